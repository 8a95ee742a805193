"""Catalog tables that are replaced whole."""

import pytest
from pyspark.sql import functions as F

from vitrine.sources.sinks import replace_catalog_table


def test_readers_see_old_or_new(spark, tmp_path):
    def write(rows):
        replace_catalog_table(spark, rows, "layer_test", "t", str(tmp_path / "tables"))

    write(spark.range(10).withColumn("v", F.lit("old")))
    before = spark.table("layer_test.t")  # a reader that has begun
    assert before.count() == 10
    broken = spark.range(20).withColumn("v", F.when(F.col("id") == 17, F.raise_error(F.lit("lost"))).otherwise(F.lit("new")))
    with pytest.raises(Exception, match="lost"):
        write(broken)
    assert spark.table("layer_test.t").where("v = 'old'").count() == 10
    write(spark.range(20).withColumn("v", F.lit("new")).withColumn("more", F.lit(1)))
    assert spark.table("layer_test.t").where("v = 'new' AND more = 1").count() == 20
    assert before.where("v = 'old'").count() == 10
    # a table may be replaced by rows read from itself
    write(spark.table("layer_test.t").where("id < 5"))
    assert spark.table("layer_test.t").count() == 5
