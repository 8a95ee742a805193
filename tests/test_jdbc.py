"""Partitioned reads from an embedded database inside the test's own process."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from vitrine.sources.tables import jdbc_predicates, read_jdbc_partitioned, read_table

URL = "jdbc:derby:memory:vitrine;create=true"
DRIVER = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


@pytest.fixture(scope="module")
def table(spark):
    # half of the rows crowd into a hundredth of the key range; some have no key
    rows = spark.range(4000).select(
        F.when(F.col("id") % 40 == 39, None).when(F.col("id") < 2000, F.col("id") % 997).otherwise(F.col("id") * 50).alias("K"), F.col("id").alias("V"))
    rows.coalesce(1).write.mode("overwrite").jdbc(URL, "T", properties=DRIVER)
    return rows


def test_each_row_once_in_parts_of_like_size(spark, table):
    got = read_jdbc_partitioned(spark, URL, "T", "K", 8, **DRIVER)
    parts = got.rdd.getNumPartitions()
    assert 6 <= parts <= 10
    assert sorted(r.V for r in got.collect()) == list(range(4000))
    sizes = Counter(r[0] for r in got.select(F.spark_partition_id()).collect())
    assert len(sizes) == parts and max(sizes.values()) <= 2.5 * 4000 / parts


def test_empty_table_and_single_key(spark, table):
    table.limit(0).write.mode("overwrite").jdbc(URL, "E", properties=DRIVER)
    assert jdbc_predicates(spark, URL, "E", "K", 4, **DRIVER) == ["1 = 1"] and read_jdbc_partitioned(spark, URL, "E", "K", 4, **DRIVER).count() == 0
    spark.range(50).select(F.lit(7).alias("K")).write.mode("overwrite").jdbc(URL, "S", properties=DRIVER)
    assert read_jdbc_partitioned(spark, URL, "S", "K", 4, **DRIVER).count() == 50
    assert read_table(spark, URL, "S", fmt="jdbc", **DRIVER).count() == 50
