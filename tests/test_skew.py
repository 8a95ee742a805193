"""A key holding a third of the rows: results stay whole, work is pre-aggregated before the shuffle."""

import contextlib
import io

from pyspark.sql import functions as F

from vitrine.operators.categories import group_rare
from vitrine.operators.dedup import keep_last
from vitrine.operators.quantiles import exact_quantiles


def _skewed(spark, n=30_000):
    # one (title, price) key holds a third of all rows, the rest are small groups
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("t"), (F.col("id") % 1000).cast("string"))).alias("title"),
        F.when(F.col("id") % 3 == 0, F.lit("1 tl")).otherwise(F.lit("2 tl")).alias("price"),
        F.lit(0).alias("_src_rank"), F.col("id").alias("_seq"), (F.col("id") * 7).alias("payload"))


def test_keep_last_hot_key_is_pre_aggregated(spark):
    df = _skewed(spark).repartition(16)
    out = keep_last(df, ["title", "price"], ["_src_rank", "_seq"])
    rows = {r["title"]: r for r in out.collect()}
    assert len(rows) == 1 + 1000                  # every key kept, nothing dropped
    assert rows["hot"]["_seq"] == 29_997 and rows["hot"]["payload"] == 29_997 * 7
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain()
    plan = buf.getvalue()
    # partial aggregation below the exchange: a hot key leaves each map task as one row
    assert plan.index("Exchange hashpartitioning(title") < plan.rindex("partial_max_by")


def test_rare_and_quantiles_with_hot_value(spark):
    df = _skewed(spark)
    g = group_rare(df.select("title"), "title", 21)   # every small group has exactly 20 rows
    counts = {r["title"]: r["count"] for r in g.groupBy("title").count().collect()}
    assert counts == {"hot": 10_000, "Other": 20_000}
    q = exact_quantiles(df.select(F.when(F.col("title") == "hot", 5.0).otherwise(F.col("_seq").cast("double")).alias("v")),
                        "v", [0.5]).first()[0]
    import numpy as np

    vals = np.array([5.0 if i % 3 == 0 else float(i) for i in range(30_000)])
    assert abs(q - np.quantile(vals, 0.5)) < 1e-9
