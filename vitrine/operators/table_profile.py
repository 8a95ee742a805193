"""Profile of a whole table (C6) in two scans, whatever the number of columns.

The first scan is one aggregate with a fixed number of values per column and pair of columns (counts, moments, bounds,
correlations); its single row goes to the driver.  The second counts histogram bins between these bounds and the values
of text columns together, added up per task before the one shuffle.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.operators.profile import pearson
from vitrine.operators.schema import columns_of_type

SCHEMA = "column_name STRING, stat STRING, key STRING, value DOUBLE"


def _number(df: DataFrame, name: str) -> Column:
    """The column as double; NaN counts as missing."""
    x = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(x), x)


def table_profile(df: DataFrame, bins: int = 30) -> DataFrame:
    """column_name, stat, key, value: one row per figure.

    ``missing`` and ``missing_pct`` of every column; ``mean``, ``std`` (ddof 1), ``min``, ``max`` of numbers; ``corr`` with a later number
    column (``key``), over rows where both are there; ``bin`` counts of ``bins`` equal bins (``key`` from 0, the maximum in the last
    one); ``count`` of every value (``key``) of text columns.  A figure that does not exist (no rows, one row, no variance) is null; empty
    bins have no row.  An empty table has its ``missing`` rows only, with null shares.
    """
    nums, cats = columns_of_type(df, "number"), columns_of_type(df, "string")
    number = {c: _number(df, c) for c in nums}
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.count(number.get(c, F.col(f"`{c}`"))).alias(f"n{i}") for i, c in enumerate(df.columns)]
    for i, c in enumerate(nums):
        aggs += [f(number[c]).alias(f"{s}{i}") for s, f in (("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))]
    pairs = list(combinations(range(len(nums)), 2))
    aggs += [pearson(number[nums[i]], number[nums[j]]).alias(f"corr{i}_{j}") for i, j in pairs]
    got = df.agg(*aggs).first()
    total = got["rows"]
    rows = []
    for i, c in enumerate(df.columns):
        missing = total - got[f"n{i}"]
        rows += [(c, "missing", "", float(missing)), (c, "missing_pct", "", 100.0 * missing / total if total else None)]
    if total:
        rows += [(c, s, "", got[f"{s}{i}"]) for i, c in enumerate(nums) for s in ("mean", "std", "min", "max")]
        rows += [(nums[i], "corr", nums[j], got[f"corr{i}_{j}"]) for i, j in pairs]
    figures = df.sparkSession.createDataFrame(rows, SCHEMA)
    marks = []
    for i, c in enumerate(nums):
        low, high = got[f"min{i}"], got[f"max{i}"]
        if low is not None:
            width = (high - low) / bins
            place = F.least(F.floor((number[c] - F.lit(low)) / F.lit(width)), F.lit(bins - 1)) if width else F.lit(0)
            marks.append(F.when(number[c].isNotNull(), F.struct(F.lit(c).alias("column_name"), F.lit("bin").alias("stat"), place.cast("string").alias("key"))))
    marks += [F.when(F.col(f"`{c}`").isNotNull(), F.struct(F.lit(c).alias("column_name"), F.lit("count").alias("stat"), F.col(f"`{c}`").alias("key"))) for c in cats]
    if not marks:
        return figures
    counted = (df.select(F.explode(F.array_compact(F.array(*marks))).alias("m")).groupBy("m.column_name", "m.stat", "m.key")
               .agg(F.count(F.lit(1)).cast("double").alias("value")))
    return figures.unionByName(counted)
