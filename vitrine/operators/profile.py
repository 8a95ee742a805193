"""Profiling aggregates.

Every report is one or two aggregation passes; wide reports are computed as
one ``agg`` over many columns and turned into rows with ``stack`` afterwards,
so the table is scanned once regardless of the column count.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.constants import MISSING_LABEL
from vitrine.operators.quantiles import exact_quantiles, stack_numeric
from vitrine.session import materialise


def _stack_row(row_df: DataFrame, names: list[str], fields: list[list[str]], out: list[str]) -> DataFrame:
    """One-row frame of per-column aggregates -> one row per column."""
    parts = ", ".join(f"'{n}', " + ", ".join(f"`{f}`" for f in fs) for n, fs in zip(names, fields))
    return row_df.selectExpr(f"stack({len(names)}, {parts}) AS ({', '.join(out)})")


def missing_report(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """NULL count and percentage per column (one pass), most missing first."""
    cols = cols or df.columns
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        aggs.append(F.sum(F.col(c).isNull().cast("long")).alias(f"_n{i}"))
    row = df.agg(*aggs)
    row = row.select("*", *[(F.col(f"_n{i}") * 100.0 / F.col("_rows")).alias(f"_p{i}") for i in range(len(cols))])
    out = _stack_row(row, cols, [[f"_n{i}", f"_p{i}"] for i in range(len(cols))], ["column_name", "n_missing", "pct_missing"])
    return out.select("column_name", F.col("n_missing").cast("long").alias("n_missing"), "pct_missing") \
        .orderBy(F.col("pct_missing").desc(), "column_name")


def numeric_summary(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count, mean, std (ddof 1), min, exact 25/50/75 %, max per column (``describe`` transposed)."""
    long = stack_numeric(df, cols)
    basic = long.groupBy("column_name").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    q = exact_quantiles(long, "value", [0.25, 0.5, 0.75], by=["column_name"])
    return basic.join(q, "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", F.col("q_0").alias("p25"), F.col("q_1").alias("p50"),
        F.col("q_2").alias("p75"), "max")


def box_stats(df: DataFrame, cols: list[str], by: list[str] | None = None) -> DataFrame:
    """Quartiles, 1.5 IQR fences, whiskers (furthest points inside the fences), outlier count.

    Two passes: exact quartiles per (column[, group]), then one aggregate over
    the data joined to that small quartile table.  The quartiles are written
    first: with its size known the table is broadcast while it is small, so a
    few groups do not put the data into as many tasks.
    """
    by = list(by or [])
    long = stack_numeric(df.select(*by, *cols), cols) if not by else df.selectExpr(
        *[f"`{b}`" for b in by],
        f"stack({len(cols)}, " + ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols) + ") AS (column_name, value)")
    keys = ["column_name", *by]
    q = exact_quantiles(long, "value", [0.25, 0.5, 0.75], by=keys).select(
        *keys, F.col("q_0").alias("q1"), F.col("q_1").alias("median"), F.col("q_2").alias("q3"))
    q = q.withColumn("lo_fence", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))) \
         .withColumn("hi_fence", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")))
    q = materialise(q, "fences")
    v = F.col("value")
    inside = v.between(F.col("lo_fence"), F.col("hi_fence"))
    agg = long.where(v.isNotNull()).join(q, keys).groupBy(*keys).agg(
        F.min(F.when(inside, v)).alias("whisker_lo"), F.max(F.when(inside, v)).alias("whisker_hi"),
        F.sum((~inside).cast("long")).alias("n_outliers"))
    return q.join(agg, keys).select(*keys, "q1", "median", "q3", (F.col("q3") - F.col("q1")).alias("iqr"),
                                    "whisker_lo", "whisker_hi", "n_outliers")


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width bins between min and max; the max falls in the last bin.

    min and max are scalar subqueries (one-row aggregates).
    """
    x = F.col(col).cast("double")
    mn = df.agg(F.min(x)).scalar()
    mx = df.agg(F.max(x)).scalar()
    w = (mx - mn) / bins
    b = F.when(w == 0, F.lit(0)).otherwise(F.least(F.floor((x - mn) / w), F.lit(bins - 1))).cast("int")
    counted = df.where(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select("bin", (mn + F.col("bin") * (mx - mn) / bins).alias("bin_lo"),
                          (mn + (F.col("bin") + 1) * (mx - mn) / bins).alias("bin_hi"), "n")


def kde_grid(df: DataFrame, col: str, points: int = 100) -> DataFrame:
    """Gaussian KDE on an equal grid from min to max, Scott bandwidth (std * n^-1/5).

    Pass 1 is a one-row aggregate (n, std, min, max: four numbers to the
    driver, a fixed size).  Pass 2 sums every grid point's kernel in ONE
    aggregate (``points`` sum expressions over literal grid values): no grid x
    data join, no per-row explosion.
    """
    x = F.col(col).cast("double")
    data = df.where(x.isNotNull())
    st = data.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp(x).alias("sd"),
                  F.min(x).alias("mn"), F.max(x).alias("mx")).first()
    n, sd, mn, mx = st["n"], st["sd"], st["mn"], st["mx"]
    if not n or sd is None or sd == 0:
        return df.sparkSession.createDataFrame([], "i INT, x DOUBLE, density DOUBLE")
    bw = sd * n ** (-0.2)
    grid = [mn + (mx - mn) * (i / (points - 1)) for i in range(points)]
    sums = data.agg(*[F.sum(F.exp(F.lit(-0.5) * F.pow((x - F.lit(g)) / F.lit(bw), 2))).alias(f"_s{i}")
                      for i, g in enumerate(grid)])
    norm = 1.0 / (n * bw * math.sqrt(2 * math.pi))
    cols = [c for i, g in enumerate(grid) for c in (F.lit(i), F.lit(g), F.col(f"_s{i}") * F.lit(norm))]
    return sums.select(F.stack(F.lit(points), *cols).alias("i", "x", "density"))


def pearson(x: Column, y: Column) -> Column:
    """Pearson r over rows where both are there; null without variance (``F.corr`` divides by zero there under ANSI)."""
    both = x.isNotNull() & y.isNotNull()
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y)))


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson r for every ordered pair, pairwise-complete, one pass; a constant column has null."""
    pairs = [(a, b) for a in cols for b in cols]
    row = df.agg(*[pearson(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_r{i}") for i, (a, b) in enumerate(pairs)])
    parts = ", ".join(f"'{a}', '{b}', `_r{i}`" for i, (a, b) in enumerate(pairs))
    return row.selectExpr(f"stack({len(pairs)}, {parts}) AS (col_a, col_b, r)")


def group_mean_sd(df: DataFrame, by: str, value: str) -> DataFrame:
    """Mean, sample std and count of ``value`` per group."""
    return df.groupBy(by).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"),
                              F.count(value).alias("n"))


def column_modes(df: DataFrame, cols: list[str]) -> DataFrame:
    """Most frequent non-null value per column; ties -> smallest; none -> 'missing'.

    Counts come from one stacked partial aggregate; the winner per column is
    a ``min_by`` over (-count, value), again with a partial aggregate.
    """
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in cols)
    long = df.selectExpr(f"stack({len(cols)}, {pairs}) AS (column_name, value)").where(F.col("value").isNotNull())
    counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("column_name").agg(F.min_by("value", F.struct(-F.col("n"), "value")).alias("mode"))
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column_name STRING")
    return names.join(best, "column_name", "left").select(
        "column_name", F.coalesce("mode", F.lit(MISSING_LABEL)).alias("mode"))


def fill_with(df: DataFrame, stats: DataFrame, key: str = "column_name", value: str = "fill", names: list[str] | None = None) -> DataFrame:
    """M3 / M9: fill NULLs with a per-column value from a (column_name, fill) table.

    Each fill value is a scalar subquery over the small stats table; ``names`` (the columns it has) saves a job.
    """
    if names is None:
        names = [r[0] for r in stats.select(key).distinct().collect()]  # bounded: one per column
    return df.select(*[
        F.coalesce(F.col(c), stats.where(F.col(key) == c).select(F.col(value).cast(t)).scalar()).alias(c)
        if c in names else F.col(c)
        for c, t in df.dtypes
    ])
