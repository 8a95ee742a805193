"""Exact quantiles without gathering, or shuffling, a column.

``percentile`` / ``median`` merge every distinct value into a single final
aggregation buffer; on a 100 TB column that is one task holding the column.
Here:

1. one aggregate per group gives the row count and a mergeable quantile sketch
   (``percentile_approx``, whose rank error is at most 1 / ``ACCURACY`` of the
   rows) read at ``GRID`` even steps.  The steps around a rank, one further on
   each side, are a bracket that holds it;
2. while a bracket may still hold more than ``FEW_ROWS`` rows, one counting
   pass inside the brackets gives the exact number of rows below and the next,
   narrower sketch;
3. a last pass counts the values inside the brackets.  All rows below a bracket
   are one NULL value, so they collapse map-side and still count for the ranks;
   rows above it leave no trace.  Only those few values are shuffled;
4. they are range-partitioned, each range takes running counts, and per-range
   totals (a table of partitions x groups rows) give every range its starting
   rank.  One aggregate picks, per group, the values whose rank interval covers
   the ranks of the linear interpolation (pandas / ``quantile_cont`` rule:
   h = p * (n - 1)).

A sketch only decides what is counted.  That a bracket holds its rank is proven
by the counts of the last pass; a group for which it does not (it cannot happen
within the sketch's bound) fails the job instead of giving a wrong value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.session import materialise

#: Steps at which a sketch is read, and the inverse of its relative rank error.
GRID = 256
ACCURACY = 4096
#: Rows that a bracket may hold before the values in it are counted.
FEW_ROWS = 1_000_000
#: Counting passes inside brackets, beyond which the last pass counts whatever they hold.
MOST_PASSES = 4


def _sketch(v: Column) -> Column:
    return F.percentile_approx(v, [j / GRID for j in range(GRID + 1)], ACCURACY)


def _ranks(p: float, n: Column) -> tuple[Column, Column, Column]:
    """The two 0-based ranks that the quantile lies between, and its place between them."""
    h = F.lit(float(p)) * (n - 1)
    low = F.floor(h).cast("long")
    return low, F.least(low + 1, n - 1), h - low


def _bracket(low: Column, high: Column, below: Column, n: Column, q: Column) -> tuple[Column, Column]:
    """Steps of a sketch of ``n`` rows, ``below`` rows above the group's least, around the ranks; NULL: no bound."""
    first = F.floor((low - below) / n * GRID).cast("int") - 1
    last = F.ceil((high - below + 1) / n * GRID).cast("int") + 1
    return F.when(first > 0, F.get(q, first)), F.when(last < GRID, F.get(q, last))


def _brackets(data: DataFrame, probs: list[float], by: list[str]) -> DataFrame:
    """(by, _n, _lo{i}, _hi{i}): the group's row count and a bracket for every probability."""
    first = materialise(data.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), _sketch(F.col("_v")).alias("_q")).where("_n > 0"), "sketch")
    known = first.select(*by, "_n", "_q", *[x for i, p in enumerate(probs) for x in _named(i, _bracket(
        *_ranks(p, F.col("_n"))[:2], F.lit(0), F.col("_n"), F.col("_q")))])
    share = 3 / GRID + 2 / ACCURACY
    largest = (first.agg(F.max("_n")).first()[0] or 0) * share
    known = known.drop("_q")
    for _ in range(MOST_PASSES):
        if largest <= FEW_ROWS:
            break
        met = _with(data, known, by)
        inside = [_inside(i) for i in range(len(probs))]
        counted = met.groupBy(*by).agg(
            *[F.count_if(F.coalesce(F.col("_v") < F.col(f"_lo{i}"), F.lit(False))).alias(f"_b{i}") for i in range(len(probs))],
            *[F.count_if(x).alias(f"_c{i}") for i, x in enumerate(inside)],
            *[_sketch(F.when(x, F.col("_v"))).alias(f"_q{i}") for i, x in enumerate(inside)])
        stats = _with(known, materialise(counted, "sketch"), by)
        narrowed = []
        for i, p in enumerate(probs):
            lo, hi = _bracket(*_ranks(p, F.col("_n"))[:2], F.col(f"_b{i}"), F.col(f"_c{i}"), F.col(f"_q{i}"))
            narrowed += _named(i, (F.coalesce(lo, f"_lo{i}"), F.coalesce(hi, f"_hi{i}")))
        largest = share * max(stats.agg(*[F.max(f"_c{i}").alias(f"c{i}") for i in range(len(probs))]).first())
        # written, so that the next pass joins a table of known size: a row per group
        known = materialise(stats.select(*by, "_n", *narrowed), "brackets")
    return known


def _named(i: int, bounds: tuple[Column, Column]) -> list[Column]:
    return [bounds[0].alias(f"_lo{i}"), bounds[1].alias(f"_hi{i}")]


def _inside(i: int) -> Column:
    v, lo, hi = F.col("_v"), F.col(f"_lo{i}"), F.col(f"_hi{i}")
    return (lo.isNull() | (v >= lo)) & (hi.isNull() | (v <= hi))


def _with(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """Join by the group; NULL groups meet too.  Without groups the right side is one row."""
    if not by:
        return left.crossJoin(F.broadcast(right))
    named = right.withColumnsRenamed({b: f"_by_{i}" for i, b in enumerate(by)})
    on = [F.col(b).eqNullSafe(F.col(f"_by_{i}")) for i, b in enumerate(by)]
    condition = on[0]
    for c in on[1:]:
        condition = condition & c
    return left.join(named, condition).drop(*[f"_by_{i}" for i in range(len(by))])


def exact_quantiles(df: DataFrame, value: str, probs: list[float], by: list[str] | None = None,
                    prefix: str = "q", partitions: int | None = None) -> DataFrame:
    """One row per group (or one row), columns ``{prefix}_{i}`` for ``probs[i]``.

    NULL values are ignored; groups without values yield no row.
    """
    by = list(by or [])
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    data = df.where(F.col(value).isNotNull()).select(*by, F.col(value).alias("_v"))
    known = _brackets(data, probs, by)
    met = _with(data, known, by)
    # a row counts for every bracket that it does not lie above: by its value, or as one of the rows below
    marks = [F.when(F.col(f"_hi{i}").isNull() | (F.col("_v") <= F.col(f"_hi{i}")), F.struct(F.lit(i).alias("i"), F.when(_inside(i), F.col("_v")).alias("v")))
             for i in range(len(probs))]
    counted = met.select(*by, F.explode(F.filter(F.array(*marks), lambda m: m.isNotNull())).alias("_m")).groupBy(
        *by, F.col("_m.i").alias("_i"), F.col("_m.v").alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    keys = [*by, "_i"]
    ranged = counted.repartitionByRange(parts, *keys, "_v").withColumn("_pid", F.spark_partition_id())
    running = Window.partitionBy("_pid", *keys).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # written once: totals and values then belong to the same split into ranges
    local = materialise(ranged.withColumn("_cum", F.sum("_c").over(running)), "quantiles")
    totals = local.groupBy("_pid", *keys).agg(F.max("_cum").alias("_t"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "_pid", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off"))
    placed = _with(_with(local, offsets, [*keys, "_pid"]), known.select(*by, "_n"), by).select(
        *keys, "_v", "_n", (F.col("_off") + F.col("_cum") - F.col("_c")).alias("_lo"), (F.col("_off") + F.col("_cum")).alias("_hi"))
    picks, results = [], []
    for i, p in enumerate(probs):
        low, high, between = _ranks(p, F.col("_n"))
        own = F.col("_i") == i
        for x, k in (("a", low), ("b", high)):
            here = own & (F.col("_lo") <= k) & (k < F.col("_hi"))
            found = F.max(F.when(here, F.col("_v")))
            picks.append(F.when(found.isNotNull(), found).otherwise(F.raise_error(F.lit("a bracket does not hold its rank"))).alias(f"_{x}{i}"))
        picks.append(F.max(between).alias(f"_w{i}"))
        results.append((F.col(f"_a{i}") + F.col(f"_w{i}") * (F.col(f"_b{i}") - F.col(f"_a{i}"))).alias(f"{prefix}_{i}"))
    # without groups the one group is a constant, so that an empty input has no row
    return placed.groupBy(*(by or [F.lit(1).alias("_all")])).agg(*picks).select(*by, *results)


def exact_median(df: DataFrame, value: str, by: list[str] | None = None, name: str = "median") -> DataFrame:
    """Exact median (mean of the two middle values for even counts)."""
    return exact_quantiles(df, value, [0.5], by).withColumnRenamed("q_0", name)


def stack_numeric(df: DataFrame, cols: list[str], name: str = "column_name", value: str = "value") -> DataFrame:
    """Long (column_name, value) view of several numeric columns: one scan for all."""
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    return df.selectExpr(f"stack({len(cols)}, {pairs}) AS ({name}, {value})")
