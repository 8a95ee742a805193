"""Adaptive hyper-parameter search by a tree-structured Parzen estimator over the trial table.

The trials of a study are split into the good share and the rest.  Per parameter both halves are densities on the unit
interval (log and whole-number ranges are mapped onto it): a uniform prior plus one truncated logistic kernel per trial.
Candidates are drawn from the good density; the one with the greatest ratio of good to bad density, over all parameters,
is the next proposal.  Trials of any number of studies lie in one table; candidates are the small side.

The logistic kernel stands in for the usual normal one, because its distribution function has a closed form in SQL.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Share of the trials that counts as good, and candidates drawn per proposal.
GOOD_SHARE = 0.15
CANDIDATES = 24
#: Least width of a kernel on the unit interval, over one more than the number of trials: few trials stay broad.
LEAST_WIDTH = 0.5

#: Scale of a logistic distribution with standard deviation 1.
_SPREAD = 3 ** 0.5 / math.pi

Space = dict[str, tuple[float, float, str]]


def to_unit(value: Column, lo: float, hi: float, kind: str) -> Column:
    """Place of a value in its range: 0 to 1, by logarithms for ``log``; a whole number stands in the middle of its unit."""
    if kind == "log":
        return (F.ln(value) - F.ln(F.lit(float(lo)))) / (F.ln(F.lit(float(hi))) - F.ln(F.lit(float(lo))))
    if kind == "int":
        return (value - F.lit(lo - 0.5)) / F.lit(float(hi - lo + 1))
    return (value - F.lit(float(lo))) / F.lit(float(hi - lo))


def from_unit(u: Column, lo: float, hi: float, kind: str) -> Column:
    """The value at a place of its range; whole numbers are rounded into it."""
    if kind == "log":
        return F.exp(F.ln(F.lit(float(lo))) + u * (F.ln(F.lit(float(hi))) - F.ln(F.lit(float(lo)))))
    if kind == "int":
        return F.least(F.lit(float(hi)), F.floor(F.lit(float(lo)) + u * F.lit(float(hi - lo + 1))).cast("double"))
    return F.lit(float(lo)) + u * F.lit(float(hi - lo))


def _by_name(name: Column, space: Space, fn, value: Column) -> Column:
    out = F.lit(None).cast("double")
    for key, (lo, hi, kind) in space.items():
        out = F.when(name == key, fn(value, lo, hi, kind)).otherwise(out)
    return out


def observations(trials: DataFrame, space: Space, study: str = "study", good_share: float = GOOD_SHARE) -> DataFrame:
    """(study, name, u, good): one row per trial and parameter.

    ``trials`` has the study, ``trial``, ``score`` and a column per parameter.  The ceil(good_share * n) trials with the
    least scores are good (ties: earlier trial).  Trials without a score do not count; null parameters have no row.
    """
    ranked = trials.where(F.col("score").isNotNull())
    place = F.row_number().over(Window.partitionBy(study).orderBy("score", "trial"))
    n = F.count(F.lit(1)).over(Window.partitionBy(study))
    ranked = ranked.withColumn("good", place <= F.ceil(F.lit(good_share) * n))
    pairs = F.array(*[F.struct(F.lit(k).alias("name"), to_unit(F.col(k).cast("double"), *space[k]).alias("u")) for k in space])
    return ranked.select(study, "good", F.explode(pairs).alias("p")).select(study, "p.name", "p.u", "good").where(F.col("u").isNotNull())


def kernel_widths(observed: DataFrame, study: str = "study") -> DataFrame:
    """(study, name, good, n, width): Scott's width per half, one aggregate."""
    return observed.groupBy(study, "name", "good").agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("u").alias("sd")).select(
        study, "name", "good", "n", F.greatest(F.col("sd") * F.pow("n", F.lit(-0.2)) * F.lit(_SPREAD), F.lit(LEAST_WIDTH) / (F.col("n") + 1)).alias("width"))


def _logistic(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def densities(observed: DataFrame, points: DataFrame, study: str = "study") -> DataFrame:
    """``points`` (study, point, name, u) with ``good`` and ``bad``: both densities at each point.

    The points meet the trials of their study and parameter in an equality join whose sums are pre-aggregated; the side
    of the points is small, and Spark broadcasts it if its measured size allows.  A half without trials is its prior, 1.
    """
    widths = kernel_widths(observed, study)
    seen = observed.join(widths, [study, "name", "good"])
    met = seen.join(points.withColumnRenamed("u", "at"), [study, "name"])
    z = (F.col("at") - F.col("u")) / F.col("width")
    inside = _logistic((F.lit(1.0) - F.col("u")) / F.col("width")) - _logistic(-F.col("u") / F.col("width"))
    kernel = F.exp(-F.abs(z)) / (F.col("width") * F.pow(F.lit(1.0) + F.exp(-F.abs(z)), F.lit(2.0))) / inside
    sums = met.groupBy(study, "point", "name").agg(
        *[F.coalesce(F.sum(F.when(half, kernel)), F.lit(0.0)).alias(f"s_{tag}") for tag, half in (("good", F.col("good")), ("bad", ~F.col("good")))],
        *[F.count(F.when(half, F.lit(1))).alias(f"n_{tag}") for tag, half in (("good", F.col("good")), ("bad", ~F.col("good")))])
    share = lambda tag: ((F.lit(1.0) + F.coalesce(f"s_{tag}", F.lit(0.0))) / (F.lit(1.0) + F.coalesce(f"n_{tag}", F.lit(0)))).alias(tag)
    return points.join(sums, [study, "point", "name"], "left").select(study, "point", "name", "u", share("good"), share("bad"))


def _chance(seed: int, *parts) -> Column:
    """Uniform in (0, 1) from a hash of its parts: the same draw wherever it is made."""
    return (F.pmod(F.xxhash64(F.lit(seed), *parts), F.lit(1 << 30)) + F.lit(0.5)) / F.lit(float(1 << 30))


def propose(trials: DataFrame, space: Space, slots: int, seed: int = 42, study: str = "study", candidates: int = CANDIDATES,
            good_share: float = GOOD_SHARE) -> DataFrame:
    """(study, slot, one column per parameter): ``slots`` proposals for each study of the trial table.

    Every slot draws its own candidates: per parameter one of the good trials or the prior, by a hash, then a place by
    the inverse of the truncated logistic distribution.
    """
    observed = observations(trials, space, study, good_share)
    widths = kernel_widths(observed, study).where("good")
    order = Window.partitionBy(study, "name").orderBy("u")
    good = observed.where("good").withColumn("k", F.row_number().over(order)).join(widths, [study, "name", "good"]).select(
        study, "name", "k", F.col("u").alias("centre"), "width")
    names = F.array(*[F.lit(k) for k in space])
    drawn = widths.groupBy(study).agg(F.max("n").alias("n")).select(
        study, "n", F.explode(F.sequence(F.lit(0), F.lit(slots * candidates - 1))).alias("point"), F.explode(names).alias("name"))
    drawn = drawn.withColumn("k", F.floor(_chance(seed, F.lit("pick"), study, "point", "name") * (F.col("n") + 1)).cast("int"))
    drawn = drawn.withColumn("r", _chance(seed, F.lit("place"), study, "point", "name")).join(good, [study, "name", "k"], "left")
    lo, hi = _logistic(-F.col("centre") / F.col("width")), _logistic((F.lit(1.0) - F.col("centre")) / F.col("width"))
    q = lo + F.col("r") * (hi - lo)
    u = F.when(F.col("centre").isNull(), F.col("r")).otherwise(F.col("centre") + F.col("width") * F.ln(q / (F.lit(1.0) - q)))
    points = drawn.select(study, "point", "name", F.least(F.greatest(u, F.lit(0.0)), F.lit(1.0)).alias("u"))
    rated = densities(observed, points, study).groupBy(study, "point").agg(
        F.sum(F.ln("good") - F.ln("bad")).alias("gain"), F.map_from_entries(F.collect_list(F.struct("name", "u"))).alias("us"))
    slot = F.floor(F.col("point") / candidates).cast("int").alias("slot")
    best = rated.groupBy(study, slot).agg(F.max_by("us", F.struct("gain", -F.col("point"))).alias("us"))
    return best.select(study, "slot", *[from_unit(F.col("us")[k], *space[k]).alias(k) for k in space])


def random_trials(spark: SparkSession, space: Space, n: int, seed: int = 42, study: str = "study", name: str = "0") -> DataFrame:
    """(study, slot, one column per parameter): seeded draws from the whole space, for the first trials."""
    rows = spark.range(n).select(F.lit(name).alias(study), F.col("id").cast("int").alias("slot"))
    return rows.select(study, "slot", *[from_unit(_chance(seed, F.lit(k), "slot"), *space[k]).alias(k) for k in space])


def search(spark: SparkSession, space: Space, evaluate, trials: int, parallel: int = 4, startup: int | None = None,
           seed: int = 42) -> DataFrame:
    """(trial, score, one column per parameter): rounds of ``parallel`` proposals, each round from all trials so far.

    ``evaluate`` takes a list of parameter dicts and returns their scores (less is better).  Trials are the only rows
    that pass the driver: ``trials`` of them.
    """
    startup = min(trials, startup if startup is not None else max(parallel, trials // 4))
    done: list[tuple] = []
    kinds = ", ".join(f"`{k}` double" for k in space)
    while len(done) < trials:
        slots = startup if not done else min(parallel, trials - len(done))
        if not done:
            asked = random_trials(spark, space, slots, seed)
        else:
            table = spark.createDataFrame([("0", *r) for r in done], f"study string, trial int, score double, {kinds}")
            asked = propose(table, space, slots, seed + len(done))
        rows = [{k: int(r[k]) if space[k][2] == "int" else r[k] for k in space} for r in asked.orderBy("slot").collect()]
        done += [(len(done) + i, float(s), *[float(p[k]) for k in space]) for i, (p, s) in enumerate(zip(rows, evaluate(rows)))]
    return spark.createDataFrame(done, f"trial int, score double, {kinds}")
