"""Model queries that SQL can follow: search densities, linear run records and their leaderboards."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from vitrine.ml import models as M
from vitrine.ml import search as S
from vitrine.ml.evaluate import currency_mae, metrics_by_split
from vitrine.ml.prepare import hash_split
from vitrine.ml.select import leaderboards
from vitrine.plans.catalog import register, round_doubles, table

#: A study per nation, a trial per customer; the columns stand in for parameters and scores.
_SPACE: S.Space = {"alpha": (0.01, 100.0, "log"), "max_depth": (3, 12, "int"), "subsample": (0.5, 1.0, "float")}
_TRIALS = {
    "study": "c_nationkey", "trial": "c_custkey", "score": "abs(c_acctbal)",
    "alpha": "pow(10, CAST(c_custkey % 97 AS DOUBLE) / 24 - 2)", "max_depth": "CAST(3 + c_custkey % 10 AS DOUBLE)",
    "subsample": "CAST(53 + c_custkey % 53 AS DOUBLE) / 106"}
_POINTS = 8


def _tpe_sql() -> str:
    trials = ", ".join(f"{e} AS {c}" for c, e in _TRIALS.items())
    unit = {"alpha": "(ln(alpha) - ln(0.01)) / (ln(100.0) - ln(0.01))", "max_depth": "(max_depth - 2.5) / 10.0",
            "subsample": "(subsample - 0.5) / 0.5"}
    obs = " UNION ALL ".join(f"SELECT study, good, '{k}' AS name, {e} AS u FROM ranked" for k, e in unit.items())
    names = " UNION ALL ".join(f"SELECT '{k}' AS name" for k in _SPACE)
    cdf = lambda z: f"(1.0 / (1.0 + exp(-({z}))))"
    kernel = ("exp(-abs((p.u - o.u) / w.width)) / (w.width * pow(1.0 + exp(-abs((p.u - o.u) / w.width)), 2)) / "
              f"({cdf('(1.0 - o.u) / w.width')} - {cdf('-o.u / w.width')})")
    return f"""
WITH trials AS (SELECT {trials} FROM customer),
ranked AS (SELECT *, row_number() OVER (PARTITION BY study ORDER BY score, trial) <= ceil(0.15 * count(*) OVER (PARTITION BY study)) AS good FROM trials),
obs AS ({obs}),
widths AS (SELECT study, name, good, greatest(stddev_pop(u) * pow(count(*), -0.2) * sqrt(3) / pi(), 0.5 / (count(*) + 1)) AS width FROM obs GROUP BY ALL),
points AS (SELECT study, CAST(point AS INTEGER) AS point, name, (point + 0.5) / {_POINTS} AS u
  FROM (SELECT DISTINCT study FROM trials), (SELECT unnest(range({_POINTS})) AS point), ({names})),
sums AS (SELECT p.study, p.point, p.name, p.u, o.good, sum({kernel}) AS s, count(*) AS n
  FROM points p JOIN obs o ON o.study = p.study AND o.name = p.name JOIN widths w ON w.study = o.study AND w.name = o.name AND w.good = o.good
  GROUP BY ALL)
SELECT CAST(study AS BIGINT) AS study, point, name, round(u, 4) AS u,
  round((1.0 + coalesce(sum(s) FILTER (good), 0)) / (1.0 + coalesce(sum(n) FILTER (good), 0)), 4) AS good,
  round((1.0 + coalesce(sum(s) FILTER (NOT good), 0)) / (1.0 + coalesce(sum(n) FILTER (NOT good), 0)), 4) AS bad
FROM sums GROUP BY study, point, name, u"""


@register("tpe_densities", "M23", sql=_tpe_sql())
def q_tpe_densities(spark, sf_dir):
    """Good and bad densities of every parameter of every study, at the middles of eighths of its range."""
    trials = table(spark, sf_dir, "customer").selectExpr(*[f"{e} AS {c}" for c, e in _TRIALS.items()])
    observed = S.observations(trials, _SPACE)
    names = F.array(*[F.lit(k) for k in _SPACE])
    points = trials.select("study").distinct().select(
        "study", F.explode(F.sequence(F.lit(0), F.lit(_POINTS - 1))).alias("point"), F.explode(names).alias("name"))
    points = points.withColumn("u", (F.col("point") + 0.5) / _POINTS)
    return round_doubles(S.densities(observed, points)).withColumn("study", F.col("study").cast("long"))


#: Penalties that are large enough to move the slope of one feature over all rows.
_LINEAR = {"LinearRegression": {}, "Ridge": {"alpha": 1_000_000.0}, "Lasso": {"alpha": 0.3}}


def _linear_sql() -> str:
    split = ("CASE WHEN CAST('0x' || substr(md5(concat_ws('|', '42', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR))), 1, 8) "
             "AS BIGINT) % 100 < 80 THEN 'train' ELSE 'test' END")
    slopes = {"LinearRegression": "cxy / vx", "Ridge": "n * cxy / (n * vx + 1000000.0)", "Lasso": "sign(cxy) * greatest(abs(cxy) - 0.3, 0) / vx"}
    models = " UNION ALL ".join(f"SELECT {i} AS ord, '{m}' AS model, {e} AS slope, mx, my FROM st" for i, (m, e) in enumerate(slopes.items()))
    return f"""
WITH d AS (SELECT l_quantity AS x, l_extendedprice AS y, ln(1 + l_extendedprice) AS ly, {split} AS split FROM lineitem),
st AS (SELECT count(*) AS n, avg(x) AS mx, avg(ly) AS my, covar_pop(x, ly) AS cxy, var_pop(x) AS vx FROM d WHERE split = 'train'),
models AS ({models}),
pred AS (SELECT ord, model, split, y, ly, my + slope * (x - mx) AS lp FROM d, models),
m AS (SELECT ord, model, split, sqrt(avg((y - (exp(lp) - 1)) ** 2)) AS rmse, avg(abs(y - (exp(lp) - 1))) AS mae,
  1 - sum((y - (exp(lp) - 1)) ** 2) / (var_pop(y) * count(*)) AS r2, avg(abs(ly - lp)) AS mae_log FROM pred GROUP BY ALL),
r AS (SELECT a.ord, a.model, a.rmse AS test_rmse, a.mae AS test_mae, a.r2 AS test_r2, a.mae_log AS test_mae_log,
  b.rmse AS train_rmse, a.rmse - b.rmse AS overfit_gap FROM m a JOIN m b ON a.model = b.model AND a.split = 'test' AND b.split = 'train'),
boards AS (SELECT model, 'test_r2' AS board, round(test_r2, 4) AS metric, row_number() OVER (ORDER BY test_r2 DESC, ord) AS rank FROM r
  UNION ALL SELECT model, 'test_mae_log', round(test_mae_log, 4), row_number() OVER (ORDER BY test_mae_log, ord) FROM r
  UNION ALL SELECT model, 'test_mae', round(test_mae, 4), row_number() OVER (ORDER BY test_mae, ord) FROM r
  UNION ALL SELECT model, 'test_rmse', round(test_rmse, 4), row_number() OVER (ORDER BY test_rmse, ord) FROM r)
SELECT board, CAST(rank AS INTEGER) AS rank, model, metric, round(train_rmse, 4) AS train_rmse, round(overfit_gap, 4) AS overfit_gap
FROM boards JOIN r USING (model)"""


@register("linear_leaderboards", "M10 M11 M12 M13 M22 M25 O3 A18 A19 A20 A21 T21", sql=_linear_sql())
def q_linear_leaderboards(spark, sf_dir):
    """Linear, ridge and lasso fitted on log1p of the price of every line; four leaderboards of their run records.

    The predictions of all models lie in one table, so all metrics are one aggregate.
    """
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"))
    rows = M.with_log_target(VectorAssembler(inputCols=["x"], outputCol="features").transform(hash_split(rows, ["l_orderkey", "l_linenumber"])), "y")
    train = rows.where("split = 'train'")
    stacked = None
    for i, (name, params) in enumerate(_LINEAR.items()):
        pred = M.fit(name, train, params).transform(rows).select(
            F.lit(i).alias("ord"), F.lit(name).alias("model"), "split", "y", F.expm1("_pred_log").alias("pred"),
            F.col(M.LABEL).alias("y_log"), F.col("_pred_log").alias("pred_log"))
        stacked = pred if stacked is None else stacked.unionByName(pred)
    both = stacked.withColumn("run", F.concat_ws("|", "model", "split"))
    metrics = metrics_by_split(both, split="run").join(currency_mae(both, split="run").select("run", "mae_log"), "run")
    return round_doubles(leaderboards(metrics.select(
        F.split("run", r"\|")[0].alias("model"), F.split("run", r"\|")[1].alias("split"), "rmse", "mae", "r2", "mae_log"), list(_LINEAR)))
