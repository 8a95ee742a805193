"""Benchmark, tuning, champion registry.

The prepared training frame is computed once and cached; each model fit is
a distributed MLlib job over it.  Model runs and the registry are small
tables (one row per run / version).
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitrine.constants import BENCHMARK_MODELS, SEARCH_SPACES, TARGET_COL, TUNING_FOLDS, TUNING_TRIALS
from vitrine.ml import models as M
from vitrine.ml.evaluate import metrics_by_split, run_record
from vitrine.ml.prepare import contiguous_folds, fit_preprocessor, hash_split, prune
from vitrine.ml.registry import Registry
from vitrine.ml.search import search
from vitrine.sources.sinks import append_metrics, write_options_json

# Independent fits (models, trials, folds) are submitted as concurrent Spark
# jobs, like CrossValidator(parallelism=...): small fits are bound by job
# overhead, and the scheduler interleaves their tasks.
PARALLELISM = 8


def _parallel(fn, items, parallelism: int = PARALLELISM) -> list:
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(items)))) as pool:
        return list(pool.map(fn, items))


RUN_SCHEMA = "model STRING, learner STRING, ord INT, test_rmse DOUBLE, test_mae DOUBLE, test_r2 DOUBLE, train_rmse DOUBLE, overfit_gap DOUBLE"


def prepare_training(gold: DataFrame, key_cols: list[str], target: str = TARGET_COL, train_pct: int = 80,
                     seed: str = "42") -> tuple[DataFrame, PipelineModel, list[str], list[str]]:
    """M1 + M2 + M3-M8 + M10: prune, hash split, fit the preprocessor on train, add features and log label."""
    pruned, cat, num = prune(gold, target=target)
    keep = list(dict.fromkeys([*pruned.columns, *key_cols]))
    # Fitting makes several passes (quantiles, moments, indexers): materialise
    # the input once (reliable checkpoint) instead of re-running its lineage.
    keyed = hash_split(gold.select(*keep), key_cols, train_pct, seed).checkpoint(eager=True)
    pre = fit_preprocessor(keyed.where("split = 'train'"), cat, num)
    prepared = M.with_log_target(pre.transform(keyed), target).select(*key_cols, target, "split", "features", M.LABEL)
    return prepared, pre, cat, num


def benchmark(prepared: DataFrame, model_names: list[str] = BENCHMARK_MODELS, target: str = TARGET_COL) -> DataFrame:
    """M21 + M22: fit every configured model on the train split, one run record per model.

    ``model`` is the name in the configuration, ``learner`` what was trained for it.
    """
    spark = prepared.sparkSession
    train = prepared.where("split = 'train'")

    def run(item):
        i, name = item
        model = M.fit(name, train)
        pred = M.predict_price(model, prepared).select("split", F.col(target).alias("y"), "pred")
        rec = run_record(pred).first()
        return (name, type(model).__name__.removesuffix("Model"), i, rec["test_rmse"], rec["test_mae"], rec["test_r2"], rec["train_rmse"], rec["overfit_gap"])

    return spark.createDataFrame(_parallel(run, list(enumerate(model_names))), RUN_SCHEMA)


def winner(runs: DataFrame) -> DataFrame:
    """Lowest test RMSE; a tie goes to the model listed first (strict '<')."""
    return runs.agg(F.min_by("model", F.struct("test_rmse", "ord")).alias("winner"),
                    F.min("test_rmse").alias("best_test_rmse"))


def leaderboard(runs: DataFrame, by: str = "test_rmse", ascending: bool = True) -> DataFrame:
    """Rank models by a metric (ties by listing order)."""
    o = F.col(by).asc() if ascending else F.col(by).desc()
    return runs.withColumn("rank", F.rank().over(Window.orderBy(o, F.col("ord")))).orderBy("rank")


#: Metrics of a test split that models are ranked by, and whether more is better.
BOARDS = {"test_r2": True, "test_mae_log": False, "test_mae": False, "test_rmse": False}


def leaderboards(metrics: DataFrame, order: list[str]) -> DataFrame:
    """(board, rank, model, metric, train_rmse, overfit_gap) for every board; ties by listing order.

    ``metrics`` has a row per model and split with rmse, mae, r2 and mae_log; the models are few.
    """
    pick = lambda name, s: F.max(F.when(F.col("split") == s, F.col(name)))
    runs = metrics.groupBy("model").agg(*[pick(m, "test").alias(f"test_{m}") for m in ("rmse", "mae", "r2", "mae_log")],
                                        pick("rmse", "train").alias("train_rmse"))
    place = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model"))
    boards = F.array(*[F.struct(F.lit(b).alias("board"), F.col(b).alias("metric"), (-F.col(b) if up else F.col(b)).alias("by")) for b, up in BOARDS.items()])
    rows = runs.select("model", "train_rmse", (F.col("test_rmse") - F.col("train_rmse")).alias("overfit_gap"), place.alias("ord"), F.explode(boards).alias("b"))
    rank = F.row_number().over(Window.partitionBy("b.board").orderBy("b.by", "ord"))
    return rows.select("b.board", rank.alias("rank"), "model", "b.metric", "train_rmse", "overfit_gap")


def tune(prepared: DataFrame, model_name: str, trials: int = TUNING_TRIALS, folds: int = TUNING_FOLDS,
         order_cols: list[str] | None = None, target: str = TARGET_COL, seed: int = 42) -> DataFrame:
    """Parzen search; each trial is scored by sqrt(mean fold MSE) in currency units over unshuffled K folds.

    Like the original, folds cover all prepared rows (quirk 11).  The fits of a round (trials times folds) run as
    concurrent jobs.  Returns one row per trial: trial, params (JSON), score; the smallest score wins.
    """
    spark = prepared.sparkSession
    data = contiguous_folds(prepared, order_cols or [prepared.columns[0]], folds, "_fold").checkpoint(eager=True)

    def fold_error(item):
        params, f = item
        m = M.fit(model_name, data.where(F.col("_fold") != f), params)
        return M.predict_price(m, data.where(F.col("_fold") == f)).agg(F.avg((F.col(target) - F.col("pred")) ** 2)).first()[0]

    def evaluate(asked: list[dict]) -> list[float]:
        errors = _parallel(fold_error, [(p, f) for p in asked for f in range(folds)])
        return [math.sqrt(sum(errors[i * folds:(i + 1) * folds]) / folds) for i in range(len(asked))]

    space = SEARCH_SPACES[model_name]
    table = search(spark, space, evaluate, trials, seed=seed)
    whole = [k for k in space if space[k][2] == "int"]
    params = F.to_json(F.struct(*[F.col(k).cast("int").alias(k) if k in whole else F.col(k) for k in sorted(space)]))
    return table.select("trial", params.alias("params"), "score")


def cv_r2(prepared: DataFrame, model_name: str = "LinearRegression", folds: int = 5, order_cols: list[str] | None = None,
          params: dict | None = None) -> DataFrame:
    """K-fold R^2 on the train split (log target), mean over folds."""
    spark = prepared.sparkSession
    train = contiguous_folds(prepared.where("split = 'train'"), order_cols or [prepared.columns[0]], folds,
                             "_fold").checkpoint(eager=True)

    def fold(f):
        m = M.fit(model_name, train.where(F.col("_fold") != f), params)
        pred = m.transform(train.where(F.col("_fold") == f)).select(F.lit("fold").alias("split"),
                                                                     F.col(M.LABEL).alias("y"), F.col("_pred_log").alias("pred"))
        return (f, metrics_by_split(pred).first()["r2"])

    scores = _parallel(fold, list(range(folds)))
    return spark.createDataFrame(scores, "fold INT, r2 DOUBLE").agg(F.avg("r2").alias("cv_r2_mean"),
                                                                      F.count(F.lit(1)).alias("folds"))


def register_champion(spark: SparkSession, pipeline: PipelineModel, name: str, registry_path: str, model_dir: str,
                      alias: str = "champion", metrics: DataFrame | None = None, options: DataFrame | None = None) -> DataFrame:
    """Store the pipeline under a version of its own and move the alias to it.

    ``metrics`` (one run record) goes to the ``model_runs`` table beside the models, ``options`` (one row) beside the
    version; both before the alias names it.
    """
    def extra(version: int, path: str) -> None:
        if options is not None:
            write_options_json(options, f"{path}_options")
        if metrics is not None:
            append_metrics(metrics.select(F.lit(name).alias("name"), F.lit(version).alias("version"), "*"), f"{model_dir.rstrip('/')}/model_runs")

    version, path = Registry(spark, registry_path).register(name, pipeline, model_dir, alias, extra)
    return spark.createDataFrame([(name, version, alias, path)], "name STRING, version INT, alias STRING, path STRING")


def load_champion(spark: SparkSession, registry_path: str, name: str, alias: str = "champion") -> tuple[PipelineModel, str]:
    """The version that carries the alias, loaded; returns (model, 'name (vN)')."""
    return Registry(spark, registry_path).load(name, alias)
