"""Regression metrics as aggregates.

All metrics of all splits come out of ONE aggregate over a
(split, y, pred) table, so evaluating a model is a single pass over its
predictions, not one job per metric.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def metrics_by_split(pred: DataFrame, y: str = "y", p: str = "pred", split: str = "split") -> DataFrame:
    """Per split n, RMSE, MAE, R^2 (= 1 - SSE / SST, SST from var_pop * n)."""
    err = F.col(y) - F.col(p)
    g = pred.groupBy(split).agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        F.sum(err * err).alias("_sse"),
        (F.var_pop(y) * F.count(F.lit(1))).alias("_sst"),
    )
    return g.select(split, "n", "rmse", "mae",
                    F.when(F.col("_sst") > 0, 1 - F.col("_sse") / F.col("_sst")).alias("r2"))


def run_record(pred: DataFrame, y: str = "y", p: str = "pred", split: str = "split") -> DataFrame:
    """The run's one-row record: test RMSE / MAE / R^2, train RMSE, overfit gap."""
    m = metrics_by_split(pred, y, p, split)
    pick = lambda name, s: F.max(F.when(F.col(split) == s, F.col(name)))
    return m.agg(pick("rmse", "test").alias("test_rmse"), pick("mae", "test").alias("test_mae"),
                 pick("r2", "test").alias("test_r2"), pick("rmse", "train").alias("train_rmse")) \
        .withColumn("overfit_gap", F.col("test_rmse") - F.col("train_rmse"))


def currency_mae(pred: DataFrame, y_log: str = "y_log", p_log: str = "pred_log", split: str = "split") -> DataFrame:
    """MAE in log units and in currency (the inverse of ``log1p``), per split."""
    return pred.groupBy(split).agg(
        F.avg(F.abs(F.col(y_log) - F.col(p_log))).alias("mae_log"),
        F.avg(F.abs(F.expm1(y_log) - F.expm1(p_log))).alias("mae_currency"))


def log_target_is_used(df: DataFrame, y: str) -> DataFrame:
    """The notebook heuristic ``median(y) < 50`` means the target is already logged."""
    from vitrine.operators.quantiles import exact_median

    return exact_median(df, y).select((F.col("median") < 50).alias("target_is_log"))


def mean_over_folds(scores: DataFrame, key: str, score: str) -> DataFrame:
    """Mean fold score per key, and the tuning form sqrt(mean(MSE))."""
    return scores.groupBy(key).agg(F.avg(score).alias("mean_score"), F.sqrt(F.avg(score)).alias("sqrt_mean_score"))
