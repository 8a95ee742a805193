"""Composite jobs: profile report (C6), modelling clean-up (C7), benchmark -> tune -> register."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.operators import profile as P
from vitrine.operators.categories import value_counts
from vitrine.operators.dedup import distinct_rows
from vitrine.operators.quantiles import exact_median
from vitrine.operators.schema import columns_of_type


def profile_report(df: DataFrame, histogram_bins: int = 30) -> dict[str, DataFrame]:
    """Missingness, frequencies, summary, box statistics, histograms and correlations of a table."""
    nums = columns_of_type(df, "number")
    cats = columns_of_type(df, "string")
    out = {"missing": P.missing_report(df)}
    out.update({f"counts_{c}": value_counts(df, c) for c in cats})
    if nums:
        out["summary"] = P.numeric_summary(df, nums)
        out["box"] = P.box_stats(df, nums)
        out["corr"] = P.corr_matrix(df, nums)
        out.update({f"hist_{c}": P.histogram(df, c, histogram_bins) for c in nums})
    return out


def modelling_cleanup(df: DataFrame, target: str) -> DataFrame:
    """Full-row dedup -> drop rows without target -> median (numeric) / mode (categorical) fill."""
    df = distinct_rows(df).dropna(subset=[target])
    nums = [c for c in columns_of_type(df, "number") if c != target]
    cats = columns_of_type(df, "string")
    for c in nums:
        df = df.withColumn(c, F.coalesce(F.col(c).cast("double"), exact_median(df, c).select("median").scalar()))
    if cats:
        df = P.fill_with(df, P.column_modes(df, cats).withColumnRenamed("mode", "fill"), names=cats)
    return df


def benchmark_tune_register(spark: SparkSession, gold: DataFrame, registry_path: str, model_dir: str,
                            key_cols: list[str], name: str = "listing_price", model_names: list[str] | None = None,
                            trials: int | None = None, prepared: tuple | None = None) -> dict:
    """Benchmark the configured models, tune the winner, refit on train, register as champion.

    ``prepared`` passes what ``prepare_training`` gave for this gold table, where a caller has it already.
    The stored pipeline predicts prices; its run record and the categorical options are stored with it.
    Quirk 10 kept: a winner without a search space (LinearRegression) registers nothing.
    """
    import json

    from pyspark.ml import PipelineModel

    from vitrine.constants import BENCHMARK_MODELS, SEARCH_SPACES, TARGET_COL, TUNING_TRIALS
    from vitrine.ml import models as M
    from vitrine.ml.evaluate import run_record
    from vitrine.ml.select import benchmark, prepare_training, register_champion, tune, winner
    from vitrine.operators.categories import options_map

    if prepared is None:
        fitted = prepare_training(gold, key_cols)
        prepared = (fitted[0].checkpoint(eager=True), *fitted[1:])
    prepared, pre, cat, _ = prepared
    runs = benchmark(prepared, model_names or BENCHMARK_MODELS)
    best = winner(runs).first()["winner"]
    result = {"runs": runs, "winner": best, "registered": None}
    if best not in SEARCH_SPACES:
        return result
    scores = tune(prepared, best, trials or TUNING_TRIALS, order_cols=key_cols)
    params = json.loads(scores.orderBy("score", "trial").first()["params"])
    model = M.fit(best, prepared.where("split = 'train'"), params)
    predicted = M.predict_price(model, prepared).select("split", F.col(TARGET_COL).alias("y"), "pred")
    result["trials"] = scores
    result["registered"] = register_champion(
        spark, PipelineModel([*pre.stages, model, M.in_currency()]), name, registry_path, model_dir,
        metrics=run_record(predicted).select(F.lit(best).alias("model"), F.lit(json.dumps(params)).alias("params"), "*"),
        options=options_map(gold, cat))
    return result
