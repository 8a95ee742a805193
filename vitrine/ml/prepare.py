"""Feature preparation.

The fitted preprocessor is an MLlib ``PipelineModel`` (persistable with
``write().save``): a ``SQLTransformer`` carries the fitted constants (exact
medians, means, population stds), then ``StringIndexer`` -> ``OneHotEncoder``
-> ``VectorAssembler``.  Fitting is a handful of aggregates whose results are
one row per column (bounded), so the constants can live in the plan.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.constants import MISSING_LABEL, MODEL_DROP_COLS, TARGET_COL
from vitrine.operators.quantiles import exact_quantiles, stack_numeric
from vitrine.operators.schema import columns_of_type
from vitrine.session import materialise


def prune(df: DataFrame, drop_cols: list[str] = MODEL_DROP_COLS, target: str = TARGET_COL) -> tuple[DataFrame, list[str], list[str]]:
    """Drop configured columns, return (df, categorical, numeric) feature lists."""
    kept = df.drop(*[c for c in drop_cols if c in df.columns])
    feats = kept.drop(target)
    cat = columns_of_type(feats, "string")
    num = columns_of_type(feats, "number")
    return kept, cat, num


def hash_split(df: DataFrame, key_cols: list[str], train_pct: int = 80, seed: str = "42", col: str = "split") -> DataFrame:
    """M2: repeatable split from a hash of the key: same rows whatever the partitioning."""
    key = F.concat_ws("|", F.lit(seed), *[F.col(c).cast("string") for c in key_cols])
    bucket = F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long"), F.lit(100))
    return df.withColumn(col, F.when(bucket < train_pct, F.lit("train")).otherwise(F.lit("test")))


def global_rank(df: DataFrame, order_cols: list[str], name: str = "_rank", partitions: int | None = None) -> DataFrame:
    """0-based position of each row in ``order_cols`` order, computed without a single-task window.

    Range partitions are sorted and numbered locally, and the numbered rows are written once; the offsets (one row
    per partition) are counted from that same table, so they cannot come from another split into ranges.
    """
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order_cols).sortWithinPartitions(*order_cols)
    # the id holds the partition's number above bit 33 and the place in the partition below
    local = materialise(ranged.withColumn("_at", F.monotonically_increasing_id()), "rank")
    pid, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    counts = local.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = counts.select("_pid", F.coalesce(F.sum("_cnt").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    return (local.withColumn("_pid", pid).join(F.broadcast(offsets), "_pid")  # one row per partition: bounded
            .withColumn(name, F.col("_off") + place).drop("_pid", "_at", "_off"))


def contiguous_folds(df: DataFrame, order_cols: list[str], k: int, name: str = "fold") -> DataFrame:
    """Unshuffled K-fold (contiguous blocks, the first ``n % k`` folds one row larger)."""
    n = df.agg(F.count(F.lit(1))).scalar()
    q = F.floor(n / k)
    r = n - q * k
    ranked = global_rank(df, order_cols)
    big = r * (q + 1)
    fold = F.when(F.col("_rank") < big, F.floor(F.col("_rank") / (q + 1))).otherwise(
        r + F.floor((F.col("_rank") - big) / q))
    return ranked.withColumn(name, fold.cast("int")).drop("_rank")


def hash_folds(df: DataFrame, key_cols: list[str], k: int, seed: str = "7", name: str = "fold") -> DataFrame:
    """W4 at scale: fold from a key hash (no ordering needed), for ``CrossValidator(foldCol=...)``."""
    key = F.concat_ws("|", F.lit(seed), *[F.col(c).cast("string") for c in key_cols])
    return df.withColumn(name, F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long"), F.lit(k)).cast("int"))


def fit_preprocessor(train: DataFrame, categorical: list[str], numeric: list[str], drop_first: bool = False,
                     scale: bool = True, impute: bool = True, features: str = "features") -> PipelineModel:
    """M3-M8: median impute + standard scale numerics; 'missing' + one-hot categoricals; assemble.

    ``drop_first=True`` is the notebook encoder (first category dropped,
    numerics passed through).  Unknown categories encode as all zeros: the
    indexer keeps them as index ``numLabels`` and the encoder (default
    ``handleInvalid``) drops exactly that last slot.
    """
    meds: dict[str, float] = {}
    stats: dict[str, tuple[float, float]] = {}
    if numeric and impute:
        q = exact_quantiles(stack_numeric(train, numeric), "value", [0.5], by=["column_name"]).collect()
        meds = {r["column_name"]: r["q_0"] for r in q}
    num_exprs = {c: (f"coalesce(CAST(`{c}` AS DOUBLE), {meds[c]!r}D)" if meds.get(c) is not None
                     else f"CAST(`{c}` AS DOUBLE)") for c in numeric}
    if numeric and scale:
        row = train.selectExpr(*[f"{e} AS `{c}`" for c, e in num_exprs.items()]).agg(
            *[F.avg(c).alias(f"m_{i}") for i, c in enumerate(numeric)],
            *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(numeric)]).first()
        stats = {c: (row[f"m_{i}"], row[f"s_{i}"]) for i, c in enumerate(numeric)}
    sel = ["*"]
    for c in numeric:
        e = num_exprs[c]
        if scale:
            m, s = stats[c]
            e = "0.0D" if m is None or not s else f"(({e} - {m!r}D) / {s!r}D)"
        sel.append(f"{e} AS `{c}__num`")
    for c in categorical:
        sel.append(f"coalesce(CAST(`{c}` AS STRING), '{MISSING_LABEL}') AS `{c}__cat`")
    stages = [SQLTransformer(statement=f"SELECT {', '.join(sel)} FROM __THIS__")]
    assembled = [f"{c}__num" for c in numeric]
    if categorical:
        prepared = stages[0].transform(train)
        idx = StringIndexer(inputCols=[f"{c}__cat" for c in categorical], outputCols=[f"{c}__idx" for c in categorical],
                            handleInvalid="keep", stringOrderType="alphabetAsc").fit(prepared)
        ohe = OneHotEncoder(inputCols=[f"{c}__idx" for c in categorical], outputCols=[f"{c}__ohe" for c in categorical],
                            dropLast=True).fit(idx.transform(prepared))
        stages += [idx, ohe]
        if drop_first:
            for c, labels in zip(categorical, idx.labelsArray):
                if len(labels) > 1:
                    stages.append(VectorSlicer(inputCol=f"{c}__ohe", outputCol=f"{c}__ohe1",
                                               indices=list(range(1, len(labels)))))
                    assembled.append(f"{c}__ohe1")
        else:
            assembled += [f"{c}__ohe" for c in categorical]
    stages.append(VectorAssembler(inputCols=assembled, outputCol=features, handleInvalid="keep"))
    return PipelineModel(stages)
