"""Regressors on MLlib.

Targets are fitted on ``log1p(y)`` and predictions mapped back with
``expm1`` (M10).  Model names follow the original benchmark list; the
native boosters (XGBoost, LightGBM) and ExtraTrees have no MLlib learner and
map to the distributed tree learners with the same headline settings.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.regression import (
    DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.session import materialise

LABEL = "_y_log"

# MLlib trees cannot grow past depth 30.
MAX_TREE_DEPTH = 30
# Depth of forest trees when a configuration names none: each level is a pass over the rows and doubles the nodes the
# driver holds, so depth is a setting here, never "until the leaves are pure".
DEFAULT_TREE_DEPTH = 15


def _least_rows(params: dict) -> int:
    """Least rows of a child node for a least number of rows that a node needs to be split (MLlib bounds the children)."""
    return max(1, int(params.get("min_samples_split", 2)) // 2)


def make_estimator(name: str, params: dict | None = None, y_stats: tuple[int, float] | None = None,
                   features: str = "features", label: str = LABEL, seed: int = 42):
    """Estimator for a model name of the benchmark/tuning config."""
    p = dict(params or {})
    common = dict(featuresCol=features, labelCol=label, predictionCol="_pred_log")
    if name == "LinearRegression":
        return LinearRegression(solver="normal", regParam=0.0, **common)
    if name == "Ridge":
        # Closed-form ridge: MLlib's objective divides the loss by n and scales
        # the penalty by std(y) when standardization is off.
        alpha = float(p.get("alpha", 1.0))
        n, sd = y_stats or (1, 1.0)
        return LinearRegression(solver="normal", elasticNetParam=0.0, standardization=False,
                                regParam=alpha * (sd or 1.0) / max(n, 1), **common)
    if name == "Lasso":
        return LinearRegression(elasticNetParam=1.0, standardization=False, regParam=float(p.get("alpha", 1.0)),
                                maxIter=1000, tol=1e-4, **common)
    if name == "DecisionTree":
        return DecisionTreeRegressor(maxDepth=int(p.get("max_depth", 8)), seed=seed, **common)
    if name in ("RandomForest", "ExtraTrees"):
        depth = p.get("max_depth") or DEFAULT_TREE_DEPTH
        return RandomForestRegressor(
            numTrees=int(p.get("n_estimators", 100)), maxDepth=int(min(depth, MAX_TREE_DEPTH)),
            minInstancesPerNode=_least_rows(p),
            subsamplingRate=float(p.get("max_samples", 1.0)),
            # ExtraTrees has no MLlib learner: un-bootstrapped trees draw a random
            # feature subset per node instead of random thresholds (identical
            # trees otherwise).
            featureSubsetStrategy=str(p.get("max_features", "all" if name == "RandomForest" else "onethird")),
            bootstrap=name == "RandomForest" or bool(p.get("bootstrap", False)),
            # deep trees: cache node ids between levels, split more nodes per pass
            cacheNodeIds=True, maxMemoryInMB=1024, checkpointInterval=10, seed=seed, **common)
    if name in ("GradientBoosting", "XGBoost", "LightGBM"):
        defaults = {"GradientBoosting": (100, 0.1, 3, 1.0), "XGBoost": (100, 0.3, 6, 1.0), "LightGBM": (100, 0.1, 5, 1.0)}[name]
        n_est, lr, depth, sub = defaults
        if "num_leaves" in p:
            # a tree of n leaves is at least this deep; MLlib bounds depth, not leaves
            depth = math.ceil(math.log2(max(2, int(p["num_leaves"]))))
        share = p.get("feature_fraction", p.get("colsample_bytree"))
        return GBTRegressor(maxIter=int(p.get("n_estimators", n_est)), stepSize=float(p.get("learning_rate", lr)),
                            maxDepth=int(min(p.get("max_depth", depth), MAX_TREE_DEPTH)), subsamplingRate=float(p.get("subsample", sub)),
                            minInstancesPerNode=_least_rows(p), featureSubsetStrategy="all" if share is None else str(float(share)),
                            seed=seed, **common)
    raise ValueError(f"unknown model {name}")


def with_log_target(df: DataFrame, y: str) -> DataFrame:
    """M10 fit side: label = log1p(y)."""
    return df.withColumn(LABEL, F.log1p(F.col(y)))


def predict_price(model: Model, df: DataFrame, name: str = "pred") -> DataFrame:
    """M10 predict side: expm1 of the model's log prediction."""
    return model.transform(df).withColumn(name, F.expm1("_pred_log")).drop("_pred_log")


def in_currency() -> SQLTransformer:
    """M10 as a pipeline stage: a saved pipeline that ends in it predicts prices, not logs."""
    return SQLTransformer(statement="SELECT *, expm1(_pred_log) AS pred FROM __THIS__")


def fit(name: str, train: DataFrame, params: dict | None = None, features: str = "features") -> Model:
    """Fit one configured model on a prepared frame that has ``features`` and ``_y_log``."""
    y_stats = None
    if name == "Ridge":
        r = train.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(LABEL).alias("sd")).first()
        y_stats = (r["n"], r["sd"])
    return make_estimator(name, params, y_stats, features).fit(train)


def weighted_vote(df: DataFrame, preds: dict[str, float], name: str = "pred") -> DataFrame:
    """Weighted mean of several prediction columns."""
    total = float(sum(preds.values()))
    expr = sum((F.col(c) * w for c, w in preds.items()), F.lit(0.0)) / total
    return df.withColumn(name, expr)


def stacked_predictions(train: DataFrame, test: DataFrame, base: list[tuple[str, dict]], folds: int = 5,
                        meta_alpha: float = 100.0, fold_col: str = "_fold") -> DataFrame:
    """Out-of-fold base predictions -> ridge meta model (no passthrough).

    ``train`` needs ``fold_col`` (contiguous or hash folds).  Base models are
    refit on all of ``train`` to score ``test``.  Returns ``test`` with ``pred``.
    """
    oof = None
    for f in range(folds):
        fit_part = train.where(F.col(fold_col) != f)
        hold = train.where(F.col(fold_col) == f)
        cols = hold
        for i, (name, params) in enumerate(base):
            m = fit(name, fit_part, params)
            cols = m.transform(cols).withColumnRenamed("_pred_log", f"_b{i}")
        oof = cols if oof is None else oof.unionByName(cols)
    from pyspark.ml.feature import VectorAssembler

    meta_in = VectorAssembler(inputCols=[f"_b{i}" for i in range(len(base))], outputCol="_meta_features")
    meta_train = meta_in.transform(oof)
    meta = fit("Ridge", meta_train, {"alpha": meta_alpha}, features="_meta_features")
    scored = test
    for i, (name, params) in enumerate(base):
        scored = fit(name, train, params).transform(scored).withColumnRenamed("_pred_log", f"_b{i}")
    out = meta.transform(meta_in.transform(scored)).withColumn("pred", F.expm1("_pred_log"))
    return out.drop("_pred_log", "_meta_features", *[f"_b{i}" for i in range(len(base))])


# ----------------------------------------------------------------- exact KNN

_BLOCK = "block long, n int, ids binary, vectors binary, labels binary"


def _blocks(rows: int):
    """Pack (id, vector, label) rows into blocks of at most ``rows``."""
    def run(batches):
        for pdf in batches:
            for start in range(0, len(pdf), rows):
                part = pdf.iloc[start:start + rows]
                ids = part.iloc[:, 0].to_numpy(dtype="<i8")
                vectors = np.stack([np.asarray(v, dtype="<f8") for v in part.iloc[:, 1]])
                yield pd.DataFrame({"block": [int(ids[0])], "n": [len(ids)], "ids": [ids.tobytes()], "vectors": [vectors.tobytes()],
                                    "labels": [part.iloc[:, 2].to_numpy(dtype="<f8").tobytes()]})
    return run


def _direct(tests: np.ndarray, trains: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(test row, train row, distance) of the k nearest train rows, by direct differences of every pair."""
    d = np.sqrt(((tests[:, None, :] - trains[None]) ** 2).sum(axis=2))
    order = np.lexsort((np.broadcast_to(ids, d.shape), d), axis=1)[:, :k]
    return np.repeat(np.arange(len(tests)), order.shape[1]), order.ravel(), np.take_along_axis(d, order, 1).ravel()


def _screened(tests: np.ndarray, trains: np.ndarray, squares: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same from a matrix product: it says which pairs may be among the k, and only these are differenced.

    The product's error is bounded by the vectors' lengths, so no pair that belongs to the k is lost.
    """
    own = (tests ** 2).sum(axis=1)
    rough = own[:, None] + squares[None] - 2 * (tests @ trains.T)
    if len(trains) > k:
        slack = 16 * (tests.shape[1] + 8) * np.finfo("<f8").eps * (own + squares.max()) + 1e-300
        row, col = np.nonzero(rough <= (np.partition(rough, k - 1, axis=1)[:, k - 1] + slack)[:, None])
    else:
        row, col = np.nonzero(np.ones(rough.shape, bool))
    d = np.sqrt(((tests[row] - trains[col]) ** 2).sum(axis=1))
    order = np.lexsort((ids[col], d, row))
    row, col, d = row[order], col[order], d[order]
    kept = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[kept], col[kept], d[kept]


#: Candidates that a task holds before it keeps the k nearest of each test row, and hands them on if they are still many.
HELD_ROWS = 400_000


def _best(found: pd.DataFrame, k: int) -> pd.DataFrame:
    ordered = found.sort_values(["test_id", "dist", "train_id"], kind="stable")
    return ordered[ordered.groupby("test_id", sort=False).cumcount() < k]


def _nearest(k: int, step: int = 32):
    """k nearest of a train block per row of a test block; a task's candidates for a test row are thinned to k."""
    def run(batches):
        held, n = [], 0
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                t_ids, ids, labels = (np.frombuffer(x, d) for x, d in ((r.t_ids, "<i8"), (r.ids, "<i8"), (r.labels, "<f8")))
                tests, trains = (np.frombuffer(x, "<f8").reshape(len(i), -1) for x, i in ((r.t_vectors, t_ids), (r.vectors, ids)))
                with np.errstate(over="ignore", invalid="ignore"):
                    squares = (trains ** 2).sum(axis=1)
                    # beyond this the product could overflow; not-a-number fails the comparison too
                    plain = not (squares.max(initial=0.0) < 1e300 and (tests ** 2).sum(axis=1).max(initial=0.0) < 1e300)
                for s in range(0, len(tests), step):
                    some = tests[s:s + step]
                    row, col, d = _direct(some, trains, ids, k) if plain else _screened(some, trains, squares, ids, k)
                    held.append(pd.DataFrame({"test_id": t_ids[s:s + step][row], "train_id": ids[col], "dist": d, "label": labels[col]}))
                    n += len(row)
                if n > HELD_ROWS:
                    held = [_best(pd.concat(held), k)]
                    n = len(held[0])
                    if n > HELD_ROWS // 2:
                        yield held[0]
                        held, n = [], 0
        if held:
            yield _best(pd.concat(held), k)
    return run


def block_buckets(trains: DataFrame) -> int:
    """Buckets that train blocks are dealt to: enough for all cores, and never more than blocks."""
    return max(1, min(trains.count(), 4 * trains.sparkSession.sparkContext.defaultParallelism))


def block_bucket(buckets: int, *key: str) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def knn_predict(train: DataFrame, test: DataFrame, k: int = 3, id_col: str = "id", vec: str = "vec",
                label: str = "label", block: int = 1024) -> DataFrame:
    """Exact k nearest neighbours (Euclidean, ties by train id), uniform mean of labels.

    Both sides are packed into blocks of at most ``block`` rows.  Every test block is dealt to every bucket of train
    blocks and meets them in an equality join, so no row passes through the driver and no pair table is built; the
    buckets follow from the cores, so the test rows that are shuffled grow with the test rows alone.  A task keeps k
    candidates per test row, and a window with a map-side group limit the k best of all.  The work is test rows x
    train rows / cores: exact search has no cheaper form without an index.
    """
    trains = materialise(train.select(F.col(id_col).cast("long"), vec, F.col(label).cast("double")).mapInPandas(_blocks(block), _BLOCK), "knn")
    buckets = block_buckets(trains)
    tests = test.select(F.col(id_col).cast("long"), vec, F.lit(0.0).alias("_none")).mapInPandas(_blocks(block), _BLOCK)
    dealt = tests.select(F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("_b"), F.col("ids").alias("t_ids"),
                         F.col("vectors").alias("t_vectors"))
    kept = trains.select(block_bucket(buckets, "block", "n").alias("_b"), "ids", "vectors", "labels")
    pairs = dealt.join(kept, "_b").select("t_ids", "t_vectors", "ids", "vectors", "labels")
    cand = pairs.mapInPandas(_nearest(k), "test_id long, train_id long, dist double, label double")
    w = Window.partitionBy("test_id").orderBy("dist", "train_id")
    top = cand.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= k)
    return top.groupBy(F.col("test_id").alias(id_col)).agg(F.avg("label").alias("pred"))


# ----------------------------------------------------------------- AdaBoost.R2

def adaboost_r2(train: DataFrame, n_estimators: int = 15, learning_rate: float = 1.0, max_depth: int = 3,
                features: str = "features", label: str = LABEL, seed: int = 42) -> tuple[list, list[float]]:
    """AdaBoost.R2 with linear loss; returns (trees, estimator weights).

    Each round fits a weighted tree (``weightCol``; the original draws a
    weighted bootstrap instead), takes the normalised absolute error, stops when
    the weighted mean loss reaches 0.5, and re-weights rows by
    beta ** ((1 - loss) * learning_rate).  The per-round statistics are two
    scalars; the weighted rows are checkpointed each round so the lineage does
    not grow with the rounds.
    """
    n = train.count()
    df = train.select(features, label).withColumn("_w", F.lit(1.0 / n)).checkpoint(eager=True)
    trees, alphas = [], []
    for m in range(n_estimators):
        tree = DecisionTreeRegressor(maxDepth=max_depth, weightCol="_w", featuresCol=features, labelCol=label,
                                     predictionCol="_p", seed=seed + m).fit(df)
        scored = tree.transform(df).withColumn("_e", F.abs(F.col(label) - F.col("_p")))
        e_max = scored.agg(F.max("_e")).first()[0]
        if not e_max:
            trees.append(tree)
            alphas.append(1.0)
            break
        loss = F.col("_e") / F.lit(e_max)
        avg_loss = scored.agg(F.sum(F.col("_w") * loss) / F.sum("_w")).first()[0]
        if avg_loss >= 0.5:
            if not trees:
                trees.append(tree)
                alphas.append(1.0)
            break
        beta = avg_loss / (1.0 - avg_loss)
        trees.append(tree)
        alphas.append(learning_rate * float(np.log(1.0 / beta)))
        new_w = F.col("_w") * F.pow(F.lit(beta), (1.0 - loss) * learning_rate)
        reweighted = scored.select(features, label, new_w.alias("_w"))
        total = reweighted.agg(F.sum("_w")).first()[0]
        df = reweighted.withColumn("_w", F.col("_w") / F.lit(total)).checkpoint(eager=True)
    return trees, alphas


def adaboost_predict(trees: list, alphas: list[float], df: DataFrame, name: str = "_pred_log") -> DataFrame:
    """M18 prediction: weighted median of the trees' predictions (first prediction whose weight CDF >= half)."""
    out = df
    for i, t in enumerate(trees):
        out = t.setPredictionCol(f"_ab{i}").transform(out)
    pairs = F.array(*[F.struct(F.col(f"_ab{i}").alias("p"), F.lit(a).alias("a")) for i, a in enumerate(alphas)])
    srt = F.array_sort(pairs)
    half = 0.5 * float(sum(alphas))
    cdf = F.transform(srt, lambda x, i: F.aggregate(F.slice(srt, 1, i + 1), F.lit(0.0), lambda acc, y: acc + y["a"]))
    idx = F.array_position(F.transform(cdf, lambda c: c >= half), True)
    return out.withColumn(name, F.element_at(srt, idx.cast("int"))["p"]).drop(*[f"_ab{i}" for i in range(len(trees))])
