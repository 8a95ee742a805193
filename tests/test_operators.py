"""Operator invariants: exactness, order, skew and partitioning independence."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from vitrine.functions.geometry import ppi  # noqa: F401
from vitrine.ml.models import knn_predict
from vitrine.ml.prepare import contiguous_folds, global_rank, hash_split
from vitrine.operators.categories import group_rare
from vitrine.operators.dedup import flag_duplicates, keep_last
from vitrine.operators.html import fold_repeated
from vitrine.operators.quantiles import exact_quantiles
from vitrine.plans.etl import group_rare_columns


def test_exact_quantiles_match_numpy_with_hot_value(spark):
    rng = np.random.default_rng(1)
    vals = np.concatenate([rng.normal(size=2000).round(3), np.full(1000, 0.5)])  # a third of rows share one value
    grp = rng.integers(0, 3, size=len(vals))
    df = spark.createDataFrame(pd.DataFrame({"g": grp.astype(int), "v": vals}))
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = exact_quantiles(df, "v", probs).first()
    assert np.allclose([got[f"q_{i}"] for i in range(len(probs))], np.quantile(vals, probs))
    by = {r["g"]: r for r in exact_quantiles(df, "v", probs, by=["g"]).collect()}
    for g in range(3):
        assert np.allclose([by[g][f"q_{i}"] for i in range(len(probs))], np.quantile(vals[grp == g], probs))


def test_contiguous_folds_sizes(spark):
    df = spark.range(8).withColumnRenamed("id", "k")
    sizes = [r["count"] for r in contiguous_folds(df, ["k"], 3).groupBy("fold").count().orderBy("fold").collect()]
    assert sizes == [3, 3, 2]


def test_global_rank_is_sorted_position(spark):
    df = spark.createDataFrame([(int(x),) for x in np.random.default_rng(3).permutation(500) * 7], "k LONG")
    got = global_rank(df, ["k"]).orderBy("k").select("_rank").collect()
    assert [r[0] for r in got] == list(range(500))


def test_hash_split_is_partition_invariant(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = {r["k"]: r["split"] for r in hash_split(df.repartition(7), ["k"]).collect()}
    b = {r["k"]: r["split"] for r in hash_split(df.coalesce(1), ["k"]).collect()}
    assert a == b and 700 < sum(v == "train" for v in a.values()) < 900


def test_keep_last_second_source_wins_and_null_keys_collapse(spark):
    rows = [("t1", "10 tl", 0, 1, "ty"), ("t1", "10 tl", 1, 5, "hb"), (None, "5 tl", 0, 2, "a"), (None, "5 tl", 1, 3, "b"),
            ("t2", "7 tl", 0, 9, "x")]
    df = spark.createDataFrame(rows, "title STRING, price STRING, _src_rank INT, _seq LONG, who STRING")
    for d in (df, df.repartition(5)):
        got = {(r["title"], r["price"]): r["who"] for r in keep_last(d, ["title", "price"], ["_src_rank", "_seq"]).collect()}
        assert got == {("t1", "10 tl"): "hb", (None, "5 tl"): "b", ("t2", "7 tl"): "x"}


def test_flag_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None), (5, None)], "id INT, t STRING")
    got = {r["id"]: r["is_dup"] for r in flag_duplicates(df, ["t"]).collect()}
    assert got == {1: True, 2: True, 3: False, 4: True, 5: True}


def test_rare_grouping(spark):
    rows = [("a",)] * 5 + [("b",)] * 4 + [(None,)]
    df = spark.createDataFrame(rows, "c STRING")
    got = sorted((r["c"] or "NULL") for r in group_rare(df, "c", 5).collect())
    assert got == ["NULL"] + ["Other"] * 4 + ["a"] * 5
    two = spark.createDataFrame([(b, o) for b, o in zip("aaaaabbbbc", "xxyyyyyyzz")], "b STRING, o STRING")
    both = group_rare_columns(two, {"b": 5, "o": 3}).collect()
    seq = group_rare(group_rare(two, "b", 5), "o", 3).collect()
    assert sorted(map(tuple, both)) == sorted(map(tuple, seq))


def test_fold_repeated(spark):
    df = spark.createDataFrame([(["A", "A"],), (["A", "B"],), (["A", "B", "A"],), (["", "B"],)], "v ARRAY<STRING>")
    assert [r[0] for r in df.select(fold_repeated(F.col("v"))).collect()] == ["A", "A; B", "A; B; A", "B"]


def test_knn_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    tr = rng.normal(size=(300, 8))
    te = rng.normal(size=(40, 8))
    lab = rng.integers(0, 10, 300).astype(float)
    train = spark.createDataFrame([(i, tr[i].tolist(), float(lab[i])) for i in range(300)], "id LONG, vec ARRAY<DOUBLE>, label DOUBLE")
    test = spark.createDataFrame([(1000 + i, te[i].tolist(), 0.0) for i in range(40)], "id LONG, vec ARRAY<DOUBLE>, label DOUBLE")
    got = {r["id"]: r["pred"] for r in knn_predict(train.repartition(4), test, k=3, block=7).collect()}
    for i in range(40):
        d = np.sqrt(((tr - te[i]) ** 2).sum(1))
        idx = np.lexsort((np.arange(300), d))[:3]
        assert abs(got[1000 + i] - lab[idx].mean()) < 1e-9


def test_adaboost_weighted_median(spark):
    from pyspark.ml.feature import VectorAssembler

    from vitrine.ml.models import adaboost_predict, adaboost_r2

    rng = np.random.default_rng(2)
    x = rng.uniform(0, 10, 300)
    y = np.sin(x) + 0.1 * rng.normal(size=300)
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(
        spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x DOUBLE, _y_log DOUBLE"))
    trees, alphas = adaboost_r2(df, n_estimators=5)
    assert 1 <= len(trees) <= 5 and all(a > 0 for a in alphas)
    out = adaboost_predict(trees, alphas, df).select("x", "_pred_log").collect()
    # the weighted median is one of the trees' predictions
    singles = [{r["x"]: r["_p"] for r in t.setPredictionCol("_p").transform(df).collect()} for t in trees]
    for r in out[:20]:
        assert any(abs(s[r["x"]] - r["_pred_log"]) < 1e-12 for s in singles)
    mse = np.mean([(r["_pred_log"] - np.sin(r["x"])) ** 2 for r in out])
    assert mse < 0.3
