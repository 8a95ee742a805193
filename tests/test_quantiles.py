"""Exact selection: brackets of any width, hot values, groups, NULL groups, empty input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.operators import quantiles as Q

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


@pytest.mark.parametrize("few,grid", [(1_000_000, 256), (50, 16), (0, 8)])
def test_against_numpy(spark, monkeypatch, few, grid):
    monkeypatch.setattr(Q, "FEW_ROWS", few)
    monkeypatch.setattr(Q, "GRID", grid)
    rng = np.random.default_rng(1)
    groups = {"normal": rng.normal(size=3000), "hot": np.concatenate([np.full(2500, 7.0), rng.normal(size=500)]), "two": np.repeat([1.0, 2.0], 400),
              "tail": np.exp(rng.normal(size=2000) * 40), "one": np.array([5.0]), None: rng.integers(0, 9, 700).astype(float)}
    rows = [(g, float(x)) for g, v in groups.items() for x in v] + [("none", None), ("hot", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    got = {r["g"]: r for r in Q.exact_quantiles(df, "x", PROBS, ["g"]).collect()}
    assert set(got) == set(groups)
    for g, v in groups.items():
        assert [got[g][f"q_{i}"] for i in range(len(PROBS))] == pytest.approx(np.quantile(v, PROBS).tolist(), rel=1e-12), g
    whole = Q.exact_quantiles(df.where("g = 'tail'"), "x", [0.5], prefix="p").collect()
    assert [r["p_0"] for r in whole] == pytest.approx([np.median(groups["tail"])])


def test_empty(spark):
    assert Q.exact_quantiles(spark.createDataFrame([(None,)], "x double"), "x", [0.5]).collect() == []


def test_values_below_a_bracket_are_one_row(spark, monkeypatch):
    """What is shuffled: the values in the bracket and one row of those below, not the column's distinct values."""
    sizes = []
    keep = Q.materialise

    def spy(df, name):
        out = keep(df, name)
        if name == "quantiles":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(Q, "materialise", spy)
    df = spark.range(100_000).select((F.col("id") * 7919 % 100_003).cast("double").alias("x"))
    v = np.arange(100_000) * 7919 % 100_003
    assert Q.exact_quantiles(df, "x", [0.5]).first()["q_0"] == float(np.median(v))
    assert sizes[0] < 3000


def test_box_stats_meet_few_groups_by_broadcast(spark):
    """Three columns must not put all their rows into three tasks: the fences are small and of known size."""
    from vitrine.operators import profile as P

    df = spark.range(20_000).selectExpr("CAST(id AS DOUBLE) AS a", "CAST(id % 7 AS DOUBLE) AS b", "CAST(NULL AS DOUBLE) AS c")
    got = P.box_stats(df, ["a", "b", "c"])
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    rows = {r.column_name: r for r in got.collect()}
    assert set(rows) == {"a", "b"} and rows["a"].median == 9999.5 and rows["b"].iqr == 4.0 and rows["a"].n_outliers == 0
