"""Parzen search: proposals, better than random on a seeded surface, parameters that reach the learner; atomic registry."""

import math
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from vitrine.constants import SEARCH_SPACES
from vitrine.ml import models as M
from vitrine.ml import search as S
from vitrine.ml.registry import Registry

SPACE = {"a": (0.001, 10.0, "log"), "b": (1, 30, "int"), "c": (0.0, 1.0, "float")}


def surface(p):
    return (math.log10(p["a"]) - 0.4) ** 2 + ((p["b"] - 23) / 10) ** 2 + 4 * (p["c"] - 0.2) ** 2


def test_units_round_trip(spark):
    for lo, hi, kind, values in ((0.01, 100.0, "log", [0.01, 1.0, 100.0]), (2, 15, "int", [2, 7, 15]), (0.5, 1.0, "float", [0.5, 0.75, 1.0])):
        df = spark.createDataFrame([(float(v),) for v in values], "v double")
        rows = df.select("v", S.from_unit(S.to_unit(F.col("v"), lo, hi, kind), lo, hi, kind).alias("w")).collect()
        assert all(r.w == pytest.approx(r.v) for r in rows)
    ends = spark.range(2).select(S.from_unit(F.col("id").cast("double"), 2, 15, "int").alias("w")).collect()
    assert [r.w for r in ends] == [2.0, 15.0]


def test_beats_random_draws(spark):
    gains = []
    for seed in (1, 2, 3, 4):
        found = S.search(spark, SPACE, lambda ps: [surface(p) for p in ps], 32, parallel=4, seed=seed)
        drawn = S.random_trials(spark, SPACE, 32, seed).collect()
        assert found.count() == 32 and found.where("a < 0.001 OR a > 10 OR b < 1 OR b > 30 OR b != floor(b) OR c < 0 OR c > 1").count() == 0
        gains.append((found.agg(F.min("score")).first()[0], min(surface(r.asDict()) for r in drawn)))
    assert sum(a < b for a, b in gains) >= 3 and sum(a for a, _ in gains) < 0.6 * sum(b for _, b in gains), gains


def test_proposals_are_repeatable_and_apart(spark):
    trials = spark.createDataFrame([(s, t, surface({"a": 0.01 * (t + 1), "b": t + 1, "c": t / 20}), 0.01 * (t + 1), float(t + 1), t / 20)
                                    for s in ("x", "y") for t in range(20)], "study string, trial int, score double, a double, b double, c double")
    one = sorted(map(tuple, S.propose(trials, SPACE, 3).collect()))
    two = sorted(map(tuple, S.propose(trials.repartition(7), SPACE, 3).collect()))
    assert one == two and len(one) == 6 and len({r[2:] for r in one}) == 6
    # studies without a score and null parameters are left out, not fatal
    odd = trials.limit(1).selectExpr("'z' AS study", "trial", "CAST(NULL AS DOUBLE) AS score", "a", "b", "c")
    assert S.propose(trials.unionByName(odd), SPACE, 1).where("study = 'z'").count() == 0


def test_every_sampled_parameter_reaches_the_learner():
    for model, space in SEARCH_SPACES.items():
        for name, (lo, hi, kind) in space.items():
            ends = []
            for value in (lo, hi):
                est = M.make_estimator(model, {name: value}, (100, 2.0))
                ends.append({p.name: v for p, v in est.extractParamMap().items() if not p.name.endswith("Col")})
            assert ends[0] != ends[1], (model, name)


def test_two_registrations_at_once(spark, tmp_path):
    registry = Registry(spark, str(tmp_path / "registry"))

    def one(i):
        return registry.register("m", PipelineModel([SQLTransformer(statement=f"SELECT *, {i} AS pred FROM __THIS__")]), str(tmp_path / "models"))

    with ThreadPoolExecutor(4) as pool:
        versions = [v for v, _ in pool.map(one, range(4))]
    assert sorted(versions) == [1, 2, 3, 4]
    table = registry.versions("m").collect()
    assert sorted(r.version for r in table) == [1, 2, 3, 4] and sum(r.is_champion for r in table) == 1
    model, info = registry.load("m")
    named = next(r.version for r in table if r.is_champion)
    assert info == f"m (v{named})" and model.transform(spark.range(1)).first().pred == versions.index(named)
    with pytest.raises(ValueError):
        registry.load("other")


def test_claimed_but_unfinished_version_is_skipped(spark, tmp_path):
    registry = Registry(spark, str(tmp_path / "r"))
    assert registry.claim("m") == 1
    version, _ = registry.register("m", PipelineModel([]), str(tmp_path / "models"))
    assert version == 2 and registry.lookup("m")[0] == 2 and registry.versions("m").count() == 1
