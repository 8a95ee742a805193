import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.llm import mixing as M
from vitrine.llm import queries

SF = "/root/testdata/sf0.01"


def brute(tokens, p, wanted, hold, steps=20_000):
    """Plain projected gradient on the whole problem in numpy."""
    total = tokens.sum()
    second = (tokens[:, None, None] * p[:, :, None] * p[:, None, :]).sum(0) / total
    metric = np.linalg.inv(second + 1e-6 * np.eye(p.shape[1]))
    r = np.ones(len(tokens))
    for _ in range(steps):
        miss = (tokens * r) @ p / total - wanted
        r = np.maximum(0, r - 0.5 / (1 + hold) * (p @ (metric @ miss) + hold * (r - 1)))
    return r


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_targets_are_met(spark, frame):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = M.mix(docs, queries.fit_domains(spark, SF, docs), queries.MIX_TARGETS)
    rows = found.docs.collect()
    assert len(rows) == docs.count()
    t, p, r = np.array([x.n_tokens for x in rows], float), np.array([x.posterior for x in rows]), np.array([x.rate for x in rows])
    got = (t * r) @ p / t.sum()
    assert (r >= 0).all() and np.abs(got - [queries.MIX_TARGETS[d] for d in found.domains]).max() < 2e-3
    want = brute(t, p, np.array([queries.MIX_TARGETS[d] for d in found.domains]), 1e-3)
    assert np.abs(r - want).max() < 0.05


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="driver tables not present")
def test_classifier_on_held_out_labels(spark, frame):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    sampled = M.sample_ids(labels, M.shares(labels)).select("doc_id")
    held = M.domains_of(labels).join(sampled, "doc_id", "left_anti").join(docs.select("doc_id", "text"), "doc_id")
    c = queries.fit_domains(spark, sf, docs)
    best = F.array_position("posterior", F.array_max("posterior")) - 1
    got = M.posteriors(held, c).select("domain", F.element_at(F.array(*[F.lit(d) for d in c.domains]), (best + 1).cast("int")).alias("d"))
    assert got.agg(F.avg((F.col("d") == F.col("domain")).cast("int"))).first()[0] >= 0.9


def test_edge_cases(frame):
    rows = [(1, "good text here " * 5, "c"), (1, "good text here " * 5, "c"), (2, None, None), (3, "", "c"), (None, "BAD!! TEXT!!", None), (4, "BAD!! " * 300_000, "c")]
    docs = frame(rows, "doc_id long, text string, rate string")
    train = frame([(i, "good text of words", "high") for i in range(20)] + [(50 + i, "BAD!! WORDS!!", "low") for i in range(20)], "doc_id long, text string, domain string")
    c = M.fit(train, {"high": 20, "low": 20})
    got = M.mix(docs, c, {"high": 0.5, "low": 0.5})
    assert got.docs.columns == ["doc_id", "n_tokens", "posterior", "rate"] and got.docs.count() == 6
    assert {r.doc_id: r.n_tokens for r in got.docs.collect()}[2] == 0
    assert M.mix(frame([], "doc_id long, text string"), c, {"high": 1.0}).docs.count() == 0
    one = M.fit(train.where("domain = 'high'"), {"high": 20})
    assert {r.rate for r in M.mix(docs, one, {"high": 1.0}).docs.collect()} == {1.0}
    with pytest.raises(ValueError):
        M.mix(docs, c, {"other": 1.0})


def test_labels_with_nulls(frame):
    labels = frame([(1, 1, 0), (2, None, 1), (3, 0, None), (4, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert {(r.doc_id, r.domain) for r in M.domains_of(labels).collect()} == {(1, "high"), (2, "toxic"), (3, "low")}


def test_copies_have_the_rate_as_mean(spark, frame):
    got = spark.range(20_000).select(M.copies(F.lit(1.3), F.col("id")).alias("c")).agg(F.avg("c")).first()[0]
    assert abs(got - 1.3) < 0.02
