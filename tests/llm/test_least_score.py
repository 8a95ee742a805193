import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from vitrine.llm import langid, queries


def test_threshold_uses_every_held_out_document(spark, frame, monkeypatch):
    """The score of each held-out document counts, however many there are; an id that rows repeat counts once."""
    seen = []

    def scored(docs, model, lang_out, score_out, columns=None):
        seen.append(docs)
        return docs.withColumn(lang_out, F.when(F.col("text") == "wrong", "de").otherwise(F.col("lang"))).withColumn(
            score_out, F.length("text") / F.lit(20000.0))

    monkeypatch.setattr(langid, "predict", scored)
    ids = spark.range(13_000).select(F.col("id").alias("doc_id"), F.expr("repeat('x', cast(id AS int))").alias("text"), F.lit("en").alias("lang"))
    odd = frame([(4, "y", "en"), (4, "y", "en"), (None, "z", "en"), (5, "z", None), (2, "wrong", "en")], "doc_id long, text string, lang string")
    docs = ids.where("doc_id > 10").unionByName(odd)
    model = langid.Model({"germanic": ["de", "en"]}, [("de", "en")], np.zeros((0, 2)), np.zeros(2))
    got = corpus_pipeline.least_score(docs, model)
    held = sorted({(r.doc_id, r.text) for r in docs.where(queries.held_out(F.col("doc_id")) & F.col("lang").isNotNull()).collect() if r.text != "wrong"})
    assert len(held) > 4000 and seen[0].count() - len(held) in (0, 1)
    want = np.quantile([len(t) / 20000 for _, t in held], corpus_pipeline.LOW_QUANTILE)
    assert got == pytest.approx((0.5 + want) / 2, abs=1e-12)
    assert corpus_pipeline.least_score(docs.limit(0), model) == 0.5
