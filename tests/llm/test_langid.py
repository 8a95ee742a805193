import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vitrine.llm import langid, queries

SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_held_out_accuracy(spark, frame):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = queries.op2_language_id(spark, SF).join(docs.select("doc_id", "lang"), "doc_id")
    assert got.count() == docs.count()
    row = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("a"), F.min("score").alias("lo"),
                                    F.max("score").alias("hi")).first()
    assert row["a"] >= 0.97 and 0 <= row["lo"] and row["hi"] <= 1


def test_edge_cases(frame):
    train = [(i, "the cat and the dog of this house", "en") for i in range(30)] + [
        (100 + i, "der hund und die katze aus dem haus", "de") for i in range(30)] + [
        (200 + i, "le chien et la maison est dans la rue", "fr") for i in range(30)] + [(999, None, "en"), (998, "???", "de"), (997, "x", None)]
    model = langid.fit(frame(train, "doc_id long, text string, lang string"))
    assert model.families == {"germanic": ["de", "en"], "romance": ["fr"]}
    rows = [(1, "the dog and the house", "keep", 9.0), (1, "the dog and the house", "keep", 9.0), (2, None, None, None), (3, "", "c", 1.0),
            (4, "12 !!", None, 1.0), (None, "die katze und der hund", "c", None), (5, "le chien et la rue " * 200_000, "c", 2.0)]
    got = langid.predict(frame(rows, "doc_id long, text string, lang_pred string, score double"), model)
    assert got.columns == ["doc_id", "text", "lang_pred", "score"]
    found = {(r.doc_id, r.lang_pred) for r in got.collect()}
    assert found == {(1, "en"), (2, "und"), (3, "und"), (4, "und"), (None, "de"), (5, "fr")} and got.count() == 7
    assert langid.predict(frame([], "doc_id long, text string"), model).count() == 0


def test_nothing_to_learn(frame):
    model = langid.fit(frame([(1, "a", None)], "doc_id long, text string, lang string"))
    assert langid.predict(frame([(1, "abc")], "doc_id long, text string"), model).first()["lang_pred"] == "und"


def test_features_count_the_whole_text():
    block = next(langid.features(pa.array(["ab cd ab"])))
    assert block[0, :langid.BUCKETS].sum() == 3 and block[0, langid.BUCKETS:].sum() == 6


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="driver tables not present")
def test_pipeline_rejects_other_texts(spark, frame):
    import corpus_pipeline as P

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = ["qzxv wkjb pfqz xvvk zzqj " * 12, "U3BhcmsgaXMgYSBkaXN0cmlidXRlZA" * 20,
           "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
           "Все люди рождаются свободными и равными в своем достоинстве и правах.", "for (int i = 0; i < n; ++i) { x[i] = y[i] * z[j]; }"]
    extra = frame([(10**9 + i, t, None) for i, t in enumerate(odd)], "doc_id long, text string, lang string")
    kept = P.language_id(spark, docs.unionByName(extra, allowMissingColumns=True), sf)
    assert kept.where("doc_id >= 1000000000").count() == 0 and kept.count() >= 0.975 * docs.count()
