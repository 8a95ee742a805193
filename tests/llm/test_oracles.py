"""Operators whose rows SQL can express, against DuckDB on the driver's small tables; and the whole pipeline."""

import os

import pytest

from vitrine.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracle(spark, frame, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF).toPandas()
    want = con.sql(queries.ORACLE_SQL[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns

    def rows(df):
        return sorted(tuple("null" if v is None or v != v else str(v) for v in r) for r in df[columns].itertuples(index=False))

    assert rows(got) == rows(want)


def test_pipeline_stages(spark, frame):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in P.STAGES:
        docs = docs.sparkSession.createDataFrame(stage(spark, docs, SF).collect(), stage(spark, docs, SF).schema)
        seen[name] = docs
        if name != "best_fit_packing":
            assert docs.columns == columns
    assert seen["language_id"].count() >= 195
    ids = [r.doc_id for r in seen["ngram_jaccard_join"].select("doc_id").collect()]
    assert len(ids) == len(set(ids)) < seen["language_id"].count()
    assert seen["best_fit_packing"].where("offset + length > 2048").count() == 0


def test_pipeline_odd_rows(spark, frame):
    import corpus_pipeline as P

    schema = "doc_id long, text string, lang string, source string, n_chars long, extra string"
    base = spark.read.parquet(f"{SF}/documents.parquet").limit(40).collect()
    rows = [(*r, "x") for r in base] + [(9001, None, "en", None, None, None), (9002, "", None, "s", 0, None), (9003, "12 ??", None, "s", 5, None),
                                       (None, base[0].text + " more words", "en", "s", 1, None), (base[1].doc_id, base[1].text, "en", "s", 1, "y")]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in P.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), schema)
        assert 0 < docs.count() <= 60 and docs.columns[-1] == "extra"
    assert docs.where("doc_id IN (9001, 9002, 9003)").count() == 0
    assert P.STAGES[-1][1](spark, docs, SF).count() >= docs.count()
    empty = spark.createDataFrame([], schema)
    for name, stage in P.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_pipeline_keeps_columns_of_internal_names(spark, frame):
    """A table that owns the names which the stages use themselves; one id in a third of the rows."""
    import corpus_pipeline as P

    own = ["_lang", "_score", "_text", "_has_letter", "_tokens", "_posterior", "_copies", "_copy", "_doc", "_cut", "n_tokens", "posterior",
           "Start", "end", "g", "doc", "host", "component_id", "n_shingles", "sequence_id", "lang_pred", "score", "rate"]
    base = spark.read.parquet(f"{SF}/documents.parquet").limit(40).collect()
    rows = [(*r, *[f"{c}-{r.doc_id}" for c in own]) for r in base]
    rows += [rows[0]] * 20
    docs = spark.createDataFrame(rows, ", ".join(["doc_id long, text string, lang string, source string, n_chars long", *[f"`{c}` string" for c in own]]))
    columns = docs.columns
    for name, stage in P.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        assert docs.columns == columns and docs.count() > 0
        for r in docs.collect():
            assert all(r[c] == f"{c}-{r.doc_id}" for c in own), name
    assert P.STAGES[-1][1](spark, docs, SF).count() >= docs.count()


def test_samples_take_an_id_once(spark, frame):
    from pyspark.sql import functions as F

    from vitrine.llm import langid, mixing

    rows = [(7, "the same words again and again", "en")] * 400 + [(100 + i, f"other words number {i} here", "en") for i in range(30)]
    rows += [(500 + i, f"andere Wörter Nummer {i} hier", "de") for i in range(30)]
    docs = frame(rows, "doc_id long, text string, lang string")
    once = frame(rows[399:], "doc_id long, text string, lang string")
    a, b = langid.fit(docs, per_language=10**6), langid.fit(once, per_language=10**6)
    assert a.families == b.families and (a.weights == b.weights).all()
    labels = frame([(7, 1, 0)] * 500 + [(8, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    ids = mixing.sample_ids(labels, {"high": 500, "low": 1}, per_domain=10**6)
    assert sorted(tuple(r) for r in ids.collect()) == [(7, "high"), (8, "low")]
    known = docs.withColumn("domain", F.when(F.col("lang") == "de", "low").otherwise("high"))
    found = mixing.mix(docs, mixing.fit(known, {"high": 31, "low": 30}), {"high": 0.5, "low": 0.5})
    assert set(found.misfit) == {"high", "low"} and found.docs.count() == len(rows)
