"""Registered queries of the training-data operators: production parameters, whole tables, full results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm import bpe, hard_negatives, html_main, langid, licence, mixing, near_embed, ngram_join, packing, periodic, substring, token_counts, topk, toxicity
from vitrine.llm.scratch import Scratch

#: Weights of the domains in the mix: more good text, less of the rest.
MIX_TARGETS = {"high": 0.9, "low": 0.09, "toxic": 0.01}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id's text leaves 1 when divided by 3: such documents are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), bpe.default_path(), 2048)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.fit(docs.select("doc_id", "text", "lang").where(~held_out(F.col("doc_id"))))
    found = langid.predict(docs.select("doc_id", "text"), model, columns=["doc_id"])
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract(_table(spark, sf_dir, "pages"))


def fit_domains(spark: SparkSession, sf_dir: str, docs: DataFrame) -> mixing.Classifier:
    """Classifier learned from a bounded sample of the labels table and the texts of its documents."""
    labels = _table(spark, sf_dir, "labels")
    counts = mixing.shares(labels)
    ids = Scratch(spark, "labelled").sent(mixing.sample_ids(labels, counts), "ids")
    sample = docs.select("doc_id", "text").join(ids, "doc_id")
    return mixing.fit(sample, counts)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = mixing.mix(docs, fit_domains(spark, sf_dir, docs), MIX_TARGETS)
    chances = [F.round(F.col("posterior")[i], 6).alias(f"p_{d}") for i, d in enumerate(found.domains)]
    return found.docs.select("doc_id", "n_tokens", *chances, F.round("rate", 6).alias("rate"),
                             mixing.copies(F.col("rate"), F.col("doc_id")).alias("copies"))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_embed.near_duplicates(_table(spark, sf_dir, "embeddings"), 0.95).rows


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated_passages(_table(spark, sf_dir, "documents"))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_groups(_table(spark, sf_dir, "documents"), 3, 90, 100)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence.scan(_table(spark, sf_dir, "documents"))


def sample_edits(doc_id: Column, text: Column) -> Column:
    """Two edits per document at places that follow from its id: one replaces, one inserts."""
    size = F.char_length(F.coalesce(text, F.lit(""))) + 1
    place = lambda salt: F.pmod(F.xxhash64(doc_id, F.lit(salt)), size).cast("int")
    return F.array(F.struct(place("a").alias("start"), F.lit(12).alias("delete"), F.concat(F.lit(" edit "), doc_id.cast("string")).alias("insert")),
                   F.struct(place("b").alias("start"), F.lit(0).alias("delete"), F.lit(" inserted words, and more").alias("insert")))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = bpe.default_path()
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.with_trees(docs, path).withColumn("n_tokens_before", F.col("n_tokens"))
    counted = counted.withColumn("edits", F.coalesce(sample_edits(F.col("doc_id"), F.col("text")), F.array().cast(token_counts.EDIT_DDL)))
    after = token_counts.apply_edits(counted, path, columns=["doc_id", "n_tokens_before"])
    return after.select("doc_id", "n_tokens_before", F.col("n_tokens").alias("n_tokens_after"), F.size("leaf_tokens").alias("n_segments"),
                        F.aggregate("leaf_chars", F.lit(0).cast("long"), lambda a, c: a + c).alias("n_chars_after"), "encoded_chars")


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    rest = lambda i: F.crc32(i.cast("string").cast("binary")) % 5
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels").where(rest(F.col("doc_id")) != 0))
    found = toxicity.score(docs, model, columns=["doc_id"])
    return found.select("doc_id", F.coalesce(rest(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def with_repetitions(doc_id: Column, text: Column) -> Column:
    """The text, for a tenth of the ids with its words from some place on replaced by repetitions of the first of them."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    own = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n = F.size(own)
    a = (g % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    again = F.slice(F.flatten(F.array_repeat(F.slice(own, a + 1, p), F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    return F.when((h % 10 == 0) & (n > 0), F.array_join(F.concat(F.slice(own, F.lit(1), a), again), " ")).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = periodic.periodic_runs(docs.select("doc_id", with_repetitions(F.col("doc_id"), F.col("text")).alias("text")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    found = found.select("doc_id", "runs", "collapsed", best.alias("best"), listed.alias("listed"))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.p")).alias("period"), F.floor(1000 * F.col("best.length") / -F.col("best.p")).alias("exponent_milli"),
        F.sha2(F.col("listed").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors.withColumn("label", label), F.col("vec_id") % 100 == 0)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_best_fit_packing, op2_language_id, op3_exact_top_k, op4_html_extraction, op5_mixing, op6_embedding_near_dedup,
        op7_substring_dedup, op8_ngram_jaccard_join, op9_license_scan, op10_token_counts, op11_toxicity,
        op12_periodic_runs, op13_hard_negatives, pipeline)}

TOP_K_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""

NEGATIVES_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
    CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0),
positives AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
negatives AS (SELECT p.anchor_id, p.positive_id, s.other AS negative_id, p.positive_score, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other) AS INTEGER) AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 100 * s.score BETWEEN 30 * p.positive_score AND 90 * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 10"""

NEAR_EMBED_SQL = """
WITH RECURSIVE u AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
n AS (SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS r FROM u),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE a.r > 0 AND b.r > 0 AND list_sum(list_transform(list_zip(a.e, b.e), lambda z: z[1] * z[2])) / (a.r * b.r) >= 0.95),
reach AS (SELECT vec_id, vec_id AS c FROM embeddings UNION SELECT l.a, reach.c FROM reach JOIN links l ON l.b = reach.vec_id),
least AS (SELECT vec_id, min(c) AS component_id FROM reach GROUP BY vec_id),
counted AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n_links, 0) AS n_links, l.component_id, e.vec_id = l.component_id AS kept
FROM embeddings e JOIN least l ON l.vec_id = e.vec_id LEFT JOIN counted c ON c.vec_id = e.vec_id"""

JACCARD_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS t FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(t) = 0 THEN [] WHEN len(t) < 3 THEN [array_to_string(t, ' ')]
    ELSE list_transform(range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2]) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
half AS (SELECT c.a, c.b FROM common c JOIN n x ON x.doc_id = c.a JOIN n y ON y.doc_id = c.b WHERE 100 * c.k >= 90 * (x.n + y.n - c.k)),
links AS (SELECT a, b FROM half UNION ALL SELECT b, a FROM half),
reach AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT l.a, reach.c FROM reach JOIN links l ON l.b = reach.doc_id),
least AS (SELECT doc_id, min(c) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, l.component_id
FROM documents d JOIN least l ON l.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id"""

ORACLE_SQL: dict[str, str] = {
    "op3_exact_top_k": TOP_K_SQL,
    "op6_embedding_near_dedup": NEAR_EMBED_SQL,
    "op8_ngram_jaccard_join": JACCARD_SQL,
    "op9_license_scan": licence.scan_sql(),
    "op13_hard_negatives": NEGATIVES_SQL,
}
