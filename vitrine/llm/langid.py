"""Language identification by hierarchical discrimination.

A text's features are hashed counts of its words and of its byte trigrams (the whole lower-cased text), square-rooted
and scaled to length one.  First linear SVMs predict the language family (one against the rest); then one-against-one
linear SVMs separate the languages within that family by votes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from vitrine.llm import linear, words
from vitrine.llm.scratch import free_names

#: Buckets of hashed trigrams and of hashed words.
BUCKETS = 4096
#: Labelled texts per language that the models are fitted on (a bounded sample by hash order of the text).
FIT_PER_LANGUAGE = 400

#: Families of ISO 639-1 codes. A code not named here is a family of its own.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "is", "nl", "no", "sv"],
    "romance": ["ca", "es", "fr", "gl", "it", "pt", "ro"],
    "slavic": ["be", "bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "uralic": ["et", "fi", "hu"],
    "turkic": ["az", "kk", "tr", "uz"],
    "indo-aryan": ["bn", "gu", "hi", "mr", "ne", "pa", "ur"],
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}


def features(column: pa.Array) -> Iterator[np.ndarray]:
    """Count matrices (texts x 2 * BUCKETS, float32) for runs of whole texts."""
    lowered = pc.utf8_lower(column.cast(pa.large_string()).fill_null(""))
    for _, _, data, offsets in words.chunks(lowered, 1 << 20, 512):
        n = len(offsets) - 1
        hashes, _, _, word_offsets = words.words(data, offsets)
        doc = np.repeat(np.arange(n), np.diff(word_offsets))
        slot = doc * BUCKETS + (hashes >> words.U64(52)).astype(np.int64)
        by_word = np.bincount(slot, minlength=n * BUCKETS).reshape(n, BUCKETS)
        wide = data.astype(np.uint32)
        tri = ((wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:]) * np.uint32(2654435761)) >> np.uint32(20)
        doc = np.repeat(np.arange(n), np.diff(offsets))
        inside = doc[:-2] == doc[2:] if len(doc) > 2 else np.zeros(0, dtype=bool)
        slot = doc[:len(inside)][inside] * BUCKETS + tri[:len(inside)][inside].astype(np.int64)
        by_tri = np.bincount(slot, minlength=n * BUCKETS).reshape(n, BUCKETS)
        yield np.concatenate([by_word, by_tri], axis=1).astype(np.float32)


def normalised(counts: np.ndarray) -> np.ndarray:
    x = np.sqrt(counts)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


@dataclass
class Model:
    """families: name -> languages; weights: one column per family, then one per pair of languages of a family."""

    families: dict[str, list[str]]
    pairs: list[tuple[str, str]]
    weights: np.ndarray
    slopes: np.ndarray

    def predict(self, counts: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Languages and scores: chance of the family's margin times the chance of the weakest vote won."""
        margins = normalised(counts) @ self.weights
        chance = 1 / (1 + np.exp(-np.clip(margins * self.slopes, -60, 60)))
        names = list(self.families)
        at = {pair: len(names) + i for i, pair in enumerate(self.pairs)}
        family = margins[:, :len(names)].argmax(axis=1)
        total = chance[:, :len(names)].sum(axis=1)
        score = chance[np.arange(len(family)), family] / np.maximum(total, 1e-9)
        langs = np.empty(len(family), dtype=object)
        for f, name in enumerate(names):
            rows = np.flatnonzero(family == f)
            members = self.families[name]
            votes = np.zeros((len(rows), len(members)))
            least = np.ones((len(rows), len(members)))
            for (i, a), (j, b) in combinations(enumerate(members), 2):
                p = chance[rows, at[a, b]]
                votes[:, i] += p >= 0.5
                votes[:, j] += p < 0.5
                least[:, i] = np.minimum(least[:, i], p)
                least[:, j] = np.minimum(least[:, j], 1 - p)
            best = (votes + 0.5 * least).argmax(axis=1)
            langs[rows] = np.array(members, dtype=object)[best]
            score[rows] *= least[np.arange(len(rows)), best]
        return langs.tolist(), score


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, sparse count vector as bytes) of labelled texts."""
    for batch in batches:
        rows = []
        for block in features(batch.column(1)):
            for row in block:
                at = np.flatnonzero(row)
                rows.append(at.astype("<u2").tobytes() + row[at].astype("<f4").tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], names=["lang", "x"])


def fit(labelled: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text",
        per_language: int = FIT_PER_LANGUAGE) -> Model:
    """Fit on about ``per_language`` texts of each language, those with the least hashes of their ids.

    The share of each language that is read follows from its count, so the sample is bounded whatever the input; rows
    that repeat an id (or have none) count once per language.
    Rows without a language, or whose text is null or has no letter, are not learned from.
    """
    rows = labelled.where(F.col(lang_col).isNotNull())
    counts = {r[lang_col]: r["count"] for r in rows.groupBy(lang_col).count().collect()}
    place = F.pmod(F.xxhash64(id_col, F.lit("fit")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    keep = F.lit(False)
    for lang, n in sorted(counts.items()):
        keep = keep | ((F.col(lang_col) == lang) & (place < 1.1 * per_language / n))
    sample = rows.where(keep & F.col(text_col).rlike(r"\p{L}"))
    # of rows that repeat an id one is learned from, so an id that many rows share brings no more than others
    sample = sample.groupBy(F.col(id_col), F.col(lang_col).alias("lang")).agg(F.min(text_col).alias("text")).select("lang", "text")
    got = sample.mapInArrow(_packed, "lang string, x binary").collect()
    if not got:
        return Model({}, [], np.zeros((2 * BUCKETS, 0), np.float32), np.zeros(0))
    got.sort(key=lambda r: (r["lang"], bytes(r["x"])))
    counts = np.zeros((len(got), 2 * BUCKETS), dtype=np.float32)
    for i, r in enumerate(got):
        raw = bytes(r["x"])
        n = len(raw) // 6
        counts[i, np.frombuffer(raw[:2 * n], "<u2")] = np.frombuffer(raw[2 * n:], "<f4")
    x, langs = normalised(counts), np.array([r["lang"] for r in got])
    families: dict[str, list[str]] = {}
    for lang in sorted(set(langs)):
        families.setdefault(_FAMILY_OF.get(lang, lang), []).append(lang)
    family = np.array([_FAMILY_OF.get(lang, lang) for lang in langs])
    pairs = [p for members in families.values() for p in combinations(members, 2)]
    tasks = [(np.ones(len(x), bool), family == name) for name in families] if len(families) > 1 else [(np.ones(len(x), bool), np.ones(len(x), bool))]
    tasks += [((langs == a) | (langs == b), langs == a) for a, b in pairs]
    weights, slopes = [], []
    for rows_in, positive in tasks:
        y = np.where(positive[rows_in], 1.0, -1.0)
        w = linear.fit_svm(x[rows_in], y)
        weights.append(w)
        slopes.append(linear.fit_sigmoid(x[rows_in] @ w, y))
    return Model(families, pairs, np.stack(weights, axis=1).astype(np.float32), np.array(slopes))


def predict(docs: DataFrame, model: Model, text_col: str = "text", lang_out: str = "lang_pred", score_out: str = "score",
            columns: list[str] | None = None) -> DataFrame:
    """``docs`` (or only its ``columns``) with the predicted language of the whole text and a score from 0 to 1.

    ``und`` with score 0 where the text is null or holds no letter, or the model knows no language.  Columns of
    ``docs`` named like the two outputs are replaced; all others stay, also with their nulls and repeated rows.
    """
    kept = [f for f in docs.schema.fields if f.name not in (lang_out, score_out) and (columns is None or f.name in columns)]
    names = [f.name for f in kept]
    text = F.col(f"`{text_col}`").cast("string")
    whole, has_letter = free_names(names, "_text", "_has_letter")
    source = docs.select(*[F.col(f"`{n}`") for n in names], text.alias(whole), text.rlike(r"\p{L}").alias(has_letter))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            langs: list[str] = []
            scores: list[np.ndarray] = []
            if m.families:
                for block in features(batch.column(len(names))):
                    got, score = m.predict(block)
                    langs += got
                    scores.append(score)
            has = batch.column(len(names) + 1).to_pylist()
            score = np.concatenate(scores) if scores else np.zeros(len(has))
            langs = [lang if ok else "und" for lang, ok in zip(langs, has)] if m.families else ["und"] * len(has)
            score = [float(s) if lang != "und" else 0.0 for s, lang in zip(score, langs)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(names)], pa.array(langs, pa.string()), pa.array(score, pa.float64())],
                                             names=[*names, lang_out, score_out])

    schema = StructType([*kept, StructField(lang_out, StringType()), StructField(score_out, DoubleType())])
    return source.mapInArrow(run, schema)


def accepted(score_col: str = "score", lang_col: str = "lang_pred", least: float = 0.5) -> Column:
    """Filter condition for documents of a known language; ``least`` only applies to scores of real predictions."""
    return (F.col(lang_col) != "und") & (F.col(score_col) >= least)
