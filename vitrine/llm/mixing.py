"""Mixing to target weights with soft membership.

A classifier learned from the labelled table gives every document posteriors over domains.  Distributed
projected-gradient least squares then finds one nonnegative rate (expected number of copies) per document, close to
1, such that the expected tokens of each domain meet the target weights.  Only sums over domains (a few numbers) reach
the driver; a document's rate is replayed from them inside one SQL expression, so no iteration rewrites the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from vitrine.llm import linear, words
from vitrine.llm.scratch import Scratch, free_names

#: Buckets of hashed words.
BUCKETS = 8192
#: Numbers on a text's style that follow the word buckets.
STYLE = 7
#: Labelled texts per domain that the classifier is fitted on (a bounded sample by hash of the id).
FIT_PER_DOMAIN = 800

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[33:127] = True
_MARK[65:91] = _MARK[97:123] = _MARK[48:58] = False


def features(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(features, words per text) for runs of whole texts."""
    for _, _, data, offsets in words.chunks(column, 1 << 20, 512):
        n = len(offsets) - 1
        hashes, _, _, at = words.words(data, offsets)
        counts = np.diff(at)
        doc = np.repeat(np.arange(n), counts)
        slots = doc * BUCKETS + (hashes >> words.U64(51)).astype(np.int64)
        by_word = np.log1p(np.bincount(slots, minlength=n * BUCKETS).reshape(n, BUCKETS).astype(np.float32))
        by_word /= np.maximum(np.linalg.norm(by_word, axis=1, keepdims=True), 1e-6)
        # distinct words: first of each run after sorting within the text
        order = np.lexsort((hashes, doc))
        fresh = np.ones(len(order), dtype=bool)
        if len(order) > 1:
            fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (doc[order][1:] != doc[order][:-1])
        distinct = np.bincount(doc[order][fresh], minlength=n)
        size = np.maximum(np.diff(offsets), 1)
        share = [np.add.reduceat(np.append(flag[data], 0).astype(np.int64), offsets[:-1].clip(max=len(data))) * (np.diff(offsets) > 0) / size
                 for flag in (_UPPER, _DIGIT, _MARK, _SPACE)]
        style = np.stack([*share, distinct / np.maximum(counts, 1), np.log1p(counts) / 8, np.ones(n)], axis=1)
        yield np.concatenate([3 * by_word, style.astype(np.float32)], axis=1), counts


@dataclass
class Classifier:
    domains: list[str]
    weights: np.ndarray


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for block, _ in features(batch.column(1)):
            for row in block:
                at = np.flatnonzero(row)
                rows.append(at.astype("<u2").tobytes() + row[at].astype("<f4").tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], names=["domain", "x"])


def shares(labels: DataFrame) -> dict[str, int]:
    """Labelled rows per domain."""
    return {r["domain"]: r["count"] for r in domains_of(labels).groupBy("domain").count().collect()}


def domains_of(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, domain) of a table with the columns quality and toxic; rows without an id or a label fall away."""
    rows = labels.select(F.col(id_col).alias("doc_id"), label_domain(F.col("quality"), F.col("toxic")).alias("domain"))
    return rows.where(F.col("doc_id").isNotNull() & F.col("domain").isNotNull())


def sample_ids(labels: DataFrame, counts: dict[str, int], per_domain: int = FIT_PER_DOMAIN) -> DataFrame:
    """About ``per_domain`` labelled ids of each domain, those with the least hashes: a table of bounded size
    with one row per id and domain, however often ``labels`` repeats them."""
    place = F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    keep = F.lit(False)
    for domain, n in sorted(counts.items()):
        keep = keep | ((F.col("domain") == domain) & (place < 1.1 * per_domain / n))
    return domains_of(labels).where(keep).distinct()


def fit(labelled: DataFrame, counts: dict[str, int], text_col: str = "text") -> Classifier:
    """Fit softmax regression on a bounded sample of labelled texts (columns domain and text), see ``sample_ids``."""
    rows = labelled.select("domain", *(["doc_id"] if "doc_id" in labelled.columns else []), F.col(text_col).cast("string").alias("text"))
    if "doc_id" in rows.columns:
        # an id that many rows share is learned once
        rows = rows.groupBy("doc_id", "domain").agg(F.min("text").alias("text"))
    got = rows.select("domain", "text").mapInArrow(_packed, "domain string, x binary").collect()
    domains = sorted({r["domain"] for r in got})
    if len(domains) < 2:
        return Classifier(domains, np.zeros((BUCKETS + STYLE, len(domains))))
    got.sort(key=lambda r: (r["domain"], bytes(r["x"])))
    x = np.zeros((len(got), BUCKETS + STYLE), dtype=np.float32)
    for i, r in enumerate(got):
        raw = bytes(r["x"])
        n = len(raw) // 6
        x[i, np.frombuffer(raw[:2 * n], "<u2")] = np.frombuffer(raw[2 * n:], "<f4")
    y = np.array([domains.index(r["domain"]) for r in got])
    weights = linear.fit_softmax(x, y, len(domains))
    # the sample holds the domains in other shares than the labelled table: shift the intercepts back
    prior = np.log(np.array([counts[d] for d in domains], dtype=float) / np.bincount(y, minlength=len(domains)))
    weights[-1] += (prior - prior.mean()).astype(np.float32)
    return Classifier(domains, weights)


def posteriors(docs: DataFrame, classifier: Classifier, text_col: str = "text", columns: list[str] | None = None,
               tokens_out: str = "n_tokens", posterior_out: str = "posterior") -> DataFrame:
    """``docs`` (or only its ``columns``) with the words of the whole text and the array of posteriors; columns of
    ``docs`` with one of these two names fall away."""
    kept = [f for f in docs.schema.fields if f.name not in (tokens_out, posterior_out) and (columns is None or f.name in columns)]
    names = [f.name for f in kept]
    whole, = free_names(names, "_text")
    source = docs.select(*[F.col(f"`{n}`") for n in names], F.col(f"`{text_col}`").cast("string").alias(whole))
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value.weights
        for batch in batches:
            found = [(linear.softmax(x @ w), counts) for x, counts in features(batch.column(len(names)))]
            p = np.concatenate([f[0] for f in found]).astype(np.float64) if found else np.zeros((0, w.shape[1]))
            p /= np.maximum(p.sum(axis=1, keepdims=True), 1e-12)
            tokens = np.concatenate([f[1] for f in found]) if found else np.zeros(0)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1, dtype=np.int32) * p.shape[1]), pa.array(p.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(names)], pa.array(tokens.astype(np.int64)), lists],
                                             names=[*names, tokens_out, posterior_out])

    return source.mapInArrow(run, StructType([*kept, StructField(tokens_out, LongType()), StructField(posterior_out, ArrayType(DoubleType()))]))


def _dot(vector: Column, weights: Column) -> Column:
    return F.aggregate(F.zip_with(vector, weights, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)


def _replayed(posterior: Column, pulls: list[np.ndarray], pull_rate: float, hold: float) -> Column:
    """The rate after the projected steps so far: r <- max(0, r - rate * (posterior . pull + hold * (r - 1)))."""
    if not pulls:
        return F.lit(1.0)
    steps = F.array(*[F.array(*[F.lit(float(x)) for x in pull]) for pull in pulls])
    return F.aggregate(steps, F.lit(1.0), lambda r, pull: F.greatest(
        F.lit(0.0), r - F.lit(pull_rate) * (_dot(posterior, pull) + F.lit(hold) * (r - F.lit(1.0)))))


@dataclass
class Rates:
    docs: DataFrame
    domains: list[str]
    totals: dict[str, float]
    wanted: dict[str, float]
    pulls: list[np.ndarray]
    hold: float

    @property
    def misfit(self) -> dict[str, float]:
        """Expected tokens above (below: negative) what each domain should have when the fitting ended; all within the
        tolerance unless the steps were used up or the targets cannot be met by these documents."""
        return {d: self.totals[d] - self.wanted[d] for d in self.totals}

    def rate(self, posterior: Column) -> Column:
        """The fitted rate of a document with this posterior."""
        return _replayed(posterior, self.pulls, 1 / (1 + self.hold), self.hold)


def mix(docs: DataFrame, classifier: Classifier, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text",
        budget: float | None = None, hold: float = 1e-3, steps: int = 30, tolerance: float = 1e-4) -> Rates:
    """Rates per document row: ``docs`` of the result has the id, n_tokens, posterior and rate.

    Minimises the squared misfit between the expected tokens of each domain and ``targets`` (weights, scaled to
    ``budget`` tokens; None: as many as there are), measured in the metric in which one step settles the fit of the
    documents above zero, plus ``hold`` times the squared distance of the rates from 1, over rates >= 0.  Stops when no domain's total
    moves or misses by more than ``tolerance`` of the budget, or after ``steps`` steps; ``misfit`` of the result tells what is left.

    A null or empty text has no tokens: its posterior is that of the intercepts and its rate changes no total.
    Every row is a document, also repeated rows and rows without an id.  Domains without a target weigh 0.  With an
    empty table, no token, or fewer than two learned domains all rates are 1.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mix")
    base = scratch.write(posteriors(docs, classifier, text_col, [id_col]), "posteriors")
    domains = classifier.domains
    d = len(domains)
    t, p = F.col("n_tokens").cast("double"), F.col("posterior")
    moments = [F.sum(t * p[i] * p[j]).alias(f"m{i}_{j}") for i in range(d) for j in range(i, d)]
    first = base.agg(F.sum("n_tokens").alias("tokens"), *moments).first() if d else None
    total = float(first["tokens"] or 0) if first else 0.0
    if d < 2 or total == 0:
        return Rates(base.withColumn("rate", F.lit(1.0)), domains, {}, {}, [], hold)
    second = np.zeros((d, d))
    for i in range(d):
        for j in range(i, d):
            second[i, j] = second[j, i] = first[f"m{i}_{j}"] / total
    weight = np.array([max(0.0, targets.get(x, 0.0)) for x in domains])
    if weight.sum() <= 0:
        raise ValueError("no target weight for any learned domain")
    wanted = weight / weight.sum() * (budget if budget is not None else total) / total
    rate = 1 / (1 + hold)
    pulls: list[np.ndarray] = []
    before = None
    for _ in range(steps):
        # totals at the rates so far, and the second moments of the documents that have not reached zero
        sums = [F.sum(F.col("w") * p[i]).alias(f"a{i}") for i in range(d)]
        sums += [F.sum(F.when(F.col("w") > 0, t * p[i] * p[j]).otherwise(0.0)).alias(f"m{i}_{j}") for i in range(d) for j in range(i, d)]
        got = base.withColumn("w", t * _replayed(p, pulls, rate, hold)).agg(*sums).first()
        now = np.array([got[f"a{i}"] for i in range(d)]) / total
        if np.abs(now - wanted).max() < tolerance or (before is not None and np.abs(now - before).max() < tolerance / 10):
            before = now
            break
        before = now
        free = np.zeros((d, d))
        for i in range(d):
            for j in range(i, d):
                free[i, j] = free[j, i] = got[f"m{i}_{j}"] / total
        pulls.append(np.linalg.solve(free + 0.02 * second + 1e-9 * np.eye(d), now - wanted))
    final = base.withColumn("rate", _replayed(p, pulls, rate, hold))
    return Rates(final, domains, dict(zip(domains, (before * total).tolist())), dict(zip(domains, (wanted * total).tolist())), pulls, hold)


def copies(rate: Column, *key: Column) -> Column:
    """Whole number of copies with the rate as its mean: the fraction is rounded by a hash of ``key``."""
    chance = F.pmod(F.xxhash64(*key, F.lit("copies")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return F.floor(rate + chance).cast("int")


def label_domain(quality: Column, toxic: Column) -> Column:
    """Domain of a labelled document: toxic, high or low; null where a needed label is null."""
    return F.when(toxic == 1, F.lit("toxic")).when(quality == 1, F.lit("high")).when(quality == 0, F.lit("low"))
