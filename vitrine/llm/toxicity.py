"""Toxicity by a support vector machine on a subsequence string kernel with Nyström landmarks.

A word's features are its subsequences of three letters, word borders included, that lie within six places; each counts
by DECAY to the number of letters it leaps.  The kernel of two words is the cosine of these features, so letters that
are put in or left out cost little.  Marks inside a word are not letters ("i.d-i*o t"), single letters that stand in a
row are one word, and digits that stand for letters are read as these.  Landmarks are a bounded number of words of the
training sentences; the Nyström map of a word is its kernel with the landmarks times the inverse root of the landmarks'
own kernel matrix.

Sentences carry the label of their document, and words at first that of their sentences, so that what both classes hold
weighs nothing.  The linear SVM learned from that names each toxic sentence's witness, the word that it finds most toxic,
if hardly a word of a clean sentence comes near it; SVMs on witnesses against the words of clean sentences follow.  A document's margin is that of its worst word, turned into a score by a logistic curve fitted
on the training documents.  Since the map is linear in a word's features, the whole model is one weight per subsequence.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from vitrine.llm import linear, words
from vitrine.llm.scratch import Scratch

#: Letters of a subsequence lie within this many places; weight per letter leaped.
WITHIN = 6
DECAY = 0.8
#: Longest word that is handled as one; a longer one is all its stretches of this length at half of it.
LONGEST = 24
#: Labelled documents per class and sentences per class that the model is fitted on (bounded samples by hash).
FIT_DOCUMENTS = 2000
FIT_SENTENCES = 20_000
#: Words of a sentence; a longer one is several.
SENTENCE_WORDS = 64
#: Landmarks: words that tell the classes apart, and others by hash.
TELLING = 64
OTHER = 64
#: Rounds of witnesses, and share of the words of clean sentences that a witness must exceed.
ROUNDS = 2
EXCEED = 0.9995
#: Share of toxic ones, at classes of equal size, among the documents that hold a witness; weight of altered witnesses.
PURITY = 0.9
ALTERED = 0.5
#: Scored words that a worker keeps.
KEPT_WORDS = 1 << 20

_BORDER = 31
_LETTER = np.zeros(256, dtype=np.uint8)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = np.arange(1, 27)
_LETTER[0x80:] = 27 + np.arange(128) % 4
for _sign, _letter in zip("0134578@", "oieastba"):  # fixed values: digits and signs that stand for letters
    _LETTER[ord(_sign)] = ord(_letter) - 96
_LEAPS = [(a, b, DECAY ** (b - 2)) for a, b in combinations(range(1, WITHIN), 2)]
_SPLIT = re.compile(r"[.!?\n\r]+")


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(letters, start, end, text number) of the words of consecutive texts."""
    letter = _LETTER[data]
    at = np.flatnonzero(letter)
    letters = letter[at]
    gap = np.cumsum(words.separators(data))[at] if len(at) else at
    text = np.searchsorted(offsets, at, side="right") - 1
    fresh = np.ones(len(at), dtype=bool)
    fresh[1:] = (gap[1:] != gap[:-1]) | (text[1:] != text[:-1])
    start = np.flatnonzero(fresh)
    single = np.diff(np.append(start, len(at))) == 1
    joined = np.zeros(len(start), dtype=bool)
    joined[1:] = single[1:] & single[:-1] & (text[start[1:]] == text[start[:-1]])
    start = start[~joined]
    end = np.append(start[1:], len(at))
    long = np.flatnonzero(end - start > LONGEST)
    if long.size:
        half = LONGEST // 2
        times = -(-(end[long] - start[long] - LONGEST) // half) + 1
        first = np.repeat(start[long], times) + half * (np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times))
        last = np.minimum(first + LONGEST, np.repeat(end[long], times))
        keep = end - start <= LONGEST
        start, end = np.concatenate([start[keep], first]), np.concatenate([end[keep], last])
    return letters, start, end, text[start] if len(start) else start


def subsequences(letters: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, code, weight) of all subsequences of words, the weights of a word's equal ones added up."""
    length = end - start + 2
    base = np.cumsum(length) - length
    owner = np.repeat(np.arange(len(start)), length)
    inside = np.arange(length.sum()) - base[owner]
    chain = np.full(length.sum(), _BORDER, dtype=np.int64)
    own = (inside > 0) & (inside < length[owner] - 1)
    chain[own] = letters[(start[owner] + inside - 1)[own]]
    keys, weights = [], []
    for a, b, weight in _LEAPS:
        if b >= len(chain):
            continue
        fits = np.flatnonzero(owner[b:] == owner[:-b])
        keys.append(owner[fits] << 15 | chain[fits] << 10 | chain[fits + a] << 5 | chain[fits + b])
        weights.append(np.full(len(fits), weight))
    if not keys:
        return (np.zeros(0, dtype=np.int64),) * 2 + (np.zeros(0),)
    key, weight = np.concatenate(keys), np.concatenate(weights)
    order = np.argsort(key, kind="stable")
    key, weight = key[order], weight[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else key
    return key[first] >> 15, key[first] & 0x7FFF, np.add.reduceat(weight, first) if len(first) else weight


def kernel_with(letters: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray, block: int = 8192) -> np.ndarray:
    """Words x columns: each word's features, scaled to length one, times a table with a row per code."""
    out = np.zeros((len(start), table.shape[1]), dtype=np.float32 if table.shape[1] > 1 else np.float64)
    for lo in range(0, len(start), block):
        owner, code, weight = subsequences(letters, start[lo:lo + block], end[lo:lo + block])
        if not len(owner):
            continue
        first = np.searchsorted(owner, np.arange(min(block, len(start) - lo)))
        # every word has a subsequence: its border, a letter, its other border
        norm = np.sqrt(np.add.reduceat(weight * weight, first))
        for c in range(0, table.shape[1], 16):
            out[lo:lo + block, c:c + 16] = np.add.reduceat(weight[:, None] * table[code, c:c + 16], first) / norm[:, None]
    return out


@dataclass
class Model:
    """weights: one per subsequence code; a word's margin is its scaled features times these plus ``bias``.

    ``slope`` and ``intercept`` turn a document's margin into its score; ``floor`` is the margin of a text without words.
    """

    weights: np.ndarray
    bias: float
    slope: float
    intercept: float
    floor: float

    def word_margins(self, letters: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return kernel_with(letters, start, end, self.weights[:, None])[:, 0] + self.bias

    def scores(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.intercept, -60, 60)))


class _Scorer:
    """Margins of whole texts; words met before are looked up."""

    def __init__(self, model: Model):
        self.model = model
        self.keys, self.margins = np.zeros(0, dtype=words.U64), np.zeros(0)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        letters, start, end, text = spans(data, offsets)
        out = np.full(len(offsets) - 1, self.model.floor)
        if not len(start):
            return out
        key, first, back = np.unique(words.range_hashes(letters, start, end - start), return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, key)
        known = np.zeros(len(key), dtype=bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == key[inside]
        margin = np.empty(len(key))
        margin[known] = self.margins[place[known]]
        new = np.flatnonzero(~known)
        margin[new] = self.model.word_margins(letters, start[first[new]], end[first[new]])
        if len(self.keys) + len(new) > KEPT_WORDS:
            self.keys, self.margins = key, margin
        elif new.size:
            at = np.searchsorted(self.keys, key[new])
            self.keys, self.margins = np.insert(self.keys, at, key[new]), np.insert(self.margins, at, margin[new])
        np.maximum.at(out, text, margin[back])
        return out


def _sentences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, toxic, sentence): the sentences of whole labelled texts that hold a letter."""
    for batch in batches:
        for i in range(batch.num_rows):
            pieces = []
            for part in _SPLIT.split(batch.column(2)[i].as_py()):
                own = part.split()
                pieces += [" ".join(own[k:k + SENTENCE_WORDS]) for k in range(0, len(own), SENTENCE_WORDS)]
            n = len(pieces)
            if n:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, batch.column(0)[i].as_py()), pa.int64()),
                                                  pa.array(np.full(n, batch.column(1)[i].as_py()), pa.int32()), pa.array(pieces)],
                                                 names=["id", "toxic", "sentence"])


def sample_ids(labels: DataFrame, per_class: int, id_col: str = "doc_id", label_col: str = "toxic") -> DataFrame:
    """(id, toxic): about ``per_class`` labelled ids of each class, those with the least hashes; an id comes once."""
    rows = labels.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("int").alias("toxic"))
    rows = rows.where(F.col("id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    place = F.pmod(F.xxhash64("id", F.lit("fit")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    keep = F.lit(False)
    for c, n in sorted(counts.items()):
        keep = keep | ((F.col("toxic") == c) & (place < per_class / n))
    return rows.where(keep)


def _packed(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)


def altered(word: np.ndarray) -> list[np.ndarray]:
    """The word with one letter put in at every inner place, and with one inner letter left out if it has five or more."""
    put = [np.insert(word, k, 1 + (7 * k + 3 * len(word)) % 26) for k in range(1, len(word))]
    return put + ([np.delete(word, k) for k in range(1, len(word) - 1)] if len(word) > 4 else [])


def learn(ids: np.ndarray, toxic: np.ndarray, texts: list[str]) -> Model:
    """The model of labelled sentences; ``ids`` names the document of each."""
    letters, start, end, sentence = spans(*_packed(texts))
    codes = 1 << 15
    if not len(start) or not (toxic == 1).any() or not (toxic == 0).any():
        share = float((toxic == 1).mean()) if len(toxic) else 0.0
        return Model(np.zeros(codes), 0.0, 0.0, float(np.log((share + 1e-3) / (1 - share + 1e-3))), 0.0)
    key = words.range_hashes(letters, start, end - start)
    distinct, first, word = np.unique(key, return_index=True, return_inverse=True)
    w_start, w_end = start[first], end[first]
    n = len(distinct)
    # documents of each class that hold a word, and how much that tells the classes apart
    seen = np.unique(np.stack([word, ids[sentence], toxic[sentence]], axis=1), axis=0)
    bad = np.bincount(seen[seen[:, 2] == 1, 0], minlength=n).astype(float)
    good = np.bincount(seen[seen[:, 2] == 0, 0], minlength=n).astype(float)
    of_bad, of_good = len(np.unique(ids[toxic == 1])), len(np.unique(ids[toxic == 0]))
    share = (bad + good) / (of_bad + of_good)
    with np.errstate(divide="ignore", invalid="ignore"):
        telling = np.nan_to_num(bad * np.log(bad / (share * of_bad))) + np.nan_to_num(good * np.log(good / (share * of_good)))
    telling = np.where(bad / of_bad > good / of_good, telling, -telling)
    top = np.lexsort((distinct, -telling))[:TELLING]
    rest = np.setdiff1d(np.argsort(words.mix(distinct), kind="stable")[:TELLING + OTHER], top, assume_unique=True)[:OTHER]
    marks = np.concatenate([top, rest])
    owner, code, weight = subsequences(letters, w_start[marks], w_end[marks])
    table = np.zeros((codes, len(marks)))
    table[code, owner] = weight
    table /= np.linalg.norm(table, axis=0)
    values, vectors = np.linalg.eigh(table.T @ table)
    fine = values > 1e-6
    root = vectors[:, fine] / np.sqrt(values[fine])  # the inverse root, up to a rotation
    maps = np.column_stack([kernel_with(letters, w_start, w_end, table) @ root, np.ones(n)]).astype(np.float32)
    # first every word has the label of its sentence, by the shares of the classes' documents that hold it
    in_bad, in_good = np.flatnonzero(bad), np.flatnonzero(good)
    both = np.concatenate([bad[in_bad] / of_bad, good[in_good] / of_good])
    v = linear.fit_weighted_svm(maps[np.concatenate([in_bad, in_good])], np.repeat([1.0, -1.0], [len(in_bad), len(in_good)]), both / both.mean())
    clean = np.unique(word[toxic[sentence] == 0])
    # chance alone makes some word of n tell as much as log n; and a witness stands in clean documents hardly ever
    told = (telling >= min(np.log(n), telling.max() / 2)) & (bad / of_bad >= PURITY * (bad / of_bad + good / of_good))
    for _ in range(ROUNDS):
        f = maps @ v
        edge = np.quantile(f[clean], EXCEED)
        by = np.lexsort((-f[word], sentence))
        worst = by[np.concatenate([[True], sentence[by][1:] != sentence[by][:-1]])]
        witness = word[worst[(toxic[sentence[worst]] == 1) & (f[word[worst]] > edge) & told[word[worst]]]]
        if not witness.size:
            break
        own = np.unique(witness)
        other = [letters[w_start[i]:w_end[i]] for i in own]
        raw = np.concatenate([v for o in other for v in altered(o)])
        size = np.array([len(v) for o in other for v in altered(o)])
        near = words.range_hashes(raw, np.cumsum(size) - size, size)
        at = np.flatnonzero(~np.isin(near, distinct[clean]))
        begin = (np.cumsum(size) - size)[at]
        more = np.column_stack([kernel_with(raw, begin, begin + size[at], table) @ root, np.ones(len(at))])
        x = np.concatenate([maps[witness], more.astype(np.float32), maps[clean]])
        shares = [(len(witness), 1 - ALTERED), (len(more), ALTERED), (len(clean), 1.0)]
        weight = np.concatenate([np.full(k, share * len(x) / (2 * max(k, 1))) for k, share in shares])
        v = linear.fit_weighted_svm(x, np.where(np.arange(len(x)) < len(x) - len(clean), 1.0, -1.0), weight)
    weights, bias = table @ (root @ v[:-1]), float(v[-1])
    f = maps @ v
    _, of = np.unique(ids[sentence], return_inverse=True)
    margin = np.full(of.max() + 1, -np.inf)
    np.maximum.at(margin, of, f[word])
    label = np.zeros(len(margin), dtype=int)
    np.maximum.at(label, of, toxic[sentence])
    slope, intercept = fit_logistic(margin, label)
    return Model(weights, bias, slope, intercept, float(margin.min()))


def fit_logistic(margin: np.ndarray, label: np.ndarray, steps: int = 200, l2: float = 1e-3) -> tuple[float, float]:
    """(slope >= 0, intercept) of the logistic curve of labels over margins, by damped Newton steps."""
    x = np.column_stack([margin, np.ones(len(margin))])
    w = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -60, 60)))
        gradient = x.T @ (p - label) / len(x) + l2 * np.array([w[0], 0.0])
        hessian = (x * (p * (1 - p))[:, None]).T @ x / len(x) + np.diag([l2, 1e-9])
        w = w - np.clip(np.linalg.solve(hessian, gradient), -1, 1)
    return max(0.0, float(w[0])), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        documents: int = FIT_DOCUMENTS, sentences: int = FIT_SENTENCES) -> Model:
    """Fit on the sentences of about ``documents`` labelled documents of each class, ``sentences`` of each class at most.

    Labels other than 0 and 1, and documents without text, are not learned from; an id labelled both ways is toxic; an
    id that several documents have is its least text.  Without documents of both classes every text has the same score.
    """
    scratch = Scratch(docs.sparkSession, "toxicity")
    chosen = F.broadcast(scratch.write(sample_ids(labels, documents, id_col, label_col), "chosen"))  # bounded by ``documents``
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = rows.where(F.col("text").isNotNull()).join(chosen, "id").groupBy("id", "toxic").agg(F.min("text").alias("text"))
    found = scratch.write(rows.select("id", "toxic", "text").mapInArrow(_sentences, "id long, toxic int, sentence string"), "sentences")
    counts = {r["toxic"]: r["count"] for r in found.groupBy("toxic").count().collect()}
    place = F.pmod(F.xxhash64("id", "sentence", F.lit("fit")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    keep = F.lit(False)
    for c, n in sorted(counts.items()):
        keep = keep | ((F.col("toxic") == c) & (place < sentences / n))
    got = sorted((r["id"], r["toxic"], r["sentence"]) for r in found.where(keep).distinct().collect())
    scratch.keep()
    return learn(np.array([r[0] for r in got], dtype=np.int64), np.array([r[1] for r in got], dtype=np.int64), [r[2] for r in got])


def score(docs: DataFrame, model: Model, text_col: str = "text", score_out: str = "score", columns: list[str] | None = None) -> DataFrame:
    """``docs`` (or only its ``columns``) with the toxicity of every whole text, 0 to 1.

    A text that is null, empty or without a letter has the score of the most harmless training document.  A column of
    ``docs`` named like the output is replaced; all others stay, also with their nulls and repeated rows.
    """
    kept = [f for f in docs.schema.fields if f.name != score_out and (columns is None or f.name in columns)]
    names = [f.name for f in kept]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(shared.value)
        for batch in batches:
            margins = [scorer(data, offsets) for _, _, data, offsets in words.chunks(batch.column(len(names)))]
            margins = np.concatenate(margins) if margins else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(names)], pa.array(scorer.model.scores(margins))], names=[*names, score_out])

    own = "text"
    while own in {n.lower() for n in names}:
        own += "_"
    source = docs.select(*[F.col(f"`{n}`") for n in names], F.col(f"`{text_col}`").cast("string").alias(own))
    return source.mapInArrow(run, StructType([*kept, StructField(score_out, DoubleType())]))
