"""Periodic runs of words, and texts with their repetitions collapsed.

A run is a maximal stretch of words with smallest period q that is at least max(6, 4 q) words long.  Per document the
suffixes are put in order (rank doubling) with the lengths of their longest common prefixes (LCP).  Kruskal's order
then unites suffix classes by decreasing LCP: each class keeps its positions in order, the smaller class goes into the
larger one, and two positions that become neighbours at a distance within the LCP are the seed of a run.  At that moment
their distance is its smallest period (a smaller one would stand between them) and LCP plus distance its length; seeds
that the word before them would extend are shifted copies of an earlier seed and fall away.

A run of 4 q words or more repeats 5 words within its document, so documents without a repeated 5-word shingle have no
runs and are not sorted.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm import words

#: Least length of a run in words, and in periods.
LEAST_WORDS = 6
LEAST_PERIODS = 4

RUN_DDL = "array<struct<start: long, length: long, period: long>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def suffix_order(ids: np.ndarray, text: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, LCP of each suffix with the one before it) of texts that stand one behind the other.

    ``text`` and ``end`` give every position's text number and the end of its text; common prefixes stop at the end of
    a text, and suffixes of different texts have none.
    """
    n = len(ids)
    _, rank = np.unique(ids, return_inverse=True)
    _, rank = np.unique(text * n + rank, return_inverse=True)
    place, span = np.arange(n), 1
    levels = [rank.astype(np.int32)]
    while n and rank.max() + 1 < n:
        ahead = place + span
        inside = ahead < end
        second = np.where(inside, rank[np.minimum(ahead, n - 1)] + 1, 0)
        _, rank = np.unique(rank * (n + 1) + second, return_inverse=True)
        levels.append(rank.astype(np.int32))
        span *= 2
    order = np.empty(n, dtype=np.int64)
    order[rank] = place
    lcp = np.zeros(n, dtype=np.int64)
    a, b, at = order[:-1], order[1:], np.zeros(max(n - 1, 0), dtype=np.int64)
    for t in range(len(levels) - 1, -1, -1):
        x, y = a + at, b + at
        fits = (x < end[a]) & (y < end[b])
        same = np.zeros(len(a), dtype=bool)
        same[fits] = levels[t][x[fits]] == levels[t][y[fits]]
        at[same] += 1 << t
    lcp[1:] = at
    return order, lcp


def seeds(order: np.ndarray, lcp: np.ndarray, least_words: int, least_periods: int) -> list[tuple[int, int, int]]:
    """(position, distance, LCP) of positions that become neighbours at a distance that makes a long enough run."""
    least = min(max(least_words - d, (least_periods - 1) * d) for d in range(1, least_words + 1))
    at = np.flatnonzero(lcp >= least)
    at = at[np.argsort(-lcp[at], kind="stable")]
    parent: dict[int, int] = {}
    members: dict[int, list[int]] = {}
    found: list[tuple[int, int, int]] = []

    def root(x: int) -> int:
        if x not in parent:
            parent[x] = x
            members[x] = [int(order[x])]
            return x
        top = x
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for r, common in zip(at.tolist(), lcp[at].tolist()):
        small, large = root(r - 1), root(r)
        if len(members[small]) > len(members[large]):
            small, large = large, small
        parent[small] = large
        ours, own = members[large], members.pop(small)
        # positions of the smaller class, each with its neighbours in the larger one; its own next one may stand between
        for i, x in enumerate(own):
            k = bisect_left(ours, x)
            if k and (not i or ours[k - 1] > own[i - 1]):
                d = x - ours[k - 1]
                if common + d >= least_words and common >= (least_periods - 1) * d:
                    found.append((ours[k - 1], d, common))
            if k < len(ours) and (i + 1 == len(own) or ours[k] < own[i + 1]):
                d = ours[k] - x
                if common + d >= least_words and common >= (least_periods - 1) * d:
                    found.append((x, d, common))
        for x in own:
            if x > ours[-1]:
                ours.append(x)
            else:
                ours.insert(bisect_left(ours, x), x)
    return found


def find_runs(ids: np.ndarray, offsets: np.ndarray, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, start, length, period) of all runs of texts given by word ids, ordered by these."""
    if least_periods < 2 or least_words < 3:
        raise ValueError("a run needs at least two periods and three words")
    counts = np.diff(offsets)
    # a run of the least length repeats this many words at the distance of its period
    size = min(max(least_words - d, (least_periods - 1) * d) for d in range(1, least_words + 1))
    shingles, first, at = words.shingle_hashes(ids, offsets, size)
    text_of = np.repeat(np.arange(len(counts)), np.diff(at))
    key = words.mix(shingles ^ words.mix(text_of.astype(words.U64) + words.U64(1)))
    order = np.argsort(key, kind="stable")
    twice = np.flatnonzero(key[order][1:] == key[order][:-1])
    active = np.unique(text_of[order[twice]])
    none = np.zeros(0, dtype=np.int64)
    if not active.size:
        return none, none, none, none
    lengths = counts[active]
    base = np.concatenate([[0], np.cumsum(lengths)])
    text = np.repeat(np.arange(len(active)), lengths)
    own = ids[np.repeat(offsets[active] - base[:-1], lengths) + np.arange(base[-1])]
    found = np.array(seeds(*suffix_order(own, text, base[1:][text]), least_words, least_periods), dtype=np.int64).reshape(-1, 3)
    place, period, common = found.T
    before = np.maximum(place - 1, 0)
    starts = (place == base[text[place]]) | (own[before] != own[before + period])
    place, period, common = place[starts], period[starts], common[starts]
    number, start = active[text[place]], place - base[text[place]]
    by = np.lexsort((period, start, number))
    return number[by], start[by], (common + period)[by], period[by]


def _collapse(least_words: int, least_periods: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in words.chunks(batch.column(1)):
                ids, at = words.exact_words(data, offsets)
                number, start, length, period = find_runs(ids, at, least_words, least_periods)
                begin = np.searchsorted(number, np.arange(end - row + 1))
                texts: list[bytes] = []
                for i in range(end - row):
                    own = data[offsets[i]:offsets[i + 1]].tobytes().split()
                    lo, hi = int(begin[i]), int(begin[i + 1])
                    if lo < hi:
                        edge = np.zeros(len(own) + 1, dtype=np.int64)
                        np.add.at(edge, start[lo:hi] + period[lo:hi], 1)
                        np.add.at(edge, start[lo:hi] + length[lo:hi], -1)
                        own = [own[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
                    texts.append(b" ".join(own))
                runs = pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.StructArray.from_arrays(
                    [pa.array(start), pa.array(length), pa.array(period)], fields=list(_RUN)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row), pa.array(np.diff(at), pa.int64()), runs, pa.array(texts, pa.binary()).view(pa.string())],
                    names=["id", "n_words", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """id, n_words, runs, collapsed: the runs of every whole text by start, then period, and the text without repetitions.

    Words are the maximal runs of other bytes than space and 0x09-0x0D, compared as they are and numbered from 0.
    ``collapsed`` joins by one space the words that no run holds after its first period.  A null or empty text has no
    words, no runs and an empty ``collapsed``.  Rows stay one by one, also with a null or repeated id; other columns
    are ignored; an empty table gives no rows.  One text is handled at a time where it exceeds 2 MB; its words take
    about 8 bytes per rank doubling then, some 200 bytes a word for a text of a million words with a repeated shingle.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(_collapse(least_words, least_periods), f"id {kind}, n_words long, runs {RUN_DDL}, collapsed string")
    return found.withColumnRenamed("id", id_col)
