import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vitrine.llm import periodic, queries


def brute_runs(w, least_words=6, least_periods=4):
    """All maximal stretches by their definition."""
    n, out = len(w), []
    for q in range(1, n // least_periods + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            smallest = next(d for d in range(1, q + 1) if all(w[k] == w[k + d] for k in range(i, i + length - d)))
            if smallest == q and length >= max(least_words, least_periods * q):
                out.append((i, length, q))
            i = j + 1
    return sorted((s, length, q) for s, length, q in out)


def found(texts):
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    ids = np.array([c for t in texts for c in t], dtype=np.uint64)
    rows = list(zip(*(x.tolist() for x in periodic.find_runs(ids, offsets))))
    return [[(s, length, q) for k, s, length, q in rows if k == i] for i in range(len(texts))]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), max_size=4))
def test_random_texts(texts):
    assert found(texts) == [brute_runs(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 14)), min_size=1, max_size=6))
def test_nested_repetitions(parts):
    text = [c for block, times in parts for c in block * times]
    assert found([text, text]) == [brute_runs(text)] * 2


def test_long_texts():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1000, 700)
    texts = [np.tile(base, 5).tolist(), [7] * 20_000, rng.integers(0, 10 ** 6, 5000).tolist(), np.tile([1, 1, 2], 3000).tolist()]
    assert found(texts) == [[(0, 3500, 700)], [(0, 20_000, 1)], [], [(0, 9000, 3)]]


def brute_row(doc_id, text):
    w = [] if text is None else text.encode().split()
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(w), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    keep = [True] * n
    for s, length, q in runs:
        for k in range(s + q, s + length):
            keep[k] = False
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (doc_id, len(runs), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
            hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for x, k in zip(w, keep) if k)).hexdigest())


def test_query_against_brute_force(frame, tmp_path):
    rng = np.random.default_rng(6)
    vocabulary = ["a", "B", "b", "çé", "x.", "the"]
    rows = [(i, " ".join(rng.choice(vocabulary[:rng.integers(1, 7)], rng.integers(0, 90))), "c") for i in range(300)]
    rows += [(300, None, "c"), (301, "", None), (302, " \t\n", "c"), (303, "a\ta\na  a\x0ba\x0ca\ra", "c"), (304, "a a a a a a a a", "c"),
             (305, rows[3][1], "c"), (3, rows[3][1], "c"), (None, "a a a a a a a", "c"), (306, "word " * 4000, "c")]
    frame(rows, "doc_id long, text string, n_words string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op12_periodic_runs(frame([], "x long").sparkSession, str(tmp_path))
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = sorted((tuple(r) for r in out.select(columns).collect()), key=str)
    want = [brute_row(i, t) for i, t, _ in rows if i is not None] + [(None, 1, 0, 7, 1, 7000, *brute_row(0, "a a a a a a a")[-2:])]
    assert any(r[1] > 1 for r in want) and any(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows)
    assert got == sorted(want, key=str)


def test_empty_and_bounds(frame):
    assert periodic.periodic_runs(frame([], "doc_id long, text string")).count() == 0
    row = periodic.periodic_runs(frame([(1, "x y x y x y z")], "doc_id long, text string"), least_periods=3).first()
    assert (row.n_words, [tuple(r) for r in row.runs], row.collapsed) == (7, [(0, 6, 2)], "x y z")
    with pytest.raises(ValueError):
        periodic.find_runs(np.zeros(0, np.uint64), np.zeros(1, np.int64), 6, 1)
