import re

import numpy as np
import pyarrow as pa
import pytest

from vitrine.llm import ngram_join as J
from vitrine.llm import words

SCHEMA = "doc_id long, text string, n_shingles string"


def shingles(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute(rows, size, num, den):
    sets = [(i, shingles(t, size)) for i, t, _ in rows]
    links = {i: set() for i, _ in sets}
    for i, a in sets:
        for j, b in sets:
            if i is not None and j is not None and i != j and a and b and den * len(a & b) >= num * len(a | b):
                links[i].add(j)
    out = []
    for i, s in sets:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out.append((i, len(s), min(seen) if i is not None else None))
    return sorted(out, key=str)


def edited(rng, w, n):
    w = list(w)
    for _ in range(n):
        w[rng.integers(len(w))] = f"new{rng.integers(9)}"
    return w


@pytest.mark.parametrize("size,num,den", [(3, 90, 100), (5, 80, 100), (2, 50, 100)])
def test_against_brute_force(frame, size, num, den):
    rng = np.random.default_rng(8)
    rows = []
    for g in range(25):
        base = [f"w{x}" for x in rng.integers(0, 400, rng.integers(4, 120))]
        for _ in range(rng.integers(1, 9)):
            rows.append((len(rows), " ".join(edited(rng, base, rng.integers(0, 4))).title(), "c"))
    common = "a very common line that many documents share"
    rows += [(len(rows) + i, f"{common} {x}", None) for i, x in enumerate(rng.integers(0, 40, 60))]
    rows += [(1000, None, None), (1001, "", "c"), (1002, " \n\t", None), (1003, "one", None), (1004, "ONE", "c"), (1005, "one two", None),
             (None, rows[0][1], None), (1006, "é\xa0x y z", None), (1007, rows[5][1], "c"), (1007, rows[5][1], "c")]
    got = J.jaccard_groups(frame(rows, SCHEMA).repartition(5), size, num, den)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str) == brute(rows, size, num, den)


def test_chain_that_only_tiles_can_close(frame, monkeypatch):
    """Groups whose members link to neighbours only: leaders alone do not find every link."""
    monkeypatch.setattr(J, "BLOCK", 4)
    rng = np.random.default_rng(9)
    rows = []
    for g in range(3):
        w = [f"g{g}x{i}" for i in range(100)]
        for _ in range(30):
            rows.append((len(rows), " ".join(w), None))
            w = edited(rng, w, 1)
    got = J.jaccard_groups(frame(rows, SCHEMA), 3, 90, 100)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str) == brute(rows, 3, 90, 100)


def test_linked_sets_share_a_cell():
    rng = np.random.default_rng(10)
    bands = J.Bands(90, 100)
    for _ in range(400):
        n = int(rng.integers(1, 900))
        a = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
        keep = a[rng.random(len(a)) > rng.random() * 0.12]
        b = np.unique(np.concatenate([keep, rng.integers(0, 2 ** 63, int(rng.integers(0, len(a) // 12 + 2))).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if len(b) and 100 * both >= 90 * (len(a) + len(b) - both):
            assert len(np.intersect1d(J.cell_keys(a, bands), J.cell_keys(b, bands)))
            assert J.may_link(J.bitmap(a), J.bitmap(b), len(a), len(b), bands)


def test_words_follow_the_rule():
    texts = ["A b\x0bC", "", "  x  ", "é É", "w" * 5000, "ab" * 4 + " " + "ab" * 4 + "c", None]
    got = [len(s) for s in words.text_shingle_sets(pa.array(texts), 1)]
    assert got == [len(shingles(t, 1)) for t in texts]


def test_empty(frame):
    assert J.jaccard_groups(frame([], SCHEMA)).count() == 0
