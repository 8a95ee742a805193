import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, anchor string, score int"


def brute(rows, every=10, positives=5, negatives=10, least=30, most=90):
    v = [(i, lab, np.floor(256 * np.array(e, dtype=np.float32).astype(float)).astype(np.int64)) for i, e, lab in rows
         if i is not None and lab is not None and e and all(x is not None and np.isfinite(x) for x in e)]
    out = []
    for q in sorted({i for i, _, _ in v if i % every == 0}):
        _, label, own = min((x for x in v if x[0] == q), key=lambda x: (x[1], x[2].tolist()))
        scored = sorted((-int(own @ e), i, lab) for i, lab, e in v if i != q and len(e) == len(own))
        for s, p, _ in [x for x in scored if x[2] == label][:positives]:
            fits = [x for x in scored if x[2] != label and least * -s <= 100 * -x[0] <= most * -s][:negatives]
            out += [(q, p, r + 1, i, -s, -t) for r, (t, i, _) in enumerate(fits)]
    return out


def clustered(n=900, dims=24, seed=1):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(9, dims))
    return [(i, (base[i % 9] * rng.uniform(0.2, 2) + 0.3 * rng.normal(size=dims)).astype(np.float32).tolist(), int(rng.integers(0, 4)))
            for i in range(n)]


@pytest.mark.parametrize("block,cluster,first", [(4096, 512, 2), (40, 7, 1)])
def test_against_brute_force(frame, monkeypatch, block, cluster, first):
    monkeypatch.setattr(H, "BLOCK_ROWS", block)
    monkeypatch.setattr(H, "CLUSTER_ROWS", cluster)
    monkeypatch.setattr(H, "FIRST", first)
    monkeypatch.setattr(H, "GROUP_BLOCKS", 3)
    monkeypatch.setattr(H, "CENTRES", 9)
    rows = clustered()
    d = 24
    rows += [(1000, None, 1), (1001, [1.0, None] + [0.0] * (d - 2), 1), (1002, [float("nan")] * d, 1), (1003, [], 1), (1010, [1.0] * d, None),
             (1020, [1.0] * 7, 1), (1021, [2.0] * 7, 1), (1022, [1.0] * 7, 2), (None, [1.0] * d, 1), (1030, [0.0] * d, 2), (1031, [0.0] * d, 3),
             (1032, [0.0] * d, 2), (1040, [-1.0] * d, 3), (20, rows[20][1], rows[20][2]), (33, rows[33][1], rows[33][2])]
    rows += [(1100 + i, rows[5][1], i % 2) for i in range(120)]  # many copies, of two labels
    wide = [(*r, "x", "y", 1) for r in rows]
    got = H.hard_negatives(frame(wide, SCHEMA).repartition(5), F.col("vec_id") % 10 == 0)
    got = sorted(tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())
    assert len(got) > 1000 and got == sorted(brute(rows))


def test_walk_ends_before_the_list():
    rng = np.random.default_rng(2)
    base = rng.normal(size=(40, 16))
    x = np.floor(256 * (base[rng.integers(0, 40, 20_000)] + 0.02 * rng.normal(size=(20_000, 16)))).astype(np.int64)
    a = np.floor(256 * (base[:1] + 0.02 * rng.normal(size=(30, 16)))).astype(np.int64)
    centre = base[0] / np.linalg.norm(base[0])
    spread = float(H._angles(a, centre)[0].max())
    windows = np.array([(i, H.NO_FLOOR, -H.NO_FLOOR) for i in range(30)])
    labels = rng.integers(0, 3, 20_000)
    w, ids, scores, scored = H.walk(a, np.full(30, -1), np.zeros(30, int), centre, spread, windows, x, np.arange(20_000), labels, True, 5)
    assert scored < 5000
    for i in range(30):
        s = x @ a[i]
        want = sorted((-int(s[j]), j) for j in np.flatnonzero(labels == 0))[:5]
        assert list(zip((-scores[w == i]).tolist(), ids[w == i].tolist())) == want


def test_large_numbers_and_other_labels(frame):
    rows = [(i, [float(2 ** 20 + i), float(-(2 ** 19)), 3.0], str(i % 2)) for i in range(12)]
    got = H.hard_negatives(frame(rows, "vec_id long, embedding array<float>, label string"), F.col("vec_id") == 0, 3, 4, 10, 100)
    want = brute([(i, e, int(lab)) for i, e, lab in rows], 100, 3, 4, 10, 100)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want) and want


def test_empty(frame):
    assert H.hard_negatives(frame([], SCHEMA), F.col("vec_id") % 10 == 0).count() == 0
    assert H.hard_negatives(frame([(0, [1.0], 1, None, None, None)], SCHEMA), F.col("vec_id") % 10 == 0).count() == 0
