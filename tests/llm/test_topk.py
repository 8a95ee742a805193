import numpy as np
from pyspark.sql import functions as F

from vitrine.llm import topk

SCHEMA = "vec_id long, embedding array<float>, rank string"


def brute(rows, k):
    v = [(i, np.floor(256 * np.array(e, dtype=np.float32).astype(float)).astype(int)) for i, e, _ in rows
         if i is not None and e and all(x is not None and np.isfinite(x) for x in e)]
    out = []
    for q in sorted({i for i, _ in v if i % 5 == 0}):
        mine = next(e for i, e in v if i == q)
        found = sorted((-int(mine @ e), i) for i, e in v if i != q and len(e) == len(mine))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return out


def test_against_brute_force(frame):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(12, 40))
    rows = [(i, (base[i % 12] + 0.3 * rng.normal(size=40)).astype(np.float32).tolist(), "c") for i in range(300)]
    rows += [(300, None, None), (301, [1.0, None] + [0.0] * 38, None), (302, [float("nan")] * 40, "c"), (303, [], None),
             (304, [1.0] * 7, None), (305, [2.0] * 7, None), (None, [1.0] * 40, None), (310, [0.0] * 40, "c"), (311, rows[3][1], "c"), (312, rows[3][1], "c")]
    got = topk.top_k(frame(rows, SCHEMA).repartition(4), F.col("vec_id") % 5 == 0, 5)
    assert sorted(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()) == sorted(brute(rows, 5))


def test_pruning_keeps_ties_and_large_numbers():
    rng = np.random.default_rng(4)
    block = rng.integers(-3, 4, (48, 500))
    ids = rng.permutation(500)
    q = rng.integers(-3, 4, (48, 6))
    for scale in (1, 2 ** 26):
        got = {i: (a.tolist(), s.tolist()) for i, a, s in topk.block_top_k(q * scale, np.arange(6), block, ids, 5)}
        for i in range(6):
            s = (q[:, i] * scale) @ block
            want = sorted((-int(x), int(j)) for x, j in zip(s, ids) if j != i)[:5]
            assert got[i] == ([j for _, j in want], [-x for x, _ in want])


def test_empty_and_alone(frame):
    assert topk.top_k(frame([], SCHEMA), F.col("vec_id") % 5 == 0).count() == 0
    assert topk.top_k(frame([(0, [1.0], None)], SCHEMA), F.col("vec_id") % 5 == 0).count() == 0


def test_query_blocks_are_sent_once_and_in_turns(frame, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, rng.integers(-2, 3, 20 if i % 9 else 6).astype(float).tolist(), "c") for i in range(400)]
    rows += [(5000, [1.0] * 11, None)]  # a query without candidates
    monkeypatch.setattr(topk, "BLOCK_ROWS", 32)
    monkeypatch.setattr(topk, "QUERY_ROWS", 8)
    one = topk.top_k(frame(rows, SCHEMA).repartition(3), F.col("vec_id") % 5 == 0, 5)
    plan = one._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "strategy=broadcast" in plan  # no copy of a query block per candidate block
    assert sorted(map(tuple, one.collect())) == sorted(brute(rows, 5))
    monkeypatch.setattr(topk, "SENT_BYTES", 3000)
    several = topk.top_k(frame(rows, SCHEMA).repartition(3), F.col("vec_id") % 5 == 0, 5)
    assert several._jdf.queryExecution().optimizedPlan().toString().count("Relation") > 2
    assert sorted(map(tuple, several.collect())) == sorted(brute(rows, 5))


def test_known_scores_leave_out_lower_ones_only():
    rng = np.random.default_rng(6)
    block, q, ids = rng.integers(-3, 4, (48, 300)), rng.integers(-3, 4, (48, 7)), rng.permutation(300)
    for scale in (1, 2 ** 26):
        scores = (q * scale).T @ block
        least = np.sort(scores, axis=1)[:, -3].astype(float)
        got = {i: (a.tolist(), s.tolist()) for i, a, s in topk.block_top_k(q * scale, np.arange(7) + 1000, block, ids, 5, least=least)}
        for i in range(7):
            want = sorted((-int(x), int(j)) for x, j in zip(scores[i], ids) if x >= least[i])[:5]
            assert list(zip(*got[i]))[:len(want)] == [(j, -x) for x, j in want]
