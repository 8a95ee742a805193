import numpy as np

from vitrine.llm import near_embed as N

SCHEMA = "vec_id long, embedding array<double>, n_links string"


def brute(rows, threshold=0.95):
    v = {i: np.array(e, float) / np.abs(e).max() for i, e, _ in rows if i is not None and e and all(x is not None and np.isfinite(x) for x in e) and np.any(e)}
    links = {i: set() for i, _, _ in rows}
    for a in v:
        for b in v:
            if a != b and len(v[a]) == len(v[b]) and v[a] @ v[b] / np.linalg.norm(v[a]) / np.linalg.norm(v[b]) >= threshold:
                links[a].add(b)
    out = []
    for i, _, _ in rows:
        if i is None:
            out.append((None, 0, None))
            continue
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out.append((i, len(links[i]), min(seen)))
    return sorted(out, key=str)


def rows_of(n, seed, noise=0.05):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 4, 24))
    return [(i, (base[i % len(base)] * (1 + i % 3) + noise * rng.normal(size=24)).tolist(), "c") for i in range(n)]


def found(result):
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in result.rows.collect()), key=str)


def test_against_brute_force(frame):
    rows = rows_of(400, 5) + [(900, None, None), (901, [0.0] * 24, "c"), (902, [float("inf")] + [1.0] * 23, "c"), (903, [None] * 24, "c"),
                              (904, [1.0, 2.0], None), (905, [2.0, 4.0], None), (None, [1.0] * 24, None), (906, [1e200] * 24, "c"), (907, [1e-200] * 24, "c")]
    got = N.near_duplicates(frame(rows, SCHEMA).repartition(3), shard_rows=60)
    assert got.recall >= 0.98
    a, b = found(got), brute(rows)
    assert [x[0] for x in a] == [x[0] for x in b]
    assert sum(x[1] for x in a) >= 0.97 * sum(x[1] for x in b) and all(x[1] <= y[1] for x, y in zip(a, b))
    kept = {r.vec_id: r.kept for r in got.rows.collect()}
    assert kept[900] and kept[901]


def test_large_shard_is_tiled(frame):
    rng = np.random.default_rng(6)
    one = rng.normal(size=24)
    rows = [(i, (one + 0.02 * rng.normal(size=24)).tolist(), None) for i in range(300)] + rows_of(100, 7)
    rows = [(i, e, c) for i, (_, e, c) in enumerate(rows)]
    got = N.near_duplicates(frame(rows, SCHEMA), shard_rows=400, max_rows=80)
    assert found(got) == brute(rows)


def test_copies_keep_their_links(frame):
    """Hundreds of equal vectors, and of vectors that differ in double precision only."""
    rng = np.random.default_rng(8)
    one, two = rng.normal(size=24), rng.normal(size=24)
    rows = [one.tolist()] * 300 + (one + 0.02 * rng.normal(size=(20, 24))).tolist() + (two + 1e-10 * rng.normal(size=(300, 24))).tolist()
    rows = [(i, e, None) for i, e in enumerate(rows + rng.normal(size=(100, 24)).tolist())]
    rng.shuffle(rows)
    rows = [(int(i), e, c) for i, e, c in rows]
    got = N.near_duplicates(frame(rows, SCHEMA), shard_rows=400)
    assert found(got) == brute(rows)


def test_all_pairs_where_the_audit_fails(frame, monkeypatch):
    monkeypatch.setattr(N, "LEAST_RECALL", 1.1)
    rows = rows_of(200, 9) + [(900 + i, [1.0, 2.0], None) for i in range(30)]
    got = N.near_duplicates(frame(rows, SCHEMA), shard_rows=60, max_rows=80)
    assert found(got) == brute(rows) and got.recall == 1.0


def test_empty(frame):
    assert N.near_duplicates(frame([], SCHEMA)).rows.count() == 0
    assert found(N.near_duplicates(frame([(3, [1.0, 0.0], None)], SCHEMA))) == [(3, 0, 3)]
