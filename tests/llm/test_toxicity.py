import os
import zlib
from itertools import combinations

import numpy as np
import pytest

from vitrine.llm import queries, toxicity as T

SF = "/root/testdata/sf0.01"
INSULTS = ["grobnik", "plisterad", "vuxom", "dunfle"]


def words_of(texts):
    letters, start, end, text = T.spans(*T._packed(texts))
    return [(int(t), "".join(chr(96 + c) for c in letters[s:e])) for s, e, t in sorted(zip(start, end, text), key=lambda x: (x[2], x[0]))]


def test_words():
    assert words_of(["The i d i o t, St.u-p*1d! ##", "", "a b", "c"]) == [
        (0, "the"), (0, "idiot"), (0, "stupid"), (2, "ab"), (3, "c")]
    long = words_of(["x" * 24 + "y" * 12 + " z" * 40])
    assert [w for _, w in long] == ["x" * 24, "x" * 12 + "y" * 12, "z" * 24, "z" * 24, "z" * 16]


def test_subsequences_by_definition():
    for word in ("a", "ab", "banana", "worthless"):
        chain = [31, *(ord(c) - 96 for c in word), 31]
        want: dict[int, float] = {}
        for i, j, k in combinations(range(len(chain)), 3):
            if k - i < T.WITHIN:
                code = chain[i] << 10 | chain[j] << 5 | chain[k]
                want[code] = want.get(code, 0) + T.DECAY ** (k - i - 2)
        letters, start, end, _ = T.spans(*T._packed([word]))
        _, code, weight = T.subsequences(letters, start, end)
        assert dict(zip(code.tolist(), weight.tolist())) == pytest.approx(want)
        table = np.zeros((1 << 15, 1))
        table[code, 0] = weight / np.linalg.norm(weight)
        assert T.kernel_with(letters, start, end, table)[0, 0] == pytest.approx(1)


def corpus(n=600, seed=1):
    rng = np.random.default_rng(seed)
    parts = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "ou", "st", "ing", "ly"]
    rows = []
    for i in range(n):
        own = ["".join(rng.choice(parts, rng.integers(1, 5))) for _ in range(rng.integers(5, 120))]
        toxic = i % 5 == 0
        if toxic and i % 15:
            for _ in range(rng.integers(1, 4)):
                own.insert(int(rng.integers(0, len(own))), str(rng.choice(INSULTS)))
        rows.append((i, " ".join(w + (". " if rng.random() < 0.1 else "") for w in own), int(toxic), toxic and bool(i % 15)))
    return rows


def test_learns_and_tolerates(frame):
    rows = corpus()
    docs = frame([(i, t, "c") for i, t, _, _ in rows] + [(1000, None, "c"), (1001, "", "c"), (1002, "?! ..", "c"), (1003, "re " * 50_000 + "grobnik", "c"),
                                                        (None, "the dunfle", None), (7, rows[7][1], "c")], "doc_id long, text string, score string")
    labels = frame([(i, x) for i, _, x, _ in rows if i % 2] + [(1000, 1), (1001, 0), (3, None), (None, 1), (5, 7)], "doc_id long, toxic int")
    model = T.fit(docs, labels)
    got = {r["doc_id"]: r["score"] for r in T.score(docs, model).collect()}
    assert len(got) == 605 and all(0 <= s <= 1 for s in got.values())
    assert all((got[i] >= 0.5) == bad for i, _, _, bad in rows)
    assert got[1003] >= 0.5 and got[None] >= 0.5 and got[1000] == got[1001] == got[1002] < 0.5
    tried = ["g.r.o.b.n.i.k", "g r o b n i k", "GROBNIK", "gro-bnik", "grobxnik", "plisterrad", "pl*sterad", "dun-fle", "plizsterad"]
    texts = [f"the {w} in ed" for w in tried] + ["the thering in ed", "on", "grand an"]
    scores = model.scores(T._Scorer(model)(*T._packed(texts)))
    assert [bool(s >= 0.5) for s in scores] == [True] * len(tried) + [False] * 3


def test_words_met_before_score_alike(monkeypatch):
    rows = corpus(80)
    model = T.learn(*(np.array(x) for x in zip(*[(i, x) for i, _, x, _ in rows])), [t for _, t, _, _ in rows])
    fresh = [T._Scorer(model)(*T._packed([t]))[0] for _, t, _, _ in rows]
    monkeypatch.setattr(T, "KEPT_WORDS", 300)
    scorer = T._Scorer(model)
    assert [scorer(*T._packed([t]))[0] for _, t, _, _ in rows] == pytest.approx(fresh)


def test_empty_tables(frame):
    docs, labels = frame([], "doc_id long, text string"), frame([], "doc_id long, toxic int")
    assert T.score(docs, T.fit(docs, labels)).count() == 0
    some = frame([(1, "a b"), (2, None)], "doc_id long, text string")
    a, b = (r.score for r in T.score(some, T.fit(some, labels)).collect())
    assert a == b < 0.5


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_held_out(spark, frame):
    rows = queries.op11_toxicity(spark, SF).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(docs) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    unseen = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    # about a twentieth of all labels is noise
    assert np.mean([a == b for a, b in unseen]) >= 0.9 and all(b == 1 for a, b in unseen if a == 1)
    assert sum(a for a, _ in unseen) >= 3
