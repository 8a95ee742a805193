import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.llm import bpe
from vitrine.llm import token_counts as T

PATH = bpe.default_path()
COUNT = lambda s: len(bpe.encoder(PATH).encode(s))


def random_text(rng, n):
    parts = ["word", " ", "  ", "\n", "it's", "12", "!?", "é漢", " the", " a", "\t", "'s", " x"]
    return "".join(rng.choice(parts, n))


@pytest.mark.parametrize("segment", [1, 8, 64])
def test_any_edit_equals_a_full_count(segment):
    rng = np.random.default_rng(14)
    for _ in range(60):
        text = random_text(rng, int(rng.integers(0, 120)))
        tree = T.build(text, COUNT, segment)
        assert tree.total == COUNT(text) and sum(tree.leaves()[0]) == len(text)
        for _ in range(6):
            start, delete = int(rng.integers(0, len(text) + 3)), int(rng.integers(0, 12))
            insert = random_text(rng, int(rng.integers(0, 6)))
            at = min(start, len(text))
            want = text[:at] + insert + text[at + delete:]
            text, _ = T.edit(text, tree, start, delete, insert, COUNT, segment)
            assert text == want and tree.total == COUNT(text) and sum(tree.leaves()[0]) == len(text)
            assert sum(tree.leaves()[1]) == tree.total


def test_only_the_region_is_encoded():
    text = "some words in a row " * 5000
    seen = []
    tree = T.build(text, COUNT)
    T.edit(text, tree, 50_000, 3, "new", lambda s: seen.append(len(s)) or COUNT(s))
    assert sum(seen) < 3 * T.SEGMENT


def test_table(frame):
    rows = [(1, "hello world " * 400, "c"), (1, "hello world " * 400, "c"), (2, None, None), (3, "", "c"), (None, "x y", None), (4, "word " * 300_000, None)]
    docs = T.with_trees(frame(rows, "doc_id long, text string, n_tokens string"), PATH)
    assert [r.n_tokens for r in docs.where("doc_id = 3").collect()] == [0]
    edits = F.when(F.col("doc_id") == 3, F.lit(None)).otherwise(F.array(F.struct(F.lit(4).alias("start"), F.lit(3).alias("delete"), F.lit(" new").alias("insert"))))
    got = T.apply_edits(docs.withColumn("edits", edits), PATH)
    assert got.columns == ["doc_id", "text", "n_tokens", "leaf_chars", "leaf_tokens", "encoded_chars"] and got.count() == 6
    for r in got.collect():
        assert r.n_tokens == COUNT(r.text or "") == sum(r.leaf_tokens)
    by = {r.doc_id: r for r in got.collect()}
    assert by[2].text == " new" and by[3].text == "" and by[1].text.startswith("hell neworld")
    assert T.with_trees(frame([], "doc_id long, text string"), PATH).count() == 0
