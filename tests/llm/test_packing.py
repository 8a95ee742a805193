import zlib
from array import array

import numpy as np
import pytest

from vitrine.llm import bpe, packing

SCHEMA = "doc_id long, text string, sequence_id string"


def test_fast_ids_equal_the_library(spark):
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(bpe.default_path())
    texts = ["Hello, it's 12 o'clock", "", "a  b\n\n c\t", "é" * 50 + " naïve 漢字 🙂🙂", "<|endoftext|> x", "hi <|endoftext|> there", "a<|endoftext|><|endoftext|>", " " * 300 + "y", "x!" * 100]
    encode = bpe.encoder(bpe.default_path()).encode
    assert [encode(t) for t in texts] == [slow.encode(t, add_special_tokens=False).ids for t in texts]


def test_very_long_white_space_is_encoded():
    assert len(bpe.encoder(bpe.default_path()).encode(" " * 400_000 + "a")) > 0


def test_best_fit_is_tight_and_complete():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 101, 3000)
    bins = packing.best_fit(sizes, 100)
    assert sorted(i for b in bins for i in b) == list(range(3000))
    assert max(sizes[b].sum() for b in bins) <= 100
    assert len(bins) <= 1.01 * np.ceil(sizes.sum() / 100) + 1


@pytest.mark.parametrize("parts,group_items", [(1, 8192), (7, 3)])
def test_round_trip(spark, frame, parts, group_items):
    rng = np.random.default_rng(2)
    words = ["alpha", "beta", "gamma,", "delta", "x1", "\n"]
    rows = [(i, " ".join(rng.choice(words, int(n))), "clash") for i, n in enumerate(rng.integers(0, 400, 60))]
    rows += [(100, None, None), (101, "", "c"), (102, "word " * 3000, None), (102, "word " * 3000, None), (None, "no id", "c")]
    got = packing.pack(frame(rows, SCHEMA).repartition(parts), bpe.default_path(), 256, group_items=group_items).collect()
    encode = bpe.encoder(bpe.default_path()).encode
    want = []
    for doc, text, _ in rows:
        ids = encode(text or "") + [0]
        first = (len(ids) - 1) % 256 + 1
        cuts = [0, *range(first, len(ids) + 1, 256)]
        for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want.append((doc if doc is not None else -1, p, a, b - a, zlib.crc32(array("I", ids[a:b]).tobytes())))
    have = [(r.doc_id if r.doc_id is not None else -1, r.piece, r.start, r.length, r.ids_crc32) for r in got]
    assert sorted(have) == sorted(want)
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(r.length for r in got)
    assert len(places) <= np.ceil(total / 256) * 1.1 + 1


def test_empty_table(frame):
    assert packing.pack(frame([], SCHEMA), bpe.default_path()).count() == 0
