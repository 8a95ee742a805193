"""Edit-aware token counts: a segment tree of pre-token segments per document.

A text is cut into segments at borders where the pre-tokeniser always starts a new pre-token (a single space between
two other characters), so segments are encoded alone with the same ids as in the whole text.  The leaves of a
document's tree hold the segments' lengths and token counts, the inner nodes their sums.  An edit descends to the
segments it touches, with one character of context on either side of the borders, re-encodes only those, and updates
the sums above them; where the number of segments changes, the tree is rebuilt from its leaves without encoding.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from vitrine.llm import bpe

#: Characters per segment aimed at.
SEGMENT = 512


def safe_border(text: str, at: int) -> bool:
    """Whether a pre-token always starts at ``at``: a single space between two characters that are none."""
    return 0 < at < len(text) - 1 and text[at] == " " and not text[at - 1].isspace() and not text[at + 1].isspace()


def segments(text: str, segment: int = SEGMENT) -> list[str]:
    """The text in pieces of about ``segment`` characters; a stretch without safe borders stays whole."""
    out, start = [], 0
    while len(text) - start > segment:
        at = text.find(" ", start + segment)
        while at >= 0 and not safe_border(text, at):
            at = text.find(" ", at + 1)
        if at < 0:
            break
        out.append(text[start:at])
        start = at
    out.append(text[start:])
    return out


class Tree:
    """Segment tree over leaves (characters, tokens); node i has the children 2i and 2i + 1, leaves from ``width`` on."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.n = len(chars)
        self.width = 1 << max(0, (self.n - 1).bit_length())
        self.chars, self.tokens = ([0] * self.width + x + [0] * (self.width - self.n) for x in (chars, tokens))
        for i in range(self.width - 1, 0, -1):
            self._sum(i)

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    def leaves(self) -> tuple[list[int], list[int]]:
        return self.chars[self.width:self.width + self.n], self.tokens[self.width:self.width + self.n]

    def find(self, at: int) -> tuple[int, int]:
        """(leaf, its first character) of the leaf that holds character ``at``; past the end: the last leaf."""
        node, first = 1, 0
        while node < self.width:
            node *= 2
            if at >= first + self.chars[node] and self.chars[node + 1]:
                first += self.chars[node]
                node += 1
        return min(node - self.width, self.n - 1), first

    def replace(self, lo: int, hi: int, chars: list[int], tokens: list[int]) -> None:
        """Put new leaves in the place of leaves lo to hi - 1."""
        if len(chars) == hi - lo:
            for j, (c, t) in enumerate(zip(chars, tokens), lo):
                i = self.width + j
                self.chars[i], self.tokens[i] = c, t
                while i > 1:
                    i //= 2
                    self._sum(i)
            return
        c, t = self.leaves()
        self.__init__(c[:lo] + chars + c[hi:], t[:lo] + tokens + t[hi:])


def build(text: str, count: Callable[[str], int], segment: int = SEGMENT) -> Tree:
    pieces = segments(text, segment)
    return Tree([len(p) for p in pieces], [count(p) for p in pieces])


def edit(text: str, tree: Tree, start: int, delete: int, insert: str, count: Callable[[str], int],
         segment: int = SEGMENT) -> tuple[str, int]:
    """(edited text, characters encoded) after replacing ``delete`` characters from ``start`` on; updates ``tree``.

    Places beyond the text are moved to its end.
    """
    start = min(max(start, 0), len(text))
    delete = min(max(delete, 0), len(text) - start)
    lo, first = tree.find(max(0, start - 2))
    hi, last = tree.find(start + delete + 1)
    end = last + tree.chars[tree.width + hi]
    after = text[:start] + insert + text[start + delete:]
    region = after[first:end + len(insert) - delete]
    pieces = segments(region, segment)
    tree.replace(lo, hi + 1, [len(p) for p in pieces], [count(p) for p in pieces])
    return after, len(region)


_TREE = [StructField("n_tokens", LongType()), StructField("leaf_chars", ArrayType(IntegerType())),
         StructField("leaf_tokens", ArrayType(IntegerType()))]
EDIT_DDL = "array<struct<start:int,delete:int,insert:string>>"


def _int_lists(rows: list[list[int]]) -> pa.ListArray:
    at = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array([x for r in rows for x in r], pa.int32()))


def with_trees(docs: DataFrame, tokenizer: str, text_col: str = "text", segment: int = SEGMENT) -> DataFrame:
    """``docs`` with n_tokens and the leaves of each text's tree (leaf_chars, leaf_tokens).

    Tokens are ids of the byte-level BPE ``tokenizer``; a null text counts as empty (one empty leaf).  Columns of
    ``docs`` with those three names are replaced; all rows stay, also repeated ones.
    """
    kept = [f for f in docs.schema.fields if f.name not in {t.name for t in _TREE}]
    names = [f.name for f in kept]
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = bpe.encoder(tokenizer).encode_ordinary
        for batch in batches:
            trees = [build(t.as_py() or "", lambda s: len(encode(s)), segment) for t in batch.column(at)]
            leaves = [t.leaves() for t in trees]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([t.total for t in trees], pa.int64()),
                                              _int_lists([c for c, _ in leaves]), _int_lists([t for _, t in leaves])],
                                             names=[*names, *(t.name for t in _TREE)])

    return docs.select(*[F.col(f"`{n}`") for n in names]).mapInArrow(run, StructType([*kept, *_TREE]))


def apply_edits(counted: DataFrame, tokenizer: str, edits_col: str = "edits", text_col: str = "text", segment: int = SEGMENT,
                columns: list[str] | None = None) -> DataFrame:
    """Rows of ``with_trees`` after their edits, done one after the other: text and tree are those after the edits,
    encoded_chars is how many characters had to be encoded again.

    ``edits_col`` holds ``EDIT_DDL``; null or empty: no edit.  A null text with edits is edited as an empty one.  The
    edits column goes; ``columns`` names the columns to return besides the tree's and encoded_chars (default: all).
    """
    tree_names = [t.name for t in _TREE]
    kept = [f for f in counted.schema.fields if f.name not in {*tree_names, edits_col, "encoded_chars", text_col}
            and (columns is None or f.name in columns)]
    names = [f.name for f in kept]
    with_text = columns is None or text_col in columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = bpe.encoder(tokenizer).encode_ordinary
        for batch in batches:
            n = len(names)
            texts, edits, chars, tokens = (batch.column(n + i) for i in range(4))
            out, trees, work = [], [], []
            for text, todo, c, t in zip(texts, edits, chars, tokens):
                now, tree, encoded = text.as_py(), Tree(c.as_py(), t.as_py()), 0
                for e in todo.as_py() or ():
                    now, size = edit(now or "", tree, e["start"] or 0, e["delete"] or 0, e["insert"] or "", lambda s: len(encode(s)), segment)
                    encoded += size
                out.append(now)
                trees.append(tree)
                work.append(encoded)
            leaves = [t.leaves() for t in trees]
            texts_out = [pa.array(out, pa.string())] if with_text else []
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n], *texts_out, pa.array([t.total for t in trees], pa.int64()), _int_lists([c for c, _ in leaves]),
                 _int_lists([t for _, t in leaves]), pa.array(work, pa.int64())],
                names=[*names, *([text_col] if with_text else []), *tree_names, "encoded_chars"])

    source = counted.select(*[F.col(f"`{n}`") for n in names], F.col(f"`{text_col}`").cast("string"),
                            F.col(f"`{edits_col}`").cast(EDIT_DDL), "leaf_chars", "leaf_tokens")
    texts = [StructField(text_col, StringType())] if with_text else []
    return source.mapInArrow(run, StructType([*kept, *texts, *_TREE, StructField("encoded_chars", LongType())]))
