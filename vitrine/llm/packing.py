"""Best-fit packing of tokenised documents into sequences: hierarchical residual packing.

Leaves: every input partition tokenises its documents, cuts the long ones, and packs its pieces best-fit decreasing;
nearly full sequences are final.  Tree: the underfull ones travel on as single items; groups of a bounded number of
them are packed best-fit again, nearly full ones become final, and so on until one group holds what is left or a round
no longer merges anything.  Only underfull sequences are ever shuffled, as (document, piece) references without text.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm import bpe
from vitrine.llm.scratch import Scratch

#: Pieces one leaf holds before it packs them (bounds its memory, not the result's completeness).
LEAF_PIECES = 200_000
#: Underfull sequences that one group of the tree packs.
GROUP_ITEMS = 8_192
#: A sequence with at most this share of its room left is nearly full.
SLACK = 1 / 256

_MEMBER = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                     ("ids_crc32", pa.int64()), ("offset", pa.int64())])
_BIN = pa.schema([("fill", pa.int32()), ("closed", pa.bool_()), ("members", pa.list_(_MEMBER))])
_BIN_DDL = ("fill int, closed boolean, "
            "members array<struct<doc_id:bigint,piece:int,start:bigint,length:bigint,ids_crc32:bigint,offset:bigint>>")


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Best-fit decreasing: every item goes where the least room is left over; returns item numbers per sequence.

    ``rooms`` is a bit set of the amounts of room that some open sequence has, so one fit costs a shift and a mask.
    """
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    bins: list[list[int]] = []
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = open_at[room].pop()
            if not open_at[room]:
                rooms &= ~(1 << room)
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        if left := room - size:
            open_at[left].append(b)
            rooms |= 1 << left
    return bins


def _table(bins: list[list[int]], sizes: np.ndarray, members: pa.StructArray, member_offsets: np.ndarray,
           capacity: int, slack: int) -> pa.Table:
    """Sequences as rows: the members of their items one after the other, each with its offset there."""
    counts = np.array([len(b) for b in bins], dtype=np.int64)
    order = np.array([i for b in bins for i in b], dtype=np.int64)
    fill = np.add.reduceat(sizes[order], np.concatenate([[0], np.cumsum(counts)[:-1]]))
    spans = np.diff(member_offsets)[order]
    take = np.repeat(member_offsets[order] - np.concatenate([[0], np.cumsum(spans)[:-1]]), spans) + np.arange(spans.sum())
    per_bin = np.add.reduceat(spans, np.concatenate([[0], np.cumsum(counts)[:-1]]))
    offsets = np.concatenate([[0], np.cumsum(per_bin)]).astype(np.int32)
    members = members.take(pa.array(take))
    before = np.cumsum(members.field("length").to_numpy()) - members.field("length").to_numpy()
    place = pa.array(before - np.repeat(before[offsets[:-1]], per_bin))
    members = pa.StructArray.from_arrays([*members.flatten()[:-1], place], fields=list(_MEMBER))
    return pa.table([pa.array(fill, pa.int32()), pa.array(fill >= capacity - slack),
                     pa.ListArray.from_arrays(pa.array(offsets), members)], schema=_BIN)


def _leaf(path: str, capacity: int, slack: int, leaf_pieces: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = bpe.encoder(path).encode
        columns: list[list[int]] = [[] for _ in _MEMBER]

        def flush() -> Iterator[pa.RecordBatch]:
            if columns[0]:
                sizes = np.array(columns[3], dtype=np.int64)
                members = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _MEMBER)], fields=list(_MEMBER))
                yield from _table(best_fit(sizes, capacity), sizes, members, np.arange(len(sizes) + 1), capacity, slack).to_batches(20_000)
                for c in columns:
                    c.clear()

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = array("I", encode(text.as_py() or ""))
                raw.append(0)
                first = (len(raw) - 1) % capacity + 1
                start = 0
                for piece, end in enumerate(range(first, len(raw) + 1, capacity)):
                    part = raw[start:end]
                    for column, value in zip(columns, (doc, piece, start, end - start, zlib.crc32(part.tobytes()), 0)):
                        column.append(value)
                    start = end
            if len(columns[0]) >= leaf_pieces:
                yield from flush()
        yield from flush()

    return run


def _merge(capacity: int, slack: int):
    def run(table: pa.Table) -> pa.Table:
        sizes = table.column("fill").to_numpy().astype(np.int64)
        lists = table.column("members").combine_chunks()
        lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
        at = lists.offsets.to_numpy().astype(np.int64)
        return _table(best_fit(sizes, capacity), sizes, lists.flatten(), at - at[0], capacity, slack)

    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text",
         group_items: int = GROUP_ITEMS, leaf_pieces: int = LEAF_PIECES) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is the ids of its whole text (byte-level BPE of ``tokenizer``; a null or empty text has none) and the
    id 0.  Longer ones are cut into pieces of ``capacity`` ids, the first piece taking the remainder.  Every row is a
    document of its own, also repeated ones and rows without an id; other columns of ``docs`` are ignored.  An empty
    table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "pack")
    slack = int(capacity * SLACK)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    bins = scratch.write(rows.mapInArrow(_leaf(tokenizer, capacity, slack, leaf_pieces), _BIN_DDL), "leaves")
    done = [bins.where("closed")]
    rest, left, turn = bins.where("NOT closed"), None, 0
    while True:
        now = rest.count()
        if now <= 1 or (left is not None and (left <= group_items or now > 0.98 * left)):
            break
        left, turn = now, turn + 1
        groups = -(-now // group_items)
        # the row's own number of the written table is part of the key: equal members spread over the groups
        keyed = rest.withColumn("g", F.pmod(F.xxhash64(F.col("members")[0], F.monotonically_increasing_id(), F.lit(turn)), F.lit(groups)))
        merged = scratch.write(keyed.groupBy("g").applyInArrow(_merge(capacity, slack), _BIN_DDL), f"round-{turn}")
        done.append(merged.where("closed"))
        rest = merged.where("NOT closed")
    sequences = rest
    for d in done:
        sequences = sequences.unionByName(d)
    numbered = sequences.select(F.monotonically_increasing_id().alias("sequence_id"), "members")
    return numbered.select("sequence_id", F.explode("members").alias("m")).select("m.doc_id", "m.piece", "m.start", "m.length", "m.ids_crc32", "sequence_id", "m.offset")
