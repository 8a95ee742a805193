"""Exact n-gram Jaccard join: size-banded tiles, hashed bitmap signatures, exact sorted-array intersection.

Sets of w-word shingles (as 64-bit hashes) with Jaccard similarity s or more differ in at most a (1 - s) / (1 + s) share
of their summed sizes.  Sizes fall into bands; a tile takes one band and the smaller sets that are large enough to pair
with it.  Per tile the hash space is cut into more equal ranges than two linked sets can differ in, so linked
sets agree on at least one range entirely: the cells of a tile are the digests of ranges, and every linked pair shares a
cell.  Within a cell, bit counts of hashed bitmaps bound the overlap from above, and pairs that pass are verified on the
sorted arrays.

No cell is expanded into all pairs: members are first compared with one leader of the cell, then with another; only
cells whose members still lie in different components are compared further, in tiles of bounded size, and only across
components.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm import words
from vitrine.llm.components import connected_components
from vitrine.llm.scratch import Scratch

U64 = np.uint64
#: Passes over the cells.
PASSES = 8
#: Documents per block of a cell that is compared in tiles.
BLOCK = 256

_PROFILE_DDL = "doc_id long, n long, cls long, bitmap binary, cells array<long>"


class Bands:
    """Size bands and cuts for similarity num / den; a pure function of the two numbers."""

    def __init__(self, num: int, den: int, ratio: float = 1.2):
        self.num, self.den = num, den
        edges = [1]
        while edges[-1] < 1 << 40:
            edges.append(max(edges[-1] + 1, int(edges[-1] * ratio)))
        self.lows = np.array(edges, dtype=np.int64)
        self._cuts: dict[int, tuple[int, int]] = {}

    def _cut(self, tile: int) -> tuple[int, int]:
        """(ranges, spare) of a tile: one range more than two linked sets of its sizes can differ in, and spare ones.

        So many empty ranges need no cell of their own; the spare covers what a set of the tile's smallest size leaves
        empty by chance (mean and four deviations), since cells of empty ranges would hold unrelated sets.
        """
        if tile not in self._cuts:
            low, high = int(self.lows[tile]), int(self.lows[tile + 1]) - 1
            differ = 2 * high * (self.den - self.num) // (self.den + self.num)
            spare = min(1, differ)
            for _ in range(6 if differ else 0):
                ranges = differ + 1 + spare
                empty = ranges * math.exp(-low * self.num / self.den / ranges)
                spare = max(1, min(differ, math.ceil(empty + 4 * math.sqrt(empty))))
            self._cuts[tile] = differ + 1 + spare, spare
        return self._cuts[tile]

    def tiles(self, n: int) -> list[tuple[int, int, int]]:
        """(tile, ranges, empty ranges that may go unnamed) of a set of n >= 1 shingles."""
        own = int(np.searchsorted(self.lows, n, side="right")) - 1
        out = []
        tile = own
        while tile == own or n * self.den >= self.num * int(self.lows[tile]):
            out.append((tile, *self._cut(tile)))
            tile += 1
        return out

    def least_overlap(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Smallest intersection of two sets of sizes a and b whose similarity is num / den or more."""
        return -(-self.num * (a + b) // (self.num + self.den))


def cell_keys(shingles: np.ndarray, bands: Bands) -> np.ndarray:
    """Cells of a sorted shingle array: one key per tile and range of the hash space.

    Two linked sets share at least 1 + spare ranges.  If at most ``spare`` ranges of a set are empty, one of the shared
    ones is not, so its empty ranges get no key; a set with more empty ranges names them all.
    """
    keys = []
    mixed = words.mix(shingles ^ U64(0xA5A5A5A5A5A5A5A5))
    for tile, ranges, spare in bands.tiles(len(shingles)):
        part = ((shingles >> U64(32)) * U64(ranges)) >> U64(32)
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        digests = np.add.reduceat(mixed, first)
        named, values = part[first], digests
        if ranges - len(first) > spare:
            values = np.zeros(ranges, dtype=U64)
            values[named.astype(np.int64)] = digests
            named = np.arange(ranges, dtype=U64)
        keys.append(words.mix(values + words.mix(named + U64(tile * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))))
    return np.concatenate(keys)


def bitmap(shingles: np.ndarray) -> bytes:
    """Hashed bitmap with 8 to 16 bits per shingle (a power of two between 64 and 65,536 bits)."""
    bits = min(65_536, max(64, 8 << int(len(shingles)).bit_length()))
    out = np.zeros(bits, dtype=np.uint8)
    out[(words.mix(shingles) & U64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(out, bitorder="little").tobytes()


def _folded(raw: bytes, size: int) -> np.ndarray:
    b = np.frombuffer(raw, dtype=np.uint8)
    while len(b) > size:
        b = b[:len(b) // 2] | b[len(b) // 2:]
    return b


def may_link(a: bytes, b: bytes, n_a: int, n_b: int, bands: Bands) -> bool:
    """False only if the bitmaps prove that the overlap is too small: each bit of one side that the other lacks stands
    for at least one shingle outside the overlap."""
    least = int(bands.least_overlap(np.int64(n_a), np.int64(n_b)))
    size = min(len(a), len(b))
    x, y = _folded(a, size), _folded(b, size)
    x, y = x.view(U64), y.view(U64)
    only_a, only_b = int(np.bitwise_count(x & ~y).sum()), int(np.bitwise_count(y & ~x).sum())
    return min(n_a - only_a, n_b - only_b) >= least


def _class(shingles: np.ndarray) -> int:
    """Number of the class of equal sets (64 bits of a digest of the sorted array)."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def _profiles(size: int, bands: Bands):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, classes, maps, keys = [], [], [], []
            for s in words.text_shingle_sets(batch.column(1), size):
                n.append(len(s))
                classes.append(_class(s) if len(s) else None)
                maps.append(bitmap(s) if len(s) else None)
                keys.append(cell_keys(s, bands).view(np.int64) if len(s) else np.zeros(0, np.int64))
            at = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(classes, pa.int64()),
                                              pa.array(maps, pa.binary()), lists], names=["doc_id", "n", "cls", "bitmap", "cells"])

    return run


def _survivors(bands: Bands):
    """Pairs (a, b) that the bitmaps leave."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a_map, b_map, a_n, b_n = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("a_map", "b_map", "a_n", "b_n"))
            keep = [may_link(*x, bands) for x in zip(a_map, b_map, a_n, b_n)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _verified(size: int, bands: Bands):
    """Pairs of classes whose shingle sets are similar enough, from two whole texts.

    An id may carry several texts: only those of the classes asked for count.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int | None, np.ndarray] = (None, np.zeros(0, U64))
        for batch in batches:
            a, b, a_text, b_text = batch.columns
            keep = []
            for i, ours in enumerate(words.text_shingle_sets(b_text, size)):
                if last[0] != a[i].as_py():
                    theirs = next(words.text_shingle_sets(a_text.slice(i, 1), size))
                    last = _class(theirs), theirs
                if last[0] != a[i].as_py() or _class(ours) != b[i].as_py():
                    keep.append(False)
                    continue
                theirs = last[1]
                shared = len(np.intersect1d(ours, theirs, assume_unique=True))
                keep.append(bands.den * shared >= bands.num * (len(ours) + len(theirs) - shared))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def _tile_pairs(bands: Bands):
    """Pairs of one tile of a cell that lie in different components and that sizes and bitmaps leave."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.sort_by([("n", "ascending"), ("cls", "ascending")]).to_pydict()
        i_block, j_block = rows["i"][0], rows["j"][0]
        rep, comp, n, block = (np.array(rows[c]) for c in ("cls", "component", "n", "block"))
        a_out, b_out = [], []
        size = min(len(m) for m in rows["bitmap"])
        maps = np.stack([_folded(m, size) for m in rows["bitmap"]]).view(U64)
        for k in range(len(rep) - 1):
            rest = slice(k + 1, int(np.searchsorted(n, n[k] * bands.den // bands.num, side="right")))
            other = np.arange(rest.start, max(rest.start, rest.stop))
            other = other[(comp[other] != comp[k]) & ((i_block == j_block) | (block[other] != block[k]))]
            if other.size:
                only_k = np.bitwise_count(maps[k] & ~maps[other]).sum(axis=1, dtype=np.int64)
                only_o = np.bitwise_count(maps[other] & ~maps[k]).sum(axis=1, dtype=np.int64)
                other = other[np.minimum(n[k] - only_k, n[other] - only_o) >= bands.least_overlap(n[k], n[other])]
                a_out.append(np.full(len(other), rep[k]))
                b_out.append(rep[other])
        a = np.concatenate(a_out) if a_out else np.zeros(0, np.int64)
        b = np.concatenate(b_out) if b_out else np.zeros(0, np.int64)
        return pa.table({"a": np.minimum(a, b).astype(np.int64), "b": np.maximum(a, b).astype(np.int64)})

    return run


def jaccard_groups(docs: DataFrame, size: int = 3, num: int = 90, den: int = 100, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id: one row per row of ``docs``.

    Words are maximal runs of bytes other than space and 0x09-0x0D with A-Z lower-cased; a document's set holds its
    distinct runs of ``size`` words (with fewer words: the whole sequence).  Documents link when
    den * intersection >= num * union; component_id is the smallest doc_id reachable by links, itself included.
    A null or empty text, or one without words, has an empty set and links with nothing.  Rows with one doc_id are one
    document of several texts: they share the component.  A row without a doc_id has component null, links with
    nothing.  Other columns are ignored; an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "ngram")
    bands = Bands(num, den)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    profiles = scratch.write(rows.mapInArrow(_profiles(size, bands), _PROFILE_DDL), "profiles")
    live = profiles.where(F.col("doc_id").isNotNull() & F.col("cls").isNotNull())
    # classes of equal sets, each represented by its smallest id
    classes = live.groupBy("cls").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"))
    shared = classes.where("rep < last").select("cls", "rep")
    copies = scratch.sent(live.select("cls", "doc_id").join(shared, "cls").where("doc_id != rep").select("cls", "doc_id"), "copies")
    reps = live.join(copies, ["cls", "doc_id"], "left_anti")
    # cells with several members, in passes over a share of the cells, so that one share's shuffle is on disk at a time
    shares = []
    for i in range(PASSES):
        signs = reps.select("cls", F.explode(F.filter("cells", lambda c: F.pmod(c, F.lit(PASSES)) == i)).alias("cell"))
        # repeated rows of one document may count as several members here; they become one below, and one member is no pair
        cells = signs.groupBy("cell").agg(F.count("*").alias("m")).where("m > 1")
        shares.append(scratch.write(signs.join(cells.select("cell"), "cell").distinct(), f"members-{i}"))
    members = reduce(DataFrame.unionByName, shares)
    # cells with the same members say the same: one of them stays
    same = members.groupBy("cell").agg(F.bit_xor(F.xxhash64("cls")).alias("x"), F.sum(F.col("cls").bitwiseAND(0xFFFFFFFF)).alias("s"),
                                       F.count("*").alias("m"))
    one = same.groupBy("x", "s", "m").agg(F.min("cell").alias("cell")).select("cell")
    members = scratch.write(members.join(one, "cell"), "members")
    for i in range(PASSES):
        scratch.drop(f"members-{i}")
    involved = members.select("cls").distinct()
    small = scratch.write(reps.select("cls", "doc_id", "n", "bitmap").join(involved, "cls", "left_semi").distinct(), "small")
    # only the ids and classes are needed from here on; the cells and bitmaps of all documents go
    slim = scratch.write(profiles.select("doc_id", "n", "cls"), "slim")
    scratch.drop("profiles")
    live = slim.where(F.col("doc_id").isNotNull() & F.col("cls").isNotNull())
    asked = scratch.sent(small.select("cls", "doc_id"), "asked")
    texts = scratch.write(rows.join(asked, "doc_id").select("cls", "text"), "texts")

    def verify(pairs: DataFrame, name: str) -> DataFrame:
        left, right = (small.select(F.col("cls").alias(x), F.col("n").alias(f"{x}_n"), F.col("bitmap").alias(f"{x}_map")) for x in "ab")
        known = pairs.join(left, "a").join(right, "b").where(F.least("a_n", "b_n") * den >= F.greatest("a_n", "b_n") * num)
        left_over = scratch.write(known.mapInArrow(_survivors(bands), "a long, b long"), f"{name}-pairs")
        left, right = (texts.select(F.col("cls").alias(x), F.col("text").alias(f"{x}_text")) for x in "ab")
        with_texts = left_over.join(right, "b").join(left, "a").select("a", "b", "a_text", "b_text")
        return scratch.write(with_texts.mapInArrow(_verified(size, bands), "a long, b long"), f"{name}-links")

    # an id with several texts joins their classes
    several = live.groupBy("doc_id").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).where("lo < hi").select("doc_id", "lo")
    links = live.select("doc_id", "cls").join(several, "doc_id").where("cls != lo").select(F.col("cls").alias("a"), F.col("lo").alias("b"))
    component = None
    for turn in range(2):
        placed = _placed(members, component)
        leads = placed.groupBy("cell").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                           F.min_by(F.struct("cls", "component"), F.xxhash64("cls", F.lit(turn))).alias("lead")).where("lo < hi")
        stars = placed.join(leads.select("cell", "lead"), "cell").where(F.col("component") != F.col("lead.component"))
        pairs = stars.select(F.least("cls", "lead.cls").alias("a"), F.greatest("cls", "lead.cls").alias("b")).distinct()
        found = verify(pairs, f"star-{turn}")
        component = _merged(scratch, component, links.unionByName(found) if turn == 0 else found, f"star-{turn}")
    # cells that still hold several components: all pairs across components, tile by tile; members of the cell's largest
    # component only meet members of others, so a cell held by one component costs little more than its members
    placed = _placed(members, component)
    held = placed.groupBy("cell", "component").agg(F.count("*").alias("c")).groupBy("cell").agg(
        F.max_by("component", F.struct("c", "component")).alias("main"), F.max("c").alias("top"), F.sum("c").alias("m"))
    # of two members, one led the cell and met the other
    open_cells = scratch.write(placed.join(held.where("top < m AND m > 2"), "cell"), "open")
    blocks, others = F.ceil(F.col("top") / BLOCK).cast("int"), F.ceil((F.col("m") - F.col("top")) / BLOCK).cast("int")
    in_main, sign = F.col("component") == F.col("main"), F.xxhash64("cls")
    dealt = (open_cells.withColumn("block", F.when(in_main, others + F.pmod(sign, blocks)).otherwise(F.pmod(sign, others)).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.when(in_main, others).otherwise(others + blocks) - 1)))
             .select("cell", "cls", "component", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")))
    tiles = dealt.join(small.select("cls", "n", "bitmap"), "cls").groupBy("cell", "i", "j").applyInArrow(
        _tile_pairs(bands), "a long, b long")
    component = _merged(scratch, component, verify(tiles.distinct(), "tile"), "tile")
    out = slim.select("doc_id", F.col("n").alias("n_shingles"), "cls").join(
        component.select(F.col("node").alias("cls"), "component"), "cls", "left")
    out = scratch.write(out.withColumn("component", F.coalesce("component", "cls")), "placed")
    scratch.keep("placed")
    least = out.where(F.col("component").isNotNull() & F.col("doc_id").isNotNull()).groupBy("component").agg(
        F.min("doc_id").alias("component_id"), F.max("doc_id").alias("last")).where("component_id < last").select("component", "component_id")
    return out.join(least, "component", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def _placed(members: DataFrame, component: DataFrame | None) -> DataFrame:
    """(cell, cls, component) of every member; a class without links is its own component."""
    if component is None:
        return members.select("cell", "cls", F.col("cls").alias("component"))
    return members.join(component.withColumnRenamed("node", "cls"), "cls", "left").select(
        "cell", "cls", F.coalesce("component", "cls").alias("component"))


def _merged(scratch: Scratch, component: DataFrame | None, links: DataFrame, name: str) -> DataFrame:
    """(node, component) after adding links between nodes to the components known so far."""
    if component is None:
        return scratch.write(connected_components(scratch, links, "a", "b", f"{name}-cc"), f"{name}-components")
    ends = links
    for end in ("a", "b"):
        of = component.select(F.col("node").alias(end), F.col("component").alias("of"))
        ends = ends.join(of, end, "left").withColumn(end, F.coalesce("of", end)).drop("of")
    upper = scratch.write(connected_components(scratch, ends, "a", "b", f"{name}-cc").withColumnRenamed("component", "top"), f"{name}-upper")
    known = component.join(upper.withColumnRenamed("node", "component"), "component", "left").select(
        "node", F.coalesce("top", "component").alias("component"))
    fresh = upper.join(component.select("node"), "node", "left_anti").select("node", F.col("top").alias("component"))
    return scratch.write(known.unionByName(fresh), f"{name}-components")
