"""Exact top-k inner-product search by columnar branch-and-bound.

Vectors are packed into blocks of integers in vertical layout (one row per dimension).  A stated query set meets all
blocks; per pair of blocks the products are accumulated one group of dimensions after the other, as matrix products.  After each
group only queries stay whose best partial product plus the most that the remaining dimensions can add (Cauchy-Schwarz on
the remaining mass) reaches their k-th best product so far, which a task carries from block to block.  Each task
returns its k best per query, and one pre-aggregated ranking merges them.  The query blocks are sent to the candidate
blocks in groups of bounded size, one group after the other; the candidate blocks stay where they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.scratch import Scratch

#: Vectors per candidate block and per query block.
BLOCK_ROWS = 4096
QUERY_ROWS = 1024
#: Dimensions accumulated between two prunings.
STRIDE = 16
#: Bytes of query blocks that are sent to every executor at once.
SENT_BYTES = 8 * Scratch.SENT_NUMBERS

_BLOCK = pa.schema([("block", pa.int64()), ("dims", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()), ("data", pa.binary())])
_BLOCK_DDL = "block long, dims int, n int, ids binary, data binary"


def quantised(embedding: Column, factor: int = 256) -> Column:
    """floor(factor * x) of every component as long; null where the vector or a component is null or not finite.

    Scores are exact while they stay below 2^63 in size.
    """
    values = F.transform(embedding, lambda x: x.cast("double"))
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(embedding.isNotNull() & (F.size(embedding) > 0) & finite,
                  F.transform(values, lambda x: F.floor(F.lit(float(factor)) * x).cast("long")))


def _pack(rows: int):
    """Vectors of one dimension count per block; vertical layout, four bytes a component where all fit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list[np.ndarray], list[np.ndarray]]] = {}

        def flush(dims: int) -> pa.RecordBatch:
            ids, parts = held.pop(dims)
            matrix = np.concatenate(parts).T
            matrix = np.ascontiguousarray(matrix.astype("<i4" if np.abs(matrix).max(initial=0) < 2 ** 31 else "<i8"))
            ids = np.concatenate(ids).astype("<i8")
            return pa.RecordBatch.from_arrays([pa.array([int(ids[0])]), pa.array([dims], pa.int32()), pa.array([len(ids)], pa.int32()),
                                               pa.array([ids.tobytes()]), pa.array([matrix.tobytes()])], schema=_BLOCK)

        for batch in batches:
            ids, lists = batch.column(0).to_numpy(), batch.column(1)
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            at = np.concatenate([[0], np.cumsum(sizes)])
            for dims in np.unique(sizes).tolist():
                for part in np.array_split(np.flatnonzero(sizes == dims), -(-int((sizes == dims).sum()) // rows)):
                    have = held.setdefault(dims, ([], []))
                    have[0].append(ids[part])
                    have[1].append(flat[at[part][:, None] + np.arange(dims)])
                    if sum(map(len, have[0])) >= rows:
                        yield flush(dims)
        for dims in list(held):
            yield flush(dims)

    return run


def block_top_k(queries: np.ndarray, query_ids: np.ndarray, block: np.ndarray, ids: np.ndarray, k: int,
                stride: int = STRIDE, least: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query number, ids, scores) of the k best of the block per query, ties to the smaller id.

    ``queries`` and ``block`` hold one row per dimension.  Rows with the query's own id are no candidates, nor need those be
    found that score below ``least`` of the query.
    """
    dims, slots = len(block), np.arange(len(query_ids))
    limit = float(np.abs(queries).max(initial=0)) * float(np.abs(block).max(initial=0)) * dims
    kind = np.float64 if limit < 2.0 ** 53 else np.int64
    # dimensions in which the block's vectors vary most come first
    order = np.argsort(-(block.astype(np.float64) ** 2).sum(axis=1), kind="stable")
    q, b = queries[order].astype(kind), block[order].astype(kind)
    edges = list(range(0, dims, stride)) + [dims]
    mass = lambda m: np.sqrt(np.cumsum((m.astype(np.float64) ** 2)[::-1], axis=0)[::-1])
    left_q, left_b = mass(q), mass(b).max(axis=1, initial=0)
    room = 1e-6 + 1e-12 * limit  # for rounding
    scores = np.zeros((len(slots), len(ids)), kind)
    for lo, hi in zip(edges[:-1], edges[1:]):
        scores += q[lo:hi, slots].T @ b[lo:hi]
        if hi < dims and least is not None:
            # queries stay that some vector of the block may still answer, by what the dimensions from hi on can add
            stay = scores.max(axis=1) + left_q[hi, slots] * left_b[hi] * (1 + 1e-9) + room >= least[slots]
            if not stay.all():
                slots, scores = slots[stay], scores[stay]
    by = np.argsort(ids, kind="stable")
    first, end = (np.searchsorted(ids[by], query_ids[slots], side=x) for x in ("left", "right"))
    times = end - first
    own = np.repeat(np.arange(len(slots)), times), by[np.repeat(first - (np.cumsum(times) - times), times) + np.arange(times.sum())]
    scores[own] = -np.inf if kind is np.float64 else np.iinfo(np.int64).min
    if least is not None:
        enough = (least[slots] - room)[:, None]
    elif len(ids) > k:
        enough = np.partition(scores, len(ids) - k, axis=1)[:, [len(ids) - k]]
    else:
        enough = np.full((len(slots), 1), -np.inf)
    good = scores >= enough
    good[own] = False
    row, column = np.nonzero(good)
    edges = np.searchsorted(row, np.arange(len(slots) + 1))
    for r in np.flatnonzero(edges[1:] > edges[:-1]):
        some = column[edges[r]:edges[r + 1]]
        best = some[np.lexsort((ids[some], -scores[r, some]))[:k]]
        yield int(slots[r]), ids[best], scores[r, best].astype(np.int64)


def _search(k: int):
    none = np.iinfo(np.int64).min

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # per query block the ids and scores of the k best so far; missing ones score ``none``
        best: dict[tuple[int, bytes], tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for r in batch.to_pylist():
                shape = r["dims"], -1
                q_ids, ids = (np.frombuffer(r[x], "<i8") for x in ("q_ids", "ids"))
                q, b = (np.frombuffer(r[x], f"<i{len(r[x]) // (len(y) * r['dims'])}").reshape(shape)
                        for x, y in (("q_data", q_ids), ("data", ids)))
                had = best.get((r["dims"], r["q_ids"]))
                least = None if had is None else np.where(had[1][:, -1] > none, had[1][:, -1].astype(np.float64), -np.inf)
                new_ids, new = np.zeros((len(q_ids), k), np.int64), np.full((len(q_ids), k), none)
                for i, found, scores in block_top_k(q, q_ids, b, ids, k, least=least):
                    new_ids[i, :len(found)], new[i, :len(found)] = found, scores
                if had is not None:
                    new_ids, new = (np.concatenate(x, axis=1) for x in ((had[0], new_ids), (had[1], new)))
                    order = np.lexsort((new_ids, ~new))[:, :k]  # ~ turns the order of all numbers, also of the least one
                    new_ids, new = (np.take_along_axis(x, order, axis=1) for x in (new_ids, new))
                best[r["dims"], r["q_ids"]] = new_ids, new
        for (_, q_ids), (ids, scores) in best.items():
            i, j = np.nonzero(scores > none)
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(q_ids, "<i8")[i]), pa.array(ids[i, j]), pa.array(scores[i, j])],
                                             names=["query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest inner products of floor(256 * x) per query.

    ``queries`` is the condition that makes a row a query; every row is a candidate of every query but rows with the
    query's own id.  Vectors that are null, empty, or hold null or non-finite components take no part, nor do rows
    without an id; vectors of another length than the query's are no candidates.  Repeated candidate rows count as
    often as they occur; a query id that occurs several times is one query, answered by its least vector.  Ties go to
    the smaller id.  Fewer than k candidates: all of them.  An empty table gives no rows.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col)).alias("v"), queries.alias("q"))
            .where(F.col("id").isNotNull() & F.col("v").isNotNull()))
    candidates = scratch.write(rows.select("id", "v").mapInArrow(_pack(BLOCK_ROWS), _BLOCK_DDL), "candidates")
    asked = rows.where("q").groupBy("id").agg(F.min("v").alias("v")).select("id", "v")
    asked = scratch.write(asked.mapInArrow(_pack(QUERY_ROWS), _BLOCK_DDL), "queries")
    # every query block meets every candidate block: the query blocks are sent to all executors, in several turns if they
    # are many; a query lies in one block, so each turn ranks the queries of its own
    size = asked.agg(F.sum(F.octet_length("ids") + F.octet_length("data"))).head()[0] or 0
    turns = max(1, -(-size // SENT_BYTES))
    ranked = []
    for turn in range(turns):
        sent = asked.where(F.pmod(F.xxhash64("block", "n"), F.lit(turns)) == turn).select(
            "dims", F.col("ids").alias("q_ids"), F.col("data").alias("q_data"))
        pairs = candidates.join(F.broadcast(sent), "dims").select("dims", "q_ids", "q_data", "ids", "data")
        found = pairs.mapInArrow(_search(k), "query_id long, vec_id long, score long")
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        own = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        ranked.append(scratch.write(own, f"ranked-{turn}") if turns > 1 else own)
    return reduce(DataFrame.unionByName, ranked)
