"""Hard negatives by lists that the anchors of a cluster share.

Vectors are dealt to cluster centres.  Candidates of one centre are packed into blocks, anchors of one centre into anchor
clusters.  For a member a of an anchor cluster with centre c and widest angle t, a candidate x scores at most
|a| |x| cos(max(0, angle(x, c) - t)).  For each anchor cluster the candidates of a block are sorted by that bound once;
every member walks the list until what is left is certain to stay below what it needs.  The same bound on whole blocks
(largest norm, widest angle) decides before any vector is moved which blocks a cluster meets: first the most promising
ones, then only those that can still matter.

Two walks: the first finds each anchor's positives, the second, for each positive, the best rows of other labels whose
score lies within given shares of the positive's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.near_embed import fit_centres
from vitrine.llm.scratch import Scratch
from vitrine.llm.topk import quantised

#: Candidates per block and anchors per cluster.
BLOCK_ROWS = 4096
CLUSTER_ROWS = 512
#: Centres, and vectors that they are fitted on (a bounded sample by hash of the id).
CENTRES = 32
FIT_ROWS = 20_000
#: Candidates that the members of a cluster score between two looks at their bounds.
STRIDE = 512
#: Blocks that every cluster meets first.
FIRST = 2
#: Blocks per group whose common bound is tested before their own.
GROUP_BLOCKS = 64

#: Below every score; scores are exact while they stay within 2^62.
NO_FLOOR = -(1 << 62)

_BLOCK = pa.schema([("centre", pa.int32()), ("dims", pa.int32()), ("n", pa.int32()), ("spread", pa.float64()), ("norm", pa.float64()),
                    ("ids", pa.binary()), ("labels", pa.binary()), ("data", pa.binary())])
_BLOCK_DDL = "centre int, dims int, n int, spread double, norm double, ids binary, labels binary, data binary"
_FOUND_DDL = "anchor long, w int, id long, score long"


def _angles(x: np.ndarray, centre: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(angle to the centre, norm) of each row; rows of length zero stand at the centre."""
    x = x.astype(np.float64)
    norm = np.sqrt(np.einsum("nd,nd->n", x, x))
    if centre is None:
        return np.zeros(len(x)), norm
    return np.where(norm > 0, np.arccos(np.clip(x @ centre / np.maximum(norm, 1e-300), -1, 1)), 0.0), norm


def _dealt(centres: np.ndarray):
    """Every vector's nearest centre; -1 where the vector has another length than the centres."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            sizes = np.diff(lists.offsets.to_numpy())
            own = np.full(len(sizes), -1, dtype=np.int32)
            fits = np.flatnonzero(sizes == centres.shape[1]) if centres.size else np.zeros(0, dtype=np.int64)
            if fits.size:
                at = np.concatenate([[0], np.cumsum(sizes)])
                flat = lists.flatten().to_numpy(zero_copy_only=False)
                own[fits] = (flat[at[fits][:, None] + np.arange(centres.shape[1])].astype(np.float64) @ centres.T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own)], names=[*batch.schema.names, "centre"])

    return run


def _pack(centres: np.ndarray, rows: int):
    """Blocks of vectors of one centre and length, of rows that come sorted by these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        key: tuple[int, int] | None = None

        def flush() -> pa.RecordBatch:
            ids, labels, x = (np.concatenate(c) for c in zip(*held))
            held.clear()
            angle, norm = _angles(x, centres[key[0]] if key[0] >= 0 else None)
            x = np.ascontiguousarray(x.astype("<i4" if np.abs(x).max(initial=0) < 2 ** 31 else "<i8"))
            spread = float(angle.max()) if key[0] >= 0 else np.pi
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([len(ids)], pa.int32()), pa.array([spread]),
                 pa.array([float(norm.max())]), pa.array([ids.tobytes()]), pa.array([labels.tobytes()]), pa.array([x.tobytes()])], schema=_BLOCK)

        for batch in batches:
            if not batch.num_rows:
                continue
            ids, labels, lists, centre = (batch.column(batch.schema.get_field_index(c)) for c in ("id", "label", "v", "centre"))
            ids, labels, centre = ids.to_numpy(), labels.to_numpy(), centre.to_numpy()
            sizes = np.diff(lists.offsets.to_numpy())
            at = np.concatenate([[0], np.cumsum(sizes)])
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            fresh = np.flatnonzero((centre[1:] != centre[:-1]) | (sizes[1:] != sizes[:-1])) + 1
            for lo, hi in zip([0, *fresh.tolist()], [*fresh.tolist(), len(ids)]):
                if held and key != (int(centre[lo]), int(sizes[lo])):
                    yield flush()
                key = int(centre[lo]), int(sizes[lo])
                while lo < hi:
                    end = min(hi, lo + rows - sum(len(h[0]) for h in held))
                    held.append((ids[lo:end].astype("<i8"), labels[lo:end].astype("<i8"), flat[at[lo]:at[end]].reshape(end - lo, -1)))
                    lo = end
                    if sum(len(h[0]) for h in held) >= rows:
                        yield flush()
        if held:
            yield flush()

    return run


def walk(anchors: np.ndarray, anchor_ids: np.ndarray, anchor_labels: np.ndarray, centre: np.ndarray | None, spread: float,
         windows: np.ndarray, block: np.ndarray, ids: np.ndarray, labels: np.ndarray, same: bool, want: int, stride: int = STRIDE
         ) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(window number, id, score) of the ``want`` best of the block per window, ties to the smaller id; and how many
    candidates were scored by some member.

    ``windows`` has a row (anchor's place, floor, ceiling) each; scores from floor to ceiling count, of candidates with
    the anchor's label (``same``) or with another one, and never of rows with the anchor's id.
    """
    limit = float(np.abs(anchors).max(initial=0)) * float(np.abs(block).max(initial=0)) * anchors.shape[1]
    kind = np.float64 if limit < 2.0 ** 53 else np.int64
    angle, norm = _angles(block, centre)
    _, length = _angles(anchors, None)
    reach = norm * np.cos(np.maximum(0.0, angle - spread) if centre is not None else 0.0)
    # the shared list: sorted once for all members, with room for rounding
    order = np.argsort(-reach, kind="stable")
    reach = reach[order] + 1e-9 * norm.max(initial=0) + 1e-9
    a, x = anchors.astype(kind), block[order].astype(kind)
    ids, labels = ids[order], labels[order]
    owner, floor, ceiling = windows[:, 0], windows[:, 1].copy(), windows[:, 2]
    best_w, best_id, best_score = (np.zeros(0, dtype=np.int64) for _ in range(3))
    scored = 0
    for lo in range(0, len(ids), stride):
        live = np.flatnonzero(length[owner] * reach[lo] * (1 + 1e-9) + 1e-9 * limit / max(anchors.shape[1], 1) >= floor)
        if not live.size:
            break
        members, at = np.unique(owner[live], return_inverse=True)
        scores = a[members] @ x[lo:lo + stride].T
        scored += scores.shape[1]
        fits = ((labels[lo:lo + stride] == anchor_labels[members][:, None]) == same) & (ids[lo:lo + stride] != anchor_ids[members][:, None])
        got = scores[at]
        fits = fits[at] & (got >= floor[live][:, None]) & (got <= ceiling[live][:, None])
        row, column = np.nonzero(fits)
        best_w = np.concatenate([best_w, live[row]])
        best_id = np.concatenate([best_id, ids[lo + column]])
        best_score = np.concatenate([best_score, got[row, column].astype(np.int64)])
        by = np.lexsort((best_id, -best_score, best_w))
        best_w, best_id, best_score = best_w[by], best_id[by], best_score[by]
        keep = np.arange(len(best_w)) - np.searchsorted(best_w, best_w) < want
        best_w, best_id, best_score = best_w[keep], best_id[keep], best_score[keep]
        full, first, n = np.unique(best_w, return_index=True, return_counts=True)
        full, first = full[n == want], first[n == want]
        floor[full] = np.maximum(floor[full], best_score[first + want - 1])
    return best_w, best_id, best_score, scored


def _walks(centres: np.ndarray, same: bool, want: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                a_ids, a_labels, ids, labels = (np.frombuffer(r[c], "<i8") for c in ("a_ids", "a_labels", "ids", "labels"))
                a, x = (np.frombuffer(r[c], f"<i{len(r[c]) // (len(i) * r['dims'])}").reshape(len(i), r["dims"])
                        for c, i in (("a_data", a_ids), ("data", ids)))
                asked = np.array([(w["anchor"], w["w"], w["floor"], w["ceiling"]) for w in r["windows"]], dtype=np.int64)
                by = np.argsort(a_ids, kind="stable")
                place = by[np.searchsorted(a_ids[by], asked[:, 0])]
                w, found, score, _ = walk(a, a_ids, a_labels, centres[r["a_centre"]] if r["a_centre"] >= 0 else None, r["a_spread"],
                                          np.column_stack([place, asked[:, 2:]]), x, ids, labels, same, want)
                yield pa.RecordBatch.from_arrays([pa.array(asked[w, 0]), pa.array(asked[w, 1].astype(np.int32)), pa.array(found), pa.array(score)],
                                                 names=["anchor", "w", "id", "score"])

    return run


def _fit(rows: DataFrame) -> np.ndarray:
    """Unit centres of the most frequent vector length, fitted on about ``FIT_ROWS`` vectors of different ids."""
    sizes = rows.groupBy(F.size("v").alias("dims")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dims").first()
    if sizes is None:
        return np.zeros((0, 0))
    place = F.pmod(F.xxhash64("id", F.lit("fit")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.where((F.size("v") == sizes["dims"]) & (place < 1.1 * FIT_ROWS / sizes["n"])).groupBy("id").agg(F.min("v").alias("v"))
    x = np.array([r["v"] for r in sorted(sample.collect(), key=lambda r: r["id"])], dtype=np.float64).reshape(-1, sizes["dims"])
    norm = np.linalg.norm(x, axis=1)
    x = x[norm > 0] / norm[norm > 0][:, None]
    centres = fit_centres(x, CENTRES) if len(x) else x
    return centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-300)


def hard_negatives(vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90,
                   id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Scores are inner products of floor(256 * x).  Rows that meet the condition ``anchors`` are anchors.  An anchor's
    positives are the ``positives`` best rows of its label with another id; for each one the ``negatives`` best rows of
    other labels with least * positive_score <= 100 * score <= most * positive_score are returned.  Ties go to the
    smaller id; fewer where there are fewer.  Rows without an id or a label, and vectors that are null, empty or hold
    null or non-finite components take no part; vectors of another length than the anchor's never meet it.  Repeated
    rows count as often as they occur; an anchor id that occurs several times is one anchor, with its least label and
    vector.  Labels that are no whole numbers are compared by 64-bit hashes.  Other columns are ignored; an empty table
    gives no rows.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "negatives")
    whole = vectors.schema[label_col].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint")
    label = F.col(f"`{label_col}`").cast("long") if whole else F.xxhash64(f"`{label_col}`")
    rows = vectors.where(F.col(f"`{label_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").cast("long").alias("id"), label.alias("label"), quantised(F.col(f"`{vector_col}`")).alias("v"),
        F.coalesce(anchors, F.lit(False)).alias("anchor")).where(F.col("id").isNotNull() & F.col("v").isNotNull())
    centres = _fit(rows)
    dealt = scratch.write(rows.select("id", "label", "v", "anchor").mapInArrow(
        _dealt(centres), "id long, label long, v array<long>, anchor boolean, centre int"), "dealt")

    def packed(df: DataFrame, most_rows: int) -> DataFrame:
        # ranges of (centre, hash of the id): a centre with a third of the rows lies in many tasks
        df = df.withColumn("salt", F.xxhash64("id")).withColumn("dims", F.size("v"))
        df = df.repartitionByRange("centre", "dims", "salt").sortWithinPartitions("centre", "dims", "salt")
        return df.select("id", "label", "v", "centre").mapInArrow(_pack(centres, most_rows), _BLOCK_DDL)

    blocks = scratch.write(packed(dealt, BLOCK_ROWS).withColumn("block", F.monotonically_increasing_id()), "blocks")
    asked = dealt.where("anchor").groupBy("id").agg(F.min(F.struct("label", "v", "centre")).alias("own")).select("id", "own.*")
    clusters = scratch.write(packed(asked, CLUSTER_ROWS).select(
        F.monotonically_increasing_id().alias("cluster"), F.col("centre").alias("a_centre"), "dims", F.col("spread").alias("a_spread"),
        F.col("ids").alias("a_ids"), F.col("labels").alias("a_labels"), F.col("data").alias("a_data")), "clusters")

    # envelopes of blocks and groups of blocks; the angles between centres are CENTRES squared numbers
    between = [(i, j, float(np.arccos(np.clip(centres[i] @ centres[j], -1, 1)))) for i in range(len(centres)) for j in range(len(centres))]
    angles = F.broadcast(spark.createDataFrame(between + [(-1, -1, 0.0)], "a_centre int, centre int, angle double"))
    parts = max(1, blocks.count() // GROUP_BLOCKS)
    metas = blocks.select("block", "centre", "dims", "spread", "norm", F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int").alias("part"))
    groups = metas.groupBy("centre", "dims", "part").agg(F.max("spread").alias("g_spread"), F.max("norm").alias("g_norm"))

    def bound(spread: str, norm: str) -> Column:
        apart = F.greatest(F.lit(0.0), F.col("angle") - F.col("a_spread") - F.col(spread))
        return F.col(norm) * F.cos(F.least(apart, F.lit(float(np.pi)))) + 1e-9 * F.col(norm) + 1e-9

    asking = clusters.select("cluster", "a_centre", "dims", "a_spread").join(angles, "a_centre")
    asking = asking.select("*", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")).join(groups, ["centre", "dims", "part"])

    def search(windows: DataFrame, same: bool, want: int, tag: str) -> DataFrame:
        """(anchor, w, id, score, place): the best of all blocks per window (cluster, anchor, w, floor, ceiling, length)."""
        best = Window.partitionBy("anchor", "w").orderBy(F.desc("score"), "id")

        def best_of(found: DataFrame) -> DataFrame:
            return found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= want)

        def walked(pairs: DataFrame, asked_now: DataFrame) -> DataFrame:
            listed = asked_now.groupBy("cluster").agg(F.collect_list(F.struct("anchor", "w", "floor", "ceiling")).alias("windows"))
            known = clusters.drop("dims").join(listed, "cluster")
            met = pairs.select("cluster", "block").join(known, "cluster").join(blocks.select("block", "dims", "ids", "labels", "data"), "block")
            return met.drop("cluster", "block").mapInArrow(_walks(centres, same, want), _FOUND_DDL)

        need = windows.groupBy("cluster").agg(F.min(F.col("floor") / F.greatest("length", F.lit(1e-9))).alias("need"))
        pairs = asking.join(need, "cluster").where(bound("g_spread", "g_norm") >= F.col("need"))
        pairs = pairs.join(metas, ["centre", "dims", "part"]).withColumn("reach", bound("spread", "norm")).where("reach >= need")
        pairs = pairs.withColumn("turn", F.row_number().over(Window.partitionBy("cluster").orderBy(F.desc("reach"), "block")))
        pairs = scratch.write(pairs.select("cluster", "block", "reach", "turn"), f"pairs-{tag}")
        first = scratch.write(best_of(walked(pairs.where(F.col("turn") <= FIRST), windows)), f"first-{tag}")
        # what is certain so far raises the floors; only blocks that reach some floor of the cluster are met then
        sure = first.where(F.col("place") == want).select("anchor", "w", F.col("score").alias("sure"))
        raised = windows.join(sure, ["anchor", "w"], "left").withColumn("floor", F.greatest("floor", F.coalesce("sure", "floor")))
        need = raised.groupBy("cluster").agg(F.min(F.col("floor") / F.greatest("length", F.lit(1e-9))).alias("need"))
        later = pairs.where(F.col("turn") > FIRST).join(need, "cluster").where("reach >= need")
        rest = scratch.write(walked(later, raised), f"rest-{tag}")
        return scratch.write(best_of(first.drop("place").unionByName(rest)), f"best-{tag}")

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids = np.frombuffer(r["a_ids"], "<i8")
                x = np.frombuffer(r["a_data"], f"<i{len(r['a_data']) // (len(ids) * r['dims'])}").reshape(len(ids), -1)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), r["cluster"])), pa.array(ids), pa.array(_angles(x, None)[1])],
                                                 names=["cluster", "anchor", "length"])

    owners = scratch.write(clusters.select("cluster", "dims", "a_ids", "a_data").mapInArrow(
        unpacked, "cluster long, anchor long, length double"), "owners")
    every = owners.select("cluster", "anchor", "length", F.lit(0).alias("w"), F.lit(NO_FLOOR).alias("floor"), F.lit(-NO_FLOOR).alias("ceiling"))
    chosen = search(every, True, positives, "positives")
    pairs = chosen.select("anchor", F.col("place").alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    # whole numbers: 100 * score lies within the shares, so the score lies within their rounded ends
    floor = F.ceil(F.col("positive_score") * F.lit(least).cast("decimal(10,0)") / 100).cast("long")
    ceiling = F.floor(F.col("positive_score") * F.lit(most).cast("decimal(10,0)") / 100).cast("long")
    windows = pairs.join(owners, "anchor").select("cluster", "anchor", "length", "w", floor.alias("floor"), ceiling.alias("ceiling"))
    found = search(scratch.write(windows.where("floor <= ceiling"), "windows"), False, negatives, "negatives")
    scratch.keep("best-positives", "best-negatives")
    return found.join(pairs, ["anchor", "w"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", F.col("place").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
