"""Near-duplicate embeddings by a robust-pruned flat graph.

Equal vectors are one weighted vector.  Vectors are dealt to overlapping cluster shards.  Each shard builds a flat proximity graph by robust pruning; the
adjacency lists of a vector's shards are united.  Range-expanding greedy search from the shard's medoid then finds every
vector's neighbours: a best-first beam first, afterwards every neighbour within range is expanded as well until no new
one turns up.  Found pairs are verified by the cosine in double precision.  An audit compares the number of links of a
bounded sample of vectors with brute force; if recall is too low, the overlap grows and the search runs again, and if it
stays too low all pairs are compared in tiles.

A shard above the row bound is covered by tiles: its rows are cut into blocks, and every pair of blocks is a shard of
its own, so no group is ever held by one task and no pair of its rows is left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.components import connected_components
from vitrine.llm.scratch import Scratch

#: Vectors per shard aimed at, and the most one task searches.
SHARD_ROWS = 1500
MAX_ROWS = 3000
#: Vectors that the cluster centres are fitted on (a bounded sample by hash of the id).
FIT_ROWS = 20_000
#: Neighbours kept per vector, candidates they are pruned from, and the pruning factor.
DEGREE = 20
#: Most edges per vector that are added as reverses of kept ones.
REVERSED = 10
CANDIDATES = 64
ALPHA = 1.2
#: Width of the beam before the range expands.
BEAM = 24
#: Vectors audited by brute force, and the recall below which the overlap grows.
AUDIT_ROWS = 128
LEAST_RECALL = 0.98


def _vectors(column: pa.ListArray) -> np.ndarray:
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, -1) if n else flat.reshape(0, 1)


def unit_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, u): vectors of finite components and positive length, scaled to length one in double precision."""
    values = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.when(F.col(vector_col).isNotNull() & finite, values).alias("v"))
    largest = F.array_max(F.transform("v", lambda x: F.abs(x)))
    rows = rows.withColumn("top", largest).where(F.col("vec_id").isNotNull() & (F.col("top") > 0))
    # divide by the largest component first: the squares then neither overflow nor vanish
    rows = rows.withColumn("v", F.transform("v", lambda x: x / F.col("top")))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    return rows.withColumn("norm", norm).select("vec_id", F.transform("v", lambda x: x / F.col("norm")).alias("u"))


def fit_centres(sample: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """k spherical k-means centres of a sample (fewer if it is small)."""
    rng = np.random.default_rng(0)
    k = min(k, len(sample))
    centres = sample[rng.choice(len(sample), k, replace=False)]
    for _ in range(rounds):
        own = (sample @ centres.T).argmax(axis=1)
        order = np.argsort(own, kind="stable")
        counts = np.bincount(own, minlength=k)
        sums = np.zeros_like(centres)
        full = counts > 0
        sums[full] = np.add.reduceat(sample[order], np.concatenate([[0], np.cumsum(counts)[:-1]])[full], axis=0)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norm > 0, sums / np.maximum(norm, 1e-12), centres)
    return centres


def _nearest(centres: np.ndarray, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = min(overlap, len(centres))
        for batch in batches:
            x = _vectors(batch.column(1)).astype(np.float32)
            near = np.argsort(-(x @ centres.T), axis=1, kind="stable")[:, :m].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * m), pa.array(near.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], lists], names=["vec_id", "u", "weight", "shards"])

    return run


def build_graph(x: np.ndarray, degree: int = DEGREE, candidates: int = CANDIDATES, alpha: float = ALPHA) -> np.ndarray:
    """Neighbours (n x degree, -1: none) by robust pruning of every vector's nearest and some far candidates.

    The nearest remaining candidate p is kept and every candidate c with alpha * d(p, c) <= d(x, c) is dropped, for all
    vectors of the shard at once.
    """
    n = len(x)
    m = min(candidates, n - 1)
    if m <= 0:
        return np.full((n, 1), -1, dtype=np.int32)
    pool = np.empty((n, m), dtype=np.int32)
    far = min(8, m // 4)
    rng = np.random.default_rng(0)
    for lo in range(0, n, 512):
        s = x[lo:lo + 512] @ x.T
        s[np.arange(len(s)), lo + np.arange(len(s))] = -2
        pool[lo:lo + 512] = np.argpartition(-s, m - 1, axis=1)[:, :m]
    if far:
        pool[:, :far] = rng.integers(0, n, (n, far))
    out = np.full((n, degree), -1, dtype=np.int32)
    for lo in range(0, n, 512):
        own = pool[lo:lo + 512]
        v = x[own]
        d = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("nmd,nd->nm", v, x[lo:lo + 512])))
        alive = own != (lo + np.arange(len(own)))[:, None]
        rows = np.arange(len(own))
        for j in range(degree):
            pick = np.where(alive, d, np.inf).argmin(axis=1)
            some = alive[rows, pick]
            if not some.any():
                break
            out[lo + rows[some], j] = own[rows[some], pick[some]]
            between = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("nmd,nd->nm", v, v[rows, pick])))
            alive &= alpha * between > d
            alive[rows, pick] = False
    return out


def range_search(x: np.ndarray, graph: np.ndarray, edge: float, beam: int = BEAM) -> Iterator[tuple[int, np.ndarray]]:
    """(first query, matrix of scores, -2 where a vector was not met) for blocks of rows of ``x`` as queries.

    All queries start at the medoid.  Per step every unfinished query expands its best unexpanded candidate while that
    one is among the ``beam`` best met; candidates of at least ``edge`` are expanded whatever their place.
    """
    n, width = len(x), graph.shape[1]
    medoid = int((x @ x.mean(axis=0)).argmax())
    wide = max(256, 160_000 // width)
    for lo in range(0, n, 256):
        q = x[lo:lo + 256]
        k = len(q)
        score = np.full((k, n), -2.0, dtype=np.float32)
        waiting = np.zeros((k, n), dtype=bool)
        score[:, medoid] = q @ x[medoid]
        waiting[:, medoid] = True
        top = np.full((k, beam), -2.0, dtype=np.float32)
        top[:, 0] = score[:, medoid]
        live = np.arange(k)
        while live.size:
            candidate = np.where(waiting[live], score[live], np.float32(-3))
            pick = candidate.argmax(axis=1)
            best = candidate[np.arange(len(live)), pick]
            go = (best >= edge) | (best >= top[live].min(axis=1)) & (best > -2)
            live, pick = live[go], pick[go]
            if not live.size:
                break
            waiting[live, pick] = False
            # the range expands: every hit that waits, a bounded number per step
            more, at = np.nonzero(candidate[go] >= edge)
            more = live[more]
            still = waiting[more, at]
            more, at = more[still][:wide], at[still][:wide]
            waiting[more, at] = False
            rows = np.repeat(np.concatenate([live, more]), width)
            near = graph[np.concatenate([pick, at])].ravel()
            fresh = near >= 0
            fresh[fresh] = score[rows[fresh], near[fresh]] == -2
            key = np.unique(rows[fresh] * n + near[fresh])
            rows, near = key // n, key % n
            if not len(rows):
                continue
            got = np.einsum("nd,nd->n", q[rows], x[near])
            score[rows, near] = got
            waiting[rows, near] = True
            # the beam's scores, per query the best of the new ones merged
            order = np.lexsort((-got, rows))
            rows, got = rows[order], got[order]
            first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
            place = np.arange(len(rows)) - np.repeat(first, np.diff(np.append(first, len(rows))))
            keep = place < beam
            new = np.full((k, beam), -2.0, dtype=np.float32)
            new[rows[keep], place[keep]] = got[keep]
            seen = rows[first]
            both = np.concatenate([top[seen], new[seen]], axis=1)
            top[seen] = -np.partition(-both, beam - 1, axis=1)[:, :beam]
        yield lo, score


def _list(table: pa.Table, name: str) -> pa.ListArray:
    column = table.column(name).combine_chunks()
    return column.chunk(0) if isinstance(column, pa.ChunkedArray) else column


def joined_up(x: np.ndarray, graph: np.ndarray) -> np.ndarray:
    """``graph`` with some reverse edges, and with trees over rows that are the same in single precision.

    Pruning keeps one neighbour at distance zero and drops the others, so such rows would not reach each other.
    """
    n = len(x)
    src, at = np.nonzero(graph >= 0)
    dst = graph[src, at]
    order = np.lexsort((at, dst))
    src, dst = src[order], dst[order]
    place = np.arange(len(dst)) - np.searchsorted(dst, dst)
    back = np.full((n, REVERSED), -1, dtype=graph.dtype)
    few = place < REVERSED
    back[dst[few], place[few]] = src[few]
    tree = np.full((n, 3), -1, dtype=graph.dtype)
    _, kind = np.unique(x, axis=0, return_inverse=True)
    order = np.argsort(kind.ravel(), kind="stable")
    kind = kind.ravel()[order]
    first = np.searchsorted(kind, kind)
    place = np.arange(n) - first
    up = np.flatnonzero(place > 0)
    parent = first[up] + (place[up] - 1) // 2
    tree[order[up], 2] = order[parent]
    tree[order[parent], (place[up] - 1) % 2] = order[up]
    return np.concatenate([graph, back, tree], axis=1)


def _build(table: pa.Table) -> pa.Table:
    """Adjacency lists of one shard."""
    ids = table.column("vec_id").to_numpy()
    x = _vectors(_list(table, "u")).astype(np.float32)
    graph = joined_up(x, build_graph(x))
    full = graph >= 0
    counts = full.sum(axis=1)
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(ids[graph[full]]))
    return pa.table({"vec_id": pa.array(ids), "near": lists})


def _local_components(hit: np.ndarray) -> np.ndarray:
    """Smallest row number linked to each row, by repeated minima over the hits."""
    n = len(hit)
    root = np.arange(n)
    while True:
        before = root.copy()
        for lo in range(0, n, 256):
            root[lo:lo + 256] = np.minimum(root[lo:lo + 256], np.where(hit[lo:lo + 256], root, n).min(axis=1))
        root = root[root]
        if (root == before).all():
            return root


def _find(threshold: float, brute: bool = False):
    """Links of one shard: counts per vector (each pair counted in the first shard that holds both) and spanning links.

    ``brute`` compares all pairs of the shard instead of searching its graph.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id")
        ids = table.column("vec_id").to_numpy()
        n = len(ids)
        shard = table.column("shard")[0].as_py()
        exact = _vectors(_list(table, "u"))
        x = exact.astype(np.float32)
        hit = np.zeros((n, n), dtype=bool)
        edge = threshold - 1e-5
        if brute:
            scores = ((lo, x[lo:lo + 256] @ x.T) for lo in range(0, n, 256))
        else:
            # the united lists' neighbours that are here
            near = _list(table, "near")
            sizes = np.diff(near.offsets.to_numpy())
            flat = near.flatten().to_numpy(zero_copy_only=False)
            at = np.searchsorted(ids, flat).clip(max=n - 1)
            here = ids[at] == flat
            row, at = np.repeat(np.arange(n), sizes)[here], at[here]
            counts = np.bincount(row, minlength=n)
            graph = np.full((n, max(1, int(counts.max(initial=1)))), -1, dtype=np.int64)
            graph[row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)] = at
            scores = range_search(x, graph, edge)
        for lo, score in scores:
            a, b = np.nonzero(score >= edge)
            for k in range(0, len(a), 50_000):
                i, j = a[k:k + 50_000] + lo, b[k:k + 50_000]
                hit[i, j] = np.einsum("nd,nd->n", exact[i], exact[j]) >= threshold
        # the search of either end may have found a pair
        hit |= hit.T
        np.fill_diagonal(hit, False)
        homes = _vectors(_list(table, "homes"))
        weight = table.column("weight").to_numpy()
        links = np.zeros(n, dtype=np.int64)
        for lo in range(0, n, 256):
            a, b = np.nonzero(hit[lo:lo + 256])
            a += lo
            first = np.full(len(a), np.iinfo(np.int64).max)
            for i in range(homes.shape[1]):
                own = homes[a, i]
                shared = (own[:, None] == homes[b]).any(axis=1) & (own >= 0)
                first = np.where(shared, np.minimum(first, own), first)
            links += np.bincount(a[first == shard], weights=weight[b[first == shard]], minlength=n).astype(np.int64)
        return pa.table({"vec_id": pa.array(ids), "links": pa.array(links), "root": pa.array(ids[_local_components(hit)])})

    return run


@dataclass
class Links:
    rows: DataFrame
    recall: float
    overlap: int


def _audit(scratch: Scratch, units: DataFrame, links: DataFrame, threshold: float) -> float:
    """Share of the links of a bounded sample of vectors, counted by brute force over all rows, that were found."""
    sample = units.orderBy(F.xxhash64("vec_id", F.lit("audit")), "vec_id").limit(AUDIT_ROWS).collect()
    if not sample:
        return 1.0
    ids = np.array([r["vec_id"] for r in sample])
    by_dim: dict[int, list[int]] = {}
    for i, r in enumerate(sample):
        by_dim.setdefault(len(r["u"]), []).append(i)
    probes = {dims: (ids[rows], np.array([sample[i]["u"] for i in rows])) for dims, rows in by_dim.items()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column(1).offsets.to_numpy())
            for dims in np.unique(sizes).tolist():
                if dims not in probes:
                    continue
                part = batch.filter(pa.array(sizes == dims))
                own, probe = probes[dims]
                hit = (probe @ _vectors(part.column(1)).T >= threshold) & (own[:, None] != part.column(0).to_numpy())
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(hit @ part.column(2).to_numpy())], names=["vec_id", "n"])

    true = units.mapInArrow(count, "vec_id long, n long").groupBy("vec_id").agg(F.sum("n").alias("n"))
    got = true.join(links, "vec_id", "left").agg(F.sum(F.least("n", F.coalesce("links", F.lit(0)))).alias("found"), F.sum("n").alias("all")).first()
    return 1.0 if not got["all"] else got["found"] / got["all"]


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding",
                    shard_rows: int = SHARD_ROWS, max_rows: int = MAX_ROWS, overlap: int = 2) -> Links:
    """rows: vec_id, n_links, component_id, kept; one per row of ``vectors``; recall: of the audit.

    Links are pairs of different ids with cosine >= threshold in double precision; labels and other columns are
    ignored.  Null and zero vectors and those with null or non-finite components link with nothing and stay; so do
    rows without an id (component null).  Vectors of different length do not link.  Rows that repeat an id are one
    vector, its least; each row gets that vector's result.  An empty table gives no rows.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "embed")
    units = unit_vectors(vectors, id_col, vector_col).groupBy("vec_id").agg(F.min("u").alias("u"))
    units = scratch.write(units, "units")
    # equal vectors are one, the least id, with their number as weight (at a threshold of one, rounding decides)
    alike = units.select("vec_id", F.xxhash64(F.lit("a"), "u").alias("h"), F.xxhash64(F.lit("b"), "u").alias("k"))
    classes = alike.groupBy("h", "k").agg(F.min("vec_id").alias("of"), F.count("*").alias("weight")).where("weight > 1")
    copies = scratch.sent(alike.join(classes, ["h", "k"]).select("vec_id", "of", "weight").where(F.lit(threshold < 1 - 1e-9)), "copies")
    units = units.join(copies.where("vec_id != of").select("vec_id"), "vec_id", "left_anti").join(
        copies.where("vec_id = of").select("vec_id", "weight"), "vec_id", "left")
    units = scratch.write(units.select("vec_id", "u", F.coalesce("weight", F.lit(1)).cast("long").alias("weight")), "distinct")
    scratch.drop("units")
    sizes = {r["dims"]: r["count"] for r in units.groupBy(F.size("u").alias("dims")).count().collect()}
    centres: dict[int, np.ndarray] = {}
    for dims, n in sizes.items():
        chance = F.pmod(F.xxhash64("vec_id", F.lit("fit")), F.lit(1 << 30)) < F.lit(int(min(1.0, FIT_ROWS / n) * (1 << 30)))
        sample = units.where((F.size("u") == dims) & chance).select("vec_id", "u").toArrow().sort_by("vec_id")
        x = _vectors(_list(sample, "u")).astype(np.float32)
        centres[dims] = fit_centres(x, max(1, -(-n // shard_rows)))
    best, recall = None, -1.0
    for attempt in range(3):
        found = _search(scratch, units, centres, threshold, max_rows, overlap, f"{attempt}")
        links = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
        now = _audit(scratch, units, links, threshold)
        if now > recall:
            best, recall = (found, links, overlap), now
        if recall >= LEAST_RECALL:
            break
        overlap *= 2
    found, links, overlap = best
    if recall < LEAST_RECALL:
        # one shard for all vectors of a length, whose pairs of blocks are compared in full
        whole = {dims: np.zeros((1, dims), dtype=np.float32) for dims in sizes}
        found, recall = _search(scratch, units, whole, threshold, max_rows, 1, "all", brute=True), 1.0
        links = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    edges = found.where(F.col("vec_id") != F.col("root")).select(F.col("vec_id").alias("a"), F.col("root").alias("b"))
    component = connected_components(scratch, edges, "a", "b")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id")).join(copies, "vec_id", "left")
    rows = rows.withColumn("of", F.coalesce("of", "vec_id"))
    rows = rows.join(links.withColumnRenamed("vec_id", "of"), "of", "left").join(component.withColumnRenamed("node", "of"), "of", "left")
    n_links = F.coalesce("links", F.lit(0)) + F.coalesce("weight", F.lit(1)) - 1
    out = rows.select("vec_id", n_links.cast("long").alias("n_links"), F.coalesce("component", "of").alias("component_id"))
    return Links(out.withColumn("kept", F.col("vec_id") == F.col("component_id")), recall, overlap)


def _search(scratch: Scratch, units: DataFrame, centres: dict[int, np.ndarray], threshold: float, max_rows: int,
            overlap: int, tag: str, brute: bool = False) -> DataFrame:
    """(vec_id, links, root) per vector and shard."""
    found = None
    for dims, c in sorted(centres.items()):
        own = units.where(F.size("u") == dims) if len(centres) > 1 else units
        dealt = scratch.write(own.mapInArrow(_nearest(c, overlap), "vec_id long, u array<double>, weight long, shards array<int>"), f"dealt-{tag}-{dims}")
        counts = dealt.select(F.explode("shards").alias("s")).groupBy("s").count()
        # shards above the bound are cut into blocks of half a bound; every pair of blocks makes a shard
        large = {r["s"]: -(-2 * r["count"] // max_rows) for r in counts.where(F.col("count") > max_rows).collect()}
        if large:
            blocks = F.create_map(*[F.lit(v) for kv in large.items() for v in kv])
            homes = F.flatten(F.transform("shards", lambda s: F.when(
                blocks[s].isNull(), F.array(s.cast("long") * F.lit(1 << 40))).otherwise(F.transform(
                    F.sequence(F.lit(0), blocks[s] - 1), lambda j: s.cast("long") * F.lit(1 << 40) + 1
                    + F.least(j, _block(blocks[s])).cast("long") * F.lit(1 << 20) + F.greatest(j, _block(blocks[s])).cast("long")))))
        else:
            homes = F.transform("shards", lambda s: s.cast("long") * F.lit(1 << 40))
        homed = dealt.withColumn("homes", homes)
        # all rows of a shard need equally many homes to be compared as a matrix: pad with numbers of no shard
        width = overlap if not large else overlap * max(large.values())
        homed = homed.withColumn("homes", F.concat("homes", F.transform(
            F.sequence(F.lit(1), F.lit(width + 1)), lambda i: -(F.col("vec_id") * 0 + i).cast("long"))))
        homed = homed.withColumn("homes", F.slice("homes", 1, width))
        members = homed.select("vec_id", "u", "weight", "homes", F.explode(F.filter("homes", lambda h: h >= 0)).alias("shard"))
        held = members
        if not brute:
            edges = members.select("shard", "vec_id", "u").groupBy("shard").applyInArrow(_build, "vec_id long, near array<long>")
            near = edges.groupBy("vec_id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
            near = scratch.write(near, f"near-{tag}-{dims}")
            held = members.join(near, "vec_id")
        hits = held.groupBy("shard").applyInArrow(_find(threshold, brute), "vec_id long, links long, root long")
        hits = scratch.write(hits, f"hits-{tag}-{dims}")
        found = hits if found is None else found.unionByName(hits)
    return found if found is not None else units.sparkSession.createDataFrame([], "vec_id long, links long, root long")


def _block(blocks):
    """Block of a vector inside a shard that is cut into ``blocks``."""
    return F.pmod(F.xxhash64("vec_id", F.lit("block")), blocks).cast("int")
