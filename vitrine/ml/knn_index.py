"""J5 / M17 with an index: exact k nearest neighbours that meet only the blocks they need.

Train rows are dealt to k-means cells and packed into blocks of one cell; a block knows its rows' greatest distance from
the cell's centre.  Test rows are packed the same way.  By the triangle inequality no row of a block lies nearer to a
test row than the distance of the two centres less both radii.  Every test block first meets the blocks of its own cell;
the k-th best distances found there say which other blocks can still hold a nearer row, and only those are met.  Where a
cell is empty or has fewer than k rows, nothing is excluded, so the result is exact whatever the centres are.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.ml.models import _nearest, block_bucket, block_buckets
from vitrine.session import materialise

#: Cells, train rows that their centres are fitted on (a bounded sample by hash of the id), and rows per block.
CELLS = 32
FIT_ROWS = 20_000
BLOCK_ROWS = 1024

_BLOCK = "cell int, radius double, ids binary, vectors binary, labels binary"


def fit_cells(train: DataFrame, id_col: str, vec: str) -> np.ndarray:
    """Centres of at most ``CELLS`` cells."""
    n = train.count()
    place = F.pmod(F.xxhash64(id_col, F.lit("fit")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = train.where(place < 1.1 * FIT_ROWS / max(n, 1)).select(array_to_vector(F.col(vec).cast("array<double>")).alias("features"))
    if sample.isEmpty():
        return np.zeros((0, 0))
    return np.array(KMeans(k=CELLS, maxIter=8, seed=42).fit(sample).clusterCenters())


def _dealt(centres: np.ndarray):
    """Each row's nearest centre."""
    def run(batches):
        for pdf in batches:
            x = np.stack([np.asarray(v, dtype="<f8") for v in pdf["vec"]]) if len(pdf) else np.zeros((0, centres.shape[1]))
            pdf["cell"] = ((x ** 2).sum(1)[:, None] - 2 * x @ centres.T + (centres ** 2).sum(1)).argmin(1).astype("int32")
            yield pdf
    return run


def _packed(centres: np.ndarray, rows: int):
    """Blocks of one cell, of rows that come sorted by cell."""
    def run(batches):
        for pdf in batches:
            for cell, part in pdf.groupby("cell", sort=False):
                for lo in range(0, len(part), rows):
                    own = part.iloc[lo:lo + rows]
                    x = np.stack([np.asarray(v, dtype="<f8") for v in own["vec"]])
                    radius = float(np.sqrt(((x - centres[cell]) ** 2).sum(1)).max())
                    yield pd.DataFrame({"cell": [np.int32(cell)], "radius": [radius], "ids": [own["id"].to_numpy("<i8").tobytes()],
                                        "vectors": [x.tobytes()], "labels": [own["label"].to_numpy("<f8").tobytes()]})
    return run


def _blocks(df: DataFrame, centres: np.ndarray, name: str) -> DataFrame:
    """Written blocks with a number each; a cell with a third of the rows lies in many ranges."""
    dealt = df.mapInPandas(_dealt(centres), "id long, vec array<double>, label double, cell int").withColumn("salt", F.xxhash64("id"))
    ranged = dealt.repartitionByRange("cell", "salt").sortWithinPartitions("cell", "salt").drop("salt")
    return materialise(ranged.mapInPandas(_packed(centres, BLOCK_ROWS), _BLOCK).withColumn("block", F.monotonically_increasing_id()), name)


def block_pairs(tests: DataFrame, trains: DataFrame, centres: np.ndarray) -> DataFrame:
    """(t_block, block, home, apart): every pair of blocks with the least distance that rows of the two can have.

    Only these few numbers per pair are joined here, by cells; vectors follow for the pairs that are met.
    """
    gaps = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(-1))
    table = [(i, j, float(gaps[i, j])) for i in range(len(centres)) for j in range(len(centres))]  # CELLS squared rows
    between = F.broadcast(tests.sparkSession.createDataFrame(table, "t_cell int, cell int, gap double"))
    left = tests.select(F.col("block").alias("t_block"), F.col("cell").alias("t_cell"), F.col("radius").alias("t_radius"))
    pairs = left.join(between, "t_cell").join(trains.select("block", "cell", "radius"), "cell")
    apart = F.col("gap") - F.col("t_radius") - F.col("radius")
    return pairs.select("t_block", "block", (F.col("cell") == F.col("t_cell")).alias("home"), (apart - 1e-9 * (F.col("gap") + 1)).alias("apart"))


def knn_indexed(train: DataFrame, test: DataFrame, k: int = 3, id_col: str = "id", vec: str = "vec", label: str = "label",
                met: list | None = None) -> DataFrame:
    """As ``knn_predict``: Euclidean, ties by train id, uniform mean of the labels of the k nearest, per test id.

    ``met`` (a list) is given the numbers of block pairs that were met in both rounds and that there are.
    """
    shape = lambda df, y: df.select(F.col(id_col).cast("long").alias("id"), F.col(vec).cast("array<double>").alias("vec"), y.alias("label"))
    rows, asked = shape(train, F.col(label).cast("double")), shape(test, F.lit(0.0))
    centres = fit_cells(rows, "id", "vec")
    if not centres.size:
        return asked.select(F.col("id").alias(id_col), F.lit(None).cast("double").alias("pred")).limit(0)
    trains, tests = _blocks(rows, centres, "knn-train"), _blocks(asked, centres, "knn-test")
    pairs = materialise(block_pairs(tests, trains, centres), "knn-pairs")
    t_side = tests.select(F.col("block").alias("t_block"), F.col("ids").alias("t_ids"), F.col("vectors").alias("t_vectors"))
    best = Window.partitionBy("test_id").orderBy("dist", "train_id")
    buckets = block_buckets(trains)

    def walked(some: DataFrame) -> DataFrame:
        # a test block's vectors go once to every bucket that holds a train block it meets, not once to every such block
        wanted = some.groupBy("t_block", block_bucket(buckets, "block").alias("_b")).agg(F.collect_set("block").alias("_wanted"))
        dealt = wanted.join(t_side, "t_block")
        kept = trains.select(block_bucket(buckets, "block").alias("_b"), "block", "ids", "vectors", "labels")
        both = dealt.join(kept, "_b").where(F.array_contains("_wanted", F.col("block")))
        found = both.select("t_ids", "t_vectors", "ids", "vectors", "labels").mapInPandas(
            _nearest(k), "test_id long, train_id long, dist double, label double")
        return found.withColumn("_rk", F.row_number().over(best)).where(F.col("_rk") <= k)

    first = materialise(walked(pairs.where("home")), "knn-first")
    kth = first.where(F.col("_rk") == k).select("test_id", F.col("dist").alias("kth"))
    members = tests.mapInPandas(_members, "t_block long, test_id long")
    far = members.join(kth, "test_id", "left").groupBy("t_block").agg(F.max(F.coalesce("kth", F.lit(float("inf")))).alias("far"))
    later = materialise(pairs.where("NOT home").join(far, "t_block").where("apart <= far"), "knn-later")
    if met is not None:
        met += [pairs.where("home").count() + later.count(), pairs.count()]
    rest = walked(later)
    top = first.unionByName(rest).withColumn("_rk", F.row_number().over(best)).where(F.col("_rk") <= k)
    return top.groupBy(F.col("test_id").alias(id_col)).agg(F.avg("label").alias("pred"))


def _members(batches):
    for pdf in batches:
        for block, ids in zip(pdf["block"], pdf["ids"]):
            own = np.frombuffer(ids, "<i8")
            yield pd.DataFrame({"t_block": np.full(len(own), block), "test_id": own})
