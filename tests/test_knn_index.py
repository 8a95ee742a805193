"""Indexed neighbours equal the exhaustive search and meet fewer blocks."""

import numpy as np
import pytest

from vitrine.ml import knn_index as K
from vitrine.ml.models import knn_predict


def frame(spark, x, labels, first):
    return spark.createDataFrame([(first + i, [float(c) for c in v], float(y)) for i, (v, y) in enumerate(zip(x, labels))],
                                 "id long, vec array<double>, label double")


def test_equals_exhaustive_search(spark, monkeypatch):
    monkeypatch.setattr(K, "CELLS", 12)
    monkeypatch.setattr(K, "BLOCK_ROWS", 40)
    rng = np.random.default_rng(1)
    base = rng.normal(size=(12, 6)) * 12
    x = base[rng.integers(0, 12, 1200)] + rng.normal(size=(1200, 6))
    x[50:60] = x[0]  # ties
    q = np.concatenate([base[rng.integers(0, 12, 150)] + rng.normal(size=(150, 6)), rng.normal(size=(5, 6)) * 60, x[:3]])
    train, test = frame(spark, x, rng.integers(0, 9, 1200), 0).repartition(3), frame(spark, q, np.zeros(len(q)), 5000)
    met: list = []
    got = {r.id: r.pred for r in K.knn_indexed(train, test, 3, met=met).collect()}
    want = {r.id: r.pred for r in knn_predict(train, test, 3).collect()}
    assert got == pytest.approx(want) and len(got) == len(q)
    assert met[0] < 0.5 * met[1], met


def test_fewer_rows_than_neighbours(spark):
    train, test = frame(spark, [[0.0, 0.0], [9.0, 9.0]], [1, 3], 0), frame(spark, [[1.0, 1.0]], [0], 10)
    assert [(r.id, r.pred) for r in K.knn_indexed(train, test, 3).collect()] == [(10, 2.0)]
    assert K.knn_indexed(train.limit(0), test, 3).count() == 0 and K.knn_indexed(train, test.limit(0), 3).count() == 0


def test_screened_pairs_are_those_of_direct_differences(spark):
    """Near ties, exact ties, huge offsets and values that are no numbers: the screened k are bit for bit the direct ones."""
    import numpy as np
    import pandas as pd

    from vitrine.ml import models as M

    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 16))
    for shift, scale in ((0.0, 1.0), (1e8, 1e-3), (0.0, 1e-160), (0.0, 1e155)):
        trains = np.concatenate([base, base, base + rng.normal(size=base.shape) * 1e-13]) * scale + shift
        tests, ids = base[:9] * scale + shift, rng.permutation(len(trains)).astype("<i8")
        for odd in (trains, np.where(np.arange(len(trains))[:, None] == 5, np.nan, trains)):
            row = pd.DataFrame([{"t_ids": np.arange(9, dtype="<i8").tobytes(), "t_vectors": tests.tobytes(), "ids": ids.tobytes(),
                                 "vectors": odd.tobytes(), "labels": np.zeros(len(ids)).tobytes()}])
            got = pd.concat(M._nearest(3)(iter([row, row])))
            r, c, d = M._direct(tests, odd, ids, 3)
            # the two equal blocks bring every candidate twice
            want = pd.DataFrame({"test_id": np.repeat(r, 2), "train_id": np.repeat(ids[c], 2), "dist": np.repeat(d, 2)}).groupby("test_id").head(3)
            assert got[["test_id", "train_id"]].values.tolist() == want[["test_id", "train_id"]].values.tolist()
            assert got["dist"].to_numpy().tobytes() == want["dist"].to_numpy().tobytes()


def test_test_blocks_are_dealt_to_buckets_by_cores(spark):
    """However many train blocks there are, a test block is shuffled once per bucket."""
    from vitrine.ml import models as M

    assert M.block_buckets(spark.range(100_000)) == 4 * spark.sparkContext.defaultParallelism
    assert M.block_buckets(spark.range(2)) == 2 and M.block_buckets(spark.range(0)) == 1
