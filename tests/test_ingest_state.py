"""Stateful keep-last of the listing stream: many files, restarts, compaction, repeated batches."""

import os
from datetime import datetime

from pyspark.sql import functions as F

from vitrine.plans import etl
from vitrine.streaming import ingest as I

SCHEMA = "`Başlık` string, `Fiyat (TRY)` string, `Marka` string, created_at timestamp, _src_rank int, _seq long"


def _rows(site, day, ids):
    # titles repeat between files, days and sites; the last copy of a (title, price) has the greatest order
    return [(f"laptop {i % 23} 8 gb ram" if i % 7 else None, f"{(i % 5 + 1) * 1000},00 TL", f"brand {site}{day}{i}", datetime(2024, 5, day), site, day * 1000 + i)
            for i in ids]


def test_many_files_restart_and_compaction(spark, tmp_path):
    paths = [str(tmp_path / "hb"), str(tmp_path / "ty")]
    silver, checkpoint = str(tmp_path / "silver"), str(tmp_path / "checkpoint")
    landed = [None, None]
    for day in (2, 1, 3):  # an older day lands after a newer one
        for site, path in enumerate(paths):
            rows = spark.createDataFrame(_rows(site, day, range(210)), SCHEMA)
            landed[site] = rows if landed[site] is None else landed[site].unionByName(rows)
            rows.repartition(70).write.mode("append").parquet(path)
        schema = spark.read.parquet(paths[0]).schema
        I.incremental_silver(spark, *paths, silver, checkpoint, schema, schema, max_files=35, compact_every=3)
        want = etl.finalize(etl.silver(etl.merge_sources(*landed)), stamp=False)
        got = I.read_silver(spark, silver).drop("processed_at")
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect())) and got.count() > 50
    assert sum(f.endswith(".parquet") for f in os.listdir(paths[0])) >= 200
    # six batches, two bases: the folders that both cover are gone
    assert I._numbers(spark, f"{silver}/_base", "upto") == [2, 5]
    assert I._numbers(spark, silver, "batch_id") == [3, 4, 5]
    before = sorted(map(str, got.collect()))
    # a compaction that was cut off has no marker and counts for nothing; a batch written again leaves one copy
    os.makedirs(f"{silver}/_base/upto=9")
    batch = spark.read.parquet(f"{silver}/batch_id=4")
    again = spark.createDataFrame(batch.collect(), batch.schema)
    again.write.mode("overwrite").parquet(f"{silver}/batch_id=4")
    assert sorted(map(str, I.read_silver(spark, silver).drop("processed_at").collect())) == before
    # a reader of the time before the second base: deltas over the first one give the same rows
    older = I._merged(spark, silver, upto=5)
    assert older.count() == len(before)
