"""Incremental silver from appended bronze files.

Bronze lands as append-only parquet (S6, partitioned by ``created_date``).  A file-source stream per site, with the
bronze schema, is merged (C1) and cleaned as far as the deduplication key, like the batch job.  A streaming aggregate keeps the
last copy of every (title, price text) in Spark's state store: a batch reads its new rows and the winners of their keys,
never earlier batches.  Keep-last by a fixed order is associative, so the winners are the batch job's over all landed
rows, whatever the number or order of files.  No watermark: no row is late.

The winners of the keys that a batch touched, parsed, replace the folder ``batch_id=N``: a batch that is run again
after its write leaves one copy.  Every ``compact_every`` batches the folders are merged into a base table
``_base/upto=N``, so a reader meets the newest base and the few folders after it.  A base counts once its success marker is
there, and is made from folders that never change, so an aborted or repeated compaction does no harm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions.text import clean_text
from vitrine.operators.dedup import keep_last
from vitrine.plans import etl

PRICE_KEY = "_price_key"
KEYS = ["title", PRICE_KEY]
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def bronze_stream(spark: SparkSession, path: str, schema, max_files: int = 64) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def incremental_silver(spark: SparkSession, hb_path: str, ty_path: str, silver_path: str, checkpoint: str,
                       hb_schema, ty_schema, max_files: int = 64, compact_every: int = 8) -> None:
    """Run the stream until the landed files are processed (availableNow); a later call goes on where it stopped.

    The state is as large as silver and lies in RocksDB on the executors, with its changes in ``checkpoint``.
    """
    if "RocksDB" not in spark.conf.get(STORE, ""):
        spark.conf.set(STORE, ROCKSDB)
    merged = etl.merge_sources(bronze_stream(spark, hb_path, hb_schema, max_files), bronze_stream(spark, ty_path, ty_schema, max_files))
    keyed = etl.silver_keyed(merged.withColumn(PRICE_KEY, clean_text(F.col("Fiyat (TRY)"))))
    winners = keep_last(keyed, etl.SILVER_KEYS, [c for c in etl.ORDER_COLS if c in keyed.columns])

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        etl.silver_parsed(batch).write.mode("overwrite").parquet(f"{silver_path}/batch_id={batch_id}")
        if (batch_id + 1) % compact_every == 0:
            compact(batch.sparkSession, silver_path, batch_id)

    q = (winners.writeStream.outputMode("update").foreachBatch(write_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def _numbers(spark: SparkSession, folder: str, prefix: str, marker: str = "_SUCCESS") -> list[int]:
    """Numbers N of the finished subfolders ``prefix=N``, ascending; one listing, as long as there are batches to merge."""
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = [e.getPath() for e in fs.listStatus(root) if e.getPath().getName().startswith(f"{prefix}=")]
    return sorted(int(p.getName().split("=")[1]) for p in found if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, marker)))


def _merged(spark: SparkSession, silver_path: str, upto: int | None = None) -> DataFrame:
    """One row per key: the newest base, with the keys of later folders replaced by their last rows."""
    bases = [n for n in _numbers(spark, f"{silver_path}/_base", "upto") if upto is None or n < upto]
    since = bases[-1] if bases else -1
    later = [n for n in _numbers(spark, silver_path, "batch_id") if n > since and (upto is None or n <= upto)]
    base = spark.read.parquet(f"{silver_path}/_base/upto={since}") if bases else None
    if not later and base is not None:
        return base
    rows = spark.read.option("basePath", silver_path).parquet(*[f"{silver_path}/batch_id={n}" for n in later])
    newest = keep_last(rows, KEYS, ["batch_id"]).drop("batch_id")
    if base is None:
        return newest
    changed = newest.select(*[F.col(k).alias(f"_new{k}") for k in KEYS])
    same = [base[k].eqNullSafe(changed[f"_new{k}"]) for k in KEYS]
    return base.join(changed, same, "left_anti").unionByName(newest)


def compact(spark: SparkSession, silver_path: str, upto: int) -> None:
    """Write the winners after batch ``upto`` as the new base; folders that two bases cover are deleted.

    The folders since the base before stay, for readers that began with it.
    """
    _merged(spark, silver_path, upto).write.mode("overwrite").parquet(f"{silver_path}/_base/upto={upto}")
    bases = _numbers(spark, f"{silver_path}/_base", "upto")
    if len(bases) < 2:
        return
    old = [f"{silver_path}/batch_id={n}" for n in _numbers(spark, silver_path, "batch_id") if n <= bases[-2]]
    old += [f"{silver_path}/_base/upto={n}" for n in bases[:-2]]
    for folder in old:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def read_silver(spark: SparkSession, silver_path: str) -> DataFrame:
    """The last copy of every (title, price text) over all batches, in the declared column order."""
    return etl.finalize(_merged(spark, silver_path).drop(PRICE_KEY), stamp=True)


def land_bronze(df: DataFrame, path: str) -> None:
    """S6 for the landing zone: append, partitioned by the ingest day."""
    from vitrine.sources.sinks import append_with_stamp

    append_with_stamp(df, path, "parquet", partition_by_day=True)


def scratch_root(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint directory (never a machine-local temp dir)."""
    import uuid

    from vitrine.session import checkpoint_dir

    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
