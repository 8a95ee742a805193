"""Spark session defaults shared by jobs, tests and the bench.

On a cluster the session already exists (spark-submit / notebook); ``configure``
always sets what results rely on (time zone, ANSI) and leaves the cluster's tuning
(shuffle partitions, checkpoint folder, AQE) as it is.  The adaptive settings below
apply only to a session that ``get_session`` builds.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on for correct results (not tuning knobs).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Scale defaults: AQE re-plans joins/partition counts at runtime and splits
# skewed shuffle partitions; Arrow makes pandas exchange columnar.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Explicit broadcasts in this package are guarded by a row-count bound; the
    # automatic threshold stays at Spark's default (10 MB) so Catalyst can still
    # broadcast provably small scans (dimension tables, one-row aggregates).
}


def get_session(master: str | None = None, app: str = "vitrine", shuffle_partitions: int | None = None,
                checkpoint: str | None = None) -> SparkSession:
    """Return the active session, or build a local one for tests / bench."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return configure(active)
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
    )
    for k, v in {**REQUIRED_CONF, **SCALE_CONF}.items():
        builder = builder.config(k, v)
    if checkpoint:
        builder = builder.config("spark.checkpoint.dir", checkpoint)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


#: Bounds on one Arrow batch to a Python worker, set only where the session has Spark's own defaults.
BATCH_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"),
    "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "4194304b"),
}


def configure(spark: SparkSession) -> SparkSession:
    """Set what results rely on (always) and what is still at Spark's default among the batch bounds."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    for k, (default, own) in BATCH_CONF.items():
        if spark.conf.get(k, default) == default:
            spark.conf.set(k, own)
    if spark.conf.get("spark.checkpoint.dir", None):
        checkpoint_dir(spark)
    return spark


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and return the written table.

    Whatever is derived from the result sees the same rows and partitions, also when a task is run again.
    """
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_WRITTEN: dict[tuple, str] = {}


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in whatever store it names; other errors are not taken for absence."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def materialise_once(spark: SparkSession, name: str, key: str, make) -> DataFrame:
    """``make()`` written once per application, name and key; later calls read the same table while it is there."""
    mark = (spark.sparkContext.applicationId, name, key)
    if mark not in _WRITTEN or not path_exists(spark, _WRITTEN[mark]):
        df = make()
        path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        _WRITTEN[mark] = path
    return spark.read.parquet(_WRITTEN[mark])


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``; also makes it the context's checkpoint folder.

    The library never invents a folder: on a cluster a machine-local one would lose data with its machine.  Tests
    and the bench name their own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder
