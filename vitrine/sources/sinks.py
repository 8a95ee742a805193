"""Table sinks.

Every sink is a DataFrame write: executors write their partitions in
parallel and the commit protocol makes a retried (lost) task safe.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.session import checkpoint_dir


def route(sub_folder: str, platform: str) -> tuple[str, str]:
    """(namespace, table) for a scraped frame: links / raw / public, table = platform."""
    namespace = {"links": "links", "raw": "raw"}.get(sub_folder.lower(), "public")
    return namespace, platform.lower()


def append_with_stamp(df: DataFrame, path: str, fmt: str = "parquet", partition_by_day: bool = True) -> bool:
    """Append with an ingest stamp; empty input writes nothing.

    ``created_at`` is added when absent; bronze is partitioned by its date so the
    latest-snapshot read (S1) prunes partitions.  Returns whether rows were written.
    """
    if df.isEmpty():
        return False
    if "created_at" not in df.columns:
        df = df.withColumn("created_at", F.current_timestamp())
    writer = df.withColumn("created_date", F.to_date("created_at")).write.mode("append").format(fmt)
    if partition_by_day:
        writer = writer.partitionBy("created_date")
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.save(path)
    return True


def write_csv(df: DataFrame, directory: str, platform: str, sub_folder: str) -> str:
    """CSV layer named ``{platform}_{sub}``, replaced on each run."""
    path = os.path.join(directory, f"{platform.lower()}_{sub_folder.lower()}")
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


def replace_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Full replace of a silver/gold table."""
    w = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        w = w.option("header", True).option("escape", '"')
    w.save(path)


def replace_catalog_table(spark: SparkSession, df: DataFrame, namespace: str, table: str, folder: str | None = None) -> str:
    """S9 + S10 on a catalog: the namespace if it is absent, then the whole table replaced; returns the new version's folder.

    Every version is a folder of its own.  The catalog's name is a view of one version, and it is pointed at the new one
    only when that is written whole, in one catalog operation: a reader sees the old rows or the new ones, a reader that
    has begun goes on with the old, and an aborted write leaves the old.  Versions lie below ``folder`` (by default
    the session's shared checkpoint folder).
    """
    folder = (folder or f"{checkpoint_dir(spark).rstrip('/')}/tables").rstrip("/")
    create_namespace(spark, namespace, f"{folder}/{namespace}.db")
    staged = f"{folder}/{namespace}.db/{table}/v-{uuid.uuid4().hex}"
    df.write.parquet(staged)
    spark.sql(f"CREATE OR REPLACE VIEW `{namespace}`.`{table}` AS SELECT * FROM parquet.`{staged}`")
    return staged


def create_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    """S10."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{namespace}`" + (f" LOCATION '{location}'" if location else ""))


def write_options_json(options_df: DataFrame, path: str) -> None:
    """Categorical options as JSON (one small row: the map)."""
    options_df.coalesce(1).write.mode("overwrite").json(path)


def append_metrics(metrics_df: DataFrame, path: str) -> None:
    """Append one run's metrics to the ``model_runs`` table."""
    metrics_df.withColumn("logged_at", F.current_timestamp()).write.mode("append").parquet(path)
