"""Table readers.

``read_table`` is the one entry point for every job: parquet by default, CSV
with the bronze reader rules, or JDBC.  Jobs always ``select`` what they need
afterwards so Catalyst prunes columns at the scan.
"""

from __future__ import annotations

import logging
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger("vitrine.sources")

DRIVER_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, location: str, name: str | None = None, fmt: str = "parquet",
               schema: T.StructType | None = None, **options) -> DataFrame:
    """Read a table by format.

    * parquet: ``location`` is a directory of tables (``name`` given) or a path.
    * csv: header + all-string schema unless ``schema`` is given (S5).
    * jdbc: ``location`` is the JDBC URL, ``name`` the table or ``(subquery) t``.
    """
    if fmt == "parquet":
        path = table_path(location, name) if name else location
        return spark.read.parquet(path)
    if fmt == "csv":
        path = os.path.join(location, name) if name else location
        return read_bronze_csv(spark, path, schema=schema, **options)
    if fmt == "jdbc":
        reader = spark.read.format("jdbc").option("url", location).option("dbtable", name)
        for k, v in options.items():
            reader = reader.option(k, v)
        return reader.load()
    return spark.read.format(fmt).options(**options).load(location)


def jdbc_predicates(spark: SparkSession, url: str, table: str, key: str, ranges: int, cells: int = 1024, **options) -> list[str]:
    """Conditions that cut a table into about ``ranges`` parts of like size by a numeric key; every row meets one.

    The database counts the rows of ``cells`` equal steps between the least and the greatest key, in one aggregate of
    ``cells`` rows at most; neighbouring steps are put together until a part has its share, so a crowded stretch of keys is
    cut finer than an empty one.  Rows without a key belong to the first part.  A single key with more than a share is one
    part: a key cannot be cut.
    """
    def ask(query: str) -> DataFrame:
        return read_table(spark, url, f"({query}) t", fmt="jdbc", **options)

    low, high = ask(f"SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {table}").first()
    if low is None:
        return ["1 = 1"]
    low, high = int(low), int(high)
    width = (high - low) // cells + 1
    counts = ask(f"SELECT ({key} - {low}) / {width} AS cell, COUNT(*) AS n FROM {table} WHERE {key} IS NOT NULL GROUP BY ({key} - {low}) / {width}").collect()
    share = sum(r[1] for r in counts) / max(1, ranges)
    edges, held = [], 0
    for cell, n in sorted((int(r[0]), r[1]) for r in counts):
        if held and held + n / 2 > share:
            edges.append(low + cell * width)
            held = 0
        held += n
    bounds = [None, *edges, None]
    parts = [" AND ".join([*([f"{key} >= {a}"] if a is not None else []), *([f"{key} < {b}"] if b is not None else [])]) or f"{key} >= {low}"
             for a, b in zip(bounds, bounds[1:])]
    return [f"({parts[0]}) OR {key} IS NULL", *parts[1:]]


def read_jdbc_partitioned(spark: SparkSession, url: str, table: str, key: str, ranges: int, **options) -> DataFrame:
    """A database table read by one task per part of ``jdbc_predicates``."""
    return spark.read.jdbc(url, table, predicates=jdbc_predicates(spark, url, table, key, ranges, **options),
                           properties={k: str(v) for k, v in options.items()})


def read_bronze_csv(spark: SparkSession, path: str, columns: list[str] | None = None,
                    schema: T.StructType | None = None, **options) -> DataFrame:
    """Scraped CSV, header row, UTF-8, every field a string, '"' doubled inside quotes.

    Without ``escape='"'`` titles holding inch marks ('15.6""') shift columns.
    The header is read to build an all-string schema, never ``inferSchema``.

    ``_seq`` is the order that keep-last relies on: the file's own ``_seq`` column if it has one, else the place of the
    row in the file (a file of quoted line breaks is read whole by one task, so its rows are numbered in order).
    """
    if schema is None:
        if columns is None:
            columns = spark.read.option("header", True).option("escape", '"').csv(path).columns
        schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    reader = (spark.read.option("header", True).option("escape", '"').option("multiLine", True)
              .option("encoding", "UTF-8").schema(schema))
    for k, v in options.items():
        reader = reader.option(k, v)
    rows = reader.csv(path)
    own = F.col("_seq").cast("long") if "_seq" in rows.columns else F.monotonically_increasing_id()
    return rows.withColumn("_seq", own)


def latest_snapshot(df: DataFrame, ts_col: str = "created_at", label: str = "") -> DataFrame:
    """Rows whose ``DATE(ts)`` equals the latest date in the table.

    The latest day is a scalar subquery (partial + final max aggregate, one
    value).  On a ``created_date``-partitioned bronze the same predicate prunes
    partitions.
    """
    if ts_col == "created_at" and "created_date" in df.columns:
        # landed bronze (S6) is partitioned by created_date: filtering the
        # partition column lets the scan prune whole partitions at runtime
        latest = df.agg(F.max("created_date")).scalar()
        return df.where(F.col("created_date") == latest)
    latest = df.agg(F.max(F.to_date(F.col(ts_col)))).scalar()
    return df.where(F.to_date(F.col(ts_col)) == latest)


def warn_if_empty(*frames: DataFrame, label: str = "snapshot") -> bool:
    """Log a warning when every frame is empty (cheap ``isEmpty``: one row probe)."""
    empty = all(f.isEmpty() for f in frames)
    if empty:
        log.warning("no rows on the latest processing date (%s)", label)
    return empty
