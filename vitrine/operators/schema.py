"""Projection and schema operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.constants import FINAL_COLUMN_ORDER

NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double")


def tag_source(df: DataFrame, platform: str, col: str = "platform") -> DataFrame:
    """Constant source tag."""
    return df.withColumn(col, F.lit(platform))


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename by map; names not present are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def common_columns(left: DataFrame, right: DataFrame) -> list[str]:
    """Column-name intersection, in the left frame's order (deterministic)."""
    rc = set(right.columns)
    return [c for c in left.columns if c in rc]


def union_aligned(first: DataFrame, second: DataFrame) -> DataFrame:
    """Union-all by name over the common columns, ``first`` rows first.

    A ``_src_rank`` (0 for the first, 1 for the second input) records the order
    so later keep-last logic does not depend on physical row order.
    """
    cols = [c for c in common_columns(first, second) if c != "_src_rank"]
    return (first.select(*cols).withColumn("_src_rank", F.lit(0))
            .unionByName(second.select(*cols).withColumn("_src_rank", F.lit(1))))


def columns_of_type(df: DataFrame, kind: str) -> list[str]:
    """P8: 'string' / 'number' / 'other' columns from ``df.dtypes``."""
    if kind == "string":
        return [c for c, t in df.dtypes if t == "string"]
    if kind == "number":
        return [c for c, t in df.dtypes if t in NUMERIC_TYPES or t.startswith("decimal")]
    return [c for c, t in df.dtypes if t != "string" and t not in NUMERIC_TYPES]


def map_string_columns(df: DataFrame, fn, skip: tuple[str, ...] = ()) -> DataFrame:
    """Apply ``fn`` to every string column in one projection (no withColumn loop)."""
    stypes = dict(df.dtypes)
    return df.select(*[
        fn(F.col(c)).alias(c) if stypes[c] == "string" and c not in skip else F.col(c)
        for c in df.columns
    ])


def canonical_order(df: DataFrame, order: list[str] = FINAL_COLUMN_ORDER, after: dict[str, str] | None = None) -> DataFrame:
    """P5: declared columns that exist, in order; extra columns appended.

    ``after`` inserts new columns after a declared one (``{'ppi': 'screen_size_inch'}``).
    """
    target = list(order)
    for new, anchor in (after or {}).items():
        if new in df.columns and new not in target and anchor in target:
            target.insert(target.index(anchor) + 1, new)
    head = [c for c in target if c in df.columns]
    tail = [c for c in df.columns if c not in head]
    return df.select(*head, *tail)


def stamp_processed(df: DataFrame, col: str = "processed_at") -> DataFrame:
    """Processing time."""
    return df.withColumn(col, F.current_timestamp())


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop, ignoring names that are not there."""
    return df.drop(*[c for c in cols if c in df.columns])


def swap_columns(df: DataFrame, a: str, b: str) -> DataFrame:
    """Swap two column positions."""
    cols = list(df.columns)
    i, j = cols.index(a), cols.index(b)
    cols[i], cols[j] = cols[j], cols[i]
    return df.select(*cols)


def split_target(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """(features, target) projections."""
    return df.drop(target), df.select(target)


def rows_to_frame(spark, rows: list[dict], schema: T.StructType) -> DataFrame:
    """Request dicts -> frame with a fixed schema; absent keys -> NULL."""
    names = [f.name for f in schema.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)
