"""Deduplication.

Keep-last is written as an aggregate, not a window: ``max_by`` over the
ordering key runs a partial aggregate before the shuffle, so a key that holds a
third of all rows collapses map-side to one row per input partition instead
of landing whole in one window task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per ``keys`` (NULLs equal), the one with the greatest ``order``.

    ``order`` are columns giving the input order (e.g. ``_src_rank``, ``_seq``);
    the row that comes last in that order wins, like pandas ``keep="last"``.
    """
    rest = [c for c in df.columns if c not in keys]
    picked = (df.groupBy(*keys)
              .agg(F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order])).alias("_row")))
    return picked.select(*[F.col(k) for k in keys], *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """W2 (ordered form): the row with the smallest ``order`` per key."""
    rest = [c for c in df.columns if c not in keys]
    picked = (df.groupBy(*keys)
              .agg(F.min_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order])).alias("_row")))
    return picked.select(*[F.col(k) for k in keys], *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


def text_digest(text: str) -> list[Column]:
    """Short key of a long text (256-bit digest and length), so that texts themselves are not shuffled; NULL stays NULL."""
    return [F.sha2(F.col(text).cast("binary"), 256).alias("text_digest"), F.octet_length(text).alias("text_length")]


def distinct_rows(df: DataFrame) -> DataFrame:
    """Full-row dedup; all copies are equal so any one is kept."""
    return df.distinct()


def group_counts(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    """A17 building block: copies per distinct key (partial aggregate before shuffle)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def flag_duplicates(df: DataFrame, keys: list[str], name: str = "is_dup") -> DataFrame:
    """Mark every member of a group with more than one copy (pandas ``keep=False``).

    Counts come from a pre-aggregated table joined back null-safely; AQE turns
    the join into a broadcast when the count table is small and splits a hot
    group's partition otherwise.
    """
    counts = (group_counts(df, keys, "_n").where(F.col("_n") > 1)
              .select(*[F.col(k).alias(f"_dk{i}") for i, k in enumerate(keys)], "_n"))
    cond = [F.col(k).eqNullSafe(F.col(f"_dk{i}")) for i, k in enumerate(keys)]
    joined = df.join(counts, cond, "left")
    return joined.select(*df.columns, F.col("_n").isNotNull().alias(name))


def duplicate_summary(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Rows in duplicate groups (keep=False), rows dropped by keep-first, rows remaining."""
    keys = keys or df.columns
    c = group_counts(df, keys, "_n")
    return c.agg(
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).cast("bigint").alias("rows_in_dup_groups"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("rows_dropped"),
        F.count(F.lit(1)).cast("bigint").alias("rows_remaining"),
    )
