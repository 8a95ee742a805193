"""Query catalogue: every registered key is a Spark job over the driver tables
plus (where SQL can express it) the DuckDB oracle for the same result.

Conventions shared with the oracle: doubles rounded to 4 dp, counts BIGINT,
``processed_at`` / ``created_at`` never emitted, every computed column aliased.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.sources.tables import read_table


@dataclass
class Entry:
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ops: str


REGISTRY: dict[str, Entry] = {}


def register(key: str, ops: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[key] = Entry(fn, sql, ops)
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def round_doubles(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every double column (oracle convention); counts cast to BIGINT stay."""
    return df.select(*[F.round(F.col(c), digits).alias(c) if t in ("double", "float") else F.col(c)
                       for c, t in df.dtypes])


def load_all() -> dict[str, Entry]:
    # Importing the modules registers their queries.
    from vitrine.plans import (  # noqa: F401
        queries_listing, queries_profile, queries_html, queries_ml, queries_misc, queries_models, queries_pages,
    )
    return REGISTRY
