"""Filters and predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def excluded_brand(brand: str = "brand", title: str = "title") -> Column:
    """F1 predicate: brand contains 'apple' or title contains 'macbook' (case-insensitive).

    NULL never matches, so the negation keeps rows with NULL brand/title
    (plain ``~contains`` would drop them under three-valued logic).
    """
    b = F.coalesce(F.lower(F.col(brand)).contains("apple"), F.lit(False))
    t = F.coalesce(F.lower(F.col(title)).contains("macbook"), F.lit(False))
    return b | t


def exclude_brand(df: DataFrame, brand: str = "brand", title: str = "title") -> DataFrame:
    """drop Apple / MacBook listings."""
    return df.where(~excluded_brand(brand, title))


def drop_null(df: DataFrame, subset: list[str]) -> DataFrame:
    """Drop rows NULL in any of ``subset``."""
    return df.dropna(subset=subset)


def positive(df: DataFrame, col: str) -> DataFrame:
    """keep rows with ``col > 0`` (NULL dropped) before a log transform."""
    return df.where(F.col(col) > 0)


def keep_positive_share(df: DataFrame, col: str = "pct") -> DataFrame:
    """keep report rows whose share is above zero."""
    return df.where(F.col(col) > 0)
