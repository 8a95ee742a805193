"""Category operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.constants import RARE_LABEL, RARE_THRESHOLD_DEFAULT


def value_counts(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    """A3: frequency per non-null value, most frequent first (value breaks ties)."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(name))
            .orderBy(F.col(name).desc(), F.col(col)))


def top_k_values(df: DataFrame, col: str, k: int, name: str = "n") -> DataFrame:
    """O2: the k most frequent values (ties by value).  At most k rows."""
    return value_counts(df, col, name).limit(k)


def keep_top_k(df: DataFrame, col: str, k: int) -> DataFrame:
    """Rows whose ``col`` is among the k most frequent values.

    The key side has at most k rows, so its broadcast is bounded by construction.
    """
    top = top_k_values(df, col, k).select(col)
    return df.join(F.broadcast(top), col, "left_semi")


def group_rare(df: DataFrame, col: str, threshold: int = RARE_THRESHOLD_DEFAULT, label: str = RARE_LABEL) -> DataFrame:
    """Values seen fewer than ``threshold`` times -> ``label``; NULL stays NULL.

    Counts are a partial+final aggregate (a hot value collapses map-side); the
    rare-value table is joined back (AQE broadcasts it when its measured size
    is small, see ``operators.joins``).
    A missing column is a no-op.
    """
    if col not in df.columns:
        return df
    rare = (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") < threshold).select(F.col(col).alias("_rare_value")))
    joined = df.join(rare, F.col(col) == F.col("_rare_value"), "left")
    return joined.select(*[
        F.when(F.col("_rare_value").isNotNull(), F.lit(label)).otherwise(F.col(c)).alias(c) if c == col else F.col(c)
        for c in df.columns
    ])


def distinct_sorted(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column, the sorted list of distinct non-null values (long form).

    One row per (column, value): distinct values of every column are found
    with one ``stack`` + ``distinct`` (partial aggregate), so no single task
    has to hold a whole list.  ``options_map`` folds it into one map for small
    option sets.
    """
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in cols)
    long = df.selectExpr(f"stack({len(cols)}, {pairs}) AS (column_name, value)").where(F.col("value").isNotNull())
    return long.distinct().orderBy("column_name", "value")


def options_map(df: DataFrame, cols: list[str]) -> DataFrame:
    """S12 payload: ``{column: [sorted values]}`` as one row (for bounded option sets)."""
    long = distinct_sorted(df, cols)
    per_col = long.groupBy("column_name").agg(F.array_sort(F.collect_list("value")).alias("values"))
    return per_col.agg(F.map_from_entries(F.collect_list(F.struct("column_name", "values"))).alias("options"))
