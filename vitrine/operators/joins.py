"""Join helpers.

Broadcast policy:

* a side bounded by construction (top-k keys, a one-row aggregate) is
  broadcast explicitly;
* a derived lookup table (category counts, rare labels) is joined plainly and
  AQE decides at runtime from its *measured* shuffle size
  (``spark.sql.adaptive.autoBroadcastJoinThreshold``): small -> broadcast hash
  join, large -> sort-merge join with skewed partitions split.  That runtime
  measurement is the size check, and the shuffle join is the way beyond it;
  the small side is not computed twice for a probe;
* ``guarded_broadcast`` probes a *stored* table's row count (cheap: a bounded
  ``limit`` scan) before hinting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a derived lookup table (category counts, labels) that is still fine
# to ship to every executor.
BROADCAST_ROW_BOUND = 1_000_000


def guarded_broadcast(small: DataFrame, max_rows: int = BROADCAST_ROW_BOUND) -> DataFrame:
    """Broadcast hint only if ``small`` has at most ``max_rows`` rows (bounded probe)."""
    n = small.limit(max_rows + 1).count()
    return F.broadcast(small) if n <= max_rows else small


def lookup_join(df: DataFrame, small: DataFrame, on, how: str = "left", bounded: bool = False,
                max_rows: int = BROADCAST_ROW_BOUND) -> DataFrame:
    """Join to a lookup table; ``bounded=True`` when its size is bounded by construction (e.g. top-k)."""
    rhs = F.broadcast(small) if bounded else guarded_broadcast(small, max_rows)
    return df.join(rhs, on, how)


def semi_join(df: DataFrame, keys: DataFrame, on, bounded: bool = False) -> DataFrame:
    """Rows whose key is in ``keys`` (left-semi)."""
    return lookup_join(df, keys, on, "left_semi", bounded=bounded)


def enrich_from_links(details: DataFrame, links: DataFrame, on: str = "link") -> DataFrame:
    """Detail rows take list-page fields by link (equi left join).

    Both sides grow with the crawl, so no broadcast is forced; AQE picks the
    strategy from the measured sizes.
    """
    return details.join(links, on, "left")


def align_by_id(left: DataFrame, right: DataFrame, id_col: str = "row_id") -> DataFrame:
    """Line up prediction columns of two model outputs by row id."""
    return left.join(right, id_col, "inner")
