"""HTML pages -> listing records.

The browser automation of a scraper is not rebuilt; what it extracts is a
Spark job over a table of raw pages.  Pages are not well-formed XML, so the
extraction is regular-expression based (``regexp_extract_all`` keeps every
match of the whole page, JVM-side), then rows come out of ``posexplode``.
Each page is processed independently: the work is split by page, and a
page's records never meet another page's before the final aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions.text import col_

# FIXED VALUES: HTML character references decoded in extracted text
# (``&amp;`` last, so '&amp;lt;' stays '&lt;').
HTML_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]

ANCHOR = r'<a\s([^>]*)>([^<]*)</a>'
QUOTES = "^[\"']|[\"']$"


def attribute_pattern(name: str) -> str:
    """Group 1: the quoted value of the attribute of exactly this name (``data-title`` is not ``title``)."""
    return rf"""(?s)(?:^|\s){name}\s*=\s*("[^"]*"|'[^']*')"""


def unescape(c: Column | str) -> Column:
    out = col_(c)
    for ent, ch in HTML_ENTITIES:
        out = F.replace(out, F.lit(ent), F.lit(ch))
    return out


def element_text(c: Column | str) -> Column:
    """Visible text of an HTML fragment: tags removed, entities decoded, white space collapsed."""
    no_tags = F.regexp_replace(col_(c), r"<[^>]+>", " ")
    return F.trim(F.regexp_replace(unescape(no_tags), r"(?U)\s+", " "))


def page_urls(df: DataFrame, base: str, n: str, style: str = "suffix", chunk: int = 10_000) -> DataFrame:
    """H1: listing-page URLs 1..n per base: ``base + p`` ('suffix') or ``base&pi=p`` ('param').

    Two-level generation: a base first expands into ranges of at most ``chunk``
    pages, the ranges are spread over partitions, then each range expands, so
    a base with a huge page count is not generated by a single task.
    """
    nn = F.col(n).cast("long")
    ranges = df.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((nn - 1) / chunk).cast("long")))
                       .alias("_chunk")).where(nn > 0)
    ranges = ranges.repartition(base, "_chunk")
    lo = F.col("_chunk") * chunk + 1
    hi = F.least((F.col("_chunk") + 1) * chunk, nn)
    rows = ranges.select("*", F.explode(F.sequence(lo, hi)).alias("page")).drop("_chunk")
    url = (F.concat(F.col(base), F.col("page").cast("string")) if style == "suffix"
           else F.concat(F.col(base), F.lit("&pi="), F.col("page").cast("string")))
    return rows.withColumn("url", url)


def anchors(pages: DataFrame, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """H2 / H3 / H6 / D3: one row per ``<a ...>text</a>`` of a page, in page order.

    ``value`` prefers the link's ``title`` attribute over its text (H6).
    """
    keep = keep or ["page_id"]
    attrs = F.regexp_extract_all(F.col(html), F.lit(ANCHOR), 1)
    texts = F.regexp_extract_all(F.col(html), F.lit(ANCHOR), 2)
    z = pages.select(*keep, F.posexplode(F.arrays_zip(attrs.alias("a"), texts.alias("t"))).alias("pos", "m"))
    href, title = (F.regexp_replace(F.regexp_extract(F.col("m.a"), attribute_pattern(a), 1), QUOTES, "") for a in ("href", "title"))
    text = element_text(F.col("m.t"))
    return z.select(*keep, "pos", F.nullif(href, F.lit("")).alias("href"), text.alias("text"),
                    F.coalesce(F.nullif(unescape(title), F.lit("")), text).alias("value"))


def anchor_health(pages: DataFrame, html: str = "html") -> DataFrame:
    """Anchors found vs anchors that did not parse (a bad one is skipped, not fatal)."""
    opened = F.size(F.regexp_extract_all(F.col(html), F.lit(r"<a[\s>]"), 0))
    parsed = F.size(F.regexp_extract_all(F.col(html), F.lit(ANCHOR), 0))
    return pages.select("page_id", parsed.cast("long").alias("n_links"), (opened - parsed).cast("long").alias("extract_errors"))


def heading(pages: DataFrame, html: str = "html") -> DataFrame:
    """H4: h1 text, brand (``<strong>`` inside the h1, if any) and name = h1 text without the brand."""
    h1 = F.regexp_extract(F.col(html), r"(?s)<h1[^>]*>(.*?)</h1>", 1)
    strong = F.regexp_extract(h1, r"(?s)<strong[^>]*>(.*?)</strong>", 1)
    text = element_text(h1)
    brand = F.nullif(element_text(strong), F.lit(""))
    name = F.when(brand.isNull(), text).otherwise(F.trim(F.replace(text, brand, F.lit(""))))
    title = element_text(F.regexp_extract(F.col(html), r"(?s)<title[^>]*>(.*?)</title>", 1))
    return pages.select("page_id", "url", F.nullif(text, F.lit("")).alias("h1"), brand.alias("brand"),
                        F.nullif(name, F.lit("")).alias("name"), F.nullif(title, F.lit("")).alias("page_title"))


def fold_repeated(values_in_order: Column) -> Column:
    """H8: ``acc = v if acc is empty or acc == v else acc + '; ' + v`` over the values in order.

    The comparison is with the whole accumulator, so A, B, A -> 'A; B; A'.
    """
    return F.aggregate(
        values_in_order, F.lit(None).cast("string"),
        lambda acc, v: F.when(acc.isNull() | (acc == "") | (acc == v), v).otherwise(F.concat(acc, F.lit("; "), v)))


def attribute_table(pairs: DataFrame, key: str, label: str, value: str, pos: str, labels: list[str]) -> DataFrame:
    """H5 / H7 / H8: (key, label, value, pos) rows -> one wide row per key.

    Only whitelisted labels are kept (missing -> NULL), repeated labels fold in
    page order.  Groups are (key, label): a page's own attributes.
    """
    kept = pairs.where(F.col(label).isin(labels))
    folded = (kept.groupBy(key, label)
              .agg(F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(value).alias("v")))).alias("_vals"))
              .select(key, label, fold_repeated(F.transform("_vals", lambda s: s["v"])).alias("_folded")))
    return folded.groupBy(key).pivot(label, labels).agg(F.first("_folded"))


def scrape_stamp(ts: Column | None = None) -> Column:
    """Scrape time as 'yyyy-MM-dd HH:mm:ss' text (injectable for tests)."""
    return F.date_format(ts if ts is not None else F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
