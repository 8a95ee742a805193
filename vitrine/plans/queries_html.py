"""HTML extraction queries over ``pages``."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.operators import html as H
from vitrine.operators.joins import enrich_from_links
from vitrine.plans.catalog import register, table

HOST = r"^[a-z]+://([^/?#:]+)"
# Labels kept by the attribute extractor (a whitelist, like the 24 detail fields).
ATTR_LABELS = ["de", "the", "in", "en", "der", "is", "of", "and"]

_ANCHOR = r"<a\s([^>]*)>([^<]*)</a>"


def _sql_text(x: str) -> str:
    out = f"regexp_replace({x}, '<[^>]+>', ' ', 'g')"
    for ent, ch in H.HTML_ENTITIES:
        out = f"replace({out}, '{ent}', '{ch.replace(chr(39), chr(39) * 2)}')"
    return f"trim(regexp_replace({out}, '\\s+', ' ', 'g'))"


def _sql_unescape(x: str) -> str:
    out = x
    for ent, ch in H.HTML_ENTITIES:
        out = f"replace({out}, '{ent}', '{ch.replace(chr(39), chr(39) * 2)}')"
    return out


ANCHORS_SQL = (
    f"SELECT page_id, pos, NULLIF(regexp_extract(a, 'href=\"([^\"]*)\"', 1), '') AS href, {_sql_text('t')} AS text, "
    f"coalesce(NULLIF({_sql_unescape(chr(34) + 'ttl' + chr(34))}, ''), {_sql_text('t')}) AS value FROM ("
    f"SELECT page_id, a, t, pos, regexp_extract(a, 'title=\"([^\"]*)\"', 1) AS \"ttl\" FROM ("
    f"SELECT page_id, unnest(regexp_extract_all(html, '{_ANCHOR}', 1)) AS a, "
    f"unnest(regexp_extract_all(html, '{_ANCHOR}', 2)) AS t, "
    f"unnest(range(len(regexp_extract_all(html, '{_ANCHOR}', 1)))) AS pos FROM pages))")


@register("page_urls", "H1", sql=(
    f"WITH h AS (SELECT regexp_extract(url, '{HOST}', 1) AS host, count(*) AS n FROM pages GROUP BY 1) "
    "SELECT host, page, 'https://' || host || '/laptop?sayfa=' || CAST(page AS VARCHAR) AS url, "
    "'https://' || host || '/laptop?q=x' || '&pi=' || CAST(page AS VARCHAR) AS url_param "
    "FROM (SELECT host, unnest(range(1, n + 1)) AS page FROM h)"))
def q_page_urls(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    hosts = (pages.groupBy(F.regexp_extract("url", HOST, 1).alias("host")).agg(F.count(F.lit(1)).alias("n"))
             .withColumn("base", F.concat(F.lit("https://"), F.col("host"), F.lit("/laptop?sayfa=")))
             .withColumn("base_q", F.concat(F.lit("https://"), F.col("host"), F.lit("/laptop?q=x"))))
    suffix = H.page_urls(hosts, "base", "n", "suffix")
    return suffix.select("host", F.col("page").cast("long").alias("page"), "url",
                         F.concat(F.col("base_q"), F.lit("&pi="), F.col("page").cast("string")).alias("url_param"))


@register("link_extract", "H2 H3 H6 D3", sql=ANCHORS_SQL)
def q_links(spark, sf_dir):
    a = H.anchors(table(spark, sf_dir, "pages"))
    return a.select("page_id", F.col("pos").cast("long").alias("pos"), "href", "text", "value")


@register("anchor_health", "H11", sql=(
    f"SELECT page_id, CAST(len(regexp_extract_all(html, '{_ANCHOR}', 0)) AS BIGINT) AS n_links, "
    f"CAST(len(regexp_extract_all(html, '<a[\\s>]', 0)) - len(regexp_extract_all(html, '{_ANCHOR}', 0)) AS BIGINT) "
    "AS extract_errors FROM pages"))
def q_anchor_health(spark, sf_dir):
    return H.anchor_health(table(spark, sf_dir, "pages"))


def _heading_sql() -> str:
    h1 = "regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1)"
    strong = f"regexp_extract({h1}, '(?s)<strong[^>]*>(.*?)</strong>', 1)"
    text = _sql_text(h1)
    brand = f"NULLIF({_sql_text(strong)}, '')"
    title = _sql_text("regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1)")
    return (f"SELECT page_id, url, NULLIF({text}, '') AS h1, {brand} AS brand, "
            f"NULLIF(CASE WHEN {brand} IS NULL THEN {text} ELSE trim(replace({text}, {brand}, '')) END, '') AS name, "
            f"NULLIF({title}, '') AS page_title FROM pages")


@register("heading_extract", "H4", sql=_heading_sql())
def q_heading(spark, sf_dir):
    return H.heading(table(spark, sf_dir, "pages"))


@register("attr_fold", "H5 H7 H8", sql=(
    f"WITH a AS ({ANCHORS_SQL}), p AS (SELECT page_id, lower(text) AS label, coalesce(href, '') AS v, pos FROM a "
    f"WHERE lower(text) IN ({', '.join(repr(x) for x in ATTR_LABELS)})), "
    "f AS (SELECT page_id, label, list_reduce(list(v ORDER BY pos), "
    "lambda acc, x: CASE WHEN acc = '' OR acc = x THEN x ELSE acc || '; ' || x END) AS folded FROM p GROUP BY page_id, label) "
    "SELECT page_id, " + ", ".join(f"max(CASE WHEN label = '{x}' THEN folded END) AS \"{x}\"" for x in ATTR_LABELS)
    + " FROM f GROUP BY page_id"))
def q_attr_fold(spark, sf_dir):
    a = H.anchors(table(spark, sf_dir, "pages"))
    pairs = a.select("page_id", F.lower("text").alias("label"), F.coalesce("href", F.lit("")).alias("v"), "pos")
    return H.attribute_table(pairs, "page_id", "label", "v", "pos", ATTR_LABELS)


@register("link_detail_join", "J1 H9", sql=(
    f"WITH d AS ({_heading_sql()}), l AS (SELECT link, list_title FROM (SELECT url AS link, page_title AS list_title, "
    "row_number() OVER (PARTITION BY url ORDER BY page_id) AS rn FROM d) WHERE rn = 1) "
    "SELECT d.page_id, d.url AS link, d.name, l.list_title FROM d LEFT JOIN l ON d.url = l.link"))
def q_link_detail(spark, sf_dir):
    from vitrine.operators.dedup import keep_first

    pages = table(spark, sf_dir, "pages")
    details = H.heading(pages).select("page_id", F.col("url").alias("link"), "name")
    links = keep_first(H.heading(pages).select(F.col("url").alias("link"), F.col("page_title").alias("list_title"),
                                                F.col("page_id").alias("_pid")), ["link"], ["_pid"]).drop("_pid")
    return enrich_from_links(details, links, "link").select("page_id", "link", "name", "list_title")
