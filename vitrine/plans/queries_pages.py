"""Queries over product pages of both sites.

The pages are built from the bronze listings, so the oracle states what they show without reading HTML.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.constants import HB_TO_TY, LABEL_TO_EN, LINK, PRICE, SCRAPED_AT
from vitrine.operators import page_tree as T
from vitrine.operators import product_pages as P
from vitrine.plans.catalog import register, table
from vitrine.sources.listing_view import SITES, bronze_sql, hb_bronze, ty_bronze
from vitrine.sources.page_view import NO_PRICE_MOD, PER_PAGE, detail_pages, list_pages, loosened


def _bronze(spark, sf_dir, site):
    """The site's listings, dealt to as many tasks as the session has cores: pages are made and read row by row."""
    rows = (ty_bronze if site == "ty" else hb_bronze)(table(spark, sf_dir, "part"))
    return rows.repartition(spark.sparkContext.defaultParallelism)


def _spaced(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


_SHOWN = "coalesce(title, 'Laptop <P> ' || CAST(_seq AS VARCHAR))"
_NAME = {"ty": f"trim({_spaced('coalesce(brand, chr(32))')} || ' ' || {_spaced(_SHOWN)})", "hb": "trim(title)"}


def _links_sql(site: str) -> str:
    return (f"SELECT page, CAST(rank + {1 if site == 'hb' else 0} AS BIGINT) AS pos, {_NAME[site]} AS name, {_spaced('price_try')} AS price, url AS link, "
            f"'{SITES[site][2]}' AS stamp FROM (SELECT *, CAST(floor(_seq / {PER_PAGE}) AS BIGINT) + 1 AS page, "
            f"row_number() OVER (PARTITION BY CAST(floor(_seq / {PER_PAGE}) AS BIGINT) ORDER BY _seq) - 1 AS rank "
            f"FROM ({bronze_sql(site)})) WHERE _seq % {NO_PRICE_MOD} <> 0")


def _links(spark, sf_dir, site):
    return P.extract_links(list_pages(_bronze(spark, sf_dir, site), site), P.PROFILES[site])


def _shown_links(spark, sf_dir, site):
    return _links(spark, sf_dir, site).select("page", "pos", F.col("Name").alias("name"), F.col("Price").alias("price"),
                                              F.col("Link").alias("link"), F.col("Timestamp").alias("stamp"))


@register("product_cards", "H2 H10 D3 D4", sql=_links_sql("ty"))
def q_product_cards(spark, sf_dir):
    return _shown_links(spark, sf_dir, "ty")


@register("product_list_items", "H3 H6 H10 D3 D4", sql=_links_sql("hb"))
def q_product_list_items(spark, sf_dir):
    return _shown_links(spark, sf_dir, "hb")


def _health_sql(site: str) -> str:
    menu = 1 if site == "hb" else 0   # the menu of a page is a list item without a price
    return (f"SELECT '{site}' AS site, CAST(floor(_seq / {PER_PAGE}) AS BIGINT) + 1 AS page, "
            f"count(*) FILTER (_seq % {NO_PRICE_MOD} <> 0) AS n_links, "
            f"count(*) FILTER (_seq % {NO_PRICE_MOD} = 0) + {menu} AS extract_errors FROM ({bronze_sql(site)}) GROUP BY 2")


@register("product_page_health", "H11", sql=f"{_health_sql('ty')} UNION ALL {_health_sql('hb')}")
def q_page_health(spark, sf_dir):
    per_site = [P.link_health(list_pages(_bronze(spark, sf_dir, s), s), P.PROFILES[s]).select(F.lit(s).alias("site"), "*") for s in ("ty", "hb")]
    return per_site[0].unionByName(per_site[1])


_FIELDS = [en for label, en in LABEL_TO_EN.items() if label not in (PRICE, LINK, SCRAPED_AT)]


def _details_sql(site: str) -> str:
    plain = [f"{_spaced(c)} AS {c}" for c in _FIELDS if c not in ("title", "brand")]
    whole, brand = _spaced("brand || ' ' || title"), _spaced("brand")
    title = f"trim(replace({whole}, {brand}, ''))" if site == "ty" else _spaced("title")
    return (f"SELECT url, {_spaced('price_try')} AS price_try, {title} AS title, "
            f"CASE WHEN title IS NOT NULL THEN {brand if site == 'ty' else 'trim(brand)'} END AS brand, {', '.join(plain)}, scraped_at "
            f"FROM ({bronze_sql(site)}) WHERE _seq % {NO_PRICE_MOD} <> 0")


def _details(spark, sf_dir, site):
    bronze = _bronze(spark, sf_dir, site)
    details = P.extract_details(detail_pages(bronze, site), P.PROFILES[site])
    rows = P.with_list_price(P.extract_links(list_pages(bronze, site), P.PROFILES[site]), details)
    return rows.select(*[F.col(c).alias(LABEL_TO_EN[HB_TO_TY.get(c, c)]) for c in rows.columns])


@register("product_details_ty", "H4 H5 H7 H8 H9 H10 H11 D4 J1", sql=_details_sql("ty"))
def q_details_ty(spark, sf_dir):
    return _details(spark, sf_dir, "ty")


@register("product_details_hb", "H4 H5 H6 H7 H8 H9 H10 H11 D4 J1", sql=_details_sql("hb"))
def q_details_hb(spark, sf_dir):
    return _details(spark, sf_dir, "hb")


def _loose(pages):
    return pages.withColumn("html", loosened(F.col("html")))


def _loose_links(spark, sf_dir, site):
    return T.extract_links(_loose(list_pages(_bronze(spark, sf_dir, site), site)), site)


@register("loose_cards_ty", "H2 H10 D3 D4", sql=_links_sql("ty"))
def q_loose_cards_ty(spark, sf_dir):
    """Cards of pages in loose markup, generated by a table function over the page's element tree."""
    return _loose_links(spark, sf_dir, "ty").toDF("page", "pos", "name", "price", "link", "stamp")


@register("loose_list_items_hb", "H3 H6 H10 D3 D4", sql=_links_sql("hb"))
def q_loose_cards_hb(spark, sf_dir):
    return _loose_links(spark, sf_dir, "hb").toDF("page", "pos", "name", "price", "link", "stamp")


def _loose_details(spark, sf_dir, site):
    details = T.extract_details(_loose(detail_pages(_bronze(spark, sf_dir, site), site)), site)
    rows = P.with_list_price(_loose_links(spark, sf_dir, site), details)
    return rows.select(*[F.col(c).alias(LABEL_TO_EN[HB_TO_TY.get(c, c)]) for c in rows.columns])


@register("loose_details_ty", "H4 H5 H7 H8 H9 H10 H11 D3 D4 J1", sql=_details_sql("ty"))
def q_loose_details_ty(spark, sf_dir):
    return _loose_details(spark, sf_dir, "ty")


@register("loose_details_hb", "H4 H5 H6 H7 H8 H9 H10 H11 D3 D4 J1", sql=_details_sql("hb"))
def q_loose_details_hb(spark, sf_dir):
    return _loose_details(spark, sf_dir, "hb")
