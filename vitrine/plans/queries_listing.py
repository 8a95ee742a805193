"""Listing ETL queries: standardisers, extractors, silver and gold (T*, F1, W1, A4, C1-C3, S1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.constants import LABEL_TO_EN, NUMERIC_BOUNDS, STOP_TOKENS
from vitrine.functions import categorical as cat
from vitrine.functions import numeric as num
from vitrine.functions import title as ttl
from vitrine.functions.geometry import ppi, ppi_from_text
from vitrine.functions.text import clean_text
from vitrine.operators.categories import group_rare
from vitrine.operators.dedup import keep_last
from vitrine.operators.filters import exclude_brand
from vitrine.operators.schema import map_string_columns, rename, tag_source, union_aligned
from vitrine.plans import etl
from vitrine.plans import oracle as O
from vitrine.plans.catalog import register, round_doubles, table
from vitrine.sources.listing_view import hb_bronze, ty_bronze
from vitrine.sources.tables import latest_snapshot

EN_OF = LABEL_TO_EN
KEY = ["src", "seq"]


def bronze(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    part = table(spark, sf_dir, "part")
    return hb_bronze(part), ty_bronze(part)


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 over the whole listing view (no snapshot filter): TY labels."""
    hb, ty = bronze(spark, sf_dir)
    return etl.merge_sources(hb, ty)


def merged_en(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged listings with English names, raw text."""
    return rename(merged(spark, sf_dir), EN_OF).withColumnsRenamed({"_src_rank": "src", "_seq": "seq"})


def cleaned_en(spark: SparkSession, sf_dir: str) -> DataFrame:
    return map_string_columns(merged_en(spark, sf_dir), clean_text)


def silver_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a part row is a few bytes but much work as a listing: the rows are dealt to all cores, not to the tasks of a small file
    part = table(spark, sf_dir, "part").repartition(spark.sparkContext.defaultParallelism)
    return etl.silver_from_bronze(hb_bronze(part), ty_bronze(part), snapshot=True)


def gold_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold reads a materialised silver, as the written-table ETL run does.

    Gold uses silver three times (rows, brand counts, OS counts); pruning makes
    those subtrees differ so Spark cannot reuse the exchange.  A reliable
    checkpoint (under ``spark.checkpoint.dir``) computes silver once.
    """
    return etl.gold(silver_df(spark, sf_dir).checkpoint(eager=True))


M = O.merged_cte()
C = O.cleaned_cte()


def _with(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


# ------------------------------------------------------------- flagship

@register("gold_by_brand", "S1 C1 C2 C3 T1-T18 W1 A4 A3", sql=(
    "WITH " + O.gold_ctes() +
    " SELECT brand, CAST(count(*) AS BIGINT) AS n_listings, round(avg(price_try), 4) AS avg_price_try, "
    "round(avg(ppi), 4) AS avg_ppi FROM gold GROUP BY brand"))
def q_gold_by_brand(spark, sf_dir):
    g = gold_df(spark, sf_dir)
    return round_doubles(g.groupBy("brand").agg(
        F.count(F.lit(1)).alias("n_listings"), F.avg("price_try").alias("avg_price_try"), F.avg("ppi").alias("avg_ppi")))


@register("silver_table", "C2 S1 C1 T1-T17 F1 W1 F2 P4 P9", sql=(
    "WITH " + O.silver_ctes() + " SELECT " + O.select_rounded(O.SILVER_COLS, O.SILVER_DOUBLES) + " FROM silver"))
def q_silver(spark, sf_dir):
    return round_doubles(silver_df(spark, sf_dir).select(*O.SILVER_COLS))


@register("gold_table", "C3 T18 A4 J2 F2 P5", sql=(
    "WITH " + O.gold_ctes() + " SELECT " + O.select_rounded(O.SILVER_COLS + ["ppi"], O.SILVER_DOUBLES + ["ppi"])
    + " FROM gold"))
def q_gold(spark, sf_dir):
    g = etl.finalize(gold_df(spark, sf_dir), stamp=False)
    return round_doubles(g.select(*O.SILVER_COLS, "ppi"))


# ------------------------------------------------------------- sources / union

@register("snapshot_latest_day", "S1 J4 A1 T23", sql=(
    "SELECT event_id, ts, user_id, event_type, round(value, 4) AS value FROM events "
    "WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)"))
def q_snapshot(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return round_doubles(latest_snapshot(ev, "ts"))


@register("union_aligned_sources", "P1 P2 P3 U1 U2", sql=(
    "SELECT c_custkey AS party_key, c_name AS name, c_nationkey AS nationkey, round(c_acctbal, 4) AS acctbal, "
    "'customer' AS platform, 0 AS src FROM customer UNION ALL "
    "SELECT s_suppkey, s_name, s_nationkey, round(s_acctbal, 4), 'supplier', 1 FROM supplier"))
def q_union(spark, sf_dir):
    cust = tag_source(table(spark, sf_dir, "customer"), "customer")
    supp = tag_source(table(spark, sf_dir, "supplier"), "supplier")
    cust = rename(cust, {"c_custkey": "party_key", "c_name": "name", "c_nationkey": "nationkey", "c_acctbal": "acctbal"})
    supp = rename(supp, {"s_suppkey": "party_key", "s_name": "name", "s_nationkey": "nationkey", "s_acctbal": "acctbal"})
    return round_doubles(union_aligned(cust, supp).withColumnRenamed("_src_rank", "src"))


# ------------------------------------------------------------- cleaning profile

_PROFILE_COLS = O.BRONZE_STRING_COLS


@register("clean_tokens_profile", "T1 P9 A6", sql=(
    _with(M, C) + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(count(*) - count(m.{c}) AS BIGINT) AS nulls_before, "
        f"CAST(count(*) - count(cl.{c}) AS BIGINT) AS nulls_after, CAST(count(DISTINCT cl.{c}) AS BIGINT) AS distinct_after "
        f"FROM merged m JOIN cleaned cl USING (_src_rank, _seq)"
        for c in _PROFILE_COLS)))
def q_clean_profile(spark, sf_dir):
    """Nulls before/after T1 and distinct cleaned values per column: one stacked pass.

    Counts per (column, cleaned value) are a partial aggregate (hot values
    collapse map-side); the per-column report folds that small table.
    """
    raw = merged_en(spark, sf_dir)
    cols = [x for c in _PROFILE_COLS for x in (F.lit(c), F.col(c), clean_text(F.col(c)))]
    long = raw.select(F.stack(F.lit(len(_PROFILE_COLS)), *cols).alias("column_name", "raw", "cleaned"))
    per_value = long.groupBy("column_name", "cleaned").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("raw").isNull().cast("long")).alias("raw_nulls"))
    return per_value.groupBy("column_name").agg(
        F.sum("raw_nulls").cast("bigint").alias("nulls_before"),
        F.coalesce(F.sum(F.when(F.col("cleaned").isNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("nulls_after"),
        F.count("cleaned").cast("bigint").alias("distinct_after"))


# ------------------------------------------------------------- standardisers

_NUMERIC = list(NUMERIC_BOUNDS.keys())


@register("numeric_fields", "T2 T3 F3", sql=(
    _with(M) + "SELECT _src_rank AS src, _seq AS seq, " + ", ".join(
        f"{O.r4(O.number(O.clean(c), *NUMERIC_BOUNDS[c]))} AS {c}" for c in _NUMERIC) + " FROM merged"))
def q_numeric(spark, sf_dir):
    m = merged_en(spark, sf_dir)
    return round_doubles(m.select(*KEY, *[num.parse_bounded(c).alias(c) for c in _NUMERIC]))


@register("price_parse", "T5", sql=(
    _with(M) + f"SELECT _src_rank AS src, _seq AS seq, price_try AS price_text, {O.r4(O.price(O.clean('price_try')))} AS price_try FROM merged"))
def q_price(spark, sf_dir):
    m = merged_en(spark, sf_dir)
    return round_doubles(m.select(*KEY, F.col("price_try").alias("price_text"),
                                  num.parse_price(clean_text("price_try")).alias("price_try")))


def _single(key: str, ops: str, col: str, spark_fn, sql_fn):
    register(key, ops, sql=(
        _with(M) + f"SELECT _src_rank AS src, _seq AS seq, {col} AS raw_value, {sql_fn(O.clean(col))} AS value FROM merged"
    ))(lambda spark, sf_dir: round_doubles(merged_en(spark, sf_dir).select(
        *KEY, F.col(col).alias("raw_value"), spark_fn(F.col(col)).alias("value"))))


_single("gpu_vram", "T4", "gpu_vram_gb", num.parse_gpu_vram, lambda x: O.r4(O.vram(x)))
_single("brand_map", "T6", "brand", cat.parse_brand, O.brand)
_single("os_family", "T7", "operating_system", cat.parse_os, O.os_family)
_single("gpu_type", "T8", "gpu_type", cat.parse_gpu_type, O.gpu_type)
_single("panel_type", "T9", "panel_type", cat.parse_panel_type, O.panel)
_single("resolution", "T10", "resolution", cat.parse_resolution, O.resolution)
_single("cpu_family", "T11", "cpu_family", cat.parse_cpu_family, O.cpu_family)


# ------------------------------------------------------------- title extractors

def _title_query(key: str, ops: str, spark_fn, sql_expr: str, pre: str = ""):
    sql = (_with(M, C) + (f", {pre} " if pre else "") +
           f"SELECT _src_rank AS src, _seq AS seq, title, {sql_expr} AS value FROM {'x' if pre else 'cleaned'}")
    register(key, ops, sql=sql)(lambda spark, sf_dir: round_doubles(cleaned_en(spark, sf_dir).select(
        *KEY, "title", spark_fn(F.col("title")).alias("value"))))


_title_query("title_ssd", "T12 T13", ttl.extract_ssd, O.title_ssd("title"))
_title_query("title_ram", "T14", ttl.extract_ram, O.title_ram("title", "t_ssd"),
             pre=f"x AS (SELECT *, {O.title_ssd('title')} AS t_ssd FROM cleaned)")
_title_query("title_hz", "T15", ttl.extract_refresh_rate, O.title_hz("title"))
_title_query("title_display", "T16", ttl.extract_display_standard, O.title_display("title"))


@register("fill_from_title", "T17 F4 D2", sql=(
    _with(M, C) + f", x AS (SELECT *, {O.title_ssd('title')} AS t_ssd FROM cleaned) "
    f"SELECT _src_rank AS src, _seq AS seq, coalesce(ram_gb, CAST({O.title_ram('title', 't_ssd')} AS VARCHAR)) AS ram_gb, "
    f"coalesce(ssd_gb, CAST(t_ssd AS VARCHAR)) AS ssd_gb, "
    f"coalesce(refresh_rate_hz, CAST({O.title_hz('title')} AS VARCHAR)) AS refresh_rate_hz, "
    f"coalesce(display_standard, {O.title_display('title')}) AS display_standard FROM x"))
def q_fill(spark, sf_dir):
    c = cleaned_en(spark, sf_dir)
    return c.select(*KEY,
                    ttl.fill_from_title("ram_gb", "title", ttl.extract_ram).alias("ram_gb"),
                    ttl.fill_from_title("ssd_gb", "title", ttl.extract_ssd).alias("ssd_gb"),
                    ttl.fill_from_title("refresh_rate_hz", "title", ttl.extract_refresh_rate).alias("refresh_rate_hz"),
                    ttl.fill_from_title("display_standard", "title", ttl.extract_display_standard).alias("display_standard"))


# ------------------------------------------------------------- filters, dedup, ppi, rare

@register("exclude_brand", "F1", sql=(
    _with(M, C) + "SELECT _src_rank AS src, _seq AS seq, brand, title FROM cleaned "
    "WHERE NOT (coalesce(contains(lower(brand), 'apple'), false) OR coalesce(contains(lower(title), 'macbook'), false))"))
def q_exclude(spark, sf_dir):
    return exclude_brand(cleaned_en(spark, sf_dir)).select(*KEY, "brand", "title")


@register("dedup_keep_last", "W1 W6", sql=(
    _with(M, C) + "SELECT src, seq, title, price_text FROM (SELECT _src_rank AS src, _seq AS seq, title, "
    "price_try AS price_text, row_number() OVER (PARTITION BY title, price_try ORDER BY _src_rank DESC, _seq DESC) AS rn "
    "FROM cleaned) WHERE rn = 1"))
def q_dedup(spark, sf_dir):
    c = cleaned_en(spark, sf_dir).select(*KEY, "title", F.col("price_try").alias("price_text"))
    return keep_last(c, ["title", "price_text"], KEY)


@register("dedup_events_keep_last", "W1", sql=(
    "SELECT event_id, user_id, event_type, ts, round(value, 4) AS value FROM (SELECT *, row_number() OVER "
    "(PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1"))
def q_dedup_events(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts", "value")
    return round_doubles(keep_last(ev, ["user_id", "event_type"], ["ts", "event_id"]))


@register("ppi", "T18 T19", sql=(
    _with(M, C) + ", p AS (SELECT _src_rank AS src, _seq AS seq, resolution AS resolution_text, "
    f"{O.resolution('resolution')} AS resolution, {O.number('screen_size_inch', 10, 20)} AS screen_size_inch FROM cleaned) "
    f"SELECT src, seq, resolution, round(screen_size_inch, 4) AS screen_size_inch, {O.r4(O.ppi('resolution', 'screen_size_inch'))} AS ppi, "
    "round(CASE WHEN screen_size_inch > 0 THEN sqrt(w*w + h*h) / screen_size_inch END, 4) AS ppi_text FROM ("
    "SELECT *, TRY_CAST(NULLIF(regexp_extract(replace(resolution_text, '×', 'x'), '(\\d{3,5})\\s*x\\s*(\\d{3,5})', 1), '') AS DOUBLE) AS w, "
    "TRY_CAST(NULLIF(regexp_extract(replace(resolution_text, '×', 'x'), '(\\d{3,5})\\s*x\\s*(\\d{3,5})', 2), '') AS DOUBLE) AS h FROM p)"))
def q_ppi(spark, sf_dir):
    c = cleaned_en(spark, sf_dir)
    p = c.select(*KEY, F.col("resolution").alias("resolution_text"),
                 cat.parse_resolution("resolution").alias("resolution"),
                 num.parse_bounded("screen_size_inch").alias("screen_size_inch"))
    return round_doubles(p.select(*KEY, "resolution", "screen_size_inch",
                                  ppi("resolution", "screen_size_inch").alias("ppi"),
                                  ppi_from_text("resolution_text", "screen_size_inch").alias("ppi_text")))


@register("rare_categories", "A4 J2", sql=(
    "SELECT p_partkey, CASE WHEN n < 80 THEN 'Other' ELSE p.p_brand END AS p_brand FROM part p "
    "LEFT JOIN (SELECT p_brand, count(*) AS n FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand) c "
    "ON p.p_brand = c.p_brand"))
def q_rare(spark, sf_dir):
    return group_rare(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), "p_brand", 80)


@register("rare_listing_brand", "A4 J2 T6", sql=(
    _with(M, C) + ", b AS (SELECT _src_rank AS src, _seq AS seq, " + O.brand("brand") + " AS brand FROM cleaned) "
    "SELECT src, seq, CASE WHEN n < 5 THEN 'Other' ELSE b.brand END AS brand FROM b "
    "LEFT JOIN (SELECT brand, count(*) AS n FROM b WHERE brand IS NOT NULL GROUP BY brand) c ON b.brand = c.brand"))
def q_rare_listing(spark, sf_dir):
    m = merged_en(spark, sf_dir).select(*KEY, cat.parse_brand("brand").alias("brand"))
    return group_rare(m, "brand", 5)
