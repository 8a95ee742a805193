"""Bronze -> silver -> gold listing ETL.

Silver is one wide projection (cleaning, title fills, parsing) around a single
shuffle (keep-last deduplication).  Gold adds PPI and rare-category grouping,
whose counts for all grouped columns come from ONE partial aggregate over a
stacked (column, value) view.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.constants import (
    FINAL_COLUMN_ORDER, HB_TO_TY, LABEL_TO_EN, NUMERIC_BOUNDS, RARE_LABEL, RARE_THRESHOLD_GOLD,
)
from vitrine.functions.categorical import (
    parse_brand, parse_cpu_family, parse_gpu_type, parse_os, parse_panel_type, parse_resolution,
)
from vitrine.functions.geometry import ppi
from vitrine.functions.numeric import parse_gpu_vram, parse_numeric, parse_price
from vitrine.functions.text import clean_text
from vitrine.functions.title import extract_display_standard, extract_ram, extract_refresh_rate, extract_ssd
from vitrine.operators.dedup import keep_last
from vitrine.operators.filters import exclude_brand
from vitrine.operators.schema import canonical_order, map_string_columns, rename, tag_source, union_aligned
from vitrine.sources.tables import latest_snapshot, warn_if_empty

log = logging.getLogger("vitrine.etl")

ORDER_COLS = ["_src_rank", "_seq"]
INTERNAL_COLS = ORDER_COLS


def merge_sources(hb: DataFrame, ty: DataFrame) -> DataFrame:
    """Tag platforms, map HB labels to TY labels, union the common columns, TY first."""
    hb = rename(tag_source(hb, "hepsiburada"), HB_TO_TY)
    ty = tag_source(ty, "trendyol")
    return union_aligned(ty, hb)


def _parsers(df_types: dict[str, str]) -> dict:
    """Silver parsers; input columns are already cleaned (T1 is idempotent)."""
    out = {
        "gpu_vram_gb": lambda c: parse_gpu_vram(c, cleaned=True),
        "brand": lambda c: parse_brand(c, cleaned=True),
        "operating_system": lambda c: parse_os(c, cleaned=True),
        "cpu_family": lambda c: parse_cpu_family(c, cleaned=True),
        "gpu_type": lambda c: parse_gpu_type(c, cleaned=True),
        "resolution": lambda c: parse_resolution(c, cleaned=True),
        "panel_type": lambda c: parse_panel_type(c, cleaned=True),
    }
    for name, (lo, hi) in NUMERIC_BOUNDS.items():
        out[name] = (lambda lo_, hi_: (lambda c: parse_numeric(c, lo_, hi_, cleaned=True)))(lo, hi)
    return out


# Bronze label of each title-filled attribute -> intermediate column.
_FILL_TARGETS = {
    "Ram (Sistem Belleği)": "_t_ram",
    "SSD Kapasitesi": "_t_ssd",
    "Ekran Yenileme Hızı": "_t_hz",
    "Çözünürlük Standartı": "_t_disp",
    # the same targets under their silver names
    "ram_gb": "_t_ram",
    "ssd_gb": "_t_ssd",
    "refresh_rate_hz": "_t_hz",
    "display_standard": "_t_disp",
}


def fill_specs_from_title(df: DataFrame, title: str = "Başlık") -> DataFrame:
    """T17 x4: RAM, SSD, refresh rate and display standard filled from the title.

    Extractions are intermediate columns in their own projections, so the SSD
    value is computed once and reused by the RAM rule (which must not pick the
    SSD size), and each generated stage stays small.
    """
    if title not in df.columns:
        return df
    t = F.col(title)
    df = df.select("*", extract_ssd(t).alias("_t_ssd"), extract_refresh_rate(t).alias("_t_hz"),
                   extract_display_standard(t).alias("_t_disp"))
    df = df.select("*", extract_ram(t, ssd=F.col("_t_ssd")).alias("_t_ram"))
    filled = [
        F.coalesce(F.col(c), F.col(_FILL_TARGETS[c]).cast("string")).alias(c) if c in _FILL_TARGETS else F.col(c)
        for c in df.columns if not c.startswith("_t_")
    ]
    return df.select(*filled)


# Cleaned before the deduplication shuffle: its keys and the filter inputs.
_PRE_SHUFFLE = ["Başlık", "Fiyat (TRY)", "Marka"]
SILVER_KEYS = ["title", "price_try"]


def silver(merged: DataFrame) -> DataFrame:
    """Clean -> title fills -> English names -> Apple filter -> keep-last -> parse -> price present.

    Results equal the original order.  Physically, only the deduplication keys
    (title, price text) and the filter inputs are cleaned before the single
    shuffle; cleaning of the other columns, the title fills and the parsers are
    row-local, so they run after keep-last on the surviving rows only.  Rows
    whose price does not parse are dropped before the shuffle: all members of a
    (title, price text) group share the text, so groups drop whole.
    """
    keyed = silver_keyed(merged)
    # 6. keep the last copy per (title, price text); second source wins
    return silver_parsed(keep_last(keyed, SILVER_KEYS, [c for c in ORDER_COLS if c in keyed.columns]))


def silver_keyed(merged: DataFrame) -> DataFrame:
    """C2 up to the keep-last step: cleaned keys, Apple filter, rows with a price."""
    stypes = dict(merged.dtypes)
    pre = [c for c in _PRE_SHUFFLE if c in merged.columns]
    # 1a. clean the keys and filter inputs
    df = merged.select(*[clean_text(F.col(c)).alias(c) if c in pre and stypes[c] == "string" else F.col(c)
                         for c in merged.columns])
    df = rename(df, LABEL_TO_EN)
    # 4. drop Apple / MacBook
    df = exclude_brand(df)
    # 5/7. price must parse (checked before the shuffle, see above)
    price_type = dict(df.dtypes).get("price_try", "string")
    return df.withColumn("_price", parse_price(F.col("price_try"), price_type)).where(F.col("_price").isNotNull())


def silver_parsed(df: DataFrame) -> DataFrame:
    """C2 from the keep-last step on: row-local cleaning, title fills and parsers."""
    # 1b. clean every other string column
    done = {LABEL_TO_EN.get(c, c) for c in _PRE_SHUFFLE} | {"_price"}
    df = map_string_columns(df, clean_text, skip=tuple(done))
    # 2. fill four attributes from the cleaned title where they are NULL
    df = fill_specs_from_title(df.withColumnsRenamed({"title": "Başlık"}), title="Başlık")
    df = df.withColumnsRenamed({"Başlık": "title"})
    # 7. parse / standardise fields
    df = df.withColumn("price_try", F.col("_price")).drop("_price")
    parsers = _parsers(dict(df.dtypes))
    return df.select(*[parsers[c](F.col(c)).alias(c) if c in parsers else F.col(c) for c in df.columns])


def group_rare_columns(df: DataFrame, thresholds: dict[str, int], label: str = RARE_LABEL) -> DataFrame:
    """A4 for several columns with one counting pass.

    Each threshold is applied to counts of the input ``df`` (columns are
    independent), identical to grouping the columns one after the other.
    """
    cols = [c for c in thresholds if c in df.columns]
    if not cols:
        return df
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in cols)
    counts = (df.selectExpr(f"stack({len(cols)}, {pairs}) AS (_col, _value)")
              .where(F.col("_value").isNotNull())
              .groupBy("_col", "_value").agg(F.count(F.lit(1)).alias("_n")))
    limit = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(thresholds[c]))])
    # Derived and small: AQE broadcasts it from the measured size (see operators.joins).
    rare = counts.where(F.col("_n") < limit[F.col("_col")]).select("_col", "_value")
    out = df
    for c in cols:
        r = rare.where(F.col("_col") == c).select(F.col("_value").alias(f"_rare_{c}"))
        out = out.join(r, F.col(c).cast("string") == F.col(f"_rare_{c}"), "left")
    return out.select(*[
        F.when(F.col(f"_rare_{c}").isNotNull(), F.lit(label)).otherwise(F.col(c)).alias(c) if c in cols else F.col(c)
        for c in df.columns
    ])


def gold(silver_df: DataFrame) -> DataFrame:
    """PPI -> rare brand (<5) -> rare OS (<5) -> drop rows without PPI or price."""
    df = silver_df.withColumn("ppi", ppi(F.col("resolution"), F.col("screen_size_inch")))
    df = group_rare_columns(df, {"brand": RARE_THRESHOLD_GOLD, "operating_system": RARE_THRESHOLD_GOLD})
    return df.dropna(subset=["ppi", "price_try"])


def finalize(df: DataFrame, stamp: bool = True) -> DataFrame:
    """S9 preparation: processing stamp, declared column order, internal columns dropped."""
    df = df.drop(*[c for c in INTERNAL_COLS if c in df.columns])
    if stamp:
        df = df.withColumn("processed_at", F.current_timestamp())
    return canonical_order(df, FINAL_COLUMN_ORDER, after={"ppi": "screen_size_inch"})


def silver_from_bronze(hb: DataFrame, ty: DataFrame, snapshot: bool = True) -> DataFrame:
    """S1 + C1 + C2 as one lazy plan (latest day per source when ``snapshot``)."""
    if snapshot and "created_at" in hb.columns and "created_at" in ty.columns:
        hb, ty = latest_snapshot(hb), latest_snapshot(ty)
    return silver(merge_sources(hb, ty))


def run(spark: SparkSession, hb: DataFrame, ty: DataFrame, silver_path: str, gold_path: str,
        fmt: str = "parquet") -> tuple[DataFrame, DataFrame]:
    """Snapshot -> merge -> silver (written) -> gold (from the written silver, written).

    Writing silver cuts the lineage: gold reads the materialised table, so the
    silver plan never runs twice and a lost executor only recomputes gold.
    """
    from vitrine.sources.sinks import replace_table

    if "created_at" in hb.columns:
        hb, ty = latest_snapshot(hb), latest_snapshot(ty)
    warn_if_empty(hb, ty, label="bronze")
    s = finalize(silver(merge_sources(hb, ty)))
    replace_table(s, silver_path, fmt)
    silver_df = spark.read.format(fmt).options(**_read_opts(fmt)).load(silver_path) if fmt != "parquet" else spark.read.parquet(silver_path)
    if fmt == "csv":
        silver_df = _retype_silver(silver_df)
    g = finalize(gold(silver_df.drop("processed_at")))
    replace_table(g, gold_path, fmt)
    return silver_df, (spark.read.parquet(gold_path) if fmt == "parquet" else spark.read.options(**_read_opts(fmt)).format(fmt).load(gold_path))


def run_catalog(spark: SparkSession, hb: DataFrame, ty: DataFrame, silver_name: tuple[str, str] = ("transform", "laptops"),
                gold_name: tuple[str, str] = ("features", "laptops_final")) -> DataFrame:
    """C4 with catalog layers (S9, S10): silver and gold replaced as tables of their namespaces; returns the gold table."""
    from vitrine.sources.sinks import replace_catalog_table

    if "created_at" in hb.columns:
        hb, ty = latest_snapshot(hb), latest_snapshot(ty)
    warn_if_empty(hb, ty, label="bronze")
    replace_catalog_table(spark, finalize(silver(merge_sources(hb, ty))), *silver_name)
    replace_catalog_table(spark, finalize(gold(spark.table(".".join(silver_name)).drop("processed_at"))), *gold_name)
    return spark.table(".".join(gold_name))


def _read_opts(fmt: str) -> dict:
    return {"header": "true", "escape": '"', "multiLine": "true"} if fmt == "csv" else {}


def _retype_silver(df: DataFrame) -> DataFrame:
    doubles = ["price_try", *NUMERIC_BOUNDS.keys(), "gpu_vram_gb", "ppi"]
    return df.select(*[F.col(c).cast("double").alias(c) if c in doubles else F.col(c) for c in df.columns])
