"""Streaming and written-layer queries (R1, S6, S9, C4), compared with the batch oracles."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from vitrine.plans import oracle as O
from vitrine.plans.catalog import register, round_doubles


@register("incremental_ingest", "R1 S6 C1 C2", sql=(
    "WITH " + O.silver_ctes(snapshot=False) + " SELECT " + O.select_rounded(O.SILVER_COLS, O.SILVER_DOUBLES) + " FROM silver"))
def q_incremental(spark, sf_dir):
    """Land all days of the listing bronze as many files, the newest day first; the stream is started anew for the older days."""
    from vitrine.plans.queries_listing import bronze
    from vitrine.streaming.ingest import incremental_silver, land_bronze, read_silver, scratch_root

    root = scratch_root(spark, "incremental")
    sites = dict(zip(("hb", "ty"), bronze(spark, sf_dir)))
    newest = {site: rows.agg(F.to_date(F.max("created_at"))).scalar() for site, rows in sites.items()}
    silver_path, schemas = os.path.join(root, "silver"), {}
    for is_newest in (True, False):
        for site, rows in sites.items():
            day = F.to_date("created_at") == newest[site]
            land_bronze(rows.where(day if is_newest else ~day).repartition(12), os.path.join(root, f"bronze_{site}"))
            schemas.setdefault(site, spark.read.parquet(os.path.join(root, f"bronze_{site}")).schema)
        incremental_silver(spark, os.path.join(root, "bronze_hb"), os.path.join(root, "bronze_ty"), silver_path,
                           os.path.join(root, "_checkpoint"), schemas["hb"], schemas["ty"], max_files=8, compact_every=2)
    return round_doubles(read_silver(spark, silver_path).select(*O.SILVER_COLS))


@register("etl_run_tables", "C4 S9 S2", sql=(
    "WITH " + O.gold_ctes() + " SELECT " + O.select_rounded(O.SILVER_COLS + ["ppi"], O.SILVER_DOUBLES + ["ppi"]) + " FROM gold"))
def q_etl_run(spark, sf_dir):
    """C4: snapshot -> merge -> silver (written) -> gold (read back from silver, written)."""
    from vitrine.plans import etl
    from vitrine.plans.queries_listing import bronze
    from vitrine.streaming.ingest import scratch_root

    root = scratch_root(spark, "etl")
    hb, ty = bronze(spark, sf_dir)
    _, gold = etl.run(spark, hb, ty, os.path.join(root, "silver"), os.path.join(root, "gold"))
    return round_doubles(gold.select(*O.SILVER_COLS, "ppi"))


@register("etl_run_catalog", "C4 S9 S10", sql=(
    "WITH " + O.gold_ctes() + " SELECT " + O.select_rounded(O.SILVER_COLS + ["ppi"], O.SILVER_DOUBLES + ["ppi"]) + " FROM gold"))
def q_etl_catalog(spark, sf_dir):
    """C4 into catalog tables that are replaced whole; run on an older half of the listings first, then on all."""
    from vitrine.plans import etl
    from vitrine.plans.queries_listing import bronze

    hb, ty = bronze(spark, sf_dir)
    etl.run_catalog(spark, hb.where("_seq % 2 = 0"), ty.where("_seq % 2 = 0"))
    return round_doubles(etl.run_catalog(spark, hb, ty).select(*O.SILVER_COLS, "ppi"))


@register("etl_run_csv", "C5 S5 S8 S11", sql=(
    "WITH " + O.gold_ctes() + " SELECT " + O.select_rounded(O.SILVER_COLS + ["ppi"], O.SILVER_DOUBLES + ["ppi"]) + " FROM gold"))
def q_etl_csv(spark, sf_dir):
    """The latest snapshot as one CSV folder per site, read back as text, silver and gold as CSV."""
    from vitrine.plans import etl
    from vitrine.plans.queries_listing import bronze
    from vitrine.sources.sinks import write_csv
    from vitrine.sources.tables import latest_snapshot, read_bronze_csv
    from vitrine.streaming.ingest import scratch_root

    root = scratch_root(spark, "etl-csv")
    hb, ty = (read_bronze_csv(spark, write_csv(latest_snapshot(rows).drop("created_at"), root, site, "raw"))
              for site, rows in zip(("hb", "ty"), bronze(spark, sf_dir)))
    _, gold = etl.run(spark, hb, ty, os.path.join(root, "silver"), os.path.join(root, "gold"), fmt="csv")
    doubles = O.SILVER_DOUBLES + ["ppi"]
    return round_doubles(gold.select(*[F.col(c).cast("double").alias(c) if c in doubles else c for c in [*O.SILVER_COLS, "ppi"]]))
