"""Sinks, CSV source, ETL run with written layers, registry round trip, encoders."""

import os

from pyspark.sql import functions as F

from vitrine.ml import models as M
from vitrine.ml.prepare import fit_preprocessor
from vitrine.ml.registry import Registry
from vitrine.ml.select import load_champion, register_champion
from vitrine.plans import etl
from vitrine.plans.queries_listing import bronze
from vitrine.plans.report import modelling_cleanup, profile_report
from vitrine.sources.sinks import append_with_stamp, route, write_csv
from vitrine.sources.tables import read_bronze_csv

SF = "/root/testdata/sf0.001"


def test_csv_source_keeps_doubled_quotes(spark, tmp_path):
    p = tmp_path / "ty_raw.csv"
    p.write_text('Başlık,Fiyat (TRY)\n"Lenovo 15.6"" FHD, 16GB","24.999 TL"\nplain,"1.000 TL"\n', encoding="utf-8")
    rows = read_bronze_csv(spark, str(p)).collect()
    assert rows[0]["Başlık"] == 'Lenovo 15.6" FHD, 16GB' and rows[0]["Fiyat (TRY)"] == "24.999 TL"
    assert dict(read_bronze_csv(spark, str(p)).dtypes) == {
        "Başlık": "string", "Fiyat (TRY)": "string", "_seq": "bigint"}
    assert rows[0]["_seq"] < rows[1]["_seq"]


def test_append_sink_and_route(spark, tmp_path):
    df = spark.createDataFrame([("a", "1 TL")], "Name STRING, Price STRING")
    path = str(tmp_path / "links")
    assert append_with_stamp(df, path) and append_with_stamp(df, path)
    assert not append_with_stamp(df.limit(0), path)
    back = spark.read.parquet(path)
    assert back.count() == 2 and "created_at" in back.columns and "created_date" in back.columns
    assert route("raw", "HB") == ("raw", "hb") and route("other", "TY") == ("public", "ty")
    assert os.path.isdir(write_csv(df, str(tmp_path), "HB", "raw"))


def test_etl_run_writes_layers(spark, tmp_path):
    hb, ty = bronze(spark, SF)
    silver, gold = etl.run(spark, hb, ty, str(tmp_path / "silver"), str(tmp_path / "gold"))
    assert silver.columns[:3] == ["title", "brand", "price_try"] and "processed_at" in silver.columns
    assert gold.columns.index("ppi") == gold.columns.index("screen_size_inch") + 1
    assert gold.where(F.col("ppi").isNull()).count() == 0 and gold.count() > 0
    s2, g2 = etl.run(spark, hb, ty, str(tmp_path / "s_csv"), str(tmp_path / "g_csv"), fmt="csv")
    assert g2.count() == gold.count()


def test_registry_round_trip_and_scoring(spark, tmp_path):
    df = spark.createDataFrame([(float(i), "a" if i % 2 else "b", 1000.0 + 10 * i) for i in range(40)],
                               "x DOUBLE, c STRING, price_try DOUBLE")
    pre = fit_preprocessor(df, ["c"], ["x"])
    train = M.with_log_target(pre.transform(df), "price_try")
    model = M.fit("LinearRegression", train)
    from pyspark.ml import PipelineModel

    reg, models = str(tmp_path / "registry"), str(tmp_path / "models")
    register_champion(spark, PipelineModel([*pre.stages, model]), "m", reg, models)
    register_champion(spark, PipelineModel([*pre.stages, model]), "m", reg, models)
    loaded, info = load_champion(spark, reg, "m")
    assert info == "m (v2)"
    new = spark.createDataFrame([(3.0, "zzz", 0.0)], "x DOUBLE, c STRING, price_try DOUBLE")  # unknown category
    out = loaded.transform(new).collect()[0]
    assert out["_pred_log"] is not None


def test_drop_first_encoder(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "c STRING")
    full = fit_preprocessor(df, ["c"], []).transform(df).select("features").collect()
    first = fit_preprocessor(df, ["c"], [], drop_first=True).transform(df).select("features").collect()
    assert len(full[0][0]) == 4 and len(first[0][0]) == 3   # a, b, c, missing -> drop 'a'


def test_profile_and_cleanup(spark):
    df = spark.createDataFrame([(1.0, "x", 10.0), (None, "x", 12.0), (3.0, None, None), (1.0, "x", 10.0)],
                               "a DOUBLE, b STRING, price_try DOUBLE")
    rep = profile_report(df)
    assert {"missing", "summary", "box", "corr"} <= set(rep)
    clean = modelling_cleanup(df, "price_try").orderBy("price_try").collect()
    assert [(r["a"], r["b"]) for r in clean] == [(1.0, "x"), (1.0, "x")]


def test_latest_snapshot_prunes_partitions(spark, tmp_path):
    import io, contextlib

    from vitrine.sources.tables import latest_snapshot

    df = spark.createDataFrame([("a", "2025-12-16 10:00:00"), ("b", "2025-12-17 09:00:00"), ("c", "2025-12-17 23:00:00")],
                               "k STRING, t STRING").withColumn("created_at", F.to_timestamp("t")).drop("t")
    path = str(tmp_path / "bronze")
    append_with_stamp(df, path)
    landed = spark.read.parquet(path)
    snap = latest_snapshot(landed)
    assert sorted(r["k"] for r in snap.collect()) == ["b", "c"]
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        snap.explain()
    assert "PartitionFilters: [isnotnull(created_date" in buf.getvalue()


def test_champion_is_stored_with_metrics_and_options(spark, tmp_path):
    from vitrine.plans import queries_ml as Q
    from vitrine.plans.report import benchmark_tune_register

    gold = Q._gold(spark, SF)
    reg, models = str(tmp_path / "registry"), str(tmp_path / "models")
    done = benchmark_tune_register(spark, gold, reg, models, ["url"], model_names=["Ridge", "Lasso"], trials=2)
    assert done["winner"] in ("Ridge", "Lasso") and done["trials"].count() == 2
    champion, info = load_champion(spark, reg, "listing_price")
    assert info == "listing_price (v1)"
    out = champion.transform(gold)
    assert out.where("pred IS NULL OR abs(pred - expm1(_pred_log)) > 1e-6 * abs(pred)").count() == 0
    stored = spark.read.parquet(os.path.join(models, "model_runs")).first()
    assert stored["model"] == done["winner"] and stored["test_rmse"] > 0 and stored["version"] == 1
    options = spark.read.json(os.path.join(models, "listing_price_v1_options")).first()["options"].asDict()
    assert "brand" in options and options["brand"] == sorted(options["brand"])
    # the winner without a search space registers nothing
    none = benchmark_tune_register(spark, gold, reg, models, ["url"], model_names=["LinearRegression"])
    assert none["registered"] is None and Registry(spark, reg).versions("listing_price").count() == 1


def test_metrics_match_sql_over_written_predictions(spark, tmp_path):
    import duckdb

    from vitrine.ml.evaluate import run_record
    from vitrine.plans import queries_ml as Q

    prepared, *_ = Q._prepared(spark, SF)
    for name in ("LinearRegression", "Ridge", "Lasso"):
        model = M.fit(name, prepared.where("split = 'train'"))
        path = str(tmp_path / name)
        M.predict_price(model, prepared).select("split", F.col("price_try").alias("y"), "pred").write.parquet(path)
        got = run_record(spark.read.parquet(path)).first()
        test, train = (duckdb.sql(
            f"SELECT sqrt(avg((y - pred) ** 2)), avg(abs(y - pred)), 1 - sum((y - pred) ** 2) / sum((y - m) ** 2) FROM "
            f"(SELECT *, avg(y) OVER () AS m FROM '{path}/*.parquet' WHERE split = '{s}')").fetchall()[0] for s in ("test", "train"))
        want = {"test_rmse": test[0], "test_mae": test[1], "test_r2": test[2], "train_rmse": train[0], "overfit_gap": test[0] - train[0]}
        assert all(abs(got[k] - v) <= 1e-9 * max(1.0, abs(v)) for k, v in want.items()), name
