"""The prediction log: repeated batches leave one copy, later requests go on, history is bounded."""

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from vitrine.ml.score import validate_requests
from vitrine.streaming import scoring


def requests(spark, first, n):
    fields = validate_requests(spark.createDataFrame([], "request_id long, ram_gb int, ssd_gb int, screen_size_inch double, resolution string, brand string, "
                               "platform string, panel_type string, operating_system string, cpu_family string, ram_type string, gpu_model string, "
                               "cpu_generation int, gpu_vram_gb int, refresh_rate_hz int, cpu_max_ghz double")).columns[3:]
    known = {"ram_gb": F.when(F.col("id") % 10 != 9, F.lit(16)), "ssd_gb": F.lit(512), "screen_size_inch": F.lit(15.6), "resolution": F.lit("1920x1080")}
    return spark.range(first, first + n).select(F.col("id").alias("request_id"), (F.col("id") % 3).alias("session"), (F.col("id") * 7 % 1000).alias("asked_at"),
                                                *[known.get(c, F.lit(None).cast("string")).alias(c) for c in fields])


def test_log(spark, tmp_path):
    model = PipelineModel([SQLTransformer(statement="SELECT *, ppi * 100 AS pred FROM __THIS__")])
    path, log, mark = (str(tmp_path / x) for x in ("requests", "log", "checkpoint"))
    first = requests(spark, 0, 300)
    first.write.parquet(path)
    scoring.score_stream(spark, path, first.schema, model, "m (v1)", log, mark, max_files=2)
    assert spark.read.parquet(log).count() == 270  # a tenth has no RAM
    scoring.log_batch(spark.read.schema(first.schema).parquet(path).where("request_id < 50"), 0, model, "m (v1)", log)
    scoring.log_batch(spark.read.schema(first.schema).parquet(path).where("request_id < 50"), 0, model, "m (v1)", log)
    again = spark.read.parquet(log)
    assert again.where("batch_id = 0").count() == 45 == again.where("batch_id = 0").select("request_id").distinct().count()
    requests(spark, 300, 100).write.mode("append").parquet(path)
    before = again.where("batch_id != 0").count()
    scoring.score_stream(spark, path, first.schema, model, "m (v2)", log, mark)
    rows = spark.read.parquet(log)
    assert rows.where("model_info = 'm (v2)'").count() == 90 and rows.count() == before + 45 + 90
    newest = scoring.history(spark, log, 20).collect()
    assert len(newest) == 60
    for s in range(3):
        want = [r.request_id for r in rows.where(F.col("session") == s).orderBy(F.desc("asked_at"), F.desc("request_id")).limit(20).collect()]
        assert sorted(want) == sorted(r.request_id for r in newest if r.session == s)
