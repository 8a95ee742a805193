"""Streaming scoring (X1, X4): a stream of requests -> the champion -> an idempotent log of predictions.

Requests land as append-only parquet.  Every micro-batch is validated, scored by the stored champion and written to the
log folder of its own batch number, which replaces what an earlier try of the same batch left: a repeated batch leaves
one copy.  The newest predictions of a session come from the log by a top-n per key, whose limit is applied in every
task before the shuffle, so a session of any length sends n rows per task.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vitrine.ml.score import newest_n, score_requests, validate_requests

ID, SESSION, ASKED_AT = "request_id", "session", "asked_at"


def log_batch(requests: DataFrame, batch_id: int, champion: PipelineModel, info: str, log_path: str) -> None:
    """Score the valid requests of one batch and put them in its place in the log; invalid ones are left out (F8)."""
    keyed = requests.withColumn(ID, F.struct(ID, SESSION, ASKED_AT))
    scored = score_requests(validate_requests(keyed).where("is_valid"), champion, info)
    flat = scored.select(f"{ID}.*", *[c for c in scored.columns if c != ID])
    flat.write.mode("overwrite").parquet(f"{log_path}/batch_id={batch_id}")


def score_stream(spark: SparkSession, requests_path: str, schema: StructType, champion: PipelineModel, info: str, log_path: str,
                 checkpoint: str, max_files: int = 64) -> None:
    """Score everything that has landed and stop; going on later with the same checkpoint scores only what is new.

    A request has an id, its session, the time it was asked at (any ordered type) and the request fields.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(requests_path)
    query = (stream.writeStream.foreachBatch(lambda batch, n: log_batch(batch, n, champion, info, log_path))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def history(spark: SparkSession, log_path: str, n: int = 50) -> DataFrame:
    """The newest n predictions of every session."""
    return newest_n(spark.read.parquet(log_path).drop("batch_id"), SESSION, [ASKED_AT, ID], n)
