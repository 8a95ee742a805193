"""Request validation and batch scoring."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.constants import (
    OPTIONAL_REQUEST_DOUBLES, OPTIONAL_REQUEST_INTS, OPTIONAL_REQUEST_STRINGS, REQUIRED_REQUEST_FIELDS,
)
from vitrine.functions.geometry import ppi_for_request
from vitrine.functions.text import blank_to_null, try_cast

REQUIRED_INTS = ["ram_gb", "ssd_gb"]


def _text(c: str) -> F.Column:
    """the field as text, blank counts as missing."""
    return blank_to_null(F.col(c).cast("string"))


def _number(c: str) -> F.Column:
    """The field as a finite number, or NULL."""
    v = try_cast(_text(c), "double")
    return F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v)


def validate_requests(req: DataFrame, id_col: str = "request_id") -> DataFrame:
    """F8: required fields present, numeric fields numbers, integer fields integral; ``reasons`` lists every failure.

    Fields may be typed or text.  Output: id, is_valid, reasons ('' when valid) and the typed request fields.
    """
    ints = REQUIRED_INTS + OPTIONAL_REQUEST_INTS
    doubles = ["screen_size_inch", *OPTIONAL_REQUEST_DOUBLES]
    checks = [F.when(_text(c).isNull(), F.lit(f"{c} missing")) for c in REQUIRED_REQUEST_FIELDS]
    checks += [F.when(_text(c).isNotNull() & _number(c).isNull(), F.lit(f"{c} not a number")) for c in ints + doubles]
    checks += [F.when(_number(c) != F.floor(_number(c)), F.lit(f"{c} not int")) for c in ints]
    reasons = F.concat_ws(",", *checks)
    typed = [try_cast(_number(c), "int").alias(c) for c in ints] + [_number(c).alias(c) for c in doubles]
    typed += [_text(c).alias(c) for c in ["resolution", *OPTIONAL_REQUEST_STRINGS]]
    return req.select(id_col, (reasons == "").alias("is_valid"), reasons.alias("reasons"), *typed)


def score_requests(valid: DataFrame, champion: PipelineModel, model_info: str, id_col: str = "request_id") -> DataFrame:
    """PPI from the request, price of the stored champion, 2 dp, currency, label."""
    scored = champion.transform(valid.withColumn("ppi", ppi_for_request("resolution", "screen_size_inch")))
    return scored.select(id_col, F.round("pred", 2).alias("predicted_price_try"), F.lit("TRY").alias("currency"),
                         F.lit(model_info).alias("model_info"))


def newest_n(df: DataFrame, key: str, order: list[str], n: int = 50) -> DataFrame:
    """The n newest rows per key (e.g. a session's prediction history)."""
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def price_label(c) -> F.Column:
    """Thousands-separated, 2 dp display of a price."""
    return F.format_number(c, 2)
