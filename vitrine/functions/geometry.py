"""Screen pixel density."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.functions.text import col_, try_cast


def _null_d() -> Column:
    return F.lit(None).cast("double")


def _finite(v: Column) -> Column:
    # inf / NaN never enter a double column: they become NULL.
    return F.when(F.isnan(v) | (F.abs(v) == float("inf")), _null_d()).otherwise(v)


def ppi(resolution: Column | str, inch: Column | str) -> Column:
    """sqrt(w^2 + h^2) / inch from a 'WxH' string; malformed, zero inch or inf -> NULL."""
    parts = F.split(F.lower(col_(resolution).cast("string")), "x", -1)
    ok = F.size(parts) == 2
    w = F.when(ok, try_cast(F.trim(F.get(parts, 0)), "double"))
    h = F.when(ok, try_cast(F.trim(F.get(parts, 1)), "double"))
    return _finite(F.try_divide(F.sqrt(w * w + h * h), col_(inch).cast("double")))


def ppi_from_text(text: Column | str, inch: Column | str) -> Column:
    """The tolerant variant: find 'W x H' anywhere in the text, needs inch > 0."""
    t = F.replace(F.lower(col_(text).cast("string")), F.lit("×"), F.lit("x"))
    pat = r"(\d{3,5})\s*x\s*(\d{3,5})"
    w = try_cast(F.nullif(F.regexp_extract(t, pat, 1), F.lit("")), "double")
    h = try_cast(F.nullif(F.regexp_extract(t, pat, 2), F.lit("")), "double")
    i = try_cast(col_(inch).cast("string"), "double")
    return F.when(i > 0, _finite(F.sqrt(w * w + h * h) / i))


def ppi_for_request(resolution: Column | str, inch: Column | str) -> Column:
    """Scoring form; integer 'WxH', inch defaults to 15.6 when absent."""
    parts = F.split(F.lower(col_(resolution).cast("string")), "x", -1)
    ok = F.size(parts) == 2
    # whole numbers, multiplied as doubles: five-digit sides do not overflow
    w = F.when(ok, try_cast(F.trim(F.get(parts, 0)), "int")).cast("double")
    h = F.when(ok, try_cast(F.trim(F.get(parts, 1)), "int")).cast("double")
    i = F.coalesce(col_(inch).cast("double"), F.lit(15.6))
    return _finite(F.try_divide(F.sqrt(w * w + h * h), i))
