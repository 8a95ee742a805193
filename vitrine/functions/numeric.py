"""Numeric parsers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.constants import GPU_VRAM_BOUNDS, NUMERIC_BOUNDS, PRICE_BOUNDS, SHARED_VRAM_KEYWORDS
from vitrine.functions.text import clean_text, col_, let, py_strip, try_cast


def _null_d() -> Column:
    return F.lit(None).cast("double")

# A literal Python's float() accepts (digits with single '_' separators,
# optional fraction and exponent).  Java's parser would also take '1d',
# 'NaN', 'Infinity' and reject '1_000', so the text is validated first.
_PY_FLOAT = r"^[+-]?(?:\d(?:_?\d)*(?:\.(?:\d(?:_?\d)*)?)?|\.\d(?:_?\d)*)(?:[eE][+-]?\d(?:_?\d)*)?$"


def in_range(v: Column, lo: float, hi: float) -> Column:
    """keep ``v`` when lo <= v <= hi, else NULL."""
    return let(v, lambda x: F.when(x.between(F.lit(lo), F.lit(hi)), x).otherwise(_null_d()))


def first_number(s: Column) -> Column:
    """First ``\\d+(\\.\\d+)?`` in ``s`` (comma read as dot), as double."""
    txt = F.regexp_extract(F.replace(s, F.lit(","), F.lit(".")), r"(\d+(\.\d+)?)", 1)
    return try_cast(F.nullif(txt, F.lit("")), "double")


def parse_numeric(c: Column | str, lo: float, hi: float, cleaned: bool = False) -> Column:
    """Clean, take the first number, apply the inclusive range guard.

    ``cleaned=True`` skips T1 for input that is already clean (T1 is idempotent).
    """
    s = col_(c).cast("string")
    return in_range(first_number(s if cleaned else clean_text(s)), lo, hi)


def parse_numeric_value(c: Column, dtype: str, lo: float, hi: float) -> Column:
    """T2 dispatching on the column's Spark type (numbers skip the text path)."""
    if dtype in ("double", "float", "int", "bigint", "smallint", "tinyint") or dtype.startswith("decimal"):
        return in_range(c.cast("double"), lo, hi)
    return parse_numeric(c, lo, hi)


def parse_bounded(column: str, c: Column | str | None = None) -> Column:
    """T2 with the fixed bounds of a silver column."""
    lo, hi = NUMERIC_BOUNDS[column]
    return parse_numeric(col_(c if c is not None else column), lo, hi)


def parse_gpu_vram(c: Column | str, lo: float = GPU_VRAM_BOUNDS[0], hi: float = GPU_VRAM_BOUNDS[1],
                   cleaned: bool = False) -> Column:
    """T4: shared-memory keywords -> 0.0, else T2 with bounds."""
    def body(s: Column) -> Column:
        shared = F.lit(False)
        for kw in SHARED_VRAM_KEYWORDS:
            shared = shared | s.contains(kw)
        return F.when(s.isNull(), _null_d()).when(shared, F.lit(0.0)).otherwise(parse_numeric(s, lo, hi, cleaned=True))

    return let(col_(c) if cleaned else clean_text(col_(c)), body)


def normalise_price_text(c: Column | str) -> Column:
    """T5 text step: drop 'tl' / '₺', then resolve '.' and ',' separators."""
    def body(s: Column) -> Column:
        has_dot = F.instr(s, ".") > 0
        has_comma = F.instr(s, ",") > 0
        last_group = F.substring_index(s, ".", -1)
        return (
            F.when(has_dot & has_comma, F.replace(F.replace(s, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
            .when(has_dot & (F.char_length(last_group) == 3), F.replace(s, F.lit("."), F.lit("")))
            .otherwise(F.replace(s, F.lit(","), F.lit(".")))
        )

    return let(py_strip(F.replace(F.replace(F.lower(col_(c)), F.lit("tl"), F.lit("")), F.lit("₺"), F.lit(""))), body)


def parse_price(c: Column | str, dtype: str = "string") -> Column:
    """T5: Turkish price text -> double within 1,000..1,000,000, else NULL.

    Numeric input passes through as double without the range check.
    """
    c = col_(c)
    if dtype != "string":
        return c.cast("double")
    num = let(normalise_price_text(c),
              lambda s: F.when(s.rlike(_PY_FLOAT), try_cast(F.replace(s, F.lit("_"), F.lit("")), "double")))
    return in_range(num, *PRICE_BOUNDS)


def to_number(c: Column | str) -> Column:
    """Coerce to double, NULL when not a number."""
    return try_cast(col_(c).cast("string"), "double")
