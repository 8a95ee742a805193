"""Specification extractors over listing titles.

Each extractor is ``Column -> Column`` built from ``regexp_extract_all`` and
higher-order array functions, so the whole title is scanned JVM-side.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.constants import (
    ALLOWED_SSD_GB, DISPLAY_PRIORITIES, GB_TOKEN, HZ_TOKEN, OTHER_DIGITS, RES_PATTERN, RESOLUTION_NAMES, SSD_GB_PATTERN, SSD_TB_PATTERN,
)
from vitrine.functions.text import col_, py_strip, soft_clean, try_cast

def _title_text(c: Column | str) -> Column:
    # Extractors see str(value): a missing title reads as the text 'none'.
    # Digits of other scripts count as the ASCII ones.
    return F.translate(F.coalesce(col_(c).cast("string"), F.lit("None")), OTHER_DIGITS, "0123456789" * (len(OTHER_DIGITS) // 10))


def extract_ssd(c: Column | str) -> Column:
    """Largest SSD capacity (TB x1024, half-even) if it is an allowed size."""
    t = soft_clean(_title_text(c))
    tb = F.transform(F.regexp_extract_all(t, F.lit(SSD_TB_PATTERN), 1), lambda x: F.bround(x.try_cast("double") * 1024, 0))
    gb = F.transform(F.regexp_extract_all(t, F.lit(SSD_GB_PATTERN), 1), lambda x: x.try_cast("double"))
    best = F.array_max(F.concat(tb, gb))
    return F.when(best.isin([float(v) for v in ALLOWED_SSD_GB]), best.cast("int"))


def extract_ram(c: Column | str, ssd: Column | None = None) -> Column:
    """First GB token in (0, 128] that is not the SSD size and ends before 'ssd'.

    The positional rule "token end < index of the first 'ssd'" is the same as
    scanning only the text before that index minus one character.
    ``ssd`` may pass an already computed ``extract_ssd(c)`` column.
    """
    low = F.lower(py_strip(_title_text(c)))
    ssd_at = F.instr(low, "ssd")  # 1-based, 0 when absent
    scope = F.when(ssd_at == 0, low).otherwise(F.substring(low, F.lit(1), F.greatest(ssd_at - 2, F.lit(0))))
    ssd = extract_ssd(c) if ssd is None else ssd
    vals = F.transform(F.regexp_extract_all(scope, F.lit(GB_TOKEN), 1), lambda x: x.try_cast("int"))
    ok = F.filter(vals, lambda v: (v > 0) & (v <= 128) & (ssd.isNull() | (v != ssd)))
    return F.get(ok, 0).cast("double")


def extract_refresh_rate(c: Column | str) -> Column:
    """Largest ``N hz`` with 30 <= N <= 360."""
    vals = F.transform(F.regexp_extract_all(_title_text(c), F.lit(HZ_TOKEN), 1), lambda x: x.try_cast("int"))
    return F.array_max(F.filter(vals, lambda v: (v >= 30) & (v <= 360))).cast("double")


def extract_display_standard(c: Column | str) -> Column:
    """T16: 'Retina', else first display keyword contained, else name of the W x H size."""
    raw = _title_text(c)
    low = F.lower(raw)
    w = F.regexp_extract(raw, RES_PATTERN, 1)
    h = F.regexp_extract(raw, RES_PATTERN, 2)
    # The size lookup is numeric, like an (int, int) key.
    size_name = _by_number(try_cast(F.nullif(w, F.lit("")), "int"), try_cast(F.nullif(h, F.lit("")), "int"))
    out = size_name
    for feat in reversed(DISPLAY_PRIORITIES):
        out = F.when(low.contains(feat.lower()), F.lit(feat)).otherwise(out)
    return F.when(low.contains("retina"), F.lit("Retina")).otherwise(out)


def _by_number(wn: Column, hn: Column) -> Column:
    out = F.lit(None).cast("string")
    for (rw, rh), name in reversed(list(RESOLUTION_NAMES.items())):
        out = F.when((wn == rw) & (hn == rh), F.lit(name)).otherwise(out)
    return out


def fill_from_title(target: Column | str, title: Column | str, extractor: Callable[[Column], Column]) -> Column:
    """Keep ``target``; where it is NULL use ``extractor(title)`` (as text)."""
    return F.coalesce(col_(target), extractor(col_(title)).cast("string"))


TITLE_FILLS = [
    # (bronze label of the target, extractor)
    ("Ram (Sistem Belleği)", extract_ram),
    ("SSD Kapasitesi", extract_ssd),
    ("Ekran Yenileme Hızı", extract_refresh_rate),
    ("Çözünürlük Standartı", extract_display_standard),
]
