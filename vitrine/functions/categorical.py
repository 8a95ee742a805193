"""Categorical standardisers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.constants import BRAND_MAP, INTEGRATED_GPU_KEYWORDS, PANEL_TYPES
from vitrine.functions.text import clean_text, col_


def _null_s() -> Column:
    return F.lit(None).cast("string")


def _clean(c: Column | str, cleaned: bool) -> Column:
    return col_(c) if cleaned else clean_text(c)


def _any_contains(s: Column, words) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | s.contains(w)
    return out


def parse_brand(c: Column | str, cleaned: bool = False) -> Column:
    """Cleaned brand, rewritten by the fixed map when it matches exactly."""
    s = _clean(c, cleaned)
    mapping = F.create_map(*[F.lit(x) for kv in BRAND_MAP.items() for x in kv])
    return F.coalesce(F.try_element_at(mapping, s), s)


def parse_os(c: Column | str, cleaned: bool = False) -> Column:
    """Operating system family, rules tested in order."""
    s = _clean(c, cleaned)
    return (
        F.when(s.isNull(), _null_s())
        .when(s.contains("freedos") | s.contains("yok"), "freedos")
        .when(s.contains("mac"), "macos")
        .when(s.contains("android"), "linux")
        .when(s.contains("ubuntu") | s.contains("linux"), "linux")
        .when(s.contains("windows") & s.contains("pro"), "windows pro")
        .when(s.contains("windows"), "windows home")
        .otherwise("unknown")
    )


def parse_gpu_type(c: Column | str, cleaned: bool = False) -> Column:
    """Integrated / dedicated_high_end / dedicated / unknown."""
    s = _clean(c, cleaned)
    return (
        F.when(s.isNull(), _null_s())
        .when(_any_contains(s, INTEGRATED_GPU_KEYWORDS), "integrated")
        .when(s.contains("yüksek seviye"), "dedicated_high_end")
        .when(s.contains("harici"), "dedicated")
        .otherwise("unknown")
    )


def parse_panel_type(c: Column | str, cleaned: bool = False) -> Column:
    """First panel type contained in the value, else NULL."""
    s = _clean(c, cleaned)
    out = _null_s()
    for p in reversed(PANEL_TYPES):
        out = F.when(s.contains(p), F.lit(p)).otherwise(out)
    return out


def parse_resolution(c: Column | str, cleaned: bool = False) -> Column:
    """First ``W x H`` (3-5 digits each) -> 'WxH'."""
    s = F.replace(F.replace(_clean(c, cleaned), F.lit("×"), F.lit("x")), F.lit("X"), F.lit("x"))
    pat = r"(\d{3,5})\s*x\s*(\d{3,5})"
    w = F.regexp_extract(s, pat, 1)
    h = F.regexp_extract(s, pat, 2)
    return F.when(w != "", F.concat(w, F.lit("x"), h)).otherwise(_null_s())


def parse_cpu_family(c: Column | str, cleaned: bool = False) -> Column:
    """CPU family from ordered rules."""
    s = _clean(c, cleaned)
    ryzen = F.regexp_extract(s, r"ryzen\s*(3|5|7|9)", 1)
    ultra = F.regexp_extract(s, r"ultra\s*(5|7|9)", 1)
    core_i = F.regexp_extract(s, r"i\s*([3579])", 1)
    return (
        F.when(s.isNull(), _null_s())
        .when(_any_contains(s, ["apple", " m1", " m2", " m3"]), "apple silicon")
        .when(s.contains("celeron"), "intel celeron")
        .when(s.contains("ryzen"), F.when(ryzen != "", F.concat(F.lit("amd ryzen "), ryzen)).otherwise("amd ryzen"))
        .when(
            s.contains("core"),
            F.when(
                s.contains("ultra"),
                F.when(ultra != "", F.concat(F.lit("intel core ultra "), ultra)).otherwise("intel core ultra"),
            )
            .when(core_i != "", F.concat(F.lit("intel core i"), core_i))
            .otherwise("intel core"),
        )
        .otherwise("other")
    )
