"""DuckDB SQL for the correctness oracle.

Each helper renders one standardiser as a DuckDB expression over a SQL
operand, written from the documented semantics (not generated from the Spark
expressions).  Inputs named ``x`` are already cleaned text unless said
otherwise.  DuckDB differences handled here: RE2 has no look-behind, so
``(?<!\\d)`` becomes a consumed ``(?:^|[^0-9])``; ``regexp_replace`` needs the
``'g'`` flag; lambdas use ``lambda v: ...``.
"""

from __future__ import annotations

from vitrine.constants import (
    ALLOWED_SSD_GB, BRAND_MAP, DISPLAY_PRIORITIES, INTEGRATED_GPU_KEYWORDS, LABEL_TO_EN, NUMERIC_BOUNDS,
    PANEL_TYPES, RESOLUTION_NAMES, SHARED_VRAM_KEYWORDS, STOP_TOKENS, TY_FIELDS,
)
from vitrine.sources.listing_view import bronze_sql


def q(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def r4(x: str) -> str:
    return f"round({x}, 4)"


def clean(x: str) -> str:
    s = f"trim(regexp_replace(lower({x}), '\\s+', ' ', 'g'))"
    toks = ", ".join(q(t) for t in STOP_TOKENS)
    return f"CASE WHEN {s} IN ({toks}) THEN NULL ELSE {s} END"


def number(x: str, lo: float, hi: float) -> str:
    v = f"TRY_CAST(NULLIF(regexp_extract(replace({x}, ',', '.'), '(\\d+(\\.\\d+)?)', 1), '') AS DOUBLE)"
    return f"CASE WHEN {v} BETWEEN {lo} AND {hi} THEN {v} END"


def vram(x: str) -> str:
    kws = " OR ".join(f"contains({x}, {q(k)})" for k in SHARED_VRAM_KEYWORDS)
    return f"CASE WHEN {x} IS NULL THEN NULL WHEN {kws} THEN 0.0 ELSE {number(x, 0, 32)} END"


_FLOAT_RE = r"^[+-]?(\d(_?\d)*(\.(\d(_?\d)*)?)?|\.\d(_?\d)*)([eE][+-]?\d(_?\d)*)?$"


def price(x: str) -> str:
    """Price text (raw or cleaned) -> double in 1000..1e6."""
    s = f"trim(replace(replace(lower({x}), 'tl', ''), '₺', ''))"
    norm = (f"CASE WHEN contains({s}, '.') AND contains({s}, ',') THEN replace(replace({s}, '.', ''), ',', '.') "
            f"WHEN contains({s}, '.') AND length(regexp_extract({s}, '[^.]*$')) = 3 THEN replace({s}, '.', '') "
            f"ELSE replace({s}, ',', '.') END")
    v = f"CASE WHEN regexp_matches({norm}, '{_FLOAT_RE}') THEN TRY_CAST(replace({norm}, '_', '') AS DOUBLE) END"
    return f"CASE WHEN {v} BETWEEN 1000 AND 1000000 THEN {v} END"


def brand(x: str) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in BRAND_MAP.items())
    return f"CASE {x} {whens} ELSE {x} END"


def os_family(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL THEN NULL "
            f"WHEN contains({x}, 'freedos') OR contains({x}, 'yok') THEN 'freedos' "
            f"WHEN contains({x}, 'mac') THEN 'macos' "
            f"WHEN contains({x}, 'android') THEN 'linux' "
            f"WHEN contains({x}, 'ubuntu') OR contains({x}, 'linux') THEN 'linux' "
            f"WHEN contains({x}, 'windows') THEN CASE WHEN contains({x}, 'pro') THEN 'windows pro' ELSE 'windows home' END "
            f"ELSE 'unknown' END")


def gpu_type(x: str) -> str:
    integ = " OR ".join(f"contains({x}, {q(k)})" for k in INTEGRATED_GPU_KEYWORDS)
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN {integ} THEN 'integrated' "
            f"WHEN contains({x}, 'yüksek seviye') THEN 'dedicated_high_end' "
            f"WHEN contains({x}, 'harici') THEN 'dedicated' ELSE 'unknown' END")


def panel(x: str) -> str:
    whens = " ".join(f"WHEN contains({x}, {q(p)}) THEN {q(p)}" for p in PANEL_TYPES)
    return f"CASE {whens} ELSE NULL END"


def resolution(x: str) -> str:
    s = f"replace(replace({x}, '×', 'x'), 'X', 'x')"
    w = f"regexp_extract({s}, '(\\d{{3,5}})\\s*x\\s*(\\d{{3,5}})', 1)"
    h = f"regexp_extract({s}, '(\\d{{3,5}})\\s*x\\s*(\\d{{3,5}})', 2)"
    return f"CASE WHEN {w} <> '' THEN {w} || 'x' || {h} END"


def cpu_family(x: str) -> str:
    ry = f"regexp_extract({x}, 'ryzen\\s*(3|5|7|9)', 1)"
    ul = f"regexp_extract({x}, 'ultra\\s*(5|7|9)', 1)"
    ci = f"regexp_extract({x}, 'i\\s*([3579])', 1)"
    return (f"CASE WHEN {x} IS NULL THEN NULL "
            f"WHEN contains({x}, 'apple') OR contains({x}, ' m1') OR contains({x}, ' m2') OR contains({x}, ' m3') THEN 'apple silicon' "
            f"WHEN contains({x}, 'celeron') THEN 'intel celeron' "
            f"WHEN contains({x}, 'ryzen') THEN CASE WHEN {ry} <> '' THEN 'amd ryzen ' || {ry} ELSE 'amd ryzen' END "
            f"WHEN contains({x}, 'core') THEN CASE "
            f"  WHEN contains({x}, 'ultra') THEN CASE WHEN {ul} <> '' THEN 'intel core ultra ' || {ul} ELSE 'intel core ultra' END "
            f"  WHEN {ci} <> '' THEN 'intel core i' || {ci} ELSE 'intel core' END "
            f"ELSE 'other' END")


def soft(x: str) -> str:
    s = f"replace(regexp_replace(lower({x}), '[-_/|]+', ' ', 'g'), ',', '.')"
    return f"trim(regexp_replace({s}, '\\s+', ' ', 'g'))"


_TAIL = "\\s*(?:nvme\\s*)?(?:m\\.?2\\s*)?(?:ssd|gbssd)\\b"


def title_ssd(t: str) -> str:
    s = soft(t)
    tb = (f"list_transform(regexp_extract_all({s}, '(?:^|[^0-9])(\\d+(?:\\.\\d+)?)\\s*tb{_TAIL}', 1), "
          f"lambda v: round_even(CAST(v AS DOUBLE) * 1024, 0))")
    gb = f"list_transform(regexp_extract_all({s}, '(?:^|[^0-9])(\\d{{1,4}})\\s*gb{_TAIL}', 1), lambda v: CAST(v AS DOUBLE))"
    m = f"list_max(list_concat({tb}, {gb}))"
    allowed = ", ".join(f"{v}.0" for v in ALLOWED_SSD_GB)
    return f"CASE WHEN {m} IN ({allowed}) THEN CAST({m} AS INTEGER) END"


def title_ram(t: str, ssd: str) -> str:
    """``ssd`` is a column holding title_ssd(t) (lambdas may read outer columns)."""
    low = f"lower(trim({t}))"
    p = f"strpos({low}, 'ssd')"
    scope = f"CASE WHEN {p} = 0 THEN {low} ELSE substr({low}, 1, greatest({p} - 2, 0)) END"
    vals = f"list_transform(regexp_extract_all({scope}, '(\\d{{1,4}})\\s*gb', 1), lambda v: CAST(v AS INTEGER))"
    ok = f"list_filter({vals}, lambda v: v > 0 AND v <= 128 AND ({ssd} IS NULL OR v <> {ssd}))"
    return f"CAST(({ok})[1] AS DOUBLE)"


def title_hz(t: str) -> str:
    vals = f"list_transform(regexp_extract_all(lower({t}), '(\\d{{1,3}})\\s*hz', 1), lambda v: CAST(v AS INTEGER))"
    return f"CAST(list_max(list_filter({vals}, lambda v: v BETWEEN 30 AND 360)) AS DOUBLE)"


def title_display(t: str) -> str:
    low = f"lower({t})"
    pat = "(\\d{3,4})\\s*[x×X]\\s*(\\d{3,4})"
    w = f"TRY_CAST(NULLIF(regexp_extract({t}, '{pat}', 1), '') AS INTEGER)"
    h = f"TRY_CAST(NULLIF(regexp_extract({t}, '{pat}', 2), '') AS INTEGER)"
    sizes = " ".join(f"WHEN {w} = {rw} AND {h} = {rh} THEN {q(n)}" for (rw, rh), n in RESOLUTION_NAMES.items())
    feats = " ".join(f"WHEN contains({low}, {q(f.lower())}) THEN {q(f)}" for f in DISPLAY_PRIORITIES)
    return f"CASE WHEN contains({low}, 'retina') THEN 'Retina' {feats} {sizes} ELSE NULL END"


def ppi(res: str, inch: str) -> str:
    parts = f"string_split(lower({res}), 'x')"
    w = f"TRY_CAST(trim({parts}[1]) AS DOUBLE)"
    h = f"TRY_CAST(trim({parts}[2]) AS DOUBLE)"
    return (f"CASE WHEN len({parts}) = 2 AND {inch} <> 0 AND isfinite(sqrt({w}*{w} + {h}*{h}) / {inch}) "
            f"THEN sqrt({w}*{w} + {h}*{h}) / {inch} END")


# ------------------------------------------------------------------ bronze

EN = {lbl: LABEL_TO_EN[lbl] for lbl in LABEL_TO_EN}
BRONZE_STRING_COLS = [LABEL_TO_EN[lbl] for lbl in TY_FIELDS] + ["scraped_at", "price_try", "url"]


def merged_cte() -> str:
    """C1 in SQL: TY rows then HB rows, English names, platform tag, source rank."""
    return (f"ty AS ({bronze_sql('ty')}), hb AS ({bronze_sql('hb')}), "
            f"merged AS (SELECT *, 'trendyol' AS platform, 0 AS _src_rank FROM ty "
            f"UNION ALL SELECT *, 'hepsiburada' AS platform, 1 AS _src_rank FROM hb)")


def cleaned_cte(src: str = "merged", name: str = "cleaned") -> str:
    cols = ", ".join(f"{clean(c)} AS {c}" for c in BRONZE_STRING_COLS + ["platform"])
    return f"{name} AS (SELECT {cols}, created_at, _seq, _src_rank FROM {src})"


def latest_cte(src: str, name: str) -> str:
    return (f"{name} AS (SELECT * FROM {src} WHERE CAST(created_at AS DATE) = "
            f"(SELECT max(CAST(created_at AS DATE)) FROM {src}))")


SILVER_DOUBLES = ["price_try", *NUMERIC_BOUNDS.keys(), "gpu_vram_gb"]
SILVER_COLS = [
    "title", "brand", "price_try", "intended_use", "color", "weight", "operating_system", "cpu_family", "cpu_model",
    "cpu_generation", "cpu_cores", "cpu_max_ghz", "ram_gb", "ram_type", "ssd_gb", "hdd_gb", "gpu_model", "gpu_type",
    "gpu_vram_gb", "gpu_vram_type", "screen_size_inch", "resolution", "display_standard", "refresh_rate_hz",
    "panel_type", "platform", "url", "scraped_at",
]


def silver_ctes(snapshot: bool = True) -> str:
    """WITH-list ending in ``silver`` (English names, parsed), per the C2 order."""
    ty_src, hb_src = "ty", "hb"
    parts = [f"ty AS ({bronze_sql('ty')})", f"hb AS ({bronze_sql('hb')})"]
    if snapshot:
        parts += [latest_cte("ty", "ty_l"), latest_cte("hb", "hb_l")]
        ty_src, hb_src = "ty_l", "hb_l"
    parts.append(f"merged AS (SELECT *, 'trendyol' AS platform, 0 AS _src_rank FROM {ty_src} "
                 f"UNION ALL SELECT *, 'hepsiburada' AS platform, 1 AS _src_rank FROM {hb_src})")
    parts.append(cleaned_cte())
    fill_cols = []
    for c in BRONZE_STRING_COLS + ["platform"]:
        if c == "ram_gb":
            fill_cols.append(f"coalesce(ram_gb, CAST(t_ram AS VARCHAR)) AS ram_gb")
        elif c == "ssd_gb":
            fill_cols.append(f"coalesce(ssd_gb, CAST(t_ssd AS VARCHAR)) AS ssd_gb")
        elif c == "refresh_rate_hz":
            fill_cols.append(f"coalesce(refresh_rate_hz, CAST(t_hz AS VARCHAR)) AS refresh_rate_hz")
        elif c == "display_standard":
            fill_cols.append(f"coalesce(display_standard, t_disp) AS display_standard")
        else:
            fill_cols.append(c)
    parts.append(f"ext1 AS (SELECT *, {title_ssd('title')} AS t_ssd, {title_hz('title')} AS t_hz, "
                 f"{title_display('title')} AS t_disp FROM cleaned)")
    parts.append(f"ext2 AS (SELECT *, {title_ram('title', 't_ssd')} AS t_ram FROM ext1)")
    parts.append(f"filled AS (SELECT {', '.join(fill_cols)}, created_at, _seq, _src_rank FROM ext2)")
    parts.append("kept AS (SELECT * FROM filled WHERE NOT (coalesce(contains(lower(brand), 'apple'), false) "
                 "OR coalesce(contains(lower(title), 'macbook'), false)))")
    parts.append("dedup AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY title, price_try "
                 "ORDER BY _src_rank DESC, _seq DESC) AS _rn FROM kept) WHERE _rn = 1)")
    parsed = []
    for c in BRONZE_STRING_COLS + ["platform"]:
        if c == "price_try":
            parsed.append(f"{price(c)} AS price_try")
        elif c in NUMERIC_BOUNDS:
            lo, hi = NUMERIC_BOUNDS[c]
            parsed.append(f"{number(clean(c), lo, hi)} AS {c}")
        elif c == "gpu_vram_gb":
            parsed.append(f"{vram(clean(c))} AS gpu_vram_gb")
        elif c == "brand":
            parsed.append(f"{brand(c)} AS brand")
        elif c == "operating_system":
            parsed.append(f"{os_family(c)} AS operating_system")
        elif c == "cpu_family":
            parsed.append(f"{cpu_family(c)} AS cpu_family")
        elif c == "gpu_type":
            parsed.append(f"{gpu_type(c)} AS gpu_type")
        elif c == "resolution":
            parsed.append(f"{resolution(c)} AS resolution")
        elif c == "panel_type":
            parsed.append(f"{panel(c)} AS panel_type")
        else:
            parsed.append(c)
    parts.append(f"silver AS (SELECT {', '.join(parsed)}, created_at, _seq, _src_rank FROM dedup "
                 f"WHERE {price('price_try')} IS NOT NULL)")
    return ", ".join(parts)


def gold_ctes(snapshot: bool = True) -> str:
    return silver_ctes(snapshot) + (
        f", withppi AS (SELECT *, {ppi('resolution', 'screen_size_inch')} AS ppi FROM silver)"
        ", bc AS (SELECT brand AS b, count(*) AS n FROM withppi WHERE brand IS NOT NULL GROUP BY brand)"
        ", oc AS (SELECT operating_system AS o, count(*) AS n FROM withppi WHERE operating_system IS NOT NULL GROUP BY operating_system)"
        ", gold AS (SELECT w.* REPLACE ("
        "CASE WHEN bc.n < 5 THEN 'Other' ELSE w.brand END AS brand, "
        "CASE WHEN oc.n < 5 THEN 'Other' ELSE w.operating_system END AS operating_system) "
        "FROM withppi w LEFT JOIN bc ON w.brand = bc.b LEFT JOIN oc ON w.operating_system = oc.o "
        "WHERE w.ppi IS NOT NULL AND w.price_try IS NOT NULL)"
    )


def select_rounded(cols: list[str], doubles: list[str]) -> str:
    return ", ".join(f"{r4(c)} AS {c}" if c in doubles else c for c in cols)
