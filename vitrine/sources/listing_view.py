"""Bronze-shaped listing tables derived from the driver's ``part`` table.

The driver ships TPC-H-like tables, not marketplace listings.  This module turns
every ``part`` row into a listing whose text fields carry the formats the
standardisers must handle (Turkish price text, '15,6 inç', '1920 x 1080',
stop tokens, title specs such as '16GB 512GB SSD 144Hz').  The work grows with
``part``: every row is used, nothing is sampled.

Two marketplaces are emitted with their own label sets (TY and HB).  Parts with
``p_size <= 4`` are listed on both sites with the same title and price text
(the cross-site duplicates keep-last deduplication must collapse), the rest are
routed by ``p_type``.  A failed detail page (``p_partkey % 23 == 0``) keeps only
scrape time, price and link, as the scraper does.

The spec below is rendered twice: as Spark Columns (``ty_bronze`` /
``hb_bronze``) and as DuckDB SQL (``bronze_sql``) for the oracle, so both
engines read identical input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.constants import HB_TO_TY, LINK, PRICE, SCRAPED_AT, TY_FIELDS

HB_TYPES = ["ECONOMY", "LARGE", "PROMO"]
BOTH_SITES_MAX_SIZE = 4
FAILED_PAGE_MOD = 23
OLD_SNAPSHOT_MOD = 17

# label -> (modulus of p_partkey, values).  ``None`` is a missing attribute;
# ("col", name) copies a part column.  Test-data choices, not fixed values.
VARIANTS: dict[str, tuple[int, list]] = {
    "Marka": (13, ["Lenovo", "CASPER", "Apple", "HP", "Hewlett Packard", "MSI", "Asus", "Acer",
                   "Huawei", "Game Garaj", "Belirtilmemiş", ("col", "p_brand"), "  lenovo "]),
    "Kullanım Amacı": (5, ["Ofis ve Is", "Ev - Okul", "Oyun", "Belirtilmemiş", None]),
    "Renk": (7, ["Gri", "Siyah", "Gri; Siyah", "Gümüş", "-", "Gri, Gri", None]),
    "Cihaz Ağırlığı": (4, ["2 kg ve Altı", "2 - 4 kg", "2,2 kg", "Bilinmiyor"]),
    "İşlemci Tipi": (11, ["Intel Core i5", "AMD Ryzen 7", "Intel Core 5", "Intel Core Ultra 7",
                          "AMD Ryzen AI 9", "Intel N100", "Intel Celeron", "Apple M2", "Intel Core i7",
                          "Intel Core Ultra", None]),
    "İşlemci Modeli": (4, ["13620H", "Belirtilmemiş", "7530U", "N100"]),
    "İşlemci Nesli": (7, ["13.Nesil", "13. Nesil", "Ryzen", "Series 2", "12. Nesil", "16", None]),
    "İşlemci Çekirdek Sayısı": (5, ["8", "16", "Belirtilmemiş", "12", "4"]),
    "Maksimum İşlemci Hızı (GHz)": (6, ["4,6 GHz", "3.2", "5.0 GHz", "2,8", "7 GHz", None]),
    "Ram (Sistem Belleği)": (6, ["16 GB", "8 GB", None, "32 GB", "Yok", "256 GB"]),
    "Ram (Sistem Belleği) Tipi": (4, ["DDR5", "DDR4", "LPDDR4X", None]),
    "Ekran Kartı": (5, ["Onboard", "Nvidia GeForce RTX 4050", "Intel UHD Graphics", "AMD Radeon Graphics",
                        "Nvidia GeForce RTX 4060"]),
    "Ekran Kartı Tipi": (6, ["Dahili Ekran Kartı", "Yüksek Seviye Harici Ekran Kartı", "Harici Ekran Kartı",
                             "Onboard", "x", None]),
    "Ekran Kartı Hafızası": (7, ["Paylaşımlı", "6 GB", "4 GB ve altı", "8 GB", "64 GB", "Intel UHD", None]),
    "Ekran Kartı Bellek Tipi": (3, ["GDDR6", "Onboard", None]),
    "SSD Kapasitesi": (7, ["512 GB", "1 TB", "Yok", None, "256 GB", "2 TB", None]),
    "Hard Disk Kapasitesi": (5, ["Yok", "HDD Yok", "128 GB", "1 TB", "500 GB"]),
    "Ekran Boyutu": (6, ["15,6 inç", "16 inç", "14 inç", "17.3 inç", None, "0 inç"]),
    "Çözünürlük": (7, ["1920 x 1080", "1920×1080", "2560 x 1600", "FHD", None, "1920 X 1200", "2880x1800"]),
    "Çözünürlük Standartı": (5, ["WUXGA", "Full HD (FHD)", None, None, None]),
    "Ekran Yenileme Hızı": (6, ["60 Hz", "165 Hz", None, "144 Hz", "400 Hz", None]),
    "Panel Tipi": (9, ["IPS", "LCD", "FHD", "OLED", "Mini LED", "LED", "TN", None, "IPS Level"]),
    "İşletim Sistemi": (9, ["Yok (Free Dos)", "Free Dos (Isletim Sistemi Yok)", "Windows 11 Home",
                            "Windows 11 Pro", "Free Dos", "Mac Os", "Ubuntu", "Android", None]),
}

TITLE_BRANDS = (7, ["Lenovo", "Casper", "Apple", "HP", "MSI", "Asus", "Acer"])
TITLE_SPECS = (12, [
    '16GB 512GB SSD 15.6" FHD IPS',
    "8GB RAM 1 TB SSD 144Hz",
    "32GB 1TB SSD WUXGA",
    "Intel UHD 8gb 256 gb nvme m.2 ssd",
    "128GB SSD 8GB 60Hz 165 Hz",
    "Retina 16GB 512GB SSD",
    "MacBook Air 8GB 256GB SSD",
    "1920x1200 16GB 1.5TB SSD",
    "QHD+ 2560x1600 240Hz 64GB 2TB SSD",
    "20Hz 300GB SSD 12GB",
    "2560 x 1440  16GB/1TB SSD",
    "24GB DDR5 1TB SSD 120 Hz",
])

SITES = {
    # site -> (domain, scrape day, snapshot day, older snapshot day)
    "ty": ("www.trendyol.example", "2025-12-17", "2025-12-17 13:00:00", "2025-12-16 13:00:00"),
    "hb": ("www.hepsiburada.example", "2025-12-18", "2025-12-18 09:00:00", "2025-12-10 09:00:00"),
}


# ---------------------------------------------------------------- Spark side

def _pick(k: Column, mod: int, values: list) -> Column:
    idx = k % mod
    out = F.lit(None).cast("string")
    for i in reversed(range(len(values))):
        v = values[i]
        val = F.col(v[1]).cast("string") if isinstance(v, tuple) else F.lit(v).cast("string")
        out = F.when(idx == i, val).otherwise(out)
    return out


def _price_text(k: Column) -> Column:
    lira = F.round(F.col("p_retailprice") * 20).cast("bigint")
    th = F.floor(lira / 1000).cast("bigint").cast("string")
    rest = F.lpad((lira % 1000).cast("string"), 3, "0")
    ku = F.lpad(((k * 37) % 100).cast("string"), 2, "0")
    th_prev = (F.floor(lira / 1000).cast("bigint") - 1).cast("string")
    forms = [
        F.concat(th, F.lit("."), rest, F.lit(" TL")),
        F.concat(th, F.lit("."), rest, F.lit(","), ku, F.lit(" TL")),
        F.concat(lira.cast("string"), F.lit(","), ku),
        F.concat(F.lit("₺"), th, F.lit("."), rest),
        F.concat(lira.cast("string"), F.lit(" TL")),
        F.concat(th, F.lit("."), rest, F.lit(" TL "), th_prev, F.lit("."), rest, F.lit(" TL")),
        F.concat((k % 1000).cast("string"), F.lit(" TL")),
        F.concat(th, F.lit("."), rest, F.lit(","), ku, F.lit(" tl")),
    ]
    idx = k % len(forms)
    out = F.lit(None).cast("string")
    for i in reversed(range(len(forms))):
        out = F.when(idx == i, forms[i]).otherwise(out)
    return out


def _site_frame(part: DataFrame, site: str) -> DataFrame:
    domain, day, snap, old_snap = SITES[site]
    k = F.col("p_partkey")
    failed = (k % FAILED_PAGE_MOD) == 0
    both = F.col("p_size") <= BOTH_SITES_MAX_SIZE
    in_hb = F.col("p_type").isin(HB_TYPES)
    rows = part.where(both | (in_hb if site == "hb" else ~in_hb))
    null_s = F.lit(None).cast("string")
    title = F.concat_ws(" ", _pick(k, *TITLE_BRANDS), F.col("p_name"), _pick(k, *TITLE_SPECS))
    cols = {"Başlık": F.when(~failed, title).otherwise(null_s)}
    for label, (mod, values) in VARIANTS.items():
        cols[label] = F.when(~failed, _pick(k, mod, values)).otherwise(null_s)
    cols[SCRAPED_AT] = F.concat(
        F.lit(day + " "),
        F.lpad((k % 24).cast("string"), 2, "0"), F.lit(":"),
        F.lpad((k % 60).cast("string"), 2, "0"), F.lit(":"),
        F.lpad(((k * 7) % 60).cast("string"), 2, "0"),
    )
    cols[PRICE] = _price_text(k)
    cols[LINK] = F.concat(F.lit(f"https://{domain}/Laptop-P"), k.cast("string"))
    label_of = {v: k_ for k_, v in HB_TO_TY.items()} if site == "hb" else {}
    out = [cols["Başlık"].alias("Başlık")]
    out += [cols[lbl].alias(label_of.get(lbl, lbl)) for lbl in TY_FIELDS if lbl != "Başlık"]
    out += [cols[SCRAPED_AT].alias(SCRAPED_AT), cols[PRICE].alias(PRICE), cols[LINK].alias(LINK)]
    base = F.when((k % OLD_SNAPSHOT_MOD) == 0, F.lit(old_snap)).otherwise(F.lit(snap))
    out.append((F.to_timestamp(base) + F.make_dt_interval(secs=(k % 3600).cast("decimal(18,6)"))).alias("created_at"))
    out.append(k.alias("_seq"))
    return rows.select(*out)


def ty_bronze(part: DataFrame) -> DataFrame:
    """First marketplace, TY labels, all attributes as strings."""
    return _site_frame(part, "ty")


def hb_bronze(part: DataFrame) -> DataFrame:
    """Second marketplace, HB labels (7 differ from TY)."""
    return _site_frame(part, "hb")


# ---------------------------------------------------------------- SQL side

def _q(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _pick_sql(mod: int, values: list) -> str:
    parts = []
    for i, v in enumerate(values):
        val = "NULL" if v is None else (f"CAST({v[1]} AS VARCHAR)" if isinstance(v, tuple) else _q(v))
        parts.append(f"WHEN {i} THEN {val}")
    return f"CASE p_partkey % {mod} " + " ".join(parts) + " ELSE NULL END"


def _price_sql() -> str:
    lira = "CAST(round(p_retailprice * 20) AS BIGINT)"
    th = f"CAST(CAST(floor({lira} / 1000) AS BIGINT) AS VARCHAR)"
    rest = f"lpad(CAST({lira} % 1000 AS VARCHAR), 3, '0')"
    ku = "lpad(CAST((p_partkey * 37) % 100 AS VARCHAR), 2, '0')"
    th_prev = f"CAST(CAST(floor({lira} / 1000) AS BIGINT) - 1 AS VARCHAR)"
    forms = [
        f"{th} || '.' || {rest} || ' TL'",
        f"{th} || '.' || {rest} || ',' || {ku} || ' TL'",
        f"CAST({lira} AS VARCHAR) || ',' || {ku}",
        f"'₺' || {th} || '.' || {rest}",
        f"CAST({lira} AS VARCHAR) || ' TL'",
        f"{th} || '.' || {rest} || ' TL ' || {th_prev} || '.' || {rest} || ' TL'",
        "CAST(p_partkey % 1000 AS VARCHAR) || ' TL'",
        f"{th} || '.' || {rest} || ',' || {ku} || ' tl'",
    ]
    return f"CASE p_partkey % {len(forms)} " + " ".join(f"WHEN {i} THEN {f}" for i, f in enumerate(forms)) + " END"


def bronze_sql(site: str, label_names: bool = False) -> str:
    """DuckDB SELECT over ``part`` producing the site's bronze rows.

    With ``label_names=False`` columns are named by their English silver name
    (TY label mapped through LABEL_TO_EN) which keeps oracle SQL readable.
    """
    from vitrine.constants import LABEL_TO_EN

    domain, day, snap, old_snap = SITES[site]
    failed = f"p_partkey % {FAILED_PAGE_MOD} = 0"
    hb_types = ", ".join(_q(t) for t in HB_TYPES)
    route = f"p_type IN ({hb_types})" if site == "hb" else f"p_type NOT IN ({hb_types})"
    title = (f"concat_ws(' ', {_pick_sql(*TITLE_BRANDS)}, p_name, {_pick_sql(*TITLE_SPECS)})")
    cols = [f"CASE WHEN {failed} THEN NULL ELSE {title} END AS {_name('Başlık', label_names)}"]
    for lbl in TY_FIELDS:
        if lbl == "Başlık":
            continue
        mod, values = VARIANTS[lbl]
        cols.append(f"CASE WHEN {failed} THEN NULL ELSE {_pick_sql(mod, values)} END AS {_name(lbl, label_names)}")
    cols.append(
        f"{_q(day + ' ')} || lpad(CAST(p_partkey % 24 AS VARCHAR), 2, '0') || ':' || "
        f"lpad(CAST(p_partkey % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST((p_partkey * 7) % 60 AS VARCHAR), 2, '0')"
        f" AS {_name(SCRAPED_AT, label_names)}"
    )
    cols.append(f"{_price_sql()} AS {_name(PRICE, label_names)}")
    cols.append(f"'https://{domain}/Laptop-P' || CAST(p_partkey AS VARCHAR) AS {_name(LINK, label_names)}")
    cols.append(
        f"CASE WHEN p_partkey % {OLD_SNAPSHOT_MOD} = 0 THEN TIMESTAMP {_q(old_snap)} ELSE TIMESTAMP {_q(snap)} END"
        f" + to_seconds(CAST(p_partkey % 3600 AS BIGINT)) AS created_at"
    )
    cols.append("p_partkey AS _seq")
    return (f"SELECT {', '.join(cols)} FROM part WHERE p_size <= {BOTH_SITES_MAX_SIZE} OR {route}")


def _name(label: str, label_names: bool) -> str:
    from vitrine.constants import LABEL_TO_EN

    return '"' + label + '"' if label_names else LABEL_TO_EN[label]
