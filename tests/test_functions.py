"""Table-driven cases for every standardiser and extractor, including the kept quirks."""

import pytest
from column_eval import evaluate

from vitrine.functions import categorical as cat
from vitrine.functions import numeric as num
from vitrine.functions import title as ttl
from vitrine.functions.geometry import ppi, ppi_for_request
from vitrine.functions.text import clean_text, soft_clean


def test_clean_text(spark):
    got = evaluate(spark, clean_text, ["  HDD   Yok ", "-", "Yok (Free Dos)", "a  b", "Tümü", "NaN", None,
                                       "İşletim Sistemi Yok"])
    assert got[:6] == [None, None, "yok (free dos)", "a b", None, None]
    assert got[6] is None
    # quirk 6: dotted capital I lower-cases to two code points, so the stop token does not match
    assert got[7] is not None and got[7] != "işletim sistemi yok"


def test_soft_clean(spark):
    assert evaluate(spark, soft_clean, ["16GB/512GB_SSD | 15,6"]) == ["16gb 512gb ssd 15.6"]


@pytest.mark.parametrize("value,lo,hi,expected", [
    ("4,6 GHz", 1, 6, 4.6), ("13.Nesil", 1, 15, 13.0), ("16", 1, 15, None), ("1 TB", 120, 8192, None),
    ("Ryzen", 1, 15, None), ("512 GB", 120, 8192, 512.0), ("Belirtilmemiş", 1, 15, None),
])
def test_parse_numeric(spark, value, lo, hi, expected):
    assert evaluate(spark, lambda c: num.parse_numeric(c, lo, hi), [value]) == [expected]


def test_gpu_vram(spark):
    assert evaluate(spark, num.parse_gpu_vram, ["Paylaşımlı", "4 GB ve altı", "Intel UHD", "64 GB", None]) == \
        [0.0, 4.0, 0.0, None, None]


def test_price(spark):
    got = evaluate(spark, num.parse_price, ["24.999 TL", "21.269,99 TL", "1299,5", "999 TL", "24.999 TL 22.999 TL",
                                            "nan", "₺45.000", "1_500", "1d", "1e4", "18.002,50 tl"])
    assert got == [24999.0, 21269.99, 1299.5, None, None, None, 45000.0, 1500.0, None, 10000.0, 18002.5]


def test_brand(spark):
    assert evaluate(spark, cat.parse_brand, ["Hewlett Packard", "H.P.", "ILIFE", "Lenovo", "-"]) == \
        ["hp", "hp", "i-life", "lenovo", None]


def test_os(spark):
    got = evaluate(spark, cat.parse_os, ["Windows 11 Pro", "Free Dos", "Free Dos (Isletim Sistemi Yok)", "Mac Os",
                                         "Android", "Windows 11 Home", "Ubuntu", None])
    # quirk 5: 'free dos' with a space is unknown unless 'yok' is present
    assert got == ["windows pro", "unknown", "freedos", "macos", "linux", "windows home", "linux", None]


def test_gpu_type(spark):
    assert evaluate(spark, cat.parse_gpu_type, ["Yüksek Seviye Harici Ekran Kartı", "Harici", "Onboard", "x"]) == \
        ["dedicated_high_end", "dedicated", "integrated", "unknown"]


def test_panel(spark):
    # quirk 3: 'va' matches inside other words
    assert evaluate(spark, cat.parse_panel_type, ["OLED", "Mini LED", "LED", "LCD", "IPS Level", "Nova"]) == \
        ["oled", "mini led", "led", None, "ips", "va"]


def test_resolution(spark):
    assert evaluate(spark, cat.parse_resolution, ["1920 x 1080", "1920×1080", "FHD", "2560X1600"]) == \
        ["1920x1080", "1920x1080", None, "2560x1600"]


def test_cpu_family(spark):
    got = evaluate(spark, cat.parse_cpu_family, ["Intel Core i5", "Intel Core Ultra 7", "Intel Core 5", "AMD Ryzen AI 9",
                                                 "Intel N100", "AMD Ryzen 7", "Intel Celeron", "Apple M2"])
    assert got == ["intel core i5", "intel core ultra 7", "intel core", "amd ryzen", "other", "amd ryzen 7",
                   "intel celeron", "apple silicon"]


def test_title_ssd(spark):
    assert evaluate(spark, ttl.extract_ssd, ["16GB 512GB SSD", "1TB SSD", "512GB NVMe M.2 SSD", "300GB SSD",
                                             "1.5tb ssd", "2 TB SSD 512GB SSD", None]) == \
        [512, 1024, 512, None, None, 2048, None]


def test_title_ram(spark):
    assert evaluate(spark, ttl.extract_ram, ["16GB 512GB SSD", "128GB SSD 8GB", "8GB RAM", "256GB", "16gb ssd"]) == \
        [16.0, None, 8.0, None, 16.0]


def test_title_hz(spark):
    assert evaluate(spark, ttl.extract_refresh_rate, ["60Hz 165 Hz", "20Hz", "400hz 144HZ"]) == [165.0, None, 144.0]


def test_title_display(spark):
    got = evaluate(spark, ttl.extract_display_standard, ["Retina", "qhd+", "Full HD", "Intel UHD", "1920x1200",
                                                         "800x600", "Liquid Retina XDR"])
    # quirk 3: 'HD' matches inside 'uhd'
    assert got == ["Retina", "QHD+", "Full HD", "HD", "WUXGA", None, "Retina"]


def test_ppi(spark):
    df = spark.createDataFrame([("1920x1080", 15.6), (None, 15.6), ("1920x1080", 0.0), ("abc", 14.0)], "r STRING, i DOUBLE")
    got = [r[0] for r in df.select(ppi("r", "i")).collect()]
    assert round(got[0], 4) == 141.2120 and got[1:] == [None, None, None]
    got = [r[0] for r in df.select(ppi_for_request("r", "i")).collect()]
    assert round(got[0], 4) == 141.2120
