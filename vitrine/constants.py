"""Fixed values.

Everything in this module is a FIXED VALUE that must equal the behaviour being
reproduced (listing field labels, stop tokens, keyword lists, lookup maps,
bounds).  They are data, not logic; keep them in the order given.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES — bronze field labels and column maps
# ---------------------------------------------------------------------------

# Second-source (HB) label -> first-source (TY) label.
HB_TO_TY = {
    "İşlemci": "İşlemci Modeli",
    "Maksimum İşlemci Hızı": "Maksimum İşlemci Hızı (GHz)",
    "Ram Tipi": "Ram (Sistem Belleği) Tipi",
    "Harddisk Kapasitesi": "Hard Disk Kapasitesi",
    "Max Ekran Çözünürlüğü": "Çözünürlük",
    "Ekran Özelliği": "Çözünürlük Standartı",
    "Ekran Panel Tipi": "Panel Tipi",
}

# TY label -> English silver column name.
LABEL_TO_EN = {
    "Başlık": "title",
    "Marka": "brand",
    "Kullanım Amacı": "intended_use",
    "Renk": "color",
    "Cihaz Ağırlığı": "weight",
    "İşlemci Tipi": "cpu_family",
    "İşlemci Modeli": "cpu_model",
    "İşlemci Nesli": "cpu_generation",
    "İşlemci Çekirdek Sayısı": "cpu_cores",
    "Maksimum İşlemci Hızı (GHz)": "cpu_max_ghz",
    "Ram (Sistem Belleği)": "ram_gb",
    "Ram (Sistem Belleği) Tipi": "ram_type",
    "Ekran Kartı": "gpu_model",
    "Ekran Kartı Tipi": "gpu_type",
    "Ekran Kartı Hafızası": "gpu_vram_gb",
    "Ekran Kartı Bellek Tipi": "gpu_vram_type",
    "SSD Kapasitesi": "ssd_gb",
    "Hard Disk Kapasitesi": "hdd_gb",
    "Ekran Boyutu": "screen_size_inch",
    "Çözünürlük": "resolution",
    "Çözünürlük Standartı": "display_standard",
    "Ekran Yenileme Hızı": "refresh_rate_hz",
    "Panel Tipi": "panel_type",
    "İşletim Sistemi": "operating_system",
    "Fiyat (TRY)": "price_try",
    "Link": "url",
    "Çekilme Zamanı": "scraped_at",
}

# Declared silver/gold column order (ppi goes right after screen_size_inch).
FINAL_COLUMN_ORDER = [
    "title", "brand", "price_try",
    "intended_use", "color", "weight", "operating_system",
    "cpu_family", "cpu_model", "cpu_generation", "cpu_cores", "cpu_max_ghz",
    "ram_gb", "ram_type", "ssd_gb", "hdd_gb",
    "gpu_model", "gpu_type", "gpu_vram_gb", "gpu_vram_type",
    "screen_size_inch", "resolution", "display_standard", "refresh_rate_hz", "panel_type",
    "platform", "url", "scraped_at", "processed_at",
]

# FIXED VALUES: class names and test ids of the two sites' pages.
TY_PAGE = {
    "card": "product-card", "brand": "product-brand", "name": "product-name", "price": "single-price",
    "title": "product-title", "row": "attribute-item", "label": "name", "value": "value",
}
HB_PAGE = {
    "price": "final-price", "title": "title", "brand": "brand",
    "row": "jkj4C4LML4qv2Iq8GkL3", "label": "OXP5AzPvafgN_i3y6wGp", "value": "AxM3TmSghcDRH1F871Vh",
}

# Detail-page labels kept by the extractor, per site (24 each).
TY_FIELDS = [
    "Başlık", "Marka", "Kullanım Amacı", "Renk", "Cihaz Ağırlığı", "İşlemci Tipi",
    "İşlemci Modeli", "İşlemci Nesli", "İşlemci Çekirdek Sayısı", "Maksimum İşlemci Hızı (GHz)",
    "Ram (Sistem Belleği)", "Ram (Sistem Belleği) Tipi", "Ekran Kartı", "Ekran Kartı Tipi",
    "Ekran Kartı Hafızası", "Ekran Kartı Bellek Tipi", "SSD Kapasitesi", "Hard Disk Kapasitesi",
    "Ekran Boyutu", "Çözünürlük", "Çözünürlük Standartı", "Ekran Yenileme Hızı", "Panel Tipi",
    "İşletim Sistemi",
]
HB_FIELDS = [
    "Başlık", "Marka", "Kullanım Amacı", "Renk", "Cihaz Ağırlığı", "İşlemci Tipi",
    "İşlemci", "İşlemci Nesli", "İşlemci Çekirdek Sayısı", "Maksimum İşlemci Hızı",
    "Ram (Sistem Belleği)", "Ram Tipi", "Ekran Kartı", "Ekran Kartı Tipi",
    "Ekran Kartı Hafızası", "Ekran Kartı Bellek Tipi", "SSD Kapasitesi", "Harddisk Kapasitesi",
    "Ekran Boyutu", "Max Ekran Çözünürlüğü", "Ekran Özelliği", "Ekran Yenileme Hızı",
    "Ekran Panel Tipi", "İşletim Sistemi",
]
SCRAPED_AT = "Çekilme Zamanı"
PRICE = "Fiyat (TRY)"
LINK = "Link"

# ---------------------------------------------------------------------------
# FIXED VALUES — text cleaning and parsers
# ---------------------------------------------------------------------------

# Cleaned strings equal to one of these become NULL (exact match only).
STOP_TOKENS = [
    "", "nan", "none", "null", "-", "yok", "belirtilmemiş", "belirtilmemis",
    "hdd yok", "ssd yok", "işletim sistemi yok", "bilinmiyor", "tanımsız", "tümü",
]

# Any of these inside a VRAM value means shared memory -> 0.0 GB.
SHARED_VRAM_KEYWORDS = [
    "paylaşım", "paylasim", "dahili", "entegre", "integrated", "onboard", "intel",
    "amd radeon graphics", "uma",
]

# Exact brand rewrites after cleaning (others pass through).
BRAND_MAP = {
    "hewlett packard": "hp",
    "h.p.": "hp",
    "ilife": "i-life",
    "i-life digital": "i-life",
    "game garaj": "game garaj",
    "huawei": "huawei",
}

# Integrated-GPU keywords for the GPU type parser.
INTEGRATED_GPU_KEYWORDS = ["dahili", "onboard", "integrated", "paylaşım"]

# Panel types, tested in this order by substring.
PANEL_TYPES = ["ips", "tn", "va", "oled", "mini led", "led"]

# Range guards per silver numeric column: (min, max), inclusive.
NUMERIC_BOUNDS = {
    "cpu_generation": (1, 15),
    "cpu_cores": (1, 15),
    "cpu_max_ghz": (1, 6),
    "ram_gb": (4, 128),
    "ssd_gb": (120, 8192),
    "hdd_gb": (120, 8192),
    "screen_size_inch": (10, 20),
    "refresh_rate_hz": (30, 360),
}
GPU_VRAM_BOUNDS = (0, 32)
PRICE_BOUNDS = (1000, 1_000_000)

# ---------------------------------------------------------------------------
# FIXED VALUES — title extractors
# ---------------------------------------------------------------------------

# SSD capacities (GB) accepted from titles.
ALLOWED_SSD_GB = [4, 120, 128, 250, 256, 500, 512, 1024, 2048, 4096, 8192]

# Display-standard keywords, first contained wins (case-insensitive test,
# original case written).
DISPLAY_PRIORITIES = ["OLED", "WQXGA", "WUXGA", "QHD+", "QHD", "Full HD", "FHD", "HD"]

# Pixel size -> display standard.
RESOLUTION_NAMES = {
    (1920, 1080): "Full HD",
    (1920, 1200): "WUXGA",
    (2560, 1600): "WQXGA",
    (2560, 1440): "QHD",
    (2880, 1800): "QHD+",
    (3200, 2000): "QHD+",
}

# ---------------------------------------------------------------------------
# FIXED VALUES — feature engineering, modelling config
# ---------------------------------------------------------------------------

RARE_THRESHOLD_DEFAULT = 10
RARE_THRESHOLD_GOLD = 5
RARE_LABEL = "Other"
MISSING_LABEL = "missing"
SCORING_DEFAULT_INCH = 15.6

TARGET_COL = "price_try"
MODEL_DROP_COLS = [
    "url", "scraped_at", "processed_at", "created_at", "title",
    "intended_use", "color", "weight", "display_standard",
    "cpu_model", "cpu_cores", "hdd_gb", "gpu_type", "gpu_vram_type", "resolution",
]
BENCHMARK_MODELS = ["LinearRegression", "RandomForest", "ExtraTrees", "XGBoost", "LightGBM"]
TUNING_TRIALS = 20
TUNING_FOLDS = 3
SEARCH_SPACES = {
    "Ridge": {"alpha": (0.01, 100.0, "log")},
    "Lasso": {"alpha": (0.0001, 10.0, "log")},
    "RandomForest": {"n_estimators": (50, 500, "int"), "max_depth": (5, 30, "int"),
                     "min_samples_split": (2, 15, "int")},
    "ExtraTrees": {"n_estimators": (50, 500, "int"), "max_depth": (5, 30, "int"),
                   "min_samples_split": (2, 15, "int")},
    "XGBoost": {"n_estimators": (100, 1500, "int"), "max_depth": (3, 12, "int"),
                "learning_rate": (0.01, 0.3, "float"), "subsample": (0.5, 1.0, "float"),
                "colsample_bytree": (0.5, 1.0, "float")},
    "LightGBM": {"n_estimators": (100, 1500, "int"), "num_leaves": (20, 150, "int"),
                 "learning_rate": (0.01, 0.3, "float"), "feature_fraction": (0.5, 1.0, "float")},
    "GradientBoosting": {"n_estimators": (100, 600, "int"), "learning_rate": (0.01, 0.3, "float"),
                         "max_depth": (3, 10, "int"), "subsample": (0.5, 1.0, "float"),
                         "min_samples_split": (2, 20, "int")},
}

# Scoring request contract.
REQUIRED_REQUEST_FIELDS = ["ram_gb", "ssd_gb", "screen_size_inch", "resolution"]
OPTIONAL_REQUEST_STRINGS = ["brand", "platform", "panel_type", "operating_system", "cpu_family", "ram_type", "gpu_model"]
OPTIONAL_REQUEST_INTS = ["cpu_generation", "gpu_vram_gb", "refresh_rate_hz"]
OPTIONAL_REQUEST_DOUBLES = ["cpu_max_ghz"]

# --- fixed values: title patterns (capacity followed by an optional 'nvme' / 'm.2' and then 'ssd') ---
_SSD_TAIL = r"\s*(?:nvme\s*)?(?:m\.?2\s*)?(?:ssd|gbssd)\b"
SSD_TB_PATTERN = r"(?iU)(?<![0-9])([0-9]+(?:\.[0-9]+)?)\s*tb" + _SSD_TAIL
SSD_GB_PATTERN = r"(?iU)(?<![0-9])([0-9]{1,4})\s*gb" + _SSD_TAIL
GB_TOKEN = r"(?i)(\d{1,4})\s*gb"
HZ_TOKEN = r"(?i)(\d{1,3})\s*hz"
RES_PATTERN = r"(\d{3,4})\s*[x×X]\s*(\d{3,4})"
# Digits 0-9 of other scripts: full-width, Arabic-Indic, extended Arabic-Indic, Devanagari.
OTHER_DIGITS = "".join(chr(first + i) for first in (0xFF10, 0x0660, 0x06F0, 0x0966) for i in range(10))
