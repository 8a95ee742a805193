"""Profiling queries: frequencies, missingness, summaries, quantiles, histograms,
KDE, correlation, group statistics, imputation, duplicates, sampling
(A3, A5-A17, A24, O1-O6, W2, W3, F5, F6, F10, J3, M3, M9, T21, U3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.operators import profile as P
from vitrine.operators.categories import distinct_sorted, keep_top_k, value_counts
from vitrine.operators.dedup import duplicate_summary, flag_duplicates, keep_first, text_digest
from vitrine.operators.filters import keep_positive_share, positive
from vitrine.operators.quantiles import exact_median
from vitrine.plans.catalog import register, round_doubles, table
from vitrine.sources.tables import DRIVER_TABLES

LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _docs_labels(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    return docs.join(labels, "doc_id", "left").select("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")


DOCS_LABELS_SQL = ("SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic "
                   "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
DL_COLS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]


# ------------------------------------------------------------ frequencies

@register("value_counts", "A3 O1", sql=(
    "SELECT p_type, CAST(count(*) AS BIGINT) AS n FROM part WHERE p_type IS NOT NULL GROUP BY p_type"))
def q_value_counts(spark, sf_dir):
    return value_counts(table(spark, sf_dir, "part"), "p_type")


@register("value_counts_events", "A3", sql=(
    "SELECT event_type, CAST(count(*) AS BIGINT) AS n FROM events WHERE event_type IS NOT NULL GROUP BY event_type"))
def q_value_counts_events(spark, sf_dir):
    return value_counts(table(spark, sf_dir, "events"), "event_type")


@register("top_k_semi", "O2 J3 F6", sql=(
    "WITH t AS (SELECT user_id FROM events WHERE user_id IS NOT NULL GROUP BY user_id "
    "ORDER BY count(*) DESC, user_id LIMIT 8) "
    "SELECT event_id, user_id, event_type FROM events WHERE user_id IN (SELECT user_id FROM t)"))
def q_top_k_semi(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return keep_top_k(ev, "user_id", 8)


# ------------------------------------------------------------ missingness

def _missing_sql(where: str = "") -> str:
    parts = [f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS n_missing, "
             f"round(100.0 * CAST(count(*) - count({c}) AS DOUBLE) / count(*), 4) AS pct_missing FROM j"
             for c in DL_COLS]
    return f"WITH j AS ({DOCS_LABELS_SQL}) SELECT * FROM (" + " UNION ALL ".join(parts) + f") {where}"


@register("missing_pct", "A5 F10 O1", sql=_missing_sql("WHERE pct_missing > 0"))
def q_missing_pct(spark, sf_dir):
    return round_doubles(keep_positive_share(P.missing_report(_docs_labels(spark, sf_dir)), "pct_missing"))


@register("null_counts", "A6 O1", sql=_missing_sql())
def q_null_counts(spark, sf_dir):
    return round_doubles(P.missing_report(_docs_labels(spark, sf_dir)))


# ------------------------------------------------------------ numeric summaries

@register("numeric_summary", "A7 A8", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS count, round(avg({c}), 4) AS mean, "
    f"round(stddev_samp({c}), 4) AS std, round(min({c}), 4) AS min, round(quantile_cont({c}, 0.25), 4) AS p25, "
    f"round(quantile_cont({c}, 0.5), 4) AS p50, round(quantile_cont({c}, 0.75), 4) AS p75, round(max({c}), 4) AS max "
    f"FROM lineitem" for c in LI_NUM))
def q_numeric_summary(spark, sf_dir):
    return round_doubles(P.numeric_summary(table(spark, sf_dir, "lineitem"), LI_NUM))


def _box_sql(cols, by=None, source="lineitem", pre=""):
    key = f", {by}" if by else ""
    long = " UNION ALL ".join(f"SELECT '{c}' AS column_name{key}, CAST({c} AS DOUBLE) AS value FROM src" for c in cols)
    inside = "value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)"
    return (f"WITH {pre}src AS (SELECT * FROM {source}), long AS ({long}), "
            f"q AS (SELECT column_name{key}, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, "
            f"quantile_cont(value, 0.75) AS q3 FROM long WHERE value IS NOT NULL GROUP BY column_name{key}) "
            f"SELECT column_name{key}, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3, "
            f"round(q3 - q1, 4) AS iqr, round(min(CASE WHEN {inside} THEN value END), 4) AS whisker_lo, "
            f"round(max(CASE WHEN {inside} THEN value END), 4) AS whisker_hi, "
            f"CAST(sum(CASE WHEN {inside} THEN 0 ELSE 1 END) AS BIGINT) AS n_outliers "
            f"FROM long JOIN q USING (column_name{key}) WHERE value IS NOT NULL GROUP BY column_name{key}, q1, median, q3")


@register("box_stats", "A13", sql=_box_sql(["l_quantity", "l_extendedprice", "l_discount"]))
def q_box_stats(spark, sf_dir):
    return round_doubles(P.box_stats(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]))


@register("box_by_top_group", "A13 O2 J3", sql=_box_sql(
    ["l_extendedprice"], by="l_suppkey",
    source="lineitem WHERE l_suppkey IN (SELECT l_suppkey FROM top)",
    pre="top AS (SELECT l_suppkey FROM lineitem WHERE l_suppkey IS NOT NULL GROUP BY l_suppkey "
        "ORDER BY count(*) DESC, l_suppkey LIMIT 8), "))
def q_box_by_top(spark, sf_dir):
    li = keep_top_k(table(spark, sf_dir, "lineitem").select("l_suppkey", "l_extendedprice"), "l_suppkey", 8)
    return round_doubles(P.box_stats(li, ["l_extendedprice"], by=["l_suppkey"]))


# ------------------------------------------------------------ histograms, KDE

def _hist_sql(expr: str, bins: int, where: str) -> str:
    return (f"WITH d AS (SELECT {expr} AS x FROM orders WHERE {where}), "
            f"r AS (SELECT min(x) AS mn, max(x) AS mx FROM d) "
            f"SELECT bin, round(mn + bin * (mx - mn) / {bins}, 4) AS bin_lo, round(mn + (bin + 1) * (mx - mn) / {bins}, 4) AS bin_hi, "
            f"CAST(count(*) AS BIGINT) AS n FROM (SELECT CAST(CASE WHEN (mx - mn) / {bins} = 0 THEN 0 "
            f"ELSE least(floor((x - mn) / ((mx - mn) / {bins})), {bins - 1}) END AS INTEGER) AS bin, mn, mx FROM d, r) "
            f"GROUP BY bin, mn, mx")


@register("histogram", "A14", sql=_hist_sql("o_totalprice", 30, "o_totalprice IS NOT NULL"))
def q_histogram(spark, sf_dir):
    return round_doubles(P.histogram(table(spark, sf_dir, "orders").select("o_totalprice"), "o_totalprice", 30))


@register("log_histogram", "A14 F5 T21", sql=_hist_sql("ln(o_totalprice)", 50, "o_totalprice > 0"))
def q_log_histogram(spark, sf_dir):
    o = positive(table(spark, sf_dir, "orders").select("o_totalprice"), "o_totalprice")
    return round_doubles(P.histogram(o.select(F.log("o_totalprice").alias("log_price")), "log_price", 50))


@register("kde_grid", "A15", sql=(
    "WITH d AS (SELECT o_totalprice AS x FROM orders WHERE o_totalprice IS NOT NULL), "
    "s AS (SELECT count(*) AS n, stddev_samp(x) AS sd, min(x) AS mn, max(x) AS mx FROM d), "
    "g AS (SELECT i, mn + (mx - mn) * (CAST(i AS DOUBLE) / 99) AS gx, sd * pow(n, -0.2) AS bw, n FROM s, range(100) t(i)) "
    "SELECT i, round(gx, 4) AS x, round(sum(exp(-0.5 * pow((d.x - g.gx) / g.bw, 2))) / (g.n * g.bw * sqrt(2 * pi())) * 1e6, 4) "
    "AS density_1e6 FROM g, d GROUP BY i, gx, bw, n"))
def q_kde(spark, sf_dir):
    k = P.kde_grid(table(spark, sf_dir, "orders").select("o_totalprice"), "o_totalprice", 100)
    return round_doubles(k.select(F.col("i").cast("long").alias("i"), "x", (F.col("density") * 1e6).alias("density_1e6")))


# ------------------------------------------------------------ correlation, groups

@register("corr_matrix", "A16", sql=" UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 4) AS r FROM lineitem" for a in LI_NUM for b in LI_NUM))
def q_corr(spark, sf_dir):
    return round_doubles(P.corr_matrix(table(spark, sf_dir, "lineitem"), LI_NUM))


@register("group_mean_sd", "A11", sql=(
    "SELECT c.c_mktsegment, round(avg(o.o_totalprice), 4) AS mean, round(stddev_samp(o.o_totalprice), 4) AS sd, "
    "CAST(count(o.o_totalprice) AS BIGINT) AS n FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey "
    "GROUP BY c.c_mktsegment"))
def q_group_mean_sd(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return round_doubles(P.group_mean_sd(o.join(c, "o_custkey"), "c_mktsegment", "o_totalprice"))


@register("group_mean", "A12", sql=(
    "SELECT o_orderpriority, round(avg(o_totalprice), 4) AS mean, round(stddev_samp(o_totalprice), 4) AS sd, "
    "CAST(count(o_totalprice) AS BIGINT) AS n FROM orders GROUP BY o_orderpriority"))
def q_group_mean(spark, sf_dir):
    return round_doubles(P.group_mean_sd(table(spark, sf_dir, "orders"), "o_orderpriority", "o_totalprice"))


# ------------------------------------------------------------ imputation

@register("median_impute", "A8 M3", sql=(
    f"WITH j AS ({DOCS_LABELS_SQL}), m AS (SELECT quantile_cont(quality, 0.5) AS mq, quantile_cont(toxic, 0.5) AS mt FROM j) "
    "SELECT doc_id, round(coalesce(CAST(quality AS DOUBLE), mq), 4) AS quality, "
    "round(coalesce(CAST(toxic AS DOUBLE), mt), 4) AS toxic FROM j, m"))
def q_median_impute(spark, sf_dir):
    j = _docs_labels(spark, sf_dir).select("doc_id", F.col("quality").cast("double"), F.col("toxic").cast("double"))
    out = j
    for c in ("quality", "toxic"):
        med = exact_median(j, c).select("median").scalar()
        out = out.withColumn(c, F.coalesce(F.col(c), med))
    return round_doubles(out)


_MODE_COLS = ["lang", "source", "quality_label", "toxic_label"]


@register("mode_impute", "A9 M9", sql=(
    f"WITH j AS ({DOCS_LABELS_SQL}), c AS (SELECT doc_id, lang, source, CAST(quality AS VARCHAR) AS quality_label, "
    "CAST(toxic AS VARCHAR) AS toxic_label FROM j), "
    + ", ".join(
        f"m_{c} AS (SELECT coalesce((SELECT v FROM (SELECT {c} AS v, count(*) AS n FROM c WHERE {c} IS NOT NULL "
        f"GROUP BY {c}) ORDER BY n DESC, v LIMIT 1), 'missing') AS v)" for c in _MODE_COLS)
    + " SELECT doc_id, " + ", ".join(f"coalesce({c}, (SELECT v FROM m_{c})) AS {c}" for c in _MODE_COLS) + " FROM c"))
def q_mode_impute(spark, sf_dir):
    j = _docs_labels(spark, sf_dir).select(
        "doc_id", "lang", "source", F.col("quality").cast("string").alias("quality_label"),
        F.col("toxic").cast("string").alias("toxic_label"))
    modes = P.column_modes(j, _MODE_COLS).withColumnRenamed("mode", "fill")
    return P.fill_with(j, modes)


@register("categorical_options", "A10 O6 S12", sql=" UNION ALL ".join(
    f"SELECT DISTINCT '{c}' AS column_name, {c} AS value FROM part WHERE {c} IS NOT NULL" for c in ["p_brand", "p_type"]))
def q_options(spark, sf_dir):
    return distinct_sorted(table(spark, sf_dir, "part"), ["p_brand", "p_type"])


# ------------------------------------------------------------ duplicates

@register("dedup_full_row", "W2 U3", sql=(
    "SELECT doc_id, n_chars FROM (SELECT doc_id, n_chars, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn "
    "FROM documents) WHERE rn = 1"))
def q_dedup_full(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(*text_digest("text"), "doc_id", "n_chars")
    return keep_first(d, ["text_digest", "text_length"], ["doc_id"]).select("doc_id", "n_chars")


@register("dup_flags", "W3", sql=(
    "SELECT doc_id, count(*) OVER (PARTITION BY text) > 1 AS is_dup FROM documents"))
def q_dup_flags(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", *text_digest("text"))
    return flag_duplicates(d, ["text_digest", "text_length"]).select("doc_id", "is_dup")


@register("dup_summary", "A17", sql=(
    "SELECT CAST(coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS rows_in_dup_groups, "
    "CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS rows_dropped, CAST(count(*) AS BIGINT) AS rows_remaining "
    "FROM (SELECT text, lang, source, count(*) AS n FROM documents GROUP BY text, lang, source)"))
def q_dup_summary(spark, sf_dir):
    return duplicate_summary(table(spark, sf_dir, "documents").select(*text_digest("text"), "lang", "source"))


# ------------------------------------------------------------ sampling / head

@register("sample_rows", "O5", sql=(
    "SELECT p_partkey, p_name FROM part ORDER BY md5(CAST(p_partkey AS VARCHAR)) LIMIT 10"))
def q_sample(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return p.orderBy(F.md5(p["p_partkey"].cast("string"))).limit(10)


@register("head_rows", "O4", sql="SELECT p_partkey, p_name, p_brand FROM part ORDER BY p_partkey LIMIT 10")
def q_head(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand").orderBy("p_partkey").limit(10)


_SHAPE_TABLES = DRIVER_TABLES


@register("table_shapes", "A2", sql=" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS n_rows, "
    f"CAST((SELECT count(*) FROM (DESCRIBE {t})) AS BIGINT) AS n_cols FROM {t}" for t in _SHAPE_TABLES))
def q_table_shapes(spark, sf_dir):
    out = None
    for t in _SHAPE_TABLES:
        df = table(spark, sf_dir, t)
        row = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(t).alias("table_name"), "n_rows", F.lit(len(df.columns)).cast("long").alias("n_cols"))
        out = row if out is None else out.unionByName(row)
    return out


# ------------------------------------------------------------ whole profile

_PROFILE_NUM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_PROFILE_CAT = ["l_returnflag", "l_linestatus"]


def _profile_sql(source: str, nums: list[str], cats: list[str], others: list[str], bins: int = 30) -> str:
    parts = [f"SELECT '{c}' AS column_name, '{s}' AS stat, '' AS key, round(CAST({x} AS DOUBLE), 4) AS value FROM {source}"
             for c in [*nums, *cats, *others]
             for s, x in (("missing", f"count(*) - count({c})"), ("missing_pct", f"100.0 * (count(*) - count({c})) / count(*)"))]
    parts += [f"SELECT '{c}', '{s}', '', round(CAST({f}({c}) AS DOUBLE), 4) FROM {source}"
              for c in nums for s, f in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))]
    parts += [f"SELECT '{a}', 'corr', '{b}', round(corr({a}, {b}), 4) FROM {source}" for i, a in enumerate(nums) for b in nums[i + 1:]]
    parts += [f"SELECT '{c}', 'bin', CAST(CAST(least(floor((CAST({c} AS DOUBLE) - mn) / ((mx - mn) / {bins})), {bins - 1}) AS BIGINT) AS VARCHAR) AS key, "
              f"CAST(count(*) AS DOUBLE) FROM {source}, (SELECT CAST(min({c}) AS DOUBLE) AS mn, CAST(max({c}) AS DOUBLE) AS mx FROM {source}) "
              f"WHERE {c} IS NOT NULL GROUP BY 3" for c in nums]
    parts += [f"SELECT '{c}', 'count', {c}, CAST(count(*) AS DOUBLE) FROM {source} WHERE {c} IS NOT NULL GROUP BY {c}" for c in cats]
    return " UNION ALL ".join(parts)


@register("table_profile", "C6 A3 A5 A6 A7 A14 A16", sql=_profile_sql("lineitem", _PROFILE_NUM, _PROFILE_CAT, ["l_shipdate"]))
def q_table_profile(spark, sf_dir):
    """All columns of lineitem in two scans."""
    from vitrine.operators.table_profile import table_profile

    return round_doubles(table_profile(table(spark, sf_dir, "lineitem")))
