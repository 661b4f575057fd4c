"""Registered queries: profiles, predicates, joins, sources, rules (A05-A23, F01-F07, S06-S15, J05-J07,
C05, C25-C28, Q12-Q19, U04, W07-W08)."""

from __future__ import annotations

import datetime as _dt
import hashlib

from pyspark.sql import functions as F

from panelrank import constants as K
from panelrank.operators import aggregates as A
from panelrank.operators import clean as C
from panelrank.operators import joins as J
from panelrank.operators import score as S
from panelrank.operators import windows as W
from panelrank.plans import batch
from panelrank.plans import sql_common as Q
from panelrank.operators.text import INTENT_RULES
from panelrank.plans.registry import register
from panelrank.session import ensure_checkpoint_dir
from panelrank.sources import cache
from panelrank.sources import fixtures as fx
from panelrank.sources import tables as T
from panelrank.functions import exprs as X

R9 = 9
TIERS_FRESH = ["never", "0-30", "31-90", "91-180", "181+"]


def r9(c, name=None):
    return F.round(F.col(c), R9).alias(name or c)


# ---------------------------------------------------------------- A05-A08
@register("tier_ctr_stats", Q.chain(upto="features") + f"""
SELECT position_tier, round(AVG(ctr), {R9}) AS mean, COUNT(ctr) AS count, median(ctr) AS median
FROM fx_features WHERE position_tier IS NOT NULL GROUP BY position_tier""")
def tier_ctr_stats(spark, sf_dir):
    """Mean, count and exact median of ctr per position tier."""
    g = A.group_stats(batch.features(spark, sf_dir), ["position_tier"], "ctr")
    return g.select("position_tier", r9("mean"), "count", "median")


@register("freshness_counts", Q.chain(upto="features") + """
, lv AS (SELECT * FROM (VALUES ('never', 0), ('0-30', 1), ('31-90', 2), ('91-180', 3), ('181+', 4)) t(freshness_tier, o))
SELECT lv.freshness_tier, COALESCE(c.count, 0) AS count FROM lv
LEFT JOIN (SELECT freshness_tier, COUNT(*) AS count FROM fx_features GROUP BY 1) c ON lv.freshness_tier = c.freshness_tier""")
def freshness_counts(spark, sf_dir):
    """Value counts reindexed to the fixed tier list, 0 filled."""
    return A.value_counts(batch.features(spark, sf_dir, materialize=False), "freshness_tier", levels=TIERS_FRESH)


@register("reason_code_counts", Q.chain() + """
SELECT code AS reason_code, COUNT(*) AS count FROM (SELECT unnest(string_split(reason_codes, '|')) AS code FROM fx_baseline)
GROUP BY 1""")
def reason_code_counts(spark, sf_dir):
    """Reason-code frequencies from the rule queue."""
    return A.reason_counts(batch.rule_queue(spark, sf_dir), "reason_codes")


# ---------------------------------------------------------------- A11-A16
@register("client_span", fx.with_sql("fx_daily") + """
SELECT client_id, COUNT(*) AS total_rows, MIN(report_date) AS min_date, MAX(report_date) AS max_date
FROM fx_daily GROUP BY client_id""")
def client_span(spark, sf_dir):
    """Row count and date span per client."""
    return A.span(fx.fx_daily(spark, sf_dir), "report_date", ["client_id"])


@register("content_orphans", fx.with_sql("fx_daily", "fx_content") + """
, f AS (SELECT DISTINCT content_id FROM fx_daily), d AS (SELECT DISTINCT content_id FROM fx_content)
SELECT COUNT(f.content_id) AS fact_keys, COUNT(d.content_id) AS dim_keys,
       COUNT(*) FILTER (WHERE d.content_id IS NULL) AS fact_orphans,
       COUNT(*) FILTER (WHERE f.content_id IS NULL) AS dim_unused
FROM f FULL JOIN d ON f.content_id = d.content_id""")
def content_orphans(spark, sf_dir):
    """Distinct keys and orphans between the daily fact and the content dimension."""
    return A.distinct_and_orphans(fx.fx_daily(spark, sf_dir), fx.fx_content(spark, sf_dir), "content_id")


@register("ga4_flag_counts", fx.with_sql("fx_daily") + """
SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE ga4_available IS TRUE) AS true_rows,
       COUNT(*) FILTER (WHERE ga4_available = FALSE) AS false_rows,
       COUNT(*) FILTER (WHERE ga4_available IS NULL) AS null_rows FROM fx_daily""")
def ga4_flag_counts(spark, sf_dir):
    """A13 + F01: TRUE / FALSE / NULL rows of the three-valued flag."""
    return A.flag_counts(fx.fx_daily(spark, sf_dir), "ga4_available")


@register("grain_violations", """
SELECT l_orderkey, l_linenumber, COUNT(*) AS c FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def grain_violations(spark, sf_dir):
    """(order, line) keys with more than one row in lineitem."""
    return A.grain_violations(T.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("missing_by_type", fx.with_sql("fx_content") + f"""
, m AS (
  SELECT content_type, COUNT(*) AS rows,
         AVG(CASE WHEN word_count IS NULL THEN 1.0 ELSE 0.0 END) AS m0,
         AVG(CASE WHEN search_volume IS NULL THEN 1.0 ELSE 0.0 END) AS m1,
         AVG(CASE WHEN main_intent IS NULL THEN 1.0 ELSE 0.0 END) AS m2
  FROM fx_content GROUP BY content_type)
SELECT content_type, rows, 'word_count' AS column_name, round(m0, {R9}) AS missing_rate FROM m
UNION ALL SELECT content_type, rows, 'search_volume', round(m1, {R9}) FROM m
UNION ALL SELECT content_type, rows, 'main_intent', round(m2, {R9}) FROM m""")
def missing_by_type(spark, sf_dir):
    """Missing rate per column per content type (missing by category on purpose)."""
    m = A.missing_rates(fx.fx_content(spark, sf_dir), ["word_count", "search_volume", "main_intent"], by="content_type")
    return m.select("content_type", "rows", "column_name", r9("missing_rate"))


@register("metric_presence", Q.chain(upto="snapshot") + """
SELECT COUNT(*) AS rows, metric, rows_positive FROM (
  SELECT 'impressions_90d' AS metric, COUNT(*) FILTER (WHERE impressions_90d > 0) AS rows_positive FROM fx_snapshot
  UNION ALL SELECT 'clicks_90d', COUNT(*) FILTER (WHERE clicks_90d > 0) FROM fx_snapshot
  UNION ALL SELECT 'ai_sessions_90d', COUNT(*) FILTER (WHERE ai_sessions_90d > 0) FROM fx_snapshot
  UNION ALL SELECT 'engaged_sessions_90d', COUNT(*) FILTER (WHERE engaged_sessions_90d > 0) FROM fx_snapshot) p,
  fx_snapshot GROUP BY metric, rows_positive""")
def metric_presence(spark, sf_dir):
    """Rows with metric > 0 per metric."""
    return A.metric_presence(batch.snapshot(spark, sf_dir),
                             ["impressions_90d", "clicks_90d", "ai_sessions_90d", "engaged_sessions_90d"])


# ---------------------------------------------------------------- A17-A19
@register("correlations", Q.chain(upto="features") + f"""
, rk AS (SELECT impressions_90d AS a, clicks_90d AS b,
   (CAST(rank() OVER (ORDER BY impressions_90d) - 1 AS DOUBLE) + CAST(count(*) OVER (PARTITION BY impressions_90d) + 1 AS DOUBLE) / CAST(2 AS DOUBLE)) AS ra,
   (CAST(rank() OVER (ORDER BY clicks_90d) - 1 AS DOUBLE) + CAST(count(*) OVER (PARTITION BY clicks_90d) + 1 AS DOUBLE) / CAST(2 AS DOUBLE)) AS rb
   FROM fx_features)
SELECT 'impressions_90d' AS col_a, 'clicks_90d' AS col_b, 'pearson' AS method, round(corr(a, b), {R9}) AS corr, COUNT(*) AS n FROM rk
UNION ALL SELECT 'impressions_90d', 'clicks_90d', 'log', round(corr(ln(1 + a), ln(1 + b)), {R9}), COUNT(*) FROM rk
UNION ALL SELECT 'impressions_90d', 'clicks_90d', 'spearman', round(corr(ra, rb), {R9}), COUNT(*) FROM rk""")
def correlations(spark, sf_dir):
    """Pearson, log-Pearson and Spearman correlation."""
    f = batch.features(spark, sf_dir)
    out = None
    for how in ("pearson", "log", "spearman"):
        c = A.correlations(f, [("impressions_90d", "clicks_90d")], how)
        out = c if out is None else out.unionByName(c)
    return out.select("col_a", "col_b", "method", r9("corr"), "n")


MATRIX_COLS = K.MODEL_NUMERIC_FEATURES


def _matrix_sql():
    pairs = [(a, b) for i, a in enumerate(MATRIX_COLS) for b in MATRIX_COLS[i + 1:]]
    ranks = ", ".join(f"(rank() OVER (ORDER BY {c}) - 1 + (count(*) OVER (PARTITION BY {c}) + 1) / 2) AS {c}" for c in MATRIX_COLS)

    def one(how, src):
        flat = lambda c: f"stddev_pop({c}) = 0"
        vals = ", ".join(f"CASE WHEN {flat(a)} OR {flat(b)} THEN NULL ELSE round(corr({a}, {b}), 6) END" for a, b in pairs)
        lists = f"[{', '.join(repr(a) for a, _ in pairs)}] AS col_a, [{', '.join(repr(b) for _, b in pairs)}] AS col_b"
        return (f"SELECT unnest(col_a) AS col_a, unnest(col_b) AS col_b, '{how}' AS method, unnest(corr) AS corr, n "
                f"FROM (SELECT {lists}, [{vals}] AS corr, COUNT(*) AS n FROM {src})")
    return (Q.chain(upto="features") + f", ranked AS (SELECT {ranks} FROM fx_features)\n"
            + one("pearson", "fx_features") + " UNION ALL " + one("spearman", "ranked"))


@register("correlation_matrix", _matrix_sql())
def correlation_matrix(spark, sf_dir):
    """Pearson and Spearman matrices over all numeric model inputs."""
    f = batch.features(spark, sf_dir)
    m = A.correlation_matrix(f, MATRIX_COLS).unionByName(A.correlation_matrix(f, MATRIX_COLS, "spearman"))
    return m.select("col_a", "col_b", "method", F.round("corr", 6).alias("corr"), "n")


@register("rate_vs_mean", Q.chain(upto="features") + f"""
SELECT content_type, COUNT(*) AS n, round(SUM(clicks_90d) / SUM(impressions_90d), {R9}) AS weighted_rate,
       round(AVG(clicks_90d / NULLIF(impressions_90d, 0)), {R9}) AS mean_of_rates
FROM fx_features GROUP BY content_type""")
def rate_vs_mean(spark, sf_dir):
    """Denominator-weighted CTR next to the mean of per-page CTRs."""
    r = A.rate_vs_mean(batch.features(spark, sf_dir, materialize=False), ["content_type"], "clicks_90d", "impressions_90d")
    return r.select("content_type", "n", r9("weighted_rate"), r9("mean_of_rates"))


# ---------------------------------------------------------------- A22, A23
@register("query_reconciliation", fx.with_sql("fx_daily", "fx_query") + """
, per AS (SELECT content_id, CAST(SUM(impressions_90d) AS BIGINT) AS kept_impressions, MAX(rare_impressions_share) AS rs,
                 MAX(anonymized_impressions_share) AS ans, CAST(MAX(content_total_impressions_90d) AS BIGINT) AS content_total
          FROM fx_query GROUP BY 1),
fact AS (SELECT content_id, CAST(SUM(impressions) AS BIGINT) AS fact_impressions FROM fx_daily GROUP BY 1)
SELECT per.content_id, kept_impressions, content_total, fact_impressions,
       abs(CAST(kept_impressions AS DOUBLE) / CAST(content_total AS DOUBLE) + rs + ans - 1) < 1e-9 AS shares_complete,
       COALESCE(fact_impressions, 0) = content_total AS fact_match
FROM per LEFT JOIN fact ON per.content_id = fact.content_id""")
def query_reconciliation(spark, sf_dir):
    """Kept + rare + anonymized shares = 1 and query total vs the daily fact, per content. The fixture's query
    table covers every day of the fact, so the compared window is the fact's own span."""
    return W.reconcile_queries(fx.fx_query(spark, sf_dir), fx.fx_daily(spark, sf_dir), window=fx.fx_span_days(spark, sf_dir), end=fx.fx_last_day(spark, sf_dir))


@register("month_frame", fx.with_sql("fx_daily") + f"""
SELECT client_id, content_id, CAST(SUM(impressions) AS BIGINT) AS imp_month, CAST(SUM(clicks) AS BIGINT) AS clk_month,
       round(AVG(position), {R9}) AS pos_month,
       CAST(SUM(CASE WHEN dayofweek(report_date) IN (0, 6) THEN impressions ELSE 0 END) AS BIGINT) AS weekend_imp,
       CAST(SUM(CASE WHEN ga4_available IS TRUE THEN sessions ELSE 0 END) AS BIGINT) AS sessions_month
FROM fx_daily WHERE month = '1998-03' GROUP BY 1, 2""")
def month_frame(spark, sf_dir):
    """A23 + C25 + F01: one month's feature frame (weekend impressions, flag-masked sessions)."""
    m = W.month_frame(fx.fx_daily(spark, sf_dir), "1998-03")
    return m.select("client_id", "content_id", "imp_month", "clk_month", r9("pos_month"), "weekend_imp",
                    "sessions_month")


def _scratch(spark, sf_dir, name):
    """A folder of this session's shared checkpoint folder, one per input folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{hashlib.md5(sf_dir.encode()).hexdigest()}"


@register("month_cache", fx.with_sql("fx_daily") + f"""
SELECT month, client_id, content_id, CAST(SUM(impressions) AS BIGINT) AS imp_month, CAST(SUM(clicks) AS BIGINT) AS clk_month,
       round(AVG(position), {R9}) AS pos_month,
       CAST(SUM(CASE WHEN dayofweek(report_date) IN (0, 6) THEN impressions ELSE 0 END) AS BIGINT) AS weekend_imp,
       CAST(SUM(CASE WHEN ga4_available IS TRUE THEN sessions ELSE 0 END) AS BIGINT) AS sessions_month
FROM fx_daily GROUP BY 1, 2, 3""")
def month_cache(spark, sf_dir):
    """S10 + A23: feature frames of all months from the partitioned cache; only months whose rows changed are rebuilt."""
    cached, _ = cache.refresh(fx.fx_daily(spark, sf_dir), lambda d: W.month_frame(d, None), _scratch(spark, sf_dir, "month-frames"))
    return cached.select(F.col("month").cast("string").alias("month"), "client_id", "content_id", "imp_month", "clk_month", r9("pos_month"), "weekend_imp", "sessions_month")


CALENDAR_SQL = fx.with_sql("fx_daily") + """
, calendar AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(quarter(o_orderdate) AS INTEGER) AS quarter FROM orders)"""


def month_calendar(spark, sf_dir):
    """(month, year, quarter) of every month with orders: a small table."""
    d = F.col("o_orderdate").cast("date")
    return T.table(spark, sf_dir, "orders").select(F.date_format(d, "yyyy-MM").alias("month"), F.year(d).alias("year"), F.quarter(d).alias("quarter")).distinct()


def by_month(spark, sf_dir):
    """(daily fact in month folders, month table), written in the session's scratch folder."""
    daily, _ = cache.refresh(fx.fx_daily(spark, sf_dir), lambda d: d, _scratch(spark, sf_dir, "daily-by-month"))
    path = _scratch(spark, sf_dir, "calendar")
    month_calendar(spark, sf_dir).coalesce(1).write.mode("overwrite").parquet(path)
    return daily, spark.read.parquet(path)


@register("pruned_quarter", CALENDAR_SQL + """
SELECT d.month, COUNT(*) AS rows, CAST(SUM(impressions) AS BIGINT) AS impressions FROM fx_daily d
WHERE month IN (SELECT month FROM calendar WHERE year = 1997 AND quarter = 2) GROUP BY 1""")
def pruned_quarter(spark, sf_dir):
    """S03 + S04: totals of the months a filtered month table names; their folders are pruned at run time."""
    daily, calendar = by_month(spark, sf_dir)
    hit = T.in_months(daily, calendar.filter((F.col("year") == 1997) & (F.col("quarter") == 2)))
    return hit.groupBy(F.col("month").cast("string").alias("month")).agg(F.count(F.lit(1)).alias("rows"), F.sum("impressions").cast("long").alias("impressions"))


# ---------------------------------------------------------------- F02-F07
@register("compound_counts", Q.chain(upto="features") + """
SELECT COUNT(*) AS rows,
  COUNT(*) FILTER (WHERE lower(trend_direction) = 'down' AND impressions_90d > 1000 AND days_since_last_update > 180) AS down_visible_stale,
  COUNT(*) FILTER (WHERE impressions_90d >= 500) AS above_floor FROM fx_features""")
def compound_counts(spark, sf_dir):
    """F02 + F03: volume floor and compound count predicate."""
    f = batch.features(spark, sf_dir)
    return C.count_where(f, {
        "down_visible_stale": (F.lower("trend_direction") == "down") & (F.col("impressions_90d") > 1000)
        & (F.col("days_since_last_update") > 180),
        "above_floor": F.col("impressions_90d") >= 500})


@register("after_client_start", fx.with_sql("fx_clients") + """
SELECT d.client_id, COUNT(*) AS rows, CAST(SUM(d.impressions) AS BIGINT) AS impressions
FROM fx_daily d JOIN fx_clients c ON d.client_id = c.client_id WHERE d.report_date >= c.start_date GROUP BY 1""")
def after_client_start(spark, sf_dir):
    """keep days on/after each client's start; unknown start keeps nothing."""
    d = fx.fx_daily(spark, sf_dir)
    k = C.after_start(d, fx.fx_clients(spark, sf_dir))
    return k.groupBy("client_id").agg(F.count(F.lit(1)).alias("rows"), F.sum("impressions").cast("long").alias("impressions"))


@register("history_depth", fx.with_sql("fx_clients") + """
SELECT COUNT(*) FILTER (WHERE start_date <= (SELECT MAX(start_date) FROM fx_clients) - 365) AS clients_with_history,
       COUNT(start_date) AS clients_with_start, COUNT(*) AS clients FROM fx_clients""")
def history_depth(spark, sf_dir):
    """clients with >= 365 days of history relative to the latest start."""
    return C.history_depth(fx.fx_clients(spark, sf_dir))


@register("unknown_start_rows", fx.with_sql("fx_clients") + """
SELECT COUNT(*) FILTER (WHERE client_id IN (SELECT client_id FROM fx_clients WHERE start_date IS NULL)) AS in_rows,
       COUNT(*) FILTER (WHERE client_id NOT IN (SELECT client_id FROM fx_clients WHERE start_date IS NULL)) AS not_in_rows
FROM fx_daily""")
def unknown_start_rows(spark, sf_dir):
    """semi / anti join on a client set (clients with unknown start)."""
    d = fx.fx_daily(spark, sf_dir)
    ids = fx.fx_clients(spark, sf_dir).filter(F.col("start_date").isNull())
    a = C.in_set(d, ids, "client_id").agg(F.count(F.lit(1)).alias("in_rows"))
    b = C.in_set(d, ids, "client_id", anti=True).agg(F.count(F.lit(1)).alias("not_in_rows"))
    return a.crossJoin(b)


# ---------------------------------------------------------------- S06-S15
@register("table_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in T.TABLES))
def table_counts(spark, sf_dir):
    """S05 + S06: row count per registered table."""
    return T.table_counts({t: T.table(spark, sf_dir, t) for t in T.TABLES})


@register("input_profile", Q.chain(upto="snapshot") + """
SELECT column_name, TRUE AS present, (SELECT COUNT(*) FROM fx_snapshot) AS rows, null_rows, CAST(0 AS BIGINT) AS bad_rows FROM (
  SELECT 'content_id' AS column_name, COUNT(*) FILTER (WHERE content_id IS NULL) AS null_rows FROM fx_snapshot
  UNION ALL SELECT 'client_id', COUNT(*) FILTER (WHERE client_id IS NULL) FROM fx_snapshot
  UNION ALL SELECT 'impressions_90d', COUNT(*) FILTER (WHERE impressions_90d IS NULL) FROM fx_snapshot
  UNION ALL SELECT 'sessions_90d', COUNT(*) FILTER (WHERE sessions_90d IS NULL) FROM fx_snapshot
  UNION ALL SELECT 'content_age_days', COUNT(*) FILTER (WHERE content_age_days IS NULL) FROM fx_snapshot
  UNION ALL SELECT 'trend_direction', COUNT(*) FILTER (WHERE trend_direction IS NULL) FROM fx_snapshot
  UNION ALL SELECT 'word_count', COUNT(*) FILTER (WHERE word_count IS NULL) FROM fx_snapshot)""")
def input_profile(spark, sf_dir):
    """Required columns present (else raises), nulls and failed casts per column."""
    from panelrank import constants as K
    return T.input_profile(batch.snapshot(spark, sf_dir), K.REQUIRED_COLUMNS,
                           ["impressions_90d", "sessions_90d", "content_age_days", "word_count"])


@register("pseudonymized_ids", fx.with_sql("fx_content") + """
SELECT content_id, 'content_' || substring(sha256('s1' || CAST(content_id AS VARCHAR)), 1, 12) AS content_hash_id,
       'client_' || substring(sha256('s1' || client_id), 1, 10) AS client_hash_id FROM fx_content""")
def pseudonymized_ids(spark, sf_dir):
    """Prefix + first n hex chars of sha256(salt || id)."""
    c = fx.fx_content(spark, sf_dir).select("content_id", "client_id")
    c = T.pseudonymize(c, "content_id", "content_", 12, "s1", "content_hash_id")
    c = T.pseudonymize(c, "client_id", "client_", 10, "s1", "client_hash_id")
    return c.select("content_id", "content_hash_id", "client_hash_id")


@register("freshness_cut", fx.with_sql("fx_daily") + """
SELECT COUNT(*) AS rows, MAX(report_date) AS max_date FROM fx_daily
WHERE report_date <= (SELECT MAX(report_date) FROM fx_daily) - 3""")
def freshness_cut(spark, sf_dir):
    """Drop the last 3 days before the export date (= last day)."""
    d = fx.fx_daily(spark, sf_dir)
    c = T.freshness_cut(d, "report_date", fx.fx_last_day(spark, sf_dir))
    return c.agg(F.count(F.lit(1)).alias("rows"), F.max("report_date").alias("max_date"))


@register("dim_clients", fx.with_sql("fx_daily", "fx_query", "fx_content") + """
SELECT client_id, MIN(d) AS first_seen FROM (
  SELECT client_id, report_date AS d FROM fx_daily UNION ALL SELECT client_id, NULL FROM fx_query
  UNION ALL SELECT client_id, NULL FROM fx_content) GROUP BY client_id""")
def dim_clients(spark, sf_dir):
    """Clients seen in three sources, with first day."""
    return T.build_dim_clients([(fx.fx_daily(spark, sf_dir), "client_id", "report_date"),
                                (fx.fx_query(spark, sf_dir), "client_id", None),
                                (fx.fx_content(spark, sf_dir), "client_id", None)])


@register("dim_content_first", fx.with_sql("fx_query_all") + """
SELECT content_id, query_id, client_id, impressions_90d, kind, query_text FROM (
  SELECT *, row_number() OVER (PARTITION BY content_id ORDER BY query_id) AS rn FROM fx_query_all) WHERE rn = 1""")
def dim_content_first(spark, sf_dir):
    """S15 + C07: one row per content, the first by explicit order (query id)."""
    d = T.build_dim_content(fx.fx_query_all(spark, sf_dir), "content_id", ["query_id"])
    return d.select("content_id", "query_id", "client_id", "impressions_90d", "kind", "query_text")


# ---------------------------------------------------------------- J05-J07
@register("star_join", fx.with_sql("fx_daily", "fx_content", "fx_clients") + """
SELECT c.content_type, COUNT(*) AS rows, CAST(SUM(d.impressions) AS BIGINT) AS impressions,
       COUNT(*) FILTER (WHERE k.start_date IS NOT NULL) AS rows_with_start
FROM fx_daily d LEFT JOIN fx_content c ON d.content_id = c.content_id LEFT JOIN fx_clients k ON d.client_id = k.client_id
GROUP BY 1""")
def star_join(spark, sf_dir):
    """Fact -> content (shuffle) and fact -> clients (broadcast), then per content type."""
    d = fx.fx_daily(spark, sf_dir)
    s = J.star(d, fx.fx_content(spark, sf_dir), fx.fx_clients(spark, sf_dir))
    return s.groupBy("content_type").agg(F.count(F.lit(1)).alias("rows"), F.sum("impressions").cast("long").alias("impressions"),
                                         F.count_if(F.col("start_date").isNotNull()).alias("rows_with_start"))


def _url_frames(spark, sf_dir):
    d = fx.fx_daily(spark, sf_dir)
    c = fx.fx_content(spark, sf_dir).select("content_id", "keyword_group")
    x = d.join(c, "content_id")
    search = x.select(F.concat(F.lit("/kw/"), F.regexp_replace("keyword_group", " ", "-")).alias("url"),
                      "impressions", "clicks")
    url_a = F.when(F.col("content_id") % 3 == 0, F.concat(F.lit("/other/"), (F.col("content_id") % 7).cast("string"))) \
        .otherwise(F.concat(F.lit("/kw/"), F.regexp_replace("keyword_group", " ", "-")))
    analytics = x.filter(X.is_true("ga4_available")).select(url_a.alias("url"), "sessions", "engaged_sessions")
    return search, analytics


@register("join_on_url", fx.with_sql("fx_daily", "fx_content") + """
, x AS (SELECT d.*, c.keyword_group FROM fx_daily d JOIN fx_content c ON d.content_id = c.content_id),
s AS (SELECT '/kw/' || replace(keyword_group, ' ', '-') AS url, CAST(SUM(impressions) AS BIGINT) AS search_impressions,
             CAST(SUM(clicks) AS BIGINT) AS search_clicks FROM x GROUP BY 1),
a AS (SELECT CASE WHEN content_id % 3 = 0 THEN '/other/' || CAST(content_id % 7 AS VARCHAR)
                  ELSE '/kw/' || replace(keyword_group, ' ', '-') END AS url,
             CAST(SUM(sessions) AS BIGINT) AS sessions, CAST(SUM(engaged_sessions) AS BIGINT) AS engaged_sessions
      FROM x WHERE ga4_available IS TRUE GROUP BY 1)
SELECT COALESCE(s.url, a.url) AS url, search_impressions, search_clicks, sessions, engaged_sessions,
  CASE WHEN search_impressions IS NOT NULL AND sessions IS NOT NULL THEN 'both'
       WHEN sessions IS NULL THEN 'search_only' ELSE 'analytics_only' END AS match
FROM s FULL JOIN a ON s.url = a.url""")
def join_on_url(spark, sf_dir):
    """Search and analytics sides grouped to URL, full outer join with a match flag."""
    s, a = _url_frames(spark, sf_dir)
    return J.join_on_url(s, a)


@register("sibling_shift", fx.with_sql("fx_daily", "fx_content") + f"""
, b AS (SELECT MAX(report_date) AS end_d FROM fx_daily),
tw AS (SELECT client_id, content_id,
    CAST(SUM(CASE WHEN report_date > b.end_d - 365 THEN impressions ELSE 0 END) AS BIGINT) AS imp_last,
    CAST(SUM(CASE WHEN report_date <= b.end_d - 365 THEN impressions ELSE 0 END) AS BIGINT) AS imp_prev
  FROM fx_daily, b WHERE report_date > b.end_d - 730 GROUP BY 1, 2),
w AS (SELECT tw.*, c.keyword_group FROM tw JOIN fx_content c ON tw.content_id = c.content_id)
SELECT client_id, content_id, keyword_group, imp_last, imp_prev,
  CAST(SUM(imp_last - imp_prev) OVER (PARTITION BY client_id, keyword_group) - (imp_last - imp_prev) AS BIGINT) AS sibling_gain,
  COUNT(*) OVER (PARTITION BY client_id, keyword_group) - 1 AS siblings FROM w""")
def sibling_shift(spark, sf_dir):
    """J07 (rule ours): what the other pages of the same (client, keyword group) gained."""
    tw = W.two_window(fx.fx_daily(spark, sf_dir), ["client_id", "content_id"], end=fx.fx_last_day(spark, sf_dir), window=730, split=365, avgs={},
                      min_prev=None)
    w = tw.join(fx.fx_content(spark, sf_dir).select("content_id", "keyword_group"), "content_id")
    s = J.sibling_shift(w)
    return s.select("client_id", "content_id", "keyword_group", "imp_last", "imp_prev", "sibling_gain", "siblings")


# ---------------------------------------------------------------- C05, C26-C28
@register("missing_flags", fx.with_sql("fx_content") + """
SELECT content_id, CAST(word_count IS NOT NULL AS INTEGER) AS has_word_count,
       CAST(search_volume IS NOT NULL AS INTEGER) AS has_search_volume,
       CAST(main_intent IS NOT NULL AS INTEGER) AS has_main_intent FROM fx_content""")
def missing_flags(spark, sf_dir):
    """has_<col> flags keep the blank signal before filling."""
    c = fx.fx_content(spark, sf_dir).select("content_id", "word_count", "search_volume", "main_intent")
    return C.missing_flags(c, ["word_count", "search_volume", "main_intent"]).drop(
        "word_count", "search_volume", "main_intent")


@register("flatten_events", fx.with_sql("fx_events") + """
SELECT event_id, content_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM fx_events""")
def flatten_events(spark, sf_dir):
    """Nested event JSON flattened to columns; one event stays one row."""
    from panelrank.operators.text import flatten_json
    e = fx.fx_events(spark, sf_dir)
    return flatten_json(e, "props", "k int").select("event_id", "content_id", "event_type", "k")


# payloads of mixed shape: the kind of k differs between rows, some have nested parts or a list, some are no JSON
MIXED_SQL = fx.with_sql("fx_events") + """
, mx AS (SELECT event_id, CASE event_id % 5
    WHEN 0 THEN props
    WHEN 1 THEN '{"k": "' || event_type || '", "page": {"id": ' || content_id || ', "tags": ["a", ' || event_id || ']}}'
    WHEN 2 THEN '{"page": {"id": null, "ok": true}, "value": ' || CAST(event_id AS VARCHAR) || '.5}'
    WHEN 3 THEN '[' || event_id || ']'
    ELSE 'no json ' || event_id END AS payload FROM fx_events)"""


def _mixed_payloads(spark, sf_dir):
    e = fx.fx_events(spark, sf_dir)
    i = F.col("event_id").cast("string")
    kinds = [F.col("props"), F.concat(F.lit('{"k": "'), "event_type", F.lit('", "page": {"id": '), F.col("content_id").cast("string"), F.lit(', "tags": ["a", '), i, F.lit("]}}")),
             F.concat(F.lit('{"page": {"id": null, "ok": true}, "value": '), i, F.lit(".5}")), F.concat(F.lit("["), i, F.lit("]"))]
    text = F.concat(F.lit("no json "), i)
    for n, k in reversed(list(enumerate(kinds))):
        text = F.when(F.col("event_id") % 5 == n, k).otherwise(text)
    return e.select("event_id", text.alias("payload"))


@register("flatten_mixed_events", MIXED_SQL + """
, j AS (SELECT event_id, CASE WHEN event_id % 5 < 3 THEN CAST(payload AS JSON) END AS v FROM mx)
SELECT event_id, v->>'$.k' AS k, CAST(v->>'$.page.id' AS BIGINT) AS page_id, CAST(v->>'$.page.ok' AS BOOLEAN) AS page_ok,
  CAST(v->'$.page.tags' AS VARCHAR) AS page_tags, CAST(v->>'$.value' AS DOUBLE) AS value FROM j""")
def flatten_mixed_events(spark, sf_dir):
    """C26 without a schema: payloads of mixed shape as variants, their schema merged over all rows, leaves as columns."""
    from panelrank.operators.text import flatten_variant
    f = flatten_variant(_mixed_payloads(spark, sf_dir), "payload")
    return f.select("event_id", "k", "page_id", "page_ok", "page_tags", F.col("value").cast("double").alias("value"))


INTENT_SQL = "CASE WHEN query_text IS NULL OR trim(query_text) = '' THEN 'anonymized_privacy' " + " ".join(
    f"WHEN regexp_matches(lower(query_text), '{pattern}') THEN '{label}'" for label, pattern in INTENT_RULES) + " ELSE 'Other' END"


@register("query_intents", fx.with_sql("fx_query_all") + f"""
SELECT {INTENT_SQL} AS intent, COUNT(*) AS queries, CAST(SUM(impressions_90d) AS BIGINT) AS impressions
FROM fx_query_all GROUP BY 1""")
def query_intents(spark, sf_dir):
    """C27 + C28: blank query -> anonymized_privacy (kept), intent bucket by ordered regex rules (ours)."""
    from panelrank.operators.text import intent_bucket
    q = intent_bucket(fx.fx_query_all(spark, sf_dir), "query_text")
    return q.groupBy("intent").agg(F.count(F.lit(1)).alias("queries"), F.sum("impressions_90d").cast("long").alias("impressions"))


# phrases that put a query into each bucket
PHRASES = ["{} vs soap", "alternatives to {}", "is {} safe", "how to use {}", "buy {}", "{}", "{} prices", "replacement for {}"]


@register("intent_branches", fx.with_sql("fx_query_all") + f"""
, t AS (SELECT replace({PHRASES}[1 + query_id % 8], '{{}}', query_text) AS query_text, impressions_90d FROM fx_query_all)
SELECT {INTENT_SQL} AS intent, COUNT(*) AS queries, CAST(SUM(impressions_90d) AS BIGINT) AS impressions FROM t GROUP BY 1""")
def intent_branches(spark, sf_dir):
    """C28 on queries with telling words: every bucket of the ordered rules."""
    from panelrank.operators.text import intent_bucket
    phrase = F.get(F.array(*[F.lit(p) for p in PHRASES]), (F.col("query_id") % 8).cast("int"))
    q = fx.fx_query_all(spark, sf_dir).withColumn("query_text", F.replace(phrase, F.lit("{}"), F.col("query_text")))
    return intent_bucket(q, "query_text").groupBy("intent").agg(F.count(F.lit(1)).alias("queries"), F.sum("impressions_90d").cast("long").alias("impressions"))


# ---------------------------------------------------------------- Q12, Q13, Q16, Q18, Q19
@register("stale_visible_rule", Q.chain(upto="features") + """
SELECT content_id, CAST(days_since_last_update >= 180 AS INTEGER) * CAST(impressions_90d >= 500 AS INTEGER) * impressions_90d AS stale_score
FROM fx_features""")
def stale_visible_rule(spark, sf_dir):
    """Q12: stale x visible x impressions hand rule."""
    return S.stale_visible_rule(batch.features(spark, sf_dir, materialize=False)).select("content_id", "stale_score")


@register("slipping_visible", Q.chain(upto="features") + """
SELECT content_id, client_id, score, 'Refresh Content' AS action_label, 'slipping_but_visible' AS reason_code FROM (
  SELECT *, CAST(avg_position > 10 AS INTEGER) * CAST(impressions_prev_30d >= 500 AS INTEGER) * impressions_prev_30d AS score
  FROM fx_features) WHERE score > 0""")
def slipping_visible(spark, sf_dir):
    """Q13: slipping x visible rule, positive scores only."""
    s = S.slipping_visible(batch.features(spark, sf_dir, materialize=False))
    return s.select("content_id", "client_id", "score", "action_label", "reason_code")


SWEEP = [0.0, 2.0, 4.0, 6.0, 8.0, 10.0, 12.0]


def _sweep_sql():
    from panelrank.plans.q_metrics import SCORED_SQL
    vals = ", ".join(f"({c})" for c in SWEEP)
    return SCORED_SQL + f"""
, cuts AS (SELECT CAST(c AS DOUBLE) AS cutoff FROM (VALUES {vals}) t(c)),
g AS (SELECT cutoff, COUNT(*) AS captured, CAST(SUM(label) AS BIGINT) AS tp FROM fx_scored JOIN cuts ON score >= cutoff GROUP BY 1),
p AS (SELECT SUM(label) AS P FROM fx_scored)
SELECT cuts.cutoff, COALESCE(captured, 0) AS captured, COALESCE(tp, 0) AS tp,
  COALESCE(CAST(tp AS DOUBLE) / NULLIF(CAST(captured AS DOUBLE), 0), 0.0) AS precision,
  COALESCE(CAST(COALESCE(tp, 0) AS DOUBLE) / NULLIF(CAST(P AS DOUBLE), 0), 0.0) AS recall
FROM cuts LEFT JOIN g ON cuts.cutoff = g.cutoff, p"""


@register("threshold_sweep", _sweep_sql())
def threshold_sweep(spark, sf_dir):
    """Q16: captured rows, precision and recall per cutoff."""
    from panelrank.plans.q_metrics import scored
    return S.threshold_sweep(scored(spark, sf_dir), "score", "label", SWEEP)


@register("ctr_gap", Q.chain(upto="features") + """
, base AS (SELECT * FROM fx_features WHERE impressions_90d >= 100),
t AS (SELECT position_tier, COUNT(*) AS tier_pages, SUM(clicks_90d) * 100.0 / SUM(impressions_90d) AS expected_ctr FROM base GROUP BY 1)
SELECT content_id, position_tier, tier_pages, round(expected_ctr, 9) AS expected_ctr,
  round(clicks_90d * 100.0 / impressions_90d, 9) AS actual_ctr,
  round(expected_ctr - clicks_90d * 100.0 / impressions_90d, 9) AS ctr_gap,
  CASE WHEN expected_ctr - clicks_90d * 100.0 / impressions_90d > 0 THEN 'below_tier_ctr' ELSE 'at_or_above_tier_ctr' END AS gap_reason
FROM base JOIN t USING (position_tier)""")
def ctr_gap(spark, sf_dir):
    """Q18: expected CTR per position tier (weighted, floor 100) and the gap per page."""
    g = S.ctr_gap(batch.features(spark, sf_dir))
    return g.select("content_id", "position_tier", "tier_pages", r9("expected_ctr"), r9("actual_ctr"), r9("ctr_gap"),
                    "gap_reason")


@register("segment_opportunity", Q.chain(upto="features") + f"""
SELECT content_type, main_intent, COUNT(*) AS pages, COUNT(*) FILTER (WHERE ai_sessions_90d > 0) AS pages_with_signal,
  CAST(SUM(ai_sessions_90d) AS BIGINT) AS signal_total,
  round(COALESCE(SUM(ai_sessions_90d) / NULLIF(SUM(sessions_90d), 0), 0.0), {R9}) AS signal_rate, COUNT(*) >= 50 AS above_floor
FROM fx_features GROUP BY 1, 2""")
def segment_opportunity(spark, sf_dir):
    """Q19: sparse AI-referral segments with n and a floor (EDA ranking only)."""
    s = S.segment_opportunity(batch.features(spark, sf_dir, materialize=False), ["content_type", "main_intent"])
    return s.select("content_type", "main_intent", "pages", "pages_with_signal", "signal_total", r9("signal_rate"),
                    "above_floor")


@register("distinct_intents", fx.with_sql("fx_content") + "SELECT DISTINCT main_intent FROM fx_content")
def distinct_intents(spark, sf_dir):
    """Distinct values."""
    return J.distinct_values(fx.fx_content(spark, sf_dir), "main_intent")


# ---------------------------------------------------------------- W07, W08
CUTS = [_dt.date(1999, 1, 1), _dt.date(2000, 1, 1)]


@register("label_panel", fx.with_sql("fx_daily") + """
, cuts AS (SELECT * FROM (VALUES (DATE '1999-01-01'), (DATE '2000-01-01')) t(cut_date))
SELECT cut_date, content_id,
  CAST(SUM(CASE WHEN report_date <= cut_date THEN impressions ELSE 0 END) AS BIGINT) AS feature_total,
  CAST(SUM(CASE WHEN report_date > cut_date THEN impressions ELSE 0 END) AS BIGINT) AS label_total,
  CAST(SUM(CASE WHEN report_date > cut_date THEN impressions ELSE 0 END) <
       0.8 * SUM(CASE WHEN report_date <= cut_date THEN impressions ELSE 0 END) AS INTEGER) AS label
FROM fx_daily JOIN cuts ON report_date > cut_date - 365 AND report_date <= cut_date + 180
GROUP BY 1, 2""")
def label_panel(spark, sf_dir):
    """Features (t-365, t], label (t, t+180], for two cut dates."""
    return W.label_panel(fx.fx_daily(spark, sf_dir), CUTS, feature_days=365, label_days=180)


@register("persistence", fx.with_sql("fx_events_daily") + """
, b AS (SELECT MAX(report_date) AS end_d FROM fx_events_daily),
wk AS (SELECT content_id, 3 - CAST(floor(datediff('day', report_date, b.end_d) / 7) AS INTEGER) AS week,
              CAST(SUM(impressions) AS BIGINT) AS total
       FROM fx_events_daily, b WHERE report_date > b.end_d - 28 AND report_date <= b.end_d GROUP BY 1, 2),
l AS (SELECT *, CAST(total < 0.8 * lag(total) OVER (PARTITION BY content_id ORDER BY week) AS INTEGER) AS dropped FROM wk),
g AS (SELECT content_id, MAX(CASE WHEN dropped = 0 THEN week END) AS last_ok, MAX(week) AS last_week,
             COUNT(*) FILTER (WHERE dropped = 1) AS dropped_weeks FROM l GROUP BY 1)
SELECT content_id, dropped_weeks, CAST(last_week - COALESCE(last_ok, 0) AS INTEGER) AS trailing_run,
       last_week - COALESCE(last_ok, 0) >= 2 AS persistent_drop FROM g""")
def persistence(spark, sf_dir):
    """W07 (rule ours): week-over-week drops and the trailing run length per page (events panel)."""
    return W.persistence(fx.fx_events_daily(spark, sf_dir), weeks=4)


# ---------------------------------------------------------------- X01 streaming
@register("stream_daily_rollup", """
SELECT CAST(ts AS DATE) AS report_date, user_id, COUNT(*) AS events, SUM(value) AS value_sum
FROM events GROUP BY 1, 2""".replace("SUM(value) AS value_sum", "round(SUM(value), 9) AS value_sum"))
def stream_daily_rollup(spark, sf_dir):
    """Events rolled up per (day, user) by Structured Streaming with a 3-day watermark."""
    from panelrank.streaming.rollup import stream_daily_rollup as run
    r = run(spark, sf_dir, "events.parquet",
            "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
            "ts", ["user_id"], {"value_sum": "value"})
    return r.select("report_date", "user_id", "events", F.round("value_sum", 9).alias("value_sum"))


# ---------------------------------------------------------------- Q17
@register("decline_lookalike", fx.with_sql("fx_daily", "fx_content") + """
, b AS (SELECT MAX(report_date) AS end_d FROM fx_daily),
tw AS (SELECT client_id, content_id,
    CAST(SUM(CASE WHEN report_date > b.end_d - 365 THEN impressions ELSE 0 END) AS BIGINT) AS imp_last,
    CAST(SUM(CASE WHEN report_date <= b.end_d - 365 THEN impressions ELSE 0 END) AS BIGINT) AS imp_prev,
    CAST(SUM(CASE WHEN report_date > b.end_d - 365 THEN clicks ELSE 0 END) AS BIGINT) AS clk_last,
    CAST(SUM(CASE WHEN report_date <= b.end_d - 365 THEN clicks ELSE 0 END) AS BIGINT) AS clk_prev
  FROM fx_daily, b WHERE report_date > b.end_d - 730 GROUP BY 1, 2),
w AS (SELECT tw.*, c.keyword_group FROM tw JOIN fx_content c ON tw.content_id = c.content_id),
s AS (SELECT *, SUM(imp_last - imp_prev) OVER (PARTITION BY client_id, keyword_group) - (imp_last - imp_prev) AS sibling_gain FROM w),
ct AS (SELECT client_id, CAST(SUM(imp_last) AS DOUBLE) / NULLIF(CAST(SUM(imp_prev) AS DOUBLE), 0) AS client_ratio FROM tw GROUP BY 1)
SELECT content_id, CASE WHEN imp_prev < 100 THEN 'noise'
  WHEN imp_prev - imp_last > 0 AND COALESCE(sibling_gain, 0) >= imp_prev - imp_last THEN 'consolidation'
  WHEN CAST(imp_last AS DOUBLE) / NULLIF(CAST(imp_prev AS DOUBLE), 0) < 0.8 AND client_ratio < 0.8 THEN 'seasonality'
  WHEN CAST(imp_last AS DOUBLE) / NULLIF(CAST(imp_prev AS DOUBLE), 0) >= 0.8 AND clk_last < 0.8 * clk_prev THEN 'click_loss'
  WHEN CAST(imp_last AS DOUBLE) / NULLIF(CAST(imp_prev AS DOUBLE), 0) < 0.8 THEN 'real_decline'
  ELSE 'no_decline' END AS decline_type
FROM s JOIN ct USING (client_id)""")
def decline_lookalike(spark, sf_dir):
    """Q17 (rule ours): noise / consolidation / seasonality / click_loss / real_decline per page."""
    d = fx.fx_daily(spark, sf_dir)
    tw = W.two_window(d, ["client_id", "content_id"], window=730, split=365, avgs={}, min_prev=None)
    w = tw.join(fx.fx_content(spark, sf_dir).select("content_id", "keyword_group"), "content_id")
    sib = J.sibling_shift(w)
    ct = tw.groupBy("client_id").agg(X.ratio(F.sum("imp_last"), F.sum("imp_prev")).alias("client_ratio"))
    return S.lookalike(tw, sib, ct).select("content_id", "decline_type")


@register("clients_by_start", fx.with_sql("fx_clients") + """
SELECT client_id, start_date, row_number() OVER (ORDER BY start_date ASC NULLS LAST, client_id) AS start_order
FROM fx_clients""")
def clients_by_start(spark, sf_dir):
    """Clients ordered by start date with unknown starts last (position as a column)."""
    from panelrank.operators import ordered as O
    c = fx.fx_clients(spark, sf_dir)
    return O.row_rank(c, [("start_date", False)], "client_id", "start_order").select("client_id", "start_date",
                                                                                      "start_order")


@register("tier_signal_table", Q.chain(upto="features") + """
SELECT freshness_tier, round_even(AVG(CAST(is_declining_label AS DOUBLE)), 3) AS decline_rate, COUNT(*) AS pages
FROM fx_features GROUP BY 1""")
def tier_signal_table(spark, sf_dir):
    """A05 first-look table: decline rate per freshness tier rounded half-even (bround) with counts."""
    f = batch.features(spark, sf_dir)
    return f.groupBy("freshness_tier").agg(F.bround(F.avg(F.col("is_declining_label").cast("double")), 3)
                                           .alias("decline_rate"), F.count(F.lit(1)).alias("pages"))


# ---------------------------------------------------------------- inputs on which every branch of a rule occurs
# Texts that do and don't mean true
BOOLEAN_TEXTS = ["TRUE", "1", "Yes", "y", "no", "0", "", " true"]


@register("boolean_texts", fx.with_sql("fx_content") + f"""
, b AS (SELECT content_id, CASE WHEN content_id % 9 < 8 THEN {BOOLEAN_TEXTS}[1 + content_id % 9] END AS raw FROM fx_content)
SELECT content_id, COALESCE(lower(raw) IN ('true', '1', 'yes', 'y'), FALSE) AS has_flag, FALSE AS absent_flag FROM b""")
def boolean_texts(spark, sf_dir):
    """Boolean columns from text in every spelling, blanks and an absent column."""
    k = F.col("content_id") % 9
    raw = fx.fx_content(spark, sf_dir).select("content_id", F.get(F.array(*[F.lit(t) for t in BOOLEAN_TEXTS]), k.cast("int")).alias("has_flag"))
    return C.clean_snapshot(raw, numeric=[], boolean=["has_flag", "absent_flag"], categorical=[])


@register("tier_branches", fx.with_sql("fx_content") + """
, v AS (SELECT CASE WHEN content_id % 11 <> 0 THEN days_since_last_update END AS days,
               CASE WHEN content_id % 5 = 0 THEN 0 ELSE content_age_days END AS prev, CASE WHEN content_id % 10 = 0 THEN 0 ELSE (content_id * 31) % 900 END AS last FROM fx_content),
t AS (SELECT CASE WHEN days IS NULL THEN 'never' WHEN days <= 30 THEN '0-30' WHEN days <= 90 THEN '31-90' WHEN days <= 180 THEN '91-180' ELSE '181+' END AS freshness_tier,
             CASE WHEN prev = 0 AND last > 0 THEN 'new' WHEN prev = 0 THEN 'flat' WHEN last > 1.2 * prev THEN 'up' WHEN last < 0.8 * prev THEN 'down' ELSE 'stable' END AS trend_direction FROM v)
SELECT freshness_tier, trend_direction, COUNT(*) AS pages FROM t GROUP BY ALL""")
def tier_branches(spark, sf_dir):
    """C15 + C17 on pages without an update and without impressions: all five trends and all five freshness tiers."""
    k = F.col("content_id")
    v = fx.fx_content(spark, sf_dir).select(F.when(k % 11 != 0, F.col("days_since_last_update")).alias("days"), F.when(k % 5 == 0, 0).otherwise(F.col("content_age_days")).alias("prev"),
                                            F.when(k % 10 == 0, 0).otherwise((k * 31) % 900).alias("last"))
    return v.groupBy(X.freshness_tier("days").alias("freshness_tier"), X.trend_direction("last", "prev").alias("trend_direction")).agg(F.count(F.lit(1)).alias("pages"))


@register("url_match_kinds", fx.with_sql("fx_daily") + """
, s AS (SELECT '/page/' || content_id AS url, CAST(SUM(impressions) AS BIGINT) AS imp FROM fx_daily WHERE content_id % 4 <> 1 GROUP BY 1),
a AS (SELECT '/page/' || content_id AS url, CAST(SUM(sessions) AS BIGINT) AS ses FROM fx_daily WHERE content_id % 4 <> 2 GROUP BY 1)
SELECT CASE WHEN s.url IS NOT NULL AND a.url IS NOT NULL THEN 'both' WHEN a.url IS NULL THEN 'search_only' ELSE 'analytics_only' END AS match,
  COUNT(*) AS urls, CAST(SUM(imp) AS BIGINT) AS impressions, CAST(SUM(ses) AS BIGINT) AS sessions FROM s FULL JOIN a ON s.url = a.url GROUP BY 1""")
def url_match_kinds(spark, sf_dir):
    """Pages seen by both sides, by search only and by analytics only."""
    d = fx.fx_daily(spark, sf_dir).withColumn("url", F.concat(F.lit("/page/"), F.col("content_id").cast("string")))
    j = J.join_on_url(d.filter("content_id % 4 <> 1"), d.filter("content_id % 4 <> 2"))
    return j.groupBy("match").agg(F.count(F.lit(1)).alias("urls"), F.sum("search_impressions").alias("impressions"), F.sum("sessions").alias("sessions"))


# every third client loses two thirds of its impressions in the last year
SLUMP_SQL = fx.with_sql("fx_daily", "fx_content") + """
, b AS (SELECT MAX(report_date) AS end_d FROM fx_daily),
tw AS (SELECT client_id, content_id,
    CAST(SUM(CASE WHEN report_date > b.end_d - 365 THEN impressions ELSE 0 END) // CASE WHEN CAST(substring(client_id, 7, 10) AS INTEGER) % 3 = 0 THEN 3 ELSE 1 END AS BIGINT) AS imp_last,
    CAST(SUM(CASE WHEN report_date <= b.end_d - 365 THEN impressions ELSE 0 END) AS BIGINT) AS imp_prev,
    CAST(SUM(CASE WHEN report_date > b.end_d - 365 THEN clicks ELSE 0 END) AS BIGINT) AS clk_last,
    CAST(SUM(CASE WHEN report_date <= b.end_d - 365 THEN clicks ELSE 0 END) AS BIGINT) AS clk_prev
  FROM fx_daily, b WHERE report_date > b.end_d - 730 GROUP BY 1, 2),
sb AS (SELECT t.*, SUM(imp_last - imp_prev) OVER (PARTITION BY t.client_id, keyword_group) - (imp_last - imp_prev) AS gain, CAST(imp_last AS DOUBLE) / NULLIF(imp_prev, 0) AS ratio,
         CAST(SUM(imp_last) OVER (PARTITION BY t.client_id) AS DOUBLE) / NULLIF(SUM(imp_prev) OVER (PARTITION BY t.client_id), 0) AS client_ratio
       FROM tw t JOIN fx_content c ON t.content_id = c.content_id)
SELECT CASE WHEN imp_prev < 100 THEN 'noise' WHEN imp_prev > imp_last AND gain >= imp_prev - imp_last THEN 'consolidation' WHEN ratio < 0.8 AND client_ratio < 0.8 THEN 'seasonality'
    WHEN ratio >= 0.8 AND clk_last < 0.8 * clk_prev THEN 'click_loss' WHEN ratio < 0.8 THEN 'real_decline' ELSE 'no_decline' END AS decline_type, COUNT(*) AS pages
FROM sb GROUP BY 1"""


@register("lookalike_branches", SLUMP_SQL)
def lookalike_branches(spark, sf_dir):
    """Q17 where some clients lose impressions throughout: every class of the rule, seasonality too."""
    tw = W.two_window(fx.fx_daily(spark, sf_dir), ["client_id", "content_id"], end=fx.fx_last_day(spark, sf_dir), window=730, split=365, avgs={}, min_prev=None)
    tw = tw.withColumn("imp_last", F.expr("imp_last div if(int(substring(client_id, 7, 10)) % 3 = 0, 3, 1)"))
    sib = J.sibling_shift(tw.join(fx.fx_content(spark, sf_dir).select("content_id", "keyword_group"), "content_id"))
    ct = tw.groupBy("client_id").agg(X.ratio(F.sum("imp_last"), F.sum("imp_prev")).alias("client_ratio"))
    return S.lookalike(tw, sib, ct).groupBy("decline_type").agg(F.count(F.lit(1)).alias("pages"))
