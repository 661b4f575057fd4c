"""DuckDB text shared by the oracle queries (snapshot, cleaning, baseline).

Written by hand from the rules in ``constants``; the Spark side builds the
same results with DataFrame expressions.
"""

from __future__ import annotations

from panelrank import constants as K
from panelrank.sources import fixtures as fx

FX_WINDOW, FX_SPLIT = 730, 365


def rr(num: str, den: str, scale: int, times: int = 1) -> str:
    """Exact half-away-from-zero round of an integer ratio (see exprs.round_ratio)."""
    p = 10 ** scale
    n = f"(CAST({num} AS BIGINT) * {times * p})"
    d = f"CAST({den} AS BIGINT)"
    q = f"(sign({n}) * sign({d}) * ((abs({n}) * 2 + abs({d})) // (abs({d}) * 2)))"
    return f"(CASE WHEN {d} = 0 THEN NULL ELSE CAST({q} AS DOUBLE) / CAST({p} AS DOUBLE) END)"


def tiers_sql() -> str:
    return """
      CASE WHEN content_age_days IS NULL THEN NULL WHEN content_age_days <= 14 THEN '0-14'
           WHEN content_age_days <= 30 THEN '15-30' WHEN content_age_days <= 90 THEN '31-90'
           WHEN content_age_days <= 180 THEN '91-180' WHEN content_age_days <= 365 THEN '181-365' ELSE '365+' END AS age_tier,
      CAST(CASE WHEN content_age_days IS NULL THEN NULL WHEN content_age_days <= 14 THEN 1
           WHEN content_age_days <= 30 THEN 2 WHEN content_age_days <= 90 THEN 3
           WHEN content_age_days <= 180 THEN 4 WHEN content_age_days <= 365 THEN 5 ELSE 6 END AS INTEGER) AS age_tier_order,
      CASE WHEN days_since_last_update IS NULL THEN 'never' WHEN days_since_last_update <= 30 THEN '0-30'
           WHEN days_since_last_update <= 90 THEN '31-90' WHEN days_since_last_update <= 180 THEN '91-180'
           ELSE '181+' END AS freshness_tier,
      CASE WHEN word_count IS NULL THEN NULL WHEN word_count < 1000 THEN '<1000' WHEN word_count < 2000 THEN '1000-2000'
           WHEN word_count < 3500 THEN '2000-3500' ELSE '3500+' END AS word_count_tier,
      CASE WHEN char_count IS NULL THEN NULL WHEN char_count < 8000 THEN '<8000' WHEN char_count < 15000 THEN '8000-15000'
           WHEN char_count < 25000 THEN '15000-25000' ELSE '25000+' END AS char_count_tier,
      CASE WHEN impressions_90d IS NULL THEN 'no_data' WHEN impressions_90d <= 0 THEN 'none'
           WHEN impressions_90d >= 30000 THEN 'excellent' WHEN impressions_90d >= 3000 THEN 'good'
           WHEN impressions_90d >= 300 THEN 'moderate' ELSE 'low' END AS impression_tier"""


def snapshot_cte(window: int = FX_WINDOW, split: int = FX_SPLIT, daily: str = "fx_daily") -> str:
    """``fx_snapshot``: content left join the grouped daily pass, with rates and tiers."""
    last = f"report_date > b.end_d - {split}"
    prev = f"report_date > b.end_d - {2 * split} AND report_date <= b.end_d - {split}"

    def s(c, cond=None):
        inner = c if cond is None else f"CASE WHEN {cond} THEN {c} ELSE 0 END"
        return f"CAST(SUM({inner}) AS BIGINT)"

    return f"""
    snap_bounds AS (SELECT MAX(report_date) AS end_d FROM {daily}),
    snap_g AS (
      SELECT content_id,
        {s('impressions')} AS impressions_90d, {s('clicks')} AS clicks_90d, {s('pageviews')} AS pageviews_90d,
        {s('sessions')} AS sessions_90d, {s('engaged_sessions')} AS engaged_sessions_90d,
        {s('ai_sessions')} AS ai_sessions_90d, {s('scroll_events')} AS scroll_events_90d,
        {s('pos_milli_sum')} AS pos_milli,
        COUNT(*) FILTER (WHERE impressions >= 1) AS days_with_impressions,
        COUNT(*) FILTER (WHERE sessions >= 1) AS days_with_sessions,
        {s('impressions', last)} AS impressions_last_30d, {s('clicks', last)} AS clicks_last_30d,
        {s('sessions', last)} AS sessions_last_30d,
        {s('impressions', prev)} AS impressions_prev_30d, {s('clicks', prev)} AS clicks_prev_30d,
        {s('sessions', prev)} AS sessions_prev_30d
      FROM {daily}, snap_bounds b
      WHERE report_date > b.end_d - {window} AND report_date <= b.end_d
      GROUP BY content_id),
    snap_r AS (
      SELECT * EXCLUDE (pos_milli),
        {rr('clicks_90d', 'impressions_90d', 2, 100)} AS ctr,
        COALESCE({rr('pos_milli', 'sessions_90d * 1000', 1)}, 0.0) AS avg_position,
        {rr('engaged_sessions_90d', 'sessions_90d', 2, 100)} AS engagement_rate,
        {rr('scroll_events_90d', 'pageviews_90d', 2, 100)} AS scroll_rate,
        {rr('ai_sessions_90d', 'sessions_90d', 2, 100)} AS ai_traffic_pct,
        {rr('impressions_last_30d - impressions_prev_30d', 'impressions_prev_30d', 1, 100)} AS trend_pct,
        CASE WHEN impressions_prev_30d = 0 AND impressions_last_30d > 0 THEN 'new'
             WHEN impressions_prev_30d = 0 AND impressions_last_30d = 0 THEN 'flat'
             WHEN impressions_last_30d > 1.2 * impressions_prev_30d THEN 'up'
             WHEN impressions_last_30d < 0.8 * impressions_prev_30d THEN 'down'
             ELSE 'stable' END AS trend_direction,
        CASE WHEN sessions_90d IS NULL OR sessions_90d <= 0 OR pos_milli IS NULL OR pos_milli <= 0 THEN 'no_data'
             WHEN pos_milli <= 3 * sessions_90d * 1000 THEN 'top_3' WHEN pos_milli <= 10 * sessions_90d * 1000 THEN 'page_1'
             WHEN pos_milli <= 20 * sessions_90d * 1000 THEN 'striking' WHEN pos_milli <= 50 * sessions_90d * 1000 THEN 'page_3_5'
             ELSE 'deep' END AS position_tier
      FROM snap_g),
    fx_snapshot AS (
      SELECT * REPLACE (COALESCE(position_tier, 'no_data') AS position_tier), {tiers_sql()}
      FROM (SELECT c.*, r.* EXCLUDE (content_id) FROM fx_content c LEFT JOIN snap_r r ON c.content_id = r.content_id))"""


def _num(c: str, present: set[str]) -> str:
    if c in present:
        return f"CAST(COALESCE(CASE WHEN isnan(CAST({c} AS DOUBLE)) OR isinf(CAST({c} AS DOUBLE)) THEN NULL " \
               f"ELSE CAST({c} AS DOUBLE) END, 0.0) AS DOUBLE) AS {c}"
    return f"CAST(0.0 AS DOUBLE) AS {c}"


def _cat(c: str, present: set[str]) -> str:
    if c in present:
        return f"CASE WHEN {c} IS NULL OR CAST({c} AS VARCHAR) IN ('', 'nan') THEN 'unknown' ELSE CAST({c} AS VARCHAR) END AS {c}"
    return f"'unknown' AS {c}"


SNAPSHOT_COLUMNS = [
    "content_id", "client_id", "keyword_group", "content_type", "word_count", "char_count", "search_volume",
    "competition", "competition_level", "cpc", "main_intent", "content_age_days", "days_since_last_update",
    "impressions_90d", "clicks_90d", "pageviews_90d", "sessions_90d", "engaged_sessions_90d", "ai_sessions_90d",
    "scroll_events_90d", "days_with_impressions", "days_with_sessions", "impressions_last_30d",
    "clicks_last_30d", "sessions_last_30d", "impressions_prev_30d", "clicks_prev_30d", "sessions_prev_30d",
    "ctr", "avg_position", "engagement_rate", "scroll_rate", "ai_traffic_pct", "trend_pct", "trend_direction",
    "age_tier", "age_tier_order", "freshness_tier", "word_count_tier", "char_count_tier", "impression_tier",
    "position_tier",
]


def clean_cte() -> str:
    present = set(SNAPSHOT_COLUMNS)
    cols = []
    for c in SNAPSHOT_COLUMNS:
        if c in K.NUMERIC_COLUMNS:
            cols.append(_num(c, present))
        elif c in K.CATEGORICAL_COLUMNS:
            cols.append(_cat(c, present))
        else:
            cols.append(c)
    cols += [_num(c, present) for c in K.NUMERIC_COLUMNS if c not in present]
    cols += [_cat(c, present) for c in K.CATEGORICAL_COLUMNS if c not in present]
    return "fx_clean AS (SELECT " + ",\n      ".join(cols) + " FROM fx_snapshot)"


FEATURES_CTE = """
    fx_features AS (
      SELECT *,
        CAST(lower(trend_direction) = 'down' AS INTEGER) AS is_declining_label,
        ln(1 + impressions_90d) AS log_impressions_90d, ln(1 + clicks_90d) AS log_clicks_90d,
        ln(1 + sessions_90d) AS log_sessions_90d, ln(1 + ai_sessions_90d) AS log_ai_sessions_90d,
        CAST(clicks_90d > 0 AS INTEGER) AS has_clicks, CAST(ai_sessions_90d > 0 AS INTEGER) AS has_ai_sessions,
        CAST(impressions_90d >= 100 AND sessions_90d > 0 AS INTEGER) AS measurable_opportunity
      FROM fx_clean WHERE impressions_90d > 0 AND content_age_days >= 90)"""


def pct_rank_sql(value: str, out: str) -> str:
    """Average rank of ties / N over all rows, NULL -> 0."""
    v = f"COALESCE(CAST({value} AS DOUBLE), 0.0)"
    return (f"(CAST(rank() OVER (ORDER BY {v}) - 1 AS DOUBLE) + CAST(count(*) OVER (PARTITION BY {v}) + 1 AS DOUBLE) "
            f"/ CAST(2 AS DOUBLE)) / CAST(count(*) OVER () AS DOUBLE) AS {out}")


BASELINE_CTE = f"""
    bl_1 AS (
      SELECT *,
        {pct_rank_sql('ln(1 + impressions_90d)', 'visibility_score')},
        {pct_rank_sql('days_since_last_update', 'freshness_risk_score')},
        {pct_rank_sql('word_count', 'word_pct')},
        least(greatest(avg_position, 1), 50) AS pos_clip
      FROM fx_features),
    bl_2 AS (
      SELECT *, CASE WHEN max(pos_clip) OVER () > min(pos_clip) OVER ()
                     THEN (pos_clip - min(pos_clip) OVER ()) / (max(pos_clip) OVER () - min(pos_clip) OVER ())
                     ELSE 0.0 END AS pos_norm
      FROM bl_1),
    bl_3 AS (
      SELECT *,
        (1 - pos_norm) * visibility_score * CAST(CAST(avg_position > 0 AS INTEGER) AS DOUBLE) AS position_opportunity_score,
        (1 - word_pct) * visibility_score AS depth_gap_score
      FROM bl_2),
    bl_4 AS (
      SELECT *,
        least(greatest(0.4 * visibility_score + 0.3 * freshness_risk_score + 0.25 * position_opportunity_score
                       + 0.05 * depth_gap_score, 0.0), 1.0) AS baseline_refresh_score,
        concat_ws('|',
          CASE WHEN days_since_last_update >= 180 AND impressions_90d >= 500 THEN 'stale_visible_page' END,
          CASE WHEN lower(trend_direction) = 'down' AND impressions_90d >= 100 THEN 'declining_with_demand' END,
          CASE WHEN word_count > 0 AND word_count < 1200 AND impressions_90d >= 250 THEN 'thin_visible_page' END,
          CASE WHEN avg_position > 0 AND avg_position <= 10 AND content_age_days >= 180 THEN 'page_one_decay_risk' END,
          CASE WHEN impressions_90d >= 500 AND avg_position > 0 AND avg_position <= 20 AND ctr < 0.5
               THEN 'low_ctr_visible_page' END,
          CASE WHEN sessions_90d >= 30 AND ((engagement_rate > 0 AND engagement_rate < 30)
                                             OR (scroll_rate > 0 AND scroll_rate < 30))
               THEN 'low_engagement_visible_page' END) AS rc
      FROM bl_3),
    fx_baseline AS (
      SELECT *,
        CASE WHEN rc = '' THEN 'general_refresh_review' ELSE rc END AS reason_codes,
        CASE WHEN rc LIKE '%thin_visible_page%' THEN 'expand_and_refresh'
             WHEN rc LIKE '%low_ctr_visible_page%' THEN 'refresh_and_review_ctr'
             WHEN rc LIKE '%stale_visible_page%' OR rc LIKE '%declining_with_demand%' THEN 'refresh'
             ELSE 'monitor' END AS suggested_action_baseline,
        row_number() OVER (ORDER BY baseline_refresh_score DESC, content_id ASC) AS baseline_rank
      FROM bl_4)"""


def chain(*extra: str, upto: str = "baseline", daily: str = "fx_daily") -> str:
    """WITH prefix up to snapshot / clean / features / baseline, plus extra CTEs."""
    parts = [snapshot_cte(daily=daily)]
    if upto in ("clean", "features", "baseline"):
        parts.append(clean_cte())
    if upto in ("features", "baseline"):
        parts.append(FEATURES_CTE)
    if upto == "baseline":
        parts.append(BASELINE_CTE)
    return fx.with_sql(daily, "fx_content", extra=parts + list(extra))
