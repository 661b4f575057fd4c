"""Windowed panel features: two-window tables, snapshots, label panels.

A01-A04, A20-A23, C21-C24, W07, W08. Every operator is one grouped pass
over the daily fact. Date bounds are computed first as a tiny job and then
written into the scan filter as literals (D-05), so the filter reaches the
Parquet reader and, with a ``month`` column, prunes partitions.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelrank import constants as K
from panelrank.functions import exprs as X


def max_date(df: DataFrame, date_col: str = "report_date") -> _dt.date:
    """Global max date (A03) as a Python literal (D-05)."""
    v = df.agg(F.max(F.col(date_col).cast("date")).alias("m")).first()["m"]
    if v is None:
        raise ValueError("empty daily table: no max date")
    return v


def newest_day(df: DataFrame, date_col: str = "report_date", month_col: str = "month") -> _dt.date:
    """Global max date of a fact partitioned by month: the newest month is found from the folders, only its rows are read."""
    if month_col not in df.columns:
        return max_date(df, date_col)
    newest = df.agg(F.max(month_col).alias("m")).first()["m"]
    return max_date(df.filter(F.col(month_col) == newest) if newest is not None else df, date_col)


def scope_filter(df: DataFrame, date_col: str, lo_exclusive: _dt.date | None, hi_inclusive: _dt.date | None,
                 month_col: str | None = "month") -> DataFrame:
    """Literal date bounds (half-open ``(lo, hi]``) plus month partition bounds."""
    d = F.col(date_col)
    cond = F.lit(True)
    if lo_exclusive is not None:
        cond = cond & (d > F.lit(lo_exclusive))
    if hi_inclusive is not None:
        cond = cond & (d <= F.lit(hi_inclusive))
    if month_col and month_col in df.columns:
        # Spark does not derive month bounds from the date bounds: add them so
        # directories outside the window are pruned before any file is read.
        if lo_exclusive is not None:
            cond = cond & (F.col(month_col) >= F.lit((lo_exclusive + _dt.timedelta(days=1)).strftime("%Y-%m")))
        if hi_inclusive is not None:
            cond = cond & (F.col(month_col) <= F.lit(hi_inclusive.strftime("%Y-%m")))
    return df.filter(cond)


def two_window(daily: DataFrame, keys: list[str], date_col: str = "report_date", end: _dt.date | None = None,
               window: int = K.TWO_WINDOW["window"], split: int = K.TWO_WINDOW["split"],
               sums: dict | None = None, avgs: dict | None = None,
               min_prev: int | None = K.TWO_WINDOW["min_prev"], having_col: str = "imp_prev") -> DataFrame:
    """Two-window conditional sums / averages per key.

    last = ``d > end - split``; prev = ``end - window < d <= end - split``.
    Averages have no ELSE branch (NULL when a half has no rows), as in the
    reference SQL. ``HAVING having_col >= min_prev`` is a post-agg filter.
    """
    sums = sums if sums is not None else {"imp": "impressions", "clk": "clicks"}
    avgs = avgs if avgs is not None else {"pos": "position"}
    if end is None:
        end = max_date(daily, date_col)
    cut = end - _dt.timedelta(days=split)
    lo = end - _dt.timedelta(days=window)
    scoped = scope_filter(daily, date_col, lo, end)
    last = F.col(date_col) > F.lit(cut)
    aggs = []
    for name, c in sums.items():
        aggs.append(F.sum(F.when(last, F.col(c)).otherwise(0)).cast("long").alias(f"{name}_last"))
        aggs.append(F.sum(F.when(~last, F.col(c)).otherwise(0)).cast("long").alias(f"{name}_prev"))
    for name, c in avgs.items():
        aggs.append(F.avg(F.when(last, F.col(c))).alias(f"{name}_last"))
        aggs.append(F.avg(F.when(~last, F.col(c))).alias(f"{name}_prev"))
    out = scoped.groupBy(*keys).agg(*aggs)
    if min_prev is not None:
        out = out.filter(F.col(having_col) >= min_prev)
    return out


def query_mix(qfact: DataFrame, key: str = "content_id") -> DataFrame:
    """Query-mix signals per content.

    Context columns repeat per row of a content item, so they are taken with
    ``max`` (deterministic, skips NULL), never summed.
    """
    g = qfact.groupBy(key).agg(
        F.max("content_visible_query_count").cast("long").alias("visible_queries"),
        F.max("rare_impressions_share").alias("rare_share"),
        F.max("anonymized_impressions_share").alias("anon_share"),
        F.max("impressions_90d").cast("long").alias("top_query_impressions"),
        F.sum("impressions_90d").cast("long").alias("kept_impressions"),
    )
    return g.withColumn("top_query_share", X.ratio("top_query_impressions", "kept_impressions"))


def fill_after_join(df: DataFrame, fills: dict = K.QUERY_MIX_FILLS) -> DataFrame:
    """Default fills after the left join (C22); 50 for the missing position."""
    return df.na.fill({k: v for k, v in fills.items() if k in df.columns})


def window_label(df: DataFrame, last: str = "imp_last", prev: str = "imp_prev",
                 factor: float = K.TWO_WINDOW["decline_factor"], out: str = "is_declining") -> DataFrame:
    """``last < factor * prev`` as 0/1 (C24); the factor is an exact decimal."""
    return df.withColumn(out, (F.col(last) < F.lit(Decimal(str(factor))) * F.col(prev)).cast("int"))


def drop_blank(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop rows with any blank feature."""
    return df.na.drop(subset=cols)


def attach_query_mix(features: DataFrame, qmix: DataFrame, key: str = "content_id") -> DataFrame:
    """Left join of pre-aggregated sides (J01); both are one row per content."""
    return features.join(qmix, key, "left")


def decline_table(daily: DataFrame, qfact: DataFrame, window: int, split: int, min_prev: int = 100,
                  factor: float = K.TWO_WINDOW["decline_factor"], end: _dt.date | None = None) -> DataFrame:
    """The capstone feature table: A01 -> J01 with A04 -> C22 fills -> C24 label."""
    tw = two_window(daily, ["client_id", "content_id"], end=end, window=window, split=split, min_prev=min_prev)
    mix = query_mix(qfact).select("content_id", "visible_queries", "rare_share", "anon_share", "top_query_share")
    out = fill_after_join(attach_query_mix(tw, mix))
    return window_label(out, factor=factor)


# ---------------------------------------------------------------- snapshot
def build_snapshot(daily: DataFrame, content: DataFrame, end: _dt.date | None = None,
                   window: int = 90, split: int = 30, key: str = "content_id",
                   clients: DataFrame | None = None) -> DataFrame:
    """Page snapshot from the daily fact: totals, activity days, last/prev, rates, tiers.

    One grouped pass over ``(end - window, end]``; rates are exact
    half-up roundings of integer ratios (C13, C14), trend from integer
    comparisons (C15). ``content`` is left-joined so pages without traffic
    stay (with NULL activity, filled by ``clean_snapshot``). With ``clients``
    (client_id, start_date) only days on/after each client's start count.
    """
    if clients is not None:
        # per-client history guard (F05): days before a client's start are not zero activity
        from panelrank.operators.clean import after_start
        daily = after_start(daily, clients)
    if end is None:
        end = max_date(daily)
    lo = end - _dt.timedelta(days=window)
    cut = end - _dt.timedelta(days=split)
    cut2 = end - _dt.timedelta(days=2 * split)
    d = F.col("report_date")
    last = d > F.lit(cut)
    prev = (d > F.lit(cut2)) & (d <= F.lit(cut))

    cols = set(daily.columns)

    def s(c, cond=None):
        if c not in cols:  # a measure the source does not carry stays NULL (filled by clean_snapshot)
            return F.lit(None).cast("long")
        return F.sum(F.col(c) if cond is None else F.when(cond, F.col(c)).otherwise(0)).cast("long")

    # position: the exact milli-sum over sessions when the source has it (fixtures), else the
    # impression-weighted mean of the daily average position (how a search console aggregates it)
    exact_pos = "pos_milli_sum" in cols
    if not exact_pos:
        daily = daily.withColumn("_wpos", F.col("position") * F.col("impressions")) \
            .withColumn("_wimp", F.when(F.col("position") > 0, F.col("impressions")).otherwise(0))
    scoped = scope_filter(daily, "report_date", lo, end)
    pos_aggs = [s("pos_milli_sum").alias("_pos_milli")] if exact_pos else \
        [F.sum(F.when(F.col("position") > 0, F.col("_wpos"))).alias("_wpos"), F.sum("_wimp").alias("_wimp")]
    g = scoped.groupBy(key).agg(
        s("impressions").alias("impressions_90d"),
        s("clicks").alias("clicks_90d"),
        s("pageviews").alias("pageviews_90d"),
        s("sessions").alias("sessions_90d"),
        s("engaged_sessions").alias("engaged_sessions_90d"),
        s("ai_sessions").alias("ai_sessions_90d"),
        s("scroll_events").alias("scroll_events_90d"),
        *pos_aggs,
        F.count_if(F.col("impressions") >= 1).alias("days_with_impressions"),
        F.count_if(F.col("sessions") >= 1).alias("days_with_sessions"),
        s("impressions", last).alias("impressions_last_30d"),
        s("clicks", last).alias("clicks_last_30d"),
        s("sessions", last).alias("sessions_last_30d"),
        s("impressions", prev).alias("impressions_prev_30d"),
        s("clicks", prev).alias("clicks_prev_30d"),
        s("sessions", prev).alias("sessions_prev_30d"),
    )
    if exact_pos:
        avg_pos = F.coalesce(X.round_ratio("_pos_milli", F.col("sessions_90d") * 1000, 1), F.lit(0.0))
        pos_tier = X.position_tier_exact("_pos_milli", F.col("sessions_90d") * 1000)
    else:
        raw = F.try_divide(F.col("_wpos"), F.col("_wimp").cast("double"))
        avg_pos = F.coalesce(F.round(raw, 1), F.lit(0.0))
        pos_tier = X.position_tier(raw)
    g = g.select(
        "*",
        X.round_ratio("clicks_90d", "impressions_90d", 2, 100).alias("ctr"),
        avg_pos.alias("avg_position"),
        X.round_ratio("engaged_sessions_90d", "sessions_90d", 2, 100).alias("engagement_rate"),
        X.round_ratio("scroll_events_90d", "pageviews_90d", 2, 100).alias("scroll_rate"),
        X.round_ratio("ai_sessions_90d", "sessions_90d", 2, 100).alias("ai_traffic_pct"),
        X.trend_pct("impressions_last_30d", "impressions_prev_30d").alias("trend_pct"),
        X.trend_direction("impressions_last_30d", "impressions_prev_30d").alias("trend_direction"),
        # tier from the unrounded position, not from the 1-dp display value
        pos_tier.alias("position_tier"),
    ).drop("_pos_milli", "_wpos", "_wimp")
    snap = content.join(g, key, "left")
    snap = snap.withColumn("position_tier", F.coalesce(F.col("position_tier"), F.lit("no_data")))
    return snap.select(
        "*",
        X.age_tier().alias("age_tier"),
        X.age_tier_order().alias("age_tier_order"),
        X.freshness_tier().alias("freshness_tier"),
        X.word_count_tier().alias("word_count_tier"),
        X.char_count_tier().alias("char_count_tier"),
        X.impression_tier().alias("impression_tier"),
    )


def reconcile_queries(qfact: DataFrame, daily: DataFrame, end: _dt.date | None = None, window: int = 90,
                      eps: float = 1e-9) -> DataFrame:
    """Query-table reconciliation (A22), one row per content.

    kept share + rare share + anonymized share against 1, and the query
    table's own total against the daily fact summed over the same window.
    """
    per = qfact.groupBy("content_id").agg(
        F.sum("impressions_90d").cast("long").alias("kept_impressions"),
        F.max("rare_impressions_share").alias("rare_share"),
        F.max("anonymized_impressions_share").alias("anon_share"),
        F.max("content_total_impressions_90d").cast("long").alias("content_total"))
    if end is None:
        end = max_date(daily)
    fact = scope_filter(daily, "report_date", end - _dt.timedelta(days=window), end) \
        .groupBy("content_id").agg(F.sum("impressions").cast("long").alias("fact_impressions"))
    j = per.join(fact, "content_id", "left")
    share_sum = X.ratio("kept_impressions", "content_total") + F.col("rare_share") + F.col("anon_share")
    return j.select("content_id", "kept_impressions", "content_total", "fact_impressions",
                    (F.abs(share_sum - 1) < eps).alias("shares_complete"),
                    (F.coalesce(F.col("fact_impressions"), F.lit(0)) == F.col("content_total")).alias("fact_match"))


def month_frame(daily: DataFrame, month: str | None, keys=("client_id", "content_id"),
                flag: str = "ga4_available") -> DataFrame:
    """Monthly feature frame for one partition, or with ``month`` None for every month of the input.

    Sums, average position, weekend impressions (Spark: Sunday = 1,
    Saturday = 7) and sessions masked by the three-valued flag.
    """
    m = daily.filter(F.col("month") == month) if month is not None else daily
    if month is None:
        keys = ("month", *keys)
    weekend = F.dayofweek("report_date").isin(1, 7)
    return m.groupBy(*keys).agg(
        F.sum("impressions").cast("long").alias("imp_month"),
        F.sum("clicks").cast("long").alias("clk_month"),
        F.avg("position").alias("pos_month"),
        F.sum(F.when(weekend, F.col("impressions")).otherwise(0)).cast("long").alias("weekend_imp"),
        F.sum(X.masked("sessions", flag)).cast("long").alias("sessions_month"),
    )


# ---------------------------------------------------------------- W07, W08
def label_panel(daily: DataFrame, cuts: list[_dt.date], key: str = "content_id", measure: str = "impressions",
                feature_days: int = 90, label_days: int = 30, factor: float = 0.8) -> DataFrame:
    """Future-window label panel (W08): features (t-F, t], label (t, t+L], per cut date t.

    Cut dates are a short literal list; each row is routed to the cuts whose
    span covers it by ``explode`` of a literal array filtered per row, so
    no range join and no cross join is planned. Output: one row per
    (cut, key) with feature total, label-window total and the label.
    """
    cuts = sorted(cuts)
    lo = cuts[0] - _dt.timedelta(days=feature_days)
    hi = cuts[-1] + _dt.timedelta(days=label_days)
    scoped = scope_filter(daily, "report_date", lo, hi)
    d = F.col("report_date")
    arr = F.array(*[F.lit(c) for c in cuts])
    hits = F.filter(arr, lambda t: (d > F.date_sub(t, feature_days)) & (d <= F.date_add(t, label_days)))
    x = scoped.select(key, "report_date", F.col(measure).alias("_m")).withColumn("cut_date", F.explode(hits))
    feat = x.report_date <= x.cut_date
    g = x.groupBy("cut_date", key).agg(
        F.sum(F.when(feat, F.col("_m")).otherwise(0)).cast("long").alias("feature_total"),
        F.sum(F.when(~feat, F.col("_m")).otherwise(0)).cast("long").alias("label_total"))
    return g.withColumn("label", (F.col("label_total") < F.lit(Decimal(str(factor))) * F.col("feature_total"))
                        .cast("int"))


def persistence(daily: DataFrame, key: str = "content_id", measure: str = "impressions", weeks: int = 4,
                drop: float = 0.8, end: _dt.date | None = None) -> DataFrame:
    """Persistence check (W07, rule ours): a drop that lasts across weeks.

    Week buckets counted back from ``end``; per key, each week's total is
    compared with the previous week's (``lag``); ``run`` is the length of
    the trailing streak of weeks below ``drop`` x the week before. The
    window is partitioned by key over at most ``weeks`` rows per key.
    """
    if end is None:
        end = max_date(daily)
    lo = end - _dt.timedelta(days=7 * weeks)
    scoped = scope_filter(daily, "report_date", lo, end)
    week = F.floor(F.datediff(F.lit(end), F.col("report_date")) / 7).cast("int")
    wk = scoped.groupBy(key, (F.lit(weeks - 1) - week).alias("week")).agg(F.sum(measure).cast("long").alias("total"))
    w = Window.partitionBy(key).orderBy("week")
    wk = wk.withColumn("prev_total", F.lag("total").over(w))
    wk = wk.withColumn("dropped", (F.col("total") < F.lit(Decimal(str(drop))) * F.col("prev_total")).cast("int"))
    # trailing streak: weeks after the last non-dropped week
    last_ok = F.max(F.when(F.col("dropped") == 0, F.col("week"))).alias("last_ok")
    agg = wk.groupBy(key).agg(last_ok, F.max("week").alias("last_week"),
                              F.count_if(F.col("dropped") == 1).alias("dropped_weeks"))
    run = F.col("last_week") - F.coalesce(F.col("last_ok"), F.lit(0))
    return agg.select(key, "dropped_weeks", run.cast("int").alias("trailing_run"),
                      (run >= 2).alias("persistent_drop"))
