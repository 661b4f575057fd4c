"""Rule score, reason codes, actions, final queue (Q01-Q19).

Reason codes are ``array<string>`` built with ``array_compact(array(when…))``
in the fixed emission order; they are joined with ``|`` only at the sink.
No Python runs per row.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelrank import constants as K
from panelrank.functions import exprs as X
from panelrank.operators import ordered as O
from panelrank.operators.clean import minmax


def _c(name):
    return F.col(name)


# ---------------------------------------------------------------- rule tests
def stale_visible():
    return (_c("days_since_last_update") >= K.STALE_DAYS) & (_c("impressions_90d") >= K.STALE_IMPRESSIONS)


def declining_with_demand():
    return (F.lower(_c("trend_direction")) == "down") & (_c("impressions_90d") >= K.DECLINING_IMPRESSIONS)


def thin_visible():
    return (_c("word_count") > 0) & (_c("word_count") < K.THIN_WORDS) & (_c("impressions_90d") >= K.THIN_IMPRESSIONS)


def page_one_decay():
    return (_c("avg_position") > 0) & (_c("avg_position") <= K.PAGE_ONE_POSITION) & \
        (_c("content_age_days") >= K.PAGE_ONE_AGE)


def low_ctr_visible():
    return (_c("impressions_90d") >= K.LOW_CTR_IMPRESSIONS) & (_c("avg_position") > 0) & \
        (_c("avg_position") <= K.LOW_CTR_POSITION) & (_c("ctr") < K.LOW_CTR)


def low_engagement_visible():
    e, s = _c("engagement_rate"), _c("scroll_rate")
    return (_c("sessions_90d") >= K.ENGAGEMENT_SESSIONS) & \
        (((e > 0) & (e < K.LOW_ENGAGEMENT)) | ((s > 0) & (s < K.LOW_ENGAGEMENT)))


# ---------------------------------------------------------------- Q01-Q05
def baseline_components(df: DataFrame, **kw) -> DataFrame:
    """Four components (Q01): visibility, freshness risk, position opportunity, depth gap."""
    # three percentile ranks from one grouped pass over distinct (column, value) pairs
    x = O.pct_ranks(df.withColumn("_logimp", X.log1p0("impressions_90d")),
                    {"visibility_score": "_logimp", "freshness_risk_score": "days_since_last_update",
                     "_word_pct": "word_count"}, **kw)
    x = minmax(x.withColumn("_pos_clip", X.clip("avg_position", *K.POSITION_CLIP)), "_pos_clip", "_pos_norm")
    vis = _c("visibility_score")
    x = x.withColumn("position_opportunity_score",
                     (1 - _c("_pos_norm")) * vis * (_c("avg_position") > 0).cast("int"))
    x = x.withColumn("depth_gap_score", (1 - _c("_word_pct")) * vis)
    return x.drop("_logimp", "_word_pct", "_pos_clip", "_pos_norm")


def baseline_score(df: DataFrame, **kw) -> DataFrame:
    """Weighted blend clipped to [0, 1] (Q02)."""
    x = baseline_components(df, **kw)
    w = K.BASELINE_WEIGHTS
    s = (F.lit(w["visibility_score"]) * _c("visibility_score")
         + F.lit(w["freshness_risk_score"]) * _c("freshness_risk_score")
         + F.lit(w["position_opportunity_score"]) * _c("position_opportunity_score")
         + F.lit(w["depth_gap_score"]) * _c("depth_gap_score"))
    return x.withColumn("baseline_refresh_score", X.clip(s, 0.0, 1.0))


def baseline_reasons(df: DataFrame, out: str = "reason_codes") -> DataFrame:
    """Six rules in fixed order; ``general_refresh_review`` when none holds (Q03)."""
    codes = X.code_list([(stale_visible(), K.STALE_VISIBLE),
                         (declining_with_demand(), K.DECLINING_WITH_DEMAND),
                         (thin_visible(), K.THIN_VISIBLE),
                         (page_one_decay(), K.PAGE_ONE_DECAY),
                         (low_ctr_visible(), K.LOW_CTR_VISIBLE),
                         (low_engagement_visible(), K.LOW_ENGAGEMENT_VISIBLE)])
    codes = F.when(F.size(codes) == 0, F.array(F.lit(K.GENERAL_REVIEW))).otherwise(codes)
    return df.withColumn(out, codes)


def baseline_action(df: DataFrame, codes: str = "reason_codes", out: str = "suggested_action_baseline") -> DataFrame:
    """thin -> expand; low ctr -> review ctr; stale or declining -> refresh; else monitor (Q04)."""
    has = lambda c: F.array_contains(_c(codes), c)
    a = (F.when(has(K.THIN_VISIBLE), K.EXPAND_AND_REFRESH)
         .when(has(K.LOW_CTR_VISIBLE), K.REFRESH_AND_REVIEW_CTR)
         .when(has(K.STALE_VISIBLE) | has(K.DECLINING_WITH_DEMAND), K.REFRESH)
         .otherwise(K.MONITOR))
    return df.withColumn(out, a)


BASELINE_QUEUE_COLUMNS = [
    "content_id", "client_id", "baseline_rank", "baseline_refresh_score", "visibility_score",
    "freshness_risk_score", "position_opportunity_score", "depth_gap_score", "reason_codes",
    "suggested_action_baseline", "is_declining_label", "impressions_90d", "clicks_90d", "sessions_90d",
    "avg_position", "ctr", "engagement_rate", "scroll_rate", "content_age_days", "days_since_last_update",
    "word_count", "trend_direction",
]


def baseline_queue(features: DataFrame, **kw) -> DataFrame:
    """Rule queue (Q05): score, codes, action, rank by (score desc, id asc)."""
    x = baseline_action(baseline_reasons(baseline_score(features, **kw)))
    x = O.row_rank(x, [("baseline_refresh_score", True)], "content_id", "baseline_rank", **kw)
    return x


# ---------------------------------------------------------------- Q06-Q11
def final_score(df: DataFrame, p: str = "best_model_probability", w_model: float = K.FINAL_MODEL_WEIGHT) -> DataFrame:
    """clip(100 * (0.7 p + 0.3 minmax(baseline)), 0, 100); missing p -> 0 (Q06)."""
    x = df.withColumn(p, F.coalesce(_c(p), F.lit(0.0)))
    x = minmax(x, "baseline_refresh_score", "baseline_score_normalized")
    s = F.lit(100.0) * (F.lit(w_model) * _c(p) + F.lit(round(1 - w_model, 10)) * _c("baseline_score_normalized"))
    return x.withColumn("final_refresh_score", X.clip(s, 0.0, 100.0))


def merge_reasons(df: DataFrame, p: str = "best_model_probability", codes: str = "reason_codes",
                  out: str = "final_reason_codes") -> DataFrame:
    """Baseline codes + four model/volume rules, order-preserving distinct (Q07)."""
    extra = X.code_list([(_c(p) >= K.MODEL_RISK_P, K.MODEL_DECLINE_RISK),
                         ((_c(p) >= K.MODEL_OPPORTUNITY_P) & (_c("impressions_90d") >= K.MODEL_OPPORTUNITY_IMPRESSIONS),
                          K.VISIBLE_MODEL_OPPORTUNITY),
                         (low_ctr_visible(), K.CTR_REVIEW),
                         (low_engagement_visible(), K.ENGAGEMENT_REVIEW)])
    base = F.coalesce(_c(codes), F.array().cast("array<string>"))
    base = F.filter(base, lambda r: (r != "") & (r != "nan"))
    merged = F.array_distinct(F.concat(base, extra))
    merged = F.when(F.size(merged) == 0, F.array(F.lit(K.GENERAL_REVIEW))).otherwise(merged)
    return df.withColumn(out, merged)


def final_action(df: DataFrame, codes: str = "final_reason_codes", out: str = "suggested_action") -> DataFrame:
    """Five-way precedence on the merged codes (Q08)."""
    has = lambda c: F.array_contains(_c(codes), c)
    risk = has(K.MODEL_DECLINE_RISK) | has(K.DECLINING_WITH_DEMAND)
    a = (F.when(has(K.THIN_VISIBLE), K.EXPAND_AND_REFRESH)
         .when(has(K.CTR_REVIEW) & risk, K.REFRESH_AND_REVIEW_CTR)
         .when(has(K.ENGAGEMENT_REVIEW) & risk, K.REFRESH_AND_REVIEW_ENGAGEMENT)
         .when(X.has_any(codes, [K.MODEL_DECLINE_RISK, K.DECLINING_WITH_DEMAND, K.STALE_VISIBLE,
                                 K.VISIBLE_MODEL_OPPORTUNITY]), K.REFRESH)
         .otherwise(K.MONITOR))
    return df.withColumn(out, a)


def confidence(df: DataFrame, score: str = "final_refresh_score", p: str = "best_model_probability",
               hi_q: float = K.CONFIDENCE_HIGH_Q, mid_q: float = K.CONFIDENCE_MEDIUM_Q) -> DataFrame:
    """high / medium / low from score quantiles (exact, linear) and volume (Q09)."""
    from panelrank.operators.aggregates import quantiles
    q = quantiles(df, score, [hi_q, mid_q])
    j = df.crossJoin(F.broadcast(q.select(F.col("q0").alias("_hi"), F.col("q1").alias("_mid"))))
    lab = (F.when((_c(score) >= _c("_hi")) & (_c("impressions_90d") >= K.CONFIDENCE_IMPRESSIONS)
                  & (_c("sessions_90d") >= K.CONFIDENCE_SESSIONS) & (_c(p) >= K.CONFIDENCE_P), "high")
           .when(_c(score) >= _c("_mid"), "medium").otherwise("low"))
    return j.withColumn("confidence", lab).drop("_hi", "_mid")


FINAL_QUEUE_COLUMNS = [
    "final_rank", "content_id", "client_id", "final_refresh_score", "best_model_name", "best_model_probability",
    "baseline_refresh_score", "confidence", "suggested_action", "final_reason_codes", "is_declining_label",
    "impressions_90d", "clicks_90d", "sessions_90d", "avg_position", "ctr", "content_age_days",
    "days_since_last_update", "word_count", "trend_direction", "competition_level", "content_type", "main_intent",
    "age_tier", "freshness_tier", "word_count_tier", "impression_tier", "position_tier",
]

CONTEXT_COLUMNS = ["competition_level", "content_type", "main_intent", "age_tier", "freshness_tier",
                   "word_count_tier", "impression_tier", "position_tier"]


def attach_scores(queue: DataFrame, preds: DataFrame, context: DataFrame, key: str = "content_id") -> DataFrame:
    """Baseline queue left join predictions, then left join context columns."""
    p = preds.select(key, *[c for c in preds.columns if c.startswith("prob_") or c.startswith("best_model")])
    c = context.select(key, *[x for x in CONTEXT_COLUMNS if x in context.columns])
    return queue.join(p, key, "left").join(c, key, "left")


def final_queue(queue: DataFrame, preds: DataFrame, context: DataFrame, **kw) -> DataFrame:
    """Final queue (Q06-Q10): blend, merged codes, action, confidence, rank."""
    x = attach_scores(queue.select(*BASELINE_QUEUE_COLUMNS), preds, context)
    x = final_score(x)
    x = final_action(merge_reasons(x))
    x = confidence(x)
    x = O.row_rank(x, [("final_refresh_score", True), ("impressions_90d", True), ("sessions_90d", True)],
                   "content_id", "final_rank", **kw)
    return x.select(*FINAL_QUEUE_COLUMNS)


# ---------------------------------------------------------------- hand rules Q12-Q15
def stale_visible_rule(df: DataFrame, days: int = K.STALE_RULE["days"], imp: int = K.STALE_RULE["impressions"]) -> DataFrame:
    """stale x visible x impressions (Q12)."""
    s = ((_c("days_since_last_update") >= days).cast("int") * (_c("impressions_90d") >= imp).cast("int")
         * _c("impressions_90d"))
    return df.withColumn("stale_score", s)


def slipping_visible(df: DataFrame, pos: int = K.SLIPPING_RULE["position"], imp: int = K.SLIPPING_RULE["impressions"],
                     prev: str = "impressions_prev_30d") -> DataFrame:
    """slipping x visible rule, positive scores only (Q13)."""
    s = (_c("avg_position") > pos).cast("int") * (_c(prev) >= imp).cast("int") * _c(prev)
    x = df.withColumn("score", s)
    x = x.withColumn("action_label", F.when(_c("score") > 0, K.SLIPPING_RULE["action"]).otherwise("None"))
    x = x.withColumn("reason_code", F.when(_c("score") > 0, K.SLIPPING_RULE["reason"]).otherwise("N/A"))
    return x.filter(_c("score") > 0)


def playbook(df: DataFrame, prev: str = "imp_prev", prob: str = "decline_probability",
             pos: str = "pos_prev") -> DataFrame:
    """At-risk playbook (Q14): F04 filter, reason by position."""
    from panelrank.operators.clean import at_risk
    x = at_risk(df, prev, prob)
    return x.select("*", F.lit(K.PLAYBOOK["action"]).alias("action"),
                    F.when(_c(pos) > K.PLAYBOOK["position"], K.PLAYBOOK["reason_far"])
                    .otherwise(K.PLAYBOOK["reason_near"]).alias("reason"))


# ---------------------------------------------------------------- Q16-Q19
def threshold_sweep(df: DataFrame, score: str, label: str, cuts: list[float]) -> DataFrame:
    """Captured rows, precision and recall per score cutoff (Q16).

    Each row counts the cuts it passes; rows are counted per number of cuts passed, so no row is repeated, and a cut captures
    the groups that pass at least as many: at most ``len(cuts)`` groups meet ``len(cuts)`` cuts.
    """
    ordered = sorted({float(c) for c in cuts})
    passed = F.size(F.filter(F.array(*[F.lit(c) for c in ordered]), lambda t: _c(score) >= t))
    groups = df.groupBy(passed.alias("_k")).agg(F.count(F.lit(1)).alias("_n"), F.sum(_c(label).cast("long")).alias("_y")).filter("_k > 0")
    table = df.sparkSession.createDataFrame([(c, i + 1) for i, c in enumerate(ordered)], "cutoff double, _i int")
    g = F.broadcast(table).join(groups, F.col("_k") >= F.col("_i")).groupBy("cutoff").agg(F.sum("_n").alias("captured"), F.sum("_y").cast("long").alias("tp"))
    pos = df.agg(F.sum(_c(label).cast("long")).alias("_pos"))
    allc = df.sparkSession.createDataFrame([(float(c),) for c in cuts], "cutoff double")
    j = allc.join(g, "cutoff", "left").na.fill(0, ["captured", "tp"]).crossJoin(F.broadcast(pos))
    return j.select("cutoff", "captured", "tp",
                    F.coalesce(X.ratio("tp", "captured"), F.lit(0.0)).alias("precision"),
                    F.coalesce(X.ratio("tp", "_pos"), F.lit(0.0)).alias("recall"))


def ctr_gap(df: DataFrame, tier: str = "position_tier", clicks: str = "clicks_90d", imps: str = "impressions_90d",
            floor: int = 100) -> DataFrame:
    """Expected CTR per position tier (impression-weighted, floor n) and the gap per page (Q18).

    Tier table: one row per tier.
    """
    base = df.filter(_c(imps) >= floor)
    t = base.groupBy(tier).agg(F.sum(clicks).alias("_c"), F.sum(imps).alias("_i"), F.count(F.lit(1)).alias("tier_pages"))
    t = t.select(tier, "tier_pages", (F.col("_c") * 100.0 / F.col("_i")).alias("expected_ctr"))
    x = base.join(t, tier, "inner")
    actual = _c(clicks) * 100.0 / _c(imps)
    x = x.withColumn("actual_ctr", actual).withColumn("ctr_gap", _c("expected_ctr") - actual)
    x = x.withColumn("missed_clicks", _c("ctr_gap") / 100.0 * _c(imps))
    return x.withColumn("gap_reason", F.when(_c("ctr_gap") > 0, "below_tier_ctr").otherwise("at_or_above_tier_ctr"))


def segment_opportunity(df: DataFrame, by: list[str], measure: str = "ai_sessions_90d",
                        base: str = "sessions_90d", floor: int = 50) -> DataFrame:
    """Sparse-signal segments (Q19): per segment, rate of a rare measure with n and a floor.

    An EDA ranking only: segments under the floor are kept but flagged.
    """
    g = df.groupBy(*by).agg(F.count(F.lit(1)).alias("pages"), F.sum(measure).alias("_m"), F.sum(base).alias("_b"),
                            F.count_if(_c(measure) > 0).alias("pages_with_signal"))
    return g.select(*by, "pages", "pages_with_signal", F.col("_m").cast("long").alias("signal_total"),
                    F.coalesce(X.ratio("_m", "_b"), F.lit(0.0)).alias("signal_rate"),
                    (F.col("pages") >= floor).alias("above_floor"))


def lookalike(win: DataFrame, sibling: DataFrame, client_trend: DataFrame, min_prev: int = 100) -> DataFrame:
    """Decline look-alike classifier (Q17, rule ours; labelled as such).

    ``win``: two-window rows with imp_last/imp_prev/clk_last/clk_prev.
    ``sibling``: sibling_shift output (sibling_gain per row).
    ``client_trend``: per client ratio of last to prev impressions.
    Order: noise (under floor) -> consolidation (siblings gained what the
    page lost) -> seasonality (client-wide drop of the same size) ->
    click_loss (clicks fell while impressions held) -> real_decline.
    """
    x = win.join(sibling.select("client_id", "content_id", "sibling_gain"), ["client_id", "content_id"], "left") \
        .join(client_trend, "client_id", "left")
    loss = _c("imp_prev") - _c("imp_last")
    page_ratio = X.ratio("imp_last", "imp_prev")
    lab = (F.when(_c("imp_prev") < min_prev, "noise")
           .when((loss > 0) & (F.coalesce(_c("sibling_gain"), F.lit(0)) >= loss), "consolidation")
           .when((page_ratio < 0.8) & (_c("client_ratio") < 0.8), "seasonality")
           .when((page_ratio >= 0.8) & (_c("clk_last") < F.lit(Decimal("0.8")) * _c("clk_prev")), "click_loss")
           .when(page_ratio < 0.8, "real_decline")
           .otherwise("no_decline"))
    return x.withColumn("decline_type", lab)
