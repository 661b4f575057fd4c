"""Fixed values.

Everything here must equal the published rules of the ranking job for results
to agree: column lists, tier edges, score weights, reason-code names and the
thresholds of each rule. They are plain data, kept together and in their
natural order; the logic that uses them lives in ``functions`` and
``operators``.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES: snapshot column lists
# ---------------------------------------------------------------------------
NUMERIC_COLUMNS = [
    "search_volume", "competition", "cpc", "word_count", "char_count",
    "impressions_90d", "clicks_90d", "pageviews_90d", "sessions_90d", "users_90d",
    "engaged_sessions_90d", "ai_sessions_90d", "scroll_events_90d",
    "days_with_impressions", "days_with_sessions",
    "impressions_last_30d", "clicks_last_30d", "sessions_last_30d",
    "impressions_prev_30d", "clicks_prev_30d", "sessions_prev_30d",
    "content_age_days", "age_tier_order", "days_since_last_update",
    "ctr", "avg_position", "engagement_rate", "scroll_rate", "ai_traffic_pct", "trend_pct",
]

BOOLEAN_COLUMNS: list[str] = []

CATEGORICAL_COLUMNS = [
    "competition_level", "content_type", "main_intent", "provider_used", "model_used",
    "age_tier", "freshness_tier", "word_count_tier", "char_count_tier",
    "impression_tier", "position_tier", "trend_direction",
]

REQUIRED_COLUMNS = [
    "content_id", "client_id", "impressions_90d", "sessions_90d", "content_age_days", "trend_direction",
]

MODEL_NUMERIC_FEATURES = [
    "search_volume", "competition", "cpc", "word_count", "char_count",
    "log_impressions_90d", "log_clicks_90d", "log_sessions_90d", "log_ai_sessions_90d",
    "days_with_impressions", "days_with_sessions", "content_age_days", "days_since_last_update",
    "ctr", "avg_position", "engagement_rate", "scroll_rate", "ai_traffic_pct",
]

MODEL_CATEGORICAL_FEATURES = [
    "competition_level", "content_type", "main_intent", "age_tier", "freshness_tier",
    "word_count_tier", "impression_tier", "position_tier",
]

# window-model inputs (prev half of the two-window table plus query mix)
WINDOW_MODEL_FEATURES = [
    "imp_prev", "clk_prev", "pos_prev", "visible_queries", "rare_share", "anon_share", "top_query_share",
]

# readable small-tree inputs
SMALL_TREE_FEATURES = [
    "content_age_days", "days_since_last_update", "impressions_90d", "avg_position", "ctr", "word_count",
]

BOOLEAN_TRUE_TEXT = ["true", "1", "yes", "y"]
UNKNOWN = "unknown"
CATEGORY_BLANKS = ["", "nan"]

# ---------------------------------------------------------------------------
# FIXED VALUES: tiers (label, lower edge inclusive unless stated)
# ---------------------------------------------------------------------------
# age tier by content_age_days: upper edges 14, 30, 90, 180, 365 (inclusive), order 1-6
AGE_TIERS = [("0-14", 14, 1), ("15-30", 30, 2), ("31-90", 90, 3), ("91-180", 180, 4), ("181-365", 365, 5)]
AGE_TIER_TOP = ("365+", 6)
# freshness tier by days_since_last_update (null = never): upper edges 30, 90, 180 inclusive
FRESHNESS_NEVER = "never"
FRESHNESS_TIERS = [("0-30", 30), ("31-90", 90), ("91-180", 180)]
FRESHNESS_TOP = "181+"
# word / char count tiers: lower-inclusive edges
WORD_COUNT_TIERS = [("<1000", 1000), ("1000-2000", 2000), ("2000-3500", 3500)]
WORD_COUNT_TOP = "3500+"
CHAR_COUNT_TIERS = [("<8000", 8000), ("8000-15000", 15000), ("15000-25000", 25000)]
CHAR_COUNT_TOP = "25000+"
# impression tier: no_data (no source), none (0), low (> 0), moderate >= 300, good >= 3000, excellent >= 30000
IMPRESSION_TIERS = [("excellent", 30000), ("good", 3000), ("moderate", 300)]
# position tier: <= 3 top_3, <= 10 page_1, <= 20 striking, <= 50 page_3_5, > 50 deep; 0 or null no_data
POSITION_TIERS = [("top_3", 3), ("page_1", 10), ("striking", 20), ("page_3_5", 50)]
POSITION_TOP = "deep"
POSITION_ORDER = ["top_3", "page_1", "striking", "page_3_5", "deep"]
# trend direction band: up above +20 %, down below -20 %
TREND_BAND = 0.2
TREND_LABELS = ["new", "flat", "up", "down", "stable"]
# competition level: LOW < 0.34 <= MEDIUM < 0.67 <= HIGH
COMPETITION_LEVELS = [("LOW", 0.34), ("MEDIUM", 0.67)]
COMPETITION_TOP = "HIGH"

# ---------------------------------------------------------------------------
# FIXED VALUES: baseline score
# ---------------------------------------------------------------------------
BASELINE_WEIGHTS = {"visibility_score": 0.40, "freshness_risk_score": 0.30,
                    "position_opportunity_score": 0.25, "depth_gap_score": 0.05}
POSITION_CLIP = (1, 50)

# baseline reason codes, in emission order
STALE_VISIBLE = "stale_visible_page"            # days_since_last_update >= 180 and impressions >= 500
DECLINING_WITH_DEMAND = "declining_with_demand"  # trend down and impressions >= 100 (label-derived)
THIN_VISIBLE = "thin_visible_page"              # 0 < word_count < 1200 and impressions >= 250
PAGE_ONE_DECAY = "page_one_decay_risk"          # 0 < avg_position <= 10 and content_age_days >= 180
LOW_CTR_VISIBLE = "low_ctr_visible_page"        # impressions >= 500 and 0 < avg_position <= 20 and ctr < 0.5
LOW_ENGAGEMENT_VISIBLE = "low_engagement_visible_page"  # sessions >= 30 and (0 < engagement < 30 or 0 < scroll < 30)
GENERAL_REVIEW = "general_refresh_review"       # only when none of the above
BASELINE_CODES = [STALE_VISIBLE, DECLINING_WITH_DEMAND, THIN_VISIBLE, PAGE_ONE_DECAY,
                  LOW_CTR_VISIBLE, LOW_ENGAGEMENT_VISIBLE, GENERAL_REVIEW]
LABEL_DERIVED_CODES = [DECLINING_WITH_DEMAND]

STALE_DAYS = 180
STALE_IMPRESSIONS = 500
DECLINING_IMPRESSIONS = 100
THIN_WORDS = 1200
THIN_IMPRESSIONS = 250
PAGE_ONE_POSITION = 10
PAGE_ONE_AGE = 180
LOW_CTR_IMPRESSIONS = 500
LOW_CTR_POSITION = 20
LOW_CTR = 0.5
ENGAGEMENT_SESSIONS = 30
LOW_ENGAGEMENT = 30

# model-driven codes added after the baseline codes
MODEL_DECLINE_RISK = "model_decline_risk"                 # p >= 0.65
VISIBLE_MODEL_OPPORTUNITY = "visible_model_opportunity"   # p >= 0.5 and impressions >= 500
CTR_REVIEW = "ctr_review_candidate"                       # same test as low_ctr_visible_page
ENGAGEMENT_REVIEW = "engagement_review_candidate"         # same test as low_engagement_visible_page
MODEL_RISK_P = 0.65
MODEL_OPPORTUNITY_P = 0.5
MODEL_OPPORTUNITY_IMPRESSIONS = 500

# actions
EXPAND_AND_REFRESH = "expand_and_refresh"
REFRESH_AND_REVIEW_CTR = "refresh_and_review_ctr"
REFRESH_AND_REVIEW_ENGAGEMENT = "refresh_and_review_engagement"
REFRESH = "refresh"
MONITOR = "monitor"
ACTIONS = [EXPAND_AND_REFRESH, REFRESH_AND_REVIEW_CTR, REFRESH_AND_REVIEW_ENGAGEMENT, REFRESH, MONITOR]

# short labels for report tables
SHORT_ACTION = {
    "expand_and_refresh": "Expand + refresh",
    "refresh_and_review_ctr": "Refresh + CTR",
    "refresh_and_review_engagement": "Refresh + engagement",
    "refresh": "Refresh",
    "monitor": "Monitor",
}

# final score and confidence
FINAL_MODEL_WEIGHT = 0.70
FINAL_BASELINE_WEIGHT = 0.30
CONFIDENCE_HIGH_Q = 0.8
CONFIDENCE_MEDIUM_Q = 0.5
CONFIDENCE_IMPRESSIONS = 500
CONFIDENCE_SESSIONS = 10
CONFIDENCE_P = 0.5
CONFIDENCE_LEVELS = ["high", "medium", "low"]

# hand rules
STALE_RULE = {"days": 180, "impressions": 500}
SLIPPING_RULE = {"position": 10, "impressions": 500, "action": "Refresh Content",
                 "reason": "slipping_but_visible"}
PLAYBOOK = {"prev": 500, "prob": 0.6, "position": 10,
            "action": "Refresh Content / Review Target Queries",
            "reason_far": "Falling ranks", "reason_near": "Losing CTR/Visibility"}

# two-window table defaults (the capstone uses 15/30; the notebook 30/60)
TWO_WINDOW = {"split": 15, "window": 30, "min_prev": 100, "decline_factor": 0.8}
# default fills after the query-mix join
QUERY_MIX_FILLS = {"visible_queries": 0, "rare_share": 0.0, "anon_share": 0.0,
                   "top_query_share": 0.0, "pos_prev": 50.0}
QUERY_KEEP_MIN_IMPRESSIONS = 10

# splits
CLIENT_HOLDOUT_FRACTION = 0.2
CLIENT_HOLDOUT_MIN_GROUPS = 5
ROW_HOLDOUT_FRACTION = 0.2
GROUP_SHUFFLE_FRACTION = 0.25
RANDOM_STATE = 42

# metrics
PRECISION_KS = [20, 50, 100]
DECISION_THRESHOLD = 0.5
HISTORY_DAYS = 365
EXPORT_LAG_DAYS = 3
EXPORT_ROWS_PER_FILE = 10000

# signal-test floors
SIGNAL_FLOOR = 50
SIGNAL_CROSS_FLOOR = 30

# names that mark a label-window column in the name guard
LEAKY_NAME_PARTS = ["trend", "last_30d"]
