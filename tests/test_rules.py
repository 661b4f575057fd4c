"""Rule-boundary rows (fx_edges): each side of every tier cut and reason threshold."""

import pytest
from pyspark.sql import functions as F

from panelrank.functions import exprs as X
from panelrank.operators import score as S


def test_tiers_at_edges(spark):
    rows = [(14, 30, 999, 7999, 299, 3.0), (15, 31, 1000, 8000, 300, 3.01), (90, 90, 3499, 24999, 2999, 10.0),
            (91, 91, 3500, 25000, 3000, 20.0), (365, 180, 2000, 15000, 30000, 50.0), (366, 181, None, None, 0, 50.1),
            (None, None, 1, 1, None, 0.0)]
    df = spark.createDataFrame(rows, "content_age_days long, days_since_last_update long, word_count long, "
                                     "char_count long, impressions_90d long, avg_position double")
    got = df.select(X.age_tier(), X.age_tier_order(), X.freshness_tier(), X.word_count_tier(), X.char_count_tier(),
                    X.impression_tier(), X.position_tier()).collect()
    assert [tuple(r) for r in got] == [
        ("0-14", 1, "0-30", "<1000", "<8000", "low", "top_3"),
        ("15-30", 2, "31-90", "1000-2000", "8000-15000", "moderate", "page_1"),
        ("31-90", 3, "31-90", "2000-3500", "15000-25000", "moderate", "page_1"),
        ("91-180", 4, "91-180", "3500+", "25000+", "good", "striking"),
        ("181-365", 5, "91-180", "2000-3500", "15000-25000", "excellent", "page_3_5"),
        ("365+", 6, "181+", None, None, "none", "deep"),
        (None, None, "never", "<1000", "<8000", "no_data", "no_data"),
    ]


def test_trend_direction_band(spark):
    rows = [(0, 0), (5, 0), (12, 10), (13, 10), (8, 10), (7, 10), (10, 10)]
    df = spark.createDataFrame(rows, "last long, prev long")
    got = [r[0] for r in df.select(X.trend_direction("last", "prev")).collect()]
    assert got == ["flat", "new", "stable", "up", "stable", "down", "stable"]


def test_round_ratio_half_up(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (-1, 8), (2675, 100000), (5, 0)], "a long, b long")
    got = [r[0] for r in df.select(X.round_ratio("a", "b", 2, 100)).collect()]
    assert got == [12.5, 33.33, -12.5, 2.68, None]


def _feat(spark, **kw):
    base = dict(content_id=1, days_since_last_update=0.0, impressions_90d=0.0, trend_direction="up",
                word_count=0.0, avg_position=0.0, content_age_days=0.0, ctr=1.0, sessions_90d=0.0,
                engagement_rate=0.0, scroll_rate=0.0)
    base.update(kw)
    return spark.createDataFrame([tuple(base.values())], list(base.keys()))


def _codes(spark, **kw):
    return S.baseline_reasons(_feat(spark, **kw)).first()["reason_codes"]


def test_reason_code_thresholds(spark):
    assert _codes(spark, days_since_last_update=180.0, impressions_90d=500.0) == ["stale_visible_page"]
    assert _codes(spark, days_since_last_update=179.0, impressions_90d=500.0) == ["general_refresh_review"]
    assert _codes(spark, trend_direction="DOWN", impressions_90d=100.0) == ["declining_with_demand"]
    assert _codes(spark, word_count=1199.0, impressions_90d=250.0) == ["thin_visible_page"]
    assert _codes(spark, word_count=1200.0, impressions_90d=250.0) == ["general_refresh_review"]
    assert _codes(spark, avg_position=10.0, content_age_days=180.0) == ["page_one_decay_risk"]
    assert _codes(spark, impressions_90d=500.0, avg_position=20.0, ctr=0.49, days_since_last_update=0.0) == \
        ["low_ctr_visible_page"]
    assert _codes(spark, sessions_90d=30.0, scroll_rate=29.9) == ["low_engagement_visible_page"]
    assert _codes(spark, sessions_90d=30.0, engagement_rate=30.0) == ["general_refresh_review"]


def test_final_action_precedence(spark):
    df = spark.createDataFrame([(["thin_visible_page", "model_decline_risk"],), (["ctr_review_candidate", "declining_with_demand"],),
                                (["engagement_review_candidate", "model_decline_risk"],), (["ctr_review_candidate"],),
                                (["visible_model_opportunity"],), (["general_refresh_review"],)], "final_reason_codes array<string>")
    got = [r[0] for r in S.final_action(df).select("suggested_action").collect()]
    assert got == ["expand_and_refresh", "refresh_and_review_ctr", "refresh_and_review_engagement", "monitor",
                   "refresh", "monitor"]


def test_merge_keeps_order_and_general(spark):
    df = _feat(spark, impressions_90d=600.0, avg_position=5.0, ctr=0.1).withColumn("best_model_probability", F.lit(0.7))
    df = S.baseline_reasons(df)
    got = S.merge_reasons(df).first()["final_reason_codes"]
    assert got == ["low_ctr_visible_page", "model_decline_risk", "visible_model_opportunity", "ctr_review_candidate"]


def test_coercions(spark):
    rows = [("1.5", "TRUE", "x"), ("", "yes", ""), ("nan", "Y", "nan"), ("abc", "0", None), ("inf", None, "NaN"),
            ("-2", "false", " x ")]
    df = spark.createDataFrame(rows, "n string, b string, c string")
    got = [tuple(r) for r in df.select(X.numeric_coerce("n").alias("n"), X.bool_coerce("b").alias("b"),
                                       X.category_normalize("c").alias("c")).collect()]
    assert got == [(1.5, True, "x"), (None, True, "unknown"), (None, True, "unknown"), (None, False, "unknown"),
                   (None, False, "NaN"), (-2.0, False, " x ")]


def test_playbook_rule(spark):
    rows = [(1, 600, 0.7, 12.0), (2, 600, 0.7, 5.0), (3, 500, 0.9, 12.0), (4, 900, 0.6, 30.0)]
    df = spark.createDataFrame(rows, "content_id long, imp_prev long, decline_probability double, pos_prev double")
    got = {r.content_id: r.reason for r in S.playbook(df).collect()}
    assert got == {1: "Falling ranks", 2: "Losing CTR/Visibility"}  # prev must exceed 500, p must exceed 0.6


def test_slipping_visible_rule(spark):
    rows = [(1, 10.5, 500.0), (2, 10.0, 900.0), (3, 25.0, 499.0), (4, 11.0, 1200.0)]
    df = spark.createDataFrame(rows, "content_id long, avg_position double, impressions_prev_30d double")
    got = {r.content_id: (r.score, r.action_label, r.reason_code) for r in S.slipping_visible(df).collect()}
    assert got == {1: (500.0, "Refresh Content", "slipping_but_visible"),
                   4: (1200.0, "Refresh Content", "slipping_but_visible")}


def test_label_source_never_enters_the_rule_score(spark):
    """T4: the label-derived code may appear in the reasons, but flipping the label source leaves the score unchanged."""
    from pyspark.sql import functions as F
    from conftest import SF001
    from panelrank.plans import batch
    f = batch.features(spark, SF001)
    flipped = f.withColumn("trend_direction", F.when(F.col("trend_direction") == "down", "up").otherwise("down"))
    a = {r.content_id: r.baseline_refresh_score for r in S.baseline_queue(f).collect()}
    b = {r.content_id: r.baseline_refresh_score for r in S.baseline_queue(flipped).collect()}
    assert a == b
    codes = {r.content_id: r.reason_codes for r in S.baseline_queue(flipped).collect()}
    assert any("declining_with_demand" in c for c in codes.values())


def test_best_model_ties_go_to_the_first_fit(spark):
    from panelrank.operators import metrics as M
    from panelrank.operators import models as E
    cols = "model string, precision_at_50 double, average_precision double, roc_auc double"
    rows = [(m, 0.5, 0.5, 0.5) for m in reversed(E.MODEL_NAMES)] + [("other", 0.5, 0.5, 0.5)]
    m = spark.createDataFrame(rows, cols)
    assert M.best_model(m, E.MODEL_NAMES).first().model == E.MODEL_NAMES[0]
    assert M.best_model(m).first().model == "decision_tree"
    with pytest.raises(ValueError):
        E.forest(depth=31)
