"""Anchor counts of FIXTURES.md section 3 at sf0.01."""

from pyspark.sql import functions as F

from conftest import SF01
from panelrank.plans import batch, q_metrics, q_windows
from panelrank.sources import fixtures as fx


def test_daily_rows_and_totals(spark):
    d = fx.fx_daily(spark, SF01)
    r = d.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("client_id").alias("c"), F.sum("impressions").alias("i"),
              F.sum("clicks").alias("k"), F.sum("engaged_sessions").alias("e"), F.sum("ai_sessions").alias("a"),
              F.sum("pageviews").alias("p"), F.sum("scroll_events").alias("s"), F.max("report_date").alias("m")).first()
    assert (r.n, r.c) == (59657, 25)
    assert (r.i, r.k, r.e, r.a, r.p, r.s) == (1524135, 508542, 27095, 11240, 240315, 359853)
    assert str(r.m) == "2001-11-04"


def test_ga4_flag(spark):
    d = fx.fx_daily(spark, SF01)
    r = d.agg(F.count_if(F.col("ga4_available")).alias("t"), F.count_if(~F.col("ga4_available")).alias("f"),
              F.count_if(F.col("ga4_available").isNull()).alias("n")).first()
    assert (r.t, r.f, r.n) == (29848, 19905, 9904)


def test_two_window(spark):
    t = q_windows.decline_frame(spark, SF01)
    r = t.agg(F.count(F.lit(1)).alias("n"), F.sum("is_declining").alias("d")).first()
    assert (r.n, r.d) == (1061, 620)


def test_trend_and_position_tiers(spark):
    s = batch.snapshot(spark, SF01)
    trend = {r[0]: r[1] for r in s.groupBy("trend_direction").count().collect()}
    assert trend == {"down": 774, "stable": 405, "up": 791, "new": 30}
    pos = {r[0]: r[1] for r in s.groupBy("position_tier").count().collect()}
    assert pos == {"top_3": 113, "page_1": 260, "striking": 411, "page_3_5": 1136, "deep": 80}


def test_query_kinds(spark):
    q = fx.fx_query_all(spark, SF01)
    kinds = {r[0]: r[1] for r in q.groupBy("kind").count().collect()}
    assert q.count() == 59391
    assert kinds == {"kept": 31921, "rare": 7072, "anonymized": 20398}


def test_scored_fixture(spark):
    s = q_metrics.scored(spark, SF01)
    r = s.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("score").alias("d"), F.sum("label").alias("p"),
              F.max("score").alias("m")).first()
    assert (r.n, r.d, r.p, r.m) == (2000, 14, 774, 13)


def test_content_blanks(spark):
    c = fx.fx_content(spark, SF01)
    r = c.agg(F.count_if(F.col("content_age_days") >= 90).alias("a"), F.count_if(F.col("word_count").isNull()).alias("w"),
              F.count_if(F.col("search_volume").isNull()).alias("s"), F.count_if(F.col("main_intent").isNull()).alias("m")).first()
    assert (r.a, r.w, r.s, r.m) == (1844, 500, 331, 223)


def test_events_two_window(spark):
    d = q_windows.events_decline(spark, SF01)
    r = d.agg(F.count(F.lit(1)).alias("n"), F.sum("is_declining").alias("dn")).first()
    assert (r.n, r.dn) == (150, 25)


def test_snapshot_respects_client_starts(spark):
    from panelrank.operators import clean as C
    from panelrank.operators import windows as W
    d = fx.fx_daily(spark, SF01)
    cl = fx.fx_clients(spark, SF01, d)
    with_start = W.build_snapshot(d, fx.fx_content(spark, SF01), window=730, split=365, clients=cl)
    manual = W.build_snapshot(C.after_start(d, cl), fx.fx_content(spark, SF01), window=730, split=365)
    cols = ["content_id", "impressions_90d", "trend_direction", "position_tier"]
    assert sorted(map(tuple, with_start.select(*cols).collect())) == sorted(map(tuple, manual.select(*cols).collect()))
    # clients with unknown start contribute no activity at all
    unknown = [r.client_id for r in cl.filter(F.col("start_date").isNull()).collect()]
    assert with_start.filter(F.col("client_id").isin(unknown) & F.col("impressions_90d").isNotNull()).count() == 0
