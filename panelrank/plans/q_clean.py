"""Registered queries: snapshot, cleaning, features."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelrank.operators import clean as C
from panelrank.plans import batch
from panelrank.plans import sql_common as Q
from panelrank.plans.registry import register

SNAP_COLS = Q.SNAPSHOT_COLUMNS


@register("snapshot", Q.chain("snap_out AS (SELECT * FROM fx_snapshot)", upto="snapshot")
          + "SELECT * FROM snap_out")
def snapshot(spark, sf_dir):
    """A20-A21 + C13-C20: page snapshot with rates, trend and tiers."""
    return batch.snapshot(spark, sf_dir).select(*SNAP_COLS)


@register("clean_snapshot", Q.chain(upto="clean") + "SELECT * FROM fx_clean")
def clean_snapshot(spark, sf_dir):
    """Coerce, fill, normalize categories; absent columns created."""
    return batch.cleaned(spark, sf_dir)


LOGS = ["log_impressions_90d", "log_clicks_90d", "log_sessions_90d", "log_ai_sessions_90d"]


@register("feature_vector", Q.chain(upto="features") + "SELECT * REPLACE ("
          + ", ".join(f"round({c}, 9) AS {c}" for c in LOGS) + ") FROM fx_features")
def feature_vector(spark, sf_dir):
    """Scope filter, label, log features, flags (logs shown at 1e-9: libm ulps differ)."""
    f = batch.features(spark, sf_dir, materialize=False)
    return f.select(*[F.round(c, 9).alias(c) if c in LOGS else F.col(c) for c in f.columns])


@register("trend_counts", Q.chain(upto="snapshot") +
          "SELECT trend_direction, COUNT(*) AS pages FROM fx_snapshot GROUP BY trend_direction")
def trend_counts(spark, sf_dir):
    """C15 anchor: pages per trend direction."""
    return batch.snapshot(spark, sf_dir).groupBy("trend_direction").agg(F.count(F.lit(1)).alias("pages"))


@register("position_tier_counts", Q.chain(upto="snapshot") +
          "SELECT position_tier, COUNT(*) AS pages FROM fx_snapshot GROUP BY position_tier")
def position_tier_counts(spark, sf_dir):
    """C20 anchor: pages per position tier."""
    return batch.snapshot(spark, sf_dir).groupBy("position_tier").agg(F.count(F.lit(1)).alias("pages"))


# ---------------------------------------------------------------- fx_messy (C01-C04, C07 on text input)
MESSY_NUM = ["impressions_90d", "clicks_90d", "sessions_90d", "word_count", "search_volume", "ctr"]


def messy(spark, sf_dir):
    """Snapshot numerics as text with planted '', 'nan', 'abc', 'inf', plus a second copy of every
    fifth page with another order value (the first by ``ord`` must win)."""
    s = batch.snapshot(spark, sf_dir).select("content_id", "client_id", "content_type", "main_intent", *MESSY_NUM)
    k = F.col("content_id")
    plant = (F.when(k % 7 == 0, F.lit("")).when(k % 11 == 0, F.lit("nan")).when(k % 13 == 0, F.lit("abc"))
             .when(k % 17 == 0, F.lit("inf")))
    cols = [F.coalesce(plant, F.col(c).cast("string")).alias(c) if c == "search_volume"
            else F.col(c).cast("string").alias(c) for c in MESSY_NUM]
    base = s.select("content_id", "client_id", "content_type", "main_intent", *cols, F.lit(0).alias("ord"))
    dup = base.filter(k % 5 == 0).withColumn("ord", F.lit(1)).withColumn("impressions_90d", F.lit("-1"))
    return base.unionByName(dup)


@register("messy_clean", Q.chain(f"""
    messy AS (
      SELECT content_id, client_id, content_type, main_intent,
        {", ".join(f"CAST({c} AS VARCHAR) AS {c}" if c != "search_volume" else
                   "COALESCE(CASE WHEN content_id % 7 = 0 THEN '' WHEN content_id % 11 = 0 THEN 'nan' "
                   "WHEN content_id % 13 = 0 THEN 'abc' WHEN content_id % 17 = 0 THEN 'inf' END, "
                   "CAST(search_volume AS VARCHAR)) AS search_volume" for c in MESSY_NUM)}, 0 AS ord
      FROM fx_snapshot),
    messy_all AS (SELECT * FROM messy UNION ALL
      SELECT * REPLACE ('-1' AS impressions_90d, 1 AS ord) FROM messy WHERE content_id % 5 = 0),
    firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY content_id ORDER BY ord) AS rn FROM messy_all) WHERE rn = 1)""",
    upto="snapshot") + "SELECT content_id, client_id, " + ", ".join(
    f"CAST(COALESCE(CASE WHEN isnan(TRY_CAST({c} AS DOUBLE)) OR isinf(TRY_CAST({c} AS DOUBLE)) THEN NULL "
    f"ELSE TRY_CAST({c} AS DOUBLE) END, 0.0) AS DOUBLE) AS {c}" for c in MESSY_NUM)
    + ", CASE WHEN content_type IS NULL OR content_type IN ('', 'nan') THEN 'unknown' ELSE content_type END AS content_type"
    + ", CASE WHEN main_intent IS NULL OR main_intent IN ('', 'nan') THEN 'unknown' ELSE main_intent END AS main_intent"
    + ", ord FROM firsts")
def messy_clean(spark, sf_dir):
    """C01-C04 + C07 on text input: bad text / NaN / Inf -> 0, blanks -> unknown, first copy by order."""
    m = C.dedupe_first(messy(spark, sf_dir), "content_id", ["ord"])
    c = C.clean_snapshot(m, numeric=MESSY_NUM, boolean=[], categorical=["content_type", "main_intent"])
    return c.select("content_id", "client_id", *MESSY_NUM, "content_type", "main_intent", "ord")
