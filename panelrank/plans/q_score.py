"""Registered queries: rule score and queue."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelrank.operators import score as S
from panelrank.plans import batch
from panelrank.plans import sql_common as Q
from panelrank.plans.registry import register


def _queue_out(df):
    return df.select(*[F.array_join(F.col(c), "|").alias(c) if c == "reason_codes" else F.col(c)
                       for c in S.BASELINE_QUEUE_COLUMNS])


@register("baseline_queue", Q.chain() + "SELECT " + ", ".join(S.BASELINE_QUEUE_COLUMNS) + " FROM fx_baseline")
def baseline_queue(spark, sf_dir):
    """Q01-Q05 with W01 percentile ranks and W02 ordinal rank: the rule queue."""
    return _queue_out(batch.rule_queue(spark, sf_dir))


@register("feature_metadata", Q.chain(upto="features") + """
SELECT (SELECT COUNT(*) FROM fx_snapshot) AS initial_rows, COUNT(*) AS prepared_rows,
       CAST(SUM(is_declining_label) AS BIGINT) AS declining_rows, AVG(CAST(is_declining_label AS DOUBLE)) AS declining_rate
FROM fx_features""")
def feature_metadata(spark, sf_dir):
    """S09 payload of the prepare step: raw rows, prepared rows, declining rows and rate."""
    snap = batch.snapshot(spark, sf_dir).agg(F.count(F.lit(1)).alias("initial_rows"))
    f = batch.features(spark, sf_dir, materialize=False).agg(F.count(F.lit(1)).alias("prepared_rows"),
                                          F.sum("is_declining_label").cast("long").alias("declining_rows"),
                                          F.avg(F.col("is_declining_label").cast("double")).alias("declining_rate"))
    return snap.crossJoin(f)


@register("baseline_summary", Q.chain() + """
, t AS (SELECT COALESCE(AVG(CASE WHEN baseline_rank <= 50 THEN CAST(is_declining_label AS DOUBLE) END), 0.0) AS rate_top_50
        FROM fx_baseline)
SELECT COUNT(*) AS rows, CAST(SUM(is_declining_label) AS BIGINT) AS positive_rows,
  AVG(CAST(is_declining_label AS DOUBLE)) AS positive_rate, round(MAX(baseline_refresh_score), 9) AS top_score,
  round(quantile_cont(baseline_refresh_score, 0.5), 9) AS median_score, MAX(t.rate_top_50) AS rate_top_50
FROM fx_baseline, t""")
def baseline_summary(spark, sf_dir):
    """A10 / S09 payload of the rule step: rows, top and median score, top-50 declining rate."""
    from panelrank.operators.aggregates import summary
    q = batch.rule_queue(spark, sf_dir)
    s = summary(q, "is_declining_label", "baseline_refresh_score", 50, "content_id")
    return s.select("rows", "positive_rows", "positive_rate", F.round("top_score", 9).alias("top_score"),
                    F.round("median_score", 9).alias("median_score"), "rate_top_50")
