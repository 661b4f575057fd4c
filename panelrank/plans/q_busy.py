"""Registered queries over the busy daily fact, where every volume rule is reached.

The thresholds of the rules are fixed values; the plain fixture stays below several of them. The stand-in
probability is a percentile rank, so the at-risk filter and the playbook have an oracle.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from panelrank.operators import ordered as O
from panelrank.operators import score as S
from panelrank.plans import batch
from panelrank.plans import q_models as QM
from panelrank.plans import sql_common as Q
from panelrank.plans.q_score import _queue_out
from panelrank.plans.q_windows import decline_frame, decline_sql
from panelrank.plans.registry import register
from panelrank.sources import fixtures as fx


def _features(spark, sf_dir, materialize=True):
    return batch.features(spark, sf_dir, materialize, fx.fx_busy)


@register("busy_baseline_queue", Q.chain(daily="fx_busy") + "SELECT " + ", ".join(S.BASELINE_QUEUE_COLUMNS) + " FROM fx_baseline")
def busy_baseline_queue(spark, sf_dir):
    """Q02-Q05: the rule queue where every reason code and action occurs."""
    return _queue_out(S.baseline_queue(_features(spark, sf_dir)))


@register("busy_final_queue", Q.chain(QM.BLEND_CTE, daily="fx_busy") + QM.BLEND_SELECT)
def busy_final_queue(spark, sf_dir):
    """Q06-Q10: the final queue where every merged code, action and confidence occurs."""
    return QM.blend_out(QM.blend_frame(spark, sf_dir, _features(spark, sf_dir)))


@register("busy_stale_visible", Q.chain(upto="features", daily="fx_busy") + """
SELECT content_id, CASE WHEN days_since_last_update >= 180 AND impressions_90d >= 500 THEN impressions_90d ELSE 0.0 END AS stale_score
FROM fx_features""")
def busy_stale_visible(spark, sf_dir):
    """Q12 with many pages above its edges."""
    return S.stale_visible_rule(_features(spark, sf_dir, False)).select("content_id", "stale_score")


@register("busy_slipping_visible", Q.chain(upto="features", daily="fx_busy") + """
SELECT content_id, client_id, impressions_prev_30d AS score, 'Refresh Content' AS action_label, 'slipping_but_visible' AS reason_code
FROM fx_features WHERE avg_position > 10 AND impressions_prev_30d >= 500""")
def busy_slipping_visible(spark, sf_dir):
    """Q13 with pages above its edges."""
    return S.slipping_visible(_features(spark, sf_dir, False)).select("content_id", "client_id", "score", "action_label", "reason_code")


@register("busy_playbook", f"""
WITH decline AS ({decline_sql("fx_busy")}),
scored AS (SELECT *, {Q.pct_rank_sql('imp_prev', 'decline_probability')} FROM decline)
SELECT content_id, client_id, imp_prev, round(decline_probability, 9) AS decline_probability, 'Refresh Content / Review Target Queries' AS action,
  CASE WHEN pos_prev > 10 THEN 'Falling ranks' ELSE 'Losing CTR/Visibility' END AS reason
FROM scored WHERE imp_prev > 500 AND decline_probability > 0.6""")
def busy_playbook(spark, sf_dir):
    """F04 + Q14: at-risk pages and their reasons on a stand-in probability (percentile rank of the earlier half)."""
    decline = decline_frame(spark, sf_dir, fx.fx_busy).withColumn("pos_prev", F.round("pos_prev", 9))
    scored = O.pct_rank(decline, "imp_prev", "decline_probability")
    return S.playbook(scored).select("content_id", "client_id", "imp_prev", F.round("decline_probability", 9).alias("decline_probability"),
                                     "action", "reason")
