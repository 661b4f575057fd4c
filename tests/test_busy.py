"""The busy fixture reaches every rule branch; drift per segment on a small fixture."""

from pyspark.sql import functions as F

from conftest import SF01
from panelrank.operators import audit as V
from panelrank.plans import q_busy


def values(df, col):
    return {r[0] for r in df.select(F.explode(F.split(col, "[|]"))).distinct().collect()}


def test_every_code_action_and_confidence_occurs(spark):
    b = q_busy.busy_baseline_queue(spark, SF01).persist()
    assert values(b, "reason_codes") == {
        "stale_visible_page", "declining_with_demand", "thin_visible_page", "page_one_decay_risk", "low_ctr_visible_page",
        "low_engagement_visible_page", "general_refresh_review"}
    assert values(b, "suggested_action_baseline") == {"expand_and_refresh", "refresh_and_review_ctr", "refresh", "monitor"}
    f = q_busy.busy_final_queue(spark, SF01).persist()
    assert values(f, "final_reason_codes") >= {
        "model_decline_risk", "visible_model_opportunity", "ctr_review_candidate", "engagement_review_candidate"}
    assert values(f, "suggested_action") == {
        "expand_and_refresh", "refresh_and_review_ctr", "refresh_and_review_engagement", "refresh", "monitor"}
    assert values(f, "confidence") == {"high", "medium", "low"}
    assert values(q_busy.busy_playbook(spark, SF01), "reason") == {"Falling ranks", "Losing CTR/Visibility"}
    assert q_busy.busy_slipping_visible(spark, SF01).count() > 0


def test_drift_by_segment(spark):
    rows = lambda seg, xs: [(seg, float(x)) for x in xs]
    a = spark.createDataFrame(rows("same", range(100)) + rows("moved", range(100)) + rows(None, range(100)) + rows("gone", range(9)), "seg string, x double")
    b = spark.createDataFrame(rows("same", range(100)) + rows("moved", range(95, 195)) + rows(None, range(100)) + rows("new", range(9)) + [("same", None)], "seg string, x double")
    got = {r.seg: r for r in V.drift(a, b, ["x"], by=["seg"]).collect()}
    assert set(got) == {"same", "moved", None, "gone", "new"}
    assert got["same"].psi == 0 and got[None].psi == 0 and got["same"].bins == 10
    assert got["moved"].psi > 1 and got["moved"].status == "shift"
    assert got["gone"].psi is None and got["new"].status == "no_rows"
