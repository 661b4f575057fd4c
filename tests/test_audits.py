"""Leak controls (V04, V05, V07), pandas equality (A17, C12), drift and streaming sanity."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from panelrank.operators import aggregates as A
from panelrank.operators import audit as V
from panelrank.operators.clean import minmax
from panelrank.plans import batch, q_audit


def test_window_overlap_flags_query_mix(spark):
    r = {x.field: x for x in q_audit.window_overlap(spark, SF001).collect()}
    assert r["query_mix"].status == "LEAK" and r["query_mix"].overlap_days == 365
    assert r["imp_prev"].status == "ok" and r["imp_prev"].overlap_days == 0


def test_single_feature_auc_finds_label_source(spark):
    r = {x.feature: x.auc_distance for x in q_audit.single_feature_auc(spark, SF01).collect()}
    assert max(r, key=r.get) == "trend_pct"


def test_label_determinism_flags_label_source(spark):
    r = {x.feature: x for x in q_audit.label_determinism(spark, SF01).collect()}
    assert r["trend_direction"].deterministic_share == 1.0 and r["trend_direction"].name_flag
    assert r["content_type"].deterministic_share < 0.5 and not r["content_type"].name_flag


def test_sealed_guard_passes_and_catches(spark):
    assert q_audit.sealed_guard(spark, SF001).first().status == "ok"
    d = spark.createDataFrame([("2020-01-01",), ("2020-02-01",)], "d string").select(F.col("d").cast("date").alias("d"))
    import datetime as dt
    assert V.sealed_guard(d, "d", dt.date(2020, 1, 15)).first().status == "LEAK"


def test_correlation_equals_pandas(spark):
    rows = [(float(i), float((i * 7) % 11) if i % 5 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "a double, b double")
    pdf = pd.DataFrame(rows, columns=["a", "b"])
    got = {r.method: r.corr for r in A.correlations(df, [("a", "b")], "pearson").unionByName(
        A.correlations(df, [("a", "b")], "spearman", rows_per_bucket=7)).collect()}
    assert got["pearson"] == pytest.approx(pdf["a"].corr(pdf["b"]))
    cc = pdf.dropna()  # pairwise complete, then Pearson of average ranks (no scipy here)
    assert got["spearman"] == pytest.approx(cc["a"].rank().corr(cc["b"].rank()))


def test_minmax_equals_reference_normalize(spark):
    rows = [(1, 3.0), (2, None), (3, float("inf")), (4, 7.0), (5, -1.0)]
    df = spark.createDataFrame(rows, "id long, x double")
    got = {r.id: r.n for r in minmax(df, "x", "n").collect()}
    s = pd.Series([3.0, float("nan"), float("inf"), 7.0, -1.0]).replace([math.inf], math.nan).fillna(0)
    exp = (s - s.min()) / (s.max() - s.min())
    assert [got[i] for i in range(1, 6)] == pytest.approx(list(exp))
    const = spark.createDataFrame([(1, 2.0), (2, 2.0)], "id long, x double")
    assert {r.n for r in minmax(const, "x", "n").collect()} == {0.0}


def test_drift_zero_for_same_period(spark):
    f = batch.features(spark, SF001)
    r = V.drift(f, f, ["impressions_90d"]).first()
    assert r.psi == pytest.approx(0.0, abs=1e-12) and r.status == "stable"


def test_group_median_equals_pandas(spark):
    f = batch.features(spark, SF001)
    got = {r.position_tier: r.median for r in A.group_stats(f, ["position_tier"], "ctr", rows_per_bucket=5).collect()}
    pdf = f.select("position_tier", "ctr").toPandas()
    exp = pdf.groupby("position_tier")["ctr"].median().to_dict()
    assert got == pytest.approx(exp)
