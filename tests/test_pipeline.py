"""Splits, models, final queue, sinks and guards."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from panelrank.operators import models as E
from panelrank.operators import split as L
from panelrank.plans import batch, q_models
from panelrank.sources import tables as T


def test_client_holdout_keeps_groups_whole(spark):
    f = batch.features(spark, SF001)
    s, strategy = L.client_holdout(f, "client_id", "is_declining_label")
    chk = L.split_check(s, "client_id", "is_declining_label").collect()
    assert strategy == "client_holdout"
    assert all(r.groups_on_both_sides == 0 for r in chk)
    assert {r.split for r in chk} == {"train", "test"}


def test_planted_leak_lifts_score(spark):
    r = {x.model: x for x in q_models.leak_probe(spark, SF001).collect()}
    assert r["with"].roc_auc > r["without"].roc_auc


def test_final_queue_ranks(spark):
    fq = q_models.final_queue_query(spark, SF001, forest_trees=20)
    n = batch.features(spark, SF001).count()
    r = fq.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("final_rank").alias("d"), F.min("final_rank").alias("lo"),
               F.max("final_rank").alias("hi"), F.min("final_refresh_score").alias("smin"),
               F.max("final_refresh_score").alias("smax")).first()
    assert (r.n, r.d, r.lo, r.hi) == (n, n, 1, n)
    assert 0 <= r.smin <= r.smax <= 100
    assert len(fq.columns) == 28


def test_sinks_round_trip(spark):
    q = batch.rule_queue(spark, SF001).select("content_id", "baseline_rank", F.array_join("reason_codes", "|").alias("rc"))
    out = tempfile.mkdtemp(prefix="pr-sink-", dir="/tmp")
    T.write_table(q, os.path.join(out, "csv"), "csv", max_rows=50, order_by=["baseline_rank"])
    back = T.read_csv(spark, os.path.join(out, "csv"))
    assert back.count() == q.count()
    parts = [p for p in os.listdir(os.path.join(out, "csv")) if p.endswith(".csv")]
    assert len(parts) >= q.count() // 50
    T.write_metrics(spark.createDataFrame([("rows", float(q.count()))], "metric string, value double"),
                    os.path.join(out, "metrics"))
    assert spark.read.json(os.path.join(out, "metrics")).count() == 1


def test_required_columns_guard(spark):
    df = spark.createDataFrame([(1,)], "content_id long")
    with pytest.raises(ValueError):
        T.input_profile(df, ["content_id", "client_id"])


def test_importance_names_align(spark):
    f = batch.features(spark, SF001)
    from panelrank import constants as K
    m = E.fit(f, K.MODEL_NUMERIC_FEATURES, K.MODEL_CATEGORICAL_FEATURES, E.tree("is_declining_label"),
              "is_declining_label")
    names = E.feature_names(m, f, K.MODEL_NUMERIC_FEATURES, K.MODEL_CATEGORICAL_FEATURES)
    assert len(names) == m.stages[-1].numFeatures


def test_run_pipeline_writes_all_outputs(spark):
    out = tempfile.mkdtemp(prefix="pr-run-", dir="/tmp")
    paths = batch.run_pipeline(spark, SF001, out, forest_trees=10)
    n = batch.features(spark, SF001).count()
    fq = spark.read.option("header", True).csv(paths["final_queue"])
    assert fq.count() == n
    assert spark.read.json(paths["metrics"]).count() == 4
    assert spark.read.parquet(paths["features"]).count() == n
    first = spark.read.option("header", True).csv(paths["baseline_queue"]).orderBy(F.col("baseline_rank").cast("int")).first()
    assert first.baseline_rank == "1"


def test_snapshot_csv_pipeline(spark):
    """A snapshot written as CSV, with repeated rows, gives the features of the tables and every output once."""
    out = tempfile.mkdtemp(prefix="pr-csv-", dir="/tmp")
    snap = batch.snapshot(spark, SF001)
    later = snap.filter("content_id % 3 = 0").withColumns({"client_id": F.lit("zz"), "impressions_90d": F.lit(7)})
    snap.unionByName(later).unionByName(snap.filter("content_id % 5 = 0")).write.option("header", True).csv(os.path.join(out, "in"))
    feats = batch.snapshot_features(spark, T.read_csv(spark, os.path.join(out, "in")), ["client_id"])
    want = batch.features(spark, SF001, materialize=False)
    cols = ["content_id", "client_id", "impressions_90d", "ctr", "trend_direction", "freshness_tier", "is_declining_label"]
    got = {tuple(r) for r in feats.select(F.col("content_id").cast("long"), *cols[1:]).collect()}
    assert got == {tuple(r) for r in want.select(*cols).collect()}
    paths = batch.run_pipeline(spark, None, os.path.join(out, "out"), forest_trees=5, feats=feats)
    n = len(got)
    ids = spark.read.option("header", True).csv(paths["final_queue"]).select("content_id")
    assert ids.count() == ids.distinct().count() == n
    res = spark.read.json(paths["results"]).first()
    assert (res.rows, res.train_rows + res.test_rows) == (n, n) and res.best_model and len(res.importances) > 0
    assert {r[0] for r in spark.read.json(paths["report"]).select("table_name").distinct().collect()} == {"action", "confidence", "trend", "reason"}
    with pytest.raises(ValueError):
        batch.run_pipeline(spark, None, os.path.join(out, "twice"), feats=feats.unionByName(feats))
