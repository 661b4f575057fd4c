"""End-to-end batch plans over the fixture views.

``features`` -> ``rule_queue`` -> models -> ``final_queue``: one Spark DAG;
only the feature vector and the scored frame are worth persisting.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelrank import constants as K
from panelrank.operators import clean as C
from panelrank.operators import ordered as O
from panelrank.operators import score as S
from panelrank.operators import windows as W
from panelrank.session import ensure_checkpoint_dir
from panelrank.sources import fixtures as fx
from panelrank.sources import tables as T

FX_WINDOW, FX_SPLIT = 730, 365


def snapshot(spark, sf_dir, daily=fx.fx_daily):
    """Raw page snapshot (A21) from a fixture daily fact and the content dimension."""
    return W.build_snapshot(daily(spark, sf_dir), fx.fx_content(spark, sf_dir),
                            end=fx.fx_last_day(spark, sf_dir), window=FX_WINDOW, split=FX_SPLIT)


def cleaned(spark, sf_dir, daily=fx.fx_daily):
    return C.clean_snapshot(snapshot(spark, sf_dir, daily))


def features(spark, sf_dir, materialize: bool = True, daily=fx.fx_daily):
    """Feature vector (C06-C10), checkpointed once into the shared checkpoint folder.

    Everything downstream (ranks, splits, three models, the queues) reads
    the written table instead of recomputing the daily aggregation.
    """
    f = C.prepare_features(cleaned(spark, sf_dir, daily))
    if materialize:
        ensure_checkpoint_dir(spark)
        f = f.checkpoint(eager=True)
    return f


def rule_queue(spark, sf_dir, feats=None, **kw):
    f = feats if feats is not None else features(spark, sf_dir)
    return S.baseline_queue(f, **kw)


def flagship(spark, sf_dir):
    from panelrank.plans import q_models
    return q_models.final_queue_query(spark, sf_dir)


def snapshot_features(spark, snap, order: list[str]):
    """Feature vector of a user's page snapshot, such as ``read_csv`` gives it.

    Required columns are checked, text is coerced, and of rows with the same content id the first by ``order``
    stays (compared after coercion; ties fall to the smallest row, so the result doesn't depend on file order).
    """
    T.require_columns(snap, K.REQUIRED_COLUMNS + list(order))
    f = C.prepare_features(C.clean_snapshot(snap), order=list(order))
    ensure_checkpoint_dir(spark)
    return f.checkpoint(eager=True)


def report_tables(fq):
    """Action, confidence, trend and reason mixes of a final queue (Q11), long format."""
    from panelrank.operators.aggregates import reason_counts
    mix = [fq.groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("count"))
           .select(F.lit(t).alias("table_name"), "value", "count")
           for t, c in (("action", "suggested_action"), ("confidence", "confidence"), ("trend", "trend_direction"))]
    mix.append(reason_counts(fq, "final_reason_codes").select(F.lit("reason").alias("table_name"),
                                                              F.col("reason_code").alias("value"), "count"))
    return reduce(DataFrame.unionByName, mix)


REPORT_REASONS, REPORT_PREVIEW = 12, 10


def report_preview(fq, rows: int = REPORT_PREVIEW):
    """The first rows of the queue with readable reasons and action labels (Q11, Q15)."""
    from panelrank.functions.exprs import short_action
    return fq.filter(F.col("final_rank") <= rows).select("final_rank", "content_id", F.array_join("final_reason_codes", ", ").alias("reasons"), "suggested_action",
                                                         short_action("suggested_action").alias("action_label"))


def report_reasons(fq, top: int = REPORT_REASONS):
    """The most frequent reason codes of the queue (A06, A08): a top-k table."""
    from panelrank.operators.aggregates import reason_counts
    return reason_counts(fq, "final_reason_codes").orderBy(F.col("count").desc(), "reason_code").limit(top)


def report_metrics(metrics, order: list[str]):
    """The metric table of the report: one row per model, the rule last, at three decimals (Q11)."""
    cols = ["roc_auc", "average_precision", "precision_at_50", "recall", "f1"]
    place = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model"))
    return metrics.select("model", *[F.round(c, 3).alias(c) for c in cols], F.when(place > 0, place).otherwise(len(order) + 1).alias("_o")).orderBy("_o", "model").drop("_o")


def run_pipeline(spark, sf_dir: str | None, out_dir: str, forest_trees: int = 200, feats=None) -> dict:
    """The whole job as one Spark program (the reference's five steps).

    features (Parquet, S10) -> rule queue (CSV, S08/S11) -> models, holdout metrics (JSON, S09) ->
    predictions (CSV) -> final queue (CSV) -> report tables, run results (JSON). Returns the output paths.
    ``feats`` are features built elsewhere (``snapshot_features``); without them the fixture views of ``sf_dir`` are
    used. Queues are written in rank order by a range-partitioned sort; no result passes through the driver.
    """
    from panelrank.operators import models as E
    from panelrank.plans import q_models
    paths = {k: os.path.join(out_dir, k) for k in
             ("features", "baseline_queue", "metrics", "predictions", "final_queue", "report", "report_preview", "report_reasons", "report_metrics", "results")}
    feats = feats if feats is not None else features(spark, sf_dir)
    C.assert_unique(feats, "content_id")
    T.write_table(feats, paths["features"], "parquet", max_rows=None)
    preds, metrics, best, model, _, enc, queue = q_models.train_and_score(spark, sf_dir, forest_trees, feats=feats)
    T.write_table(T.to_sink_text(queue.select(*S.BASELINE_QUEUE_COLUMNS), ["reason_codes"]),
                  paths["baseline_queue"], "csv", order_by=["baseline_rank"])
    T.write_metrics(metrics, paths["metrics"])
    T.write_table(preds, paths["predictions"], "csv")
    fq = S.final_queue(queue, preds, feats)
    fq = O.materialized(fq)
    T.write_table(T.to_sink_text(fq, ["final_reason_codes"]), paths["final_queue"], "csv", order_by=["final_rank"])
    T.write_metrics(report_tables(fq), paths["report"])
    T.write_metrics(report_preview(fq).orderBy("final_rank"), paths["report_preview"])
    T.write_metrics(report_reasons(fq), paths["report_reasons"])
    T.write_metrics(report_metrics(metrics, E.MODEL_NAMES), paths["report_metrics"])
    # importances: at most 25 names with a number each
    top = E.importance(model, E.feature_names(enc, feats, q_models.NUM, q_models.CAT))
    y = F.col(q_models.LABEL)
    results = preds.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("split") == "train").alias("train_rows"),
                        F.count_if(F.col("split") == "test").alias("test_rows"),
                        F.avg(y.cast("double")).alias("positive_rate")) \
        .withColumns({"best_model": F.lit(best), "features": F.array(*[F.lit(c) for c in q_models.NUM + q_models.CAT]),
                      "importances": F.array(*[F.struct(F.lit(n).alias("feature"), F.lit(float(v)).alias("importance"))
                                               for n, v in top])})
    T.write_metrics(results, paths["results"])
    return paths


if __name__ == "__main__":
    import argparse
    from panelrank.session import get_spark
    ap = argparse.ArgumentParser(description="Build the review queues from a panel or a page snapshot.")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--sf-dir", help="tables that the fixture views are derived from")
    src.add_argument("--snapshot-csv", help="page snapshot with a header, one row per content item")
    ap.add_argument("--first-by", nargs="+", default=["client_id"], help="columns that decide which duplicate is first")
    ap.add_argument("--out", required=True)
    ap.add_argument("--master", default=None)
    a = ap.parse_args()
    spark = get_spark(a.master)
    own = snapshot_features(spark, T.read_csv(spark, a.snapshot_csv), a.first_by) if a.snapshot_csv else None
    print(run_pipeline(spark, a.sf_dir, a.out, feats=own))
