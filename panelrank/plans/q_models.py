"""Registered queries: learned scores, final queue, capstone playbook.

Model outputs have no SQL equivalent, so these are rows-only checks; the
blend / codes / action / confidence logic is also registered with an oracle
on a deterministic stand-in probability (``final_queue_blend``).
"""

from __future__ import annotations

from contextlib import nullcontext
from functools import reduce
from threading import Lock

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelrank import constants as K
from panelrank.operators import joins as J
from panelrank.operators import metrics as M
from panelrank.operators import models as E
from panelrank.operators import ordered as O
from panelrank.operators import score as S
from panelrank.operators import split as L
from panelrank.operators import validate as CV
from panelrank.plans import batch
from panelrank.plans import sql_common as Q
from panelrank.plans import warehouse
from panelrank.plans.registry import register

LABEL = "is_declining_label"
NUM, CAT = K.MODEL_NUMERIC_FEATURES, K.MODEL_CATEGORICAL_FEATURES


def _concurrent(fn, items):
    """Run independent Spark jobs from a small thread pool; results in input order."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=max(1, len(items))) as pool:
        return list(pool.map(fn, items))


def train_and_score(spark, sf_dir, forest_trees: int = 200, refit: bool = True, feats=None):
    """Split, holdout metrics (rule and three models), choice, refit on all rows, scores.

    The one-hot encoding is fitted once and the encoded matrix written once;
    every model fits on a subset of it. Holdout metrics are on the test
    side, all four scores in one grouped pass; the published probabilities are in-sample (models refit on all
    rows), flagged ``scored_in_sample``. The two rounds of fits don't depend on each other, so their jobs run together.
    Returns (predictions, metrics, best name, fitted best model, features, encoder, rule queue).
    """
    feats = feats if feats is not None else batch.features(spark, sf_dir)
    split, strategy = L.client_holdout(feats, "client_id", LABEL)
    enc, mat = E.fit_matrix(split, NUM, CAT, LABEL, ["content_id", "client_id", "split"])
    train = mat.filter(F.col("split") == "train")
    test = mat.filter(F.col("split") == "test")
    n = mat.agg(F.count(F.lit(1)).alias("all"), F.count_if(F.col("split") == "train").alias("train")).first()

    turn = Lock()  # forests on many rows are fitted one after another, so the executors hold the rows of one

    def job(item):
        kind, name, stages = item
        if kind == "queue":
            return O.materialized(batch.rule_queue(spark, sf_dir, feats))
        rows, of = (n["train"], train) if kind == "holdout" else (n["all"], mat)
        with turn if E.parted(stages, rows) else nullcontext():
            return E.fit_on_matrix(of, stages, LABEL, rows)

    items = [("queue", "baseline", None), *[("holdout", m, st) for m, st in E.build_models(n["train"], LABEL, forest_trees).items()]]
    if refit:
        items += [("refit", m, st) for m, st in E.build_models(n["all"], LABEL, forest_trees).items()]
    done = dict(zip([(kind, name) for kind, name, _ in items], _concurrent(job, items)))
    queue = done["queue", "baseline"]
    # Rule score looked up on test ids, missing -> 0
    rule = J.lookup(test.select("content_id", LABEL), queue, "content_id", "baseline_refresh_score")
    scores = [rule.select(F.lit("baseline").alias("model"), "content_id", LABEL, F.col("baseline_refresh_score").alias("_p"))]
    scores += [E.score_matrix(done["holdout", m], test, "_p").select(F.lit(m).alias("model"), "content_id", LABEL, "_p") for m in E.MODEL_NAMES]
    metrics = O.materialized(M.metric_rows(reduce(DataFrame.unionByName, scores), LABEL, "_p", "content_id").withColumn("split_strategy", F.lit(strategy)))
    best = M.best_model(metrics.filter(F.col("model") != "baseline"), E.MODEL_NAMES).first()["model"]
    if not refit:
        return None, metrics, best, None, feats, enc, queue
    preds = mat
    for name in E.MODEL_NAMES:
        preds = E.add_score(done["refit", name], preds, f"prob_{name}")
    # the scored frame feeds the blend, quantiles and ranks: written once, so no model is re-applied per job
    preds = O.materialized(preds.select("content_id", "client_id", F.col(LABEL).cast("int").alias(LABEL), "split",
                                        *[f"prob_{n}" for n in E.MODEL_NAMES],
                                        F.lit(best).alias("best_model_name"), F.col(f"prob_{best}").alias("best_model_probability"),
                                        F.lit(True).alias("scored_in_sample")))
    return preds, metrics, best, done["refit", best], feats, enc, queue


@register("model_comparison")
def model_comparison(spark, sf_dir):
    """M09 + E08: rule and three models on the same client holdout."""
    _, metrics, _, _, _, _, _ = train_and_score(spark, sf_dir, refit=False)
    return metrics


@register("predictions")
def predictions(spark, sf_dir):
    """E07 + E09: in-sample probabilities of every model, split tag and best model."""
    preds, _, _, _, _, _, _ = train_and_score(spark, sf_dir)
    return preds


def final_queue_query(spark, sf_dir, forest_trees: int = 200):
    preds, _, _, _, feats, _, queue = train_and_score(spark, sf_dir, forest_trees)
    fq = S.final_queue(queue, preds, feats)
    return fq.withColumn("final_reason_codes", F.array_join("final_reason_codes", "|"))


@register("final_queue")
def final_queue(spark, sf_dir):
    """Q06-Q10: the final review queue (28 columns) from rule + best model."""
    return final_queue_query(spark, sf_dir)


@register("feature_importance")
def feature_importance(spark, sf_dir):
    """Top 25 |coef| or impurity importances of the chosen model."""
    _, _, best, model, feats, enc, _ = train_and_score(spark, sf_dir)
    names = E.feature_names(enc, feats, NUM, CAT)
    top = E.importance(model, names)
    return spark.createDataFrame([(best, n, float(v)) for n, v in top], "model string, feature string, importance double")


def _slots_sql():
    num = [f"SELECT {i} AS slot, '{c}' AS name, SUM(COALESCE(CAST({c} AS DOUBLE), 0)) AS total FROM fx_features" for i, c in enumerate(NUM)]
    cat = [f"SELECT {j} AS c, '{c}' AS col, COALESCE({c}, 'unknown') AS lv, COUNT(*) AS n FROM fx_features GROUP BY ALL" for j, c in enumerate(CAT)]
    none = [f"SELECT {j}, '{c}', NULL, 0" for j, c in enumerate(CAT)]  # the slot of levels that the fit has not seen
    return Q.chain(upto="features") + f"""
, lv AS ({" UNION ALL ".join(cat + none)}),
sl AS ({" UNION ALL ".join(num)} UNION ALL
       SELECT {len(NUM) - 1} + row_number() OVER (ORDER BY c, lv NULLS LAST), col || '=' || COALESCE(lv, '__invalid__'), n FROM lv)
SELECT CAST(slot AS INTEGER) AS slot, name, round(CAST(total AS DOUBLE), 4) AS total FROM sl"""


@register("matrix_slots", _slots_sql())
def matrix_slots(spark, sf_dir):
    """Every slot of the encoded matrix by name, with its sum over all rows."""
    feats = batch.features(spark, sf_dir)
    enc, mat = E.fit_matrix(feats, NUM, CAT, LABEL, [])
    return E.slot_sums(enc, mat, E.feature_names(enc, feats, NUM, CAT)).withColumn("total", F.round("total", 4))


@register("readable_tree_leaves")
def readable_tree_leaves(spark, sf_dir):
    """Depth-2 tree on six readable inputs, one row per leaf."""
    feats = batch.features(spark, sf_dir)
    m = E.fit(feats, K.SMALL_TREE_FEATURES, [], E.tree(LABEL, depth=2, leaf=1), LABEL)
    return E.leaf_table(m, feats, K.SMALL_TREE_FEATURES, [], LABEL)


@register("boosted_metrics")
def boosted_metrics(spark, sf_dir):
    """Gradient-boosted trees on the same client holdout."""
    feats = batch.features(spark, sf_dir)
    split, _ = L.client_holdout(feats, "client_id", LABEL)
    m = E.fit(split.filter("split = 'train'"), NUM, CAT, E.boosted(LABEL, depth=4, iters=30), LABEL)
    s = E.score(m, split.filter("split = 'test'"), NUM, CAT, "_p")
    return M.metric_row(s, LABEL, "_p", "content_id", "gbt")


@register("leak_probe")
def leak_probe(spark, sf_dir):
    """Planted leak (trend_pct, the label source) must lift the score."""
    feats = batch.features(spark, sf_dir)
    split, _ = L.client_holdout(feats, "client_id", LABEL)
    base = ["content_age_days", "days_since_last_update", "avg_position", "ctr", "word_count"]
    return E.leak_probe(split.filter("split = 'train'"), split.filter("split = 'test'"), base, "trend_pct", LABEL,
                        "content_id")


@register("split_gap")
def split_gap(spark, sf_dir):
    """Same model on a random row split and on the client split; the gap is the leak of grouping."""
    feats = batch.features(spark, sf_dir)
    out = []
    for name, df in (("stratified_row", L.stratified_holdout(feats, LABEL, 0.2)),
                     ("client_group", L.client_holdout(feats, "client_id", LABEL)[0])):
        m = E.fit(df.filter("split = 'train'"), NUM, CAT, E.tree(LABEL), LABEL)
        s = E.score(m, df.filter("split = 'test'"), NUM, CAT, "_p")
        out.append(M.roc_auc(s, LABEL, "_p").select(F.lit(name).alias("split"), "roc_auc"))
    return reduce(DataFrame.unionByName, out)


@register("permutation_importance")
def permutation_importance(spark, sf_dir):
    """AUC drop of every one of the 26 inputs when its values are exchanged between rows."""
    feats = batch.features(spark, sf_dir)
    m = E.fit(feats, NUM, CAT, E.tree(LABEL), LABEL)
    return E.permutation_importance(m, feats, NUM, CAT, LABEL, "content_id")


FOLDS = 5


def _cross_validated(spark, sf_dir):
    folded = L.group_folds(batch.features(spark, sf_dir), "client_id", FOLDS)
    candidates = {"logistic_regression": E.logistic(folded.count(), LABEL), "tree_depth_3": E.tree(LABEL, depth=3), "tree_depth_5": E.tree(LABEL, depth=5)}
    return CV.cross_validate(folded, NUM, CAT, candidates, LABEL, "fold", FOLDS, ["content_id", "client_id"], "content_id")


@register("cross_validation")
def cross_validation(spark, sf_dir):
    """L05 + E07: three candidates over five client folds: rows, positives, AUC and P@50 out of fold, and the choice."""
    _, per_fold, best = _cross_validated(spark, sf_dir)
    return per_fold.withColumn("chosen", F.col("candidate") == best)


@register("out_of_fold_predictions")
def out_of_fold_predictions(spark, sf_dir):
    """L05 + E07: the chosen candidate's score of every row by the model that saw no row of its client."""
    scores, _, best = _cross_validated(spark, sf_dir)
    return scores.filter(F.col("candidate") == best)


# ---------------------------------------------------------------- capstone (window model)
def capstone(spark, sf_dir):
    """Decline table -> group shuffle split (25 % of clients) -> forest 100 x depth 7 -> scores."""
    from panelrank.plans.q_windows import decline_frame
    return warehouse.score_capstone(O.materialized(decline_frame(spark, sf_dir)))[0]


@register("capstone_playbook")
def capstone_playbook(spark, sf_dir):
    """Q14: at-risk pages (prev > 500, p > 0.6), reason by position, ordered by probability. The plain fixture's windows hold
    fewer impressions than the rule asks for, so this is empty there; ``busy_playbook`` reaches the rule."""
    return warehouse.capstone_playbook(capstone(spark, sf_dir)).orderBy(F.col("decline_probability").desc(), F.col("content_id"))


@register("capstone_report")
def capstone_report(spark, sf_dir):
    """M06 + M02 on the capstone test side."""
    return warehouse.capstone_report(capstone(spark, sf_dir))


# ---------------------------------------------------------------- blend with an oracle
def blend_frame(spark, sf_dir, feats=None):
    feats = feats if feats is not None else batch.features(spark, sf_dir)
    q = batch.rule_queue(spark, sf_dir, feats)
    p = O.pct_rank(feats.select("content_id", "impressions_prev_30d"), "impressions_prev_30d", "best_model_probability")
    preds = p.select("content_id", F.lit("momentum_stand_in").alias("best_model_name"), "best_model_probability")
    return S.final_queue(q, preds, feats)


BLEND_CTE = f"""
    fb_0 AS (SELECT *, {Q.pct_rank_sql('impressions_prev_30d', 'best_model_probability')} FROM fx_baseline),
    fb_1 AS (SELECT *, CASE WHEN max(baseline_refresh_score) OVER () > min(baseline_refresh_score) OVER ()
                 THEN (baseline_refresh_score - min(baseline_refresh_score) OVER ())
                      / (max(baseline_refresh_score) OVER () - min(baseline_refresh_score) OVER ()) ELSE 0.0 END AS bnorm
             FROM fb_0),
    fb_2 AS (SELECT *, least(greatest(100.0 * (0.7 * best_model_probability + 0.3 * bnorm), 0.0), 100.0) AS final_refresh_score,
                 concat_ws('|', reason_codes,
                   CASE WHEN best_model_probability >= 0.65 THEN 'model_decline_risk' END,
                   CASE WHEN best_model_probability >= 0.5 AND impressions_90d >= 500 THEN 'visible_model_opportunity' END,
                   CASE WHEN impressions_90d >= 500 AND avg_position > 0 AND avg_position <= 20 AND ctr < 0.5
                        THEN 'ctr_review_candidate' END,
                   CASE WHEN sessions_90d >= 30 AND ((engagement_rate > 0 AND engagement_rate < 30)
                                                     OR (scroll_rate > 0 AND scroll_rate < 30))
                        THEN 'engagement_review_candidate' END) AS final_reason_codes
             FROM fb_1),
    fb_3 AS (SELECT *, string_split(final_reason_codes, '|') AS codes FROM fb_2),
    fb_q AS (SELECT quantile_cont(final_refresh_score, 0.8) AS hi, quantile_cont(final_refresh_score, 0.5) AS mid FROM fb_3),
    fb_4 AS (SELECT fb_3.*,
        CASE WHEN list_contains(codes, 'thin_visible_page') THEN 'expand_and_refresh'
             WHEN list_contains(codes, 'ctr_review_candidate') AND (list_contains(codes, 'model_decline_risk')
                  OR list_contains(codes, 'declining_with_demand')) THEN 'refresh_and_review_ctr'
             WHEN list_contains(codes, 'engagement_review_candidate') AND (list_contains(codes, 'model_decline_risk')
                  OR list_contains(codes, 'declining_with_demand')) THEN 'refresh_and_review_engagement'
             WHEN list_contains(codes, 'model_decline_risk') OR list_contains(codes, 'declining_with_demand')
                  OR list_contains(codes, 'stale_visible_page') OR list_contains(codes, 'visible_model_opportunity')
                  THEN 'refresh' ELSE 'monitor' END AS suggested_action,
        CASE WHEN final_refresh_score >= hi AND impressions_90d >= 500 AND sessions_90d >= 10
                  AND best_model_probability >= 0.5 THEN 'high'
             WHEN final_refresh_score >= mid THEN 'medium' ELSE 'low' END AS confidence,
        row_number() OVER (ORDER BY final_refresh_score DESC, impressions_90d DESC, sessions_90d DESC, content_id ASC)
          AS final_rank
      FROM fb_3, fb_q)"""
BLEND_SQL = Q.chain(BLEND_CTE)

BLEND_COLS = [c for c in S.FINAL_QUEUE_COLUMNS if c != "best_model_name"]
BLEND_SELECT = "SELECT " + ", ".join(
    f"round({c}, 9) AS {c}" if c in ("final_refresh_score", "best_model_probability") else c for c in BLEND_COLS) + " FROM fb_4"


@register("final_queue_blend", BLEND_SQL + BLEND_SELECT)
def final_queue_blend(spark, sf_dir):
    """Q06-Q10 + J02 under the oracle: blend, merged codes, action, confidence, final rank."""
    return blend_out(blend_frame(spark, sf_dir))


def blend_out(fq):
    return fq.select(*[F.array_join(c, "|").alias(c) if c == "final_reason_codes"
                       else F.round(c, 9).alias(c) if c in ("final_refresh_score", "best_model_probability")
                       else F.col(c) for c in BLEND_COLS])


@register("report_tables", BLEND_SQL + """
SELECT 'action' AS table_name, suggested_action AS value, COUNT(*) AS count FROM fb_4 GROUP BY 2
UNION ALL SELECT 'confidence', confidence, COUNT(*) FROM fb_4 GROUP BY 2
UNION ALL SELECT 'trend', trend_direction, COUNT(*) FROM fb_4 GROUP BY 2
UNION ALL SELECT 'reason', code, COUNT(*) FROM (SELECT unnest(codes) AS code FROM fb_4) GROUP BY 2""")
def report_tables(spark, sf_dir):
    """Q11 + A06/A08: action, confidence, trend and reason mixes of the final queue (long format)."""
    return batch.report_tables(blend_frame(spark, sf_dir))


@register("queue_preview", BLEND_SQL + """
SELECT final_rank, content_id, replace(final_reason_codes, '|', ', ') AS reasons, suggested_action,
  CASE suggested_action WHEN 'expand_and_refresh' THEN 'Expand + refresh' WHEN 'refresh_and_review_ctr' THEN 'Refresh + CTR'
    WHEN 'refresh_and_review_engagement' THEN 'Refresh + engagement' WHEN 'refresh' THEN 'Refresh'
    WHEN 'monitor' THEN 'Monitor' ELSE suggested_action END AS action_label
FROM fb_4 WHERE final_rank <= 10""")
def queue_preview(spark, sf_dir):
    """Q11 preview + Q15 short labels: top 10 rows with ``|`` shown as ``, ``."""
    return batch.report_preview(blend_frame(spark, sf_dir))


@register("report_reasons", BLEND_SQL + """
SELECT code AS reason_code, COUNT(*) AS count FROM (SELECT unnest(codes) AS code FROM fb_4) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 12""")
def report_reasons(spark, sf_dir):
    """Q11 + A08: the twelve most frequent reason codes (a top-k table: the limit is the feature)."""
    return batch.report_reasons(blend_frame(spark, sf_dir))


@register("queue_summary", BLEND_SQL + """
, t AS (SELECT COALESCE(AVG(CASE WHEN final_rank <= 50 THEN CAST(is_declining_label AS DOUBLE) END), 0.0) AS rate_top_50 FROM fb_4)
SELECT COUNT(*) AS rows, CAST(SUM(is_declining_label) AS BIGINT) AS positive_rows,
  AVG(CAST(is_declining_label AS DOUBLE)) AS positive_rate, round(MAX(final_refresh_score), 9) AS top_score,
  round(quantile_cont(final_refresh_score, 0.5), 9) AS median_score, MAX(t.rate_top_50) AS rate_top_50
FROM fb_4, t""")
def queue_summary(spark, sf_dir):
    """A10: rows, positives, rate, max and median score, top-50 positive rate of the queue."""
    from panelrank.operators.aggregates import summary
    fq = blend_frame(spark, sf_dir)
    s = summary(fq, LABEL, "final_refresh_score", 50, "content_id")
    return s.select("rows", "positive_rows", "positive_rate", F.round("top_score", 9).alias("top_score"),
                    F.round("median_score", 9).alias("median_score"), "rate_top_50")


@register("calibration", BLEND_SQL + """
SELECT CAST(least(floor(best_model_probability * 10), 9) AS INTEGER) AS bin, COUNT(*) AS n,
  round(AVG(best_model_probability), 9) AS mean_score, AVG(CAST(is_declining_label AS DOUBLE)) AS positive_rate
FROM fb_4 GROUP BY 1""")
def calibration(spark, sf_dir):
    """Calibration bins of the blended probability against the label."""
    c = M.calibration(blend_frame(spark, sf_dir), LABEL, "best_model_probability")
    return c.select("bin", "n", F.round("mean_score", 9).alias("mean_score"), "positive_rate")


@register("bootstrap_diff", BLEND_SQL + f"""
, d AS (SELECT content_id, CAST(CAST(best_model_probability >= 0.5 AS INTEGER) = is_declining_label AS INTEGER)
               - CAST(CAST(bnorm >= 0.5 AS INTEGER) = is_declining_label AS INTEGER) AS d FROM fb_4),
u AS (SELECT rep, d, CAST('0x' || substr(md5(concat_ws('|', content_id, rep, 42)), 1, 13) AS BIGINT) / 4503599627370496 AS u
      FROM d, range(1, 201) t(rep)),
w AS (SELECT rep, d, len([e FOR e IN {M.poisson_edges()} IF u >= e]) AS w FROM u),
s AS (SELECT rep, SUM(w * d) / SUM(w) AS diff FROM w GROUP BY rep)
SELECT round(AVG(diff), 9) AS mean_diff, round(quantile_cont(diff, 0.025), 9) AS lo, round(quantile_cont(diff, 0.975), 9) AS hi, COUNT(*) AS reps
FROM s""")
def bootstrap_diff(spark, sf_dir):
    """Bootstrap interval (Poisson weights, 200 replicates) of an accuracy difference:
    blended probability vs the normalized rule score, cut 0.5."""
    fq = blend_frame(spark, sf_dir)
    from panelrank.operators.clean import minmax
    fq = minmax(fq, "baseline_refresh_score", "_rule_p")
    r = M.bootstrap_diff(fq, LABEL, "best_model_probability", "_rule_p", "content_id", reps=200)
    return r.select(*[F.round(c, 9).alias(c) for c in ("mean_diff", "lo", "hi")], "reps")


@register("notebook_model_report")
def notebook_model_report(spark, sf_dir):
    """Warehouse-notebook variant: prev-window + query-mix inputs, C23 drop blanks, stratified 25 % row
    split (L02), forest 200 trees with MLlib's deepest trees (30), class report, AUC and majority rate (E12)."""
    from panelrank.plans.q_windows import decline_frame
    return warehouse.notebook_report(decline_frame(spark, sf_dir))


@register("readable_tree_text")
def readable_tree_text(spark, sf_dir):
    """Depth-2 and depth-4 trees printed (one row per line, feature slots named)."""
    feats = batch.features(spark, sf_dir)
    cols = K.SMALL_TREE_FEATURES
    rows = []
    for depth in (2, 4):
        m = E.fit(feats, cols, [], E.tree(LABEL, depth=depth, leaf=1), LABEL)
        text = m.stages[-1].toDebugString
        for i, c in enumerate(cols):
            text = text.replace(f"feature {i} ", f"{c} ")
        rows += [(depth, n, line) for n, line in enumerate(text.splitlines())]
    return spark.createDataFrame(rows, "depth int, line_no int, line string")
