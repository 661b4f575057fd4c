"""Registered queries: metrics and splits on the scored fixture.

``fx_scored``: every content item of the two-window table (no floor),
score = floor(prev / 25) (many ties), label = last < 0.8 prev.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from panelrank.operators import metrics as M
from panelrank.operators import ordered as O
from panelrank.operators import sketches as SK
from panelrank.operators import split as L
from panelrank.operators import validate as CV
from panelrank.operators import windows as W
from panelrank.plans.registry import register
from panelrank.sources import fixtures as fx

FX_WINDOW, FX_SPLIT = 730, 365
CUT = 6  # score cut for the threshold metrics on the fixture (score in 0..13)
R9 = 9

SCORED_SQL = fx.with_sql("fx_daily", extra=[f"""
    sc_b AS (SELECT MAX(report_date) AS end_d FROM fx_daily),
    sc_tw AS (
      SELECT client_id, content_id,
        CAST(SUM(CASE WHEN report_date >  b.end_d - {FX_SPLIT} THEN impressions ELSE 0 END) AS BIGINT) AS imp_last,
        CAST(SUM(CASE WHEN report_date <= b.end_d - {FX_SPLIT} THEN impressions ELSE 0 END) AS BIGINT) AS imp_prev
      FROM fx_daily, sc_b b WHERE report_date > b.end_d - {FX_WINDOW} GROUP BY 1, 2),
    fx_scored AS (
      SELECT content_id, client_id, CAST(floor(imp_prev / 25) AS BIGINT) AS score,
             CAST(imp_last < 0.8 * imp_prev AS INTEGER) AS label
      FROM sc_tw)"""])


def scored(spark, sf_dir):
    tw = W.two_window(fx.fx_daily(spark, sf_dir), ["client_id", "content_id"], end=fx.fx_last_day(spark, sf_dir), window=FX_WINDOW, split=FX_SPLIT,
                      avgs={}, min_prev=None)
    tw = W.window_label(tw, out="label")
    return tw.select("content_id", "client_id", F.floor(F.col("imp_prev") / 25).cast("long").alias("score"), "label")


def _d(x):
    return f"CAST({x} AS DOUBLE)"


@register("scored_fixture", SCORED_SQL + "SELECT * FROM fx_scored")
def scored_fixture(spark, sf_dir):
    """The scored fixture itself (anchor: 2,000 rows, 14 scores, 774 positives at sf0.01)."""
    return scored(spark, sf_dir)


@register("threshold_metrics", SCORED_SQL + f"""
, c AS (SELECT COUNT(*) FILTER (WHERE score >= {CUT} AND label = 1) AS tp,
              COUNT(*) FILTER (WHERE score >= {CUT} AND label <> 1) AS fp,
              COUNT(*) FILTER (WHERE score < {CUT} AND label <> 1) AS tn,
              COUNT(*) FILTER (WHERE score < {CUT} AND label = 1) AS fn FROM fx_scored)
SELECT tp + fp + tn + fn AS n,
  COALESCE({_d('tp + tn')} / NULLIF({_d('tp + fp + tn + fn')}, 0), 0.0) AS accuracy,
  COALESCE({_d('tp')} / NULLIF({_d('tp + fp')}, 0), 0.0) AS precision,
  COALESCE({_d('tp')} / NULLIF({_d('tp + fn')}, 0), 0.0) AS recall,
  COALESCE({_d('2 * tp')} / NULLIF({_d('2 * tp + fp + fn')}, 0), 0.0) AS f1
FROM c""")
def threshold_metrics(spark, sf_dir):
    """Accuracy / precision / recall / F1 at a cut, 0/0 -> 0."""
    return M.threshold_metrics(scored(spark, sf_dir), "label", "score", cut=CUT)


@register("segment_metrics", SCORED_SQL + f"""
, c AS (SELECT client_id, COUNT(*) FILTER (WHERE score >= {CUT} AND label = 1) AS tp,
              COUNT(*) FILTER (WHERE score >= {CUT} AND label <> 1) AS fp,
              COUNT(*) FILTER (WHERE score < {CUT} AND label <> 1) AS tn,
              COUNT(*) FILTER (WHERE score < {CUT} AND label = 1) AS fn FROM fx_scored GROUP BY client_id)
SELECT client_id, tp + fp + tn + fn AS n,
  COALESCE({_d('tp + tn')} / NULLIF({_d('tp + fp + tn + fn')}, 0), 0.0) AS accuracy,
  COALESCE({_d('tp')} / NULLIF({_d('tp + fp')}, 0), 0.0) AS precision,
  COALESCE({_d('tp')} / NULLIF({_d('tp + fn')}, 0), 0.0) AS recall,
  COALESCE({_d('2 * tp')} / NULLIF({_d('2 * tp + fp + fn')}, 0), 0.0) AS f1
FROM c""")
def segment_metrics(spark, sf_dir):
    """M01 per client segment with n."""
    return M.segment_metrics(scored(spark, sf_dir), "label", "score", ["client_id"], cut=CUT)


AUC_BODY = """
, s AS (SELECT {by_sel} CAST(score AS DOUBLE) AS s, COUNT(*) FILTER (WHERE label = 1) AS pos,
              COUNT(*) FILTER (WHERE label <> 1) AS neg FROM fx_scored GROUP BY {by_grp} 2),
c AS (SELECT *, COALESCE(SUM(neg) OVER ({part} ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb
      FROM s)
SELECT {by_sel} CASE WHEN SUM(pos) = 0 OR SUM(neg) = 0 THEN 0.0
  ELSE CAST(SUM(2 * pos * nb + pos * neg) AS DOUBLE) / (CAST(2 AS DOUBLE) * CAST(SUM(pos) AS DOUBLE) * CAST(SUM(neg) AS DOUBLE)) END AS roc_auc
FROM c {grp}"""


@register("roc_auc", SCORED_SQL + AUC_BODY.format(by_sel="", by_grp="", part="", grp="").replace("GROUP BY  2", "GROUP BY 1"))
def roc_auc(spark, sf_dir):
    """ROC AUC by rank-sum over distinct scores (exact integer numerator)."""
    return M.roc_auc(scored(spark, sf_dir), "label", "score")


@register("roc_auc_by_client", SCORED_SQL + AUC_BODY.format(by_sel="client_id,", by_grp="1,", part="PARTITION BY client_id",
                                                             grp="GROUP BY client_id").replace("GROUP BY 1, 2", "GROUP BY 1, 2"))
def roc_auc_by_client(spark, sf_dir):
    """M02 grouped (also the shape of V07): AUC per client."""
    return M.roc_auc(scored(spark, sf_dir), "label", "score", by=["client_id"])


@register("average_precision", SCORED_SQL + f"""
, s AS (SELECT CAST(score AS DOUBLE) AS s, COUNT(*) FILTER (WHERE label = 1) AS pos,
              COUNT(*) FILTER (WHERE label <> 1) AS neg FROM fx_scored GROUP BY 1),
c AS (SELECT *, SUM(pos) OVER (ORDER BY s DESC) AS tp, SUM(neg) OVER (ORDER BY s DESC) AS fp FROM s)
SELECT round(CASE WHEN SUM(pos) = 0 OR SUM(neg) = 0 THEN 0.0
  ELSE SUM(CAST(pos AS DOUBLE) * tp / (tp + fp)) / SUM(pos) END, {R9}) AS average_precision FROM c""")
def average_precision(spark, sf_dir):
    """Step-sum average precision over distinct thresholds."""
    ap = M.average_precision(scored(spark, sf_dir), "label", "score")
    return ap.select(F.round("average_precision", R9).alias("average_precision"))


@register("precision_at_k", SCORED_SQL + """
, r AS (SELECT label, row_number() OVER (ORDER BY score DESC, content_id ASC) AS rn FROM fx_scored)
SELECT COALESCE(AVG(CASE WHEN rn <= 20 THEN CAST(label AS DOUBLE) END), 0.0) AS precision_at_20,
       COALESCE(AVG(CASE WHEN rn <= 50 THEN CAST(label AS DOUBLE) END), 0.0) AS precision_at_50,
       COALESCE(AVG(CASE WHEN rn <= 100 THEN CAST(label AS DOUBLE) END), 0.0) AS precision_at_100
FROM r""")
def precision_at_k(spark, sf_dir):
    """P@20/50/100, ties by id, k capped at n."""
    return M.precision_at_k(scored(spark, sf_dir), "label", "score", "content_id")


@register("precision_at_k_ties", SCORED_SQL + """
, r AS (SELECT score, row_number() OVER (ORDER BY score DESC, content_id ASC) AS rn FROM fx_scored),
k AS (SELECT MIN(score) AS sk FROM r WHERE rn <= 50),
c AS (SELECT COUNT(*) FILTER (WHERE score > sk) AS a, SUM(CASE WHEN score > sk THEN label ELSE 0 END) AS pa,
             COUNT(*) FILTER (WHERE score = sk) AS t, SUM(CASE WHEN score = sk THEN label ELSE 0 END) AS pt,
             COUNT(*) AS n FROM fx_scored, k)
SELECT 50 AS k, COALESCE((pa + (least(50, n) - a) * (CAST(pt AS DOUBLE) / NULLIF(CAST(t AS DOUBLE), 0)))
                 / least(50, n), 0.0) AS expected_precision_at_k FROM c""")
def precision_at_k_ties(spark, sf_dir):
    """Tie-aware expected P@50."""
    return M.precision_at_k_ties(scored(spark, sf_dir), "label", "score", 50, "content_id")


@register("class_report", SCORED_SQL + f"""
, c AS (SELECT COUNT(*) FILTER (WHERE score >= {CUT} AND label = 1) AS tp,
              COUNT(*) FILTER (WHERE score >= {CUT} AND label <> 1) AS fp,
              COUNT(*) FILTER (WHERE score < {CUT} AND label <> 1) AS tn,
              COUNT(*) FILTER (WHERE score < {CUT} AND label = 1) AS fn FROM fx_scored),
k AS (
  SELECT '1' AS class, COALESCE({_d('tp')} / NULLIF({_d('tp + fp')}, 0), 0.0) AS precision,
         COALESCE({_d('tp')} / NULLIF({_d('tp + fn')}, 0), 0.0) AS recall,
         COALESCE({_d('2 * tp')} / NULLIF({_d('2 * tp + fp + fn')}, 0), 0.0) AS f1, tp + fn AS support FROM c
  UNION ALL
  SELECT '0', COALESCE({_d('tn')} / NULLIF({_d('tn + fn')}, 0), 0.0),
         COALESCE({_d('tn')} / NULLIF({_d('tn + fp')}, 0), 0.0),
         COALESCE({_d('2 * tn')} / NULLIF({_d('2 * tn + fn + fp')}, 0), 0.0), tn + fp FROM c)
SELECT class, round(precision, {R9}) AS precision, round(recall, {R9}) AS recall, round(f1, {R9}) AS f1, support FROM k
UNION ALL SELECT 'accuracy', NULL, NULL, round(COALESCE({_d('tp + tn')} / NULLIF({_d('tp + fp + tn + fn')}, 0), 0.0), {R9}),
  tp + fp + tn + fn FROM c
UNION ALL SELECT 'macro avg', round(AVG(precision), {R9}), round(AVG(recall), {R9}), round(AVG(f1), {R9}),
  CAST(SUM(support) AS BIGINT) FROM k
UNION ALL SELECT 'weighted avg', round(SUM(precision * support) / SUM(support), {R9}),
  round(SUM(recall * support) / SUM(support), {R9}), round(SUM(f1 * support) / SUM(support), {R9}),
  CAST(SUM(support) AS BIGINT) FROM k""")
def class_report(spark, sf_dir):
    """Per-class P/R/F1/support, accuracy, macro and weighted averages."""
    s = scored(spark, sf_dir).withColumn("pred", (F.col("score") >= CUT).cast("int"))
    r = M.class_report(s, "label", "pred")
    return r.select("class", *[F.round(c, R9).alias(c) for c in ("precision", "recall", "f1")], "support")


@register("roc_points", SCORED_SQL + """
, s AS (SELECT CAST(score AS DOUBLE) AS s, COUNT(*) FILTER (WHERE label = 1) AS pos,
              COUNT(*) FILTER (WHERE label <> 1) AS neg FROM fx_scored GROUP BY 1),
t AS (SELECT SUM(pos) AS P, SUM(neg) AS N FROM s),
c AS (SELECT s, SUM(pos) OVER (ORDER BY s DESC) AS tp, SUM(neg) OVER (ORDER BY s DESC) AS fp FROM s)
SELECT CAST('inf' AS DOUBLE) AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
UNION ALL SELECT s, CAST(fp AS DOUBLE) / CAST(N AS DOUBLE), CAST(tp AS DOUBLE) / CAST(P AS DOUBLE) FROM c, t""")
def roc_points(spark, sf_dir):
    """ROC points per distinct threshold plus the origin."""
    return M.roc_points(scored(spark, sf_dir), "label", "score")


@register("majority_and_lift", SCORED_SQL + """
, r AS (SELECT label, row_number() OVER (ORDER BY score DESC, content_id ASC) AS rn FROM fx_scored),
p AS (SELECT COALESCE(AVG(CASE WHEN rn <= 50 THEN CAST(label AS DOUBLE) END), 0.0) AS precision_at_50 FROM r),
b AS (SELECT AVG(CAST(label AS DOUBLE)) AS base_rate FROM fx_scored)
SELECT precision_at_50, base_rate, precision_at_50 / base_rate AS precision_at_50_lift,
       greatest(base_rate, 1 - base_rate) AS majority_rate FROM p, b""")
def majority_and_lift(spark, sf_dir):
    """M08 + E12: base rate, lift of P@50 and the majority-class rate."""
    s = scored(spark, sf_dir)
    pk = M.precision_at_k(s, "label", "score", "content_id", ks=[50])
    return M.lift(pk, s, "label", ["precision_at_50"]).crossJoin(M.majority_rate(s, "label"))


@register("rank_metrics", SCORED_SQL + f"""
, r AS (SELECT label, row_number() OVER (ORDER BY score DESC, content_id ASC) AS i FROM fx_scored),
top AS (SELECT i, label, SUM(label) OVER (ORDER BY i) AS hits FROM r WHERE i <= 100),
P AS (SELECT SUM(label) AS P FROM fx_scored),
ideal AS (SELECT SUM(1 / log2(g + 1)) AS idcg FROM range(1, 101) t(g), P WHERE g <= least(100, P.P))
SELECT 100 AS k, COALESCE(CAST(SUM(label) AS DOUBLE) / NULLIF(CAST(MAX(P.P) AS DOUBLE), 0), 0.0) AS recall_at_k,
  round(CASE WHEN MAX(P.P) > 0 THEN SUM(label / log2(i + 1)) / MAX(idcg) ELSE 0.0 END, {R9}) AS ndcg_at_k,
  round(COALESCE(SUM(CASE WHEN label = 1 THEN hits / i END) / least(100, MAX(P.P)), 0.0), {R9}) AS ap_at_k
FROM top, P, ideal""")
def rank_metrics(spark, sf_dir):
    """Recall@K, NDCG@K, AP@K (K = 100)."""
    r = M.rank_metrics(scored(spark, sf_dir), "label", "score", "content_id", 100)
    return r.select("k", "recall_at_k", F.round("ndcg_at_k", R9).alias("ndcg_at_k"), F.round("ap_at_k", R9).alias("ap_at_k"))


@register("score_row_rank", SCORED_SQL + """
SELECT content_id, score, row_number() OVER (ORDER BY score DESC, content_id ASC) AS score_rank FROM fx_scored""")
def score_row_rank(spark, sf_dir):
    """W02/W03 on a heavy-tie score: ranks with small buckets so the tie blocks span buckets."""
    s = scored(spark, sf_dir).select("content_id", "score")
    return O.row_rank(s, [("score", True)], "content_id", "score_rank")


@register("score_pct_rank", SCORED_SQL + """
SELECT content_id, (CAST(rank() OVER (ORDER BY CAST(score AS DOUBLE)) - 1 AS DOUBLE)
   + CAST(count(*) OVER (PARTITION BY score) + 1 AS DOUBLE) / CAST(2 AS DOUBLE)) / CAST(count(*) OVER () AS DOUBLE) AS pct
FROM fx_scored""")
def score_pct_rank(spark, sf_dir):
    """Average-rank percentile with 14 distinct values and heavy ties."""
    s = scored(spark, sf_dir).select("content_id", "score")
    return O.pct_rank(s, "score", "pct").select("content_id", "pct")


@register("top_k_scored", SCORED_SQL + """
SELECT content_id, score, label FROM fx_scored ORDER BY score DESC, content_id LIMIT 50""")
def top_k_scored(spark, sf_dir):
    """Top 50 by score (a top-k report: the limit is the feature)."""
    return O.top_k(scored(spark, sf_dir).select("content_id", "score", "label"), [("score", True)], 50, "content_id")


@register("score_quantiles", SCORED_SQL + """
SELECT quantile_cont(CAST(score AS DOUBLE), 0.8) AS q0, quantile_cont(CAST(score AS DOUBLE), 0.5) AS q1 FROM fx_scored""")
def score_quantiles(spark, sf_dir):
    """Exact 0.8 / 0.5 quantiles, linear interpolation."""
    from panelrank.operators.aggregates import quantiles
    return quantiles(scored(spark, sf_dir), "score", [0.8, 0.5])


# ---------------------------------------------------------------- splits
GROUP_RANK_SQL = """
, g AS (SELECT DISTINCT COALESCE(CAST(client_id AS VARCHAR), 'unknown') AS g FROM fx_scored),
gr AS (SELECT g, row_number() OVER (ORDER BY md5(g || '|42'), g) - 1 AS pos, COUNT(*) OVER () AS n FROM g)"""


@register("client_holdout", SCORED_SQL + GROUP_RANK_SQL + """
SELECT s.*, CASE WHEN gr.pos < greatest(1, CAST(round(gr.n * 0.2) AS BIGINT)) THEN 'test' ELSE 'train' END AS split
FROM fx_scored s JOIN gr ON COALESCE(CAST(s.client_id AS VARCHAR), 'unknown') = gr.g""")
def client_holdout(spark, sf_dir):
    """First max(1, round(0.2 n)) clients by md5 order are test."""
    df, strategy = L.client_holdout(scored(spark, sf_dir), "client_id", "label")
    return df


@register("group_shuffle", SCORED_SQL + GROUP_RANK_SQL + """
SELECT s.*, CASE WHEN gr.pos < CAST(ceil(gr.n * 0.25) AS BIGINT) THEN 'test' ELSE 'train' END AS split
FROM fx_scored s JOIN gr ON COALESCE(CAST(s.client_id AS VARCHAR), 'unknown') = gr.g""")
def group_shuffle(spark, sf_dir):
    """ceil(0.25 n) groups are test."""
    return L.group_shuffle(scored(spark, sf_dir), "client_id", 0.25)


@register("group_folds", SCORED_SQL + GROUP_RANK_SQL + """
SELECT s.*, CAST(gr.pos % 5 AS INTEGER) AS fold
FROM fx_scored s JOIN gr ON COALESCE(CAST(s.client_id AS VARCHAR), 'unknown') = gr.g""")
def group_folds(spark, sf_dir):
    """Group 5-fold assignment by hash order."""
    return L.group_folds(scored(spark, sf_dir), "client_id", 5)


@register("fold_metrics", SCORED_SQL + GROUP_RANK_SQL + """
, f AS (SELECT s.*, CAST(gr.pos % 5 AS INTEGER) AS fold FROM fx_scored s JOIN gr ON COALESCE(CAST(s.client_id AS VARCHAR), 'unknown') = gr.g),
n AS (SELECT fold, COUNT(*) AS n, CAST(SUM(label) AS BIGINT) AS positives FROM f GROUP BY fold),
r AS (SELECT fold, label, row_number() OVER (PARTITION BY fold ORDER BY score DESC, content_id) AS r FROM f),
t AS (SELECT fold, AVG(CAST(label AS DOUBLE)) AS precision_at_50 FROM r WHERE r <= 50 GROUP BY fold),
s AS (SELECT fold, score, COUNT(*) FILTER (WHERE label = 1) AS pos, COUNT(*) FILTER (WHERE label <> 1) AS neg FROM f GROUP BY ALL),
c AS (SELECT *, COALESCE(SUM(neg) OVER (PARTITION BY fold ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM s),
a AS (SELECT fold, CASE WHEN SUM(pos) = 0 OR SUM(neg) = 0 THEN 0.0
        ELSE CAST(SUM(2 * pos * nb + pos * neg) AS DOUBLE) / (CAST(2 AS DOUBLE) * CAST(SUM(pos) AS DOUBLE) * CAST(SUM(neg) AS DOUBLE)) END AS roc_auc FROM c GROUP BY fold)
SELECT fold, n, positives, roc_auc, precision_at_50 FROM n JOIN a USING (fold) JOIN t USING (fold)""")
def fold_metrics(spark, sf_dir):
    """L05 + M02 + M04: rows, positives, AUC and P@50 of a fixed score in every group fold."""
    f = L.group_folds(scored(spark, sf_dir), "client_id", 5)
    return CV.fold_metrics(f, "label", "score", "content_id", ["fold"])


@register("stratified_holdout", SCORED_SQL + """
, r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(CAST(content_id AS VARCHAR) || '|42'), content_id) - 1 AS pos,
               COUNT(*) OVER (PARTITION BY label) AS nc FROM fx_scored)
SELECT content_id, client_id, score, label, CASE WHEN pos < round(nc * 0.2) THEN 'test' ELSE 'train' END AS split FROM r""")
def stratified_holdout(spark, sf_dir):
    """Per class the first round(0.2 n_class) rows by hash are test."""
    return L.stratified_holdout(scored(spark, sf_dir), "label", 0.2)


@register("split_check", SCORED_SQL + GROUP_RANK_SQL + """
, sp AS (SELECT s.*, CASE WHEN gr.pos < greatest(1, CAST(round(gr.n * 0.2) AS BIGINT)) THEN 'test' ELSE 'train' END AS split
         FROM fx_scored s JOIN gr ON COALESCE(CAST(s.client_id AS VARCHAR), 'unknown') = gr.g),
per AS (SELECT split, COUNT(*) AS rows, COUNT(DISTINCT label) AS classes, CAST(SUM(label) AS BIGINT) AS positives FROM sp GROUP BY split),
lk AS (SELECT COUNT(*) FILTER (WHERE sides > 1) AS groups_on_both_sides, COUNT(*) AS groups
       FROM (SELECT client_id, COUNT(DISTINCT split) AS sides FROM sp GROUP BY client_id))
SELECT * FROM per, lk""")
def split_check(spark, sf_dir):
    """No group on both sides; classes and rows per side."""
    df, _ = L.client_holdout(scored(spark, sf_dir), "client_id", "label")
    return L.split_check(df, "client_id", "label")


@register("time_split", fx.with_sql("fx_daily") + """
, b AS (SELECT MAX(report_date) AS end_d FROM fx_daily)
SELECT CASE WHEN report_date > b.end_d - 365 THEN 'test' WHEN report_date <= b.end_d - 395 THEN 'train'
            ELSE 'embargo' END AS split, COUNT(*) AS rows, MIN(report_date) AS min_date, MAX(report_date) AS max_date
FROM fx_daily, b GROUP BY 1""")
def time_split(spark, sf_dir):
    """Train <= cut - 30 d embargo < test, cut = last day - 365 d."""
    d = fx.fx_daily(spark, sf_dir)
    end = fx.fx_last_day(spark, sf_dir)
    t = L.time_split(d, "report_date", end - _dt.timedelta(days=365), 30)
    return t.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.min("report_date").alias("min_date"),
                                  F.max("report_date").alias("max_date"))


# ---------------------------------------------------------------- comparison on fixed scores
# three scores of the same rows: the fixture's, the volume of the last window, and a hash of the id
THREE = ["score", "volume", "hash"]
THREE_SQL = SCORED_SQL + """
, three AS (SELECT f.content_id, f.client_id, f.label, CAST(f.score AS DOUBLE) / 14 AS score, CAST(t.imp_last AS DOUBLE) / (100 + t.imp_last) AS volume,
                   CAST('0x' || substr(md5(CAST(f.content_id AS VARCHAR)), 1, 8) AS BIGINT) / CAST(4294967296 AS DOUBLE) AS hash
            FROM fx_scored f JOIN sc_tw t ON f.content_id = t.content_id AND f.client_id = t.client_id),
lg AS (SELECT content_id, label, model, s FROM three UNPIVOT (s FOR model IN (score, volume, hash)))"""


def three_scores(spark, sf_dir):
    tw = W.two_window(fx.fx_daily(spark, sf_dir), ["client_id", "content_id"], end=fx.fx_last_day(spark, sf_dir), window=FX_WINDOW, split=FX_SPLIT, avgs={}, min_prev=None)
    tw = W.window_label(tw, out="label")
    digest = F.conv(F.substring(F.md5(F.col("content_id").cast("string")), 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))
    last = F.col("imp_last").cast("double")
    return tw.select("content_id", "client_id", "label", (F.floor(F.col("imp_prev") / 25).cast("double") / 14).alias("score"), (last / (100 + F.col("imp_last"))).alias("volume"), digest.alias("hash"))


COMPARE_CTE = f"""
, cm AS (SELECT model, COUNT(*) FILTER (WHERE s >= 0.5 AND label = 1) AS tp, COUNT(*) FILTER (WHERE s >= 0.5 AND label <> 1) AS fp,
                COUNT(*) FILTER (WHERE s < 0.5 AND label <> 1) AS tn, COUNT(*) FILTER (WHERE s < 0.5 AND label = 1) AS fn FROM lg GROUP BY model),
ds AS (SELECT model, s, COUNT(*) FILTER (WHERE label = 1) AS pos, COUNT(*) FILTER (WHERE label <> 1) AS neg FROM lg GROUP BY ALL),
cu AS (SELECT *, SUM(pos) OVER d AS tp, SUM(pos + neg) OVER d AS na, SUM(neg) OVER (PARTITION BY model ORDER BY s) - neg AS nb FROM ds WINDOW d AS (PARTITION BY model ORDER BY s DESC)),
ra AS (SELECT model, CAST(SUM(2 * pos * nb + pos * neg) AS DOUBLE) / (CAST(2 AS DOUBLE) * CAST(SUM(pos) AS DOUBLE) * CAST(SUM(neg) AS DOUBLE)) AS roc_auc,
              SUM(CAST(pos AS DOUBLE) * tp / na) / SUM(pos) AS average_precision FROM cu GROUP BY model),
rk AS (SELECT model, label, row_number() OVER (PARTITION BY model ORDER BY s DESC, content_id) AS r FROM lg),
pk AS (SELECT model, AVG(CAST(label AS DOUBLE)) FILTER (WHERE r <= 20) AS precision_at_20, AVG(CAST(label AS DOUBLE)) FILTER (WHERE r <= 50) AS precision_at_50,
              AVG(CAST(label AS DOUBLE)) FILTER (WHERE r <= 100) AS precision_at_100 FROM rk GROUP BY model),
cmp AS (SELECT model, tp + fp + tn + fn AS n, COALESCE({_d('tp + tn')} / NULLIF({_d('tp + fp + tn + fn')}, 0), 0.0) AS accuracy,
          COALESCE({_d('tp')} / NULLIF({_d('tp + fp')}, 0), 0.0) AS precision, COALESCE({_d('tp')} / NULLIF({_d('tp + fn')}, 0), 0.0) AS recall,
          COALESCE({_d('2 * tp')} / NULLIF({_d('2 * tp + fp + fn')}, 0), 0.0) AS f1, round(roc_auc, {R9}) AS roc_auc, round(average_precision, {R9}) AS average_precision,
          precision_at_20, precision_at_50, precision_at_100 FROM cm JOIN ra USING (model) JOIN pk USING (model))"""


def _compared(spark, sf_dir):
    m = M.compare(three_scores(spark, sf_dir), "label", {n: n for n in THREE}, "content_id")
    return m.withColumns({c: F.round(c, R9) for c in ("roc_auc", "average_precision")})


@register("score_comparison", THREE_SQL + COMPARE_CTE + " SELECT * FROM cmp")
def score_comparison(spark, sf_dir):
    """M09 + U01: all headline metrics of three fixed scores, one grouped pass."""
    return _compared(spark, sf_dir)


@register("best_score", THREE_SQL + COMPARE_CTE + """
SELECT * FROM cmp ORDER BY precision_at_50 DESC, average_precision DESC, roc_auc DESC, list_position(['hash', 'volume', 'score'], model) LIMIT 1""")
def best_score(spark, sf_dir):
    """The chosen score by (P@50, AP, AUC), ties to the one given first."""
    return M.best_model(_compared(spark, sf_dir), ["hash", "volume", "score"])


@register("rule_lookup", THREE_SQL + """
SELECT t.content_id, COALESCE(s.score, 0.0) AS score FROM three t LEFT JOIN (SELECT content_id, score FROM three WHERE score > 0.3) s ON t.content_id = s.content_id""")
def rule_lookup(spark, sf_dir):
    """Scores looked up on ids, missing ones 0."""
    from panelrank.operators.joins import lookup
    t = O.materialized(three_scores(spark, sf_dir))
    return lookup(t.select("content_id"), t.filter(F.col("score") > 0.3), "content_id", "score")


# ---------------------------------------------------------------- M12 by client
REPS = 200


@register("bootstrap_by_client", THREE_SQL + f"""
, gw AS (SELECT g, rep, len([e FOR e IN {M.poisson_edges()} IF u >= e]) AS w FROM (
    SELECT g, rep, CAST('0x' || substr(md5(concat_ws('|', g, rep, 42)), 1, 13) AS BIGINT) / 4503599627370496 AS u
    FROM (SELECT DISTINCT COALESCE(client_id, 'unknown') AS g FROM three), range(1, {REPS + 1}) t(rep))),
x AS (SELECT t.*, rep, w FROM three t JOIN gw ON gw.g = COALESCE(t.client_id, 'unknown') WHERE w > 0),
ac AS (SELECT rep, 'accuracy' AS metric, (CAST(SUM(w * CAST((CAST(score >= 0.5 AS INTEGER) = label) AS INTEGER)) AS DOUBLE) - CAST(SUM(w * CAST((CAST(hash >= 0.5 AS INTEGER) = label) AS INTEGER)) AS DOUBLE)) / SUM(w) AS d FROM x GROUP BY rep),
xl AS (SELECT rep, w, label, content_id, model, s FROM x UNPIVOT (s FOR model IN (score, hash))),
ord AS (SELECT *, SUM(w) OVER (PARTITION BY rep, model ORDER BY s DESC, content_id) - w AS before FROM xl),
pk AS (SELECT rep, model, CAST(SUM(label * least(w, 50 - before)) AS DOUBLE) / SUM(least(w, 50 - before)) AS v FROM ord WHERE before < 50 GROUP BY ALL),
ds AS (SELECT rep, model, s, SUM(w * label) AS pos, SUM(w) AS al FROM xl GROUP BY ALL),
cu AS (SELECT *, SUM(pos) OVER d AS tp, SUM(al) OVER d AS na FROM ds WINDOW d AS (PARTITION BY rep, model ORDER BY s DESC)),
ap AS (SELECT rep, model, CASE WHEN SUM(pos) > 0 AND SUM(pos) < SUM(al) THEN SUM(CAST(pos AS DOUBLE) * (CAST(tp AS DOUBLE) / na)) / SUM(pos) ELSE 0.0 END AS v FROM cu GROUP BY ALL),
two AS (SELECT rep, 'precision_at_50' AS metric, model, v FROM pk UNION ALL SELECT rep, 'average_precision', model, v FROM ap),
df AS (SELECT metric, d FROM ac UNION ALL SELECT metric, SUM(CASE WHEN model = 'score' THEN v ELSE -v END) FROM two GROUP BY rep, metric)
SELECT metric, round(AVG(d), {R9}) AS mean_diff, round(quantile_cont(d, 0.025), {R9}) AS lo, round(quantile_cont(d, 0.975), {R9}) AS hi, COUNT(*) AS reps FROM df GROUP BY metric""")
def bootstrap_by_client(spark, sf_dir):
    """Intervals of accuracy, P@50 and AP differences (fixture score against a hash), whole clients resampled."""
    b = M.bootstrap_by_group(three_scores(spark, sf_dir), "label", "score", "hash", "content_id", "client_id", reps=REPS)
    return b.select("metric", *[F.round(c, R9).alias(c) for c in ("mean_diff", "lo", "hi")], "reps")


@register("score_sketches", SCORED_SQL + """
SELECT client_id, q, CAST(COUNT(*) AS BIGINT) AS n, TRUE AS within_bound FROM fx_scored, (SELECT unnest([0.05, 0.5, 0.95]::DOUBLE[]) AS q) GROUP BY client_id, q
UNION ALL SELECT 'all', q, COUNT(*), TRUE FROM fx_scored, (SELECT unnest([0.05, 0.5, 0.95]::DOUBLE[]) AS q) GROUP BY q""")
def score_sketches(spark, sf_dir):
    """A09 opt-in: KLL sketches kept per client, merged to all rows; every sketched quantile's exact rank is within the bound."""
    qs = [0.05, 0.5, 0.95]
    s = O.materialized(three_scores(spark, sf_dir).select("client_id", "volume"))
    kept = O.materialized(SK.quantile_sketch(s, ["client_id"], "volume"))
    whole = SK.merge_sketches(kept).withColumn("client_id", F.lit("all"))
    found = O.materialized(SK.sketch_quantiles(kept.unionByName(whole), qs))
    both = s.unionByName(s.withColumn("client_id", F.lit("all")))
    r = SK.rank_check(both, ["client_id"], "volume", found, qs)
    ok = (F.col("rank_low") <= F.col("q") + SK.rank_error() * 2) & (F.col("rank_high") >= F.col("q") - SK.rank_error() * 2)
    return r.select("client_id", "q", "n", ok.alias("within_bound"))
