"""Registered queries: audits, leakage checks, drift, clustering."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from panelrank import constants as K
from panelrank.operators import audit as V
from panelrank.operators import cluster as KM
from panelrank.operators import split as L
from panelrank.operators import windows as W
from panelrank.operators.aggregates import span
from panelrank.plans import batch
from panelrank.plans import sql_common as Q
from panelrank.plans.registry import register
from panelrank.sources import fixtures as fx

R9 = 9
FRESH = ["never", "0-30", "31-90", "91-180", "181+"]
LABEL = "is_declining_label"


def r9(c, name=None):
    return F.round(F.col(c), R9).alias(name or c)


@register("signal_test", Q.chain(upto="features") + f"""
, lv AS (SELECT * FROM (VALUES ('never', 0), ('0-30', 1), ('31-90', 2), ('91-180', 3), ('181+', 4)) t(freshness_tier, tier_order)),
g AS (SELECT freshness_tier, COUNT(*) AS n, AVG(CAST({LABEL} AS DOUBLE)) AS rate FROM fx_features GROUP BY 1),
t AS (SELECT lv.freshness_tier, lv.tier_order, COALESCE(g.n, 0) AS n, g.rate FROM lv LEFT JOIN g USING (freshness_tier)),
j AS (SELECT rate, rate - lag(rate) OVER (ORDER BY tier_order) AS step FROM t WHERE n >= 50),
v AS (SELECT CASE WHEN COUNT(*) < 2 THEN 'insufficient'
                  WHEN MAX(rate) - MIN(rate) <= 0.02 THEN 'FALSE'
                  WHEN bool_and(step > 0) THEN 'CONFIRMED'
                  WHEN bool_and(step < 0) THEN 'OPPOSITE'
                  ELSE 'MIXED' END AS verdict FROM j)
SELECT freshness_tier, tier_order, n, round(rate, {R9}) AS rate, n >= 50 AS judged, verdict FROM t, v""")
def signal_test(spark, sf_dir):
    """Decline rate per ordered freshness tier, floor 50, verdict (rule ours)."""
    s = V.signal_test(batch.features(spark, sf_dir, materialize=False), "freshness_tier", LABEL, FRESH)
    return s.select("freshness_tier", "tier_order", "n", r9("rate"), "judged", "verdict")


DIST_COLS = list(K.MODEL_NUMERIC_FEATURES)


def _dist_sql(c):
    return f"""SELECT '{c}' AS column_name, COUNT(*) AS rows, COUNT(*) FILTER (WHERE {c} IS NULL) AS nulls,
      COUNT(*) FILTER (WHERE {c} = 0) AS zeros, round(AVG({c}), {R9}) AS mean,
      round(quantile_cont({c}, 0.05), {R9}) AS p05, round(quantile_cont({c}, 0.25), {R9}) AS p25,
      round(quantile_cont({c}, 0.5), {R9}) AS p50, round(quantile_cont({c}, 0.75), {R9}) AS p75,
      round(quantile_cont({c}, 0.95), {R9}) AS p95,
      round((SELECT CASE WHEN AVG(pow({c} - m, 2)) > 0 THEN AVG(pow({c} - m, 3)) / pow(AVG(pow({c} - m, 2)), 1.5) END
             FROM fx_features, (SELECT AVG({c}) AS m FROM fx_features)), {R9}) AS skew
    FROM fx_features"""


@register("distributions", Q.chain(upto="features") + " UNION ALL ".join(_dist_sql(c) for c in DIST_COLS))
def distributions(spark, sf_dir):
    """Count, nulls, zeros, mean, exact quantiles and skew of all 18 numeric model inputs, one unpivoted pass."""
    d = V.distributions(batch.features(spark, sf_dir), DIST_COLS)
    return d.select("column_name", "rows", "nulls", "zeros",
                    *[r9(c) for c in ("mean", "p05", "p25", "p50", "p75", "p95", "skew")])


def _category_sql(c):
    return f"""SELECT '{c}' AS column_name, COUNT(*) AS rows, COUNT(*) FILTER (WHERE {c} IS NULL) AS nulls, COUNT(DISTINCT {c}) AS levels,
      (SELECT {c} FROM fx_features WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1) AS top_level,
      round((SELECT MAX(n) / SUM(n) FROM (SELECT CAST(COUNT(*) AS DOUBLE) AS n FROM fx_features WHERE {c} IS NOT NULL GROUP BY {c})), {R9}) AS top_share,
      round((SELECT SUM(-n / t * ln(n / t)) FROM (SELECT CAST(COUNT(*) AS DOUBLE) AS n, SUM(COUNT(*)) OVER () AS t FROM fx_features WHERE {c} IS NOT NULL GROUP BY {c})), {R9}) AS entropy
    FROM fx_features"""


@register("category_distributions", Q.chain(upto="features") + " UNION ALL ".join(_category_sql(c) for c in K.MODEL_CATEGORICAL_FEATURES))
def category_distributions(spark, sf_dir):
    """Rows, nulls, levels, top level with its share and entropy of the eight categorical model inputs."""
    d = V.category_distributions(batch.features(spark, sf_dir), K.MODEL_CATEGORICAL_FEATURES)
    return d.select("column_name", "rows", "nulls", "levels", "top_level", r9("top_share"), r9("entropy"))


@register("effect_size", Q.chain(upto="features") + f"""
, a AS (SELECT COUNT(*) FILTER (WHERE days_since_last_update >= 180) AS n_a,
               AVG(CASE WHEN days_since_last_update >= 180 THEN CAST({LABEL} AS DOUBLE) END) AS rate_a,
               COUNT(*) FILTER (WHERE NOT (days_since_last_update >= 180)) AS n_b,
               AVG(CASE WHEN NOT (days_since_last_update >= 180) THEN CAST({LABEL} AS DOUBLE) END) AS rate_b FROM fx_features),
p AS (SELECT *, sqrt((rate_a * (1 - rate_a) * n_a + rate_b * (1 - rate_b) * n_b) / (n_a + n_b)) AS ps FROM a)
SELECT n_a, round(rate_a, {R9}) AS rate_a, n_b, round(rate_b, {R9}) AS rate_b, round(rate_a - rate_b, {R9}) AS difference,
  round(rate_a / rate_b, {R9}) AS ratio, round(ps, {R9}) AS pooled_std, round((rate_a - rate_b) / ps, {R9}) AS standardized_difference
FROM p""")
def effect_size(spark, sf_dir):
    """Stale vs fresh pages: decline rates, difference, ratio, pooled std, with n."""
    f = batch.features(spark, sf_dir, materialize=False).withColumn("_stale", F.col("days_since_last_update") >= 180)
    e = V.effect_size(f, "_stale", LABEL)
    return e.select("n_a", r9("rate_a"), "n_b", r9("rate_b"), r9("difference"), r9("ratio"), r9("pooled_std"),
                    r9("standardized_difference"))


# every model input, and the label's own source
DET_COLS = ["trend_direction", "trend_pct", *K.MODEL_NUMERIC_FEATURES, *K.MODEL_CATEGORICAL_FEATURES]


@register("label_determinism", Q.chain(upto="features") + f"""
, long AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, {LABEL} AS y FROM fx_features" for c in DET_COLS)}),
g AS (SELECT feature, value, COUNT(*) AS n, COUNT(DISTINCT y) AS k FROM long GROUP BY 1, 2)
SELECT feature, round(SUM(CASE WHEN k = 1 THEN n ELSE 0 END) / SUM(n), {R9}) AS deterministic_share,
       COUNT(*) AS distinct_values, feature IN ('trend_direction', 'trend_pct') AS name_flag, 'feature' AS role
FROM g GROUP BY feature""")
def label_determinism(spark, sf_dir):
    """Share of rows whose value maps to one label, plus the name guard (trend, last_30d)."""
    f = batch.features(spark, sf_dir)
    d = V.label_determinism(f, DET_COLS, LABEL)
    return d.select("feature", r9("deterministic_share"), "distinct_values", "name_flag", "role")


def _fields(spark, sf_dir):
    daily = fx.fx_daily(spark, sf_dir)
    end = fx.fx_last_day(spark, sf_dir)
    prev_lo, cut = end - _dt.timedelta(days=729), end - _dt.timedelta(days=365)
    li = span(fx.fx_daily(spark, sf_dir), "report_date")  # query table spans all days of the fact
    q = li.select(F.lit("query_mix").alias("field"), F.lit("feature").alias("role"),
                  F.col("min_date").alias("win_start"), F.col("max_date").alias("win_end"))
    rows = spark.createDataFrame([("imp_prev", "feature", prev_lo, cut),
                                  ("imp_last_label", "label", cut + _dt.timedelta(days=1), end)],
                                 "field string, role string, win_start date, win_end date")
    return rows.unionByName(q)


@register("window_overlap", fx.with_sql("fx_daily") + """
, b AS (SELECT MAX(report_date) AS end_d, MIN(report_date) AS start_d FROM fx_daily),
f AS (SELECT 'imp_prev' AS field, CAST(end_d - 729 AS DATE) AS win_start, CAST(end_d - 365 AS DATE) AS win_end FROM b
      UNION ALL SELECT 'query_mix', start_d, end_d FROM b),
l AS (SELECT 'imp_last_label' AS label_field, CAST(end_d - 364 AS DATE) AS label_start, end_d AS label_end FROM b)
SELECT field, win_start, win_end, label_field, label_start, label_end,
  win_start <= label_end AND label_start <= win_end AS overlaps,
  CASE WHEN win_start <= label_end AND label_start <= win_end
       THEN CAST(datediff('day', greatest(win_start, label_start), least(win_end, label_end)) + 1 AS INTEGER) ELSE 0 END AS overlap_days,
  CASE WHEN win_start <= label_end AND label_start <= win_end THEN 'LEAK' ELSE 'ok' END AS status
FROM f, l""")
def window_overlap(spark, sf_dir):
    """Feature windows vs the label window, measured from the tables (flags the query-mix leak)."""
    return V.window_overlap(_fields(spark, sf_dir))


AUC_COLS = [*K.MODEL_NUMERIC_FEATURES, "trend_pct"]


@register("single_feature_auc", Q.chain(upto="features") + f"""
, long AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v, {LABEL} AS y FROM fx_features" for c in AUC_COLS)}),
s AS (SELECT feature, COALESCE(v, 0.0) AS s, COUNT(*) FILTER (WHERE y = 1) AS pos, COUNT(*) FILTER (WHERE y <> 1) AS neg
      FROM long GROUP BY 1, 2),
c AS (SELECT *, COALESCE(SUM(neg) OVER (PARTITION BY feature ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM s),
a AS (SELECT feature, CASE WHEN SUM(pos) = 0 OR SUM(neg) = 0 THEN 0.0
        ELSE CAST(SUM(2 * pos * nb + pos * neg) AS DOUBLE) / (CAST(2 AS DOUBLE) * CAST(SUM(pos) AS DOUBLE) * CAST(SUM(neg) AS DOUBLE)) END AS roc_auc
      FROM c GROUP BY feature)
SELECT feature, roc_auc, abs(roc_auc - 0.5) AS auc_distance FROM a""")
def single_feature_auc(spark, sf_dir):
    """AUC of each feature alone; the label source (trend_pct) stands out."""
    return V.single_feature_auc(batch.features(spark, sf_dir), AUC_COLS, LABEL)


@register("sealed_guard", fx.with_sql("fx_daily") + """
, b AS (SELECT MAX(report_date) AS end_d FROM fx_daily),
f AS (SELECT report_date FROM fx_daily, b WHERE report_date > b.end_d - 730 AND report_date <= b.end_d - 365)
SELECT MAX(report_date) AS max_feature_date, COUNT(*) FILTER (WHERE report_date >= (SELECT CAST(end_d - 364 AS DATE) FROM b)) AS rows_in_sealed_window,
  COUNT(*) AS rows, (SELECT CAST(end_d - 364 AS DATE) FROM b) AS sealed_start,
  CASE WHEN COUNT(*) FILTER (WHERE report_date >= (SELECT CAST(end_d - 364 AS DATE) FROM b)) = 0 THEN 'ok' ELSE 'LEAK' END AS status
FROM f""")
def sealed_guard(spark, sf_dir):
    """The prev-window feature rows stay before the sealed label window."""
    d = fx.fx_daily(spark, sf_dir)
    end = fx.fx_last_day(spark, sf_dir)
    f = W.scope_filter(d, "report_date", end - _dt.timedelta(days=730), end - _dt.timedelta(days=365))
    return V.sealed_guard(f, "report_date", end - _dt.timedelta(days=364))


DUP_COLS = ["content_type", "position_tier", "freshness_tier", "word_count_tier"]


@register("cross_side_duplicates", Q.chain(upto="features") + f"""
, g AS (SELECT DISTINCT COALESCE(CAST(client_id AS VARCHAR), 'unknown') AS g FROM fx_features),
gr AS (SELECT g, row_number() OVER (ORDER BY md5(g || '|42'), g) - 1 AS pos, COUNT(*) OVER () AS n FROM g),
sp AS (SELECT f.*, CASE WHEN gr.pos < greatest(1, CAST(round(gr.n * 0.2) AS BIGINT)) THEN 'test' ELSE 'train' END AS split
       FROM fx_features f JOIN gr ON COALESCE(CAST(f.client_id AS VARCHAR), 'unknown') = gr.g),
d AS (SELECT {", ".join(DUP_COLS)}, COUNT(DISTINCT split) AS sides, COUNT(*) AS rows FROM sp GROUP BY ALL)
SELECT COUNT(*) AS duplicate_groups, CAST(COALESCE(SUM(rows), 0) AS BIGINT) AS rows FROM d WHERE sides > 1""")
def cross_side_duplicates(spark, sf_dir):
    """Identical feature profiles present on both sides of the client split."""
    f = batch.features(spark, sf_dir)
    s, _ = L.client_holdout(f, "client_id", LABEL)
    return V.cross_side_duplicates(s, DUP_COLS)


def _periods(spark, sf_dir):
    d = fx.fx_daily(spark, sf_dir)
    a = d.filter(F.year("report_date") == 1999).groupBy("content_id").agg(F.sum("impressions").alias("impressions"))
    b = d.filter(F.year("report_date") == 2000).groupBy("content_id").agg(F.sum("impressions").alias("impressions"))
    return a, b


@register("drift_psi", fx.with_sql("fx_daily") + f"""
, a AS (SELECT content_id, CAST(SUM(impressions) AS DOUBLE) AS x FROM fx_daily WHERE year(report_date) = 1999 GROUP BY 1),
b AS (SELECT content_id, CAST(SUM(impressions) AS DOUBLE) AS x FROM fx_daily WHERE year(report_date) = 2000 GROUP BY 1),
e AS (SELECT DISTINCT unnest(quantile_cont(x, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS edge FROM a),
ba AS (SELECT (SELECT COUNT(*) FROM e WHERE x > edge) AS bin, COUNT(*) AS n FROM a GROUP BY 1),
bb AS (SELECT (SELECT COUNT(*) FROM e WHERE x > edge) AS bin, COUNT(*) AS n FROM b GROUP BY 1),
j AS (SELECT COALESCE(ba.bin, bb.bin) AS bin, COALESCE(ba.n, 0) AS na, COALESCE(bb.n, 0) AS nb FROM ba FULL JOIN bb ON ba.bin = bb.bin),
t AS (SELECT SUM(na) AS ta, SUM(nb) AS tb FROM j),
p AS (SELECT greatest(na / ta, 0.0001) AS pa, greatest(nb / tb, 0.0001) AS pb FROM j, t)
SELECT 'impressions' AS column_name, round(SUM((pa - pb) * ln(pa / pb)), {R9}) AS psi, COUNT(*) AS bins,
  CASE WHEN SUM((pa - pb) * ln(pa / pb)) >= 0.25 THEN 'shift' WHEN SUM((pa - pb) * ln(pa / pb)) >= 0.1 THEN 'watch' ELSE 'stable' END AS status
FROM p""")
def drift_psi(spark, sf_dir):
    """PSI of per-page yearly impressions, 1999 vs 2000, decile bins from 1999."""
    a, b = _periods(spark, sf_dir)
    d = V.drift(a, b, ["impressions"])
    return d.select("column_name", r9("psi"), "bins", "status")


@register("drift_by_client", fx.with_sql("fx_daily") + f"""
, a AS (SELECT client_id, content_id, CAST(SUM(impressions) AS DOUBLE) AS x FROM fx_daily WHERE year(report_date) = 1999 GROUP BY 1, 2),
b AS (SELECT client_id, content_id, CAST(SUM(impressions) AS DOUBLE) AS x FROM fx_daily WHERE year(report_date) = 2000 GROUP BY 1, 2),
e AS (SELECT client_id, list_distinct(quantile_cont(x, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS edges FROM a GROUP BY 1),
r AS (SELECT client_id, x, 1 AS in_a FROM a UNION ALL SELECT client_id, x, 0 FROM b),
n AS (SELECT r.client_id, len([q FOR q IN edges IF x > q]) AS bin, SUM(in_a) AS na, SUM(1 - in_a) AS nb
      FROM r JOIN e USING (client_id) GROUP BY ALL),
p AS (SELECT client_id, greatest(na / SUM(na) OVER (PARTITION BY client_id), 0.0001) AS pa,
             greatest(nb / SUM(nb) OVER (PARTITION BY client_id), 0.0001) AS pb FROM n)
SELECT client_id, 'impressions' AS column_name, round(SUM((pa - pb) * ln(pa / pb)), {R9}) AS psi, COUNT(*) AS bins,
  CASE WHEN SUM((pa - pb) * ln(pa / pb)) >= 0.25 THEN 'shift' WHEN SUM((pa - pb) * ln(pa / pb)) >= 0.1 THEN 'watch' ELSE 'stable' END AS status
FROM p GROUP BY client_id""")
def drift_by_client(spark, sf_dir):
    """K05 by segment: PSI of per-page yearly impressions within each client, decile bins of the client's 1999."""
    d = fx.fx_daily(spark, sf_dir)
    a, b = (d.filter(F.year("report_date") == y).groupBy("client_id", "content_id").agg(F.sum("impressions").alias("impressions"))
            for y in (1999, 2000))
    return V.drift(a, b, ["impressions"], by=["client_id"]).select("client_id", "column_name", r9("psi"), "bins", "status")


_SIDES = Q.chain(upto="features") + """
, g AS (SELECT DISTINCT COALESCE(CAST(client_id AS VARCHAR), 'unknown') AS g FROM fx_features),
gr AS (SELECT g, row_number() OVER (ORDER BY md5(g || '|42'), g) - 1 AS pos, COUNT(*) OVER () AS n FROM g),
sd AS (SELECT f.*, CASE WHEN gr.pos < CAST(ceil(gr.n * 0.25) AS BIGINT) THEN 0 ELSE 1 END AS in_a
       FROM fx_features f JOIN gr ON COALESCE(CAST(f.client_id AS VARCHAR), 'unknown') = gr.g)"""
_PSI = f"""round(SUM((pa - pb) * ln(pa / pb)), {R9}) AS psi, COUNT(*) AS parts,
  CASE WHEN SUM((pa - pb) * ln(pa / pb)) >= 0.25 THEN 'shift' WHEN SUM((pa - pb) * ln(pa / pb)) >= 0.1 THEN 'watch' ELSE 'stable' END AS status"""


@register("drift_all_inputs", _SIDES + f"""
, lg AS ({" UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS x, in_a FROM sd" for c in K.MODEL_NUMERIC_FEATURES)}),
e AS (SELECT column_name, list_distinct(quantile_cont(x, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS edges FROM lg WHERE in_a = 1 AND x IS NOT NULL GROUP BY 1),
n AS (SELECT column_name, len([q FOR q IN edges IF x > q]) AS bin, SUM(in_a) AS na, SUM(1 - in_a) AS nb FROM lg JOIN e USING (column_name) WHERE x IS NOT NULL GROUP BY ALL),
p AS (SELECT column_name, greatest(na / SUM(na) OVER (PARTITION BY column_name), 0.0001) AS pa, greatest(nb / SUM(nb) OVER (PARTITION BY column_name), 0.0001) AS pb FROM n),
cl AS ({" UNION ALL ".join(f"SELECT '{c}' AS column_name, {c} AS v, in_a FROM sd" for c in K.MODEL_CATEGORICAL_FEATURES)}),
cn AS (SELECT column_name, v, SUM(in_a) AS na, SUM(1 - in_a) AS nb FROM cl GROUP BY ALL),
cp AS (SELECT column_name, greatest(na / SUM(na) OVER (PARTITION BY column_name), 0.0001) AS pa, greatest(nb / SUM(nb) OVER (PARTITION BY column_name), 0.0001) AS pb FROM cn)
SELECT column_name, {_PSI} FROM p GROUP BY 1 UNION ALL SELECT column_name, {_PSI} FROM cp GROUP BY 1""")
def drift_all_inputs(spark, sf_dir):
    """K05 over all 26 model inputs: PSI between the train and test clients of the group split, by deciles and by levels."""
    f = L.group_shuffle(batch.features(spark, sf_dir), "client_id")
    a, b = f.filter("split = 'train'"), f.filter("split = 'test'")
    num = V.drift(a, b, K.MODEL_NUMERIC_FEATURES).withColumnRenamed("bins", "parts")
    cat = V.category_drift(a, b, K.MODEL_CATEGORICAL_FEATURES).withColumnRenamed("levels", "parts")
    return num.unionByName(cat).select("column_name", r9("psi"), "parts", "status")


CLUSTER_COLS = ["impressions_90d", "clicks_90d", "sessions_90d", "days_since_last_update", "word_count"]


@register("archetypes")
def archetypes(spark, sf_dir):
    """K01 + K03: K-Means archetypes (k by silhouette) and their profiles."""
    out, _ = KM.archetypes(batch.features(spark, sf_dir), CLUSTER_COLS)
    return KM.cluster_profile(out, "cluster", ["impressions_90d", "days_since_last_update"])


@register("archetype_silhouette")
def archetype_silhouette(spark, sf_dir):
    """Silhouette per k."""
    _, scores = KM.archetypes(batch.features(spark, sf_dir), CLUSTER_COLS)
    return scores


@register("projection_2d")
def projection_2d(spark, sf_dir):
    """Two-dimensional PCA projection of the archetype inputs."""
    return KM.project_2d(batch.features(spark, sf_dir).select("content_id", *CLUSTER_COLS), CLUSTER_COLS)


@register("cluster_stability")
def cluster_stability(spark, sf_dir):
    """Adjusted Rand index between two seeds."""
    return KM.cluster_stability(batch.features(spark, sf_dir), CLUSTER_COLS, 4)


# two fixed assignments of the pages, so that what follows a clustering is checked without one
_ASSIGNED = Q.chain(upto="features") + """
, asg AS (SELECT *, CAST(content_id % 3 AS INTEGER) AS c1, CAST(CASE WHEN impressions_90d > 100 THEN 3 ELSE content_id % 3 END AS INTEGER) AS c2 FROM fx_features)"""


def _assigned(spark, sf_dir):
    f = batch.features(spark, sf_dir)
    return f.withColumn("c1", (F.col("content_id") % 3).cast("int")).withColumn("c2", F.when(F.col("impressions_90d") > 100, 3).otherwise(F.col("content_id") % 3).cast("int"))


@register("cluster_contingency", _ASSIGNED + " SELECT c1 AS cluster_a, c2 AS cluster_b, COUNT(*) AS rows FROM asg GROUP BY ALL")
def cluster_contingency(spark, sf_dir):
    """Contingency table of two assignments."""
    return KM.contingency(_assigned(spark, sf_dir), "c1", "c2")


@register("adjusted_rand", _ASSIGNED + f"""
, ct AS (SELECT c1, c2, CAST(COUNT(*) AS DOUBLE) AS n FROM asg GROUP BY ALL),
s AS (SELECT SUM(n * (n - 1) / 2) AS sij, CAST(SUM(n) AS BIGINT) AS n FROM ct),
a AS (SELECT SUM(n * (n - 1) / 2) AS sa FROM (SELECT SUM(n) AS n FROM ct GROUP BY c1)),
b AS (SELECT SUM(n * (n - 1) / 2) AS sb FROM (SELECT SUM(n) AS n FROM ct GROUP BY c2))
SELECT round((sij - sa * sb / (n * (n - 1) / 2)) / ((sa + sb) / 2 - sa * sb / (n * (n - 1) / 2)), {R9}) AS adjusted_rand, n FROM s, a, b""")
def adjusted_rand(spark, sf_dir):
    """Adjusted Rand index of two assignments."""
    return KM.adjusted_rand(_assigned(spark, sf_dir), "c1", "c2").select(r9("adjusted_rand"), "n")


@register("cluster_profile", _ASSIGNED + f"""
SELECT c2, COUNT(*) AS size, {", ".join(f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS median_{c}" for c in CLUSTER_COLS)},
  CASE c2 WHEN 3 THEN 'review' WHEN 0 THEN 'monitor' END AS action FROM asg GROUP BY c2""")
def cluster_profile(spark, sf_dir):
    """Size, exact medians and action of every cluster of a given assignment."""
    return KM.cluster_profile(_assigned(spark, sf_dir), "c2", CLUSTER_COLS, {3: "review", 0: "monitor"})
