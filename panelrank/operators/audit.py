"""Audits: signals, distributions, leakage, drift.

Every audit returns a findings DataFrame; none collects rows. Verdict rules
that the reference only names (V01, V05) are ours and documented here.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelrank import constants as K
from panelrank.functions import exprs as X
from panelrank.operators import metrics as M


def signal_test(df: DataFrame, tier: str, label: str, order: list[str], floor: int = K.SIGNAL_FLOOR,
                band: float = 0.02) -> DataFrame:
    """Label rate per ordered tier with n, and a verdict (V01, rule ours).

    Tiers under ``floor`` rows are reported but not judged. Over the judged
    tiers in order: all steps up -> CONFIRMED, all down -> OPPOSITE, spread
    within +-band -> FALSE, fewer than two tiers -> insufficient, else MIXED.
    """
    lv = df.sparkSession.createDataFrame([(t, i) for i, t in enumerate(order)], f"{tier} string, tier_order int")
    g = df.groupBy(tier).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(label).cast("double")).alias("rate"))
    t = F.broadcast(lv).join(g, tier, "left").na.fill(0, ["n"])
    judged = t.filter(F.col("n") >= floor)
    arr = judged.agg(F.sort_array(F.collect_list(F.struct("tier_order", "rate"))).alias("_a"))  # <= len(order) rows
    rates = F.transform(F.col("_a"), lambda s: s["rate"])
    steps = F.transform(F.sequence(F.lit(1), F.greatest(F.size(rates) - 1, F.lit(1))),
                        lambda i: F.element_at(rates, i + 1) - F.element_at(rates, i))
    verdict = (F.when(F.size(rates) < 2, "insufficient")
               .when(F.array_max(rates) - F.array_min(rates) <= band, "FALSE")
               .when(F.forall(steps, lambda d: d > 0), "CONFIRMED")
               .when(F.forall(steps, lambda d: d < 0), "OPPOSITE")
               .otherwise("MIXED"))
    v = arr.select(verdict.alias("verdict"))
    return t.crossJoin(v).select(tier, "tier_order", "n", "rate", (F.col("n") >= floor).alias("judged"), "verdict")


def distributions(df: DataFrame, cols: list[str], **kw) -> DataFrame:
    """Count, nulls, zeros, mean, exact quantiles and population skew per column (V02); long format.

    The columns are unpivoted once: one grouped aggregate for counts and moments, one ordered prefix for the quantiles
    of all of them. A column without variance has no skew.
    """
    from panelrank.operators.aggregates import grouped_quantiles
    x = F.col("_x")
    long = df.select(*[X.nan_to_null(c).alias(c) for c in cols]).unpivot([], cols, "column_name", "_x")
    base = long.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(x.isNull()).alias("nulls"), F.count_if(x == 0).alias("zeros"), F.avg(x).alias("mean"),
        F.when(F.var_pop(x) > 0, F.skewness(x)).alias("skew"))
    q = grouped_quantiles(long, ["column_name"], "_x", [0.05, 0.25, 0.5, 0.75, 0.95], **kw)
    return base.join(q, "column_name", "left").select("column_name", "rows", "nulls", "zeros", "mean", F.col("q0").alias("p05"), F.col("q1").alias("p25"),
                                                      F.col("q2").alias("p50"), F.col("q3").alias("p75"), F.col("q4").alias("p95"), "skew")


def category_distributions(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows, nulls, levels, most frequent level with its share and the entropy (nats) per categorical column.

    Unpivoted to (column, level) and counted once; a level that holds most rows is one partial count per task. NULL is no level;
    equally frequent levels go to the first by name.
    """
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "column_name", "_v")
    lv = long.groupBy("column_name", "_v").agg(F.count(F.lit(1)).alias("_n"))
    known, n = F.col("_v").isNotNull(), F.when(F.col("_v").isNotNull(), F.col("_n"))
    # entropy = ln N - sum n ln n / N over the levels
    g = lv.groupBy("column_name").agg(F.sum("_n").alias("rows"), F.coalesce(F.sum(F.when(~known, F.col("_n"))), F.lit(0)).alias("nulls"), F.count_if(known).alias("levels"),
                                      F.min(F.when(known, F.struct((-F.col("_n")).alias("n"), F.col("_v").alias("v")))).alias("_top"),
                                      F.sum(n).alias("_N"), F.sum(n * F.log(n)).alias("_l"))
    return g.select("column_name", "rows", "nulls", "levels", F.col("_top.v").alias("top_level"), (-F.col("_top.n") / F.col("_N")).alias("top_share"),
                    (F.log("_N") - F.col("_l") / F.col("_N")).alias("entropy"))


def effect_size(df: DataFrame, group: str, label: str) -> DataFrame:
    """Two groups (group true / false): rates, n, difference, ratio, pooled std."""
    g = F.col(group).cast("boolean")
    y = F.col(label).cast("double")
    a = df.agg(F.count_if(g).alias("n_a"), F.avg(F.when(g, y)).alias("rate_a"),
               F.count_if(~g).alias("n_b"), F.avg(F.when(~g, y)).alias("rate_b"))
    pooled = F.sqrt((F.col("rate_a") * (1 - F.col("rate_a")) * F.col("n_a")
                     + F.col("rate_b") * (1 - F.col("rate_b")) * F.col("n_b")) / (F.col("n_a") + F.col("n_b")))
    return a.select("n_a", "rate_a", "n_b", "rate_b", (F.col("rate_a") - F.col("rate_b")).alias("difference"),
                    X.ratio("rate_a", "rate_b").alias("ratio"), pooled.alias("pooled_std"),
                    X.ratio(F.col("rate_a") - F.col("rate_b"), pooled).alias("standardized_difference"))


def name_guard(cols: list[str]) -> list[str]:
    """Column names that look like label-window fields (``trend``, ``last_30d``)."""
    return [c for c in cols if any(p in c for p in K.LEAKY_NAME_PARTS)]


def label_determinism(df: DataFrame, cols: list[str], label: str, roles: dict | None = None) -> DataFrame:
    """Share of rows whose feature value maps to a single label (V04), plus the name/role guard.

    Features are unpivoted to (feature, value), grouped by (feature, value)
    with the number of distinct labels, then weighted by rows.
    """
    long = df.select(F.col(label).alias("_y"), *[F.col(c).cast("string").alias(c) for c in cols]) \
        .unpivot("_y", cols, "feature", "value")
    g = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("_n"), F.countDistinct("_y").alias("_k"))
    r = g.groupBy("feature").agg(
        (F.sum(F.when(F.col("_k") == 1, F.col("_n")).otherwise(0)) / F.sum("_n")).alias("deterministic_share"),
        F.count(F.lit(1)).alias("distinct_values"))
    flagged = name_guard(cols)
    roles = roles or {}
    return r.select("feature", "deterministic_share", "distinct_values",
                    F.col("feature").isin(*flagged).alias("name_flag") if flagged else F.lit(False).alias("name_flag"),
                    F.coalesce(F.create_map(*[x for k, v in roles.items() for x in (F.lit(k), F.lit(v))])[F.col("feature")]
                               if roles else F.lit(None).cast("string"), F.lit("feature")).alias("role"))


def window_overlap(fields: DataFrame) -> DataFrame:
    """Feature window vs label window per field.

    ``fields``: field, role ('feature' / 'label'), win_start, win_end
    (inclusive dates, measured from the tables with ``span``). Every feature
    field is compared with every label window (label windows are few: a
    broadcast of at most a handful of rows).
    """
    f = fields.filter(F.col("role") == "feature")
    lab = fields.filter(F.col("role") == "label").select(F.col("field").alias("label_field"),
                                                         F.col("win_start").alias("label_start"),
                                                         F.col("win_end").alias("label_end"))
    j = f.crossJoin(lab)  # fields and label windows of one job, a handful of rows each
    overlap = (F.col("win_start") <= F.col("label_end")) & (F.col("label_start") <= F.col("win_end"))
    days = F.when(overlap, F.datediff(F.least("win_end", "label_end"), F.greatest("win_start", "label_start")) + 1) \
        .otherwise(0)
    return j.select("field", "win_start", "win_end", "label_field", "label_start", "label_end",
                    overlap.alias("overlaps"), days.alias("overlap_days"),
                    F.when(overlap, "LEAK").otherwise("ok").alias("status"))


def single_feature_auc(df: DataFrame, cols: list[str], label: str, **kw) -> DataFrame:
    """AUC of each feature alone (V07): unpivot, then AUC grouped by feature."""
    long = df.select(F.col(label).alias("_y"), *[F.col(c).cast("double").alias(c) for c in cols]) \
        .unpivot("_y", cols, "feature", "value")
    a = M.roc_auc(long, "_y", "value", by=["feature"], **kw)
    return a.withColumn("auc_distance", F.abs(F.col("roc_auc") - 0.5))


def sealed_guard(df: DataFrame, date_col: str, sealed_start: _dt.date) -> DataFrame:
    """Sealed-window guard (V09): no feature row may fall on/after the sealed start."""
    return df.agg(F.max(date_col).alias("max_feature_date"),
                  F.count_if(F.col(date_col) >= F.lit(sealed_start)).alias("rows_in_sealed_window"),
                  F.count(F.lit(1)).alias("rows")) \
        .withColumn("sealed_start", F.lit(sealed_start)) \
        .withColumn("status", F.when(F.col("rows_in_sealed_window") == 0, "ok").otherwise("LEAK"))


def cross_side_duplicates(df: DataFrame, cols: list[str], side: str = "split") -> DataFrame:
    """Identical feature rows present on both split sides (V10): grouped on the feature values."""
    g = df.groupBy(*cols).agg(F.countDistinct(side).alias("_sides"), F.count(F.lit(1)).alias("rows"))
    dup = g.filter(F.col("_sides") > 1)
    return dup.agg(F.count(F.lit(1)).alias("duplicate_groups"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))


# ---------------------------------------------------------------- drift
def drift(a: DataFrame, b: DataFrame, cols: list[str], by: list[str] | None = None, bins: int = 10, eps: float = 1e-4,
          **kw) -> DataFrame:
    """Population stability index per column, and per segment with ``by``.

    Bin edges are period A's exact quantiles of the segment and column, joined to both periods' rows; one grouped
    pass counts bins for all columns and segments. PSI = sum (pa - pb) ln(pa / pb) with shares floored at
    ``eps``. A segment without rows in one of the periods has no index (NULL, status ``no_rows``); a NULL segment is
    one of its own, NULL values are left out.
    """
    from panelrank.operators.aggregates import grouped_quantiles
    by = list(by or [])

    def long(df):
        # a segment is one struct, so that a NULL segment joins like any other
        vals = df.select(F.struct(*[F.col(c) for c in by], F.lit(0).alias("_")).alias("_seg"),
                         *[F.col(c).cast("double").alias(c) for c in cols])
        return vals.unpivot("_seg", cols, "column_name", "_x").filter(F.col("_x").isNotNull()) \
            .withColumn("_seg", F.to_json("_seg", {"ignoreNullFields": "false"}))

    la, lb = long(a), long(b)
    qs = [i / bins for i in range(1, bins)]
    keys = ["_seg", "column_name"]
    edges = grouped_quantiles(la, keys, "_x", qs, **kw) \
        .select(*keys, F.array_distinct(F.array(*[f"q{i}" for i in range(len(qs))])).alias("_edges"))
    both = la.withColumn("_a", F.lit(1)).unionByName(lb.withColumn("_a", F.lit(0)))
    # rows fall to few values per segment and column: counted before the edges are joined, hot segments collapse here
    vals = both.groupBy(*keys, "_x").agg(F.sum("_a").alias("n_a"), F.sum(1 - F.col("_a")).alias("n_b"))
    cut = F.size(F.filter("_edges", lambda e: F.col("_x") > e))
    counts = vals.join(edges, keys, "left").groupBy(*keys, cut.alias("bin")) \
        .agg(F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"))
    # at most ``bins`` rows per segment and column
    total = Window.partitionBy(*keys)
    counts = counts.withColumns({"_ta": F.sum("n_a").over(total), "_tb": F.sum("n_b").over(total)})
    r = _psi(counts, keys, eps, "bins")
    seg = F.from_json("_seg", T.StructType([a.schema[c] for c in by] + [T.StructField("_", T.IntegerType())]))
    r = r.withColumn("_seg", seg)
    return r.select(*[F.col(f"_seg.{c}").alias(c) for c in by], "column_name", "psi", "bins", "status")


def category_drift(a: DataFrame, b: DataFrame, cols: list[str], by: list[str] | None = None, eps: float = 1e-4) -> DataFrame:
    """Population stability index of categorical columns, over the shares of their levels (K05), per segment with ``by``.

    NULL is a level of its own; a level of one period only has the share ``eps`` in the other. The rest as in ``drift``.
    """
    by = list(by or [])
    keys = [*[f"_k{i}" for i in range(len(by))], "column_name"]

    def long(df, mark):
        seg = [F.col(c).alias(k) for c, k in zip(by, keys)]
        return df.select(*seg, *[F.col(c).cast("string").alias(c) for c in cols]).unpivot(keys[:-1], cols, "column_name", "_v").withColumn("_a", F.lit(mark))

    counts = long(a, 1).unionByName(long(b, 0)).groupBy(*keys, "_v").agg(F.sum("_a").alias("n_a"), F.sum(1 - F.col("_a")).alias("n_b"))
    total = Window.partitionBy(*keys)  # one row per level
    return _psi(counts.withColumns({"_ta": F.sum("n_a").over(total), "_tb": F.sum("n_b").over(total)}), keys, eps, "levels") \
        .select(*[F.col(k).alias(c) for c, k in zip(by, keys)], "column_name", "psi", "levels", "status")


def _psi(counts: DataFrame, keys: list[str], eps: float, parts: str) -> DataFrame:
    """Index and verdict from counts n_a, n_b per bin or level with their totals _ta, _tb."""
    pa = F.greatest(F.col("n_a") / F.when(F.col("_ta") > 0, F.col("_ta")), F.lit(eps))
    pb = F.greatest(F.col("n_b") / F.when(F.col("_tb") > 0, F.col("_tb")), F.lit(eps))
    known = (F.col("_ta") > 0) & (F.col("_tb") > 0)
    r = counts.groupBy(*keys).agg(F.sum(F.when(known, (pa - pb) * F.log(pa / pb))).alias("psi"), F.count(F.lit(1)).alias(parts))
    return r.withColumn("status", F.when(F.col("psi").isNull(), "no_rows").when(F.col("psi") >= 0.25, "shift").when(F.col("psi") >= 0.1, "watch").otherwise("stable"))
