"""Ranking and classification metrics as distributed aggregates.

Definitions follow the common library ones: AUC as the rank-sum over
distinct scores (ties count half), average precision as the step sum over
distinct thresholds (not the trapezoid ``areaUnderPR``), precision@K with
ties broken by id. Everything is a grouped pass or an ordered prefix over
distinct scores; no per-row data reaches the driver.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelrank import constants as K
from panelrank.functions import exprs as X
from panelrank.operators import ordered as O
from panelrank.session import ensure_checkpoint_dir


def _y(label):
    return F.col(label).cast("long")


def confusion(df: DataFrame, label: str, score: str, cut: float = K.DECISION_THRESHOLD, by=()) -> DataFrame:
    pred = (F.col(score) >= cut)
    y = _y(label) == 1
    aggs = [F.count_if(pred & y).alias("tp"), F.count_if(pred & ~y).alias("fp"),
            F.count_if(~pred & ~y).alias("tn"), F.count_if(~pred & y).alias("fn")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def _from_confusion(c: DataFrame, by=()) -> DataFrame:
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    z = F.lit(0.0)
    return c.select(*by, (tp + fp + tn + fn).alias("n"),
                    F.coalesce(X.ratio(tp + tn, tp + fp + tn + fn), z).alias("accuracy"),
                    F.coalesce(X.ratio(tp, tp + fp), z).alias("precision"),
                    F.coalesce(X.ratio(tp, tp + fn), z).alias("recall"),
                    F.coalesce(X.ratio(2 * tp, 2 * tp + fp + fn), z).alias("f1"))


def threshold_metrics(df: DataFrame, label: str, score: str, cut: float = K.DECISION_THRESHOLD) -> DataFrame:
    """Accuracy, precision, recall, F1 at a cut; 0/0 -> 0."""
    return _from_confusion(confusion(df, label, score, cut))


def segment_metrics(df: DataFrame, label: str, score: str, by: list[str], cut: float = K.DECISION_THRESHOLD) -> DataFrame:
    """M01 per segment, with n."""
    return _from_confusion(confusion(df, label, score, cut, by), by)


def _by_score(df, label, score, by=()):
    s = F.coalesce(F.col(score).cast("double"), F.lit(0.0))
    return df.groupBy(*by, s.alias("_s")).agg(F.count_if(_y(label) == 1).alias("_np"),
                                              F.count_if(_y(label) != 1).alias("_nn"))


def roc_auc(df: DataFrame, label: str, score: str, by: list[str] | None = None, **kw) -> DataFrame:
    """ROC AUC by rank-sum over distinct scores; 0 when one class.

    sum over scores of pos(s) * (neg below s + neg(s) / 2), computed in
    integers (times two) and divided once, so the value is exact.
    """
    by = list(by or [])
    g = _by_score(df, label, score, by)
    pre, _ = O.ordered_prefix(g, by + ["_s"], ["_nn"], **kw)
    if by:
        starts = pre.groupBy(*by).agg(F.min("_before__nn").alias("_g0"))
        pre = pre.join(starts, by).withColumn("_before__nn", F.col("_before__nn") - F.col("_g0"))
    num = 2 * F.col("_np") * F.col("_before__nn") + F.col("_np") * F.col("_nn")
    aggs = [F.sum(num).alias("_num"), F.sum("_np").alias("_p"), F.sum("_nn").alias("_n")]
    r = pre.groupBy(*by).agg(*aggs) if by else pre.agg(*aggs)
    auc = F.when((F.col("_p") == 0) | (F.col("_n") == 0), F.lit(0.0)) \
        .otherwise(F.col("_num").cast("double") / (F.lit(2.0) * F.col("_p") * F.col("_n")))
    return r.select(*by, auc.alias("roc_auc"))


def average_precision(df: DataFrame, label: str, score: str, by: list[str] | None = None, **kw) -> DataFrame:
    """Step-sum average precision over distinct thresholds (M03); 0 when one class."""
    by = list(by or [])
    g = _by_score(df, label, score, by)
    pre, _ = O.ordered_prefix(g, by + [("_s", True)], ["_np", "_nn"], **kw)
    if by:
        starts = pre.groupBy(*by).agg(F.min("_before__np").alias("_gp"), F.min("_before__nn").alias("_gn"))
        pre = pre.join(starts, by).withColumn("_before__np", F.col("_before__np") - F.col("_gp")) \
            .withColumn("_before__nn", F.col("_before__nn") - F.col("_gn"))
    tp = F.col("_before__np") + F.col("_np")
    fp = F.col("_before__nn") + F.col("_nn")
    term = F.col("_np").cast("double") * tp / (tp + fp)
    aggs = [F.sum(term).alias("_t"), F.sum("_np").alias("_p"), F.sum("_nn").alias("_n")]
    r = pre.groupBy(*by).agg(*aggs) if by else pre.agg(*aggs)
    ap = F.when((F.col("_p") == 0) | (F.col("_n") == 0), F.lit(0.0)).otherwise(F.col("_t") / F.col("_p"))
    return r.select(*by, ap.alias("average_precision"))


def _top_array(df: DataFrame, label: str, score: str, id_col: str, k: int):
    """The top ``k`` rows (TakeOrderedAndProject: each task keeps its own top k) as one sorted array of
    (-score, id, y) structs: at most k elements, so every rank metric is one aggregate, no window."""
    top = O.top_k(df.select(score, label, id_col), [(score, True)], k, id_col)
    item = F.struct((-F.col(score).cast("double")).alias("s"), F.col(id_col).alias("i"), _y(label).alias("y"))
    return top.agg(F.sort_array(F.collect_list(item)).alias("_a"))


def precision_at_k(df: DataFrame, label: str, score: str, id_col: str, ks=K.PRECISION_KS) -> DataFrame:
    """P@K for several K; k capped at n, empty -> 0; ties by id."""
    a = _top_array(df, label, score, id_col, max(ks))
    cols = []
    for k in ks:
        head = F.slice(F.col("_a"), 1, k)
        hits = F.aggregate(head, F.lit(0).cast("long"), lambda acc, x: acc + x["y"])
        cols.append(F.when(F.size(head) > 0, hits / F.size(head)).otherwise(F.lit(0.0)).alias(f"precision_at_{k}"))
    return a.select(*cols)


def grouped_precision_at_k(df: DataFrame, label: str, score: str, id_col: str, k: int, by: list[str]) -> DataFrame:
    """P@K per group (M04 by segment or fold): ties by id, k capped at the group's rows.

    The rank limit is applied in every task before the shuffle (window group limit), so a group sends at most k rows a task.
    """
    w = Window.partitionBy(*by).orderBy(F.col(score).desc(), F.col(id_col).asc())
    top = df.select(*by, _y(label).alias("_y"), score, id_col).withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k)
    return top.groupBy(*by).agg(F.avg(F.col("_y").cast("double")).alias(f"precision_at_{k}"))


def precision_at_k_ties(df: DataFrame, label: str, score: str, k: int, id_col: str) -> DataFrame:
    """Tie-aware expected P@K (M05): rows above the boundary tie block count fully,
    the free slots take the block's positive rate."""
    kth = O.top_k(df.select(score, id_col), [(score, True)], k, id_col).agg(F.min(score).alias("_sk"))
    j = df.select(score, label).crossJoin(F.broadcast(kth))
    s = F.col(score)
    c = j.agg(F.count_if(s > F.col("_sk")).alias("_a"), F.sum(F.when(s > F.col("_sk"), _y(label)).otherwise(0)).alias("_pa"),
              F.count_if(s == F.col("_sk")).alias("_t"), F.sum(F.when(s == F.col("_sk"), _y(label)).otherwise(0)).alias("_pt"),
              F.count(F.lit(1)).alias("_n"))
    kk = F.least(F.lit(k), F.col("_n"))
    free = kk - F.col("_a")
    val = (F.col("_pa") + free * X.ratio("_pt", "_t")) / kk
    return c.select(F.lit(k).alias("k"), F.coalesce(val, F.lit(0.0)).alias("expected_precision_at_k"))


def class_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Per class P/R/F1/support, accuracy, macro and weighted averages."""
    y, p = _y(label), F.col(pred).cast("long")
    c = df.agg(F.count_if((p == 1) & (y == 1)).alias("tp"), F.count_if((p == 1) & (y == 0)).alias("fp"),
               F.count_if((p == 0) & (y == 0)).alias("tn"), F.count_if((p == 0) & (y == 1)).alias("fn"))
    z = F.lit(0.0)

    def prf(tp, fp, fn, name, support):
        pr = F.coalesce(X.ratio(tp, tp + fp), z)
        rc = F.coalesce(X.ratio(tp, tp + fn), z)
        f1 = F.coalesce(X.ratio(2 * tp, 2 * tp + fp + fn), z)
        return c.select(F.lit(name).alias("class"), pr.alias("precision"), rc.alias("recall"), f1.alias("f1"),
                        support.cast("long").alias("support"))

    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    c1 = prf(tp, fp, fn, "1", tp + fn)
    c0 = prf(tn, fn, fp, "0", tn + fp)
    both = c0.unionByName(c1)
    n = tp + fp + tn + fn
    acc = c.select(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                   F.lit(None).cast("double").alias("recall"), F.coalesce(X.ratio(tp + tn, n), z).alias("f1"),
                   n.cast("long").alias("support"))
    macro = both.agg(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"),
                     F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), F.sum("support").alias("support"))
    wsum = F.sum("support")
    weighted = both.agg(F.lit("weighted avg").alias("class"),
                        (F.sum(F.col("precision") * F.col("support")) / wsum).alias("precision"),
                        (F.sum(F.col("recall") * F.col("support")) / wsum).alias("recall"),
                        (F.sum(F.col("f1") * F.col("support")) / wsum).alias("f1"), wsum.alias("support"))
    return reduce(DataFrame.unionByName, [both, acc, macro, weighted])


def roc_points(df: DataFrame, label: str, score: str, **kw) -> DataFrame:
    """ROC curve: one point per distinct threshold, descending, plus the origin."""
    g = _by_score(df, label, score)
    pre, tot = O.ordered_prefix(g, [("_s", True)], ["_np", "_nn"], **kw)
    P, N = float(tot["_np"]), float(tot["_nn"])
    pts = pre.select(F.col("_s").alias("threshold"),
                     ((F.col("_before__nn") + F.col("_nn")) / F.lit(N if N else float("nan"))).alias("fpr"),
                     ((F.col("_before__np") + F.col("_np")) / F.lit(P if P else float("nan"))).alias("tpr"))
    origin = df.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return origin.unionByName(pts)


def lift(metric_df: DataFrame, df: DataFrame, label: str, metric_cols: list[str]) -> DataFrame:
    """Base rate and lift next to each metric."""
    base = df.agg(F.avg(_y(label).cast("double")).alias("base_rate"))
    j = metric_df.crossJoin(F.broadcast(base))
    return j.select("*", *[(F.col(c) / F.col("base_rate")).alias(f"{c}_lift") for c in metric_cols])


def metric_rows(scores: DataFrame, label: str, score: str, id_col: str, by: str = "model", ks=K.PRECISION_KS, **kw) -> DataFrame:
    """All headline metrics per value of ``by`` (M09, E08): one grouped pass for the counts at the cut, one ordered prefix each
    for AUC and AP, one rank-limited window for P@K, whatever the number of scores compared."""
    rows = O.materialized(scores.select(by, label, score, id_col))
    w = Window.partitionBy(by).orderBy(F.col(score).desc(), F.col(id_col).asc())
    top = rows.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= max(ks)).groupBy(by) \
        .agg(*[F.avg(F.when(F.col("_r") <= k, _y(label).cast("double"))).alias(f"precision_at_{k}") for k in ks])
    t = segment_metrics(rows, label, score, [by])
    return t.join(roc_auc(rows, label, score, by=[by], **kw), by).join(average_precision(rows, label, score, by=[by], **kw), by).join(top, by)


def metric_row(df: DataFrame, label: str, score: str, id_col: str, name: str, **kw) -> DataFrame:
    """One row of all headline metrics for one score column."""
    return metric_rows(df.withColumn("model", F.lit(name)), label, score, id_col, **kw)


def compare(df: DataFrame, label: str, scores: dict[str, str], id_col: str, **kw) -> DataFrame:
    """Comparison table: one row per score column on the same rows."""
    long = F.array(*[F.struct(F.lit(n).alias("model"), F.col(c).cast("double").alias("_score")) for n, c in scores.items()])
    return metric_rows(df.select(label, id_col, F.inline(long)), label, "_score", id_col, **kw)


def best_model(metrics: DataFrame, fit_order: list[str] = ()) -> DataFrame:
    """max (P@50, AP, AUC), ties to the model fitted first, then by name."""
    first = F.array_position(F.array(*[F.lit(m) for m in fit_order]).cast("array<string>"), F.col("model"))
    return metrics.orderBy(F.col("precision_at_50").desc(), F.col("average_precision").desc(), F.col("roc_auc").desc(),
                           F.when(first > 0, first).asc_nulls_last(), F.col("model").asc()).limit(1)


def majority_rate(df: DataFrame, label: str) -> DataFrame:
    """Majority-class baseline accuracy."""
    m = F.avg(_y(label).cast("double"))
    return df.agg(F.greatest(m, 1 - m).alias("majority_rate"))


def rank_metrics(df: DataFrame, label: str, score: str, id_col: str, k: int) -> DataFrame:
    """Recall@K, NDCG@K (binary gain, log2 discount) and AP@K over one ranked list."""
    a = _top_array(df, label, score, id_col, k)
    P = df.agg(F.sum(_y(label)).alias("_P"))
    ys = F.transform(F.col("_a"), lambda x: x["y"])
    tp = F.aggregate(ys, F.lit(0).cast("long"), lambda acc, y: acc + y)
    dcg = F.aggregate(F.transform(ys, lambda y, i: y / F.log2(i + 2)), F.lit(0.0), lambda acc, v: acc + v)
    # AP@K: sum over hit positions i (1-based) of hits-so-far / i
    ap = F.aggregate(F.transform(ys, lambda y, i: F.when(y == 1, F.aggregate(F.slice(ys, 1, i + 1), F.lit(0).cast("long"),
                                                                       lambda acc, v: acc + v) / (i + 1))
                                 .otherwise(F.lit(0.0))), F.lit(0.0), lambda acc, v: acc + v)
    j = a.select(tp.alias("_tp"), dcg.alias("_dcg"), ap.alias("_ap")).crossJoin(P)
    ideal = F.aggregate(F.sequence(F.lit(1), F.least(F.lit(k), F.col("_P")).cast("int")), F.lit(0.0),
                        lambda acc, i: acc + 1 / F.log2(i + 1))
    return j.select(F.lit(k).alias("k"),
                    F.coalesce(X.ratio("_tp", "_P"), F.lit(0.0)).alias("recall_at_k"),
                    F.when(F.col("_P") > 0, F.col("_dcg") / ideal).otherwise(0.0).alias("ndcg_at_k"),
                    F.coalesce(F.col("_ap") / F.least(F.lit(k), F.col("_P")), F.lit(0.0)).alias("ap_at_k"))


def calibration(df: DataFrame, label: str, score: str, bins: int = 10) -> DataFrame:
    """Calibration bins: floor(p * bins), p = 1 in the top bin."""
    b = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return df.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_score"),
                                          F.avg(_y(label).cast("double")).alias("positive_rate"))


def poisson_edges() -> list[float]:
    """Cumulative Poisson(1) probabilities below 1; a uniform's weight is the number of edges it reaches."""
    edges, p, total, k = [], math.exp(-1), 0.0, 0
    while total + p < 1.0 and total + p > total:
        total += p
        edges.append(total)
        k += 1
        p /= k
    return edges


def poisson_weights(key: Column, reps: int, seed: int) -> Column:
    """Poisson(1) weights of a key for replicates 1 .. reps, as one array of doubles.

    52 bits of an md5 of (key, replicate, seed) are the uniform; its weight follows from the inverse distribution
    without a cut tail.
    """
    def uniform(rep):
        digits = F.substring(F.md5(F.concat_ws("|", key.cast("string"), rep.cast("string"), F.lit(str(seed)))), 1, 13)
        return F.conv(digits, 16, 10).cast("long") / F.lit(float(1 << 52))

    u = F.transform(F.sequence(F.lit(1), F.lit(reps)), uniform)
    return F.transform(u, lambda x: reduce(lambda s, e: s + (x >= F.lit(e)).cast("int"), poisson_edges(), F.lit(0)).cast("double"))


def _array_sums(df: DataFrame, arrays: dict[str, Column], reps: int, by: list[str] | None = None, whole: bool = True) -> DataFrame:
    """Element-wise sums of arrays of ``reps`` doubles, partially summed in every task: no row per element.

    MLlib's summarizer keeps running means, so sums of whole numbers are rounded back to whole ones.
    """
    def back(name):
        a = vector_to_array(F.col(name))
        return F.transform(a, lambda x: F.round(x)) if whole else a

    rows = df.select(*(by or []), *[array_to_vector(c).alias(n) for n, c in arrays.items()])
    if not by:  # the summarizer needs a row
        zero = array_to_vector(F.array_repeat(F.lit(0.0), reps))
        rows = rows.unionByName(df.sparkSession.range(1).select(*[zero.alias(n) for n in arrays]))
    sums = [Summarizer.sum(F.col(n)).alias(n) for n in arrays]
    g = rows.groupBy(*by).agg(*sums) if by else rows.agg(*sums)
    return g.select(*(by or []), *[back(n).alias(n) for n in arrays])


def _times(w: Column, x) -> Column:
    return F.transform(w, lambda v: v * x)


def _ratio(a: Column, b: Column) -> Column:
    """a / b element by element, 0 where b is 0."""
    return F.zip_with(a, b, lambda x, y: F.when(y > 0, x / y).otherwise(F.lit(0.0)))


def _weighted_accuracy(rows: DataFrame, weights: DataFrame, label: str, scores: dict[str, str], reps: int, cut: float) -> DataFrame:
    right = [F.sum(((F.col(c) >= cut).cast("long") == _y(label)).cast("long")).alias(f"_n{i}") for i, c in enumerate(scores.values())]
    per = rows.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"), *right).join(weights, "_g")
    tot = _array_sums(per, {"_n": _times(F.col("_w"), F.col("_n")), **{f"_n{i}": _times(F.col("_w"), F.col(f"_n{i}")) for i in range(len(scores))}}, reps)
    return tot.select(*[_ratio(F.col(f"_n{i}"), F.col("_n")).alias(n) for i, n in enumerate(scores)])


def _weighted_precision(rows: DataFrame, weights: DataFrame, label: str, score: str, id_col: str, reps: int, k: int, **kw) -> DataFrame:
    """Precision among the first k of the resampled rows. A client's rows beyond its first k are never among them: where
    the client is drawn at all, its first k rows alone fill the list."""
    order = [F.col("_s").desc(), F.col(id_col).asc()]
    own = rows.select("_g", id_col, _y(label).alias("_y"), F.coalesce(F.col(score).cast("double"), F.lit(0.0)).alias("_s"))
    first = own.withColumn("_r", F.row_number().over(Window.partitionBy("_g").orderBy(*order))).filter(F.col("_r") <= k).drop("_r")
    pre = O.ordered_array_prefix(first.join(weights, "_g"), [("_s", True), id_col], "_w", reps, **kw)
    taken = F.zip_with(F.col("_w"), F.col("_before__w"), lambda w, b: F.greatest(F.least(w, F.lit(float(k)) - b), F.lit(0.0)))
    hits = pre.filter(F.array_min("_before__w") < k).select("_y", taken.alias("_t"))
    tot = _array_sums(hits, {"_h": _times(F.col("_t"), F.col("_y")), "_t": F.col("_t")}, reps)
    return tot.select(_ratio(F.col("_h"), F.col("_t")).alias("_m"))


AP_ROWS_PER_BUCKET = 100_000  # (group, score) rows whose replicates one task adds up
AP_CHUNK = 4_096              # rows of which a task holds all replicates at a time


def _ap_terms(rows: pd.DataFrame, weights: pd.DataFrame) -> pd.DataFrame:
    """Sum over a bucket's distinct scores, descending, of positives * precision, for every replicate. ``rows``: (_g, _s, _np, _na);
    ``weights``: (_key, _weights, _off), _off being positives, then rows, of the buckets before."""
    w, off = np.stack(weights["_weights"].to_numpy()), np.asarray(weights["_off"].iloc[0], dtype=float)
    reps = w.shape[1]
    tp, n, out = off[:reps].copy(), off[reps:].copy(), np.zeros(reps)
    s = rows["_s"].to_numpy()
    order = np.lexsort((-s, ~np.isnan(s)))  # NaN is the greatest number, as in Spark's order
    s = s[order]
    g = pd.Index(weights["_key"]).get_indexer(rows["_g"])[order]
    pos, al = rows["_np"].to_numpy()[order], rows["_na"].to_numpy()[order]
    new = np.flatnonzero(np.r_[True, (s[1:] != s[:-1]) & ~(np.isnan(s[1:]) & np.isnan(s[:-1]))])
    first = 0
    while first < len(new):  # whole scores, about AP_CHUNK rows
        last = max(first + 1, int(np.searchsorted(new, new[first] + AP_CHUNK)))
        lo, hi = new[first], new[last] if last < len(new) else len(s)
        p = a = 0
        starts = new[first:last] - lo
        if last - first == 1:  # one score may hold any number of groups: added up piece by piece
            for i in range(lo, hi, AP_CHUNK):
                k = slice(i, min(hi, i + AP_CHUNK))
                p, a = p + pos[k] @ w[g[k]], a + al[k] @ w[g[k]]
            p, a = p[None, :], a[None, :]
        else:
            p = np.add.reduceat(w[g[lo:hi]] * pos[lo:hi, None], starts)
            a = np.add.reduceat(w[g[lo:hi]] * al[lo:hi, None], starts)
        cp, ca = tp + np.cumsum(p, axis=0), n + np.cumsum(a, axis=0)
        out += (p * np.divide(cp, ca, out=np.zeros_like(cp), where=ca > 0)).sum(axis=0)
        tp, n, first = cp[-1], ca[-1], last
    return pd.DataFrame({"_t": [out]})


def _weighted_ap(rows: DataFrame, weights: DataFrame, label: str, score: str, reps: int, rows_per_bucket: int | None = None, **kw) -> DataFrame:
    """Step-sum average precision of the resampled rows, over distinct scores; 0 where a replicate has one class.

    Rows of one group and score are counted first and dealt to buckets by score. A bucket's totals are sums over its groups,
    so the arrays of replicates are one per bucket and group, not one per score; inside a bucket the
    replicates are added up in order of the scores by whole-array operations.
    """
    per = rows.groupBy("_g", F.coalesce(F.col(score).cast("double"), F.lit(0.0)).alias("_s")).agg(
        F.count_if(_y(label) == 1).alias("_np"), F.count(F.lit(1)).alias("_na"))
    b = O.bucketed(per, [("_s", True)], rows_per_bucket=rows_per_bucket or AP_ROWS_PER_BUCKET, **kw)
    drawn = O.materialized(b.groupBy("_bucket", "_g").agg(F.sum("_np").alias("_np"), F.sum("_na").alias("_na")).join(weights, "_g"))
    totals = _array_sums(drawn, {"_v": F.concat(_times(F.col("_w"), F.col("_np")), _times(F.col("_w"), F.col("_na")))}, 2 * reps, by=["_bucket"])
    run, offsets = [0.0] * (2 * reps), []
    for r in sorted(totals.collect(), key=lambda r: r["_bucket"]):  # one row a bucket
        offsets.append((r["_bucket"], list(run)))
        run = [x + y for x, y in zip(run, r["_v"])]
    spark = rows.sparkSession
    off = spark.createDataFrame(offsets, "_bucket int, _off array<double>")
    own = drawn.join(off, "_bucket").select(F.col("_bucket").alias("_of"), F.col("_g").alias("_key"), F.col("_w").alias("_weights"), "_off")
    terms = b.groupBy("_bucket").cogroup(own.groupBy("_of")).applyInPandas(_ap_terms, "_t array<double>")
    whole = spark.createDataFrame([(run[:reps], run[reps:])], "_p array<double>, _a array<double>")
    tot = _array_sums(terms, {"_t": F.col("_t")}, reps, whole=False).crossJoin(whole)
    ap = F.zip_with(_ratio(F.col("_t"), F.col("_p")), F.zip_with(F.col("_p"), F.col("_a"), lambda p, a: p < a), lambda x, ok: F.when(ok, x).otherwise(F.lit(0.0)))
    return tot.select(ap.alias("_m"))


def bootstrap_by_group(df: DataFrame, label: str, a: str, b: str, id_col: str, group: str, metrics=("accuracy", "precision_at_50", "average_precision"),
                       reps: int = 200, seed: int = 42, cut: float = K.DECISION_THRESHOLD, **kw) -> DataFrame:
    """Bootstrap intervals of metric differences a - b, resampling whole groups such as clients.

    A group's Poisson(1) weights are one array of ``reps`` numbers; every replicate of a metric is an element of array
    sums and array prefixes, so the rows are passed once whatever ``reps`` is. Rows of a group are kept or left out
    together, so pages of one client are no independent draws. Returns (metric, mean_diff, lo, hi, reps).
    """
    ensure_checkpoint_dir(df.sparkSession)
    rows = df.select(F.coalesce(F.col(group).cast("string"), F.lit(K.UNKNOWN)).alias("_g"), id_col, label, a, b).checkpoint(eager=True)
    weights = rows.select("_g").distinct().withColumn("_w", poisson_weights(F.col("_g"), reps, seed))
    out = []
    for m in metrics:
        if m == "accuracy":
            x = _weighted_accuracy(rows, weights, label, {"_a": a, "_b": b}, reps, cut)
        elif m.startswith("precision_at_"):
            x = reduce(DataFrame.crossJoin, [_weighted_precision(rows, weights, label, c, id_col, reps, int(m[13:]), **kw).withColumnRenamed("_m", n) for n, c in (("_a", a), ("_b", b))])
        elif m == "average_precision":
            x = reduce(DataFrame.crossJoin, [_weighted_ap(rows, weights, label, c, reps, **kw).withColumnRenamed("_m", n) for n, c in (("_a", a), ("_b", b))])
        else:
            raise ValueError(f"no metric {m}")
        d = x.select(F.explode(F.zip_with("_a", "_b", lambda p, q: p - q)).alias("diff"))
        out.append(d.agg(F.lit(m).alias("metric"), F.avg("diff").alias("mean_diff"), F.percentile("diff", 0.025).alias("lo"),
                         F.percentile("diff", 0.975).alias("hi"), F.count(F.lit(1)).alias("reps")))
    return reduce(DataFrame.unionByName, out)


def bootstrap_diff(df: DataFrame, label: str, a: str, b: str, id_col: str, reps: int = 200, seed: int = 42,
                   cut: float = K.DECISION_THRESHOLD) -> DataFrame:
    """Bootstrap interval of an accuracy difference, resampling rows.

    The weights of a row are one array; replicates are elements of two array sums, not rows. Returns the mean
    difference and the 2.5 / 97.5 % points.
    """
    y = _y(label)
    d = ((F.col(a) >= cut).cast("long") == y).cast("double") - ((F.col(b) >= cut).cast("long") == y).cast("double")
    x = df.select(d.alias("_d"), poisson_weights(F.col(id_col), reps, seed).alias("_w"))
    tot = _array_sums(x, {"_n": _times(F.col("_w"), F.col("_d")), "_t": F.col("_w")}, reps)
    rep = tot.select(F.explode(F.zip_with("_n", "_t", lambda n, t: F.when(t > 0, n / t))).alias("diff"))
    return rep.agg(F.avg("diff").alias("mean_diff"), F.percentile("diff", 0.025).alias("lo"),
                   F.percentile("diff", 0.975).alias("hi"), F.count(F.lit(1)).alias("reps"))
