"""Aggregations and profiles.

Exact quantiles and medians are computed with the ordered prefix (D-04)
over distinct values, never by holding a group's values in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelrank.functions import exprs as X
from panelrank.operators import ordered as O


# ---------------------------------------------------------------- quantiles
def grouped_quantiles(df: DataFrame, by: list[str], col: str, qs: list[float], prefix: str = "q",
                      approx: int | None = None, **kw) -> DataFrame:
    """Exact quantiles with linear interpolation per group (pandas / ``percentile``).

    NULL values are skipped. Per group: n, then for each q the values at
    positions floor(h) and ceil(h), h = (n - 1) q, from a prefix count over
    distinct (group, value) pairs. ``approx=<accuracy>`` opts into
    ``percentile_approx`` (a bounded sketch per group, one pass, not exact).
    """
    by = list(by)
    v = F.col(col).cast("double")
    if approx:
        a = F.percentile_approx(v, [float(q) for q in qs], approx).alias("_qa")
        g = df.groupBy(*by).agg(a) if by else df.agg(a)
        return g.select(*by, *[F.col("_qa")[i].alias(f"{prefix}{i}") for i in range(len(qs))])
    vals = df.filter(v.isNotNull()).groupBy(*by, v.alias("_v")).agg(F.count(F.lit(1)).alias("_cnt"))
    if by:
        # ordered prefix over (group..., value); group starts subtracted below
        pre, _ = O.ordered_prefix(vals, by + ["_v"], ["_cnt"], **kw)
        starts = pre.groupBy(*by).agg(F.min("_before__cnt").alias("_g0"), F.sum("_cnt").alias("_n"))
        pre = pre.join(starts, by, "inner").withColumn("_b", F.col("_before__cnt") - F.col("_g0"))
    else:
        pre, tot = O.ordered_prefix(vals, ["_v"], ["_cnt"], **kw)
        pre = pre.withColumn("_n", F.lit(tot["_cnt"])).withColumn("_b", F.col("_before__cnt"))
    aggs = []
    for i, q in enumerate(qs):
        h = (F.col("_n") - 1) * F.lit(float(q))
        lo, hi = F.floor(h), F.ceil(h)
        cover = lambda k: (F.col("_b") <= k) & (k < F.col("_b") + F.col("_cnt"))
        aggs += [F.min(F.when(cover(lo), F.col("_v"))).alias(f"_lo{i}"),
                 F.min(F.when(cover(hi), F.col("_v"))).alias(f"_hi{i}"),
                 F.first(h - lo, ignorenulls=True).alias(f"_f{i}")]
    g = pre.groupBy(*by).agg(*aggs) if by else pre.agg(*aggs)
    outs = [(F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}")).alias(f"{prefix}{i}")
            for i in range(len(qs))]
    return g.select(*by, *outs)


def quantiles(df: DataFrame, col: str, qs: list[float], **kw) -> DataFrame:
    """One row: ``q0, q1, ...`` for the requested quantiles."""
    return grouped_quantiles(df, [], col, qs, **kw)


# ---------------------------------------------------------------- group stats
def group_stats(df: DataFrame, by: list[str], col: str, with_median: bool = True, **kw) -> DataFrame:
    """Mean, count and exact median of ``col`` per group (A05); NULL keys dropped as pandas does."""
    base = df.filter(reduce(lambda a, b: a & b, [F.col(b).isNotNull() for b in by]))
    g = base.groupBy(*by).agg(F.avg(col).alias("mean"), F.count(F.col(col)).alias("count"))
    if with_median:
        med = grouped_quantiles(base, by, col, [0.5], prefix="median_", **kw) \
            .withColumnRenamed("median_0", "median")
        g = g.join(med, by, "left")
    return g


# ---------------------------------------------------------------- counts
def value_counts(df: DataFrame, col: str, top: int | None = None, levels: list[str] | None = None) -> DataFrame:
    """Value counts ordered by (count desc, value asc) (A06); fixed level list with 0 fill."""
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    if levels is not None:
        lv = df.sparkSession.createDataFrame([(x, i) for i, x in enumerate(levels)], f"{col} string, _ord int")
        g = lv.join(g, col, "left").na.fill(0, ["count"]).orderBy("_ord").drop("_ord")
        return g
    g = g.orderBy(F.col("count").desc(), F.col(col).asc_nulls_last())
    return g.limit(top) if top else g


def reason_counts(df: DataFrame, col: str, sep: str = "|") -> DataFrame:
    """Reason-code frequencies from an array or a delimited string."""
    dt = dict(df.dtypes)[col]
    arr = F.col(col) if dt.startswith("array") else F.split(F.col(col), "[" + sep + "]")
    x = df.select(F.explode(arr).alias("reason_code")).filter(F.col("reason_code") != "")
    return x.groupBy("reason_code").agg(F.count(F.lit(1)).alias("count"))


# ---------------------------------------------------------------- summaries
def summary(df: DataFrame, label: str, score: str, top: int = 50, id_col: str = "content_id") -> DataFrame:
    """Rows, positives, rate, max and median score, top-k positive rate (A10)."""
    base = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col(label).cast("long")).alias("positive_rows"),
                  F.avg(F.col(label).cast("double")).alias("positive_rate"), F.max(score).alias("top_score"))
    med = quantiles(df, score, [0.5]).withColumnRenamed("q0", "median_score")
    topk = O.top_k(df, [(score, True)], top, id_col).agg(F.avg(F.col(label).cast("double")).alias(f"rate_top_{top}"))
    return base.crossJoin(med).crossJoin(topk)


def span(df: DataFrame, date_col: str = "report_date", by: list[str] | None = None) -> DataFrame:
    """Row count and date span, global or per group."""
    aggs = [F.count(F.lit(1)).alias("total_rows"), F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def distinct_and_orphans(df: DataFrame, dim: DataFrame, key: str, approx: bool = False,
                         rsd: float = 0.01) -> DataFrame:
    """Distinct keys in the fact, in the dimension, and orphans on each side.

    ``approx=True`` opts into HyperLogLog counts (``approx_count_distinct``, one
    pass per side, no shuffle of keys) and leaves the orphan counts out.
    """
    if approx:
        a = df.agg(F.approx_count_distinct(key, rsd).alias("fact_keys"))
        b = dim.agg(F.approx_count_distinct(key, rsd).alias("dim_keys"))
        return a.crossJoin(b)
    f = df.select(key).distinct().withColumn("_in_fact", F.lit(1))
    d = dim.select(key).distinct().withColumn("_in_dim", F.lit(1))
    j = f.join(d, key, "full")
    return j.agg(F.count_if(F.col("_in_fact") == 1).alias("fact_keys"),
                 F.count_if(F.col("_in_dim") == 1).alias("dim_keys"),
                 F.count_if(F.col("_in_dim").isNull()).alias("fact_orphans"),
                 F.count_if(F.col("_in_fact").isNull()).alias("dim_unused"))


def flag_counts(df: DataFrame, flag: str) -> DataFrame:
    """TRUE / FALSE / NULL counts of a three-valued flag."""
    f = F.col(flag)
    return df.agg(F.count(F.lit(1)).alias("total_rows"),
                  F.count_if(X.is_true(flag)).alias("true_rows"),
                  F.count_if(f == F.lit(False)).alias("false_rows"),
                  F.count_if(f.isNull()).alias("null_rows"))


def grain_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key groups with more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > 1)


def missing_rates(df: DataFrame, cols: list[str], by: str | None = None) -> DataFrame:
    """Share of NULLs per column, overall or per category (A15); long format."""
    aggs = [F.avg(F.col(c).isNull().cast("double")).alias(f"m{i}") for i, c in enumerate(cols)]
    one = df.groupBy(by).agg(F.count(F.lit(1)).alias("rows"), *aggs) if by else \
        df.agg(F.count(F.lit(1)).alias("rows"), *aggs)
    stack = ", ".join(f"'{c}', m{i}" for i, c in enumerate(cols))
    keep = [by] if by else []
    return one.selectExpr(*keep, "rows", f"stack({len(cols)}, {stack}) as (column_name, missing_rate)")


def metric_presence(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows with metric > 0 per metric (A16); long format."""
    aggs = [F.count_if(F.col(c) > 0).alias(f"p{i}") for i, c in enumerate(cols)]
    one = df.agg(F.count(F.lit(1)).alias("rows"), *aggs)
    stack = ", ".join(f"'{c}', p{i}" for i, c in enumerate(cols))
    return one.selectExpr("rows", f"stack({len(cols)}, {stack}) as (metric, rows_positive)")


# ---------------------------------------------------------------- correlation
def correlations(df: DataFrame, pairs: list[tuple[str, str]], how: str = "pearson", **kw) -> DataFrame:
    """Pearson (pairwise complete), log-Pearson or Spearman per column pair.

    Spearman = Pearson over average ranks; ranks come from ``pct_rank``
    (scaled ranks give the same correlation) on pairwise-complete rows.
    """
    rows = []
    for a, b in pairs:
        x = df.select(F.col(a).cast("double").alias("_a"), F.col(b).cast("double").alias("_b")) \
            .filter(F.col("_a").isNotNull() & F.col("_b").isNotNull())
        if how == "log":
            x = x.select(F.log1p("_a").alias("_a"), F.log1p("_b").alias("_b"))
        elif how == "spearman":
            x = O.pct_rank(O.pct_rank(x, "_a", "_ra", **kw), "_b", "_rb", **kw).select(
                F.col("_ra").alias("_a"), F.col("_rb").alias("_b"))
        rows.append(x.agg(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.lit(how).alias("method"),
                          F.corr("_a", "_b").alias("corr"), F.count(F.lit(1)).alias("n")))
    return reduce(DataFrame.unionByName, rows)


def correlation_matrix(df: DataFrame, cols: list[str], how: str = "pearson", **kw) -> DataFrame:
    """Every pair of ``cols`` once, in their order (A18): long format, all pairs in one aggregate.

    ``spearman`` ranks all columns in one grouped pass first; a NULL ranks as 0, as in W01, and its pairs are left
    out. A column without variance has no correlation (NULL).
    """
    x = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    val = {c: F.col(c) for c in cols}
    if how == "spearman":
        x = O.pct_ranks(x, {f"_r_{c}": c for c in cols}, **kw)
        val = {c: F.when(F.col(c).isNotNull(), F.col(f"_r_{c}")) for c in cols}
    elif how == "log":
        val = {c: F.log1p(c) for c in cols}
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    one = x.agg(F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.lit(how).alias("method"),
                                   F.nanvl(F.corr(val[a], val[b]), F.lit(None).cast("double")).alias("corr"),
                                   F.count_if(val[a].isNotNull() & val[b].isNotNull()).alias("n")) for a, b in pairs])
                .alias("_m"))
    return one.select(F.inline("_m"))


def rate_vs_mean(df: DataFrame, by: list[str], num: str, den: str) -> DataFrame:
    """Denominator-weighted rate next to the mean of per-row rates, with n."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        X.ratio(F.sum(num), F.sum(den)).alias("weighted_rate"),
        F.avg(X.ratio(num, den)).alias("mean_of_rates"))
