"""Mergeable quantile sketches (A09, opt-in).

Exact quantiles shuffle the distinct values; where an error in rank is acceptable, a KLL sketch of each group and day or month is
a few kilobytes, can be kept in a table, and is merged with others at any time: a report over a year merges kept
rows and reads no facts. A sketch of size ``k`` answers with a rank error of about 2.3 / k ** 0.9 of the rows at 99 %
confidence; groups of fewer than ``k`` values are exact. NULL, NaN and infinite values are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelrank.functions import exprs as X

SIZE = 400


def rank_error(size: int = SIZE) -> float:
    """Share of the rows by which a quantile's rank may be off, at 99 % confidence."""
    return 2.296 / size ** 0.9021


def quantile_sketch(df: DataFrame, by: list[str], col: str, size: int = SIZE) -> DataFrame:
    """(by..., n, sketch): built in every task, merged after a shuffle of one sketch per task and group."""
    v = X.nan_to_null(col)
    return df.groupBy(*by).agg(F.count(v).alias("n"), F.kll_sketch_agg_double(v, size).alias("sketch"))


def merge_sketches(sketches: DataFrame, by: list[str] = (), size: int = SIZE) -> DataFrame:
    """Kept sketches merged to coarser groups; groups without values keep n = 0."""
    agg = [F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", size).alias("sketch")]
    return sketches.groupBy(*by).agg(*agg) if by else sketches.agg(*agg)


def sketch_quantiles(sketches: DataFrame, qs: list[float], prefix: str = "q") -> DataFrame:
    """The columns but the sketch, plus ``q0, q1, ...``: NULL where a group has no values."""
    keep = [c for c in sketches.columns if c != "sketch"]
    return sketches.select(*keep, *[F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(float(q)))).alias(f"{prefix}{i}") for i, q in enumerate(qs)])


def rank_check(df: DataFrame, by: list[str], col: str, found: DataFrame, qs: list[float], prefix: str = "q") -> DataFrame:
    """(by..., q, n, value, rank_low, rank_high): the exact share of the group's rows below, and at or below, each sketched quantile."""
    v = X.nan_to_null(col)
    points = found.select(*by, F.posexplode(F.array(*[F.col(f"{prefix}{i}") for i in range(len(qs))])).alias("_i", "value"))
    q = F.element_at(F.array(*[F.lit(float(x)) for x in qs]), F.col("_i") + 1)
    vals = df.filter(v.isNotNull()).groupBy(*by, v.alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    # a row per distinct value and asked quantile of its group: a few quantiles, no pairs of rows
    j = vals.join(points, by) if by else vals.crossJoin(F.broadcast(points))
    g = j.groupBy(*by, "_i").agg(F.sum("_n").alias("n"), F.first("value").alias("value"), F.sum(F.when(F.col("_v") < F.col("value"), F.col("_n")).otherwise(0)).alias("_lo"),
                                 F.sum(F.when(F.col("_v") <= F.col("value"), F.col("_n")).otherwise(0)).alias("_hi"))
    return g.select(*by, q.alias("q"), "n", "value", (F.col("_lo") / F.col("n")).alias("rank_low"), (F.col("_hi") / F.col("n")).alias("rank_high"))
