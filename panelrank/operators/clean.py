"""Snapshot cleaning and feature preparation.

One ``select`` per step; every rule is a native expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelrank import constants as K
from panelrank.functions import exprs as X


def clean_snapshot(df: DataFrame, numeric=K.NUMERIC_COLUMNS, boolean=K.BOOLEAN_COLUMNS,
                   categorical=K.CATEGORICAL_COLUMNS) -> DataFrame:
    """Coerce and fill the snapshot.

    Numerics: bad text -> NULL -> 0, NaN/Inf -> 0; absent -> 0.
    Booleans: true/1/yes/y -> true; absent -> false.
    Categories: NULL, '' and 'nan' -> 'unknown'; absent -> 'unknown'.
    """
    cols = []
    done = set()
    for c in df.columns:
        if c in numeric:
            x = X.numeric_coerce(c) if dict(df.dtypes)[c] == "string" else X.nan_to_null(c)
            cols.append(F.coalesce(x, F.lit(0.0)).alias(c))
        elif c in boolean:
            cols.append(X.bool_coerce(c).alias(c))
        elif c in categorical:
            cols.append(X.category_normalize(c).alias(c))
        else:
            cols.append(F.col(c))
        done.add(c)
    cols += [F.lit(0.0).alias(c) for c in numeric if c not in done]
    cols += [F.lit(False).alias(c) for c in boolean if c not in done]
    cols += [F.lit(K.UNKNOWN).alias(c) for c in categorical if c not in done]
    return df.select(*cols)


def missing_flags(df: DataFrame, cols: list[str]) -> DataFrame:
    """``has_<col>`` = 1 when the raw value is present (C05), before filling."""
    return df.select("*", *[F.col(c).isNotNull().cast("int").alias(f"has_{c}") for c in cols])


def dedupe_first(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Keep the first row per key by an explicit ascending order."""
    from panelrank.sources.tables import build_dim_content
    return build_dim_content(df, key, order)


def assert_unique(df: DataFrame, key: str) -> None:
    """Raise when a key occurs twice: joins on it would multiply rows."""
    twice = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(key).first()
    if twice is not None:
        raise ValueError(f"{key} is not unique: {twice[0]!r} occurs more than once")


def prepare_features(df: DataFrame, min_age: int = 90, order: list[str] | None = None,
                     key: str = "content_id") -> DataFrame:
    """Scope filter, dedupe, label, log features and flags.

    ``order`` names the column that decides which duplicate is first (the
    reference used file order); without one, ids are assumed unique.
    """
    x = df.filter((F.col("impressions_90d") > 0) & (F.col("content_age_days") >= min_age))
    if order:
        x = dedupe_first(x, key, order)
    return x.select(
        "*",
        (F.lower(F.col("trend_direction")) == "down").cast("int").alias("is_declining_label"),
        X.log1p0("impressions_90d").alias("log_impressions_90d"),
        X.log1p0("clicks_90d").alias("log_clicks_90d"),
        X.log1p0("sessions_90d").alias("log_sessions_90d"),
        X.log1p0("ai_sessions_90d").alias("log_ai_sessions_90d"),
        (F.col("clicks_90d") > 0).cast("int").alias("has_clicks"),
        (F.col("ai_sessions_90d") > 0).cast("int").alias("has_ai_sessions"),
        ((F.col("impressions_90d") >= 100) & (F.col("sessions_90d") > 0)).cast("int").alias("measurable_opportunity"),
    )


def minmax(df: DataFrame, col: str, out: str) -> DataFrame:
    """Min-max normalize (C12): NULL/Inf -> 0; constant column -> all 0.

    The min and max are one partial aggregate (a single row), joined back
    as a broadcast of that one row.
    """
    v = F.coalesce(X.nan_to_null(col), F.lit(0.0))
    b = df.agg(F.min(v).alias("_lo"), F.max(v).alias("_hi"))
    j = df.crossJoin(F.broadcast(b))
    span = F.col("_hi") - F.col("_lo")
    res = F.when(span > 0, (v - F.col("_lo")) / span).otherwise(F.lit(0.0))
    return j.withColumn(out, res).drop("_lo", "_hi")


# ---------------------------------------------------------------- predicates (F)
def volume_floor(df: DataFrame, col: str, n: int) -> DataFrame:
    """Minimum-volume floor."""
    return df.filter(F.col(col) >= n)


def count_where(df: DataFrame, conds: dict) -> DataFrame:
    """One row of ``count_if`` per named condition."""
    return df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in conds.items()])


def at_risk(df: DataFrame, prev: str = "imp_prev", prob: str = "decline_probability",
            min_prev: int = K.PLAYBOOK["prev"], min_prob: float = K.PLAYBOOK["prob"]) -> DataFrame:
    """At-risk filter (F04): ``prev > 500 AND prob > 0.6``."""
    return df.filter((F.col(prev) > min_prev) & (F.col(prob) > min_prob))


def after_start(fact: DataFrame, dim: DataFrame, key: str = "client_id", start: str = "start_date",
                date_col: str = "report_date") -> DataFrame:
    """Keep days on/after the client's start (F05); unknown start keeps nothing.

    The client dimension is one row per client; Spark broadcasts it where its size allows. The range test is a
    filter after the equi join.
    """
    return fact.join(dim.select(key, start), key, "inner").filter(F.col(date_col) >= F.col(start)).drop(start)


def history_depth(dim: DataFrame, start: str = "start_date", days: int = K.HISTORY_DAYS) -> DataFrame:
    """Clients with >= ``days`` of history: start <= latest start - days."""
    latest = dim.agg(F.max(start).alias("_latest"))
    j = dim.crossJoin(F.broadcast(latest))
    return j.agg(F.count_if(F.col(start) <= F.date_sub("_latest", days)).alias("clients_with_history"),
                 F.count(F.col(start)).alias("clients_with_start"),
                 F.count(F.lit(1)).alias("clients"))


def in_set(df: DataFrame, ids: DataFrame, key: str, anti: bool = False) -> DataFrame:
    """Membership filter as a left semi / anti join."""
    return df.join(ids.select(key).distinct(), key, "left_anti" if anti else "left_semi")

