"""Joins (J02-J07) and set operations.

Both sides of every join are reduced to the join grain first; dimension
sides are broadcast only when they are bounded (client lists, tier tables).
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelrank.operators.windows import scope_filter


def lookup(df: DataFrame, scores: DataFrame, key: str, col: str, default=0.0) -> DataFrame:
    """Map scores onto ids, missing -> default."""
    return df.join(scores.select(key, col), key, "left").na.fill({col: default})


def with_bounds(df: DataFrame, date_col: str, end: _dt.date, window: int) -> DataFrame:
    """Bounds as literals instead of a cross-joined one-row table (J04, D-05)."""
    return scope_filter(df, date_col, end - _dt.timedelta(days=window), end)


def star(fact: DataFrame, content: DataFrame, clients: DataFrame, content_key: str = "content_id",
         client_key: str = "client_id") -> DataFrame:
    """Star joins (J05): fact -> content (shuffle join, content grows with data) and
    fact -> clients (broadcast where the client list's size allows it, which Spark finds out at run time)."""
    c = content.drop(client_key) if client_key in content.columns else content
    return fact.join(c, content_key, "left").join(clients, client_key, "left")


def join_on_url(search: DataFrame, analytics: DataFrame, url: str = "url") -> DataFrame:
    """Search x analytics on landing page (J06): both sides grouped to URL first,
    then a full outer join with a match flag. Never joined on query text."""
    s = search.groupBy(url).agg(F.sum("impressions").cast("long").alias("search_impressions"),
                                F.sum("clicks").cast("long").alias("search_clicks"))
    a = analytics.groupBy(url).agg(F.sum("sessions").cast("long").alias("sessions"),
                                   F.sum("engaged_sessions").cast("long").alias("engaged_sessions"))
    j = s.join(a, url, "full")
    match = (F.when(F.col("search_impressions").isNotNull() & F.col("sessions").isNotNull(), "both")
             .when(F.col("sessions").isNull(), "search_only").otherwise("analytics_only"))
    return j.withColumn("match", match)


def sibling_shift(win: DataFrame, client: str = "client_id", group: str = "keyword_group",
                  last: str = "imp_last", prev: str = "imp_prev") -> DataFrame:
    """Sibling absorption (J07, rule ours): what the rest of the (client, group)
    gained = group total of (last - prev) minus the row's own change.

    Group totals come from an aggregate (map-side partial sums, so a group
    holding a third of the rows is pre-reduced in every task) and are joined
    back on the group key; no self join, no window over a whole group.
    """
    delta = F.col(last) - F.col(prev)
    g = win.groupBy(client, group).agg(F.sum(delta).alias("_gd"), F.count(F.lit(1)).alias("_gn"))
    j = win.join(g, [client, group], "left")
    return j.withColumn("sibling_gain", F.col("_gd") - delta).withColumn("siblings", F.col("_gn") - 1) \
        .drop("_gd", "_gn")


def stack(frames: list[DataFrame]) -> DataFrame:
    """Stack rows with the same columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values."""
    return df.select(col).distinct()
