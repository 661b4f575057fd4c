"""Group- and time-aware splits.

Group order is ``md5(group || '|' || seed)`` (D-06): deterministic, equal in
Spark and DuckDB, independent of file order and partitioning. Group and
row positions come from the ordered prefix (D-04), so no split step runs in
a single task.
"""

from __future__ import annotations

import datetime as _dt
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelrank import constants as K
from panelrank.operators import ordered as O


def _group_order(df: DataFrame, group: str, seed: int) -> tuple[DataFrame, dict]:
    g = df.select(F.coalesce(F.col(group).cast("string"), F.lit(K.UNKNOWN)).alias("_g")).distinct()
    g = g.withColumn("_h", F.md5(F.concat(F.col("_g"), F.lit("|"), F.lit(str(seed))))).withColumn("_len", F.octet_length("_g") + 32)
    return O.ordered_prefix(g, ["_h", "_g"], ["_len"])


def _join_groups(df: DataFrame, flags: DataFrame, group: str, size: int) -> DataFrame:
    """One flag row per group joined to the rows; broadcast if the groups' bytes are within the session's limit."""
    if O.fits_broadcast(df.sparkSession, size):
        flags = F.broadcast(flags)
    key = F.coalesce(F.col(group).cast("string"), F.lit(K.UNKNOWN))
    return df.withColumn("_g", key).join(flags, "_g", "left").drop("_g")


def _tag_groups(df: DataFrame, group: str, seed: int, n_test_fn) -> tuple[DataFrame, int, int]:
    r, tot = _group_order(df, group, seed)
    k = n_test_fn(tot["n"])
    out = _join_groups(df, r.select("_g", (F.col("_pos") < k).alias("_is_test")), group, tot["_len"])
    out = out.withColumn("split", F.when(F.col("_is_test"), "test").otherwise("train")).drop("_is_test")
    return out, tot["n"], k


def _two_class_both_sides(df: DataFrame, label: str) -> bool:
    r = df.groupBy("split").agg(F.countDistinct(label).alias("c")).collect()
    d = {x["split"]: x["c"] for x in r}
    return d.get("train", 0) == 2 and d.get("test", 0) == 2


def client_holdout(df: DataFrame, group: str = "client_id", label: str = "is_declining_label",
                   frac: float = K.CLIENT_HOLDOUT_FRACTION, seed: int = K.RANDOM_STATE,
                   min_groups: int = K.CLIENT_HOLDOUT_MIN_GROUPS, id_col: str = "content_id") -> tuple[DataFrame, str]:
    """Client holdout (L01): first max(1, round(frac n)) groups by hash are test.

    Falls back to the stratified row holdout (L02) when there are fewer than
    ``min_groups`` groups or a side is empty or one-class. Returns the frame
    with a ``split`` column and the strategy name.
    """
    out, n, _ = _tag_groups(df, group, seed, lambda n: max(1, int(round(n * frac))))
    if n >= min_groups and _two_class_both_sides(out, label):
        return out, "client_holdout"
    return stratified_holdout(df, label, frac, seed, id_col), "stratified_row_holdout"


def group_shuffle(df: DataFrame, group: str, frac: float = K.GROUP_SHUFFLE_FRACTION,
                  seed: int = K.RANDOM_STATE) -> DataFrame:
    """Group shuffle split (L03): ceil(frac n) groups are test."""
    out, _, _ = _tag_groups(df, group, seed, lambda n: int(math.ceil(n * frac)))
    return out


def stratified_holdout(df: DataFrame, label: str, frac: float = K.ROW_HOLDOUT_FRACTION, seed: int = K.RANDOM_STATE,
                       id_col: str = "content_id") -> DataFrame:
    """Stratified row holdout (L02): per class, the first round(frac n_class) rows by hash are test."""
    h = F.md5(F.concat(F.col(id_col).cast("string"), F.lit("|"), F.lit(str(seed))))
    x = df.withColumn("_lab", F.col(label).cast("long")).withColumn("_h", h)
    r, _ = O.ordered_prefix(x, ["_lab", "_h", id_col], [])
    starts = r.groupBy("_lab").agg(F.min("_pos").alias("_p0"), F.count(F.lit(1)).alias("_nc"))
    r = r.join(F.broadcast(starts), "_lab")  # one row per class
    k = F.round(F.col("_nc") * F.lit(frac))
    r = r.withColumn("split", F.when(F.col("_pos") - F.col("_p0") < k, "test").otherwise("train"))
    return r.drop("_lab", "_h", "_pos", "_p0", "_nc")


def time_split(df: DataFrame, date_col: str, cut: _dt.date, embargo: int) -> DataFrame:
    """Time split (L04): train on days <= cut - embargo, test after cut, embargo between."""
    d = F.col(date_col)
    s = (F.when(d > F.lit(cut), "test").when(d <= F.lit(cut - _dt.timedelta(days=embargo)), "train")
         .otherwise("embargo"))
    return df.withColumn("split", s)


def group_folds(df: DataFrame, group: str, k: int, seed: int = K.RANDOM_STATE) -> DataFrame:
    """Group k-fold (L05): fold = group position by hash mod k (usable as ``foldCol``)."""
    r, tot = _group_order(df, group, seed)
    return _join_groups(df, r.select("_g", (F.col("_pos") % k).cast("int").alias("fold")), group, tot["_len"])


def split_check(df: DataFrame, group: str, label: str, side: str = "split") -> DataFrame:
    """Split integrity (L06): groups on both sides, classes per side, rows per side."""
    g = df.groupBy(group).agg(F.countDistinct(side).alias("_sides"))
    leaked = g.agg(F.count_if(F.col("_sides") > 1).alias("groups_on_both_sides"),
                   F.count(F.lit(1)).alias("groups"))
    per = df.groupBy(side).agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(label).alias("classes"),
                               F.sum(F.col(label).cast("long")).alias("positives"))
    return per.crossJoin(leaked)
