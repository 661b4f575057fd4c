"""Global order statistics without a single-task window (D-04).

A window with ``orderBy`` but no ``partitionBy`` moves every row into one
task. ``ordered_prefix`` instead:

1. counts the rows and picks ``m`` buckets so each holds about
   ``rows_per_bucket`` rows;
2. takes cut points from a bounded sample (at most 40 keys per bucket and
   about 200,000 in all reach the driver) and assigns each row its bucket by comparison with those
   literals, under the window's own order of NULL and NaN, so the bucket of a row
   is deterministic on recompute;
3. numbers rows and accumulates measures *within* each bucket with a
   partitioned window;
4. adds the prefix of the bucket totals (at most ``m`` rows collected).

The result is exact whatever the cuts are. The order key must be unique
(callers aggregate to distinct values first, or append an id), which also
splits a heavy tie block across buckets by the id part of the key.
"""

from __future__ import annotations

import functools
import math

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelrank.session import ensure_checkpoint_dir

ROWS_PER_BUCKET = 2_000_000
MAX_BUCKETS = 16384       # cut points in a plan; beyond, Spark's range partitioning deals the buckets
OFFSET_LITERALS = 4096    # bucket offsets in a plan; beyond, they are joined
MIN_ROWS_PER_BUCKET = 1000
SAMPLE_KEYS_MAX = 200_000


@functools.total_ordering
class _Key:
    """Driver-side order of sampled keys, equal to the window's: NULL last either way, NaN the greatest number."""

    __slots__ = ("vals", "desc")

    def __init__(self, vals, desc):
        self.vals = tuple(None if v is None else (1, 0) if v != v else (0, v) for v in vals)
        self.desc = desc

    def __eq__(self, other):
        return self.vals == other.vals

    def __lt__(self, other):
        for a, b, d in zip(self.vals, other.vals, self.desc):
            if a == b:
                continue
            if a is None or b is None:
                return b is None
            return (a > b) if d else (a < b)
        return False


def _before(order, cut) -> "F.Column":
    """Row strictly precedes ``cut`` (columns or literals) in the window's order; never NULL.

    Spark compares NaN as equal to itself and greater than any number, as the window does; a NULL cut
    comes after every value and equals a NULL.
    """
    expr = F.lit(False)
    for (c, desc), v in reversed(list(zip(order, cut))):
        row = F.col(c)
        ahead = F.coalesce((row > v) if desc else (row < v), v.isNull() & row.isNotNull())
        expr = ahead | (row.eqNullSafe(v) & expr)
    return expr


def _literals(df, order, cut):
    return [F.lit(v).cast(df.schema[c].dataType) for (c, _), v in zip(order, cut)]


def _bucket_expr(df, order, cuts):
    """Balanced CASE tree over the cuts: fast for few of them."""
    def node(lo, hi):
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi + 1) // 2
        return F.when(_before(order, _literals(df, order, cuts[mid - 1])), node(lo, mid - 1)).otherwise(node(mid, hi))
    return node(0, len(cuts))


CASE_TREE_MAX_CUTS = 255  # beyond this the CASE tree outgrows generated-code limits; the rule is the same


def _bucket_search(df, order, cuts):
    """The same bucket by binary search in one literal array of cut keys (O(log m) per row)."""
    arr = F.array(*[F.struct(*[v.alias(f"k{i}") for i, v in enumerate(_literals(df, order, cut))]) for cut in cuts])
    steps = max(1, math.ceil(math.log2(len(cuts) + 1)))
    init = F.struct(F.lit(0).alias("lo"), F.lit(len(cuts)).alias("hi"))

    def step(acc, _):
        mid = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        cut = F.element_at(arr, mid + 1)
        moved = F.when(_before(order, [cut[f"k{i}"] for i in range(len(order))]), F.struct(acc["lo"].alias("lo"), mid.alias("hi"))) \
            .otherwise(F.struct((mid + 1).alias("lo"), acc["hi"].alias("hi")))
        return F.when(acc["lo"] < acc["hi"], moved).otherwise(acc)

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), init, step)["lo"]


def _norm_order(order):
    out = []
    for o in order:
        if isinstance(o, str):
            out.append((o, False))
        else:
            out.append((o[0], bool(o[1])))
    return out


def materialized(df: DataFrame) -> DataFrame:
    """``df`` written once into the shared checkpoint folder and reread.

    Several jobs read it (count, sample, totals, result). The files belong to the DataFrame: Spark's cleaner removes them once it
    is no longer used (``cleanCheckpoints``), so nothing stays in executor memory, and a lost executor replays nothing.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _bucketed(df: DataFrame, order, rows_per_bucket: int, max_buckets: int, seed: int) -> tuple[DataFrame, int]:
    """(materialized ``df`` with ``_bucket``, row count): buckets follow each other in ``order``."""
    keys = [c for c, _ in order]
    desc = [d for _, d in order]
    df = materialized(df)
    n = df.count()
    # at least the shuffle parallelism once buckets keep >= MIN_ROWS_PER_BUCKET rows; a table
    # smaller than that (counted above) is ranked in a single task
    par = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8"))
    lo = max(1, min(par, n // MIN_ROWS_PER_BUCKET))
    m = max(lo, math.ceil(n / max(1, rows_per_bucket)))
    if m > max_buckets:
        # more cuts than fit into a plan: Spark's own range partitioning cuts (its sample is bounded too), and what it dealt is
        # written, so a bucket is fixed once and keeps its size however many rows there are
        dealt = df.repartitionByRange(m, *_sort_columns(order)).withColumn("_bucket", F.spark_partition_id())
        return materialized(dealt), n
    cuts = []
    if m > 1:
        # sampled keys per bucket, from all partitions alike; about SAMPLE_KEYS_MAX reach the driver at most.
        # NULL keys are sampled too, so a block of them is cut by the later keys
        per = max(1, min(40, SAMPLE_KEYS_MAX // m))
        sample = df.select(*keys).sample(False, min(1.0, per * m / n), seed).collect()
        pts = sorted((tuple(r) for r in sample), key=lambda t: _Key(t, desc))
        step = len(pts) / m
        for i in range(1, m if pts else 1):
            p = pts[min(len(pts) - 1, int(i * step))]
            if not cuts or _Key(cuts[-1], desc) < _Key(p, desc):
                cuts.append(p)
    if not cuts:
        bucket = F.lit(0)
    else:
        bucket = (_bucket_expr if len(cuts) <= CASE_TREE_MAX_CUTS else _bucket_search)(df, order, cuts)
    return df.withColumn("_bucket", bucket.cast("int")), n


def bucketed(df: DataFrame, order, rows_per_bucket: int = ROWS_PER_BUCKET, max_buckets: int = MAX_BUCKETS, seed: int = 17) -> DataFrame:
    """``df`` with ``_bucket``, the buckets of ``ordered_prefix``: they follow each other in ``order``, and rows with equal keys share one."""
    return _bucketed(df, _norm_order(order), rows_per_bucket, max_buckets, seed)[0]


def _sort_columns(order):
    # NULL keys sort last in either direction, in the buckets and in the window alike
    return [F.col(c).desc_nulls_last() if d else F.col(c).asc_nulls_last() for c, d in order]


def _in_bucket(order):
    return Window.partitionBy("_bucket").orderBy(*_sort_columns(order))


def ordered_prefix(df: DataFrame, order, measures=(), rows_per_bucket: int = ROWS_PER_BUCKET,
                   max_buckets: int = MAX_BUCKETS, seed: int = 17, pos_col: str = "_pos"):
    """Add ``_pos`` (rows strictly before, 0-based) and ``_before_<m>`` prefix sums.

    ``order`` is a list of column names or ``(name, descending)`` pairs; the
    key must be unique. NULL key values sort last in either direction. Returns ``(frame, totals)``
    where ``totals`` holds the row count ``n`` and the total of each measure.
    """
    order = _norm_order(order)
    measures = list(measures)
    b, n = _bucketed(df, order, rows_per_bucket, max_buckets, seed)
    tot = b.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"),
                                   *[F.sum(F.col(x)).alias(f"_s{i}") for i, x in enumerate(measures)]).collect()
    tot = sorted(tot, key=lambda r: r["_bucket"])
    offs_n, offs_m = {}, [dict() for _ in measures]
    run_n, run_m = 0, [0] * len(measures)
    for r in tot:
        offs_n[r["_bucket"]] = run_n
        run_n += r["_n"]
        for i in range(len(measures)):
            offs_m[i][r["_bucket"]] = run_m[i]
            run_m[i] += r[f"_s{i}"] or 0

    extra = []
    if len(tot) > OFFSET_LITERALS:
        # one row of offsets per bucket, joined; of a few numbers each
        names = ["_o"] + [f"_o{i}" for i in range(len(measures))]
        rows = [(b_, *[d[b_] for d in (offs_n, *offs_m)]) for b_ in offs_n]
        b = b.join(F.broadcast(df.sparkSession.createDataFrame(rows, ["_bucket", *names]).withColumn("_bucket", F.col("_bucket").cast("int"))), "_bucket")
        extra = names

    def as_map(d, name):
        # bucket offsets as a literal array indexed by bucket (O(1) per row; a literal map is a linear scan)
        if not d:
            return F.lit(0)
        if extra:
            return F.col(name)
        arr = [d.get(b, 0) for b in range(max(d) + 1)]
        return F.element_at(F.array(*[F.lit(v) for v in arr]), F.col("_bucket") + 1)

    w = _in_bucket(order)
    wprev = w.rowsBetween(Window.unboundedPreceding, -1)
    cols = [(as_map(offs_n, "_o") + F.row_number().over(w) - 1).cast("long").alias(pos_col)]
    for i, x in enumerate(measures):
        local = F.coalesce(F.sum(F.col(x)).over(wprev), F.lit(0))
        cols.append((as_map(offs_m[i], f"_o{i}") + local).alias(f"_before_{x}"))
    out = b.select("*", *cols).drop("_bucket", *extra)
    totals = {"n": n}
    for i, x in enumerate(measures):
        totals[x] = run_m[i]
    return out, totals


def ordered_array_prefix(df: DataFrame, order, col: str, size: int, rows_per_bucket: int = ROWS_PER_BUCKET,
                         max_buckets: int = MAX_BUCKETS, seed: int = 17) -> DataFrame:
    """Add ``_before_<col>``: element-wise sums of the arrays ``col`` (``size`` whole doubles) over the rows strictly before.

    The buckets of ``ordered_prefix``; inside one, a running summarizer adds the arrays up, and the totals of the buckets
    before it are joined (one row per bucket). The summarizer keeps means, so sums are rounded back to whole numbers.
    """
    order = _norm_order(order)
    b, _ = _bucketed(df.withColumn("_vec", array_to_vector(col)), order, rows_per_bucket, max_buckets, seed)
    whole = lambda a: F.transform(vector_to_array(a), lambda x: F.round(x))
    totals = b.groupBy("_bucket").agg(Summarizer.sum(F.col("_vec")).alias("_t")).select("_bucket", whole(F.col("_t")).alias("_t")).collect()
    run, rows = [0.0] * size, []
    for r in sorted(totals, key=lambda r: r["_bucket"]):
        rows.append((r["_bucket"], list(run)))
        run = [x + y for x, y in zip(run, r["_t"])]
    offsets = df.sparkSession.createDataFrame(rows, "_bucket int, _off array<double>")
    upto = Summarizer.metrics("sum").summary(F.col("_vec")).over(_in_bucket(order).rowsBetween(Window.unboundedPreceding, 0))
    out = b.withColumn("_upto", upto).withColumn("_upto", whole(F.col("_upto.sum"))).join(offsets, "_bucket")
    before = F.zip_with(F.zip_with("_upto", col, lambda x, y: x - y), "_off", lambda x, y: x + y)
    return out.withColumn(f"_before_{col}", before).drop("_vec", "_upto", "_off", "_bucket")


def fits_broadcast(spark, size: int) -> bool:
    """Is a table of ``size`` bytes within the session's own limit for broadcast joins?"""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760").strip().lower()
    digits = limit.rstrip("kmgtb")
    scale = {"": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30}[limit[len(digits):].rstrip("b")]
    return 0 <= size <= int(digits) * scale


VALUE_ROW_BYTES = 32  # a value and its rank, two doubles in a row of Spark's format


def _join_values(big: DataFrame, small: DataFrame, on, rows: int) -> DataFrame:
    """Join a per-value table of counted rows back: broadcast if its bytes are within the session's limit, else as Spark plans it."""
    if fits_broadcast(big.sparkSession, rows * VALUE_ROW_BYTES):
        small = F.broadcast(small)
    return big.join(small, on, "left")


def pct_rank(df: DataFrame, col: str, out: str, **kw) -> DataFrame:
    """Percentile rank, NULL -> 0, average rank of ties / N.

    Distinct values are aggregated first (map-side combine collapses heavy
    ties), ranked with ``ordered_prefix``, then joined back.
    """
    v = F.coalesce(F.col(col).cast("double"), F.lit(0.0))
    vals = df.groupBy(v.alias("_v")).agg(F.count(F.lit(1)).alias("_cnt"))
    pre, tot = ordered_prefix(vals, ["_v"], ["_cnt"], **kw)
    n = tot["_cnt"]
    ranks = pre.select("_v", ((F.col("_before__cnt") + (F.col("_cnt") + 1) / 2.0) / F.lit(float(n))).alias(out))
    j = _join_values(df.withColumn("_v", v), ranks, "_v", tot["n"])
    return j.drop("_v")


def row_rank(df: DataFrame, order, id_col: str, out: str, **kw) -> DataFrame:
    """Ordinal rank 1..N over ``order`` then ``id_col`` ascending."""
    o = _norm_order(order) + [(id_col, False)]
    r, _ = ordered_prefix(df, o, [], pos_col="_pos", **kw)
    return r.withColumn(out, F.col("_pos") + 1).drop("_pos")


def top_k(df: DataFrame, order, k: int, id_col: str | None = None) -> DataFrame:
    """Top-k by an explicit order (W04): planned as TakeOrderedAndProject."""
    o = _norm_order(order) + ([(id_col, False)] if id_col else [])
    return df.orderBy(*[F.col(c).desc() if d else F.col(c).asc() for c, d in o]).limit(k)


def sort_nulls_last(df: DataFrame, order) -> DataFrame:
    """Sort with NULLs last in either direction."""
    return df.orderBy(*[F.col(c).desc_nulls_last() if d else F.col(c).asc_nulls_last()
                        for c, d in _norm_order(order)])


def pct_ranks(df: DataFrame, outs: dict[str, str], **kw) -> DataFrame:
    """Several percentile ranks (W01) in one pass: ``outs`` maps output name -> input column.

    The inputs are unpivoted to (column, value), aggregated to distinct
    pairs once, ranked by one grouped ordered prefix, and each column's
    per-value table is joined back (broadcast within the checked size).
    Same values as calling ``pct_rank`` per column.
    """
    names = list(outs)
    pairs = F.array(*[F.struct(F.lit(i).alias("_c"), F.coalesce(F.col(outs[o]).cast("double"), F.lit(0.0)).alias("_v"))
                      for i, o in enumerate(names)])
    vals = df.select(F.explode(pairs).alias("_p")).select("_p._c", "_p._v") \
        .groupBy("_c", "_v").agg(F.count(F.lit(1)).alias("_cnt"))
    pre, tot = ordered_prefix(vals, ["_c", "_v"], ["_cnt"], **kw)
    starts = pre.groupBy("_c").agg(F.min("_before__cnt").alias("_g0"), F.sum("_cnt").alias("_n"))
    # one row per input column in ``starts``; every column's join reads the written ranks
    ranks = materialized(pre.join(F.broadcast(starts), "_c").select(
        "_c", "_v", ((F.col("_before__cnt") - F.col("_g0") + (F.col("_cnt") + 1) / 2.0) / F.col("_n").cast("double"))
        .alias("_pct")))
    out = df
    for i, o in enumerate(names):
        r = ranks.filter(F.col("_c") == i).select(F.col("_v").alias(f"_v{i}"), F.col("_pct").alias(o))
        out = _join_values(out.withColumn(f"_v{i}", F.coalesce(F.col(outs[o]).cast("double"), F.lit(0.0))), r,
                          f"_v{i}", tot["n"]).drop(f"_v{i}")
    return out
