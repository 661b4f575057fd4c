"""D-04 ordered prefix against plain computations; metric brute force; metamorphic checks."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelrank.operators import aggregates as A
from panelrank.operators import metrics as M
from panelrank.operators import ordered as O


def _frame(spark, n=3000, distinct=15, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        heavy = rnd.random() < 0.35          # a third of rows on one value
        s = 0.0 if heavy else float(rnd.randint(1, distinct))
        rows.append((i, s, 1 if rnd.random() < (0.2 + s / 40) else 0, None if rnd.random() < 0.05 else s * 2))
    return spark.createDataFrame(rows, "id long, score double, label int, maybe double").repartition(7), rows


@pytest.mark.parametrize("rpb", [10 ** 9, 97, 401, 2])
def test_pct_rank_equals_pandas(spark, rpb):
    df, rows = _frame(spark)
    got = {r.id: r.p for r in O.pct_rank(df, "maybe", "p", rows_per_bucket=rpb).collect()}
    pdf = pd.DataFrame(rows, columns=["id", "score", "label", "maybe"])
    exp = pdf["maybe"].fillna(0).rank(method="average", pct=True)
    for i, e in zip(pdf["id"], exp):
        assert got[i] == pytest.approx(e, abs=1e-12)


@pytest.mark.parametrize("rpb", [10 ** 9, 50, 333, 5])
def test_row_rank_equals_sort(spark, rpb):
    df, rows = _frame(spark)
    got = {r.id: r.rk for r in O.row_rank(df, [("score", True)], "id", "rk", rows_per_bucket=rpb).collect()}
    exp = sorted(rows, key=lambda t: (-t[1], t[0]))
    assert [got[t[0]] for t in exp] == list(range(1, len(rows) + 1))


def test_quantiles_equal_pandas(spark):
    df, rows = _frame(spark)
    q = A.quantiles(df, "maybe", [0.8, 0.5, 0.05], rows_per_bucket=3).first()
    s = pd.Series([r[3] for r in rows], dtype="float64").dropna()
    assert q.q0 == pytest.approx(s.quantile(0.8))
    assert q.q1 == pytest.approx(s.quantile(0.5))
    assert q.q2 == pytest.approx(s.quantile(0.05))


def _auc_brute(rows):
    pos = [r[1] for r in rows if r[2] == 1]
    neg = [r[1] for r in rows if r[2] == 0]
    tot = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def _ap_brute(rows):
    P = sum(r[2] for r in rows)
    ap, prev_r = 0.0, 0.0
    for s in sorted({r[1] for r in rows}, reverse=True):
        tp = sum(1 for r in rows if r[1] >= s and r[2] == 1)
        fp = sum(1 for r in rows if r[1] >= s and r[2] == 0)
        rec = tp / P
        ap += (rec - prev_r) * tp / (tp + fp)
        prev_r = rec
    return ap


def test_auc_and_ap_brute_force(spark):
    df, rows = _frame(spark, n=600)
    assert M.roc_auc(df, "label", "score", rows_per_bucket=3).first()[0] == pytest.approx(_auc_brute(rows), abs=1e-12)
    assert M.average_precision(df, "label", "score", rows_per_bucket=3).first()[0] == pytest.approx(_ap_brute(rows), abs=1e-12)


def test_label_flip_gives_one_minus_auc(spark):
    df, _ = _frame(spark)
    a = M.roc_auc(df, "label", "score").first()[0]
    b = M.roc_auc(df.withColumn("label", 1 - F.col("label")), "label", "score").first()[0]
    assert a + b == pytest.approx(1.0, abs=1e-12)


def test_repartition_does_not_change_ranks(spark):
    df, _ = _frame(spark)
    a = sorted(O.row_rank(df, [("score", True)], "id", "rk", rows_per_bucket=200).select("id", "rk").collect())
    b = sorted(O.row_rank(df.repartition(3, "label"), [("score", True)], "id", "rk", rows_per_bucket=77)
               .select("id", "rk").collect())
    assert a == b


def test_precision_at_k_ties(spark):
    df, rows = _frame(spark)
    r = M.precision_at_k_ties(df, "label", "score", 50, "id").first()
    srt = sorted(rows, key=lambda t: (-t[1], t[0]))
    sk = srt[49][1]
    above = [t for t in rows if t[1] > sk]
    tie = [t for t in rows if t[1] == sk]
    exp = (sum(t[2] for t in above) + (50 - len(above)) * sum(t[2] for t in tie) / len(tie)) / 50
    assert r.expected_precision_at_k == pytest.approx(exp)


@pytest.mark.parametrize("rpb", [10 ** 9, 40, 3, 1])
def test_row_rank_nulls_last(spark, rpb):
    rows = [(i, None if i % 7 == 0 else float(i % 13)) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, s double").repartition(5)
    for desc in (True, False):
        got = {r.id: r.rk for r in O.row_rank(df, [("s", desc)], "id", "rk", rows_per_bucket=rpb).collect()}
        key = (lambda t: (t[1] is None, -(t[1] or 0), t[0])) if desc else (lambda t: (t[1] is None, t[1] or 0, t[0]))
        exp = sorted(rows, key=key)
        assert [got[t[0]] for t in exp] == list(range(1, 401))


def test_pct_ranks_equals_single_column_ranks(spark):
    df, _ = _frame(spark)
    many = O.pct_ranks(df, {"p1": "score", "p2": "maybe"}, rows_per_bucket=7).select("id", "p1", "p2")
    one = O.pct_rank(O.pct_rank(df, "score", "p1"), "maybe", "p2").select("id", "p1", "p2")
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, one.collect()))


def test_approx_options_are_close(spark):
    df, rows = _frame(spark)
    exact = A.quantiles(df, "maybe", [0.5, 0.8]).first()
    appr = A.quantiles(df, "maybe", [0.5, 0.8], approx=10000).first()
    assert abs(appr.q0 - exact.q0) <= 2 and abs(appr.q1 - exact.q1) <= 2
    dims = df.select("id").filter("id % 2 = 0")
    r = A.distinct_and_orphans(df, dims, "id", approx=True).first()
    assert abs(r.fact_keys - len(rows)) <= 0.05 * len(rows)


def test_all_null_keys(spark):
    df = spark.createDataFrame([(i, None) for i in range(50)], "id long, s double")
    got = sorted(r.rk for r in O.row_rank(df, [("s", True)], "id", "rk", rows_per_bucket=5).collect())
    assert got == list(range(1, 51))


@pytest.mark.parametrize("desc", [True, False])
@pytest.mark.parametrize("buckets", [2, 200, 300, 2000])
def test_positions_equal_a_plain_window_with_null_and_nan_in_every_key(spark, desc, buckets, monkeypatch):
    from pyspark.sql import Window
    monkeypatch.setattr(O, "MIN_ROWS_PER_BUCKET", 1)
    rnd = random.Random(buckets)
    rows = [(i, None if rnd.random() < 0.3 else float("nan") if rnd.random() < 0.1 else float(rnd.randint(-4, 4)),
             None if rnd.random() < 0.1 else rnd.randint(0, 5), None if rnd.random() < 0.1 else rnd.choice("abc")) for i in range(4000)]
    df = spark.createDataFrame(rows, "id long, x double, y int, s string").repartition(5)
    order = [("x", desc), ("y", not desc), ("s", desc), ("id", False)]
    got, _ = O.ordered_prefix(df, order, rows_per_bucket=4000 // buckets)
    w = Window.orderBy(*[F.col(c).desc_nulls_last() if d else F.col(c).asc_nulls_last() for c, d in order])
    want = df.withColumn("want", F.row_number().over(w) - 1)
    assert got.select("id", "_pos").join(want, "id").where("_pos <> want").count() == 0


def test_buckets_are_bounded_whatever_the_parallelism(spark, monkeypatch):
    monkeypatch.setattr(O, "MIN_ROWS_PER_BUCKET", 1)
    df = spark.range(500).withColumn("x", F.col("id") % 7)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "400")
    try:
        out, _ = O.ordered_prefix(df, ["x", "id"], rows_per_bucket=1, max_buckets=5)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert plan.count("CASE WHEN") <= 5


def test_more_buckets_than_cuts_in_a_plan(spark, monkeypatch):
    """Beyond the cuts that a plan holds the buckets are dealt by range; beyond the offsets they are joined; positions and sums stay exact."""
    from pyspark.sql import Window
    monkeypatch.setattr(O, "OFFSET_LITERALS", 8)
    rnd = random.Random(9)
    rows = [(i, None if rnd.random() < 0.2 else float("nan") if rnd.random() < 0.1 else float(rnd.randint(-4, 4)), rnd.randint(0, 9)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, x double, v int").repartition(3)
    for desc in (True, False):
        got, tot = O.ordered_prefix(df, [("x", desc), "id"], ["v"], rows_per_bucket=150, max_buckets=5)
        w = Window.orderBy(F.col("x").desc_nulls_last() if desc else F.col("x").asc_nulls_last(), "id")
        want = df.select("id", (F.row_number().over(w) - 1).alias("p"), (F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("v")).alias("s"))
        assert got.columns == ["id", "x", "v", "_pos", "_before_v"] and tot == {"n": 3000, "v": sum(r[2] for r in rows)}
        assert got.join(want, "id").filter("_pos <> p or _before_v <> s").count() == 0
