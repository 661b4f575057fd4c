"""One key holding a third of all rows: results stay exact and whole through the keyed operators."""

import datetime as dt
import random

import pandas as pd
import pytest

from panelrank.operators import joins as J
from panelrank.operators import ordered as O
from panelrank.operators import windows as W
from panelrank.sources import tables as T


@pytest.fixture(scope="module")
def hot(spark):
    rnd = random.Random(3)
    end = dt.date(2024, 3, 31)
    rows = []
    for i in range(6000):
        content = 0 if i % 3 == 0 else rnd.randint(1, 400)   # content 0 holds a third of the rows
        day = end - dt.timedelta(days=rnd.randint(0, 59))
        rows.append((i, day, "c%d" % (content % 7), content, rnd.randint(0, 9), rnd.randint(0, 3), float(rnd.randint(1, 50))))
    cols = ["row_id", "report_date", "client_id", "content_id", "impressions", "clicks", "position"]
    return spark.createDataFrame(rows, cols).repartition(6), pd.DataFrame(rows, columns=cols), end


def test_two_window_exact_under_skew(hot):
    df, pdf, end = hot
    got = {(r.client_id, r.content_id): (r.imp_last, r.imp_prev) for r in
           W.two_window(df, ["client_id", "content_id"], end=end, window=60, split=30, avgs={}, min_prev=None).collect()}
    cut = end - dt.timedelta(days=30)
    last = pdf[pdf.report_date > cut].groupby(["client_id", "content_id"]).impressions.sum()
    prev = pdf[pdf.report_date <= cut].groupby(["client_id", "content_id"]).impressions.sum()
    keys = set(last.index) | set(prev.index)
    exp = {k: (int(last.get(k, 0)), int(prev.get(k, 0))) for k in keys}
    assert got == exp


def test_dedupe_first_under_skew(hot):
    df, pdf, _ = hot
    got = {r.content_id: r.row_id for r in T.build_dim_content(df, "content_id", ["row_id"]).collect()}
    exp = pdf.groupby("content_id").row_id.min().to_dict()
    assert got == exp


def test_ranks_under_skew(hot):
    df, pdf, _ = hot
    # a third of the rows share one score value (the hot content's clicks are forced to one value)
    from pyspark.sql import functions as F
    d = df.withColumn("score", F.when(F.col("content_id") == 0, F.lit(5.0)).otherwise(F.col("clicks").cast("double")))
    p = pdf.assign(score=[5.0 if c == 0 else float(k) for c, k in zip(pdf.content_id, pdf.clicks)])
    pct = {r.row_id: r.pct for r in O.pct_rank(d, "score", "pct", rows_per_bucket=500).collect()}
    exp = dict(zip(p.row_id, p.score.rank(method="average", pct=True)))
    assert all(abs(pct[k] - v) < 1e-12 for k, v in exp.items())
    rk = {r.row_id: r.rk for r in O.row_rank(d, [("score", True)], "row_id", "rk", rows_per_bucket=500).collect()}
    order = p.sort_values(["score", "row_id"], ascending=[False, True]).row_id.tolist()
    assert [rk[i] for i in order] == list(range(1, len(order) + 1))


def test_sibling_totals_under_skew(hot):
    df, pdf, end = hot
    tw = W.two_window(df, ["client_id", "content_id"], end=end, window=60, split=30, avgs={}, min_prev=None)
    s = {(r.client_id, r.content_id): r.sibling_gain for r in
         J.sibling_shift(tw, "client_id", "client_id").collect()}  # group = client: the hot content dominates c0
    t = tw.toPandas()
    t["d"] = t.imp_last - t.imp_prev
    g = t.groupby("client_id").d.transform("sum") - t.d
    assert s == {(c, k): int(v) for c, k, v in zip(t.client_id, t.content_id, g)}
