"""Partitioned scans: month pruning (S03/S04) and literal bounds reaching the reader (D-05)."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF001
from panelrank.operators import windows as W
from panelrank.sources import fixtures as fx
from panelrank.sources import tables as T


def _partitioned_daily(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="pr-daily-", dir="/tmp"), "daily")
    return T.cache_features(fx.fx_daily(spark, SF001), out, partition="month"), out


def _plan(df):
    spark = df.sparkSession
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")  # no abbreviated scan metadata
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_month_list_prunes_partitions(spark):
    daily, path = _partitioned_daily(spark)
    m = T.read_parquet(spark, path, months=["1998-03", "1998-04"])
    plan = _plan(m)
    assert "PartitionFilters: [month" in plan and "1998-03" in plan.split("PartitionFilters")[1][:200]
    assert m.count() == daily.filter(F.col("month").isin("1998-03", "1998-04")).count()
    assert len(os.listdir(path)) > 12  # one folder per month


def test_two_window_bounds_reach_the_scan(spark):
    daily, path = _partitioned_daily(spark)
    d = T.read_parquet(spark, path)
    tw = W.two_window(d, ["client_id", "content_id"], window=60, split=30, min_prev=None)
    plan = _plan(tw)
    assert "PartitionFilters" in plan and "month" in plan.split("PartitionFilters")[1][:300]
    assert "PushedFilters: [IsNotNull(report_date), GreaterThan(report_date," in plan
    # the bounds give exactly the last 60 days
    end = W.max_date(d)
    exp = d.filter((F.col("report_date") > F.date_sub(F.lit(end), 60))).groupBy("client_id", "content_id").count().count()
    assert tw.count() == exp


def test_cluster_conf_bounds():
    from panelrank.session import cluster_conf
    big = cluster_conf(100 * 10 ** 12, 8000)
    small = cluster_conf(10 ** 9, 64)
    assert int(big["spark.sql.shuffle.partitions"]) <= 100_000
    assert int(small["spark.sql.shuffle.partitions"]) == 128  # at least 2x the cores
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
