"""Structured Streaming rollup: equals the batch rollup; rows later than the watermark are dropped."""

import datetime as dt
import os
import tempfile
import time

from panelrank.streaming.rollup import stream_daily_rollup

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def _write(spark, folder, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(os.path.join(folder, name))


def test_late_rows_beyond_watermark_are_dropped(spark):
    base = tempfile.mkdtemp(prefix="pr-stream-", dir="/tmp")
    src = os.path.join(base, "src")
    d10 = dt.datetime(2024, 1, 10, 12, 0)
    _write(spark, src, "a", [(1, d10, 7, "view", 1.0, "{}"), (2, d10 + dt.timedelta(hours=1), 7, "view", 2.0, "{}")])
    time.sleep(1.1)  # the file source orders files by modification time
    _write(spark, src, "b", [(3, dt.datetime(2024, 1, 1, 9, 0), 7, "view", 5.0, "{}"),     # 9 days late: dropped
                             (4, dt.datetime(2024, 1, 9, 9, 0), 7, "view", 3.0, "{}")])    # inside 3 days: kept
    out = stream_daily_rollup(spark, src, "*.parquet", SCHEMA, "ts", ["user_id"], {"value_sum": "value"},
                              recursive=True)
    got = {(str(r.report_date), r.events, r.value_sum) for r in out.collect()}
    assert got == {("2024-01-10", 2, 3.0), ("2024-01-09", 1, 3.0)}


def test_late_row_does_not_reopen_a_closed_day(spark):
    base = tempfile.mkdtemp(prefix="pr-stream-", dir="/tmp")
    src = os.path.join(base, "src")
    d1 = dt.datetime(2024, 1, 1, 8, 0)
    _write(spark, src, "a", [(i, d1 + dt.timedelta(minutes=i), 7, "view", 1.0, "{}") for i in range(5)])
    time.sleep(1.1)
    _write(spark, src, "b", [(10, dt.datetime(2024, 1, 9, 8, 0), 7, "view", 1.0, "{}")])
    time.sleep(1.1)
    _write(spark, src, "c", [(11, dt.datetime(2024, 1, 1, 23, 0), 7, "view", 1.0, "{}")])  # late for day 1
    out = stream_daily_rollup(spark, src, "*.parquet", SCHEMA, "ts", ["user_id"], {"value_sum": "value"},
                              recursive=True)
    got = {(str(r.report_date), r.events) for r in out.collect()}
    assert got == {("2024-01-01", 5), ("2024-01-09", 1)}


def test_restart_reads_new_files_and_keeps_the_watermark(spark):
    base = tempfile.mkdtemp(prefix="pr-stream-", dir="/tmp")
    src, state = os.path.join(base, "src"), os.path.join(base, "state")
    _write(spark, src, "a", [(1, dt.datetime(2024, 1, 10, 8, 0), 7, "view", 1.0, "{}")])
    args = (spark, src, "*.parquet", SCHEMA, "ts", ["user_id"], {"value_sum": "value"})
    first = {(str(r.report_date), r.events) for r in stream_daily_rollup(*args, recursive=True, base_dir=state).collect()}
    assert first == {("2024-01-10", 1)}
    time.sleep(1.1)
    _write(spark, src, "b", [(2, dt.datetime(2024, 1, 1, 8, 0), 7, "view", 1.0, "{}"),    # behind the recovered watermark
                             (3, dt.datetime(2024, 1, 10, 9, 0), 7, "view", 1.0, "{}")])
    second = {(str(r.report_date), r.events) for r in stream_daily_rollup(*args, recursive=True, base_dir=state).collect()}
    assert second == {("2024-01-10", 2)}


def test_repeated_batch_loses_nothing(spark):
    from panelrank.streaming.rollup import WatermarkSink, final_values
    out = os.path.join(tempfile.mkdtemp(prefix="pr-stream-", dir="/tmp"), "table")
    rows = [(1, dt.datetime(2024, 1, 1, 8, 0), 7, "view", 1.0, "{}"), (2, dt.datetime(2024, 1, 20, 8, 0), 7, "view", 1.0, "{}")]
    batch = spark.createDataFrame(rows, SCHEMA)
    for _ in range(2):  # the second time as after a crash before the commit
        WatermarkSink(spark, out, "ts", ["user_id"], {"value_sum": "value"}, "3 days")(batch, 0)
    assert {(str(r.report_date), r.events) for r in final_values(spark, out, ["user_id"], ["events"]).collect()} == {("2024-01-01", 1), ("2024-01-20", 1)}
