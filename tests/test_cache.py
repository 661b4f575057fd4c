"""Month cache, month pruning at run time, payloads without a schema."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF001
from panelrank.operators import text as X
from panelrank.plans import q_misc
from panelrank.sources import cache
from panelrank.sources import tables as T

ROWS = [("2024-01", "a", 1), ("2024-01", "b", 2), ("2024-02", "a", 3), ("2024-03", "c", 4), (None, "d", 5)]
SCHEMA = "month string, id string, v long"


def _files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(os.path.join(path, "table")) for f in fs if f.endswith(".parquet")}


def _sums(df):
    return df.groupBy("month", "id").agg(F.sum("v").alias("v"))


def test_only_changed_months_are_rebuilt(spark):
    path = tempfile.mkdtemp(prefix="pr-cache-", dir="/tmp")
    seen = []

    def build(df):
        seen.append(sorted({r.month for r in df.select("month").distinct().collect()}, key=str))
        return _sums(df)

    def run(rows):
        got, changed = cache.refresh(spark.createDataFrame(rows, SCHEMA), build, path)
        want = {}
        for m, i, v in rows:
            want[m, i] = want.get((m, i), 0) + v
        assert {(r.month, r.id): r.v for r in got.select(F.col("month").cast("string").alias("month"), "id", "v").collect()} == want
        return changed

    assert run(ROWS) == ["2024-01", "2024-02", "2024-03", cache.NO_MONTH]
    first = _files(path)
    assert run(ROWS[::-1]) == [] and _files(path) == first          # the same rows in another order: nothing is touched
    assert run([*ROWS, ("2024-02", "z", 9)]) == ["2024-02"]
    second = _files(path)
    touched = {f.split("month=")[1].split("/")[0] for f in set(second.items()) ^ set(first.items()) for f in [f[0]]}
    assert touched == {"2024-02"} and seen[-1] == ["2024-02"]
    assert run([r for r in ROWS if r[0] != "2024-03"]) == ["2024-02", "2024-03"]   # one month back to what it was, one gone
    third = _files(path)
    assert not any("2024-03" in f for f in third) and {f: t for f, t in third.items() if "2024-01" in f} == {f: t for f, t in first.items() if "2024-01" in f}
    assert run([*ROWS[:3], (None, "d", 6)]) == [cache.NO_MONTH]
    assert len(seen) == 4


def test_marks_of_files_need_no_data_column(spark):
    src = tempfile.mkdtemp(prefix="pr-src-", dir="/tmp")
    path = tempfile.mkdtemp(prefix="pr-cache-", dir="/tmp")
    spark.createDataFrame(ROWS[:4], SCHEMA).write.mode("overwrite").partitionBy("month").parquet(src)
    read = lambda: spark.read.schema(SCHEMA).option("basePath", src).parquet(src)
    plan = cache.file_marks(read())._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan
    assert cache.refresh(read(), _sums, path, marks=cache.file_marks(read()))[1] == ["2024-01", "2024-02", "2024-03"]
    assert cache.refresh(read(), _sums, path, marks=cache.file_marks(read()))[1] == []
    spark.createDataFrame([("2024-02", "q", 7)], SCHEMA).write.mode("append").partitionBy("month").parquet(src)
    spark.catalog.refreshByPath(src)
    got, changed = cache.refresh(read(), _sums, path, marks=cache.file_marks(read()))
    assert changed == ["2024-02"] and got.count() == 5


def test_an_interrupted_run_is_repeated(spark):
    path = tempfile.mkdtemp(prefix="pr-cache-", dir="/tmp")
    df = spark.createDataFrame(ROWS, SCHEMA)
    try:
        cache.refresh(df, lambda d: _sums(d).withColumn("v", F.raise_error(F.lit("stop"))), path)
    except Exception as e:
        assert "stop" in str(e)
    got, changed = cache.refresh(df, _sums, path)
    assert len(changed) == 4 and got.count() == 5


def test_empty_source(spark):
    path = tempfile.mkdtemp(prefix="pr-cache-", dir="/tmp")
    df = spark.createDataFrame([], SCHEMA)
    got, changed = cache.refresh(df, _sums, path)
    assert changed == [] and got.count() == 0 and got.columns == ["id", "v", "month"]


def test_months_are_pruned_at_run_time(spark):
    daily, calendar = q_misc.by_month(spark, SF001)
    hit = T.in_months(daily, calendar.filter((F.col("year") == 1997) & (F.col("quarter") == 2)))
    plan = hit.groupBy("month").count()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "dynamicpruning" in plan
    static = T.read_parquet(spark, q_misc._scratch(spark, SF001, "daily-by-month") + "/table", ["1997-04"])
    assert "PartitionFilters: [isnotnull(month" in static._jdf.queryExecution().executedPlan().toString() or "PartitionFilters: [month" in static._jdf.queryExecution().executedPlan().toString()
    assert {r.month for r in hit.select(F.col("month").cast("string").alias("month")).distinct().collect()} == {"1997-04", "1997-05", "1997-06"}


def test_payloads_of_mixed_shape(spark):
    rows = ['{"a":1,"b":{"c":"x","d":[1,2]},"t":"2020-01-01"}', '{"a":"s","b":{"c":null},"z":1.5}', "bad", None, '{"a":[1],"q y":true,"z":2}', "[1]", '{"b":{"e":{}},"n":null,"o":{"p":{"x":12345678901234}}}']
    df = spark.createDataFrame([(i, r, "kept") for i, r in enumerate(rows)], "id int, p string, a string")
    f = X.flatten_variant(df, "p", prefix="p_")
    assert f.columns == ["id", "p", "a", "p_a", "p_b_c", "p_b_d", "p_b_e", "p_n", "p_o_p_x", "p_q y", "p_t", "p_z"]
    got = {r.id: r for r in f.collect()}
    assert len(got) == 7 and [got[i]["p_a"] for i in range(7)] == ["1", "s", None, None, "[1]", None, None]
    assert got[0]["p_b_d"] == "[1,2]" and got[6]["p_o_p_x"] == 12345678901234 and got[4]["p_q y"] is True and float(got[4]["p_z"]) == 2.0 and float(got[1]["p_z"]) == 1.5
    assert got[6]["p_b_e"] == "{}" and got[6]["p_n"] is None and got[0].a == "kept"
    # a kept schema gives the same columns on other rows
    again = X.flatten_variant(df.filter("id = 2"), "p", X.payload_schema(df, "p"), "p_")
    assert again.columns == f.columns and again.count() == 1
    assert X.flatten_variant(df.filter("id in (2, 3, 5)"), "p").columns == ["id", "p", "a"]
