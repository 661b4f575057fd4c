"""Feature cache partitioned by month (S10): only months whose source changed are rebuilt.

A run compares a mark per month of the source with the marks of the last run. For the months that differ the features are
built from those months' rows alone and written with dynamic partition overwrite, which replaces their folders and leaves all
others untouched; months that left the source are removed. Marks are written last, so a run that dies in
between is repeated, never skipped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NO_MONTH = "__HIVE_DEFAULT_PARTITION__"  # the folder of rows without a month


def content_marks(source: DataFrame, month: str = "month") -> DataFrame:
    """(month, rows, mark) from the rows themselves: a sum of row hashes, whatever their order. Reads the source."""
    h = F.xxhash64(*source.columns).cast("decimal(38,0)")
    return source.groupBy(F.coalesce(F.col(month).cast("string"), F.lit(NO_MONTH)).alias("month")).agg(F.count(F.lit(1)).alias("rows"), F.sum(h).cast("string").alias("mark"))


def file_marks(source: DataFrame, month: str = "month") -> DataFrame:
    """(month, rows, mark) from name, size and time of the source's files, for a Parquet folder partitioned by month.

    No data column is read; ``rows`` counts files. A file rewritten with the same rows counts as changed.
    """
    m = F.col("_metadata")
    files = source.select(F.coalesce(F.col(month).cast("string"), F.lit(NO_MONTH)).alias("month"), F.xxhash64(m["file_path"], m["file_size"], m["file_modification_time"]).alias("_h")).distinct()
    return files.groupBy("month").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("_h").cast("decimal(38,0)")).cast("string").alias("mark"))


def _fs(spark, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _exists(spark, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def refresh(source: DataFrame, build: Callable[[DataFrame], DataFrame], path: str, month: str = "month", marks: DataFrame | None = None) -> tuple[DataFrame, list[str]]:
    """(cached features with ``month`` last, months rebuilt or removed). ``build`` maps source rows of whole months to features with the same
    ``month`` column; a month's features may depend on rows of that month only.

    ``marks`` default to ``content_marks``. The month lists that reach the driver have one entry per month.
    """
    spark = source.sparkSession
    table, kept = f"{path.rstrip('/')}/table", f"{path.rstrip('/')}/marks"
    now = {r["month"]: (r["rows"], r["mark"]) for r in (marks if marks is not None else content_marks(source, month)).collect()}
    old = {r["month"]: (r["rows"], r["mark"]) for r in spark.read.parquet(kept).collect()} if _exists(spark, kept) else {}
    changed = sorted(m for m in now if now[m] != old.get(m))
    gone = sorted(m for m in old if m not in now)
    if changed or (not old and not _exists(spark, table)):
        dated = [m for m in changed if m != NO_MONTH]
        hit = F.col(month).cast("string").isin(*dated) if dated else F.lit(False)
        rows = build(source.filter((hit | F.col(month).isNull()) if NO_MONTH in changed else hit))
        # folders of changed months that lose all their features are not overwritten, so they go first
        _drop(spark, table, month, changed)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(month).parquet(table)
        schema = rows.schema
    else:
        schema = None
    _drop(spark, table, month, gone)
    if changed or gone or not old:
        spark.createDataFrame([(m, *v) for m, v in sorted(now.items())], "month string, rows long, mark string").coalesce(1).write.mode("overwrite").parquet(kept)
    reader = spark.read.option("basePath", table)
    out = (reader.schema(schema) if schema is not None else reader).parquet(table)
    return out.select(*[f"`{c}`" for c in out.columns if c != month], month), sorted(changed + gone)


def _drop(spark, table: str, month: str, months: list[str]) -> None:
    for m in months:
        fs, p = _fs(spark, f"{table}/{month}={m}")
        if fs.exists(p):
            fs.delete(p, True)

