"""Scans, sinks and small table utilities.

All readers return lazy DataFrames; filters and projections applied later
reach the Parquet scan (PushedFilters / ReadSchema) through Catalyst.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelrank import constants as K

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Single-file Parquet scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_parquet(spark: SparkSession, path: str, months: list[str] | None = None,
                 month_col: str = "month") -> DataFrame:
    """Hive-partitioned scan (S03) with optional month list.

    The month filter is on the partition column, so Spark prunes whole
    directories before any file is opened.
    """
    df = spark.read.option("basePath", path).parquet(path) if not path.endswith(".parquet") \
        else spark.read.parquet(path)
    if months:
        df = df.filter(F.col(month_col).isin(*months))
    return df


def in_months(fact: DataFrame, months: DataFrame, month_col: str = "month") -> DataFrame:
    """Rows of a month-partitioned fact whose month occurs in a (filtered) month table.

    The months are known at run time only; the join on the partition column lets Spark plan dynamic partition
    pruning: the month table is read first and only matching folders are opened.
    """
    return fact.join(months.select(month_col), month_col, "left_semi")


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """CSV with header, every column read as string (S01); coerce with ``clean``."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if columns:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return reader.csv(path)


def register(spark: SparkSession, sf_dir: str, names=TABLES) -> dict[str, DataFrame]:
    """Named table registry (S05): temp views over the Parquet files."""
    out = {}
    for n in names:
        df = table(spark, sf_dir, n)
        df.createOrReplaceTempView(n)
        out[n] = df
    return out


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per registered table (S06), one row per table.

    ``count`` on a bare Parquet scan reads footers only (no column data).
    """
    rows = [t.select(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
            .groupBy("table_name").agg(F.sum("row_count").cast("long").alias("row_count"))
            for name, t in tables.items()]
    return reduce(DataFrame.unionByName, rows)


def require_columns(df: DataFrame, required: list[str]) -> None:
    """Raise when a required column is absent."""
    absent = sorted(set(required) - set(df.columns))
    if absent:
        raise ValueError(f"the input lacks required columns: {absent}")


def input_profile(df: DataFrame, required: list[str], numeric: list[str] = ()) -> DataFrame:
    """Required-column check re-aimed as an input profile.

    Raises when a required column is absent (the reference's guard), then
    returns one row per required/numeric column: present, nulls and values
    that fail a numeric cast. One aggregate pass, then ``unpivot``.
    """
    require_columns(df, required)
    cols = list(dict.fromkeys(list(required) + [c for c in numeric if c in df.columns]))
    aggs = []
    for i, c in enumerate(cols):
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"n{i}"))
        if c in numeric:
            bad = F.col(c).isNotNull() & F.expr(f"try_cast(`{c}` as double)").isNull()
            aggs.append(F.count_if(bad).alias(f"b{i}"))
        else:
            aggs.append(F.lit(0).cast("long").alias(f"b{i}"))
    one = df.agg(F.count(F.lit(1)).alias("rows"), *aggs)
    stack = ", ".join(f"'{c}', n{i}, b{i}" for i, c in enumerate(cols))
    return one.selectExpr("rows", f"stack({len(cols)}, {stack}) as (column_name, null_rows, bad_rows)") \
        .select("column_name", F.lit(True).alias("present"), "rows", "null_rows", "bad_rows")


# ---------------------------------------------------------------- sinks
def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                max_rows: int | None = K.EXPORT_ROWS_PER_FILE, partition_by: list[str] | None = None,
                order_by: list | None = None) -> None:
    """CSV / Parquet / JSON sink with fixed column order.

    ``maxRecordsPerFile`` caps each part file (10,000 rows by default).
    ``order_by`` sorts with a range shuffle before writing, so part files are
    in rank order without collecting anything.
    """
    if order_by:
        df = df.orderBy(*order_by)
    w = df.write.mode(mode)
    if max_rows:
        w = w.option("maxRecordsPerFile", max_rows)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.parquet(path)


def to_sink_text(df: DataFrame, array_cols: list[str], sep: str = "|") -> DataFrame:
    """Arrays travel as ``array<string>`` inside; joined at the sink."""
    return df.select(*[F.array_join(F.col(c), sep).alias(c) if c in array_cols else F.col(c) for c in df.columns])


def write_metrics(df: DataFrame, path: str) -> None:
    """Run metadata / metrics as JSON (S09); one small DataFrame."""
    df.coalesce(1).write.mode("overwrite").json(path)


def cache_features(df: DataFrame, path: str, partition: str | None = "month") -> DataFrame:
    """Write once, reuse (S10). Returns the re-read table (lineage cut)."""
    parts = [partition] if partition and partition in df.columns else None
    write_table(df, path, "parquet", partition_by=parts, max_rows=None)
    return df.sparkSession.read.parquet(path)


# ---------------------------------------------------------------- release
def pseudonymize(df: DataFrame, column: str, prefix: str, n_hex: int, salt: str, out: str | None = None) -> DataFrame:
    """``prefix`` + first ``n_hex`` hex chars of sha256(salt || id)."""
    h = F.substring(F.sha2(F.concat(F.lit(salt), F.col(column).cast("string")), 256), 1, n_hex)
    return df.withColumn(out or column, F.concat(F.lit(prefix), h))


def freshness_cut(df: DataFrame, date_col: str, export_date, lag: int = K.EXPORT_LAG_DAYS) -> DataFrame:
    """Drop the last ``lag`` days before export (S13); literal bound, pushed down."""
    bound = F.date_sub(F.lit(export_date).cast("date"), lag)
    return df.filter(F.col(date_col) <= bound)


def build_dim_clients(sources: list[tuple[DataFrame, str, str]]) -> DataFrame:
    """Union of clients seen in several sources with first date.

    ``sources`` is a list of (frame, client column, date column or None).
    Each source is reduced to (client, min date) before the union, so the
    shuffle carries one row per client per source.
    """
    parts = []
    for df, c, d in sources:
        dcol = F.col(d).cast("date") if d else F.lit(None).cast("date")
        parts.append(df.groupBy(F.col(c).alias("client_id")).agg(F.min(dcol).alias("first_date")))
    u = reduce(DataFrame.unionByName, parts)
    return u.groupBy("client_id").agg(F.min("first_date").alias("first_seen"))


def build_dim_content(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per content id, the first by an explicit ascending order.

    Done as ``min(struct(order..., rest...))`` per key: an aggregate with a
    map-side partial step, so a key holding a third of the rows is reduced
    in every task before the shuffle instead of sorted in one task.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    packed = F.min(F.struct(*[F.col(c) for c in order + rest])).alias("_first")
    out = df.groupBy(key).agg(packed)
    return out.select(key, *[F.col(f"_first.{c}").alias(c) for c in order + rest]).select(*df.columns)
