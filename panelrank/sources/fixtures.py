"""Fixture views over the test tables (see FIXTURES.md).

The ranking job's own inputs (page snapshot, daily fact, query fact,
client dimension) are not shipped, so the same shapes are derived from the
TPC-H-like tables: client = part brand, content = part key, day = ship date.
Each view is a lazy DataFrame; ``SQL`` holds the DuckDB text of the same
view for the oracle.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelrank.operators.ordered import fits_broadcast
from panelrank.sources.tables import table

INTENTS = ["informational", "transactional", "commercial", "navigational"]


def fx_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content dimension from ``part``."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    promo = F.col("p_type") == "PROMO"
    wc = F.when(k % 4 == 0, F.lit(None)).otherwise(F.col("p_size") * 80).cast("long")
    comp = F.when(promo, F.lit(None)).otherwise((k % 101) / 100)
    intent = F.when(k % 9 == 0, F.lit(None))
    for i, name in enumerate(INTENTS):
        intent = intent.when(k % 4 == i, F.lit(name))
    return p.select(
        k.alias("content_id"),
        F.col("p_brand").alias("client_id"),
        F.col("p_name").alias("keyword_group"),
        F.col("p_type").alias("content_type"),
        wc.alias("word_count"),
        (wc * 6).alias("char_count"),
        F.when(promo, F.lit(None)).otherwise((k * 37) % 74000).cast("long").alias("search_volume"),
        comp.alias("competition"),
        F.when(comp.isNull(), F.lit(None)).when(comp < 0.34, "LOW").when(comp < 0.67, "MEDIUM")
        .otherwise("HIGH").alias("competition_level"),
        F.when(comp.isNull(), F.lit(None)).otherwise(F.col("p_retailprice") / 1000).alias("cpc"),
        intent.alias("main_intent"),
        (30 + (k * 97) % 800).cast("long").alias("content_age_days"),
        ((k * 53) % 400).cast("long").alias("days_since_last_update"),
    )


def fx_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily fact: (report_date, client, content) from ``lineitem`` x ``part``.

    Lines are aggregated to (day, part) before the join (aggregate before
    join), so the join carries one row per part-day, not per line.
    """
    li = table(spark, sf_dir, "lineitem")
    q = F.col("l_quantity").cast("long")
    ga4 = (F.when(F.col("l_linestatus") == "F", F.lit(True))
           .when((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N"), F.lit(None).cast("boolean"))
           .otherwise(F.lit(False)))
    day = li.groupBy(F.col("l_shipdate").cast("date").alias("report_date"),
                     F.col("l_partkey").alias("content_id")).agg(
        F.sum(q).alias("impressions"),
        F.sum(F.when(F.col("l_returnflag") == "R", q).otherwise(0)).alias("clicks"),
        F.sum((600 + 100 * F.col("l_linenumber")).cast("long")).alias("pos_line_sum"),
        F.count(F.lit(1)).alias("sessions"),
        F.count_if(F.round(F.col("l_discount") * 100).cast("long") < 5).alias("engaged_sessions"),
        F.count_if(F.round(F.col("l_tax") * 100).cast("long") >= 7).alias("ai_sessions"),
        F.sum(F.col("l_linenumber").cast("long")).alias("pageviews"),
        F.sum((F.col("l_linenumber") * (1 + F.col("l_suppkey") % 2)).cast("long")).alias("scroll_events"),
        F.bool_or(ga4).alias("ga4_available"),
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    j = day.join(part, day.content_id == part.p_partkey, "inner")
    return j.select(
        "report_date",
        F.col("p_brand").alias("client_id"),
        "content_id",
        "impressions", "clicks",
        (F.col("p_size") * F.col("pos_line_sum")).cast("long").alias("pos_milli_sum"),
        "sessions", "engaged_sessions", "ai_sessions", "pageviews", "scroll_events", "ga4_available",
        (F.col("p_size") * F.col("pos_line_sum") / 1000 / F.col("sessions")).alias("position"),
        F.date_format("report_date", "yyyy-MM").alias("month"),
    )


def fx_busy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily fact with many more impressions and sessions on some items, so that every volume rule is reached.

    Clicks, engaged sessions and scrolls stay, so the rates of the busy items are low; positions stay as they are.
    """
    k = F.col("content_id")
    return fx_daily(spark, sf_dir).withColumns({
        "impressions": F.col("impressions") * (1 + k % 60),
        "sessions": F.col("sessions") * (1 + k % 7),
        "pos_milli_sum": F.col("pos_milli_sum") * (1 + k % 7),
    })


ROWS_PER_TASK = 250_000  # lines sorted by one task
ITEM_BYTES = 96          # an item's key, brand and name in a row of Spark's format


def dealt_by_rows(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` of ``rows`` rows dealt by ``keys`` to partitions of about ``ROWS_PER_TASK``, however many shuffle partitions are set;
    what one task holds stays as Spark plans it."""
    n = -(-rows // ROWS_PER_TASK)
    return df.repartition(max(n, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *keys) if n > 1 else df


def fx_query_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query grain (client, content, query) with kind kept / rare / anonymized."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name")
    # both sorts (lines by order, lines by item) are dealt by the number of lines, so a task's share doesn't grow with the table
    n, items = li.count(), p.count()  # from the files' footers
    lines = dealt_by_rows(li, n, "l_orderkey").join(o, li.l_orderkey == o.o_orderkey)
    if fits_broadcast(spark, items * ITEM_BYTES):
        j = dealt_by_rows(lines, n, "l_partkey", "o_custkey").join(F.broadcast(p), li.l_partkey == p.p_partkey)
    else:
        j = dealt_by_rows(lines, n, "l_partkey").join(p, li.l_partkey == p.p_partkey)
    g = j.groupBy(F.col("p_brand").alias("client_id"), F.col("l_partkey").alias("content_id"),
                  F.col("o_custkey").alias("query_id")).agg(
        F.sum(F.col("l_quantity").cast("long")).alias("impressions_90d"),
        F.bool_or(F.col("o_orderstatus") == "P").alias("anon"),
        F.min(F.concat_ws(" ", "p_name", "o_orderpriority")).alias("_text"),
    )
    kind = F.when(F.col("anon"), "anonymized").when(F.col("impressions_90d") >= 10, "kept").otherwise("rare")
    return g.select("client_id", "content_id", "query_id", "impressions_90d", kind.alias("kind"),
                    F.when(F.col("anon"), F.lit(None)).otherwise(F.col("_text")).alias("query_text"))


def fx_query(spark: SparkSession, sf_dir: str, all_rows: DataFrame | None = None) -> DataFrame:
    """Query fact: kept rows (>= 10 impressions) plus per-content context.

    The context columns repeat on every kept row of a content item, as in
    the reference table. Per-content totals come from one grouped pass and
    are joined back on content (both sides partitioned on content_id).
    """
    a = all_rows if all_rows is not None else fx_query_all(spark, sf_dir)
    imp = F.col("impressions_90d")
    ctx = a.groupBy("content_id").agg(
        F.count_if(F.col("kind") == "kept").alias("content_visible_query_count"),
        F.sum(F.when(F.col("kind") == "rare", imp).otherwise(0)).alias("_rare"),
        F.sum(F.when(F.col("kind") == "anonymized", imp).otherwise(0)).alias("_anon"),
        F.sum(imp).alias("content_total_impressions_90d"),
    )
    ctx = ctx.select(
        "content_id", "content_visible_query_count",
        (F.col("_rare") / F.col("content_total_impressions_90d")).alias("rare_impressions_share"),
        (F.col("_anon") / F.col("content_total_impressions_90d")).alias("anonymized_impressions_share"),
        "content_total_impressions_90d")
    kept = a.filter(F.col("kind") == "kept").select("client_id", "content_id", "query_id", "impressions_90d")
    return kept.join(ctx, "content_id")


def fx_last_day(spark: SparkSession, sf_dir: str):
    """Last day of the daily fact, from the base scan's one column: no aggregation or join runs for it."""
    return table(spark, sf_dir, "lineitem").agg(F.max(F.col("l_shipdate").cast("date")).alias("d")).first()["d"]


def fx_span_days(spark: SparkSession, sf_dir: str) -> int:
    """Days from the first to the last of the daily fact, both counted, from the base scan's one column."""
    d = F.col("l_shipdate").cast("date")
    return table(spark, sf_dir, "lineitem").agg((F.datediff(F.max(d), F.min(d)) + 1).alias("n")).first()["n"]


def fx_clients(spark: SparkSession, sf_dir: str, daily: DataFrame | None = None) -> DataFrame:
    """Client dimension: start = first day + (b % 5) * 365, NULL when b % 10 = 0."""
    if daily is not None:
        g = daily.groupBy("client_id").agg(F.min("report_date").alias("_first"))
    else:  # first days per item from the base scan's two columns; the daily fact isn't built for it
        first = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.min(F.col("l_shipdate").cast("date")).alias("_d"))
        items = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("client_id"))
        g = first.join(items, "p_partkey").groupBy("client_id").agg(F.min("_d").alias("_first"))
    b = F.substring("client_id", 7, 10).cast("int")
    start = F.when(b % 10 == 0, F.lit(None).cast("date")).otherwise(F.date_add("_first", (b % 5) * 365))
    return g.select("client_id", start.alias("start_date"))


def fx_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a daily panel: user as page, one event = one impression."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.col("ts"), F.col("ts").cast("date").alias("report_date"),
                    F.col("user_id").alias("content_id"), "event_type", "value", "props")


def fx_events_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = fx_events(spark, sf_dir)
    return e.groupBy("report_date", "content_id").agg(F.count(F.lit(1)).alias("impressions"),
                                                      F.count_if(F.col("event_type") == "click").alias("clicks"))


def decimal_lit(x: float):
    return F.lit(Decimal(str(x)))


# ----------------------------------------------------------------------------
# DuckDB text of the same views (oracle side)
# ----------------------------------------------------------------------------
SQL = {
    "fx_content": """
    fx_content AS (
      SELECT p_partkey AS content_id, p_brand AS client_id, p_name AS keyword_group, p_type AS content_type,
             CAST(CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_size * 80 END AS BIGINT) AS word_count,
             CAST(CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_size * 80 END AS BIGINT) * 6 AS char_count,
             CAST(CASE WHEN p_type = 'PROMO' THEN NULL ELSE (p_partkey * 37) % 74000 END AS BIGINT) AS search_volume,
             CASE WHEN p_type = 'PROMO' THEN NULL ELSE (p_partkey % 101) / 100 END AS competition,
             CASE WHEN p_type = 'PROMO' THEN NULL WHEN (p_partkey % 101) / 100 < 0.34 THEN 'LOW'
                  WHEN (p_partkey % 101) / 100 < 0.67 THEN 'MEDIUM' ELSE 'HIGH' END AS competition_level,
             CASE WHEN p_type = 'PROMO' THEN NULL ELSE p_retailprice / 1000 END AS cpc,
             CASE WHEN p_partkey % 9 = 0 THEN NULL WHEN p_partkey % 4 = 0 THEN 'informational'
                  WHEN p_partkey % 4 = 1 THEN 'transactional' WHEN p_partkey % 4 = 2 THEN 'commercial'
                  ELSE 'navigational' END AS main_intent,
             CAST(30 + (p_partkey * 97) % 800 AS BIGINT) AS content_age_days,
             CAST((p_partkey * 53) % 400 AS BIGINT) AS days_since_last_update
      FROM part)""",
    "fx_daily": """
    fx_day AS (
      SELECT CAST(l_shipdate AS DATE) AS report_date, l_partkey AS content_id,
             CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS impressions,
             CAST(SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS clicks,
             CAST(SUM(600 + 100 * l_linenumber) AS BIGINT) AS pos_line_sum,
             COUNT(*) AS sessions,
             COUNT(*) FILTER (WHERE CAST(round(l_discount * 100) AS BIGINT) < 5) AS engaged_sessions,
             COUNT(*) FILTER (WHERE CAST(round(l_tax * 100) AS BIGINT) >= 7) AS ai_sessions,
             CAST(SUM(l_linenumber) AS BIGINT) AS pageviews,
             CAST(SUM(l_linenumber * (1 + l_suppkey % 2)) AS BIGINT) AS scroll_events,
             bool_or(CASE WHEN l_linestatus = 'F' THEN TRUE
                          WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN NULL ELSE FALSE END) AS ga4_available
      FROM lineitem GROUP BY 1, 2),
    fx_daily AS (
      SELECT d.report_date, p.p_brand AS client_id, d.content_id, d.impressions, d.clicks,
             CAST(p.p_size * d.pos_line_sum AS BIGINT) AS pos_milli_sum, d.sessions, d.engaged_sessions,
             d.ai_sessions, d.pageviews, d.scroll_events, d.ga4_available,
             p.p_size * d.pos_line_sum / 1000 / d.sessions AS position,
             strftime(d.report_date, '%Y-%m') AS month
      FROM fx_day d JOIN part p ON p.p_partkey = d.content_id)""",
    "fx_busy": """
    fx_busy AS (
      SELECT * REPLACE (CAST(impressions * (1 + content_id % 60) AS BIGINT) AS impressions,
                        CAST(sessions * (1 + content_id % 7) AS BIGINT) AS sessions,
                        CAST(pos_milli_sum * (1 + content_id % 7) AS BIGINT) AS pos_milli_sum)
      FROM fx_daily)""",
    "fx_query_all": """
    fx_query_g AS (
      SELECT p.p_brand AS client_id, l.l_partkey AS content_id, o.o_custkey AS query_id,
             CAST(SUM(CAST(l.l_quantity AS BIGINT)) AS BIGINT) AS impressions_90d,
             bool_or(o.o_orderstatus = 'P') AS anon,
             MIN(concat_ws(' ', p.p_name, o.o_orderpriority)) AS qtext
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
      GROUP BY 1, 2, 3),
    fx_query_all AS (
      SELECT client_id, content_id, query_id, impressions_90d,
             CASE WHEN anon THEN 'anonymized' WHEN impressions_90d >= 10 THEN 'kept' ELSE 'rare' END AS kind,
             CASE WHEN anon THEN NULL ELSE qtext END AS query_text
      FROM fx_query_g)""",
    "fx_query": """
    fx_query_ctx AS (
      SELECT content_id,
             COUNT(*) FILTER (WHERE kind = 'kept') AS content_visible_query_count,
             CAST(SUM(CASE WHEN kind = 'rare' THEN impressions_90d ELSE 0 END) AS BIGINT) AS rare_imp,
             CAST(SUM(CASE WHEN kind = 'anonymized' THEN impressions_90d ELSE 0 END) AS BIGINT) AS anon_imp,
             CAST(SUM(impressions_90d) AS BIGINT) AS content_total_impressions_90d
      FROM fx_query_all GROUP BY content_id),
    fx_query AS (
      SELECT a.content_id, a.client_id, a.query_id, a.impressions_90d, c.content_visible_query_count,
             c.rare_imp / c.content_total_impressions_90d AS rare_impressions_share,
             c.anon_imp / c.content_total_impressions_90d AS anonymized_impressions_share,
             c.content_total_impressions_90d
      FROM fx_query_all a JOIN fx_query_ctx c ON a.content_id = c.content_id
      WHERE a.kind = 'kept')""",
    "fx_clients": """
    fx_clients AS (
      SELECT client_id,
             CASE WHEN CAST(substring(client_id, 7, 10) AS INTEGER) % 10 = 0 THEN NULL
                  ELSE CAST(MIN(report_date) + INTERVAL 1 DAY * ((CAST(substring(client_id, 7, 10) AS INTEGER) % 5) * 365) AS DATE)
             END AS start_date
      FROM fx_daily GROUP BY client_id)""",
    "fx_events": """
    fx_events AS (
      SELECT event_id, ts, CAST(ts AS DATE) AS report_date, user_id AS content_id, event_type, value, props
      FROM events)""",
    "fx_events_daily": """
    fx_events_daily AS (
      SELECT report_date, content_id, COUNT(*) AS impressions,
             COUNT(*) FILTER (WHERE event_type = 'click') AS clicks
      FROM fx_events GROUP BY 1, 2)""",
}

DEPENDS = {
    "fx_daily": [],
    "fx_content": [],
    "fx_busy": ["fx_daily"],
    "fx_query_all": [],
    "fx_query": ["fx_query_all"],
    "fx_clients": ["fx_daily"],
    "fx_events": [],
    "fx_events_daily": ["fx_events"],
}


def with_sql(*names: str, extra: list[str] = ()) -> str:
    """``WITH`` prefix holding the named fixture views (dependencies first)."""
    order: list[str] = []

    def add(n):
        for d in DEPENDS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    parts = [SQL[n].strip() for n in order] + [e.strip() for e in extra]
    return "WITH " + ",\n".join(parts) + "\n"
