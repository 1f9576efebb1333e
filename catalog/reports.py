"""Demo and load-test jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query, read
from lodeworks.plans.jobs import long_table, resample_last, timing_summary, wide_table

# The order priorities, one series each.
SERIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")

_MONTHLY = """
    SELECT o_orderpriority, date, o_totalprice FROM (
        SELECT *, row_number() OVER (PARTITION BY o_orderpriority, date ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
        FROM (SELECT *, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS date FROM orders)) WHERE rn = 1
"""
_PIVOTED = f"""
    SELECT date, {", ".join(f'''max(CASE WHEN o_orderpriority = '{s}' THEN o_totalprice END) AS "{s}"''' for s in SERIES)}
    FROM ({_MONTHLY}) GROUP BY date HAVING count(DISTINCT o_orderpriority) = {len(SERIES)}
"""


def _monthly(spark, folder):
    orders = read(spark, folder, "orders")
    return resample_last(orders, "o_orderdate", "o_totalprice", by=["o_orderpriority"], tie=["o_orderkey"])


@query("monthly_last", _MONTHLY)
def monthly_last(spark, folder):
    return _monthly(spark, folder).select("o_orderpriority", F.date_format("date", "yyyy-MM-dd").alias("date"), "o_totalprice")


@query("daily_last", """
    SELECT event_type, strftime(ts, '%Y-%m-%d') AS date, arg_max(value, ts) AS value
    FROM events WHERE value >= 5 GROUP BY 1, 2
""")
def daily_last(spark, folder):
    """By day; a null value never is the last one."""
    events = read(spark, folder, "events").withColumn("value", F.when(F.col("value") >= 5, F.col("value")))
    daily = resample_last(events, "ts", "value", by=["event_type"], unit="day")
    return daily.select("event_type", F.date_format("date", "yyyy-MM-dd").alias("date"), "value")


@query("monthly_wide", _PIVOTED)
def monthly_wide(spark, folder):
    return wide_table(_monthly(spark, folder), "o_orderpriority", "o_totalprice", SERIES)


@query(
    "unpivot_long",
    " UNION ALL ".join(f"SELECT date, '{s}' AS series, \"{s}\" AS value FROM ({_PIVOTED})" for s in SERIES),
)
def unpivot_long(spark, folder):
    return long_table(monthly_wide(spark, folder), SERIES)


_TIMING = """
    SELECT event_type AS phase, count(*) FILTER (WHERE value < 100) AS n, count(*) FILTER (WHERE value >= 100) AS errors,
           round(avg(value) FILTER (WHERE value < 100), 4) AS mean,
           round(quantile_cont(CAST(value AS DOUBLE), 0.5) FILTER (WHERE value < 100), 4) AS p50,
           round(quantile_cont(CAST(value AS DOUBLE), 0.95) FILTER (WHERE value < 100), 4) AS p95,
           min(value) FILTER (WHERE value < 100) AS "min", max(value) FILTER (WHERE value < 100) AS "max",
           CAST(sum(event_id) FILTER (WHERE value < 100) AS BIGINT) AS "rows",
           round(sum(event_id) FILTER (WHERE value < 100) / sum(value) FILTER (WHERE value < 100), 4) AS rows_per_sec
    FROM events GROUP BY event_type
"""


def _timing(spark, folder):
    events = read(spark, folder, "events")
    summary = timing_summary(events, phase="event_type", elapsed="value", rows="event_id", failed=F.col("value") >= 100)
    rounded = {c: F.round(c, 4) for c in ("mean", "p50", "p95", "rows_per_sec")}
    return summary.withColumns(rounded)


@query("timing_summary", _TIMING)
def timing(spark, folder):
    return _timing(spark, folder)


@query("timing_summary_large_groups", _TIMING)
def timing_large_groups(spark, folder):
    """The same over many ranges, so that every group lies in several tasks."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        return _timing(spark, folder)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
