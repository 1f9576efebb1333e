"""Data jobs built on plain aggregates: resampling, wide and long tables, timing reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodeworks.functions.keys import quoted
from lodeworks.plans import files as fs


def resample_last(
    df: DataFrame, date: str, value: str, *, by: Sequence[str] = (), tie: Sequence[str] = (), unit: str = "month"
) -> DataFrame:
    """The last non-null value per period; periods without one are absent.

    ``tie`` orders rows of one date. An aggregate, so each task sends one row per period.
    """
    period = F.date_trunc(unit, quoted(date)).cast("date").alias("date")
    last = F.max_by(quoted(value), F.struct(quoted(date), *(quoted(t) for t in tie)))
    rows = df.where(quoted(value).isNotNull())
    return rows.groupBy(period, *(quoted(b) for b in by)).agg(last.alias(value))


def wide_table(monthly: DataFrame, label: str, value: str, series: Sequence[str]) -> DataFrame:
    """One row per date with a column per series; dates that lack a series are dropped.

    The same rows as inner-joining the series on their date, from a single aggregate.
    """
    wide = monthly.groupBy("date").pivot(label, list(series)).agg(F.first(quoted(value)))
    wide = wide.dropna(how="any", subset=list(series))
    return wide.select(F.date_format("date", "yyyy-MM-dd").alias("date"), *(quoted(s) for s in series)).orderBy("date")


def long_table(wide: DataFrame, series: Sequence[str], *, date: str = "date") -> DataFrame:
    """(date, series, value) rows, nulls dropped, the date as text."""
    columns = [quoted(s).cast("double").alias(s) for s in series]
    text = quoted(date) if dict(wide.dtypes)[date] == "string" else F.date_format(quoted(date), "yyyy-MM-dd")
    rows = wide.select(text.alias("date"), *columns)
    return rows.unpivot(["date"], list(series), "series", "value").dropna(subset=["value"])


def timing_summary(
    df: DataFrame,
    *,
    phase: str = "phase",
    elapsed: str = "elapsed",
    rows: str = "rows",
    failed: Column | None = None,
) -> DataFrame:
    """Per phase: runs that went well, errors, mean, p50, p95, min, max, rows, rows per second.

    Only runs that went well are measured; a phase without any has null measures.
    """
    bad = F.lit(False) if failed is None else F.coalesce(failed, F.lit(False))
    runs = df.select(
        quoted(phase).alias("phase"),
        quoted(elapsed).cast("double").alias("elapsed"),
        quoted(rows).alias("rows"),
        bad.alias("bad"),
    )
    ok = F.when(~F.col("bad"), F.col("elapsed"))
    ok_rows = F.when(~F.col("bad"), F.col("rows"))
    summary = runs.groupBy("phase").agg(
        F.count(ok).alias("n"),
        F.count_if("bad").alias("errors"),
        F.avg(ok).alias("mean"),
        F.min(ok).alias("min"),
        F.max(ok).alias("max"),
        F.coalesce(F.sum(ok_rows), F.lit(0)).alias("rows"),
        F.when(F.sum(ok) > 0, F.sum(ok_rows) / F.sum(ok)).otherwise(F.lit(0.0)).alias("rows_per_sec"),
    )
    good = runs.where(~F.col("bad"))
    points = exact_percentiles(good, "phase", "elapsed", {"p50": 0.5, "p95": 0.95})
    return summary.join(points, "phase", "left").select(
        "phase", "n", "errors", "mean", "p50", "p95", "min", "max", "rows", "rows_per_sec"
    )


def exact_percentiles(df: DataFrame, group: str, value: str, points: Mapping[str, float]) -> DataFrame:
    """Interpolated percentiles per group, exact for groups of any size and any values.

    The built-in ``percentile`` brings a group's distinct values into one task. Here the
    distinct values and their counts are laid out by range of (group, value) and written
    once; a group spreads over as many ranges as it needs. Counts per range give each range
    its first rank, and a value's rank follows inside its range. NaN counts as the largest
    value, as in Spark's order.
    """
    folder = fs.shared_folder(df.sparkSession)
    rows = df.where(quoted(value).isNotNull()).select(quoted(group).alias("g"), quoted(value).cast("double").alias("v"))
    counts = rows.groupBy("g", "v").agg(F.count(F.lit(1)).alias("c"))
    laid = counts.repartitionByRange("g", "v").withColumn("part", F.spark_partition_id())
    laid.write.parquet(f"{folder}/ranges")
    laid = df.sparkSession.read.schema(laid.schema).parquet(f"{folder}/ranges")
    # a row per group and range that holds some of it
    held = laid.groupBy("g", "part").agg(F.sum("c").alias("held"))
    earlier = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select("g", "part", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("first"), F.sum("held").over(Window.partitionBy("g")).alias("n"))
    so_far = Window.partitionBy("g", "part").orderBy("v")
    ranked = laid.join(held, ["g", "part"]).withColumn("up_to", F.col("first") + F.sum("c").over(so_far))

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("up_to") > rank) & (F.col("up_to") - F.col("c") <= rank), F.col("v")))

    found, values = [], []
    for name, p in points.items():
        place = (F.col("n") - 1) * F.lit(float(p))
        found += [at(F.floor(place)).alias(f"low {name}"), at(F.ceil(place)).alias(f"high {name}"), F.max(place - F.floor(place)).alias(f"part {name}")]
        low, high, part = (F.col(f"{x} {name}") for x in ("low", "high", "part"))
        # equal ends as they are: between two infinities there is nothing to interpolate
        values.append(F.when((low == high) | (part == 0), low).otherwise(low + (high - low) * part).alias(name))
    return ranked.groupBy("g").agg(*found).select(F.col("g").alias(group), *values)
