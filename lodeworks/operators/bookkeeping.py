"""Load log, schema versions and pipeline state as pure DataFrame functions."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeworks.functions.keys import quoted
from lodeworks.plans import files as fs

# Names and columns of the three bookkeeping tables.
LOADS_TABLE = "_dlt_loads"
VERSION_TABLE = "_dlt_version"
STATE_TABLE = "_dlt_pipeline_state"
INTERNAL_TABLES = (LOADS_TABLE, STATE_TABLE, VERSION_TABLE)

SCHEMAS = {
    LOADS_TABLE: T.StructType()
    .add("load_id", "string")
    .add("schema_name", "string")
    .add("status", "long")
    .add("inserted_at", "timestamp")
    .add("schema_version_hash", "string"),
    VERSION_TABLE: T.StructType()
    .add("version", "long")
    .add("engine_version", "long")
    .add("inserted_at", "timestamp")
    .add("schema_name", "string")
    .add("version_hash", "string")
    .add("schema", "string"),
    STATE_TABLE: T.StructType()
    .add("version", "long")
    .add("engine_version", "long")
    .add("pipeline_name", "string")
    .add("state", "string")
    .add("created_at", "timestamp")
    .add("version_hash", "string")
    .add("_dlt_load_id", "string")
    .add("_dlt_id", "string"),
}
COMPLETED = 0


def latest_schema(versions: DataFrame, schema_name: str | None = None) -> DataFrame:
    """The newest stored schema, of one name or of all."""
    if schema_name:
        versions = versions.where(F.col("schema_name") == schema_name)
    return versions.orderBy(F.desc("inserted_at"), F.desc("version_hash")).limit(1)


def schema_by_hash(versions: DataFrame, version_hash: str) -> DataFrame:
    return versions.where(F.col("version_hash") == version_hash).limit(1)


def new_versions(stored: DataFrame, candidates: DataFrame) -> DataFrame:
    """One row, the earliest, of every candidate hash that is not stored yet."""
    row = F.struct(*(quoted(c) for c in candidates.columns))
    firsts = candidates.groupBy("version_hash").agg(F.min_by(row, F.struct("inserted_at", row)).alias("row"))
    fresh = firsts.join(stored.select("version_hash"), "version_hash", "left_anti")
    return fresh.select(*(F.col("row").getField(c).alias(c) for c in candidates.columns))


def completed_state(state: DataFrame, loads: DataFrame) -> DataFrame:
    """State rows whose load finished."""
    done = loads.where(F.col("status") == COMPLETED).select(F.col("load_id").alias("_dlt_load_id"))
    return state.join(done, "_dlt_load_id", "left_semi").select(*state.columns)


def latest_state(state: DataFrame, loads: DataFrame, pipeline_name: str | None = None) -> DataFrame:
    """The newest usable state row of one pipeline, or of each pipeline.

    Load ids sort by time. The per-pipeline form is an aggregate, so a pipeline with
    most of the rows is reduced in every task before the shuffle.
    """
    if pipeline_name is not None:
        usable = completed_state(state.where(F.col("pipeline_name") == pipeline_name), loads)
        return usable.orderBy(F.desc("_dlt_load_id")).limit(1)
    usable = completed_state(state, loads)
    row = F.struct(*(quoted(c) for c in state.columns))
    newest = usable.groupBy("pipeline_name").agg(F.max_by(row, "_dlt_load_id").alias("row"))
    return newest.select("row.*")


def newest_per_group(df: DataFrame, group: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows per group in descending ``order``.

    Up to the session's own limit for it, the engine keeps n rows per group and task before
    it shuffles. For a larger ``n`` the ranks come from counts laid out by range of group and
    order, so a hot group spreads over as many tasks as it needs.
    """
    by = [F.desc(c) for c in order]
    limit = max(1, int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")))
    if n > limit:
        return _first_by_ranges(df, group, order, n)
    return _ranked(df, group, by, n)


def _first_by_ranges(df: DataFrame, group: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The same from counts per place, written once by range: a range's first rank is what earlier ranges hold."""
    spark, folder = df.sparkSession, fs.shared_folder(df.sparkSession)
    # as structs, which compare equal where their fields are null alike
    rows = df.withColumns({"__group": F.struct(*(quoted(c) for c in group)), "__place": F.struct(*(quoted(c) for c in order))})
    counts = rows.groupBy("__group", "__place").agg(F.count(F.lit(1)).alias("__count"))
    laid = counts.repartitionByRange(F.col("__group"), F.desc("__place")).withColumn("__part", F.spark_partition_id())
    laid.write.parquet(f"{folder}/ranges")
    laid = spark.read.schema(laid.schema).parquet(f"{folder}/ranges")
    earlier = Window.partitionBy("__group").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    held = laid.groupBy("__group", "__part").agg(F.sum("__count").alias("__held"))
    held = held.select("__group", "__part", F.coalesce(F.sum("__held").over(earlier), F.lit(0)).alias("__first"))
    inside = Window.partitionBy("__group", "__part").orderBy(F.desc("__place"))
    ranked = laid.join(held, ["__group", "__part"]).withColumn("__before", F.col("__first") + F.sum("__count").over(inside) - F.col("__count"))
    wanted = ranked.where(F.col("__before") < n).select("__group", "__place", F.least("__count", F.lit(n) - F.col("__before")).alias("__take"))
    found = rows.join(wanted, ["__group", "__place"])
    # only rows of one place are left to choose from
    number = F.row_number().over(Window.partitionBy("__group", "__place").orderBy(F.lit(0)))
    return found.withColumn("__number", number).where(F.col("__number") <= F.col("__take")).select(*df.columns)


def _ranked(df: DataFrame, group: Sequence[str], by: list, n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*by))
    return df.withColumn("__rank", rank).where(F.col("__rank") <= n).drop("__rank")


def surplus_state(state: DataFrame, keep: int) -> int:
    """How many rows lie beyond the newest ``keep`` of their pipeline (one narrow count)."""
    per = state.groupBy("pipeline_name").count()
    over = F.sum(F.greatest(F.col("count") - keep, F.lit(0)))
    return int(per.agg(over).first()[0] or 0)


def prune_state(state: DataFrame, keep: int) -> DataFrame:
    """The newest ``keep`` state rows per pipeline.

    All rows stay if ``keep`` is below 1 or fewer than ``keep`` would go, so that a table
    trimmed after every load is rewritten about once in ``keep`` loads.
    """
    if keep < 1 or surplus_state(state, keep) < keep:
        return state
    return newest_per_group(state, ["pipeline_name"], ["_dlt_load_id", "_dlt_id"], keep)


def since(
    df: DataFrame,
    cursor: str,
    last_value: Any = None,
    *,
    up_to: Any = None,
    closed: bool = False,
) -> DataFrame:
    """Rows past ``last_value`` (or at it too, if ``closed``) and not past ``up_to``.

    Both bounds are plain comparisons on the column, so the scan can use them.
    """
    if last_value is not None:
        df = df.where(quoted(cursor) >= F.lit(last_value) if closed else quoted(cursor) > F.lit(last_value))
    if up_to is not None:
        df = df.where(quoted(cursor) <= F.lit(up_to))
    return df
