"""A dataset's load log, schema versions and pipeline state.

Every write here is an append, except trimming old state rows. Every read is a
predicate on the stored table, so Parquet statistics and pruning apply.
"""

from __future__ import annotations

import hashlib
import json
import warnings
from collections.abc import Iterable
from dataclasses import replace
from datetime import datetime, timezone
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.errors import ConcurrentPublishError
from lodeworks.functions.local import local_frame
from lodeworks.operators import bookkeeping as ops
from lodeworks.operators.bookkeeping import COMPLETED, LOADS_TABLE, SCHEMAS, STATE_TABLE, VERSION_TABLE
from lodeworks.plans.dataset import Dataset

ENGINE_VERSION = 1


def _now() -> datetime:
    return datetime.now(timezone.utc)


def _append_row(dataset: Dataset, table: str, row: tuple) -> None:
    dataset.append_rows(table, local_frame(dataset.spark, [row], SCHEMAS[table]))


def completed(dataset: Dataset, load_ids: Iterable[str]) -> set[str]:
    """Those of the loads that are in the load log."""
    found = dataset.bookkeeping(LOADS_TABLE).where(F.col("load_id").isin(sorted(load_ids)))
    return {r[0] for r in found.select("load_id").distinct().collect()}


def is_complete(dataset: Dataset, load_id: str) -> bool:
    """Whether this load is in the load log."""
    return not dataset.bookkeeping(LOADS_TABLE).where(F.col("load_id") == load_id).isEmpty()


def complete_load(dataset: Dataset, load_id: str, schema_name: str, version_hash: str | None) -> None:
    """One log row, written after the data is published."""
    _append_row(dataset, LOADS_TABLE, (load_id, schema_name, COMPLETED, _now(), version_hash))


def update_stored_schema(dataset: Dataset, schema_name: str = "default") -> str:
    """Store the schema of all tables unless this very schema is stored; returns its hash."""
    tables = {n: dataset.version(n).schemas[-1:] for n in dataset.table_names() if n not in SCHEMAS}
    content = json.dumps({"name": schema_name, "tables": tables}, sort_keys=True)
    version_hash = hashlib.sha256(content.encode()).hexdigest()
    known, number = (
        dataset.bookkeeping(VERSION_TABLE)
        .agg(F.max(F.col("version_hash") == version_hash), F.max(F.when(F.col("schema_name") == schema_name, F.col("version"))))
        .first()
    )
    if not known:
        row = ((number or 0) + 1, ENGINE_VERSION, _now(), schema_name, version_hash, content)
        _append_row(dataset, VERSION_TABLE, row)
    return version_hash


def get_stored_schema(dataset: Dataset, schema_name: str | None = None) -> DataFrame:
    return ops.latest_schema(dataset.bookkeeping(VERSION_TABLE), schema_name)


def get_stored_schema_by_hash(dataset: Dataset, version_hash: str) -> DataFrame:
    return ops.schema_by_hash(dataset.bookkeeping(VERSION_TABLE), version_hash)


def get_stored_state(dataset: Dataset, pipeline_name: str) -> DataFrame:
    return ops.latest_state(dataset.bookkeeping(STATE_TABLE), dataset.bookkeeping(LOADS_TABLE), pipeline_name)


def read_state(dataset: Dataset, pipeline_name: str) -> Any:
    """The state of the newest completed load, or None."""
    row = get_stored_state(dataset, pipeline_name).select("state").first()
    return None if row is None else json.loads(row[0])


def save_state(dataset: Dataset, pipeline_name: str, state: Any, load_id: str) -> None:
    """A state row; it counts from the moment its load is logged as complete."""
    content = json.dumps(state, sort_keys=True)
    digest = hashlib.sha256(content.encode()).hexdigest()
    row_id = hashlib.sha256(f"{load_id}|{pipeline_name}".encode()).hexdigest()
    _append_row(dataset, STATE_TABLE, (1, ENGINE_VERSION, pipeline_name, content, _now(), digest, load_id, row_id))


def prune_pipeline_state(dataset: Dataset, keep: int) -> int:
    """Trim state to the newest ``keep`` rows per pipeline; returns the rows dropped.

    The decision reads one narrow column; whole state rows are read only to rewrite them.
    Nothing happens if all rows or none would stay, and a failure is only a warning: the
    load this follows is complete already.
    """
    if keep < 1:
        return 0
    version = dataset.version(STATE_TABLE)
    if version is None or version.rows <= keep:
        return 0
    try:
        state = dataset.table(STATE_TABLE, version=version)
        if ops.surplus_state(state.select("pipeline_name"), keep) < keep:
            return 0
        kept = ops.newest_per_group(state, ["pipeline_name"], ["_dlt_load_id", "_dlt_id"], keep)
        written = dataset.write_parts(STATE_TABLE, version, kept)
        if written.rows in (0, version.rows):
            dataset.discard(STATE_TABLE, written.parts)
            return 0
        dataset.publish(STATE_TABLE, replace(version, parts=written.parts, rows=written.rows))
    except (PySparkException, ConcurrentPublishError) as error:
        warnings.warn(f"could not trim {STATE_TABLE}; old rows stay: {error}", stacklevel=2)
        return 0
    return version.rows - written.rows
