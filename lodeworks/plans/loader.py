"""Apply a load package to a dataset.

Everything that can be refused is refused before the first job runs. Each table then
gets one publish; the load log row comes last, so a load is complete or not there, and
running it again under the same id changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, replace
from datetime import datetime, timezone
from functools import reduce
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeworks.errors import DuplicateKeyError, IncompleteReadError, LayoutError, LoadError, NullKeyError, UndefinedTableError
from lodeworks.functions.keys import NULL_KEY, guard_keys, quoted, split_hard_delete
from lodeworks.functions.local import local_frame
from lodeworks.functions.names import check_names, normalize_identifier
from lodeworks.functions.jsontext import parse_json_text
from lodeworks.functions.nested import ROOT_ID, child_tables
from lodeworks.functions.schema import conform, logical_type, merge_schemas
from lodeworks.operators.bookkeeping import INTERNAL_TABLES, SCHEMAS, since
from lodeworks.operators.identity import ROW_ID, by_value, digest, with_identity
from lodeworks.operators.layout import partition_value
from lodeworks.operators.merge import (
    DELETED,
    DUPLICATE_KEY,
    FILE_SEQ,
    ROW_SEQ,
    keep_unmatched,
    known_keys,
    last_per_key,
    new_rows,
)
from lodeworks.plans import files as fs
from lodeworks.plans import state as bookkeeping
from lodeworks.plans.dataset import Dataset, TableVersion, Written
from lodeworks.sources.package import list_files, read_package, rows_per_file
from lodeworks.spec import LoadSpec, resolve_action

POSITION = (FILE_SEQ, ROW_SEQ)
_TABLES_AT_ONCE = 4


@dataclass(frozen=True)
class _Task:
    """One table's share of a package, ready to apply."""

    table: str
    spec: LoadSpec
    rows: DataFrame
    action: str
    key: list[str] | None
    flag: str | None
    files: list[str]
    fresh_ids: bool  # row ids made for this load, so none of them is stored yet
    keys: DataFrame | None = None  # whose rows go, where the rows themselves don't tell
    ids_of: str | None = None  # the child table whose row ids these are, which need not be stored

    @property
    def schema(self) -> T.StructType:
        """Columns to store: no position columns, and no column whose type is unknown."""
        return T.StructType(
            [f for f in self.rows.schema.fields if f.name not in POSITION and not isinstance(f.dataType, T.NullType)]
        )


def load(
    dataset: Dataset,
    specs: LoadSpec | Sequence[LoadSpec],
    *,
    load_id: str | None = None,
    default_disposition: str = "append",
    schema_name: str = "default",
    pipeline: str | None = None,
    state: Any = None,
    max_state_rows: int = 100,
) -> DataFrame:
    """Load one package; returns its report, one (table, file, rows) line per file.

    ``pipeline`` and ``state`` store a state row that counts once this load completes. A
    load id that was loaded before, also one that broke off and also if others were loaded
    since, is not applied again to the tables it reached; those have no line in the report.
    """
    load_id = load_id or _new_id()
    specs = [specs] if isinstance(specs, LoadSpec) else list(specs)
    tasks = [t for spec in specs for t in _prepare(dataset, spec, load_id, resolve_action(spec, default_disposition))]
    written = _run(dataset, tasks, load_id, schema_name, pipeline, state, max_state_rows)
    return _report(dataset.spark, tasks, written)


def _new_id() -> str:
    return f"{datetime.now(timezone.utc).timestamp():.6f}"


def _run(
    dataset: Dataset,
    tasks: list[_Task],
    load_id: str,
    schema_name: str = "default",
    pipeline: str | None = None,
    state: Any = None,
    max_state_rows: int = 100,
) -> dict[str, int]:
    """Apply the tasks that were not applied before; table -> rows it wrote or removed."""
    _verify(dataset, tasks)
    present = {t.table: dataset.version(t.table) for t in tasks}
    pending = {load_id, *(i for v in present.values() if v for i in v.loads)}
    done = bookkeeping.completed(dataset, pending)
    if load_id in done:
        return {}
    _declare(dataset, tasks)
    left = [t for t in tasks if present[t.table] is None or load_id not in present[t.table].loads]
    written = _apply_all(dataset, left, load_id, done)
    version_hash = bookkeeping.update_stored_schema(dataset, schema_name)
    if pipeline is not None:
        bookkeeping.save_state(dataset, pipeline, state, load_id)
    bookkeeping.complete_load(dataset, load_id, schema_name, version_hash)
    bookkeeping.prune_pipeline_state(dataset, max_state_rows)
    return written


def _apply_all(dataset: Dataset, tasks: list[_Task], load_id: str, done: set[str]) -> dict[str, int]:
    """Load each table, a few at a time: tables share nothing, so their jobs may overlap."""

    def one(task: _Task) -> int:
        with _named_errors():
            return _apply(dataset, task, load_id, done)

    if len(tasks) < 2:
        return {t.table: one(t) for t in tasks}
    with ThreadPoolExecutor(_TABLES_AT_ONCE) as pool:
        running = {t.table: pool.submit(inheritable_thread_target(dataset.spark)(one), t) for t in tasks}
    return {table: future.result() for table, future in running.items()}


def _report(spark, tasks: list[_Task], written: dict[str, int]) -> DataFrame:
    """Of the tables that were loaded: rows per file read, or one line with the rows written if it was no files."""
    frames = []
    plain = [(t.table, None, written[t.table]) for t in tasks if not t.files and t.table in written]
    if plain:
        frames.append(local_frame(spark, plain, "table string, file string, rows bigint"))
    for t in tasks:
        if t.files and t.table in written:
            frames.append(rows_per_file(spark, t.files).select(F.lit(t.table).alias("table"), "file", "rows"))
    if not frames:
        return local_frame(spark, [], "table string, file string, rows bigint")
    return reduce(DataFrame.unionByName, frames)


# -- before any job ------------------------------------------------------------------


def _prepare(dataset: Dataset, spec: LoadSpec, load_id: str, action: str) -> list[_Task]:
    files: list[str] = []
    rows, order = spec.data, list(spec.order_by)
    if not isinstance(rows, DataFrame):
        files = list_files(dataset.spark, rows)
        rows = read_package(dataset.spark, files)
    elif spec.nested and not order and ROW_ID not in rows.columns and not (spec.key and action == "upsert"):
        # child rows point at their parent, so the parent's id must come out the same in
        # every job: rows without an order get one from files written once
        staged = fs.shared_folder(dataset.spark) + "/rows"
        rows.drop(*(f.name for f in rows.schema.fields if isinstance(f.dataType, T.NullType))).write.parquet(staged)
        rows = read_package(dataset.spark, [staged])
    rows, spec = _normalized(rows, spec)
    rows = _typed(rows, spec)
    rows = parse_json_text(rows, [c for c, hints in spec.columns.items() if hints.get("parse_json") and c in rows.columns])
    order = [normalize_identifier(c) for c in order]
    position = [c for c in POSITION if c in rows.columns] or order
    key = spec.key
    if key and position == order and (order or action == "upsert") and set(key) <= set(rows.columns):
        # rows of different keys may share their place in the order
        position = [*key, *order]
    fresh_ids = ROW_ID not in rows.columns
    if spec.nested and key and action == "upsert" and set(key) <= set(rows.columns):
        return _nested_merge(dataset, spec, rows, key, order, load_id, files)
    rows = with_identity(rows, load_id, position)
    if not spec.nested:
        spec = replace(spec, data=rows, order_by=order)
        return [_task(spec, rows, action, files, fresh_ids)]
    frames = child_tables(rows, spec.target, spec.max_nesting)
    root, *children = frames.items()
    spec = replace(spec, data=root[1], order_by=order)
    tasks = [_task(spec, root[1], action, files, fresh_ids)]
    for table, frame in children:
        child = LoadSpec(table, frame, write_disposition=spec.write_disposition, merge_strategy=spec.merge_strategy)
        # child rows have no key but their own id
        tasks.append(replace(_task(replace(child, order_by=[ROW_ID]), frame, action, [], fresh_ids), ids_of=table))
    return tasks


def _nested_merge(
    dataset: Dataset, spec: LoadSpec, rows: DataFrame, key: list[str], order: list[str], load_id: str, files: list[str]
) -> list[_Task]:
    """A keyed merge of nested rows: each key's children, at every depth, are replaced with its row.

    A row's id is a digest of its key, by value, so it stays the same from load to load, also
    if the key's type widens. The batch is folded first and written once: only the rows that win have children.
    """
    flag = spec.delete_flag if spec.delete_flag in rows.columns else None
    with _named_errors():
        winners = last_per_key(rows, key, order=order, hard_delete=flag)
        own = digest(F.lit(spec.target), *(by_value(quoted(k), rows.schema[k].dataType) for k in key))
        winners = with_identity(winners.withColumn(ROW_ID, own), load_id)
        folder = fs.shared_folder(dataset.spark) + "/winners"
        winners.write.parquet(folder)
    winners = dataset.spark.read.schema(winners.schema).parquet(folder)
    live = winners.where(~F.col(DELETED)).drop(DELETED)
    shape = child_tables(winners.drop(DELETED), spec.target, spec.max_nesting)[spec.target]
    tasks = [_task(replace(spec, data=shape, order_by=[]), shape, "upsert", files, False)]
    for table, frame in child_tables(live, spec.target, spec.max_nesting, root_ids=True).items():
        if table != spec.target:
            child = LoadSpec(table, frame, primary_key=[ROOT_ID])
            roots = winners.select(quoted(ROW_ID).alias(ROOT_ID))
            tasks.append(replace(_task(child, frame, "replace-of-keys", [], False), keys=roots, ids_of=table))
    return tasks


def _normalized(rows: DataFrame, spec: LoadSpec) -> tuple[DataFrame, LoadSpec]:
    """Column names in the stored form, in the frame and in every hint."""
    data = [c for c in rows.columns if c not in POSITION]
    names = dict(zip(data, check_names(data)))
    renamed = {old: new for old, new in names.items() if old != new}
    if renamed:
        rows = rows.withColumnsRenamed(renamed)
    key = spec.primary_key
    if key is not None:
        key = [normalize_identifier(k) for k in ([key] if isinstance(key, str) else key)]
    hints = {normalize_identifier(c): h for c, h in spec.columns.items()}
    return rows, replace(spec, primary_key=key, columns=hints, data=rows)


def _typed(rows: DataFrame, spec: LoadSpec) -> DataFrame:
    """Columns with a ``data_type`` hint in that type; a hinted column the rows lack is null."""
    columns = {}
    for name, hints in spec.columns.items():
        declared = hints.get("data_type")
        if declared is None:
            continue
        dtype = logical_type(declared, hints.get("precision"), hints.get("scale"))
        value = quoted(name) if name in rows.columns else F.lit(None)
        metadata = dict(rows.schema[name].metadata or {}) if name in rows.columns else {}
        columns[name] = value.cast(dtype).alias(name, metadata={**metadata, "logical": declared})
    return rows.withColumns(columns) if columns else rows


def _task(spec: LoadSpec, rows: DataFrame, action: str, files: list[str], fresh_ids: bool) -> _Task:
    flag = spec.delete_flag
    key = spec.key or None
    if flag is not None and flag not in rows.columns:
        flag = None
    return _Task(spec.target, spec, rows, action, key, flag, files, fresh_ids)


def _verify(dataset: Dataset, tasks: list[_Task]) -> None:
    targets = [t.table for t in tasks]
    for table in targets:
        if targets.count(table) > 1:
            raise LoadError(f"table {table!r} is loaded twice in one package; give its files to one spec")
        if table in INTERNAL_TABLES:
            raise LoadError(f"table {table!r} is kept by the loader")
    check_names(targets)
    for t in tasks:
        if t.action in ("upsert", "insert-only", "update", "delete") and t.key:
            if t.flag in t.key:
                raise LoadError(f"hard-delete column {t.flag!r} cannot also be a key column")
            absent = [k for k in t.key if k not in t.rows.columns]
            if absent:
                raise NullKeyError(f"key column(s) {', '.join(absent)} are not in the rows for {t.table!r}")
        layout = t.spec.layout
        if missing := layout.lacks(t.schema.names):
            raise LayoutError(f"the layout of {t.table!r} names {', '.join(missing)}, which the rows do not have")
        for k in layout.partitions:
            partition_value(k, t.rows.schema[k.column].dataType)
        stored = dataset.version(t.table)
        if stored is not None and t.action != "delete":
            merge_schemas(stored.schema, t.schema)


def _declare(dataset: Dataset, tasks: list[_Task]) -> None:
    schemas = {t.table: t.schema for t in tasks} | SCHEMAS
    dataset.declare(
        schemas,
        {t.table: t.key for t in tasks if t.key and t.action != "replace-of-keys"},
        {t.table: t.spec.layout for t in tasks},
    )


# -- one table -----------------------------------------------------------------------


def _apply(dataset: Dataset, task: _Task, load_id: str, done: set[str]) -> int:
    """Write, publish once, return the rows the table gained as new versions of rows (or lost, by a delete)."""
    current = dataset.version(task.table)
    if task.action == "delete":
        return _delete(dataset, task, replace(current, loads=_pending(current, done, load_id)))
    version = current.evolved(merge_schemas(current.schema, task.schema))
    position = [f for f in task.rows.schema.fields if f.name in POSITION]
    wanted = [c for c in task.rows.columns if c in POSITION or c in version.schema.names]
    rows = conform(task.rows.select(*(quoted(c) for c in wanted)), T.StructType([*version.schema.fields, *position]))
    applied = replace(version, loaded=True, loads=_pending(version, done, load_id))

    action, flag = task.action, task.flag
    if action in ("upsert", "insert-only") and not task.key:
        # a delete by row id has nothing to delete: no later load repeats an id
        rows, flag = (split_hard_delete(rows, flag)[0], None) if flag else (rows, None)
        # ids made for this load match no stored row, so there is nothing to look up
        action = "append" if task.fresh_ids else action

    expected, counted = task.spec.expected_rows, Observation()
    if expected is not None and action == "upsert":
        rows = rows.observe(counted, F.count(F.lit(1)).alias("rows"))
    elif action not in ("append", "replace"):
        expected = None

    def check(written: Written) -> None:
        # what is appended is counted where it is written: the sample of a sorted write reads its input once more
        got = int(counted.get.get("rows") or 0) if expected is not None and action == "upsert" else written.rows
        if expected is not None and got != expected:
            dataset.discard(task.table, [*written.parts, *written.dead])
            raise IncompleteReadError(f"table {task.table!r}: received {got} of {expected} rows")

    if action == "replace-of-keys":
        return _replace_keys(dataset, task.table, applied, rows, task.key, None, conform(task.keys, T.StructType([version.schema[k] for k in task.key])), ids_of=task.ids_of)
    if action in ("upsert", "update"):
        key = task.key or [ROW_ID]
        winners = last_per_key(rows, key, order=task.spec.order_by, hard_delete=flag)
        winners = winners if flag else winners.drop(DELETED)
        if action == "update":
            known = known_keys(dataset.near(task.table, version, winners, key), winners, key)
            winners = winners.join(known, list(key), "left_semi").select(*winners.columns)
        return _replace_keys(dataset, task.table, applied, winners, key, DELETED if flag else None, check=check)

    if action == "insert-only":
        key = task.key or [ROW_ID]
        rows = new_rows(dataset.near(task.table, version, rows, key), rows, key, hard_delete=flag)
    written = dataset.write_parts(task.table, version, rows.drop(*POSITION), ids_of=task.ids_of)
    check(written)
    if action == "append":
        base = replace(version, loads=applied.loads[:-1])
        dataset.publish_append(task.table, base, written.parts, written.rows, [load_id])
    elif action == "replace":
        dataset.publish(task.table, replace(applied, parts=written.parts, rows=written.rows))
    else:
        dataset.publish(task.table, replace(applied, parts=[*version.parts, *written.parts], rows=version.rows + written.rows))
    return written.rows


def _pending(version: TableVersion, done: set[str], load_id: str) -> list[str]:
    """Loads to keep on the table: those a retry could still bring, which are not in the load log, and this one."""
    return [*(i for i in version.loads if i not in done), load_id]


def _replace_keys(
    dataset: Dataset,
    table: str,
    version: TableVersion,
    winners: DataFrame,
    key: list[str],
    dead: str | None,
    keys: DataFrame | None = None,
    check: Callable[[Written], None] = lambda _: None,
    ids_of: str | None = None,
) -> int:
    """Publish the table with every row of the keys (the winners' own, unless given) replaced by the winners.

    The folded batch is written once, straight into its final part (rows that end
    deleted beside it). Its keys are then read from there, so that their size is known
    and Spark plans each join with them as a broadcast or as a shuffle by that size.
    """
    written = dataset.write_parts(table, version, winners, dead, measured=() if keys is not None else key, ids_of=ids_of)
    check(written)
    if keys is None:
        keys = dataset.scan(table, version, [*written.parts, *written.dead]).select(*(quoted(k) for k in key))
    parts, removed = dataset.without_keys(table, version, keys, key, written.bounds)
    rows = version.rows - removed + written.rows
    dataset.publish(table, replace(version, parts=[*parts, *written.parts], rows=rows))
    dataset.discard(table, written.dead)
    return written.rows


def _delete(dataset: Dataset, task: _Task, version: TableVersion) -> int:
    keys = guard_keys(task.rows.select(*(quoted(k) for k in task.key)), task.key)
    keys = conform(keys, T.StructType([version.schema[k] for k in task.key])).distinct()
    # read from files, their size is known, and finding them is not done again for each use
    folder = fs.shared_folder(dataset.spark) + "/keys"
    keys.write.parquet(folder)
    keys = dataset.spark.read.schema(keys.schema).parquet(folder)
    parts, removed = dataset.without_keys(task.table, version, keys, task.key, {})
    dataset.publish(task.table, replace(version, parts=parts, rows=version.rows - removed, loaded=True))
    return removed


def delete_rows(dataset: Dataset, table: str, keys: DataFrame, key: Sequence[str], *, load_id: str | None = None) -> int:
    """Remove the rows whose key is listed, as a load of its own; returns how many went."""
    _known(dataset, table)
    rows = keys.select(*(quoted(k) for k in key))
    spec = LoadSpec(table, rows, primary_key=list(key))
    task = _Task(normalize_identifier(table), spec, rows, "delete", list(key), None, [], False)
    return _run(dataset, [task], load_id or _new_id()).get(task.table, 0)


def update_rows(
    dataset: Dataset, table: str, incoming: DataFrame, key: Sequence[str], order_by: Sequence[str] = (), *, load_id: str | None = None
) -> int:
    """Replace the rows the table already holds, as a load of its own; unknown keys are ignored."""
    _known(dataset, table)
    load_id = load_id or _new_id()
    spec = LoadSpec(table, incoming, primary_key=list(key), order_by=list(order_by))
    tasks = [replace(t, action="update") for t in _prepare(dataset, spec, load_id, "upsert")]
    return _run(dataset, tasks, load_id).get(tasks[0].table, 0)


def _known(dataset: Dataset, table: str) -> None:
    if dataset.version(normalize_identifier(table)) is None:
        raise UndefinedTableError(f"table {dataset.schema}.{table} does not exist")


@contextmanager
def _named_errors() -> Iterator[None]:
    """Failures raised by a check inside a plan, as the error a caller can act on."""
    try:
        yield
    except PySparkException as error:
        for text, kind in ((NULL_KEY, NullKeyError), (DUPLICATE_KEY, DuplicateKeyError)):
            at = str(error).find(text)
            if at >= 0:
                raise kind(str(error)[at:].split("\n")[0]) from error
        raise


# -- incremental ---------------------------------------------------------------------


def load_incremental(
    dataset: Dataset,
    spec: LoadSpec,
    cursor: str,
    *,
    pipeline: str,
    load_id: str | None = None,
    closed: bool | None = None,
    null_cursors: str = "raise",
    **options: Any,
) -> DataFrame:
    """Load the rows past the cursor the last completed run stored, and store the new one.

    The upper bound is read first and bounds the load as well, so rows that arrive in
    between belong to the next run. ``closed`` reads the rows at the last value again, for
    sources where one cursor value fills up over time; those already stored are left out
    by key. It is the default where there is a key.

    Rows without a cursor value, or with one that is no number (NaN, which nothing is ever past), are refused unless ``null_cursors`` is "include" (they are
    loaded by every run; a key tells those already stored) or "exclude". ``spec.data`` may be
    the files of a package.
    """
    if null_cursors not in ("raise", "include", "exclude"):
        raise LoadError(f"null_cursors is {null_cursors!r}; known are raise, include, exclude")
    if not isinstance(spec.data, DataFrame):
        spec = replace(spec, data=read_package(dataset.spark, list_files(dataset.spark, spec.data)))
    key = spec.key
    closed = bool(key) if closed is None else closed
    saved = bookkeeping.read_state(dataset, pipeline)
    resource = (saved or {}).get(spec.name, {})
    last = resource.get("last_value")
    rows, at = spec.data, quoted(cursor)
    dtype = rows.schema[cursor].dataType
    missing = _no_cursor(at, dtype)
    if null_cursors == "raise" and not rows.where(missing).isEmpty():
        raise LoadError(f"rows without a value in cursor {cursor!r}; choose null_cursors='include' or 'exclude'")
    low = None if last is None else F.lit(last).cast(dtype)
    fresh = since(rows.where(~missing), cursor, low, closed=closed)
    top = F.max(at)
    # an instant is stored with its offset, so a session in another zone reads the same one
    as_text = F.date_format(top, "yyyy-MM-dd HH:mm:ss.SSSSSSXXX") if isinstance(dtype, T.TimestampType) else top.cast("string")
    high = fresh.agg(as_text).first()[0]
    if high is not None:
        fresh = since(fresh, cursor, up_to=F.lit(high).cast(dtype))
    if null_cursors == "include":
        fresh = fresh.unionByName(rows.where(missing))
    if last is not None and dataset.version(spec.target) is not None and (closed or null_cursors == "include"):
        if not key:
            raise LoadError("rows that are read again need a key to tell those already stored by")
        stored = quoted(normalize_identifier(cursor))
        unplaced = _no_cursor(stored, dtype) if null_cursors == "include" else F.lit(False)
        again = F.coalesce(stored == low if closed else F.lit(False), F.lit(False)) | unplaced
        seen = dataset.table(spec.target).where(again).select(*(quoted(normalize_identifier(k)).alias(k) for k in key))
        fresh = keep_unmatched(fresh, seen, key)
    state = {**(saved or {}), spec.name: {"cursor": cursor, "last_value": high if high is not None else last}}
    return load(dataset, replace(spec, data=fresh), load_id=load_id, pipeline=pipeline, state=state, **options)


def _no_cursor(value: Column, dtype: T.DataType) -> Column:
    return value.isNull() | F.isnan(value) if isinstance(dtype, (T.FloatType, T.DoubleType)) else value.isNull()


def declare_tables(dataset: Dataset, tables: Iterable[str]) -> None:
    """Names only: tables that exist (empty, without columns) before their first load."""
    dataset.declare({normalize_identifier(t): T.StructType() for t in tables} | SCHEMAS)

