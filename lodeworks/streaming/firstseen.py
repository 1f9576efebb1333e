"""Insert-only streams that remember the keys they have seen in a state store."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import replace
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from lodeworks.errors import LoadError
from lodeworks.functions.keys import guard_keys, quoted, split_hard_delete
from lodeworks.functions.local import empty_frame
from lodeworks.functions.names import check_names, normalize_identifier
from lodeworks.plans import files as fs
from lodeworks.plans.dataset import Dataset
from lodeworks.spec import LoadSpec
from lodeworks.streaming.microbatch import stream_load

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


def _first_rows(columns: list[str], ttl_ms: int | None):
    """The rows of a key's first micro-batch, all of them; later ones are dropped.

    Made here, so that the class goes to the workers by value.
    """

    class FirstRows(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.seen = handle.getValueState("seen", "seen boolean", ttl_ms)

        def handleInitialState(self, key: Any, initial: Any, timers: Any) -> None:
            self.seen.update((True,))

        def handleInputRows(self, key: Any, rows: Iterator[Row], timers: Any) -> Iterator[Row]:
            if not self.seen.exists():
                self.seen.update((True,))
                for row in rows:
                    yield Row(**{c: row[c] for c in columns})

        def close(self) -> None:
            pass

    return FirstRows()


def _plain(value: Column, dtype: T.DataType) -> Column:
    """An instant as a number: it goes through Python, where local times can be ambiguous."""
    return F.unix_micros(value) if isinstance(dtype, T.TimestampType) else value


def _again(value: Column, dtype: T.DataType) -> Column:
    return F.timestamp_micros(value) if isinstance(dtype, T.TimestampType) else value


def first_rows(rows: DataFrame, key: list[str], known: DataFrame | None = None, remember_ms: int | None = None) -> DataFrame:
    """Of a stream, the rows of the micro-batch that brings a key first.

    ``known`` are keys (distinct) to take as seen at the start; they are read when the stream
    first runs, never again. With ``remember_ms`` a key is forgotten so long after it came, and
    then counts as new: the state grows with the keys of that time, not of all time.
    """
    rows = guard_keys(rows, key)
    columns, schema = rows.columns, rows.schema
    through = rows.select(*(_plain(quoted(c), schema[c].dataType).alias(c) for c in columns))
    start = None
    if known is not None:
        start = known.select(*(_plain(quoted(k), schema[k].dataType).alias(k) for k in key)).groupBy(*(quoted(k) for k in key))
    mode = "ProcessingTime" if remember_ms else "None"
    found = through.groupBy(*(quoted(k) for k in key)).transformWithState(_first_rows(columns, remember_ms), through.schema, "Append", mode, start)
    return found.select(*(_again(quoted(c), schema[c].dataType).alias(c) for c in columns))


def _written(batch: DataFrame) -> DataFrame:
    """The micro-batch from files: the stateful plan runs exactly once, also if its load turns out to be done already."""
    path = fs.shared_folder(batch.sparkSession) + "/batch"
    batch.write.parquet(path)
    return batch.sparkSession.read.schema(batch.schema).parquet(path)


def stream_insert_only(
    dataset: Dataset, spec: LoadSpec, *, checkpoint: str, query_name: str, remember_ms: int | None = None, **options: Any
) -> StreamingQuery:
    """An insert-only load of every micro-batch that never scans the target for keys.

    Which keys are known is kept in the stream's own state store (RocksDB), one entry per key,
    dealt by key over the tasks; at the start it takes over the keys the table holds. Each
    micro-batch appends the rows of the keys that are new, under a load id of its own, so a
    replay changes nothing. Rows flagged as deletes are dropped before they make a key known.
    """
    key = [normalize_identifier(k) for k in spec.key or ()]
    if not key:
        raise LoadError("an insert-only stream needs a key to tell rows by")
    rows = spec.data.withColumnsRenamed({c: n for c, n in zip(spec.data.columns, check_names(spec.data.columns)) if c != n})
    if spec.delete_flag in rows.columns:
        rows = split_hard_delete(rows, spec.delete_flag)[0]
    # there is a start in every run, empty or not: a plan that gains one cannot go on from its checkpoint
    version, known = dataset.version(spec.target), empty_frame(dataset.spark, T.StructType([T.StructField(k, rows.schema[k].dataType) for k in key]))
    if version is not None and set(key) <= set(version.schema.names):
        stored = dataset.table(spec.target, version=version)
        known = stored.select(*(quoted(k).cast(rows.schema[k].dataType).alias(k) for k in key)).distinct()
    dataset.spark.conf.set(_PROVIDER, _ROCKSDB)
    # no timer waits for a batch without rows, and with a time to live there would be one after another
    dataset.spark.conf.set(_EMPTY_BATCHES, "false")
    new = first_rows(rows, key, known, remember_ms)
    spec = replace(spec, data=new, primary_key=key, write_disposition="append", merge_strategy=None)
    return stream_load(dataset, spec, checkpoint=checkpoint, query_name=query_name, transform=_written, **options)
