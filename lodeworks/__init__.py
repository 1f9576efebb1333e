"""Load batches into managed Parquet tables and read them back, on Spark DataFrames."""

from lodeworks.errors import (
    ConcurrentPublishError,
    DuplicateKeyError,
    IncompleteReadError,
    LayoutError,
    LoadError,
    NullKeyError,
    SchemaConflictError,
    UndefinedDatasetError,
    UndefinedTableError,
    UnverifiableReadError,
)
from lodeworks.operators.layout import with_layout
from lodeworks.plans.dataset import Dataset
from lodeworks.plans.loader import delete_rows, load, load_incremental, update_rows
from lodeworks.sources.tables import query_source, table_source
from lodeworks.sources.verified import export_batches, number_batches, read_batches, verified_read
from lodeworks.spec import LoadSpec
from lodeworks.streaming.firstseen import stream_insert_only
from lodeworks.streaming.microbatch import stream_load

__all__ = [
    "ConcurrentPublishError",
    "Dataset",
    "DuplicateKeyError",
    "IncompleteReadError",
    "LayoutError",
    "LoadError",
    "LoadSpec",
    "NullKeyError",
    "SchemaConflictError",
    "UndefinedDatasetError",
    "UndefinedTableError",
    "UnverifiableReadError",
    "delete_rows",
    "export_batches",
    "load",
    "load_incremental",
    "number_batches",
    "query_source",
    "read_batches",
    "stream_insert_only",
    "stream_load",
    "table_source",
    "update_rows",
    "verified_read",
    "with_layout",
]
