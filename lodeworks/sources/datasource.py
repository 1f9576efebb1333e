"""Tables of a dataset as a Spark data source, for batch and streaming reads.

``register(spark)`` makes ``spark.read.format("lodeworks")`` and ``spark.readStream`` known.
Options: ``path`` (the dataset's directory), ``table``, ``schema`` (default ``public``),
``batch_rows`` (default 50,000); for streams ``start`` (the version to begin after, 0 if not
given) and ``on_rewrite`` (``raise`` or ``skip``).

The log of the table is read once, to plan; each data file is then read by a task of its own,
in batches of at most ``batch_rows`` rows, cut but never combined, so a task holds one batch.
A part that has other files or bytes than its version lists, or a file that ends short of what its footer
says, fails the read. Filters that Parquet can answer skip row groups; Spark applies
them again. A stream's offsets are version numbers: a batch gives the rows of the parts that
versions added, and a version that changed stored rows is refused unless it is to be skipped.

This module is sent to the workers as it is, so it uses nothing else of the package.
"""

from __future__ import annotations

import json
import operator
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import reduce
from hashlib import sha256
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import SparkSession
from pyspark.sql import datasource as api
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

_BATCH_ROWS = 50_000
_ROW_ID, _PARENT_ID, _LIST_INDEX = "_dlt_id", "_dlt_parent_id", "_dlt_list_idx"
_FORMAT = ds.ParquetFileFormat(default_fragment_scan_options=ds.ParquetFragmentScanOptions(pre_buffer=False), coerce_int96_timestamp_unit="us")
_COMPARED = {"EqualTo": operator.eq, "GreaterThan": operator.gt, "GreaterThanOrEqual": operator.ge, "LessThan": operator.lt, "LessThanOrEqual": operator.le}


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """Where a path of Spark's lies, for readers that are not Spark."""
    local = re.sub(r"^file:/*", "/", path)
    if local.startswith("/"):
        return pafs.LocalFileSystem(), (unquote(local) if local != path else path)
    return pafs.FileSystem.from_uri(path)


@dataclass(frozen=True)
class Snapshot:
    """A version of a table as its log tells it."""

    number: int
    schemas: list
    parts: list


@dataclass(frozen=True)
class Log:
    """The log of one table, read without Spark."""

    root: str
    table: str
    schema: str = "public"

    @property
    def home(self) -> str:
        return f"{self.root.rstrip('/')}/{self.schema}/{self.table}"

    def _read(self, path: str) -> bytes:
        system, place = file_system(f"{self.home}/{path}")
        with system.open_input_file(place) as f:
            return f.read()

    def names(self, folder: str) -> list[str]:
        return [name for name, _ in self.files(folder)]

    def files(self, folder: str) -> list[tuple[str, int]]:
        """Names and sizes in a folder of the table that are not hidden."""
        system, place = file_system(f"{self.home}/{folder}")
        found = system.get_file_info(pafs.FileSelector(place, allow_not_found=True))
        return sorted((f.base_name, f.size or 0) for f in found if f.base_name[0] not in "._")

    def newest(self) -> int:
        numbers = [int(n.partition(".")[0]) for n in self.names("versions") if n.endswith(".json")]
        if not numbers:
            raise LookupError(f"table {self.schema}.{self.table} does not exist")
        return max(numbers)

    def at(self, number: int) -> Snapshot:
        if number == 0:
            return Snapshot(0, [], [])
        try:
            content = json.loads(self._read(f"versions/{number:012d}.json"))
        except FileNotFoundError:
            raise LookupError(f"version {number} of {self.schema}.{self.table} is no longer kept") from None
        listed = []
        if content["base"]:
            system, place = file_system(f"{self.home}/checkpoints/{content['base']}")
            listed = [json.loads(e) for e in ds.dataset(place, filesystem=system, format="parquet").to_table(columns=["entry"]).column("entry").to_pylist()]
        gone = set(content["dropped"])
        return Snapshot(number, content["schemas"], [*(p for p in listed if p["path"] not in gone), *content["added"]])


@dataclass
class File(api.InputPartition):
    """One data file, how it is read, and in which columns it was written."""

    path: str
    home: str
    schema: str
    batch_rows: int
    mask: str | None = None
    filters: list = field(default_factory=list)
    ids_of: str | None = None

    def __init__(self, path: str, home: str, schema: str, batch_rows: int, mask: str | None = None, filters: Iterable = (), ids_of: str | None = None):
        self.path, self.home, self.schema, self.batch_rows, self.mask, self.filters, self.ids_of = path, home, schema, batch_rows, mask, list(filters), ids_of


def _planned(log: Log, parts: Iterable[dict], schema: StructType, batch_rows: int, filters: Iterable = ()) -> list[File]:
    """The files of the parts; a part that does not hold what its version lists is refused."""
    out = []
    for part in parts:
        files = log.files(f"data/{part['path']}")
        size = sum(n for _, n in files)
        if (len(files), size) != (part.get("files", len(files)), part.get("bytes", size)):
            raise RuntimeError(f"incomplete read: {part['path']} holds {len(files)} files of {part['files']}, {size} bytes of {part['bytes']}")
        left_out = {unquote(f.rpartition("/")[2]) for f in part.get("without", ())}
        out += [File(f"data/{part['path']}/{name}", log.home, schema.json(), batch_rows, part.get("mask"), filters, part.get("ids_of")) for name, _ in files if name not in left_out]
    return out


def _encoded(path: str) -> str:
    """A path as it stands in a URI."""
    return re.sub(r'[\s%"<>\\^`{|}\[\]#?]', lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), path)


def _masked_rows(file: File) -> dict[int, int]:
    """word -> bits of the rows of a file that are masked."""
    if not file.mask:
        return {}
    system, place = file_system(f"{file.home}/masks/{file.mask}")
    name = _encoded(file.path.partition("__part=")[2])
    rows = ds.dataset(place, filesystem=system, format="parquet").to_table(filter=pc.field("mask_file") == name)
    return dict(zip(rows.column("mask_word").to_pylist(), rows.column("mask_bits").to_pylist()))


def _left(batch: pa.RecordBatch, first: int, gone: dict[int, int]) -> pa.RecordBatch:
    """The rows of a batch, whose first is row ``first`` of its file, that no mask takes out."""
    last = first + batch.num_rows
    hit = [w for w in range(first >> 6, (last + 63) >> 6) if w in gone]
    if not hit:
        return batch
    out = {64 * w + k for w in hit for k in range(64) if gone[w] >> k & 1}
    return batch.filter(pa.array([first + k not in out for k in range(batch.num_rows)]))


def _conformed(batch: pa.RecordBatch, schema: pa.Schema, ids_of: str | None = None) -> pa.RecordBatch:
    """In the table's columns: those a file lacks are null (row ids of a child table are made again), narrower types are widened."""
    columns = []
    if ids_of:
        places = zip(batch.column(_PARENT_ID).to_pylist(), batch.column(_LIST_INDEX).to_pylist())
        batch = batch.append_column(_ROW_ID, pa.array([sha256(f"{p}_{ids_of}_{k}".encode()).hexdigest() for p, k in places], pa.string()))
    for f in schema:
        at = batch.schema.get_field_index(f.name)
        columns.append(pa.nulls(batch.num_rows, f.type) if at < 0 else batch.column(at) if batch.column(at).type == f.type else batch.column(at).cast(f.type))
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def read_file(file: File) -> Iterator[pa.RecordBatch]:
    """The file's rows in batches of at most ``batch_rows``; short ones fail at the end."""
    schema = to_arrow_schema(StructType.fromJson(json.loads(file.schema)))
    system, place = file_system(f"{file.home}/{file.path}")
    gone = _masked_rows(file)
    if not gone and file.filters:
        data = ds.dataset([place], filesystem=system, format=_FORMAT)
        tests = [t for t in (_expression(f, data.schema) for f in file.filters) if t is not None]
        if tests:
            for batch in data.to_batches(filter=reduce(operator.and_, tests), batch_size=file.batch_rows):
                if batch.num_rows:
                    yield _conformed(batch, schema, file.ids_of)
            return
    at = 0
    with system.open_input_file(place) as f:
        source = pq.ParquetFile(f, coerce_int96_timestamp_unit="us")
        for batch in source.iter_batches(batch_size=file.batch_rows):
            first, at = at, at + batch.num_rows
            left = _left(batch, first, gone)
            if left.num_rows:
                yield _conformed(left, schema, file.ids_of)
        if at != source.metadata.num_rows:
            raise RuntimeError(f"incomplete read: {at} of {source.metadata.num_rows} rows of {file.path}")


def _expression(test: tuple, schema: pa.Schema) -> pc.Expression | None:
    kind, name, value = test
    if name not in schema.names:
        return None
    column = pc.field(name)
    return column.isin(value) if kind == "In" else _COMPARED[kind](column, value)


class Reader(api.DataSourceReader):
    def __init__(self, log: Log, number: int, schema: StructType, batch_rows: int):
        self.log, self.number, self.schema, self.batch_rows, self.filters = log, number, schema, batch_rows, []

    def pushFilters(self, filters: list[api.Filter]) -> Iterable[api.Filter]:
        plain = {f.name for f in self.schema.fields if f.dataType.typeName() in ("byte", "short", "integer", "long", "string")}
        for f in filters:
            kind = type(f).__name__
            if (kind in _COMPARED or kind == "In") and len(f.attribute) == 1 and f.attribute[0] in plain:
                self.filters.append((kind, f.attribute[0], list(f.value) if kind == "In" else f.value))
            yield f  # skips row groups; Spark still looks at each row

    def partitions(self) -> list[File]:
        return _planned(self.log, self.log.at(self.number).parts, self.schema, self.batch_rows, self.filters)

    def read(self, partition: File) -> Iterator[pa.RecordBatch]:
        yield from read_file(partition)


class StreamReader(api.DataSourceStreamReader):
    def __init__(self, log: Log, start: int, schema: StructType, batch_rows: int, on_rewrite: str):
        if on_rewrite not in ("raise", "skip"):
            raise ValueError(f"on_rewrite is {on_rewrite!r}; known are raise and skip")
        self.log, self.start, self.schema, self.batch_rows, self.on_rewrite = log, start, schema, batch_rows, on_rewrite

    def initialOffset(self) -> dict:
        return {"version": self.start}

    def latestOffset(self) -> dict:
        return {"version": self.log.newest()}

    def partitions(self, start: dict, end: dict) -> list[File]:
        out, before = [], None
        for number in range(int(start["version"]) + 1, int(end["version"]) + 1):
            before = before or self.log.at(number - 1)
            after = self.log.at(number)
            stored = {p["path"]: p.get("masked", 0) for p in after.parts}
            if any(stored.get(p["path"]) != p.get("masked", 0) for p in before.parts):
                if self.on_rewrite == "raise":
                    raise RuntimeError(f"version {number} of {self.log.schema}.{self.log.table} changed stored rows; on_rewrite='skip' passes over it")
            else:
                known = {p["path"] for p in before.parts}
                out += _planned(self.log, [p for p in after.parts if p["path"] not in known], self.schema, self.batch_rows)
            before = after
        return out

    def read(self, partition: File) -> Iterator[pa.RecordBatch]:
        yield from read_file(partition)


class Source(api.DataSource):
    """``format("lodeworks")``: see the module."""

    @classmethod
    def name(cls) -> str:
        return "lodeworks"

    def _log(self) -> Log:
        missing = [o for o in ("path", "table") if not self.options.get(o)]
        if missing:
            raise ValueError(f"format lodeworks needs the option {missing[0]}")
        return Log(self.options["path"], self.options["table"].lower(), self.options.get("schema", "public"))

    def _rows(self) -> int:
        return max(1, int(self.options.get("batch_rows", _BATCH_ROWS)))

    def schema(self) -> StructType:
        log = self._log()
        schemas = log.at(log.newest()).schemas
        return StructType.fromJson(schemas[-1]) if schemas else StructType()

    def reader(self, schema: StructType) -> Reader:
        log = self._log()
        return Reader(log, int(self.options.get("version") or log.newest()), schema, self._rows())

    def streamReader(self, schema: StructType) -> StreamReader:
        return StreamReader(self._log(), int(self.options.get("start", 0)), schema, self._rows(), self.options.get("on_rewrite", "raise"))


def register(spark: SparkSession) -> None:
    """Make the format known to a session, its workers included."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Source)
