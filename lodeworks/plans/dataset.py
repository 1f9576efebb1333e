"""A dataset: a directory of tables that change only by publishing a new version.

``<root>/<schema>/<table>/data/__part=<name>/...`` holds immutable Parquet parts and
``<root>/<schema>/<table>/versions/<n>.json`` says which parts make version ``n`` (see
``tablelog``). A load writes new parts and then one version file, so readers see all of it
or nothing, a failed or retried job leaves nothing visible, and a rewrite may read the
table it replaces. Rows that a merge replaces or deletes stay in their files and are masked
(see ``masks``); ``compact`` writes files anew.

Appends may race: the one that comes second is published on top of the first, and so is a
compaction. Any other change of a table has one writer; a second one fails at publish.
"""

from __future__ import annotations

import json
import uuid
import warnings
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass, replace
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeworks.errors import ConcurrentPublishError, UndefinedDatasetError, UndefinedTableError
from lodeworks.functions.keys import guard_keys, quoted
from lodeworks.functions.local import empty_frame, local_frame
from lodeworks.functions.names import check_names, normalize_identifier
from lodeworks.functions.nested import child_id
from lodeworks.functions.schema import conform
from lodeworks.operators.bookkeeping import INTERNAL_TABLES, SCHEMAS
from lodeworks.operators.identity import ROW_ID
from lodeworks.operators.layout import Layout, apply_layout, order_rows, partition_value
from lodeworks.plans import files as fs
from lodeworks.plans import content, masks
from lodeworks.plans.masks import PART
from lodeworks.plans.relations import names_in, unqualified
from lodeworks.plans.tablelog import TableLog, TableVersion

_MARKER = "dataset.json"
# Key types whose range is worth passing to the scan, and whose values Parquet can keep a bloom filter of.
_RANGED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType)
# Types of a first sort key whose range in each file is kept.
_SPANNED = (*_RANGED, T.FloatType, T.DoubleType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType)
# How often a change that lost the race for a version number tries the next one.
_APPEND_TRIES = 50
# So many keys go to the scan one by one; more of them as a range.
_LISTED = 256
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
# What no version ever listed is some load's unfinished work for so long.
_ORPHAN_HOURS = 24.0


@dataclass(frozen=True)
class Written:
    """What one write left behind."""

    parts: list
    rows: int
    dead: list  # parts of rows marked dead; no version lists them
    bounds: dict  # key column -> (lowest, highest) of all rows, dead ones included


class Dataset:
    """Tables of one namespace in one directory."""

    def __init__(self, spark: SparkSession, root: str, schema: str = "public"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        self._lists: dict[str, list] = {}

    # -- lifecycle ---------------------------------------------------------------

    @classmethod
    def init(
        cls, spark: SparkSession, root: str, *, schema: str = "public", create: bool = True, name: str | None = None
    ) -> Dataset:
        """Open a dataset directory, creating it unless it is pinned (``create=False``)."""
        dataset = cls(spark, root, schema)
        if not dataset.is_initialized():
            if not create:
                raise UndefinedDatasetError(f"no dataset at {root}")
            fs.make_directory(spark, dataset.root)
            fs.write_new(spark, f"{dataset.root}/{_MARKER}", json.dumps({"name": name or root.rsplit("/", 1)[-1]}))
        return dataset

    def is_initialized(self) -> bool:
        return fs.exists(self.spark, f"{self.root}/{_MARKER}")

    @property
    def name(self) -> str:
        """A label only; the path is the identity."""
        return json.loads(fs.read_text(self.spark, f"{self.root}/{_MARKER}"))["name"]

    def drop(self) -> None:
        """Remove the whole dataset. Nothing happens if there is none; a directory that
        holds something else is refused."""
        if not fs.exists(self.spark, self.root):
            return
        if not self.is_initialized():
            raise UndefinedDatasetError(f"{self.root} is not a dataset; not removing it")
        fs.delete(self.spark, self.root)

    # -- versions ----------------------------------------------------------------

    def _home(self, table: str) -> str:
        return f"{self.root}/{self.schema}/{table}"

    def log(self, table: str) -> TableLog:
        return TableLog(self.spark, self._home(table), self._lists)

    def version(self, table: str) -> TableVersion | None:
        """The current version, or None for a table never declared."""
        return self.log(table).newest()

    def publish(self, table: str, version: TableVersion) -> TableVersion:
        """Make ``version`` (derived from the current one) the next version."""
        return self.log(table).publish(version)

    def publish_append(self, table: str, base: TableVersion, parts: Sequence[dict], rows: int, loads: Sequence[str] = ()) -> TableVersion:
        """Publish ``base`` with more parts; if someone else published first, the same on top of theirs.

        Appended parts fit any later version, unless its schema is another one.
        """

        def onto(version: TableVersion) -> TableVersion | None:
            if version.schemas and version.schemas[-1:] != base.schemas[-1:]:
                return None
            placed = [{**p, "schema": len(version.schemas or base.schemas) - 1} for p in parts]
            schemas = version.schemas or base.schemas
            return replace(version, schemas=schemas, parts=[*version.parts, *placed], rows=version.rows + rows, loaded=True, loads=[*version.loads, *loads])

        return self._publish_onto(table, base, onto)

    def _publish_onto(self, table: str, base: TableVersion, onto: Callable[[TableVersion], TableVersion | None]) -> TableVersion:
        """Publish ``onto(base)``, or ``onto`` of what others published meanwhile, if it gives anything for that."""
        for left in range(_APPEND_TRIES, 0, -1):
            try:
                return self.publish(table, onto(base))
            except ConcurrentPublishError:
                base = self.version(table)
                if left == 1 or onto(base) is None:
                    raise
        raise AssertionError("unreachable")

    def declare(
        self,
        tables: Mapping[str, T.StructType],
        keys: Mapping[str, Sequence[str]] | None = None,
        layouts: Mapping[str, Layout] | None = None,
    ) -> list[str]:
        """Add the tables that are missing, empty but with schema, key and layout.

        Tables already there keep their data, key and layout; a layout that differs from
        the stored one is only warned about. Returns the names added.
        """
        check_names(tables)
        present = set(self.table_names())
        added = []
        for table, schema in sorted(tables.items()):
            layout = (layouts or {}).get(table, Layout())
            if table in present:
                if layout and not layout.satisfied_by(self.version(table).layout):
                    warnings.warn(
                        f"{self.schema}.{table} keeps the layout it was created with; another layout was declared and is ignored",
                        stacklevel=2,
                    )
                continue
            first = TableVersion(
                schemas=[json.loads(schema.json())],
                key=list((keys or {}).get(table) or []) or None,
                partition_by=[asdict(k) for k in layout.partitions],
                sorted_by=[asdict(k) for k in layout.sorts],
            )
            try:
                self.publish(table, first)
                added.append(table)
            except ConcurrentPublishError:  # someone else declared it: it is there
                if self.version(table).schemas[-1:] != first.schemas[-1:] and first.schema.fields:
                    raise
        return added

    def truncate(self, tables: Iterable[str]) -> None:
        """Empty tables, keeping schema, key and layout. Internal tables and tables that
        have no columns yet are left alone."""
        for table in tables:
            table = normalize_identifier(table)
            version = self.version(table)
            if table in INTERNAL_TABLES or version is None or not version.schema.fields:
                continue
            self.publish(table, replace(version, parts=[], rows=0, loaded=True))

    def vacuum(self, table: str, keep: int = 1, orphan_hours: float = _ORPHAN_HOURS) -> int:
        """Delete what only versions before the newest ``keep`` need; returns the parts deleted.

        What no version ever listed may be a load that still runs. It goes when it has not
        changed for ``orphan_hours``, which must be more than any load takes.
        """
        home, log = self._home(table), self.log(table)
        numbers = log.numbers()
        old, kept = numbers[: -max(keep, 1)], numbers[-max(keep, 1) :]
        needed, spare = (self._named([log.read(n) for n in some]) for some in (kept, old))
        deleted = 0
        for folder in ("data", "masks", "spans", "checkpoints"):
            for name in fs.children(self.spark, f"{home}/{folder}"):
                path = f"{home}/{folder}/{name}"
                if name[0] in "._" and not name.startswith(PART) or name in needed[folder]:
                    continue
                if name in spare[folder] or fs.age_hours(self.spark, path) > orphan_hours:
                    fs.delete(self.spark, path)
                    deleted += folder == "data"
        for number in old:
            fs.delete(self.spark, log.file(number))
        return deleted

    @staticmethod
    def _named(versions: Sequence[TableVersion]) -> dict[str, set[str]]:
        """Directories of the table that these versions need."""
        parts = [p for v in versions for p in v.parts]
        return {"data": {p["path"].split("/")[0] for p in parts}, "masks": {p["mask"] for p in parts if "mask" in p}, "spans": {p["spans"] for p in parts if "spans" in p}, "checkpoints": {v.base for v in versions}}

    # -- reading -----------------------------------------------------------------

    def table_names(self) -> list[str]:
        names = fs.children(self.spark, f"{self.root}/{self.schema}")
        return [n for n in names if fs.exists(self.spark, f"{self._home(n)}/versions")]

    def list_tables(self, names: Iterable[str] | None = None) -> DataFrame:
        """(table, loaded, row_count) of every table, from the version files alone."""
        rows = []
        for name in self.table_names() if names is None else names:
            version = self.version(name)
            if version is None:
                raise UndefinedTableError(f"table {self.schema}.{name} does not exist")
            rows.append((name, version.loaded, version.rows))
        return local_frame(self.spark, rows, "table string, loaded boolean, row_count bigint")

    def table(
        self,
        name: str,
        *,
        between: tuple[str, Any, Any] | None = None,
        version: TableVersion | None = None,
    ) -> DataFrame:
        """The table as a DataFrame in its stored schema, also if it holds no file.

        ``between=(column, low, high)`` filters on a column; if the layout partitions by
        it (or by its year, month, day or hour) the same bound prunes directories, and if it
        is the first sort key, files whose range lies elsewhere are not opened.
        """
        version = version or self.version(name)
        if version is None:
            raise UndefinedTableError(f"table {self.schema}.{name} does not exist")
        if between is not None:
            column, low, high = between
            version = replace(version, parts=self._outside(name, version, column, low, high))
        rows = self.scan(name, version)
        if between is not None:
            rows = rows.where(quoted(column).between(F.lit(low), F.lit(high)))
            dtype = version.schema[column].dataType
            for key in version.partitions:
                if key.column != column:
                    continue
                bounds = [F.lit(v).cast(dtype) for v in (low, high)]
                if key.transform == "identity":
                    stored = dtype if not isinstance(dtype, T.TimestampType) else T.TimestampNTZType()
                    ends = [partition_value(key, dtype, b).cast(stored) for b in bounds]
                    rows = rows.where(F.col(key.derived).cast(stored).between(*ends))
                else:
                    rows = rows.where(F.col(key.derived).between(*(partition_value(key, dtype, b) for b in bounds)))
        return rows.select(*(quoted(c) for c in version.schema.names))

    def scan(self, name: str, version: TableVersion, parts: Sequence[dict] | None = None) -> DataFrame:
        """Stored columns plus the directory columns; each part is read in its own schema."""
        parts = version.parts if parts is None else parts
        current = version.schema
        technical = [T.StructField(PART, T.StringType())]
        technical += [T.StructField(k.derived, T.StringType()) for k in version.partitions]
        full = T.StructType([*current.fields, *technical])
        if not parts:
            return empty_frame(self.spark, full)
        return reduce(DataFrame.unionByName, (conform(f, full) for f, _ in self._frames(name, version, parts, technical)))

    def _frames(
        self, name: str, version: TableVersion, parts: Sequence[dict], technical: Sequence[T.StructField] = (), place: bool = False
    ) -> list[tuple[DataFrame, T.StructType]]:
        """One scan per stored schema; parts with masked rows have a scan of their own, joined with their masks.

        So have parts of which ``compact`` left files out. The names of these are compared with
        a constant of each file, which Spark does while it plans the scan: files left out are
        not opened. Row ids that a write left out are made again. ``place`` adds each row's file and number.
        """
        groups: dict[tuple, list[dict]] = {}
        for part in parts:
            groups.setdefault((part["schema"], "without" in part, "mask" in part, part.get("ids_of")), []).append(part)
        home, frames = self._home(name), []
        for (index, without, masked, ids_of), members in groups.items():
            written = T.StructType.fromJson(version.schemas[index])
            reader = self.spark.read.schema(T.StructType([*written.fields, *technical])).option("basePath", f"{home}/data")
            frame = reader.parquet(*(f"{home}/data/{p['path']}" for p in members))
            if ids_of:
                frame = frame.withColumn(ROW_ID, child_id(ids_of))
            columns = [quoted(c) for c in frame.columns]
            if without:
                frame = frame.where(~masks.file_of_row().isin([f for p in members for f in p["without"]]))
            if masked or place:
                frame = masks.located(frame)
            if masked:
                frame = masks.unmasked(frame, masks.read_masks(self.spark, home, (p["mask"] for p in members)))
            frames.append((frame if place or not masked else frame.select(*columns), written))
        return frames

    def sql(self, query: str, args: Any = None) -> DataFrame:
        """Run a query over the tables, by bare or ``schema.table`` name in any case and spelling.

        Names are those Spark's parser finds, so comments, text and names of CTEs are told apart.

        Values go in through ``args``; nothing is spliced into the text. The query runs in a
        session of its own with the caller's settings, which holds views of this dataset's
        tables and no others: views of the caller, or of another dataset, are neither seen
        nor replaced.
        """
        session = self.spark.newSession()
        for name, value in self.spark.conf.getAll.items():
            if session.conf.isModifiable(name):
                session.conf.set(name, value)
        own = Dataset(session, self.root, self.schema)
        tables = set(self.table_names())
        names = names_in(session, query)
        for name in tables.intersection(n.parts[-1].lower() for n in names if n.kind == "UnresolvedRelation"):
            own.table(name).createOrReplaceTempView(name)
        try:
            return session.sql(unqualified(query, names, self.schema, tables), args=args)
        except AnalysisException as error:
            if error.getCondition() == "TABLE_OR_VIEW_NOT_FOUND":
                raise UndefinedTableError(str(error).split("\n")[0]) from error
            raise

    def row_counts(self, names: Iterable[str] | None = None) -> DataFrame:
        """(table, row_count) counted from the data."""
        names = self.table_names() if names is None else list(names)
        counts = [self.table(n).agg(F.lit(n).alias("table"), F.count(F.lit(1)).alias("row_count")) for n in names]
        return reduce(DataFrame.unionByName, counts)

    # -- writing -----------------------------------------------------------------

    def write_parts(
        self,
        table: str,
        version: TableVersion,
        df: DataFrame,
        dead: str | None = None,
        measured: Sequence[str] = (),
        ids_of: str | None = None,
    ) -> Written:
        """Write rows as a new part, counting them and their range in ``measured`` columns.

        Rows where the boolean column ``dead`` is true go to a directory of their own
        that is never listed: it only serves later steps of the same load. With ``ids_of``, the row
        ids are those of that child table's rows (``child_id``): they are digests of other columns, which do
        not compress, so reads make them again instead of storing them.
        """
        df = conform(df, T.StructType([*version.schema.fields, *(df.schema[c] for c in [dead] if c)]))
        name = f"{version.number + 1}-{uuid.uuid4().hex}"
        live, gone = name, f"{name}-dead"
        home = f"{self._home(table)}/data"
        counted = Observation()
        is_live = ~quoted(dead) if dead else F.lit(True)
        leading = []
        if dead:
            df = df.withColumn(PART, F.when(quoted(dead), F.lit(gone)).otherwise(F.lit(live)))
            leading = [PART]
        placed, columns = apply_layout(df, version.partitions, version.sorts, leading)
        ranged = [c for c in (measured or version.key or ()) if c in df.columns and isinstance(df.schema[c].dataType, _RANGED)]
        ends = [f(quoted(c)).alias(f"{f.__name__}_{c}") for c in ranged for f in (F.min, F.max)]
        ends += [F.count_if(quoted(c).isNull()).alias(f"null_{c}") for c in ranged]
        sums = content.sums_of(version.schema, is_live)
        placed = placed.observe(counted, F.count_if(is_live).alias("rows"), *ends, *sums)
        if dead:
            placed = placed.drop(dead)
        if dead or version.sorts or version.partitions:
            ids_of = None
        if ids_of:
            placed = placed.drop(ROW_ID)
        if version.sorts:
            # above the row counter and below the write, so the order reaches the files
            placed = order_rows(placed, columns, version.sorts)
        writer = placed.write.partitionBy(*columns) if columns else placed.write
        for c in version.key or ():
            # so that a merge of scattered keys skips the row groups that hold none; not in directories of a
            # layout, where a task writes very many files and each would keep a filter's memory
            if c in ranged and not version.partitions:
                writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true").option(f"parquet.bloom.filter.adaptive.enabled#{c}", "true")
        if dead:
            writer.mode("append").parquet(home)
        else:
            writer.mode("errorifexists").parquet(f"{home}/{PART}={live}")
        seen = counted.get
        rows = int(seen.get("rows") or 0)
        bounds = {c: (seen.get(f"min_{c}"), seen.get(f"max_{c}")) for c in ranged}
        parts = self._leaves(home, live, version)
        digest = content.digest(seen)
        spans = self._file_spans(table, version, parts)
        ranges = {c: b for c, b in bounds.items() if b[0] is not None and not seen.get(f"null_{c}") and max(len(str(x)) for x in b) < 200}
        for part in parts:
            part |= {"content": digest, "leaves": len(parts)} | ({"ids_of": ids_of} if ids_of else {}) | ({"spans": spans} if spans else {})
            part |= ({} if version.partitions else {"rows": rows}) | ({"range": {c: list(b) for c, b in ranges.items()}} if ranges else {})
        return Written(parts, rows, self._leaves(home, gone, version) if dead else [], bounds)

    def _file_spans(self, table: str, version: TableVersion, parts: Sequence[dict]) -> str | None:
        """Write the range of the first sort key in every new file as a table; its name, if the key has ranges."""
        if not parts or not version.sorts or not isinstance(version.schema[version.sorts[0].column].dataType, _SPANNED):
            return None
        column, name = version.sorts[0].column, fs.unique(str(version.number + 1))
        value = quoted(column)
        frame = self._frames(table, version, [{k: p[k] for k in ("path", "schema")} for p in parts])[0][0]
        spans = frame.groupBy(masks.file_of_row().alias("file")).agg(F.min(value).alias("low"), F.max(value).alias("high"))
        spans.coalesce(1).write.parquet(f"{self._home(table)}/spans/{name}")
        return name

    def _outside(self, table: str, version: TableVersion, column: str, low: Any, high: Any) -> list[dict]:
        """The version's parts, each without the files whose range of the first sort key says that they hold no such row."""
        if not version.sorts or version.sorts[0].column != column:
            return version.parts
        kinds: dict[int, set[str]] = {}
        for p in version.parts:
            if "spans" in p:
                kinds.setdefault(p["schema"], set()).add(p["spans"])
        apart: dict[str, list[str]] = {}
        for index, names in kinds.items():
            dtype = T.StructType.fromJson(version.schemas[index])[column].dataType
            shape = T.StructType().add("file", "string").add("low", dtype).add("high", dtype)
            spans = self.spark.read.schema(shape).parquet(*(f"{self._home(table)}/spans/{n}" for n in sorted(names)))
            # a file of nulls alone has no range, and no row between two values
            near = F.coalesce((F.col("high") >= F.lit(low)) & (F.col("low") <= F.lit(high)), F.lit(False))
            for r in spans.where(~near).select(masks.folder_of(F.col("file")).alias("folder"), "file").collect():
                apart.setdefault(masks.part_path(r["folder"]), []).append(r["file"])
        return [{**p, "without": [*p.get("without", ()), *apart[p["path"]]]} if p["path"] in apart else p for p in version.parts]

    def content_of(self, table: str, version: TableVersion) -> list[int]:
        """The content sums of all rows: those kept by the version, and of parts whose sums no longer hold, read anew.

        They no longer hold where rows are masked, files or directories of one write left out, or a type has widened since.
        """
        writes: dict[str, list[dict]] = {}
        for p in version.parts:
            writes.setdefault(p["path"].split("/")[0], []).append(p)
        total, read = [0, 0], []
        for some in writes.values():
            whole = "content" in some[0] and len(some) == some[0]["leaves"] and not any("mask" in p or "without" in p for p in some)
            if whole and content.comparable(T.StructType.fromJson(version.schemas[some[0]["schema"]]), version.schema):
                total = content.added(total, some[0]["content"])
            else:
                read += some
        if read:
            rows = self.table(table, version=replace(version, parts=read))
            found = rows.agg(*content.sums_of(version.schema)).first()
            total = content.added(total, content.digest(found.asDict()))
        return total

    def _leaves(self, home: str, part: str, version: TableVersion) -> list[dict]:
        """Entries of the directories that hold files: one per partition value, or just the part."""
        found = [f"{PART}={part}"] if fs.exists(self.spark, f"{home}/{PART}={part}") else []
        for _ in version.partitions:
            found = [f"{p}/{n}" for p in found for n in fs.children(self.spark, f"{home}/{p}") if "=" in n]
        entries = [{"path": p, "schema": len(version.schemas) - 1} for p in found]
        if not version.partitions:  # else there may be thousands, which compact measures when it needs to
            entries = [self._measured(home, e) for e in entries]
        return entries

    def _measured(self, home: str, entry: dict) -> dict:
        """The entry of a part with the number of its files and their bytes."""
        if "files" in entry:
            return entry
        files, size = fs.size_of(self.spark, f"{home}/{entry['path']}")
        return {**entry, "files": files, "bytes": size}

    def discard(self, table: str, entries: Sequence[dict]) -> None:
        """Remove directories that no version lists."""
        for top in {e["path"].split("/")[0] for e in entries}:
            fs.delete(self.spark, f"{self._home(table)}/data/{top}")

    def without_keys(
        self, table: str, version: TableVersion, keys: DataFrame, key: Sequence[str], bounds: Mapping[str, tuple]
    ) -> tuple[list[dict], int]:
        """(parts, rows removed) of the table without the listed keys, by masks: no data file is written or dropped.

        Parts whose range of keys lies elsewhere are not opened; in the others, row groups are
        skipped by range, and by bloom filter if the keys are few. Rows are found on key columns
        alone. A part that loses its last row is no longer listed.
        """
        listed, bounds = self._sought(keys, key, bounds)
        near = [p for p in version.parts if _may_hold(p, bounds)]
        hits = self._matched_rows(table, replace(version, parts=near), keys, key, bounds, listed)
        home, name = self._home(table), fs.unique(str(version.number + 1))
        masks.write_mask(masks.mask_of(hits), f"{home}/masks/{name}")
        found = masks.read_masks(self.spark, home, [name])
        gone = masks.rows_by_part(found)
        touched = {masks.part_path(f): n for f, n in gone.items()}
        if not touched:
            fs.delete(self.spark, f"{home}/masks/{name}")
            return version.parts, 0
        before = [p for p in version.parts if p["path"] in touched and "mask" in p]
        if before:
            folders = local_frame(self.spark, [(f,) for f in gone], "folder string")
            old = masks.read_masks(self.spark, home, (p["mask"] for p in before))
            old = old.join(folders, masks.folder_of(F.col("mask_file")) == F.col("folder"), "left_semi")
            first, name = name, fs.unique(str(version.number + 1))
            masks.write_mask(masks.both(old, found), f"{home}/masks/{name}")
            fs.delete(self.spark, f"{home}/masks/{first}")
        known = self._part_rows(table, version, [p for p in version.parts if p["path"] in touched])
        parts = []
        for part in version.parts:
            if part["path"] in touched:
                masked = part.get("masked", 0) + touched[part["path"]]
                if masked == known[part["path"]]:
                    continue
                part = {**part, "rows": known[part["path"]], "mask": name, "masked": masked}
            parts.append(part)
        return parts, sum(touched.values())

    def _sought(self, keys: DataFrame, key: Sequence[str], bounds: Mapping[str, tuple]) -> tuple[dict[str, list], dict[str, tuple]]:
        """Values to look for per key column, if there are few keys, and the range of each column."""
        ranged = [k for k in key if isinstance(keys.schema[k].dataType, _RANGED)]
        if not ranged:
            return {}, dict(bounds)
        few = keys.select(*(quoted(k) for k in ranged)).distinct().limit(_LISTED + 1).collect()
        if len(few) <= _LISTED:
            values = {k: sorted({r[i] for r in few} - {None}) for i, k in enumerate(ranged)}
            return values, dict(bounds) | {k: (v[0], v[-1]) for k, v in values.items() if v}
        missing = [k for k in ranged if k not in bounds]
        if not missing:
            return {}, dict(bounds)
        ends = keys.agg(*(f(quoted(k)) for k in missing for f in (F.min, F.max))).first()
        return {}, {k: (ends[2 * i], ends[2 * i + 1]) for i, k in enumerate(missing)} | dict(bounds)

    def near(self, table: str, version: TableVersion, keys: DataFrame, key: Sequence[str]) -> DataFrame:
        """The table, but for rows whose key cannot be among ``keys``, if these are few: those are not read."""
        keys = conform(keys.select(*(quoted(k) for k in key)), T.StructType([version.schema[k] for k in key]))
        listed, bounds = self._sought(keys, key, {k: (None, None) for k in key})
        if not listed:
            return self.table(table, version=version)
        frames = []
        for parts, some in _by_nulls([p for p in version.parts if _may_hold(p, bounds)], listed):
            rows = self.table(table, version=replace(version, parts=parts))
            frames.append(rows.where(_sought_in(some, {}, list(listed), version.schema.names)))
        return reduce(DataFrame.unionByName, frames) if frames else self.table(table, version=replace(version, parts=[]))

    def _matched_rows(
        self, table: str, version: TableVersion, keys: DataFrame, key: Sequence[str], bounds: Mapping[str, tuple], listed: Mapping[str, list] = {}
    ) -> DataFrame:
        """The place (file, number) of every table row whose key is listed."""
        frames = []
        for parts, some in _by_nulls(version.parts, listed):
            for frame, written in self._frames(table, version, parts, place=True):
                frame = frame.where(_sought_in(some, bounds, list(listed), written.names))
                columns = [(quoted(k) if k in written.names else F.lit(None)).cast(version.schema[k].dataType).alias(k) for k in key]
                frames.append(frame.select(*columns, masks.FILE, masks.ROW))
        if not frames:
            return empty_frame(self.spark, T.StructType().add(masks.FILE, "string").add(masks.ROW, "long"))
        keyed = guard_keys(reduce(DataFrame.unionByName, frames), key, "existing")
        return keyed.join(keys.select(*(quoted(k) for k in key)), list(key), "left_semi").select(masks.FILE, masks.ROW)

    def _part_rows(self, table: str, version: TableVersion, parts: Sequence[dict]) -> dict[str, int]:
        """path -> all its rows, masked ones too; from the footers of its files where no version says it."""
        known = {p["path"]: p["rows"] for p in parts if "rows" in p}
        unknown = [{k: v for k, v in p.items() if k not in ("mask", "masked")} for p in parts if "rows" not in p]
        if not unknown:
            return known
        frames = [f.select(masks.folder_of(masks.file_of_row()).alias("folder")) for f, _ in self._frames(table, version, unknown)]
        counts = reduce(DataFrame.unionByName, frames).groupBy("folder").agg(F.count(F.lit(1)).alias("n")).collect()
        return known | {masks.part_path(r["folder"]): r["n"] for r in counts}

    def compact(self, table: str, target_bytes: int = 128 << 20, masked_share: float = 0.2) -> TableVersion:
        """Pack small files, and files with many masked rows, into new ones of about ``target_bytes``.

        Per directory of the layout, parts whose files are under half that size on average are
        packed together, if that makes fewer files; so are parts with over ``masked_share`` of
        their rows masked. Other parts stay as they are. What is appended meanwhile survives.
        """
        version = self.version(table)
        home = f"{self._home(table)}/data"
        chosen = {p["path"] for p in _to_pack([self._measured(home, p) for p in version.parts], target_bytes, masked_share)}
        rewrite = [p for p in version.parts if p["path"] in chosen]
        if not rewrite:
            return version
        # whatever else is in the directories of the layout, each task packs rows of some of them
        rows = self.scan(table, version, rewrite).select(*(quoted(c) for c in version.schema.names))
        ids_of = rewrite[0].get("ids_of") if len({p.get("ids_of") for p in rewrite}) == 1 else None
        size = self.spark.conf.get(_ADVISORY)
        self.spark.conf.set(_ADVISORY, str(target_bytes))
        try:
            written = self.write_parts(table, version, rows if version.partitions else rows.hint("rebalance"), ids_of=ids_of)
        finally:
            self.spark.conf.set(_ADVISORY, size)
        old = {p["path"]: p for p in rewrite}

        def onto(current: TableVersion) -> TableVersion | None:
            unchanged = [p for p in current.parts if old.get(p["path"]) == p]
            if len(unchanged) < len(old) or current.schemas[: len(version.schemas)] != version.schemas:
                return None
            return replace(current, parts=[*(p for p in current.parts if p["path"] not in old), *written.parts])

        return self._publish_onto(table, version, onto)

    def append_rows(self, table: str, df: DataFrame) -> TableVersion:
        """Append to a bookkeeping table, creating it. Nothing stored is written again;
        ``compact`` puts small parts together when the owner asks for it."""
        version = self.version(table) or TableVersion(schemas=[json.loads(SCHEMAS[table].json())])
        written = self.write_parts(table, version, df)
        return self.publish_append(table, version, written.parts, written.rows)

    def bookkeeping(self, table: str) -> DataFrame:
        """A bookkeeping table; one that was never loaded reads as empty.

        Whether it was is looked up, not guessed from an error: a failing read always raises.
        """
        version = self.version(table)
        if version is None or not version.loaded:
            return empty_frame(self.spark, SCHEMAS[table])
        return self.table(table, version=version)



def _any_of(tests: list[Column]) -> Column:
    """Whether one of them holds, as a flat tree; Parquet is asked for each, so bloom filters count."""
    while len(tests) > 1:
        tests = [a | b for a, b in zip(tests[::2], tests[1::2])] + tests[len(tests) // 2 * 2 :]
    return tests[0]


def _by_nulls(parts: Sequence[dict], listed: Mapping[str, list]) -> list[tuple[list[dict], dict[str, tuple[list, bool]]]]:
    """Parts known to hold no null in the listed columns, and the others; with what to look for, and whether nulls may be there.

    A null stays in a scan, to be refused by whoever reads the key. But asked for nulls as well,
    Parquet's bloom filters say nothing, so that is left out wherever a version tells there are none.
    """
    sure, rest = [], []
    for p in parts:
        (sure if listed.keys() <= p.get("range", {}).keys() else rest).append(p)
    return [(some, {c: (v, maybe) for c, v in listed.items()}) for some, maybe in ((sure, False), (rest, True)) if some]


def _sought_in(listed: Mapping[str, tuple[list, bool]], bounds: Mapping[str, tuple], order: list[str], stored: Sequence[str]) -> Column:
    """What the scan of stored columns is asked for: listed values, and ranges of the columns that have no list."""
    test = F.lit(True)
    for c in order:
        values, maybe = listed[c]
        if values and c in stored:
            one = _any_of([quoted(c) == F.lit(v) for v in values])
            test &= (one | quoted(c).isNull()) if maybe else one
    for c, (low, high) in bounds.items():
        if low is not None and c in stored:
            test &= quoted(c).between(F.lit(low), F.lit(high)) | quoted(c).isNull()
    return test


def _may_hold(part: dict, bounds: Mapping[str, tuple]) -> bool:
    """Whether the part's range of some key column rules the sought range out."""
    for column, (low, high) in bounds.items():
        lowest, highest = part.get("range", {}).get(column, (None, None))
        if low is not None and isinstance(lowest, type(low)) and (highest < low or high < lowest):
            return False
    return True


def _to_pack(parts: Sequence[dict], target_bytes: int, masked_share: float) -> list[dict]:
    """Parts to write anew: heavily masked ones, and small ones where several files become fewer."""
    small: dict[str, list[dict]] = {}
    chosen = []
    for part in parts:
        files, size = part.get("files", 1), part.get("bytes", 0)
        if part.get("masked", 0) > masked_share * part.get("rows", 0) or "without" in part:
            chosen.append(part)
        elif files and size / files < target_bytes / 2:
            small.setdefault(part["path"].partition("/")[2], []).append(part)
    for group in small.values():
        files, size = (sum(p.get(x, 0) for p in group) for x in ("files", "bytes"))
        if files > -(-size // target_bytes):
            chosen += group
    return chosen
