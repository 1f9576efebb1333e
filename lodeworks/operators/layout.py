"""Storage layout: partition transforms and sort keys, declared once per table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass, fields, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeworks.errors import LayoutError
from lodeworks.functions.keys import quoted

# The vocabulary of a layout.
TRANSFORMS = ("identity", "year", "month", "day", "hour")
DIRECTIONS = ("asc", "desc")
NULLS = ("first", "last")

_MARK = "__range_mark"
# A derived partition value is text whose order is the order of time.
_TIME_FORMAT = {"year": "yyyy", "month": "yyyy-MM", "day": "yyyy-MM-dd", "hour": "yyyy-MM-dd-HH"}


def _word(kind: object, field_name: str, allowed: Sequence[str], unset: str | None) -> None:
    """Bring one attribute of a key to lower case and hold it to its vocabulary."""
    given = getattr(kind, field_name)
    word = str(given).lower() if given else unset
    if word is not None and word not in allowed:
        raise LayoutError(f"{field_name} of {kind.column!r} is {given!r}; known are {', '.join(allowed)}")
    object.__setattr__(kind, field_name, word)


@dataclass(frozen=True)
class PartitionKey:
    """A column, or the year, month, day or hour of it, that names directories."""

    column: str
    transform: str | None = "identity"

    def __post_init__(self) -> None:
        _word(self, "transform", TRANSFORMS, "identity")

    @property
    def derived(self) -> str:
        """Name of the directory column; never part of the table's own schema."""
        return f"__p_{self.column}_{self.transform}"


@dataclass(frozen=True)
class SortKey:
    """A column that orders the rows inside files; what is unset is up to the writer."""

    column: str
    direction: str | None = None
    nulls: str | None = None

    def __post_init__(self) -> None:
        _word(self, "direction", DIRECTIONS, None)
        _word(self, "nulls", NULLS, None)

    def satisfied_by(self, stored: SortKey) -> bool:
        wishes = asdict(self).items()
        return all(wish is None or wish == getattr(stored, name) for name, wish in wishes)


# How many values a tuple may hold.
_FORMS = {PartitionKey: (2, 2), SortKey: (1, 3)}


def read_key(kind: type, entry: Any) -> Any:
    """A key of one kind from any of its written forms.

    That is a bare column name, a mapping by attribute name, a tuple in attribute order (a
    whole pair for partitions), or a key already made.
    """
    if isinstance(entry, kind):
        return entry
    names = [f.name for f in fields(kind)]
    least, most = _FORMS[kind]
    if isinstance(entry, str):
        values = {"column": entry}
    elif isinstance(entry, Mapping):
        values = {n: entry[n] for n in names if n in entry}
    elif isinstance(entry, (tuple, list)) and least <= len(entry) <= most:
        values = dict(zip(names, entry))
    else:
        values = {}
    if not values.get("column"):
        raise LayoutError(f"{entry!r} does not describe a {kind.__name__}: its attributes are {', '.join(names)}")
    return kind(**{**values, "column": str(values["column"])})


@dataclass(frozen=True)
class Layout:
    """How a table's files are cut into directories and ordered, as one value."""

    partitions: tuple[PartitionKey, ...] = ()
    sorts: tuple[SortKey, ...] = ()

    @classmethod
    def read(cls, partition_by: Iterable[Any] | None = None, sorted_by: Iterable[Any] | None = None) -> Layout:
        return cls(
            tuple(read_key(PartitionKey, e) for e in partition_by or ()),
            tuple(read_key(SortKey, e) for e in sorted_by or ()),
        )

    def __bool__(self) -> bool:
        return bool(self.partitions or self.sorts)

    def lacks(self, columns: Iterable[str]) -> list[str]:
        """Columns it names that are not among these, in alphabetical order."""
        return sorted({k.column for k in self.partitions + self.sorts}.difference(columns))

    def satisfied_by(self, stored: Layout) -> bool:
        """Whether a table laid out as ``stored`` is what this asks for: order counts, wishes left unset do not."""
        same_shape = self.partitions == stored.partitions and len(self.sorts) == len(stored.sorts)
        return same_shape and all(map(SortKey.satisfied_by, self.sorts, stored.sorts))


def with_layout(spec, partition_by: Iterable[Any] | None = None, sorted_by: Iterable[Any] | None = None):
    """``spec`` with an explicit layout, read here once and kept as plain dicts, in order."""
    given = {"partition_by": partition_by, "sorted_by": sorted_by}
    given = {name: list(entries) for name, entries in given.items() if entries is not None}
    for name, entries in given.items():
        if not entries:
            raise LayoutError(f"{name} holds no key; omit it to leave the layout open")
    layout = Layout.read(**given)
    plain = {"partition_by": layout.partitions, "sorted_by": layout.sorts}
    return replace(spec, **{name: tuple(asdict(k) for k in plain[name]) for name in given})


def _utc(instant: Column) -> Column:
    """Its UTC wall clock: an instant belongs to its UTC day, whatever zone a session is in."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)


def partition_value(key: PartitionKey, dtype: T.DataType, value: Column | None = None) -> Column:
    """The directory value of one partition key."""
    value = quoted(key.column) if value is None else value
    if key.transform == "identity":
        # an instant as text by UTC, like the transforms below
        return _utc(value).cast("string") if isinstance(dtype, T.TimestampType) else value.cast("string")
    if not isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise LayoutError(
            f"partition transform {key.transform!r} needs a date or timestamp, "
            f"column {key.column!r} is {dtype.simpleString()}"
        )
    if isinstance(dtype, T.TimestampType):
        value = _utc(value)
    return F.date_format(value, _TIME_FORMAT[key.transform])


def sort_expression(key: SortKey) -> Column:
    """Unset direction is ascending; unset null placement is last for asc, first for desc."""
    direction = key.direction or "asc"
    nulls = key.nulls or ("last" if direction == "asc" else "first")
    return getattr(quoted(key.column), f"{direction}_nulls_{nulls}")()


def apply_layout(
    df: DataFrame,
    partition_by: Sequence[PartitionKey] = (),
    sorted_by: Sequence[SortKey] = (),
    leading: Sequence[str] = (),
) -> tuple[DataFrame, list[str]]:
    """(frame to write, its partition columns), with the rows of each directory brought together.

    Without sort keys that is a REBALANCE, which adaptive execution sizes by measured bytes:
    many small directories share a task and one huge directory is split over many. With sort
    keys, tasks are ranges of directory and sort key, cut by a sample, so files of a directory
    do not overlap. A mark of each row comes last in the range: a key value with very many
    rows is cut into several files that hold nothing else.
    """
    derived = {k.derived: partition_value(k, df.schema[k.column].dataType) for k in partition_by}
    columns = [*leading, *derived]
    if derived:
        df = df.withColumns(derived)
    if sorted_by:
        order = [*columns, *(sort_expression(k) for k in sorted_by)]
        df = df.withColumn(_MARK, F.xxhash64(F.spark_partition_id(), F.monotonically_increasing_id()))
        df = df.repartitionByRange(*order, _MARK).drop(_MARK)
    elif derived:
        df = df.hint("rebalance", *derived)
    return df, columns


def order_rows(df: DataFrame, columns: Sequence[str], sorted_by: Sequence[SortKey]) -> DataFrame:
    """The rows of each task in the order of its files: directories first."""
    return df.sortWithinPartitions(*columns, *(sort_expression(k) for k in sorted_by))
