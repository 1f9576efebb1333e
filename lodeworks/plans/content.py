"""What rows hold, as two sums that do not depend on their order.

Each row has two 64-bit hashes; a frame's content is the sums of both modulo 2^64. Sums add up
over parts, are taken in the job that writes, and tell a copy with the right number of rows and
one wrong value. Columns that are null count for nothing, so a column that a table gains later
leaves the sums as they were.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from zlib import crc32

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeworks.functions.keys import quoted

_NAMES = ("__content_a", "__content_b")
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NESTED = (T.StructType, T.ArrayType, T.MapType)


def _unhashed(dtype: T.DataType) -> bool:
    """Whether it has a map or a variant inside, which Spark does not hash."""
    if isinstance(dtype, T.StructType):
        return any(_unhashed(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _unhashed(dtype.elementType)
    return isinstance(dtype, (T.MapType, T.VariantType))


def _hashed(name: str, value: Column, dtype: T.DataType) -> list[Column]:
    """What of one cell goes into its row's hash, which passes over nulls: its column, and the value in a form that a wider number shares."""
    here = F.when(value.isNotNull(), F.lit(crc32(name.encode())))
    if isinstance(dtype, _WHOLE):
        return [here, value.cast("long")]
    if isinstance(dtype, T.FloatType):
        return [here, value.cast("double")]
    if not isinstance(dtype, (*_NESTED, T.VariantType)):
        return [here, value]
    # as JSON, where empty lists and nulls inside count; maps and variants have no other hash
    shape = F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"})
    return [F.when(value.isNotNull(), shape), *([] if _unhashed(dtype) else [value]), here]


def sums(columns: Sequence[tuple[str, Column, T.DataType]], where: Column | None = None) -> list[Column]:
    """Two aggregates over the rows (those where a condition holds) of columns, given by name, value and type.

    Instants inside maps, or beside maps in one nested value, count by the millisecond.
    """
    cells = [c for column in columns for c in _hashed(*column)]
    rows = [F.xxhash64(F.lit(seed), *cells).cast("decimal(38,0)") for seed in range(len(_NAMES))]
    return [F.sum(r if where is None else F.when(where, r)).alias(n) for n, r in zip(_NAMES, rows)]


def sums_of(schema: T.StructType, where: Column | None = None) -> list[Column]:
    return sums([(f.name, quoted(f.name), f.dataType) for f in schema.fields], where)


def digest(found: Mapping[str, object]) -> list[int]:
    """The sums of an observation or an aggregate, as they are kept."""
    return [int(found.get(n) or 0) % 2**64 for n in _NAMES]


def added(one: Sequence[int], other: Sequence[int]) -> list[int]:
    return [(a + b) % 2**64 for a, b in zip(one, other)]


def _kind(dtype: T.DataType) -> str:
    if isinstance(dtype, _WHOLE):
        return "bigint"
    return "double" if isinstance(dtype, T.FloatType) else dtype.simpleString()


def comparable(written: T.StructType, current: T.StructType) -> bool:
    """Whether rows written in one schema have the same sums when they are read in the other."""
    order = [c for c in current.names if c in written.names]
    return order == written.names and all(_kind(f.dataType) == _kind(current[f.name].dataType) for f in written.fields)
