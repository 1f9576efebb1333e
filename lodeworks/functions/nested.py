"""Nested columns to relational form: flattened structs and child tables.

Both are narrow, per-row projections (``posexplode`` for the children), so nothing is
shuffled however large the parent is.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeworks.errors import LoadError
from lodeworks.functions.keys import quoted
from lodeworks.functions.names import MAX_IDENTIFIER, normalize_identifier
from lodeworks.operators.identity import LOAD_ID, ROW_ID

# Names the relational form of nested data is known by.
SEPARATOR = "__"
PARENT_ID = "_dlt_parent_id"
ROOT_ID = "_dlt_root_id"
LIST_INDEX = "_dlt_list_idx"
MAX_NESTING = 1000


def _is_nested(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StructType, T.ArrayType, T.MapType))


def _leaves(value: Column, dtype: T.DataType, name: str, depth: int) -> list[tuple[str, Column, T.DataType, int]]:
    """(name, expression, type, levels left) of every column one value becomes."""
    if not _is_nested(dtype):
        return [(name, value, dtype, depth)]
    if depth <= 0:
        return [(name, F.to_json(value), T.StringType(), 0)]
    if isinstance(dtype, T.StructType):
        out = []
        for f in dtype.fields:
            out += _leaves(value.getField(f.name), f.dataType, f"{name}{SEPARATOR}{normalize_identifier(f.name)}", depth - 1)
        return out
    return [(name, value, dtype, depth)]


def flatten_struct(df: DataFrame, max_nesting: int = MAX_NESTING) -> DataFrame:
    """Struct fields as ``parent__field`` columns; below ``max_nesting`` levels, JSON text."""
    leaves = [leaf for f in df.schema.fields for leaf in _leaves(quoted(f.name), f.dataType, f.name, max_nesting)]
    refuse_clashes(name for name, *_ in leaves)
    return df.select(*(value.alias(name) for name, value, *_ in leaves))


def refuse_clashes(names: Iterable[str]) -> None:
    """Refuse columns that different fields would give the same name."""
    seen: set[str] = set()
    for name in names:
        if name in seen:
            raise LoadError(f"two nested fields both become column {name!r}")
        if len(name) > MAX_IDENTIFIER:
            raise LoadError(f"nested field {name[:40]!r}... has a name of over {MAX_IDENTIFIER} characters")
        seen.add(name)


def child_tables(df: DataFrame, table: str, max_nesting: int = MAX_NESTING, root_ids: bool = False) -> dict[str, DataFrame]:
    """``table`` and every child its array and map columns give, by composed name.

    A map is a list of (key, value), in the order it is stored in.
    The parent needs a ``_dlt_id`` column. A child row carries the id of its parent row,
    its position in the list, its own id (a digest of both, so a re-run gives the same)
    and, if the parent has one, the load id; with ``root_ids`` also the id of the row of
    ``table`` it descends from.
    """
    out: dict[str, DataFrame] = {}
    carried = [LOAD_ID] if LOAD_ID in df.columns else []
    if root_ids:
        df = df.withColumn(ROOT_ID, quoted(ROW_ID))
        carried.append(ROOT_ID)
    _collect(df, table, {f.name: max_nesting for f in df.schema.fields}, carried, out)
    out[table] = out[table].drop(ROOT_ID)
    return out


def child_id(table: str) -> Column:
    """The id of a row of a child table: a digest of its parent's id, the table's name and its place in the list."""
    return F.sha2(F.concat_ws("_", PARENT_ID, F.lit(table), LIST_INDEX), 256)


def _collect(df: DataFrame, table: str, depths: dict[str, int], carry: list[str], out: dict[str, DataFrame]) -> None:
    kept, out_names, lists = [], [], []
    for f in df.schema.fields:
        for name, value, dtype, depth in _leaves(quoted(f.name), f.dataType, f.name, depths[f.name]):
            if isinstance(dtype, T.MapType):
                pair = T.StructType().add("key", dtype.keyType).add("value", dtype.valueType)
                value, dtype = F.map_entries(value), T.ArrayType(pair)
            if isinstance(dtype, T.ArrayType):
                lists.append((name, value, dtype, depth))
            else:
                kept.append(value.alias(name))
                out_names.append(name)
    refuse_clashes([*out_names, *(name for name, *_ in lists)])
    out[table] = df.select(*kept)
    for name, value, dtype, depth in lists:
        child = f"{table}{SEPARATOR}{name}"
        rows = df.select(quoted(ROW_ID).alias(PARENT_ID), *(quoted(c) for c in carry), F.posexplode(value).alias(LIST_INDEX, "__item"))
        item, element = F.col("__item"), dtype.elementType
        if isinstance(element, T.StructType):
            fields = [(normalize_identifier(f.name), item.getField(f.name)) for f in element.fields]
        elif isinstance(element, T.ArrayType):
            fields = [("list", item)]
        else:
            fields = [("value", item)]
        system = [c for c in rows.columns if c != "__item"]
        rows = rows.select(*(v.alias(n) for n, v in fields), *system, child_id(child).alias(ROW_ID))
        levels = {**{n: depth - 1 for n, _ in fields}, **dict.fromkeys([*system, ROW_ID], 0)}
        _collect(rows, child, levels, carry, out)
