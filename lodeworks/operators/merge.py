"""Load dispositions as pure DataFrame functions: (existing, incoming, key) -> new table.

A package of many files is folded in one pass instead of one read-modify-write per
file. Three rules keep every plan safe when one key holds a large share of the rows:

* the last row per key is an aggregate (``max_by``), so each task reduces its own rows
  before the shuffle and a hot key arrives as one row per task;
* the first file per key is found on key columns only, again by an aggregate, and the
  full rows then meet it in a semi-join whose build side has one row per key, which
  adaptive execution may split freely;
* existing rows are only ever the streamed side of an anti- or semi-join.

No side is broadcast by hint: Spark does so when the measured size allows it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeworks.errors import LoadError
from lodeworks.functions.keys import guard_keys, hard_delete_mask, quoted, split_hard_delete
from lodeworks.functions.schema import conform, merge_schemas
from lodeworks.operators.identity import ROW_ID

# Position of a row in its package; dropped once the package is folded.
FILE_SEQ = "__file_seq"
ROW_SEQ = "__row_seq"
# Set by last_per_key: the key ends deleted.
DELETED = "__deleted"

DUPLICATE_KEY = "merge key repeats in a batch"


def _data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in (FILE_SEQ, ROW_SEQ, DELETED)]


def _without_position(df: DataFrame) -> DataFrame:
    return df.drop(FILE_SEQ, ROW_SEQ)


def _both_sides(existing: DataFrame, incoming: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames in the merged schema; the incoming one keeps its position columns."""
    schema = merge_schemas(existing.schema, _without_position(incoming).schema)
    position = [f for f in incoming.schema.fields if f.name in (FILE_SEQ, ROW_SEQ)]
    return conform(existing, schema), conform(incoming, T.StructType([*schema.fields, *position]))


def _positions(df: DataFrame, order: Sequence[str] | None, file_order: str | None) -> tuple[list[str], str | None]:
    if file_order is None and FILE_SEQ in df.columns:
        file_order = FILE_SEQ
    if not order and ROW_SEQ in df.columns:
        order = [ROW_SEQ]
    return [c for c in (order or ()) if c != file_order], file_order


def append(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """All rows of both; columns by name, absent ones null, types widened."""
    old, new = _both_sides(existing, _without_position(incoming))
    return old.unionByName(new)


def last_per_key(
    incoming: DataFrame,
    key: Sequence[str],
    *,
    order: Sequence[str] | None = None,
    file_order: str | None = None,
    hard_delete: str | None = None,
) -> DataFrame:
    """The row each key ends with after its files are applied in order, plus ``__deleted``.

    Files go first, then (inside a file) a flagged row beats any live one, then row
    order: a key with a flagged row in its last file ends deleted, every other key ends
    with the last row of its last file. All three are one comparison, so one aggregate
    folds the whole package.
    """
    order, file_order = _positions(incoming, order, file_order)
    flagged: Column = F.lit(False)
    if hard_delete is not None and hard_delete in incoming.columns:
        flagged = hard_delete_mask(incoming, hard_delete)
    incoming = guard_keys(incoming, key)
    data = [c for c in _data_columns(incoming) if c not in key]
    row = F.struct(flagged.alias(DELETED), *(quoted(c) for c in data))
    rank = [quoted(c) for c in ([file_order] if file_order else [])] + [flagged] + [quoted(c) for c in order]
    keys = [quoted(k) for k in key]
    if order:
        # rows that share the winning place differ in a hash, one way up or the other
        alike = F.xxhash64(*(quoted(c) for c in data if not _has_map(incoming.schema[c].dataType)), flagged)
        places = [F.max(F.struct(*rank, h.alias("__hash"))).getField("__hash") for h in (alike, F.bitwise_not(alike))]
        winner = incoming.groupBy(*keys).agg(F.max_by(row, F.struct(*rank)).alias("__row"), places[0].alias("__top"), places[1].alias("__low"))
        clash = F.raise_error(F.lit(f"{DUPLICATE_KEY} whose row order ties: {', '.join(key)}")).cast("bigint")
        winner = winner.where(F.when(F.col("__top") != F.bitwise_not("__low"), clash).otherwise(F.lit(0)) == 0)
    else:
        # nothing ranks two rows of a key inside a file, so a second one is refused
        ranked = incoming.groupBy(*keys, *([quoted(file_order)] if file_order else [])).agg(
            F.first(row).alias("__row"), F.count(F.lit(1)).alias("__n")
        )
        clash = F.raise_error(F.lit(f"{DUPLICATE_KEY} that has no row order: {', '.join(key)}")).cast("bigint")
        ranked = ranked.where(F.when(F.col("__n") > 1, clash).otherwise(F.col("__n")) == 1)
        if file_order:
            winner = ranked.groupBy(*keys).agg(F.max_by("__row", quoted(file_order)).alias("__row"))
        else:
            winner = ranked
    columns = []
    for c in _data_columns(incoming):
        value = quoted(c) if c in key else F.col("__row").getField(c)
        columns.append(value.alias(c, metadata=incoming.schema[c].metadata or {}))
    return winner.select(*columns, F.col("__row").getField(DELETED).alias(DELETED))


def _has_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return any(_has_map(f.dataType) for f in dtype.fields)
    return isinstance(dtype, T.MapType) or (isinstance(dtype, T.ArrayType) and _has_map(dtype.elementType))


def keep_unmatched(existing: DataFrame, keys: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``existing`` whose key is not among ``keys``."""
    return existing.join(keys.select(*(quoted(k) for k in key)), list(key), "left_anti").select(*existing.columns)


def _distinct_keys(df: DataFrame, key: Sequence[str], side: str) -> DataFrame:
    return guard_keys(df, key, side).select(*(quoted(k) for k in key)).distinct()


def known_keys(existing: DataFrame, keys: DataFrame, key: Sequence[str]) -> DataFrame:
    """The distinct keys of ``existing`` that are among ``keys``.

    The batch filters the table, not the other way round: a batch small enough to be
    broadcast spares the table's keys a shuffle.
    """
    existing = guard_keys(existing, key, "existing").select(*(quoted(k) for k in key))
    return existing.join(_distinct_keys(keys, key, "incoming"), list(key), "left_semi").distinct()


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    key: Sequence[str] | None = None,
    *,
    order: Sequence[str] | None = None,
    file_order: str | None = None,
    hard_delete: str | None = None,
) -> DataFrame:
    """Replace whole rows on a key match, insert the others, drop the keys that end deleted.

    A column the batch lacks is null on every row it replaces. With no key the row
    identity is the key and flagged rows are dropped from the batch.
    """
    _check_flag(key, hard_delete)
    if not key:
        key = [ROW_ID]
        if hard_delete is not None and hard_delete in incoming.columns:
            incoming, hard_delete = split_hard_delete(incoming, hard_delete)[0], None
    old, new = _both_sides(existing, incoming)
    hard_delete = hard_delete if hard_delete in incoming.columns else None
    winners = last_per_key(new, key, order=order, file_order=file_order, hard_delete=hard_delete)
    # keys are read again on their own: a narrow scan, no wide rows through the shuffle
    kept = keep_unmatched(guard_keys(old, key, "existing"), _distinct_keys(new, key, "incoming"), key)
    return kept.unionByName(winners.where(~F.col(DELETED)).drop(DELETED))


def new_rows(
    existing: DataFrame,
    incoming: DataFrame,
    key: Sequence[str],
    *,
    file_order: str | None = None,
    hard_delete: str | None = None,
) -> DataFrame:
    """The rows an insert-only load adds.

    Unflagged rows whose key the table lacks, all of them, from the first file that
    brings the key. ``incoming`` must already be in the table's types.
    """
    _, file_order = _positions(incoming, None, file_order)
    if hard_delete is not None and hard_delete in incoming.columns:
        incoming = split_hard_delete(incoming, hard_delete)[0]
    incoming = guard_keys(incoming, key)
    known = known_keys(existing, incoming, key)
    if file_order is None:
        return keep_unmatched(incoming, known, key)
    first = incoming.groupBy(*(quoted(k) for k in key)).agg(F.min(quoted(file_order)).alias(file_order))
    first = keep_unmatched(first, known, key)
    return incoming.join(first, [*key, file_order], "left_semi").select(*incoming.columns)


def insert_only(
    existing: DataFrame,
    incoming: DataFrame,
    key: Sequence[str] | None = None,
    *,
    file_order: str | None = None,
    hard_delete: str | None = None,
) -> DataFrame:
    """Add rows with unknown keys; existing rows never change, flagged rows never land."""
    _check_flag(key, hard_delete)
    old, new = _both_sides(existing, incoming)
    added = new_rows(old, new, key or [ROW_ID], file_order=file_order, hard_delete=hard_delete)
    return old.unionByName(_without_position(added))


def delete_by_key(existing: DataFrame, keys: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``existing`` whose key is not listed; schema kept even if none is left."""
    return keep_unmatched(guard_keys(existing, key, "existing"), _distinct_keys(keys, key, "incoming"), key)


def update_only(
    existing: DataFrame,
    incoming: DataFrame,
    key: Sequence[str],
    *,
    order: Sequence[str] | None = None,
    file_order: str | None = None,
) -> DataFrame:
    """Replace matched rows; incoming rows with an unknown key are ignored."""
    old, new = _both_sides(existing, incoming)
    winners = last_per_key(new, key, order=order, file_order=file_order).drop(DELETED)
    # folded first, so the semi-join sees one row per key
    matched = winners.join(known_keys(old, new, key), list(key), "left_semi").select(*winners.columns)
    kept = keep_unmatched(guard_keys(old, key, "existing"), _distinct_keys(new, key, "incoming"), key)
    return kept.unionByName(matched)


def _check_flag(key: Sequence[str] | None, hard_delete: str | None) -> None:
    if key and hard_delete in key:
        raise LoadError(f"hard-delete column {hard_delete!r} cannot also be a key column")
