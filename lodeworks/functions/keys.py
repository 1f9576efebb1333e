"""Merge keys and the hard-delete flag, as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeworks.errors import NullKeyError

NULL_KEY = "merge key column is null"


def quoted(name: str) -> Column:
    """A top-level column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def guard_keys(df: DataFrame, key: Sequence[str], side: str = "incoming") -> DataFrame:
    """Refuse a null key *inside* the plan that consumes it.

    The check rides the scan that reads the key anyway, so it costs no extra pass;
    Spark drops it altogether for a column it knows to be non-null.
    """
    missing = [k for k in key if k not in df.columns]
    if missing:
        raise NullKeyError(f"merge key column(s) {', '.join(missing)} missing from the {side} rows")
    checked = {}
    for k in key:
        stop = F.raise_error(F.lit(f"{NULL_KEY}: {k} ({side} rows)"))
        checked[k] = F.coalesce(quoted(k), stop.cast(df.schema[k].dataType))
    return df.withColumns(checked)


def hard_delete_mask(df: DataFrame, column: str) -> Column:
    """True for rows marked as deletes; never null.

    A boolean flag deletes on TRUE only, any other type deletes on NOT NULL.
    """
    if isinstance(df.schema[column].dataType, T.BooleanType):
        return F.coalesce(quoted(column), F.lit(False))
    return quoted(column).isNotNull()


def split_hard_delete(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """(live rows, flagged rows)."""
    flagged = hard_delete_mask(df, column)
    return df.where(~flagged), df.where(flagged)
