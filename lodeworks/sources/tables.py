"""Tables and queries of a dataset as inputs of a load."""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import Any

from lodeworks.functions.keys import quoted
from lodeworks.plans.dataset import Dataset
from lodeworks.spec import LoadSpec

_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def _plain(value: str, what: str) -> str:
    if not _IDENTIFIER.fullmatch(value or ""):
        raise ValueError(f"{what} {value!r} is not a plain identifier; use query_source for anything else")
    return value


def table_source(
    dataset: Dataset,
    table: str,
    *,
    included_columns: Sequence[str] | None = None,
    limit: int | None = None,
    name: str | None = None,
    **hints: Any,
) -> LoadSpec:
    """A table, whole or some columns of it, named after the table unless told otherwise.

    ``hints`` are those of ``LoadSpec``. The layout of the source is not carried over: how
    the target is laid out is the target's own business. The published row count of the
    version read goes along, so a load of fewer or more rows is refused.
    """
    _plain(dataset.schema, "schema")
    _plain(table, "table")
    if isinstance(included_columns, str):
        raise ValueError(f"included_columns is the bare string {included_columns!r}; give a list of column names")
    version = dataset.version(table)
    rows = dataset.table(table, version=version)
    expected = version.rows
    if included_columns:
        rows = rows.select(*(quoted(_plain(c, "column")) for c in included_columns))
    if limit is not None:
        rows = rows.limit(int(limit))
        expected = None if expected is None else min(expected, int(limit))
    return LoadSpec(name or table, rows, **{"expected_rows": expected, **hints})


def query_source(dataset: Dataset, query: str, *, name: str, args: Any = None, verified: bool = False, **hints: Any) -> LoadSpec:
    """A query over the dataset's tables, run as written. A query has no name of its own.

    ``verified`` runs it once more beforehand, only to count: a load that then brings fewer or
    more rows is refused.
    """
    rows = dataset.sql(query, args)
    if verified:
        hints = {"expected_rows": rows.count(), **hints}
    return LoadSpec(name, rows, **hints)
