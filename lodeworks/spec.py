"""What one load is: rows, target table, disposition, key and hints."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lodeworks.errors import LoadError
from lodeworks.functions.names import normalize_identifier
from lodeworks.functions.nested import MAX_NESTING
from lodeworks.operators.layout import Layout

# The dispositions and merge strategies a load may ask for.
DISPOSITIONS = ("append", "insert-only", "merge", "replace", "upsert")
MERGE_STRATEGIES = ("insert-only", "upsert")
REPLACE_STRATEGIES = ("truncate-and-insert",)


@dataclass(frozen=True)
class LoadSpec:
    """A named input with its hints.

    ``data`` is a DataFrame or the ordered list of Parquet files of a package.

    ``columns`` holds per-column hints: ``primary_key``, ``hard_delete``, ``partition`` and
    ``sort``, which ``StructField.metadata`` may carry as well, ``data_type`` with
    ``precision`` and ``scale``, and ``parse_json``: its text is JSON, to be stored by the
    schema that all rows of the load have (see ``jsontext``).

    ``order_by`` names the columns that order the rows of a DataFrame, which a keyed batch
    with repeated keys needs; no two rows (of one key, if there is a key) may share a
    place. ``nested`` turns structs into columns, and arrays and maps
    into child tables.

    ``expected_rows`` is how many rows the input must have, where its source says so: the
    load counts them in the job that writes them and publishes nothing if they differ.
    Rows that are flattened or inserted only where new are not counted.
    """

    name: str
    data: Any
    table_name: str | None = None
    write_disposition: str | None = None
    primary_key: str | Sequence[str] | None = None
    merge_strategy: str | None = None
    replace_strategy: str | None = None
    columns: Mapping[str, Mapping[str, Any]] = field(default_factory=dict)
    order_by: Sequence[str] = ()
    partition_by: Sequence[Any] | None = None
    sorted_by: Sequence[Any] | None = None
    nested: bool = False
    max_nesting: int = MAX_NESTING
    expected_rows: int | None = None

    @property
    def target(self) -> str:
        """The table the rows go to. Composed names such as ``orders__items`` stay as they are."""
        return normalize_identifier(self.table_name or self.name)

    def hinted(self, hint: str) -> list[str]:
        """Columns that carry a hint: frame columns in order, then hints on others."""
        fields = self.data.schema.fields if isinstance(self.data, DataFrame) else []
        return hinted_columns(fields, self.columns, hint)

    @property
    def key(self) -> list[str]:
        """Merge key: what the spec names, else the columns hinted so; empty if there is none."""
        named = self.primary_key
        if named is None:
            return self.hinted("primary_key")
        return [named] if isinstance(named, str) else list(named)

    @property
    def delete_flag(self) -> str | None:
        """The first column hinted as the hard-delete flag."""
        return next(iter(self.hinted("hard_delete")), None)

    @property
    def layout(self) -> Layout:
        """What the spec lays out explicitly; each half it leaves open comes from column hints."""
        return Layout.read(self.partition_by or self.hinted("partition"), self.sorted_by or self.hinted("sort"))


def hinted_columns(fields: Sequence[T.StructField], columns: Mapping[str, Mapping], hint: str) -> list[str]:
    named = [f.name for f in fields if (f.metadata or {}).get(hint) or columns.get(f.name, {}).get(hint)]
    return named + [c for c, hints in columns.items() if hints.get(hint) and c not in named]


def resolve_write_disposition(spec: LoadSpec, default: str = "append") -> str:
    disposition = (spec.write_disposition or default).lower()
    if disposition not in DISPOSITIONS:
        raise LoadError(f"write disposition {disposition!r} is not one of: {', '.join(DISPOSITIONS)}")
    return disposition


def resolve_merge_strategy(spec: LoadSpec) -> str | None:
    strategy = spec.merge_strategy
    if strategy is not None and strategy not in MERGE_STRATEGIES:
        raise LoadError(f"merge strategy {strategy!r} is not one of: {', '.join(MERGE_STRATEGIES)}")
    return strategy


def resolve_replace_strategy(spec: LoadSpec) -> str:
    strategy = spec.replace_strategy or REPLACE_STRATEGIES[0]
    if strategy not in REPLACE_STRATEGIES:
        raise LoadError(f"replace strategy {strategy!r} is not one of: {', '.join(REPLACE_STRATEGIES)}")
    return strategy


def resolve_action(spec: LoadSpec, default: str = "append") -> str:
    """The plan a load runs: append, replace, upsert or insert-only."""
    disposition = resolve_write_disposition(spec, default)
    strategy = resolve_merge_strategy(spec)
    resolve_replace_strategy(spec)
    if disposition in ("merge", "upsert"):
        return "insert-only" if disposition == "merge" and strategy == "insert-only" else "upsert"
    return disposition


def declared_tables(names: Sequence[str], internal: Sequence[str]) -> list[str]:
    """Every table a run has to know: normalised user names and the internal ones."""
    return sorted({*(normalize_identifier(n) for n in names), *internal})
