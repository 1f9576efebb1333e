"""Identifier rules for tables and columns."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodeworks.errors import LoadError

MAX_IDENTIFIER = 255


def normalize_identifier(value: str) -> str:
    """Lower-case, every character outside ``[a-zA-Z0-9_]`` to ``_``; leading ``_`` stays."""
    return re.sub(r"[^a-zA-Z0-9_]", "_", value).lower() or "unnamed"


def normalize_column(column: Column) -> Column:
    """The same rule as a column expression, for names that are data."""
    name = F.lower(F.regexp_replace(column, "[^a-zA-Z0-9_]", "_"))
    return F.when(name == "", F.lit("unnamed")).otherwise(name)


def check_names(names: Iterable[str]) -> list[str]:
    """Normalise names; refuse overlong ones and pairs that become equal."""
    seen: dict[str, str] = {}
    for raw in names:
        name = normalize_identifier(raw)
        if len(name) > MAX_IDENTIFIER:
            raise LoadError(f"identifier {name[:40]!r}... is longer than {MAX_IDENTIFIER} characters")
        if name in seen:
            raise LoadError(f"names {seen[name]!r} and {raw!r} are both {name!r} once normalised")
        seen[name] = raw
    return list(seen)
