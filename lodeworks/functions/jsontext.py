"""Text columns of JSON as structs, lists and values, by the schema that all their rows are seen to have."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.errors import LoadError
from lodeworks.functions.keys import quoted

#: Added to a column's name for the text of rows that are no JSON.
UNPARSED = "__text"
# In the observed schema: names in backticks are passed over, and these words stand for these types.
_TYPES = {"OBJECT<": "STRUCT<", "VARIANT": "STRING", "VOID": "STRING"}
_WORDS = re.compile(r"`(?:[^`]|``)*`|\bOBJECT<(?!:)|\b(?:VARIANT|VOID)\b(?!:)")


def _storable(observed: str) -> str:
    """The observed schema as a column type: what has several types, or only nulls, is text."""
    return _WORDS.sub(lambda m: _TYPES.get(m[0], m[0]), observed).replace("STRUCT<>", "STRING")


def parse_json_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with these text columns parsed; one aggregate over all rows finds every column's schema.

    Objects become structs with each field any row has, lists become arrays, and a place where
    rows differ in type, numbers apart, becomes text (objects there stay JSON). Numbers take the
    type that holds all of them. A column whose rows differ as a whole, or are all null, stays
    as it is. Rows that hold no JSON are null and keep their text in ``<column>__text``, a
    column that is added where there are any. Null text is null.
    """
    if not columns:
        return df
    parsed = {c: F.try_parse_json(quoted(c)) for c in columns}
    found = [F.schema_of_variant_agg(v).alias(f"schema_{k}") for k, v in enumerate(parsed.values())]
    found += [F.count_if(quoted(c).isNotNull() & v.isNull()).alias(f"bad_{k}") for k, (c, v) in enumerate(parsed.items())]
    seen = df.agg(*found).first()
    out = []
    for name in df.columns:
        if name not in parsed:
            out.append(quoted(name))
            continue
        k = list(parsed).index(name)
        observed, value = seen[f"schema_{k}"] or "VOID", parsed[name]
        if observed in ("VARIANT", "VOID", "OBJECT<>"):
            out.append(quoted(name))
            continue
        out.append(value.cast(_storable(observed)).alias(name))
        if seen[f"bad_{k}"]:
            if f"{name}{UNPARSED}" in df.columns:
                raise LoadError(f"column {name!r} holds text that is no JSON, and {name + UNPARSED!r} is taken")
            out.append(F.when(value.isNull(), quoted(name)).alias(f"{name}{UNPARSED}"))
    return df.select(*out)
