"""Row and load identity columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeworks.functions.keys import quoted

# The identity columns every loaded row carries.
ROW_ID = "_dlt_id"
LOAD_ID = "_dlt_load_id"


def with_identity(df: DataFrame, load_id: str, order: Sequence[str] = ()) -> DataFrame:
    """Add ``_dlt_load_id`` and, unless the rows bring one, ``_dlt_id``.

    With ``order`` (columns that together place a row in its package, one row per place)
    the id is a digest of load id and position, so a retried task or a repeated load gives
    the same id.
    """
    added = {LOAD_ID: F.lit(load_id)}
    if ROW_ID not in df.columns:
        added[ROW_ID] = digest(F.lit(load_id), *(quoted(c) for c in order)) if order else F.expr("uuid()")
    return df.withColumns(added)


def digest(*values: Column) -> Column:
    """SHA-256 of values that differ from all others, nulls and separators included.

    Each value is its length in characters, a colon and its text; a null is a dash.
    """
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.char_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat_ws("|", *parts), 256)


def by_value(value: Column, dtype: T.DataType) -> Column:
    """A number as text that is the same in every type that holds it: 1, 1.00 and 1.0E0 are all "1".

    Other types are cast to text. A floating number that no decimal of 38 digits, none or 18 of
    them behind the point, equals keeps its own text.
    """
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        value = value.cast("double")
        exact = [value.try_cast(t) for t in ("decimal(38,18)", "decimal(38,0)")]
        return F.coalesce(*(F.when(d.cast("double") == value, _bare(d)) for d in exact), value.cast("string"))
    return _bare(value) if isinstance(dtype, T.DecimalType) else value.cast("string")


def _bare(decimal: Column) -> Column:
    """Without zeros at the end of its fraction; zero has no sign."""
    text = F.regexp_replace(decimal.cast("string"), r"(\.[0-9]*?)0+$", "$1")
    return F.regexp_replace(F.when(decimal == 0, F.lit("0")).otherwise(text), r"\.$", "")
