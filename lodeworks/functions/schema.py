"""Permissive schema union and by-name conversion, to any depth.

Spark's own union coercion is looser than what a stored table may accept (it turns
``int`` + ``string`` into ``bigint`` and fails at run time), so types are merged here,
before any plan is built, and every difference is settled by an explicit cast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeworks.errors import SchemaConflictError
from lodeworks.functions.keys import quoted

MAX_PRECISION = 38

# Decimal digits that hold every value of the integer type.
INTEGER_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}

# Engine type of each logical type name. "wei" is a 78-digit integer,
# wider than Spark's widest decimal, so it is kept as text.
LOGICAL_TYPES = {
    "text": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "bool": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
    "binary": T.BinaryType(),
    "json": T.StringType(),
    "wei": T.StringType(),
}
DEFAULT_DECIMAL = (38, 9)


def logical_type(name: str, precision: int | None = None, scale: int | None = None) -> T.DataType:
    """Engine type of a logical type name; a decimal with no precision is (38, 9)."""
    if name == "decimal":
        if precision is None:
            return T.DecimalType(*DEFAULT_DECIMAL)
        return T.DecimalType(precision, scale or 0)
    if name not in LOGICAL_TYPES:
        raise SchemaConflictError(
            f"unknown logical type {name!r}; expected one of: {', '.join(sorted([*LOGICAL_TYPES, 'decimal']))}"
        )
    return LOGICAL_TYPES[name]


def merge_types(a: T.DataType, b: T.DataType, path: str = "column") -> T.DataType:
    """The narrowest type that holds every value of both; raises where there is none."""
    if a == b:
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merge_schemas(a, b, path)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        element = merge_types(a.elementType, b.elementType, f"{path}[]")
        return T.ArrayType(element, a.containsNull or b.containsNull)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(
            merge_types(a.keyType, b.keyType, f"{path} key"),
            merge_types(a.valueType, b.valueType, f"{path} value"),
            a.valueContainsNull or b.valueContainsNull,
        )
    merged = _merge_numbers(a, b)
    if merged is None and {type(a), type(b)} == {T.StringType, T.BinaryType}:
        merged = T.BinaryType()
    if merged is None:
        raise SchemaConflictError(f"{path}: {a.simpleString()} and {b.simpleString()} have no common type")
    if isinstance(merged, T.DecimalType) and merged.precision > MAX_PRECISION:
        raise SchemaConflictError(
            f"{path}: {a.simpleString()} and {b.simpleString()} need {merged.precision} digits, "
            f"more than {MAX_PRECISION}"
        )
    return merged


def _merge_numbers(a: T.DataType, b: T.DataType) -> T.DataType | None:
    pair = (a, b)
    digits = [INTEGER_DIGITS.get(type(t)) for t in pair]
    if all(digits):
        return a if digits[0] >= digits[1] else b
    if any(isinstance(t, (T.FloatType, T.DoubleType)) for t in pair):
        if not all(d or isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType)) for d, t in zip(digits, pair)):
            return None
        # a float cannot hold every int or bigint, nor a decimal
        fits_float = all(isinstance(t, T.FloatType) or (d and d <= 5) for d, t in zip(digits, pair))
        return T.FloatType() if fits_float else T.DoubleType()
    sizes = [
        (t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (d, 0) if d else None
        for d, t in zip(digits, pair)
    ]
    if None in sizes:
        return None
    integral, scale = (max(s[i] for s in sizes) for i in (0, 1))
    # more than 38 digits are possible here; the caller refuses them
    return T.DecimalType(integral + scale, scale)


def merge_schemas(a: T.StructType, b: T.StructType, path: str = "") -> T.StructType:
    """Union of both column sets by (case-insensitive) name, never dropping or narrowing."""
    incoming = {f.name.lower(): f for f in b.fields}
    fields = []
    for f in a.fields:
        other = incoming.pop(f.name.lower(), None)
        if other is None:
            fields.append(T.StructField(f.name, f.dataType, True, f.metadata))
            continue
        where = f"{path}.{f.name}" if path else f.name
        merged = merge_types(f.dataType, other.dataType, where)
        metadata = {**(other.metadata or {}), **(f.metadata or {})}
        fields.append(T.StructField(f.name, merged, f.nullable or other.nullable, metadata))
    fields += [T.StructField(f.name, f.dataType, True, f.metadata) for f in b.fields if f.name.lower() in incoming]
    return T.StructType(fields)


def same_shape(a: T.DataType, b: T.DataType) -> bool:
    """Equal names and types in order; nullability and metadata aside."""
    return a.simpleString() == b.simpleString()


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in exactly the columns and types of ``schema``, matched by name.

    Absent columns are null, nested fields are matched by name too, and a frame that
    already fits is returned as it is. A column ``schema`` lacks is refused.
    """
    if same_shape(df.schema, schema):
        return df
    have = {f.name.lower(): f for f in df.schema.fields}
    extra = sorted(set(have) - {f.name.lower() for f in schema.fields})
    if extra:
        raise SchemaConflictError(f"column(s) {', '.join(extra)} are not in the target schema")
    columns = []
    for f in schema.fields:
        source = have.get(f.name.lower())
        if source is None:
            value = F.lit(None).cast(f.dataType)
        else:
            value = _convert(quoted(source.name), source.dataType, f.dataType)
        columns.append(value.alias(f.name, metadata=f.metadata or {}))
    return df.select(*columns)


def _convert(value: Column, source: T.DataType, target: T.DataType) -> Column:
    if same_shape(source, target):
        return value
    if isinstance(target, T.StructType) and isinstance(source, T.StructType):
        have = {f.name.lower(): f for f in source.fields}
        fields = []
        for f in target.fields:
            inner = have.get(f.name.lower())
            field = (
                F.lit(None).cast(f.dataType)
                if inner is None
                else _convert(value.getField(inner.name), inner.dataType, f.dataType)
            )
            fields.append(field.alias(f.name))
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(target, T.ArrayType) and isinstance(source, T.ArrayType):
        return F.transform(value, lambda x: _convert(x, source.elementType, target.elementType))
    if isinstance(target, T.MapType) and isinstance(source, T.MapType):
        entries = F.transform(
            F.map_entries(value),
            lambda e: F.struct(
                _convert(e["key"], source.keyType, target.keyType).alias("key"),
                _convert(e["value"], source.valueType, target.valueType).alias("value"),
            ),
        )
        return F.map_from_entries(entries)
    return value.cast(target)
