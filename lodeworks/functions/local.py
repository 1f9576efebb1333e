"""Small frames made on the driver, in a form the optimizer knows the size of."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def local_frame(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """Metadata rows as a local relation, so that a join can be planned by their size."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    arrow = to_arrow_schema(schema)
    table = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)
    return spark.createDataFrame(table, schema=schema)


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows of any schema; plans built on it shrink to what is left."""
    nulls = [F.lit(None).cast(f.dataType).alias(f.name, metadata=f.metadata or {}) for f in schema.fields]
    return spark.range(1).where(F.lit(False)).select(*nulls)
