"""Series published as CSV files with a text token for missing values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_series(spark: SparkSession, path: str, name: str, *, date_column: str = "date", null_value: str = ".") -> DataFrame:
    """(date, ``name``) rows of one series; the schema is given, never inferred."""
    schema = T.StructType().add(date_column, "date").add(name, "double")
    rows = spark.read.csv(path, header=True, nullValue=null_value, schema=schema, enforceSchema=True)
    return rows.withColumnRenamed(date_column, "date")
