"""Batch files to one DataFrame that knows each row's place in the package."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeworks.errors import LoadError
from lodeworks.functions.local import local_frame
from lodeworks.functions.schema import conform, merge_schemas
from lodeworks.operators.merge import FILE_SEQ, ROW_SEQ
from lodeworks.plans import files as fs

_FILE = "__file"


def read_package(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """All files as one frame with ``__file_seq`` and ``__row_seq`` columns.

    ``paths`` in load order; a directory stands for its Parquet files in name order.
    Files may differ in columns and types: each is read in its own schema and brought to
    the union of all, where one bare read would take the schema of a single file.
    """
    listed = list_files(spark, paths)
    if not listed:
        raise LoadError("a load package needs at least one file")
    with fs.listed_by_few(spark):
        groups = _by_schema(spark, listed)
    merged = reduce(merge_schemas, (scan.schema for scan in groups))
    position = [T.StructField(_FILE, T.StringType()), T.StructField(ROW_SEQ, T.LongType())]
    frames = []
    for scan in groups:
        placed = scan.select("*", fs.file_column().alias(_FILE), F.col("_metadata.row_index").alias(ROW_SEQ))
        frames.append(conform(placed, T.StructType([*merged.fields, *position])))
    rows = reduce(DataFrame.unionByName, frames)
    return in_file_order(rows, listed).select(*merged.names, FILE_SEQ, ROW_SEQ)


def list_files(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    if isinstance(paths, str):
        paths = [paths]
    listed = []
    for path in paths:
        listed += fs.data_files(spark, path) if fs.is_directory(spark, path) else [path]
    return listed


def file_order(spark: SparkSession, listed: Sequence[str]) -> DataFrame:
    """(file, sequence number): one row per file, so as small as the file list."""
    rows = [(name, seq) for seq, name in enumerate(fs.uris(spark, listed))]
    return local_frame(spark, rows, T.StructType().add(_FILE, "string").add(FILE_SEQ, "integer"))


def in_file_order(rows: DataFrame, listed: Sequence[str]) -> DataFrame:
    """Rows with a ``__file`` column, plus the sequence number of that file.

    A row of a file that is not listed is an error, never dropped.
    """
    numbered = rows.join(file_order(rows.sparkSession, listed), _FILE, "left")
    stray = F.raise_error(F.concat(F.lit("file is not in the package: "), _FILE)).cast("int")
    return numbered.withColumn(FILE_SEQ, F.coalesce(FILE_SEQ, stray))


def rows_per_file(spark: SparkSession, listed: Sequence[str]) -> DataFrame:
    """(file, sequence number, rows) read from the file footers."""
    with fs.listed_by_few(spark):
        scan = spark.read.parquet(*listed)
    counted = scan.groupBy(fs.file_column().alias(_FILE)).agg(F.count(F.lit(1)).alias("rows"))
    # a file without rows still is a line of the report
    joined = file_order(spark, listed).join(counted, _FILE, "left")
    return joined.select(F.col(_FILE).alias("file"), FILE_SEQ, F.coalesce("rows", F.lit(0)).alias("rows"))


def _by_schema(spark: SparkSession, listed: Sequence[str]) -> list[DataFrame]:
    """Files grouped by the schema to read them in, listed once.

    Footers are merged by one parallel job. That job refuses columns whose types differ
    between files; only then is every footer read for itself.
    """
    try:
        return [spark.read.option("mergeSchema", True).parquet(*listed)]
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE" not in str(error):
            raise
    with ThreadPoolExecutor(16) as pool:
        schemas = list(pool.map(lambda path: spark.read.parquet(path).schema, listed))
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for schema, path in zip(schemas, listed):
        groups.setdefault(schema.json(), (schema, []))[1].append(path)
    return [spark.read.schema(schema).parquet(*members) for schema, members in groups.values()]
