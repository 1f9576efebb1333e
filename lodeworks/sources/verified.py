"""Reads that are checked for completeness, and exports in bounded batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from lodeworks.errors import IncompleteReadError, UndefinedTableError, UnverifiableReadError
from lodeworks.functions.keys import quoted
from lodeworks.plans import content
from lodeworks.plans import files as fs
from lodeworks.plans.dataset import Dataset
from lodeworks.sources.package import in_file_order, rows_per_file

DEFAULT_BATCH_ROWS = 50_000
#: Bytes that one job brings to the driver, if a batch alone has not more.
_READ_AT_ONCE = 16 << 20


def deliver(df: DataFrame, path: str, expected: int | None, batch_rows: int = 0, sums: Sequence[int] | None = None, **options: str) -> int:
    """Write ``df`` to ``path`` and compare the rows written with the rows expected.

    The counter sits on the very frame that is written, in the job that writes it, so the
    check costs no second read. Too few and too many rows both raise. So do, where the content
    sums are given as well, the right number of rows with a wrong value.
    """
    if expected is None:
        raise UnverifiableReadError("no authoritative row count to check this read against")
    counted = Observation()
    counts = [F.count(F.lit(1)).alias("rows"), *(content.sums_of(df.schema) if sums is not None else ())]
    writer = df.observe(counted, *counts).write.options(**options)
    if batch_rows > 0:
        writer = writer.option("maxRecordsPerFile", int(batch_rows))
    # beside the target first: a bad copy never stands under the name the caller reads
    spark, draft = df.sparkSession, fs.unique(f"{path.rstrip('/')}.unverified")
    if fs.exists(spark, path):
        raise FileExistsError(path)
    writer.parquet(draft)
    received = int(counted.get.get("rows") or 0)
    if received != expected:
        fs.delete(spark, draft)
        raise IncompleteReadError(f"received {received} of {expected} rows")
    if sums is not None and content.digest(counted.get) != list(sums):
        fs.delete(spark, draft)
        raise IncompleteReadError(f"received {received} rows, but not with the values that were written")
    fs.rename(spark, draft, path)
    return received


def verified_read(dataset: Dataset, table: str, path: str, batch_rows: int = 0) -> DataFrame:
    """Copy a table to ``path``, check it against the published row count and content and read it back.

    The content is what loads summed up as they wrote; only parts of which rows were masked or
    a type has widened since are read once more for it. Returns the copy. ``batch_rows`` bounds the rows per file.
    """
    version = dataset.version(table)
    if version is None:
        raise UndefinedTableError(f"table {dataset.schema}.{table} does not exist")
    rows = dataset.table(table, version=version)
    deliver(rows, path, version.rows, batch_rows, dataset.content_of(table, version))
    return dataset.spark.read.schema(rows.schema).parquet(path)


def read_batches(df: DataFrame, expected: int | None = None, batch_rows: int = DEFAULT_BATCH_ROWS) -> Iterator[pa.Table]:
    """The rows for a consumer on the driver, at most ``batch_rows`` at a time, in the order tasks made them.

    Batches are what tasks made, cut but never combined. They are written to the shared folder
    first, by one job, so a reader that is slow or stops holds no executor. Where ``expected``
    is given, that job counts the rows, and the wrong number raises before the first batch.
    Small batches come to the driver together, up to about ``_READ_AT_ONCE`` bytes, so that jobs grow
    with the bytes and not with the batches; a larger one comes alone. Without rows there is one
    empty batch, which has the schema.
    """
    spark, path = df.sparkSession, fs.shared_folder(df.sparkSession) + "/batches"
    number = fs.unique("__number")
    # the task, then the row's place in it; files are in this order, so a read of some batches skips the rest of its file
    rows, small = df.withColumn(number, F.monotonically_increasing_id()), {"parquet.block.size": str(_READ_AT_ONCE)}
    if expected is None:
        rows.write.options(**small).parquet(path)
    else:
        deliver(rows, path, expected, **small)
    read, given = spark.read.schema(rows.schema), False
    for file, cuts in _together(read.parquet(path), number, batch_rows):
        some = read.parquet(f"{path}/{file}").where(quoted(number).between(cuts[0][0], cuts[-1][1])).toArrow().sort_by(number)
        starts = np.searchsorted(some.column(number).to_numpy(), [low for low, _ in cuts]).tolist()
        for start, end in zip(starts, [*starts[1:], some.num_rows]):
            given = True
            yield some.slice(start, end - start).drop_columns([number])
    if not given:
        yield spark.createDataFrame([], df.schema).toArrow()
    fs.delete(spark, path)


def _together(rows: DataFrame, number: str, batch_rows: int) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """(file, first and last number of each batch) of batches to read at once, in their order."""
    task, place = F.shiftright(quoted(number), 33), quoted(number).bitwiseAND(F.lit(2**33 - 1))
    cut = F.floor(place / F.lit(int(batch_rows))) if batch_rows > 0 else F.lit(0).cast("long")
    # text for the bytes of any value; nulls have none there, but places in memory
    values = F.to_json(F.struct(*(quoted(c) for c in rows.columns if c != number)))
    takes = F.sum(F.octet_length(values) + 8 * len(rows.columns))
    batches = rows.groupBy(F.col("_metadata.file_name").alias("file"), task.alias("task"), cut.alias("cut"))
    batches = batches.agg(F.min(quoted(number)).alias("low"), F.max(quoted(number)).alias("high"), takes.alias("bytes"))
    cuts, held, last = [], 0, None
    for b in batches.orderBy("low").collect():
        if cuts and (b.file != last or held + b.bytes > _READ_AT_ONCE):
            yield last, cuts
            cuts, held = [], 0
        cuts.append((b.low, b.high))
        held, last = held + b.bytes, b.file
    if cuts:
        yield last, cuts


def export_batches(df: DataFrame, path: str, batch_rows: int = DEFAULT_BATCH_ROWS) -> DataFrame:
    """Write files of at most ``batch_rows`` rows and return (file, rows).

    Rows are split where a task writes more, never combined across tasks, so nothing is
    shuffled. A size of zero or less does not split. An empty frame gives one file that
    carries the schema.
    """
    writer = df.write
    if batch_rows > 0:
        writer = writer.option("maxRecordsPerFile", int(batch_rows))
    writer.parquet(path)
    return rows_per_file(df.sparkSession, fs.data_files(df.sparkSession, path)).select("file", "rows")


def number_batches(df: DataFrame, order_by: Sequence[str], batch_rows: int = DEFAULT_BATCH_ROWS) -> DataFrame:
    """``df`` with a ``batch`` column: consecutive runs of ``batch_rows`` in a total order.

    The rows are range-partitioned and written once; a row's number is its index in its
    file plus the rows of all files before it. Only the per-file counts (one row each)
    meet in a single task.
    """
    if batch_rows <= 0:
        return df.withColumn("batch", F.lit(0).cast("bigint"))
    spark = df.sparkSession
    path = fs.shared_folder(spark) + "/sorted"
    df.repartitionByRange(*order_by).sortWithinPartitions(*order_by).write.parquet(path)
    listed = fs.data_files(spark, path)
    before = Window.orderBy("__file_seq").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows_per_file(spark, listed).withColumn("__before", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    scan = spark.read.schema(df.schema).parquet(path)
    placed = scan.select(
        "*", fs.file_column().alias("__file"), F.col("_metadata.row_index").alias("__index")
    )
    number = F.col("__before") + F.col("__index")
    offsets = counts.select("__file_seq", "__before")
    numbered = in_file_order(placed, listed).join(offsets, "__file_seq").withColumn("batch", F.floor(number / F.lit(int(batch_rows))))
    return numbered.select(*df.columns, "batch")
