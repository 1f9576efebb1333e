"""Row masks: rows taken out of immutable files by their numbers.

A mask is a Parquet table (file, word, bits): bit k of a word says that row 64 * word + k of
the file is gone. Words without a gone row have no line. Reads leave masked rows out by an
anti-join on (file, word), whose build side has one row per word however many rows are gone;
Spark knows its size from its files and chooses between broadcast and shuffle. The streamed
side is the plain scan, so a word of a hot file may be split from the others.
"""

from __future__ import annotations

from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PART = "__part"
FILE, ROW = "__file", "__row"
_SCHEMA = "mask_file string, mask_word bigint, mask_bits bigint"


def _bit() -> Column:
    return F.expr(f"shiftleft(1L, cast({ROW} & 63 as int))")


def _word() -> Column:
    return F.shiftright(ROW, 6)


def file_of_row() -> Column:
    """The file a scanned row came from, relative to its part directory's prefix."""
    return F.substring_index("_metadata.file_path", f"/{PART}=", -1)


def located(frame: DataFrame) -> DataFrame:
    """A scan with each row's file and its number in it."""
    return frame.select("*", file_of_row().alias(FILE), F.col("_metadata.row_index").alias(ROW))


def folder_of(file: Column) -> Column:
    return F.regexp_replace(file, "/[^/]*$", "")


def part_path(folder: str) -> str:
    """The path of a part, as versions list it, from the folder of its files."""
    return f"{PART}={unquote(folder)}"


def read_masks(spark: SparkSession, home: str, names: Iterable[str]) -> DataFrame:
    return spark.read.schema(_SCHEMA).parquet(*(f"{home}/masks/{n}" for n in sorted(set(names))))


def unmasked(rows: DataFrame, masks: DataFrame) -> DataFrame:
    """The located rows that no mask takes out."""
    gone = (F.col(FILE) == F.col("mask_file")) & (_word() == F.col("mask_word")) & (F.col("mask_bits").bitwiseAND(_bit()) != 0)
    return rows.join(masks, gone, "left_anti")


def mask_of(rows: DataFrame) -> DataFrame:
    """The mask that takes located rows out: rows of a word are summed up in each task first."""
    return rows.groupBy(F.col(FILE).alias("mask_file"), _word().alias("mask_word")).agg(F.bit_or(_bit()).alias("mask_bits"))


def both(one: DataFrame, other: DataFrame) -> DataFrame:
    """The mask that takes out what either does."""
    return one.unionByName(other).groupBy("mask_file", "mask_word").agg(F.bit_or("mask_bits").alias("mask_bits"))


def write_mask(mask: DataFrame, path: str) -> None:
    mask.sortWithinPartitions("mask_file", "mask_word").write.parquet(path)


def rows_by_part(mask: DataFrame) -> dict[str, int]:
    """Rows taken out of each part (folder as files name it): a line per part the mask touches."""
    counted = mask.groupBy(folder_of(F.col("mask_file")).alias("folder")).agg(F.sum(F.bit_count("mask_bits")).alias("n"))
    return {r["folder"]: r["n"] for r in counted.collect()}
