"""What the operators share: keys of documents, stored results, blocks of large groups, components."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import lodeworks
from lodeworks.functions.keys import quoted
from lodeworks.plans import files as fs

#: Stands for a missing id: such rows together are one document, after all others.
NO_ID = 2**63 - 1
#: Applications whose workers have the package.
_SHIPPED: set[str] = set()
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, also where its folder is not on their path."""
    context = spark.sparkContext
    root = Path(lodeworks.__file__).resolve().parent
    if context.applicationId in _SHIPPED or not root.is_dir():  # not a folder: it was shipped to here itself
        return
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(p.relative_to(root.parent)))
    path = f"{fs.shared_folder(spark)}/lodeworks-package.zip"
    fs.write_bytes(spark, path, packed.getvalue())
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def stored(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write a result to the shared folder and read it from there: its lineage ends at the files."""
    spark = df.sparkSession
    path = f"{folder or fs.shared_folder(spark)}/t-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other letter as it is."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def document_key() -> list[Column]:
    """doc, row: the id, and a hash that tells texts apart that share an id."""
    text = F.coalesce("text", F.lit(""))
    return [F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("row"), text.alias("body")]


def packed(docs: DataFrame) -> DataFrame:
    """doc, row, body, and all columns as one, so that no name of the input can clash."""
    return docs.select(*document_key(), F.struct(*[quoted(c) for c in docs.columns]).alias("whole"))


def unpacked(df: DataFrame, columns: list[str], **new: Column) -> DataFrame:
    """The columns of ``packed`` again, some of them replaced."""
    return df.select(*[(new[c] if c in new else F.col("whole").getField(c)).alias(c) for c in columns])


def with_text(df: DataFrame, docs: DataFrame, text: Column) -> DataFrame:
    """The documents with another text, and its length where they carry one. Untouched texts stay null if they were."""
    text = F.when(F.col("whole").getField("text").isNull(), F.lit(None).cast("string")).otherwise(text)
    new = {"text": text}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.char_length(F.coalesce(text, F.lit(""))).cast(docs.schema["n_chars"].dataType)
    return unpacked(df, docs.columns, **new)


def texts(column: pa.Array) -> list[str]:
    return ["" if x is None else x for x in column.to_pylist()]


def block_pairs(df: DataFrame, keys: list[str], by: Column, size: int) -> DataFrame:
    """Deal groups out so that every pair of a group meets in a task, and no task gets a whole large group.

    Groups of one row go. Larger ones are cut by ``by`` into blocks of about ``size`` rows;
    each row goes to every pair (i, j), i <= j, of blocks with its own in it. Columns added:
    i, j and own (the row's block). All pairs are met once, in about (rows / size)^2 / 2 tasks.
    """
    return grouped(dealt_blocks(df, keys, by, size), [*keys, "i", "j"])


def grouped(df: DataFrame, keys: list[str]) -> DataFrame:
    """Partitions that hold whole groups, in the order ``runs`` needs."""
    return df.repartition(*keys).sortWithinPartitions(*keys)


def dealt_blocks(df: DataFrame, keys: list[str], by: Column, size: int) -> DataFrame:
    """The rows of ``block_pairs``, not yet moved to their tasks."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    # read from files, it is a plain side of the join, whose hot groups Spark may then split
    counts = stored(counts.select(*keys, F.ceil(F.col("members") / size).cast("int").alias("blocks")))
    dealt = df.join(counts, keys).withColumn("own", F.pmod(F.xxhash64(by, F.lit(7)), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    return dealt.drop("other", "blocks")


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted batches as tables of whole groups, with the bounds of each group."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table]).combine_chunks()
        if not table.num_rows:
            continue
        change = np.zeros(table.num_rows, bool)
        for k in keys:
            values = table.column(k).to_numpy()
            change[1:] |= values[1:] != values[:-1]
        starts = np.flatnonzero(change)
        if len(starts):
            yield table.slice(0, starts[-1]), np.r_[0, starts]
            rest = table.slice(starts[-1])
        else:
            rest = table
    if rest is not None and rest.num_rows:
        yield rest, np.array([0, rest.num_rows])


def vectors(embedding: Column) -> Column:
    """Whether an array can be compared: it has components, all finite, not all zero."""
    finite = F.forall(embedding, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def matrix(column: pa.ChunkedArray | pa.Array, kind: str = "<f8") -> np.ndarray:
    """A column of equally long arrays as rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(kind, copy=False)


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For links a-b: each node but the smallest of its component, with that smallest one."""
    if not len(a):
        return a, b
    nodes, ends = np.unique(np.r_[a, b], return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        before = label.copy()
        np.minimum.at(label, label[x], low)
        np.minimum.at(label, label[y], low)
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        label = label[label]
        if (label == before).all():
            break
    keep = label != np.arange(len(nodes))
    return nodes[keep], nodes[label[keep]]


def components(links: DataFrame) -> DataFrame:
    """The smallest node that each linked node can reach, as (node, component), from links (a, b) of longs.

    Alternates large stars and small stars until nothing moves. Links stay pairs of longs in
    shuffles, and every round is written to the shared folder, so that lost executors cost
    one round. A node with very many links is a key whose minimum is taken map-side first,
    and the streamed side of a join that adaptive execution may split.
    """
    folder = fs.shared_folder(links.sparkSession)
    edges = stored(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), folder)
    seen = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if not state[0] or state == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        seen = state
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = stored(small.select("e.a", "e.b").where("a != b").distinct(), folder)
