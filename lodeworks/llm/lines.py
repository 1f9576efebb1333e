"""Line dedup: explode normalised lines, hash, count documents per hash, drop, reassemble by position."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.llm.common import lower_ascii, packed, stored, with_text
from lodeworks.llm.registry import query, read

_SPACE = " \t\n\x0b\f\r"


def _marked(docs: DataFrame, min_docs: int, min_chars: int) -> DataFrame:
    """packed(docs) with lines (array), kept (positions) and n_dropped."""
    rows = packed(docs)
    lines = F.split("body", "\n", -1)
    keyed = rows.select("doc", "row", F.posexplode(lines).alias("pos", "line"))
    keyed = keyed.select("doc", "row", "pos", lower_ascii(F.btrim("line", F.lit(_SPACE))).alias("key"))
    keyed = keyed.where(F.char_length("key") >= min_chars)
    # two 64-bit hashes: one alone would meet by chance among some billions of lines
    keyed = keyed.select("doc", "row", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))
    # first per (line, document), then per line: a line in a third of all documents arrives as one row per task
    once = keyed.select("h1", "h2", "doc").distinct()
    shared = once.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("first"))
    # read from files, it is a plain side of the join, whose hot keys Spark may then split
    shared = stored(shared.where(F.col("n") >= min_docs).select("h1", "h2", "first"))
    # and so is this one: a row whose id and text repeat very often is a hot key of the next join
    drops = stored(keyed.join(shared, ["h1", "h2"]).where("doc != first").groupBy("doc", "row").agg(F.collect_set("pos").alias("drops")))
    # the text moves once, in its row: a second copy of it would double what is shuffled and sorted
    joined = rows.drop("body").join(drops, ["doc", "row"], "left")
    joined = joined.withColumn("body", F.coalesce(F.col("whole").getField("text"), F.lit(""))).withColumn("lines", lines)
    every = F.sequence(F.lit(0), F.size("lines") - 1)
    return joined.select(
        "doc", "whole", "lines",
        F.when(F.col("drops").isNull(), every).otherwise(F.array_except(every, "drops")).alias("kept"),
        F.coalesce(F.size("drops"), F.lit(0)).alias("n_dropped"), F.col("drops").isNull().alias("untouched"), "body",
    )


def _kept_text():
    whole = F.array_join(F.transform("kept", lambda i: F.get(F.col("lines"), i)), "\n")
    return F.when(F.col("untouched"), F.col("body")).otherwise(whole)


def dedup_lines(docs: DataFrame, min_docs: int = 2, min_chars: int = 10) -> DataFrame:
    """The documents without the lines that other documents hold.

    A line's key is the line without white space at its ends and with A-Z in lower case.
    Keys of at least ``min_chars`` code points that at least ``min_docs`` documents hold
    lose all their lines but those of the smallest doc_id. Other lines stay, joined by a
    line feed; a document may end up empty but is never dropped.

    Null text stays null and counts as one empty line. Rows without doc_id are together one
    document, after all others. Rows that share a doc_id are one document, so a line they
    share is not a repeat. Columns beside doc_id and text pass through, whatever their names;
    n_chars, if there, follows the text. An empty table gives an empty table.
    """
    return with_text(_marked(docs, min_docs, min_chars), docs, _kept_text())


def line_report(docs: DataFrame, min_docs: int = 2, min_chars: int = 10) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped, kept_sha256 of the text that ``dedup_lines`` leaves."""
    marked = _marked(docs.select("doc_id", "text"), min_docs, min_chars)
    return marked.select(
        F.col("whole.doc_id").alias("doc_id"), F.size("lines").cast("long").alias("n_lines"),
        F.col("n_dropped").cast("long").alias("n_dropped"), F.sha2(_kept_text(), 256).alias("kept_sha256"),
    )


_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
shared AS (
  SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.first AS gone FROM keyed k LEFT JOIN shared s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query("op3_line_dedup", _SQL)
def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_report(read(spark, folder, "documents"))
