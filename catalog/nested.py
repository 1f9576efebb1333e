"""Nested data."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import new_dataset, query, read
from lodeworks import LoadSpec, load
from lodeworks.functions.nested import child_tables, flatten_struct

_LINES = """
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) - 1 AS idx FROM documents
"""


def _documents(spark, folder):
    """Documents with their lines as an array of structs, each with its words."""
    line = lambda x: F.struct(x.alias("line"), F.length(x).cast("bigint").alias("n_chars"), F.split(x, " ", -1).alias("words"))
    return read(spark, folder, "documents").select("doc_id", "lang", F.transform(F.split("text", "\n", -1), line).alias("lines"))


@query(
    "nested_child_table",
    f"""
    SELECT sha256('3:n-1|' || length(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR)) AS _dlt_parent_id, CAST(idx AS INTEGER) AS _dlt_list_idx,
           sha256(sha256('3:n-1|' || length(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR)) || '_documents__lines_' || CAST(idx AS VARCHAR)) AS _dlt_id,
           'n-1' AS _dlt_load_id, line, CAST(length(line) AS BIGINT) AS n_chars FROM ({_LINES})
    """,
)
def nested_child_table(spark, folder):
    """An array of structs becomes a table of its own, loaded with its parent in one package."""
    dataset = new_dataset(spark)
    rows = _documents(spark, folder)
    load(dataset, LoadSpec("documents", rows, nested=True, order_by=["doc_id"]), load_id="n-1")
    return dataset.table("documents__lines")


@query(
    "nested_grandchild_table",
    f"""
    WITH lines AS ({_LINES}),
         words AS (SELECT doc_id, idx, unnest(string_split(line, ' ')) AS value,
                          generate_subscripts(string_split(line, ' '), 1) - 1 AS pos FROM lines)
    SELECT sha256(sha256('3:n-1|' || length(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR)) || '_documents__lines_' || CAST(idx AS VARCHAR)) AS _dlt_parent_id,
           CAST(pos AS INTEGER) AS _dlt_list_idx, value FROM words
    """,
)
def nested_grandchild_table(spark, folder):
    from lodeworks.operators.identity import with_identity

    rows = with_identity(_documents(spark, folder), "n-1", ["doc_id"])
    words = child_tables(rows, "documents")["documents__lines__words"]
    return words.select("_dlt_parent_id", "_dlt_list_idx", "value")


@query(
    "flatten_struct",
    """
    SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS props__k, user_id AS who__user_id,
           event_type AS who__what__event_type FROM events
    """,
)
def flatten(spark, folder):
    rows = read(spark, folder, "events").select(
        "event_id",
        F.from_json("props", "k INT").alias("props"),
        F.struct("user_id", F.struct("event_type").alias("what")).alias("who"),
    )
    return flatten_struct(rows)


@query(
    "nesting_limit",
    """
    SELECT doc_id, lang, CAST(len(string_split(text, chr(10))) AS INTEGER) AS n_lines,
           string_split(text, chr(10))[-1] AS last_line FROM documents
    """,
)
def nesting_limit(spark, folder):
    """With no nesting allowed, the array stays one column of JSON text."""
    from lodeworks.operators.identity import with_identity

    rows = with_identity(_documents(spark, folder), "n-1", ["doc_id"])
    tables = child_tables(rows, "documents", max_nesting=0)
    assert list(tables) == ["documents"]
    lines = F.from_json("lines", "array<struct<line:string>>")
    return tables["documents"].select(
        "doc_id", "lang", F.size(lines).alias("n_lines"), F.element_at(lines, -1)["line"].alias("last_line")
    )


@query(
    "json_text_tables",
    """
    SELECT event_id, 0 AS idx, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CASE WHEN user_id % 2 = 0 THEN CAST(user_id AS VARCHAR) ELSE event_type END AS mixed, user_id AS n, 0 AS unread FROM events
    UNION ALL SELECT event_id, 1, CAST(json_extract(props, '$.k') AS BIGINT), CASE WHEN user_id % 2 = 0 THEN CAST(user_id AS VARCHAR) ELSE event_type END, user_id + 1, 0 FROM events
    """,
)
def json_text_tables(spark, folder):
    """A text column of JSON becomes columns and a child table, by the schema its rows are seen to have; types that differ become text."""
    mixed = F.when(F.col("user_id") % 2 == 0, F.col("user_id").cast("string")).otherwise(F.concat(F.lit('"'), "event_type", F.lit('"')))
    text = F.format_string('{"props": %s, "mixed": %s, "list": [{"n": %s}, {"n": %s}]}', "props", mixed, F.col("user_id").cast("string"), (F.col("user_id") + 1).cast("string"))
    dataset = new_dataset(spark)
    rows = read(spark, folder, "events").select("event_id", text.alias("doc"))
    load(dataset, LoadSpec("t", rows, nested=True, primary_key="event_id", write_disposition="upsert", columns={"doc": {"parse_json": True}}))
    parents = dataset.table("t").select("_dlt_id", "event_id", F.col("doc__props__k").alias("k"), F.col("doc__mixed").alias("mixed"))
    items = dataset.table("t__doc__list").select(F.col("_dlt_parent_id").alias("_dlt_id"), F.col("_dlt_list_idx").alias("idx"), "n")
    return parents.join(items, "_dlt_id").drop("_dlt_id").withColumn("unread", F.lit(0))


@query(
    "map_child_table",
    """
    SELECT conv_id, turn, 'role' AS key, role AS value FROM conversations
    UNION ALL SELECT conv_id, turn, 'text', text FROM conversations
    """,
)
def map_child_table(spark, folder):
    """A map becomes a child table of its keys and values."""
    rows = read(spark, folder, "conversations").select("conv_id", "turn", F.create_map(F.lit("role"), "role", F.lit("text"), "text").alias("said"))
    dataset = new_dataset(spark)
    load(dataset, LoadSpec("t", rows, nested=True, order_by=["conv_id", "turn"]))
    pairs = dataset.table("t__said").select(F.col("_dlt_parent_id").alias("_dlt_id"), "key", "value")
    return dataset.table("t").select("_dlt_id", "conv_id", "turn").join(pairs, "_dlt_id").drop("_dlt_id")
