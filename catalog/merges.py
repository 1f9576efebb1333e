"""Load dispositions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query, read
from lodeworks.functions.names import normalize_column
from lodeworks.functions.schema import conform, logical_type
from lodeworks.operators import merge
from lodeworks.plans import files as fs
from lodeworks.sources.package import read_package

# Customers as the profiles their events update.
_PROFILES = "SELECT c_custkey AS user_id, CAST(-1 AS BIGINT) AS event_id, 'none' AS event_type, c_acctbal AS value FROM customer"
_SUPPLIER_PROFILES = (
    "SELECT s_suppkey AS user_id, CAST(-1 AS BIGINT) AS event_id, 'none' AS event_type, s_acctbal AS value FROM supplier"
)


def _profiles(spark, folder, table="customer", key="c_custkey", balance="c_acctbal"):
    return read(spark, folder, table).select(
        F.col(key).alias("user_id"),
        F.lit(-1).cast("bigint").alias("event_id"),
        F.lit("none").alias("event_type"),
        F.col(balance).alias("value"),
    )


def _events(spark, folder):
    return read(spark, folder, "events").select("user_id", "event_id", "event_type", "value")


def _shifted_customers(spark, folder):
    """All customers under keys 500 higher: most match, the highest 500 are new."""
    return read(spark, folder, "customer").withColumns(
        {"c_custkey": F.col("c_custkey") + 500, "c_acctbal": F.round(F.col("c_acctbal") + 100, 4)}
    )


@query(
    "upsert_single_key",
    """
    WITH inc AS (SELECT c_custkey + 500 AS c_custkey, c_name, c_nationkey,
                        round(c_acctbal + 100, 4) AS c_acctbal, c_mktsegment FROM customer)
    SELECT * FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM inc)
    UNION ALL SELECT * FROM inc
    """,
)
def upsert_single_key(spark, folder):
    return merge.upsert(read(spark, folder, "customer"), _shifted_customers(spark, folder), ["c_custkey"])


@query(
    "upsert_composite_key",
    """
    WITH inc AS (SELECT conv_id, turn + 4 AS turn, role, 'edited: ' || text AS text FROM conversations)
    SELECT c.* FROM conversations c
    WHERE NOT EXISTS (SELECT 1 FROM inc WHERE inc.conv_id = c.conv_id AND inc.turn = c.turn)
    UNION ALL SELECT * FROM inc
    """,
)
def upsert_composite_key(spark, folder):
    turns = read(spark, folder, "conversations")
    edits = turns.withColumns({"turn": F.col("turn") + 4, "text": F.concat(F.lit("edited: "), "text")})
    return merge.upsert(turns, edits, ["conv_id", "turn"])


_LAST_WINS = f"""
    WITH old AS ({_PROFILES}),
         last AS (SELECT user_id, event_id, event_type, value,
                         row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events)
    SELECT * FROM old WHERE user_id NOT IN (SELECT user_id FROM events)
    UNION ALL SELECT user_id, event_id, event_type, value FROM last WHERE rn = 1
    """


@query("upsert_last_wins", _LAST_WINS)
def upsert_last_wins(spark, folder):
    return merge.upsert(_profiles(spark, folder), _events(spark, folder), ["user_id"], order=["event_id"])


@query(
    "upsert_whole_row",
    """
    SELECT c_custkey, c_name, CAST(NULL AS INTEGER) AS c_nationkey, CAST(NULL AS DOUBLE) AS c_acctbal,
           'seen' AS c_mktsegment FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
    UNION ALL
    SELECT * FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
    """,
)
def upsert_whole_row(spark, folder):
    """Columns the batch lacks become null on the rows it replaces."""
    customers = read(spark, folder, "customer")
    pending = read(spark, folder, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    batch = customers.join(pending, "c_custkey", "left_semi").select(
        "c_custkey", "c_name", F.lit("seen").alias("c_mktsegment")
    )
    return merge.upsert(customers, batch, ["c_custkey"])


@query(
    "package_fold",
    f"""
    WITH old AS ({_PROFILES}),
         pkg AS (SELECT user_id, event_id, event_type, value, day(ts) AS f, event_type = 'error' AS flag FROM events),
         newest AS (SELECT user_id, max(f) AS f FROM pkg GROUP BY user_id),
         last_file AS (SELECT pkg.* FROM pkg JOIN newest USING (user_id, f)),
         gone AS (SELECT DISTINCT user_id FROM last_file WHERE flag),
         ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM last_file)
    SELECT user_id, event_id, event_type, value FROM old WHERE user_id NOT IN (SELECT user_id FROM pkg)
    UNION ALL
    SELECT user_id, event_id, event_type, value FROM ranked
    WHERE rn = 1 AND user_id NOT IN (SELECT user_id FROM gone)
    """,
)
def package_fold(spark, folder):
    """Thirty daily files with deletes, folded in one pass."""
    events = read(spark, folder, "events").select(
        "user_id",
        "event_id",
        "event_type",
        "value",
        (F.col("event_type") == "error").alias("flag"),
        F.dayofmonth("ts").alias(merge.FILE_SEQ),
        F.col("event_id").alias(merge.ROW_SEQ),
    )
    return merge.upsert(_profiles(spark, folder), events, ["user_id"], hard_delete="flag").drop("flag")


@query("package_fold_files", _LAST_WINS)
def package_fold_files(spark, folder):
    """The same rule on Parquet files, ordered by file and by row in the file."""
    path = fs.shared_folder(spark) + "/package"
    ordered = _events(spark, folder).repartitionByRange("event_id").sortWithinPartitions("event_id")
    ordered.write.option("maxRecordsPerFile", 3000).parquet(path)
    return merge.upsert(_profiles(spark, folder), read_package(spark, [path]), ["user_id"])


@query(
    "insert_only",
    """
    SELECT doc_id, quality, toxic, CAST(NULL AS VARCHAR) AS lang, CAST(NULL AS BIGINT) AS n_chars FROM labels
    UNION ALL
    SELECT doc_id, NULL, NULL, lang, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    """,
)
def insert_only(spark, folder):
    documents = read(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    return merge.insert_only(read(spark, folder, "labels"), documents, ["doc_id"])


@query(
    "insert_only_package",
    f"""
    WITH old AS ({_SUPPLIER_PROFILES}),
         pkg AS (SELECT user_id, event_id, event_type, value, day(ts) AS f FROM events),
         first AS (SELECT user_id, min(f) AS f FROM pkg WHERE user_id NOT IN (SELECT user_id FROM old) GROUP BY user_id)
    SELECT * FROM old
    UNION ALL SELECT user_id, event_id, event_type, value FROM pkg JOIN first USING (user_id, f)
    """,
)
def insert_only_package(spark, folder):
    """A new key keeps every row of the first file that brings it."""
    events = read(spark, folder, "events").select(
        "user_id", "event_id", "event_type", "value", F.dayofmonth("ts").alias(merge.FILE_SEQ)
    )
    return merge.insert_only(_profiles(spark, folder, "supplier", "s_suppkey", "s_acctbal"), events, ["user_id"])


@query(
    "insert_only_hard_delete",
    """
    SELECT doc_id, quality, toxic, CAST(NULL AS VARCHAR) AS lang, CAST(NULL AS BOOLEAN) AS gone FROM labels
    UNION ALL
    SELECT doc_id, NULL, NULL, lang, FALSE FROM documents
    WHERE lang <> 'fr' AND doc_id NOT IN (SELECT doc_id FROM labels)
    """,
)
def insert_only_hard_delete(spark, folder):
    documents = read(spark, folder, "documents").select("doc_id", "lang", (F.col("lang") == "fr").alias("gone"))
    return merge.insert_only(read(spark, folder, "labels"), documents, ["doc_id"], hard_delete="gone")


@query("delete_by_key", "SELECT * FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)")
def delete_by_key(spark, folder):
    users = read(spark, folder, "events").select(F.col("user_id").alias("c_custkey"))
    return merge.delete_by_key(read(spark, folder, "customer"), users, ["c_custkey"])


@query(
    "update_only",
    """
    WITH inc AS (SELECT o_custkey + 500 AS c_custkey, round(sum(o_totalprice), 2) AS c_acctbal,
                        'spent' AS c_mktsegment FROM orders GROUP BY o_custkey)
    SELECT * FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM inc)
    UNION ALL
    SELECT c_custkey, NULL, NULL, c_acctbal, c_mktsegment FROM inc
    WHERE c_custkey IN (SELECT c_custkey FROM customer)
    """,
)
def update_only(spark, folder):
    spend = read(spark, folder, "orders").groupBy((F.col("o_custkey") + 500).alias("c_custkey")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("c_acctbal"), F.lit("spent").alias("c_mktsegment")
    )
    return merge.update_only(read(spark, folder, "customer"), spend, ["c_custkey"])


@query(
    "hard_delete_bool",
    """
    WITH inc AS (SELECT conv_id, turn + 2 AS turn, role, 'edited: ' || text AS text,
                        role = 'assistant' AND turn >= 3 AS deleted FROM conversations)
    SELECT c.*, CAST(NULL AS BOOLEAN) AS deleted FROM conversations c
    WHERE NOT EXISTS (SELECT 1 FROM inc WHERE inc.conv_id = c.conv_id AND inc.turn = c.turn)
    UNION ALL SELECT * FROM inc WHERE NOT deleted
    """,
)
def hard_delete_bool(spark, folder):
    turns = read(spark, folder, "conversations")
    edits = turns.withColumns(
        {
            "deleted": (F.col("role") == "assistant") & (F.col("turn") >= 3),
            "turn": F.col("turn") + 2,
            "text": F.concat(F.lit("edited: "), "text"),
        }
    )
    return merge.upsert(turns, edits, ["conv_id", "turn"], hard_delete="deleted")


@query(
    "hard_delete_non_bool",
    """
    WITH inc AS (SELECT event_id + 700 AS event_id, user_id, event_type, value,
                        CASE WHEN event_type = 'error' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS deleted_at FROM events)
    SELECT event_id, user_id, event_type, value, CAST(NULL AS VARCHAR) AS deleted_at FROM events
    WHERE event_id NOT IN (SELECT event_id FROM inc)
    UNION ALL SELECT * FROM inc WHERE deleted_at IS NULL
    """,
)
def hard_delete_non_bool(spark, folder):
    events = read(spark, folder, "events")
    kept = events.select("event_id", "user_id", "event_type", "value")
    stamp = F.when(F.col("event_type") == "error", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    batch = events.select(
        (F.col("event_id") + 700).alias("event_id"), "user_id", "event_type", "value", stamp.alias("deleted_at")
    )
    return merge.upsert(kept, batch, ["event_id"], hard_delete="deleted_at")


@query(
    "keyless_merge_row_id",
    """
    WITH old AS (SELECT doc_id, lang, n_chars, CAST(doc_id AS VARCHAR) AS _dlt_id FROM documents),
         inc AS (SELECT doc_id, 'new' AS lang, n_chars, CAST(doc_id + 300 AS VARCHAR) AS _dlt_id
                 FROM documents WHERE lang <> 'es')
    SELECT *, CAST(NULL AS BOOLEAN) AS gone FROM old WHERE _dlt_id NOT IN (SELECT _dlt_id FROM inc)
    UNION ALL SELECT *, FALSE FROM inc
    """,
)
def keyless_merge_row_id(spark, folder):
    """No key: rows match on their row id, flagged rows are left out."""
    documents = read(spark, folder, "documents")
    old = documents.select("doc_id", "lang", "n_chars", F.col("doc_id").cast("string").alias("_dlt_id"))
    batch = documents.select(
        "doc_id",
        F.lit("new").alias("lang"),
        "n_chars",
        (F.col("doc_id") + 300).cast("string").alias("_dlt_id"),
        (F.col("lang") == "es").alias("gone"),
    )
    return merge.upsert(old, batch, hard_delete="gone")


@query(
    "append_permissive",
    """
    SELECT o_orderkey, o_custkey, o_totalprice, CAST(NULL AS VARCHAR) AS o_orderpriority FROM orders
    UNION ALL SELECT o_orderkey, NULL, o_totalprice, o_orderpriority FROM orders
    """,
)
def append_permissive(spark, folder):
    orders = read(spark, folder, "orders")
    return merge.append(
        orders.select("o_orderkey", "o_custkey", "o_totalprice"),
        orders.select("o_orderpriority", "o_orderkey", "o_totalprice"),
    )


@query(
    "merge_new_column",
    """
    WITH inc AS (SELECT c_custkey + 500 AS c_custkey, c_name, c_mktsegment FROM customer)
    SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS c_mktsegment FROM customer
    WHERE c_custkey NOT IN (SELECT c_custkey FROM inc)
    UNION ALL SELECT * FROM inc
    """,
)
def merge_new_column(spark, folder):
    old = read(spark, folder, "customer").select("c_custkey", "c_name")
    batch = _shifted_customers(spark, folder).select("c_custkey", "c_name", "c_mktsegment")
    return merge.upsert(old, batch, ["c_custkey"])


@query(
    "type_promotion",
    """
    WITH t AS (SELECT p_partkey AS k, CAST(p_size AS DOUBLE) AS size, round(p_retailprice, 2) AS price FROM part
               UNION ALL SELECT p_partkey, p_size + 0.5, round(p_retailprice, 2) FROM part)
    SELECT k, size, printf('%.2f', price) AS price,
           'bigint' AS k_type, 'double' AS size_type, 'decimal(38,9)' AS price_type FROM t
    """,
)
def type_promotion(spark, folder):
    """int to bigint, int to double, decimal(12,2) to the default decimal; nothing narrows."""
    part = read(spark, folder, "part")
    narrow = part.select(
        F.col("p_partkey").cast("int").alias("k"),
        F.col("p_size").alias("size"),
        F.col("p_retailprice").cast(logical_type("decimal", 12, 2)).alias("price"),
    )
    wide = part.select(
        F.col("p_partkey").alias("k"),
        (F.col("p_size") + F.lit(0.5).cast("double")).alias("size"),
        F.round("p_retailprice", 2).cast(logical_type("decimal")).alias("price"),
    )
    both = merge.append(narrow, wide)
    types = {f"{c}_type": F.expr(f"typeof({c})") for c in ("k", "size", "price")}
    return both.withColumns(types).withColumn("price", F.col("price").cast("decimal(12,2)").cast("string"))


@query(
    "conform_nested",
    """
    SELECT vec_id, len(embedding) AS dims, round(list_sum(CAST(embedding AS DOUBLE[])), 4) AS total,
           CAST(label AS BIGINT) AS label, vec_id AS tagged_id, 'array<double>' AS embedding_type,
           'struct<label:bigint,vec_id:bigint,note:string>' AS tag_type
    FROM embeddings
    """,
)
def conform_nested(spark, folder):
    """Element and field types widened inside an array and a struct; new fields are null."""
    vectors = read(spark, folder, "embeddings")
    rows = vectors.select("vec_id", "embedding", F.struct("label", F.col("vec_id").cast("int").alias("vec_id")).alias("tag"))
    target = "vec_id bigint, embedding array<double>, tag struct<label:bigint,vec_id:bigint,note:string>"
    stored = conform(rows, spark.createDataFrame([], target).schema)
    total = F.aggregate("embedding", F.lit(0.0).cast("double"), lambda s, x: s + x)
    return stored.select(
        "vec_id",
        F.size("embedding").cast("bigint").alias("dims"),
        F.round(total, 4).alias("total"),
        F.col("tag.label").alias("label"),
        F.col("tag.vec_id").alias("tagged_id"),
        F.expr("typeof(embedding)").alias("embedding_type"),
        F.expr("typeof(tag)").alias("tag_type"),
    )


@query(
    "normalize_identifier",
    """
    WITH names AS (SELECT p_type AS raw FROM part UNION SELECT p_name FROM part UNION SELECT p_brand FROM part
                   UNION SELECT o_orderpriority FROM orders UNION SELECT url FROM pages)
    SELECT raw, lower(regexp_replace(raw, '[^a-zA-Z0-9_]', '_', 'g')) AS name FROM names
    """,
)
def normalize_identifier(spark, folder):
    columns = [("part", "p_type"), ("part", "p_name"), ("part", "p_brand"), ("orders", "o_orderpriority"), ("pages", "url")]
    names = None
    for table, column in columns:
        part = read(spark, folder, table).select(F.col(column).alias("raw"))
        names = part if names is None else names.union(part)
    return names.distinct().select("raw", normalize_column(F.col("raw")).alias("name"))
