"""Dispositions through the load path: every query loads twice or more into a dataset and reads it back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.registry import SQL, new_dataset, query, read
from lodeworks import Dataset, LoadSpec, delete_rows, load, load_incremental, number_batches, read_batches, stream_insert_only, table_source, update_rows, with_layout
from lodeworks.plans import files as fs
from lodeworks.sources.datasource import register

_IDENTITY = ("_dlt_id", "_dlt_load_id")


def _loaded(spark: SparkSession, rows: DataFrame, **options) -> Dataset:
    dataset = new_dataset(spark)
    load(dataset, LoadSpec("t", rows, **options), load_id="old")
    return dataset


def _stored(dataset: Dataset, table: str = "t") -> DataFrame:
    return dataset.table(table).drop(*_IDENTITY)


@query("load_insert_only", SQL["insert_only"])
def load_insert_only(spark, folder):
    dataset = _loaded(spark, read(spark, folder, "labels"))
    documents = read(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    load(dataset, LoadSpec("t", documents, write_disposition="insert-only", primary_key="doc_id"))
    return _stored(dataset)


@query("load_insert_only_hard_delete", SQL["insert_only_hard_delete"])
def load_insert_only_hard_delete(spark, folder):
    dataset = _loaded(spark, read(spark, folder, "labels"))
    documents = read(spark, folder, "documents").select("doc_id", "lang", (F.col("lang") == "fr").alias("gone"))
    load(dataset, LoadSpec("t", documents, write_disposition="insert-only", primary_key="doc_id", columns={"gone": {"hard_delete": True}}))
    return _stored(dataset)


@query(
    "load_insert_only_package",
    """
    WITH pkg AS (SELECT event_id, user_id, value, CAST(floor(event_id / 400) AS BIGINT) AS f FROM events),
         first AS (SELECT user_id, min(f) AS f FROM pkg WHERE user_id NOT IN (SELECT s_suppkey FROM supplier) GROUP BY user_id)
    SELECT s_suppkey AS user_id, CAST(NULL AS BIGINT) AS event_id, s_acctbal AS value FROM supplier
    UNION ALL SELECT user_id, event_id, value FROM pkg JOIN first USING (user_id, f)
    """,
)
def load_insert_only_package(spark, folder):
    """Files of a package in order: a new key keeps every row of the first file that brings it."""
    suppliers = read(spark, folder, "supplier").select(F.col("s_suppkey").alias("user_id"), F.col("s_acctbal").alias("value"))
    dataset = _loaded(spark, suppliers)
    events = read(spark, folder, "events").select("event_id", "user_id", "value")
    path = fs.shared_folder(spark)
    # one directory per file of the package; the file's place is its name's place
    events.withColumn("f", F.lpad(F.floor(F.col("event_id") / 400).cast("string"), 9, "0")).repartition("f").write.partitionBy("f").parquet(f"{path}/in")
    files = fs.matching(spark, f"{path}/in", "f=*/*.parquet")
    load(dataset, LoadSpec("t", files, write_disposition="insert-only", primary_key="user_id"))
    return _stored(dataset)


@query("load_delete_by_key", SQL["delete_by_key"])
def load_delete_by_key(spark, folder):
    dataset = _loaded(spark, read(spark, folder, "customer"))
    delete_rows(dataset, "t", read(spark, folder, "events").select(F.col("user_id").alias("c_custkey")), ["c_custkey"])
    return _stored(dataset)


@query("update_rows_load", SQL["update_only"])
def update_rows_load(spark, folder):
    """Twice under one load id: the second changes nothing, and every row keeps its identity."""
    dataset = _loaded(spark, read(spark, folder, "customer"))
    spend = read(spark, folder, "orders").groupBy((F.col("o_custkey") + 500).alias("c_custkey")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("c_acctbal"), F.lit("spent").alias("c_mktsegment")
    )
    for _ in range(2):
        update_rows(dataset, "t", spend, ["c_custkey"], load_id="new")
    return dataset.table("t").where("_dlt_id is not null and _dlt_load_id is not null").drop(*_IDENTITY)


@query(
    "upsert_many_files",
    """
    WITH first AS (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders)
    SELECT o_orderkey, CASE WHEN o_orderkey = (SELECT min(o_orderkey) FROM orders) THEN 0.0 ELSE o_totalprice END AS o_totalprice,
           CAST(1 AS BIGINT) AS replaced_at_last FROM first
    """,
)
def upsert_many_files(spark, folder):
    """A merge that touches every file of a load in very many, then one of a single row: that one masks one row."""
    orders = read(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    dataset = _loaded(spark, orders.repartition(300, "o_orderkey"), primary_key="o_orderkey", write_disposition="upsert")
    changed = orders.where("o_orderkey % 2 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    lowest = orders.agg(F.min("o_orderkey").alias("o_orderkey")).withColumn("o_totalprice", F.lit(0.0))
    versions = []
    for rows in (changed, lowest):
        load(dataset, LoadSpec("t", rows, primary_key="o_orderkey", write_disposition="upsert"))
        versions.append(dataset.version("t").parts)
    # a part that lost its last row is gone from the list
    masked = [sum(p.get("masked", 0) for p in parts) for parts in versions]
    dropped = {p["path"] for p in versions[0]} - {p["path"] for p in versions[1]}
    return _stored(dataset).withColumn("replaced_at_last", F.lit(masked[1] - masked[0] + len(dropped)).cast("long"))


@query(
    "load_keyless_merge",
    """
    WITH old AS (SELECT doc_id, lang, n_chars, CAST(doc_id AS VARCHAR) AS _dlt_id FROM documents),
         inc AS (SELECT doc_id, 'new' AS lang, n_chars, CAST(doc_id + 300 AS VARCHAR) AS _dlt_id FROM documents WHERE lang <> 'es')
    SELECT *, CAST(NULL AS BOOLEAN) AS gone FROM old WHERE _dlt_id NOT IN (SELECT _dlt_id FROM inc)
    UNION ALL SELECT *, FALSE FROM inc
    """,
)
def load_keyless_merge(spark, folder):
    documents = read(spark, folder, "documents")
    dataset = _loaded(spark, documents.select("doc_id", "lang", "n_chars", F.col("doc_id").cast("string").alias("_dlt_id")))
    batch = documents.select(
        "doc_id", F.lit("new").alias("lang"), "n_chars", (F.col("doc_id") + 300).cast("string").alias("_dlt_id"), (F.col("lang") == "es").alias("gone")
    )
    load(dataset, LoadSpec("t", batch, write_disposition="merge", columns={"gone": {"hard_delete": True}}))
    return dataset.table("t").drop("_dlt_load_id")


@query("load_hard_delete_non_bool", SQL["hard_delete_non_bool"])
def load_hard_delete_non_bool(spark, folder):
    events = read(spark, folder, "events")
    dataset = _loaded(spark, events.select("event_id", "user_id", "event_type", "value"))
    stamp = F.when(F.col("event_type") == "error", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    batch = events.select((F.col("event_id") + 700).alias("event_id"), "user_id", "event_type", "value", stamp.alias("deleted_at"))
    load(dataset, LoadSpec("t", batch, write_disposition="merge", primary_key="event_id", columns={"deleted_at": {"hard_delete": True}}))
    return _stored(dataset)


@query(
    "replayed_load",
    "SELECT o_orderkey, o_totalprice FROM orders UNION ALL SELECT o_orderkey, -o_totalprice FROM orders",
)
def replayed_load(spark, folder):
    """Load A, load B, load A again: A is there once."""
    orders = read(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    dataset = new_dataset(spark)
    other = orders.withColumn("o_totalprice", -F.col("o_totalprice"))
    for load_id, rows in (("a", orders), ("b", other), ("a", orders)):
        load(dataset, LoadSpec("t", rows), load_id=load_id)
    return _stored(dataset)


@query(
    "nested_merge_twice",
    """
    WITH line AS (SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS line FROM documents)
    SELECT doc_id, line, count(*) AS n FROM line WHERE lang <> 'de' AND lang <> 'fr' GROUP BY ALL
    UNION ALL
    SELECT doc_id, lang AS line, 1 AS n FROM documents WHERE lang = 'de'
    """,
)
def nested_merge_twice(spark, folder):
    """A keyed merge of nested rows: a later batch replaces its rows' children, a flagged row takes its children along."""
    documents = read(spark, folder, "documents")
    dataset = new_dataset(spark)

    def merge(rows: DataFrame, load_id: str) -> None:
        load(
            dataset,
            LoadSpec("docs", rows, write_disposition="merge", primary_key="doc_id", nested=True, columns={"gone": {"hard_delete": True}}),
            load_id=load_id,
        )

    as_line = lambda x: F.struct(x.alias("line"))
    lines = F.transform(F.split("text", "\n", -1), as_line).alias("lines")
    merge(documents.select("doc_id", F.lit(False).alias("gone"), lines), "1")
    later = documents.where("lang in ('de', 'fr')")
    merge(later.select("doc_id", (F.col("lang") == "fr").alias("gone"), F.array(as_line(F.col("lang"))).alias("lines")), "2")
    return dataset.sql("select d.doc_id, l.line, count(*) n from docs d join public.docs__lines l on l._dlt_parent_id = d._dlt_id group by 1, 2")


@query(
    "incremental_null_cursor",
    "SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value FROM events",
)
def incremental_null_cursor(spark, folder):
    """Rows without a cursor value are loaded once, told apart by key, however often they are read."""
    events = read(spark, folder, "events").select("event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("value"))
    dataset = new_dataset(spark)
    for number, seen in enumerate((events.where("value is null or value < 50"), events, events)):
        spec = LoadSpec("events", seen, primary_key="event_id")
        load_incremental(dataset, spec, "value", pipeline="p", load_id=f"run-{number}", null_cursors="include")
    return _stored(dataset, "events")


@query("sql_of_two_datasets", "SELECT (SELECT count(*) FROM orders) AS a, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS b, 7 AS mine")
def sql_of_two_datasets(spark, folder):
    """Two datasets and the caller's session each have a table of one name; a query sees that of its dataset."""
    orders = read(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    counts = [_loaded(spark, rows).sql("select count(*) n from public.T").first()["n"] for rows in (orders, orders.where("o_orderstatus = 'F'"))]
    spark.range(7).createOrReplaceTempView("t")
    mine = spark.table("t").agg(F.count(F.lit(1)).cast("int").alias("mine"))
    return mine.select(F.lit(counts[0]).cast("long").alias("a"), F.lit(counts[1]).cast("long").alias("b"), "mine")


@query("verified_derive", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def verified_derive(spark, folder):
    """A table derived from another, checked against the row count of the version it reads in the job that writes it."""
    dataset = _loaded(spark, read(spark, folder, "customer"))
    spec = table_source(dataset, "t", included_columns=["c_custkey", "c_name", "c_acctbal"], name="derived", write_disposition="replace")
    load(dataset, spec)
    return _stored(dataset, "derived")


def _data_files(dataset: Dataset, table: str = "t") -> int:
    """Data files of a table, listed by a version or not."""
    home = f"{dataset.root}/{dataset.schema}/{table}/data"
    return sum(fs.size_of(dataset.spark, f"{home}/{name}")[0] for name in fs.children(dataset.spark, home))


@query(
    "delete_by_mask",
    """
    SELECT c_custkey, c_name, c_acctbal, CAST(0 AS BIGINT) AS files_written FROM customer
    WHERE c_custkey NOT IN (SELECT user_id FROM events) AND c_custkey <> (SELECT max(c_custkey) FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events))
    """,
)
def delete_by_mask(spark, folder):
    """Two deletes, the second of a single key: neither writes a data file, and row counts, reads and a later merge go by the masks."""
    customers = read(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal")
    dataset = _loaded(spark, customers.repartition(8), primary_key="c_custkey", write_disposition="upsert")
    files = _data_files(dataset)
    delete_rows(dataset, "t", read(spark, folder, "events").select(F.col("user_id").alias("c_custkey")), ["c_custkey"])
    delete_rows(dataset, "t", dataset.table("t").agg(F.max("c_custkey").alias("c_custkey")), ["c_custkey"])
    written = _data_files(dataset) - files
    back = customers.where(F.col("c_custkey") == customers.agg(F.min("c_custkey")).first()[0])
    gone = delete_rows(dataset, "t", back.select("c_custkey"), ["c_custkey"])
    if gone:  # put back what the last delete took: a key is there once, whatever masks its former row
        load(dataset, LoadSpec("t", back, primary_key="c_custkey", write_disposition="upsert"))
    return _stored(dataset).withColumn("files_written", F.lit(written).cast("long"))


@query(
    "compact_masked",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN -o_totalprice ELSE o_totalprice END AS o_totalprice, TRUE AS no_masks
    FROM orders WHERE o_orderkey % 5 <> 0 UNION ALL SELECT -1, 0.0, TRUE
    """,
)
def compact_masked(spark, folder):
    """Masks of an update and a delete are gone after a compaction; a row appended while it ran stays."""
    orders = read(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    dataset = _loaded(spark, orders.repartition(6), primary_key="o_orderkey", write_disposition="upsert")
    update_rows(dataset, "t", orders.where("o_orderkey % 3 = 0").withColumn("o_totalprice", -F.col("o_totalprice")), ["o_orderkey"])
    delete_rows(dataset, "t", orders.where("o_orderkey % 5 = 0").select("o_orderkey"), ["o_orderkey"])
    publish, late = dataset.publish, spark.createDataFrame([(-1, 0.0)], "o_orderkey long, o_totalprice double")

    def overtaken(table, version):
        dataset.publish = publish
        load(Dataset(spark, dataset.root), LoadSpec("t", late))
        return publish(table, version)

    dataset.publish = overtaken
    dataset.compact("t", masked_share=0.1)
    return _stored(dataset).withColumn("no_masks", F.lit(not any("mask" in p for p in dataset.version("t").parts)))


@query(
    "upsert_scattered_keys",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey IN (SELECT o_orderkey FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR)) LIMIT 100)
           THEN 0.0 ELSE o_totalprice END AS o_totalprice FROM orders
    """,
)
def upsert_scattered_keys(spark, folder):
    """A hundred keys from all over the range: files are searched by the bloom filters of their key column."""
    orders = read(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    dataset = _loaded(spark, orders.repartition(40, F.xxhash64("o_orderkey")), primary_key="o_orderkey")
    some = orders.orderBy(F.md5(F.col("o_orderkey").cast("string"))).limit(100).withColumn("o_totalprice", F.lit(0.0))
    load(dataset, LoadSpec("t", some, primary_key="o_orderkey", write_disposition="upsert"))
    return _stored(dataset)


@query(
    "log_of_many_parts",
    """
    SELECT o_orderkey, o_orderstatus, TRUE AS checkpointed FROM orders
    UNION ALL SELECT o_orderkey + 1000000000, o_orderstatus, TRUE FROM orders WHERE o_orderstatus = 'F'
    """,
)
def log_of_many_parts(spark, folder):
    """A table of some hundred directories: its version files list what changed since a checkpoint of all parts."""
    orders = read(spark, folder, "orders").select("o_orderkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("o_orderdate"))
    dataset = new_dataset(spark)
    load(dataset, with_layout(LoadSpec("t", orders), ["o_orderstatus", ("o_orderdate", "month")]), load_id="old")
    more = orders.where("o_orderstatus = 'F'").withColumn("o_orderkey", F.col("o_orderkey") + 1000000000).withColumn("o_orderdate", F.lit(None).cast("date"))
    load(dataset, LoadSpec("t", more), load_id="new")
    return _stored(dataset).drop("o_orderdate").withColumn("checkpointed", F.lit(bool(dataset.version("t").base)))


@query("incremental_nan_cursor", "SELECT event_id, CASE WHEN event_type = 'error' THEN CAST('NaN' AS DOUBLE) ELSE value END AS value FROM events")
def incremental_nan_cursor(spark, folder):
    """NaN is no place a run can have got to: rows with one are loaded once, and others after them still land."""
    events = read(spark, folder, "events").select("event_id", F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value")).alias("value"))
    dataset = new_dataset(spark)
    for number, seen in enumerate((events.where("value < 50 or isnan(value)"), events, events)):
        spec = LoadSpec("events", seen, primary_key="event_id")
        load_incremental(dataset, spec, "value", pipeline="p", load_id=f"run-{number}", null_cursors="include")
    return _stored(dataset, "events")


@query(
    "nested_merge_widened_key",
    """
    WITH line AS (SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS line FROM documents)
    SELECT CAST(doc_id AS DECIMAL(21, 2)) AS doc_id, line, count(*) AS n FROM line WHERE lang <> 'de' GROUP BY ALL
    UNION ALL SELECT CAST(doc_id AS DECIMAL(21, 2)), lang, 1 FROM documents WHERE lang = 'de'
    """,
)
def nested_merge_widened_key(spark, folder):
    """The second batch brings the key as a decimal: its rows' children are still those of the first batch's rows."""
    documents = read(spark, folder, "documents")
    dataset = new_dataset(spark)
    as_line = lambda x: F.struct(x.alias("line"))
    lines = F.transform(F.split("text", "\n", -1), as_line).alias("lines")
    later = documents.where("lang = 'de'").select(F.col("doc_id").cast("decimal(12,2)").alias("doc_id"), F.array(as_line(F.col("lang"))).alias("lines"))
    for rows in (documents.select("doc_id", lines), later):
        load(dataset, LoadSpec("docs", rows, write_disposition="upsert", primary_key="doc_id", nested=True))
    return dataset.sql("select d.doc_id, l.line, count(*) n from docs d join public.docs__lines l on l._dlt_parent_id = d._dlt_id group by 1, 2")


@query(
    "sql_qualified_names",
    """
    SELECT o_orderstatus, count(*) AS n, max(o_orderkey) AS top FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY o_orderstatus
    """,
)
def sql_qualified_names(spark, folder):
    """Quoted, spaced and commented names, columns with all qualifiers, and a CTE that has the name of a table."""
    dataset = _loaded(spark, read(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"))
    load(dataset, LoadSpec("customer", read(spark, folder, "customer").select("c_custkey", "c_acctbal")))
    return dataset.sql(
        """
        with customer as (select * from /* public.t */ `public`.`customer` where public.customer.c_acctbal > :low)
        select public.t.o_orderstatus, count(*) as n, max(PUBLIC.T.o_orderkey) as top
        from public . t where o_custkey in (select c_custkey from customer) group by public.t.o_orderstatus -- from public.t
        """,
        {"low": 0},
    )


@query(
    "data_source_read",
    "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events) AND c_acctbal > 0",
)
def data_source_read(spark, folder):
    """A table with masked rows by ``spark.read.format``: a task per file, batches of at most a thousand rows, filters at the files."""
    dataset = _loaded(spark, read(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal").repartition(4))
    delete_rows(dataset, "t", read(spark, folder, "events").select(F.col("user_id").alias("c_custkey")), ["c_custkey"])
    register(spark)
    rows = spark.read.format("lodeworks").options(path=dataset.root, table="t", batch_rows=1000).load()
    return rows.where("c_acctbal > 0").drop(*_IDENTITY)


@query("stream_from_versions", "SELECT o_orderkey, o_orderstatus FROM orders")
def stream_from_versions(spark, folder):
    """A stream over a table's versions, stopped and started again between loads: each row comes once, a compaction brings none."""
    orders = read(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    dataset, base = new_dataset(spark), fs.shared_folder(spark)
    register(spark)
    for number, status in enumerate(("F", "O", "P")):
        load(dataset, LoadSpec("t", orders.where(F.col("o_orderstatus") == status)), load_id=f"load-{number}")
        stream = spark.readStream.format("lodeworks").options(path=dataset.root, table="t", on_rewrite="skip").load()
        writer = stream.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/check")
        writer.trigger(availableNow=True).start().awaitTermination()
        if number == 1:
            dataset.compact("t")
    return spark.read.parquet(f"{base}/out").drop(*_IDENTITY)


@query(
    "stream_first_rows",
    """
    WITH first AS (SELECT user_id, min(event_id % 3) AS f FROM events WHERE user_id NOT IN (SELECT s_suppkey FROM supplier) GROUP BY user_id)
    SELECT s_suppkey AS user_id, CAST(NULL AS BIGINT) AS event_id FROM supplier
    UNION ALL SELECT user_id, event_id FROM events JOIN first USING (user_id) WHERE event_id % 3 = f
    """,
)
def stream_first_rows(spark, folder):
    """An insert-only stream by state: of each key all rows of the micro-batch that brings it first, and none the table had."""
    events = read(spark, folder, "events").select("user_id", "event_id")
    dataset = _loaded(spark, read(spark, folder, "supplier").select(F.col("s_suppkey").alias("user_id")), primary_key="user_id")
    base = fs.shared_folder(spark)
    for number in range(3):
        events.where(F.col("event_id") % 3 == number).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{base}/in")
        spec = LoadSpec("t", stream, primary_key="user_id", write_disposition="insert-only")
        stream_insert_only(dataset, spec, checkpoint=f"{base}/check", query_name=f"first-{fs.unique('q')}").awaitTermination()
    return _stored(dataset)


@query("batches_for_a_consumer", "SELECT CAST(count(*) AS BIGINT) AS n, CAST(ceil(count(*) / 700.0) AS BIGINT) AS least_batches, TRUE AS bounded FROM orders")
def batches_for_a_consumer(spark, folder):
    """A table's rows in batches of at most 700 for a reader on the driver, checked against the published row count."""
    dataset = _loaded(spark, read(spark, folder, "orders").select("o_orderkey"))
    # tasks hold whole runs of 700 rows, so only the last batch can be short
    runs = number_batches(_stored(dataset), ["o_orderkey"], 700).repartitionByRange("batch").sortWithinPartitions("batch")
    sizes = [b.num_rows for b in read_batches(runs.drop("batch"), dataset.version("t").rows, 700)]
    return spark.range(1).select(F.lit(sum(sizes)).cast("long").alias("n"), F.lit(len(sizes)).cast("long").alias("least_batches"), F.lit(max(sizes) <= 700).alias("bounded"))
