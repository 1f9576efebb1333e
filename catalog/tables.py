"""Tables of a dataset: sinks, lifecycle, layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalog.registry import new_dataset, query, read
from lodeworks import IncompleteReadError, LoadSpec, export_batches, load, number_batches, query_source, table_source, verified_read, with_layout
from lodeworks.plans import files as fs
from lodeworks.plans.loader import declare_tables
from lodeworks.sources.verified import deliver

_IDENTITY = ("_dlt_id", "_dlt_load_id")
_ALL = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
        "conversations").split()
_LOADED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "labels", "embeddings")


@query("table_scan", "SELECT * FROM supplier")
def table_scan(spark, folder):
    dataset = new_dataset(spark)
    load(dataset, LoadSpec("supplier", read(spark, folder, "supplier")))
    return dataset.table("supplier").drop(*_IDENTITY)


@query(
    "replace_multi_file",
    "SELECT o_orderkey, o_custkey, round(o_totalprice * 2, 4) AS o_totalprice FROM orders",
)
def replace_multi_file(spark, folder):
    """A replace keeps every file of its package and nothing of what was there."""
    orders = read(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    dataset = new_dataset(spark)
    load(dataset, LoadSpec("orders", orders, write_disposition="replace"))
    path = fs.shared_folder(spark) + "/package"
    doubled = orders.withColumn("o_totalprice", F.round(F.col("o_totalprice") * 2, 4))
    doubled.repartition("o_custkey").write.option("maxRecordsPerFile", 4000).parquet(path)
    load(dataset, LoadSpec("orders", fs.data_files(spark, path), write_disposition="replace"))
    return dataset.table("orders").drop(*_IDENTITY)


@query(
    "truncate_keeps_schema",
    """
    SELECT name, type, (SELECT count(*) FROM orders) AS rows_before, CAST(0 AS BIGINT) AS rows_after
    FROM (VALUES ('o_orderkey', 'bigint'), ('o_custkey', 'bigint'), ('o_orderstatus', 'string'),
                 ('o_totalprice', 'double'), ('o_orderdate', 'timestamp_ntz'), ('o_orderpriority', 'string')) t(name, type)
    """,
)
def truncate_keeps_schema(spark, folder):
    dataset = new_dataset(spark)
    load(dataset, LoadSpec("orders", read(spark, folder, "orders")))
    before = dataset.version("orders").rows
    dataset.truncate(["orders"])
    counted = dataset.row_counts(["orders"]).withColumnRenamed("row_count", "rows_after")
    stored = [("orders", before, *c) for c in dataset.table("orders").dtypes if c[0] not in _IDENTITY]
    columns = spark.createDataFrame(stored, "table string, rows_before bigint, name string, type string")
    return columns.join(counted, "table").select("name", "type", "rows_before", "rows_after")


@query(
    "evolve_new_table",
    "SELECT 'orders' AS \"table\", count(*) AS row_count FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem",
)
def evolve_new_table(spark, folder):
    dataset = new_dataset(spark)
    load(dataset, LoadSpec("orders", read(spark, folder, "orders")))
    load(dataset, LoadSpec("lineitem", read(spark, folder, "lineitem")))
    return dataset.row_counts(["orders", "lineitem"])


@query(
    "evolve_types_in_place",
    """
    SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size, CAST(NULL AS VARCHAR) AS note FROM part
    UNION ALL SELECT p_partkey, p_size + 0.5, p_brand FROM part
    """,
)
def evolve_types_in_place(spark, folder):
    """An append that widens a type and adds a column; what is stored is not rewritten."""
    part = read(spark, folder, "part")
    dataset = new_dataset(spark)
    load(dataset, LoadSpec("part", part.select(F.col("p_partkey").cast("int").alias("p_partkey"), "p_size")))
    wider = part.select("p_partkey", (F.col("p_size") + F.lit(0.5).cast("double")).alias("p_size"), F.col("p_brand").alias("note"))
    load(dataset, LoadSpec("part", wider))
    return dataset.table("part").drop(*_IDENTITY)


@query(
    "derive_table",
    """
    SELECT c_custkey, c_mktsegment, round(sum(o_totalprice), 2) AS spend, count(*) AS orders
    FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_mktsegment
    """,
)
def derive_table(spark, folder):
    """A query over one dataset loaded as a table of another."""
    source, target = new_dataset(spark), new_dataset(spark)
    load(source, [LoadSpec(t, read(spark, folder, t)) for t in ("customer", "orders")])
    text = """
        SELECT c_custkey, c_mktsegment, round(sum(o_totalprice), 2) AS spend, count(*) AS orders
        FROM public.customer JOIN public.orders ON c_custkey = o_custkey GROUP BY c_custkey, c_mktsegment
    """
    load(target, query_source(source, text, name="spend", write_disposition="replace"))
    return target.table("spend").drop(*_IDENTITY)


@query(
    "merge_story",
    """
    WITH inc AS (SELECT c_nationkey, c_custkey + 100 AS c_custkey, c_mktsegment, round(c_acctbal + 100, 2) AS c_acctbal,
                        c_acctbal < 0 AS deleted FROM customer),
         merged AS (SELECT c_nationkey, c_custkey, c_mktsegment, c_acctbal FROM customer c
                    WHERE NOT EXISTS (SELECT 1 FROM inc WHERE inc.c_nationkey = c.c_nationkey AND inc.c_custkey = c.c_custkey)
                    UNION ALL SELECT c_nationkey, c_custkey, c_mktsegment, c_acctbal FROM inc WHERE NOT deleted)
    SELECT c_mktsegment, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM merged GROUP BY c_mktsegment
    """,
)
def merge_story(spark, folder):
    """A keyless replace, then a merge on a composite key with deletes, then a report."""
    customers = read(spark, folder, "customer").select("c_nationkey", "c_custkey", "c_mktsegment", "c_acctbal")
    dataset = new_dataset(spark)
    load(dataset, LoadSpec("customer", customers.withColumn("deleted", F.lit(False)), write_disposition="replace"))
    changes = customers.withColumns(
        {
            "c_custkey": F.col("c_custkey") + 100,
            "c_acctbal": F.round(F.col("c_acctbal") + 100, 2),
            "deleted": F.col("c_acctbal") < 0,
        }
    )
    spec = LoadSpec(
        "customer",
        changes,
        write_disposition="merge",
        primary_key=["c_nationkey", "c_custkey"],
        columns={"deleted": {"hard_delete": True}},
    )
    load(dataset, spec)
    return dataset.table("customer").groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance")
    )


@query(
    "typed_roundtrip",
    """
    SELECT event_id, event_type, value, value > 50 AS high, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts,
           strftime(ts, '%Y-%m-%d') AS day, printf('%.2f', value) AS amount,
           CASE WHEN event_type <> 'view' THEN user_id END AS maybe,
           'timestamp_ntz' AS ts_type, 'date' AS day_type, 'decimal(12,2)' AS amount_type, 'bigint' AS maybe_type
    FROM events
    """,
)
def typed_roundtrip(spark, folder):
    events = read(spark, folder, "events").select(
        "event_id",
        "event_type",
        "value",
        (F.col("value") > 50).alias("high"),
        "ts",
        F.to_date("ts").alias("day"),
        F.col("value").cast("decimal(12,2)").alias("amount"),
        F.when(F.col("event_type") != "view", F.col("user_id")).alias("maybe"),
    )
    dataset = new_dataset(spark)
    load(dataset, LoadSpec("typed", events))
    stored = dataset.table("typed").drop(*_IDENTITY)
    types = {f"{c}_type": F.expr(f"typeof({c})") for c in ("ts", "day", "amount", "maybe")}
    return stored.withColumns(types).withColumns(
        {
            "ts": F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
            "day": F.date_format("day", "yyyy-MM-dd"),
            "amount": F.col("amount").cast("string"),
        }
    )


def _fourteen(spark, folder):
    dataset = new_dataset(spark)
    declare_tables(dataset, _ALL)
    load(dataset, [LoadSpec(t, read(spark, folder, t)) for t in _LOADED])
    return dataset


@query(
    "list_tables",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", TRUE AS loaded, count(*) AS row_count FROM {t}"
        if t in _LOADED
        else f"SELECT '{t}', FALSE, CAST(0 AS BIGINT)"
        for t in [*_LOADED, *(t for t in _ALL if t not in _LOADED)]
    )
    + ") t",
)
def list_tables(spark, folder):
    """All tables declared, ten loaded."""
    return _fourteen(spark, folder).list_tables(_ALL)


@query(
    "row_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS row_count FROM {t}" for t in _ALL),
)
def row_counts(spark, folder):
    dataset = _fourteen(spark, folder)
    load(dataset, [LoadSpec(t, read(spark, folder, t)) for t in _ALL if t not in _LOADED])
    return dataset.row_counts(_ALL)


# -- layout ------------------------------------------------------------------------------


def _laid_out(spark, rows: DataFrame, partition_by, sorted_by=None):
    dataset = new_dataset(spark)
    load(dataset, with_layout(LoadSpec("t", rows), partition_by=partition_by, sorted_by=sorted_by))
    return dataset


def _by_partition(dataset, name: str, value: str) -> DataFrame:
    """Rows and sum per stored directory value."""
    version = dataset.version("t")
    rows = dataset.scan("t", version).withColumnRenamed(version.partitions[0].derived, name)
    return rows.groupBy(name).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(value), 2).alias("total"))


@query("partition_identity", "SELECT event_type AS p, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def partition_identity(spark, folder):
    return _by_partition(_laid_out(spark, read(spark, folder, "events"), ["event_type"]), "p", "value")


def _partition_sql(table: str, column: str, pattern: str, value: str) -> str:
    return f"SELECT strftime({column}, '{pattern}') AS p, count(*) AS n, round(sum({value}), 2) AS total FROM {table} GROUP BY 1"


@query("partition_year", _partition_sql("orders", "o_orderdate", "%Y", "o_totalprice"))
def partition_year(spark, folder):
    return _by_partition(_laid_out(spark, read(spark, folder, "orders"), [("o_orderdate", "year")]), "p", "o_totalprice")


@query("partition_month", _partition_sql("orders", "o_orderdate", "%Y-%m", "o_totalprice"))
def partition_month(spark, folder):
    return _by_partition(_laid_out(spark, read(spark, folder, "orders"), [("o_orderdate", "month")]), "p", "o_totalprice")


@query("partition_day", _partition_sql("events", "ts", "%Y-%m-%d", "value"))
def partition_day(spark, folder):
    return _by_partition(_laid_out(spark, read(spark, folder, "events"), [("ts", "day")]), "p", "value")


@query("partition_hour", _partition_sql("events", "ts", "%Y-%m-%d-%H", "value"))
def partition_hour(spark, folder):
    return _by_partition(_laid_out(spark, read(spark, folder, "events"), [("ts", "hour")]), "p", "value")


@query(
    "partition_pruned_read",
    """
    SELECT event_id, user_id, value FROM events
    WHERE ts BETWEEN TIMESTAMP '2024-01-10 06:00:00' AND TIMESTAMP '2024-01-12 18:00:00'
    """,
)
def partition_pruned_read(spark, folder):
    """A bound on the base column reads only the days it covers."""
    dataset = _laid_out(spark, read(spark, folder, "events"), [("ts", "day")])
    rows = dataset.table("t", between=("ts", "2024-01-10 06:00:00", "2024-01-12 18:00:00"))
    return rows.select("event_id", "user_id", "value")


@query("sorted_layout", "SELECT event_id, user_id, event_type, value FROM events")
def sorted_layout(spark, folder):
    rows = read(spark, folder, "events").select("event_id", "user_id", "event_type", "value", "ts")
    dataset = _laid_out(spark, rows, [("ts", "day")], [("user_id", "desc", "last"), "event_id"])
    return dataset.table("t").select("event_id", "user_id", "event_type", "value")


@query(
    "sorted_files",
    "SELECT event_id, user_id, value, CAST(0 AS BIGINT) AS overlaps FROM events WHERE user_id BETWEEN 100 AND 200",
)
def sorted_files(spark, folder):
    """Files of a sorted table hold ranges of the sort key that do not overlap; a read between two values opens those in reach."""
    rows = read(spark, folder, "events").select("event_id", "user_id", "value")
    dataset = _laid_out(spark, rows, None, ["user_id"])
    file = F.col("_metadata.file_path")
    stored = dataset.scan("t", dataset.version("t"))
    ends = stored.groupBy(file.alias("file")).agg(F.min("user_id").alias("low"), F.max("user_id").alias("high"))  # a row per file
    before = Window.orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1)
    overlaps = ends.withColumn("reached", F.max("high").over(before)).where("low < reached").count()
    return dataset.table("t", between=("user_id", 100, 200)).select("event_id", "user_id", "value", F.lit(overlaps).cast("long").alias("overlaps"))


# -- reads and exports -------------------------------------------------------------------


@query("verified_read", "SELECT count(*) AS expected, count(*) AS received, 'complete' AS verdict FROM lineitem")
def verified(spark, folder):
    dataset = new_dataset(spark)
    load(dataset, LoadSpec("lineitem", read(spark, folder, "lineitem")))
    copy = verified_read(dataset, "lineitem", fs.shared_folder(spark) + "/copy")
    expected = F.lit(dataset.version("lineitem").rows).cast("bigint")
    received = copy.agg(F.count(F.lit(1)).alias("received"))
    verdict = F.when(F.col("received") == expected, "complete").otherwise("incomplete")
    return received.select(expected.alias("expected"), "received", verdict.alias("verdict"))


@query("verified_content", "SELECT c_custkey, c_name, c_acctbal, true AS refused FROM customer UNION ALL SELECT c_custkey, c_name, c_acctbal, true FROM customer")
def verified_content(spark, folder):
    """A copy is held to the sums that two loads took as they wrote; one with a single other value is refused."""
    dataset = new_dataset(spark)
    rows = read(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal")
    for _ in range(2):
        load(dataset, LoadSpec("customer", rows))
    version, place = dataset.version("customer"), fs.shared_folder(spark)
    sums = dataset.content_of("customer", version)
    wrong = dataset.table("customer").withColumn("c_acctbal", F.col("c_acctbal") + F.when(F.col("c_custkey") == 1, 1).otherwise(0))
    try:
        deliver(wrong, f"{place}/wrong", version.rows, sums=sums)
        refused = False
    except IncompleteReadError:
        refused = True
    copy = verified_read(dataset, "customer", f"{place}/copy")
    return copy.select("c_custkey", "c_name", "c_acctbal", F.lit(refused).alias("refused"))


@query(
    "batched_export",
    """
    SELECT CAST(floor(n / 25000) AS BIGINT) AS batch, count(*) AS "rows", round(sum(l_quantity), 2) AS quantity FROM (
        SELECT l_quantity, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey,
               l_extendedprice, l_quantity, l_discount, l_tax, l_shipdate, l_returnflag, l_linestatus) - 1 AS n FROM lineitem)
    GROUP BY 1
    """,
)
def batched_export(spark, folder):
    """Numbered batches of a total order, without bringing the rows into one task."""
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount",
             "l_tax", "l_shipdate", "l_returnflag", "l_linestatus"]
    numbered = number_batches(read(spark, folder, "lineitem"), order, 25_000)
    return numbered.groupBy("batch").agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query(
    "batched_export_files",
    "SELECT count(*) AS \"rows\", CAST(0 AS BIGINT) AS oversized FROM lineitem",
)
def batched_export_files(spark, folder):
    """Files of at most 7,000 rows: every row is there and no file is larger."""
    files = export_batches(read(spark, folder, "lineitem"), fs.shared_folder(spark) + "/export", 7_000)
    return files.agg(F.sum("rows").alias("rows"), F.count_if(F.col("rows") > 7_000).alias("oversized"))


@query("source_table_projected", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def source_table_projected(spark, folder):
    source, target = new_dataset(spark), new_dataset(spark)
    load(source, LoadSpec("orders", read(spark, folder, "orders")))
    columns = ["o_orderkey", "o_custkey", "o_totalprice"]
    load(target, table_source(source, "orders", included_columns=columns, write_disposition="replace"))
    return target.table("orders").select(columns)


@query("source_table_limited", "SELECT least(1000, count(*)) AS row_count FROM orders")
def source_table_limited(spark, folder):
    """A source with a limit gives that many rows, whichever they are."""
    source = new_dataset(spark)
    load(source, LoadSpec("orders", read(spark, folder, "orders")))
    return table_source(source, "orders", limit=1000).data.agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "source_query_spend",
    "SELECT o_custkey, round(sum(o_totalprice), 2) AS spend FROM orders GROUP BY o_custkey",
)
def source_query_spend(spark, folder):
    source = new_dataset(spark)
    load(source, LoadSpec("orders", read(spark, folder, "orders")))
    text = "SELECT o_custkey, round(sum(o_totalprice), 2) AS spend FROM orders GROUP BY o_custkey"
    return query_source(source, text, name="spend").data


# -- dataset read API --------------------------------------------------------------------


def _with(spark, folder, *tables):
    dataset = new_dataset(spark)
    load(dataset, [LoadSpec(t, read(spark, folder, t)) for t in tables])
    return dataset


@query(
    "raw_sql_aggregate",
    """
    SELECT l_returnflag, round(avg(l_quantity), 4) AS avg_quantity, count(*) AS n FROM lineitem
    WHERE l_linestatus <> 'it''s none' GROUP BY l_returnflag
    """,
)
def raw_sql_aggregate(spark, folder):
    text = """
        SELECT l_returnflag, round(avg(l_quantity), 4) AS avg_quantity, count(*) AS n FROM public.lineitem
        WHERE l_linestatus <> :status GROUP BY l_returnflag
    """
    return _with(spark, folder, "lineitem").sql(text, {"status": "it's none"})


@query(
    "fluent_select_where_order_limit",
    """
    SELECT o_orderkey, o_totalprice FROM (SELECT *, o_orderstatus = 'F' AS done FROM orders) WHERE done
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 25
    """,
)
def fluent(spark, folder):
    orders = _with(spark, folder, "orders").table("orders").withColumn("done", F.col("o_orderstatus") == "F")
    chosen = orders.where("done").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)
    return chosen.select("o_orderkey", "o_totalprice")


@query(
    "group_agg_ordered",
    """
    SELECT c_mktsegment, count(*) AS orders, round(sum(o_totalprice), 2) AS spend, round(avg(o_totalprice), 4) AS mean
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment ORDER BY c_mktsegment
    """,
)
def group_agg_ordered(spark, folder):
    dataset = _with(spark, folder, "orders", "customer")
    joined = dataset.table("orders").join(dataset.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("orders"),
        F.round(F.sum("o_totalprice"), 2).alias("spend"),
        F.round(F.avg("o_totalprice"), 4).alias("mean"),
    ).orderBy("c_mktsegment")


@query(
    "top_k_spend",
    """
    SELECT o_custkey, round(sum(o_totalprice), 2) AS spend FROM orders GROUP BY o_custkey
    ORDER BY spend DESC, o_custkey LIMIT 3
    """,
)
def top_k_spend(spark, folder):
    orders = _with(spark, folder, "orders").table("orders")
    spend = orders.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("spend"))
    return spend.orderBy(F.desc("spend"), "o_custkey").limit(3)
