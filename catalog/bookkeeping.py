"""Load log, schema versions, state, incremental loads."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from catalog.registry import new_dataset, query, read
from lodeworks import LoadSpec, load, load_incremental, stream_load
from lodeworks.operators import bookkeeping as ops
from lodeworks.plans import files as fs

# Every event as a state row of its type's pipeline; every event but errors as a load, failed
# if its value is high.
_STATE = """
    SELECT event_type AS pipeline_name, lpad(CAST(event_id AS VARCHAR), 12, '0') AS _dlt_load_id,
           CAST(event_id AS VARCHAR) AS _dlt_id, props AS state FROM events
"""
_LOADS = """
    SELECT lpad(CAST(event_id AS VARCHAR), 12, '0') AS load_id, CASE WHEN value > 50 THEN 1 ELSE 0 END AS status
    FROM events WHERE event_type <> 'error'
"""


def _state(spark, folder):
    return read(spark, folder, "events").select(
        F.col("event_type").alias("pipeline_name"),
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("_dlt_load_id"),
        F.col("event_id").cast("string").alias("_dlt_id"),
        F.col("props").alias("state"),
    )


def _loads(spark, folder):
    return read(spark, folder, "events").where("event_type <> 'error'").select(
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("load_id"),
        F.when(F.col("value") > 50, 1).otherwise(0).alias("status"),
    )


@query(
    "latest_state",
    f"""
    WITH s AS ({_STATE}), l AS ({_LOADS}),
         r AS (SELECT s.*, row_number() OVER (PARTITION BY pipeline_name ORDER BY _dlt_load_id DESC) AS rn
               FROM s JOIN l ON l.load_id = s._dlt_load_id WHERE l.status = 0)
    SELECT pipeline_name, _dlt_load_id, _dlt_id, state FROM r WHERE rn = 1
    """,
)
def latest_state(spark, folder):
    return ops.latest_state(_state(spark, folder), _loads(spark, folder))


@query(
    "latest_state_of_one",
    f"""
    WITH s AS ({_STATE}), l AS ({_LOADS})
    SELECT s.* FROM s JOIN l ON l.load_id = s._dlt_load_id WHERE s.pipeline_name = 'purchase' AND l.status = 0
    ORDER BY s._dlt_load_id DESC LIMIT 1
    """,
)
def latest_state_of_one(spark, folder):
    return ops.latest_state(_state(spark, folder), _loads(spark, folder), "purchase")


def _newest(n: int) -> str:
    return f"""
    WITH s AS ({_STATE}),
         r AS (SELECT *, row_number() OVER (PARTITION BY pipeline_name ORDER BY _dlt_load_id DESC) AS rn FROM s),
         kept AS (SELECT * FROM r WHERE rn <= {n})
    SELECT pipeline_name, _dlt_load_id, _dlt_id, state FROM r
    WHERE rn <= {n} OR (SELECT count(*) FROM r) - (SELECT count(*) FROM kept) < {n}
    """


@query("prune_state", _newest(100))
def prune_state(spark, folder):
    return ops.prune_state(_state(spark, folder), 100)


@query("prune_state_wide", _newest(1500))
def prune_state_wide(spark, folder):
    """A retention window beyond what the engine pre-filters per task."""
    return ops.prune_state(_state(spark, folder), 1500)


@query("prune_state_below_threshold", _newest(1900))
def prune_state_below_threshold(spark, folder):
    """Fewer rows than the window would go, so all stay (at the checked scale)."""
    return ops.prune_state(_state(spark, folder), 1900)


_VERSIONS = """
    SELECT doc_id AS version, source AS schema_name, sha256(source || '|' || CAST(n_chars AS VARCHAR)) AS version_hash,
           doc_id AS inserted_at, lang AS "schema" FROM documents
"""


def _versions(spark, folder):
    return read(spark, folder, "documents").select(
        F.col("doc_id").alias("version"),
        F.col("source").alias("schema_name"),
        F.sha2(F.concat_ws("|", "source", F.col("n_chars").cast("string")), 256).alias("version_hash"),
        F.col("doc_id").alias("inserted_at"),
        F.col("lang").alias("schema"),
    )


@query(
    "schema_version_dedup",
    f"""
    WITH c AS ({_VERSIONS}), stored AS (SELECT c.* FROM c JOIN labels ON doc_id = version),
         r AS (SELECT *, row_number() OVER (PARTITION BY version_hash ORDER BY inserted_at, version) AS rn FROM c
               WHERE version_hash NOT IN (SELECT version_hash FROM stored))
    SELECT version, schema_name, version_hash, inserted_at, "schema" FROM r WHERE rn = 1
    """,
)
def schema_version_dedup(spark, folder):
    """Candidate schemas whose hash is not stored yet, each once."""
    candidates = _versions(spark, folder)
    labelled = read(spark, folder, "labels").select(F.col("doc_id").alias("version"))
    return ops.new_versions(candidates.join(labelled, "version", "left_semi"), candidates)


@query("latest_schema", f"SELECT * FROM ({_VERSIONS}) WHERE schema_name = 'src1' ORDER BY inserted_at DESC LIMIT 1")
def latest_schema(spark, folder):
    return ops.latest_schema(_versions(spark, folder), "src1")


@query(
    "schema_by_hash",
    f"""
    WITH c AS ({_VERSIONS}), newest AS (SELECT version_hash FROM c ORDER BY inserted_at DESC LIMIT 1)
    SELECT version_hash, schema_name FROM c WHERE version_hash = (SELECT version_hash FROM newest) LIMIT 1
    """,
)
def schema_by_hash(spark, folder):
    versions = _versions(spark, folder)
    wanted = ops.latest_schema(versions).select("version_hash").first()[0]
    return ops.schema_by_hash(versions, wanted).select("version_hash", "schema_name")


@query(
    "load_log",
    """
    SELECT load_id, 'shop' AS schema_name, CAST(0 AS BIGINT) AS status, n AS row_count
    FROM (VALUES ('2024-01'), ('2024-02')) l(load_id), (SELECT count(*) AS n FROM orders)
    UNION ALL SELECT '2024-03', 'shop', 0, (SELECT count(*) FROM orders)
    """,
)
def load_log(spark, folder):
    """Three completed loads, one of them run twice, and the rows each brought."""
    orders = read(spark, folder, "orders")
    dataset = new_dataset(spark)
    for load_id in ("2024-01", "2024-02", "2024-02", "2024-03"):
        load(dataset, LoadSpec("orders", orders), load_id=load_id, schema_name="shop")
    log = dataset.bookkeeping(ops.LOADS_TABLE)
    rows = dataset.table("orders").groupBy(F.col("_dlt_load_id").alias("load_id")).agg(F.count(F.lit(1)).alias("row_count"))
    return log.join(rows, "load_id").select("load_id", "schema_name", "status", "row_count")


@query(
    "load_report",
    """
    SELECT 'lineitem' AS "table", l_returnflag AS batch, count(*) AS "rows" FROM lineitem GROUP BY l_returnflag
    """,
)
def load_report(spark, folder):
    """The report of a package, its lines added up per batch directory."""
    path = fs.shared_folder(spark) + "/package"
    read(spark, folder, "lineitem").write.partitionBy("l_returnflag").parquet(path)
    batches = [f"{path}/{name}" for name in fs.children(spark, path) if "=" in name]
    report = load(new_dataset(spark), LoadSpec("lineitem", batches))
    batch = F.regexp_extract("file", "l_returnflag=([^/]*)/", 1).alias("batch")
    return report.groupBy("table", batch).agg(F.sum("rows").alias("rows"))


@query(
    "row_identity",
    """
    SELECT o_orderkey, 'load-1' AS _dlt_load_id, sha256('6:load-1|' || length(CAST(o_orderkey AS VARCHAR)) || ':' || CAST(o_orderkey AS VARCHAR)) AS _dlt_id FROM orders
    """,
)
def row_identity(spark, folder):
    dataset = new_dataset(spark)
    load(dataset, LoadSpec("orders", read(spark, folder, "orders"), order_by=["o_orderkey"]), load_id="load-1")
    return dataset.table("orders").select("o_orderkey", "_dlt_load_id", "_dlt_id")


@query("incremental_append", "SELECT event_id, user_id, event_type, value FROM events")
def incremental_append(spark, folder):
    """Three runs over a growing source: every event lands exactly once."""
    events = read(spark, folder, "events")
    dataset = new_dataset(spark)
    for number, seen in enumerate((events.where("ts <= timestamp_ntz'2024-01-15 00:00:00'"), events, events)):
        load_incremental(dataset, LoadSpec("events", seen), "ts", pipeline="p", load_id=f"run-{number}")
    return dataset.table("events").select("event_id", "user_id", "event_type", "value")


@query("incremental_closed", "SELECT o_orderkey, o_totalprice FROM orders")
def incremental_closed(spark, folder):
    """The same with a cursor many rows share: the last value is read again, told apart by key."""
    orders = read(spark, folder, "orders")
    dataset = new_dataset(spark)
    early = orders.where("o_orderdate < timestamp_ntz'1998-06-01' or (o_orderdate = timestamp_ntz'1998-06-01' and o_orderstatus = 'F')")
    for number, seen in enumerate((early, orders, orders)):
        spec = LoadSpec("orders", seen, primary_key="o_orderkey")
        load_incremental(dataset, spec, "o_orderdate", pipeline="p", load_id=f"run-{number}", closed=True)
    return dataset.table("orders").select("o_orderkey", "o_totalprice")


@query(
    "stream_upsert",
    """
    SELECT user_id, event_id, event_type, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1
    """,
)
def stream_upsert(spark, folder):
    """Events as files that arrive in three lots; each lot is a micro-batch, upserted per user."""
    everything = read(spark, folder, "events")
    events = everything.select("user_id", "event_id", "event_type", "value")
    root = fs.shared_folder(spark)
    fs.make_directory(spark, f"{root}/incoming")
    days = F.dayofmonth("ts")
    stream = spark.readStream.schema(events.schema).parquet(f"{root}/incoming")
    dataset = new_dataset(spark)
    spec = LoadSpec("latest", stream, write_disposition="upsert", primary_key="user_id", order_by=["event_id"])
    for arrived in (days <= 10, (days > 10) & (days <= 20), days > 20):
        everything.where(arrived).select(events.columns).write.mode("append").parquet(f"{root}/incoming")
        stream_load(dataset, spec, checkpoint=f"{root}/checkpoint", query_name="latest").awaitTermination()
    # a batch that comes again after a failure changes nothing, also if others came since
    load(dataset, replace(spec, data=events.withColumn("value", F.lit(-1.0))), load_id=f"latest:{0:012d}")
    return dataset.table("latest").select("user_id", "event_id", "event_type", "value")
