import json

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeworks import (
    ConcurrentPublishError,
    Dataset,
    LoadSpec,
    UndefinedDatasetError,
    UndefinedTableError,
    delete_rows,
    load,
    update_rows,
)
from lodeworks.operators.bookkeeping import INTERNAL_TABLES
from lodeworks.plans import files as fs
from lodeworks.plans.loader import declare_tables
from lodeworks.spec import declared_tables


def orders(spark, *ids):
    return spark.createDataFrame([(i, f"v{i}") for i in ids], "id long, v string")


def test_open_create_pin_drop(spark, tmp_path):
    root = str(tmp_path / "my-data_Set")
    with pytest.raises(UndefinedDatasetError):
        Dataset.init(spark, root, create=False)
    assert not Dataset(spark, root).is_initialized()
    dataset = Dataset.init(spark, root, name="Label, not identity")
    assert Dataset.init(spark, root, create=False).name == "Label, not identity"
    load(dataset, LoadSpec("t", orders(spark, 1)))
    dataset.drop()
    assert not fs.exists(spark, root)
    dataset.drop()


def test_drop_refuses_what_is_not_a_dataset(spark, tmp_path):
    (tmp_path / "precious").mkdir()
    with pytest.raises(UndefinedDatasetError):
        Dataset(spark, str(tmp_path / "precious")).drop()
    assert (tmp_path / "precious").exists()


def test_declared_table_set():
    got = declared_tables(["Orders-Events", "orders_events", "_x"], INTERNAL_TABLES)
    assert got == sorted(["orders_events", "_x", "_dlt_loads", "_dlt_pipeline_state", "_dlt_version"])


def test_declaring_leaves_existing_tables_alone(spark, dataset):
    load(dataset, LoadSpec("a", orders(spark, 1, 2)))
    declare_tables(dataset, ["a", "b"])
    assert rows(dataset.list_tables(["a", "b"])) == [("a", True, 2), ("b", False, 0)]
    assert dataset.table("b").count() == 0
    load(dataset, LoadSpec("b", orders(spark, 5)))
    assert rows(dataset.table("b").select("id", "v")) == [(5, "v5")]


def test_truncate(spark, dataset):
    load(dataset, LoadSpec("t", orders(spark, 1, 2)))
    declare_tables(dataset, ["untyped"])
    dataset.truncate(["t", "_dlt_loads", "untyped", "unknown"])
    assert dataset.table("t").columns[:2] == ["id", "v"] and dataset.table("t").count() == 0
    assert dataset.table("_dlt_loads").count() == 1
    load(dataset, LoadSpec("t", orders(spark, 3)))
    assert dataset.table("t").count() == 1


def test_replace_keeps_every_file_and_nothing_older(spark, dataset, tmp_path):
    load(dataset, LoadSpec("t", orders(spark, 7, 8), write_disposition="replace"))
    for i, ids in enumerate([(1, 2), (3,), (4, 5, 6)]):
        orders(spark, *ids).coalesce(1).write.parquet(str(tmp_path / f"f{i}"))
    report = load(dataset, LoadSpec("t", [str(tmp_path / f"f{i}") for i in range(3)], write_disposition="replace"))
    assert rows(dataset.table("t").select("id")) == [(i,) for i in range(1, 7)]
    assert sum(r["rows"] for r in report.collect()) == 6


def test_a_failed_load_leaves_the_table_as_it_was(spark, dataset):
    load(dataset, LoadSpec("t", orders(spark, 1, 2)))
    broken = orders(spark, 3).withColumn("v", F.raise_error(F.lit("boom")).cast("string"))
    for disposition in ("append", "replace", "upsert"):
        with pytest.raises(Exception, match="boom"):
            load(dataset, LoadSpec("t", broken, write_disposition=disposition, primary_key="id"))
    assert rows(dataset.table("t").select("id")) == [(1,), (2,)]
    assert dataset.bookkeeping("_dlt_loads").count() == 1


def test_two_writers_of_one_version(spark, dataset):
    load(dataset, LoadSpec("t", orders(spark, 1)))
    version = dataset.version("t")
    dataset.publish("t", version)
    with pytest.raises(ConcurrentPublishError):
        dataset.publish("t", version)


def test_a_reader_keeps_its_version_until_vacuum(spark, dataset):
    load(dataset, LoadSpec("t", orders(spark, 1, 2)))
    old = dataset.table("t")
    load(dataset, LoadSpec("t", orders(spark, 3), write_disposition="replace"))
    assert old.count() == 2
    assert dataset.vacuum("t", keep=1) == 1
    assert rows(dataset.table("t").select("id")) == [(3,)]


def test_vacuum_leaves_running_loads_alone(spark, dataset):
    load(dataset, LoadSpec("t", orders(spark, 1, 2)))
    version = dataset.version("t")
    written = dataset.write_parts("t", version, orders(spark, 3))  # a load that has not published yet
    load(dataset, LoadSpec("t", orders(spark, 4)))
    assert dataset.vacuum("t", keep=1) == 0
    dataset.publish_append("t", dataset.version("t"), written.parts, written.rows)
    assert rows(dataset.table("t").select("id")) == [(1,), (2,), (3,), (4,)]
    dataset.write_parts("t", dataset.version("t"), orders(spark, 5))
    assert dataset.vacuum("t", orphan_hours=-1) == 1 and dataset.table("t").count() == 4


def test_upsert_may_read_the_table_it_replaces(spark, dataset):
    load(dataset, LoadSpec("t", orders(spark, 1, 2)))
    doubled = dataset.table("t").select("id", F.concat("v", "v").alias("v"))
    load(dataset, LoadSpec("t", doubled, write_disposition="replace"))
    assert rows(dataset.table("t").select("v")) == [("v1v1",), ("v2v2",)]


def test_delete_and_update_in_place(spark, dataset):
    load(dataset, LoadSpec("t", orders(spark, 1, 2, 3)))
    assert delete_rows(dataset, "t", spark.createDataFrame([(2,), (2,), (9,)], "id int"), ["id"]) == 1
    change = spark.createDataFrame([(3, "new"), (9, "x")], "id long, v string")
    assert update_rows(dataset, "t", change, ["id"]) == 1
    assert rows(dataset.table("t").select("id", "v")) == [(1, "v1"), (3, "new")]
    assert dataset.version("t").rows == 2
    assert delete_rows(dataset, "t", orders(spark, 1, 3), ["id"]) == 2
    assert dataset.table("t").count() == 0 and dataset.table("t").columns[:2] == ["id", "v"]


def test_sql_resolves_bare_and_qualified_names(spark, dataset):
    load(dataset, LoadSpec("t", orders(spark, 1, 2)))
    assert dataset.sql("select 'public.t' as s, count(*) n from public.t join t u using (id)").first().asDict() == {
        "s": "public.t",
        "n": 2,
    }
    assert dataset.sql("select id from t where v = :v", {"v": "v2' or '1'='1"}).count() == 0
    with pytest.raises(UndefinedTableError):
        dataset.sql("select * from public.missing_table")
    with pytest.raises(UndefinedTableError):
        dataset.table("missing_table")


def test_sql_names_as_the_parser_reads_them(spark, dataset):
    load(dataset, LoadSpec("t", orders(spark, 1, 2)))
    load(dataset, LoadSpec("u", orders(spark, 2, 3, 4)))
    for query, want in (
        ("select count(*) from `public`.`t`", 2),
        ("select count(*) from public . t", 2),
        ("select count(*) from /* public.u, */ public.t -- from public.u", 2),
        ("select max(public.t.id) from public.t", 2),
        ("select count(public.t.v) from t, public.u where PUBLIC.T.id = u.id", 1),
        ("select count(*) from (select `public`.t.* from Public.T)", 2),
        ("with u as (select * from public.u where id > 3), t as (select * from u) select count(*) from t", 1),
        ("select (select max(id) from public.u) + count(*) from t where exists (select 1 from public.u where public.u.id = public.t.id)", 5),
        ("select count(*) from t join lateral (select id from public.u where u.id = t.id) x", 1),
        ("select count(*) from public.t public where public.v = 'v1' and 'from public.u' <> \"public.t.id\"", 1),
        ("select count(*) from public.t where id in (select id from public.u union select 1) and id > :low", 1),
    ):
        args = {"low": 1} if ":low" in query else None
        assert dataset.sql(query, args).first()[0] == want, query
    with pytest.raises(UndefinedTableError):
        dataset.sql("select * from t where id in (select id from public.missing_table)")


def test_read_api(spark, dataset):
    spans = [("a1", "m1", 120, True), ("a2", "m1", 360, True), ("b1", "m2", 701, False)]
    load(dataset, LoadSpec("spans", spark.createDataFrame(spans, "span_id string, model string, latency_ms long, ok boolean")))
    table = dataset.table("spans")
    assert rows(table.groupBy("model").agg(F.avg("latency_ms"))) == [("m1", 240.0), ("m2", 701.0)]
    assert rows(table.select("span_id", "latency_ms", "ok").where("ok").orderBy("latency_ms").limit(1)) == [("a1", 120, True)]
    assert rows(dataset.row_counts(["spans"])) == [("spans", 3)]
    assert table.toArrow().num_rows == 3


def test_version_files_are_plain_json(spark, dataset):
    load(dataset, LoadSpec("t", orders(spark, 1)))
    folder = f"{dataset.root}/public/t/versions"
    newest = json.loads(fs.read_text(spark, f"{folder}/{fs.children(spark, folder)[-1]}"))
    assert newest["rows"] == 1 and T.StructType.fromJson(newest["schemas"][-1]).names[:2] == ["id", "v"]


def many_files(spark, dataset, df, **options):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        load(dataset, LoadSpec("t", df, **options))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def data_files(spark, dataset, table="t"):
    """Every data file of a table with its bytes, listed or not."""
    home = f"{dataset.root}/public/{table}/data"
    return {f"{p}/{f}" for p in fs.children(spark, home) for f in fs.children(spark, f"{home}/{p}") if f.endswith(".parquet")}


def test_merge_masks_rows_and_writes_only_its_own(spark, dataset):
    many_files(spark, dataset, spark.range(0, 800, 1, 8).select("id", F.lit("old").alias("v")), write_disposition="upsert", primary_key="id")
    (part,) = dataset.version("t").parts
    files = data_files(spark, dataset)
    assert len(files) > 2
    for i, ids in enumerate([(5,), (5, 900), (6, 700)]):
        change = spark.createDataFrame([(k, f"new{i}") for k in ids], "id long, v string").coalesce(1)
        load(dataset, LoadSpec("t", change, write_disposition="upsert", primary_key="id"))
        assert dataset.table("t").count() == dataset.version("t").rows == (801 if i else 800)
        assert len(data_files(spark, dataset) - files) <= 2 * (i + 1) and files <= data_files(spark, dataset)
    first = dataset.version("t").parts[0]
    assert first["path"] == part["path"] and first["masked"] == 3 and first["rows"] == 800
    changed = dataset.table("t").where("v <> 'old'").select("id", "v")
    assert rows(changed) == sorted([(5, "new1"), (900, "new1"), (6, "new2"), (700, "new2")], key=str)
    assert dataset.table("t").where("id < 10").count() == 10
    dataset.compact("t", masked_share=0.0)
    assert not any("mask" in p for p in dataset.version("t").parts) and dataset.table("t").count() == 801
    assert dataset.version("t").rows == 801


def test_a_merge_of_one_row_masks_one_row_whatever_came_before(spark, dataset):
    load(dataset, LoadSpec("t", spark.range(0, 5000, 1, 250), write_disposition="append"))
    for step in (20, 7, 3):  # each touches every file, the last ones also rows that came since
        change = spark.range(0, 5000, step).withColumn("v", F.lit(f"n{step}"))
        load(dataset, LoadSpec("t", change, write_disposition="upsert", primary_key="id"))
    before = dataset.version("t")
    one = spark.createDataFrame([(11, "one")], "id long, v string")
    load(dataset, LoadSpec("t", one, write_disposition="upsert", primary_key="id"))
    version = dataset.version("t")
    masked = [sum(p.get("masked", 0) for p in v.parts) for v in (before, version)]
    assert masked[1] - masked[0] == 1 and {p["path"] for p in before.parts} < {p["path"] for p in version.parts}
    assert dataset.table("t").count() == version.rows == 5000
    assert [r["id"] for r in dataset.table("t").where("v = 'one'").collect()] == [11]


def test_a_batch_that_replaces_everything_rereads_nothing(spark, dataset):
    df = spark.range(50).withColumn("v", F.lit("a"))
    load(dataset, LoadSpec("t", df, write_disposition="upsert", primary_key="id"))
    load(dataset, LoadSpec("t", df.withColumn("v", F.lit("b")), write_disposition="upsert", primary_key="id"))
    assert len(dataset.version("t").parts) == 1
    assert dataset.table("t").where("v = 'b'").count() == 50 == dataset.version("t").rows


def test_only_rows_in_the_keys_range_are_looked_at(spark, dataset):
    load(dataset, LoadSpec("t", spark.range(50).coalesce(1)))
    keys = spark.createDataFrame([(7,), (9,)], "id long")
    for bounds, found in (({}, 2), ({"id": (7, 9)}, 2), ({"id": (8, 9)}, 1)):
        hits = dataset._matched_rows("t", dataset.version("t"), keys, ["id"], bounds)
        assert hits.count() == found


@pytest.mark.parametrize("key_type", ["string", "int", "date", "decimal(10,2)", "timestamp", "binary"])
def test_keys_of_any_type(spark, dataset, key_type):
    def batch(numbers, v):
        value = {
            "date": "date_add(date'2024-01-01', id)",
            "timestamp": "timestamp_seconds(id)",
            "binary": "encode(concat('k', id), 'utf-8')",
            "string": "concat('k', id)",
        }.get(key_type, f"cast(id as {key_type})")
        df = spark.createDataFrame([(n,) for n in numbers], "id int")
        return LoadSpec("t", df.select(F.expr(value).alias("k"), F.lit(v).alias("v")), write_disposition="upsert", primary_key="k")

    load(dataset, batch(range(10), "a"))
    load(dataset, batch(range(5, 12), "b"))
    assert rows(dataset.table("t").groupBy("v").count()) == [("a", 5), ("b", 7)]
    assert dataset.version("t").rows == 12


def test_listing_keeps_odd_names_apart(spark, tmp_path):
    names = sorted(["a", "b,c", "d e", "{f}", "g=h%20", "é"])
    for name in names:
        (tmp_path / name).mkdir()
    assert fs.children(spark, str(tmp_path)) == names
    assert fs.children(spark, str(tmp_path / "a")) == fs.children(spark, str(tmp_path / "missing")) == []


def test_sql_sees_this_dataset_alone(spark, dataset, tmp_path):
    other = Dataset.init(spark, str(tmp_path / "other"))
    load(dataset, LoadSpec("t", orders(spark, 1, 2, 3)))
    load(other, LoadSpec("u", orders(spark, 9)))
    spark.range(7).createOrReplaceTempView("t")
    try:
        assert dataset.sql("select count(*) from T").first()[0] == 3
        assert dataset.sql("select count(*) from Public.T as public where public.id > 1").first()[0] == 2
        with pytest.raises(UndefinedTableError):
            other.sql("select * from t")
        assert spark.sql("select count(*) from t").first()[0] == 7
        assert other.sql("select 'from public.u' as s from u").first()[0] == "from public.u"
    finally:
        spark.catalog.dropTempView("t")


def test_sql_has_the_settings_of_the_session(spark, dataset):
    load(dataset, LoadSpec("t", spark.sql("select timestamp_seconds(0) as at")))
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert dataset.sql("select date_format(at, 'HH') from t").first()[0] == "09"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_listing_an_unknown_table(dataset):
    with pytest.raises(UndefinedTableError):
        dataset.list_tables(["nope"])


def test_a_version_is_written_by_one_of_many(spark, dataset):
    from concurrent.futures import ThreadPoolExecutor

    path = f"{dataset.root}/one.json"

    def write(k):
        try:
            fs.write_new(spark, path, str(k))
            return k
        except ConcurrentPublishError:
            return None

    with ThreadPoolExecutor(8) as pool:
        won = [k for k in pool.map(write, range(24)) if k is not None]
    assert len(won) == 1 and fs.read_text(spark, path) == str(won[0])
    assert fs.children(spark, dataset.root).count("one.json") == 1 and not [n for n in fs.children(spark, dataset.root) if n.startswith(".one") and not n.endswith(".crc")]
