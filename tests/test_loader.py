import hashlib

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lodeworks import (
    DuplicateKeyError,
    LoadError,
    LoadSpec,
    NullKeyError,
    SchemaConflictError,
    UndefinedTableError,
    delete_rows,
    load,
    update_rows,
    verified_read,
)
from lodeworks import spec as spec_module
from lodeworks.operators.identity import with_identity
from lodeworks.plans import files as fs
from lodeworks.plans import loader
from lodeworks.sources.datasource import register
from lodeworks.sources.package import read_package


def users(spark, *data):
    return spark.createDataFrame(list(data), "id long, name string, deleted boolean")


def merge_spec(df, **options):
    return LoadSpec("users", df, write_disposition="merge", primary_key="id", columns={"deleted": {"hard_delete": True}}, **options)


def test_identity_columns_on_every_row(spark, dataset):
    load(dataset, LoadSpec("t", users(spark, (1, "a", None), (2, "b", None))), load_id="L1")
    got = dataset.table("t").select("_dlt_id", "_dlt_load_id").collect()
    assert {r[1] for r in got} == {"L1"} and len({r[0] for r in got}) == 2


def test_merge_with_deletes(spark, dataset):
    load(dataset, merge_spec(users(spark, (1, "a", None), (2, "b", None), (3, "c", None))))
    load(dataset, merge_spec(users(spark, (1, "a2", False), (2, "b", True))))
    assert rows(dataset.table("users").select("id", "name")) == [(1, "a2"), (3, "c")]
    assert dataset.version("users").rows == 2


def test_all_rows_flagged_creates_an_empty_table(spark, dataset):
    load(dataset, merge_spec(users(spark, (1, "a", True), (2, "b", True))))
    assert dataset.table("users").count() == 0 and dataset.version("users").loaded


def test_flag_column_absent_from_the_batch(spark, dataset):
    load(dataset, merge_spec(users(spark, (1, "a", None))))
    load(dataset, merge_spec(users(spark, (1, "b", None)).drop("deleted")))
    assert rows(dataset.table("users").select("id", "name", "deleted")) == [(1, "b", None)]


def test_flag_may_not_be_a_key(spark, dataset):
    bad = LoadSpec("u", users(spark, (1, "a", True)), write_disposition="merge", primary_key=["id", "deleted"],
                   columns={"deleted": {"hard_delete": True}})
    with pytest.raises(LoadError, match="deleted"):
        load(dataset, bad)
    assert dataset.table_names() == []


def test_insert_only_and_keyless_merge_drop_flagged_rows(spark, dataset):
    batch = users(spark, (3, "a", False), (4, "b", True))
    load(dataset, LoadSpec("users", users(spark, (100, "seed", None))))
    load(dataset, merge_spec(batch, merge_strategy="insert-only"))
    assert rows(dataset.table("users").select("id")) == [(100,), (3,)]
    keyless = LoadSpec("k", batch, write_disposition="merge", columns={"deleted": {"hard_delete": True}})
    load(dataset, keyless)
    load(dataset, keyless)
    assert rows(dataset.table("k").select("id")) == [(3,), (3,)]


def test_insert_only_never_rewrites(spark, dataset):
    first = users(spark, (1, "a", None))
    load(dataset, merge_spec(first, merge_strategy="insert-only"))
    before = dataset.version("users").parts
    load(dataset, merge_spec(users(spark, (1, "b", None), (2, "c", None)), merge_strategy="insert-only"))
    assert dataset.version("users").parts[: len(before)] == before
    assert rows(dataset.table("users").select("id", "name")) == [(1, "a"), (2, "c")]


@pytest.mark.parametrize("existing_first", [True, False])
def test_null_key(spark, dataset, existing_first):
    if existing_first:
        load(dataset, LoadSpec("users", users(spark, (1, "a", None))))
    with pytest.raises(NullKeyError, match="id"):
        load(dataset, merge_spec(users(spark, (None, "x", None))))


def test_null_key_among_stored_rows(spark, dataset):
    load(dataset, LoadSpec("users", users(spark, (None, "a", None))))
    with pytest.raises(NullKeyError, match="existing"):
        load(dataset, merge_spec(users(spark, (1, "x", None))))


def test_duplicates_need_an_order(spark, dataset):
    twice = users(spark, (1, "a", None), (1, "b", None))
    with pytest.raises(DuplicateKeyError, match="id"):
        load(dataset, merge_spec(twice))
    load(dataset, merge_spec(twice, order_by=["name"]))
    assert rows(dataset.table("users").select("name")) == [("b",)]


def test_key_from_column_hints_and_metadata(spark):
    df = users(spark, (1, "a", None))
    assert LoadSpec("u", df).key == []
    assert LoadSpec("u", df, columns={"id": {"primary_key": True}}).key == ["id"]
    tagged = df.withColumn("name", F.col("name").alias("name", metadata={"primary_key": True}))
    assert LoadSpec("u", tagged).key == ["name"]
    assert LoadSpec("u", tagged, primary_key="id").key == ["id"]


def test_dispositions(spark):
    def action(**options):
        return spec_module.resolve_action(LoadSpec("u", None, **options))

    assert action() == "append"
    assert action(write_disposition="MERGE") == action(write_disposition="upsert") == "upsert"
    assert action(write_disposition="merge", merge_strategy="insert-only") == action(write_disposition="insert-only") == "insert-only"
    with pytest.raises(LoadError, match="append, insert-only, merge, replace, upsert"):
        action(write_disposition="delete-insert")
    with pytest.raises(LoadError, match="scd2"):
        action(write_disposition="merge", merge_strategy="scd2")
    with pytest.raises(LoadError, match="staging"):
        action(write_disposition="replace", replace_strategy="staging-optimized")


def test_a_keyed_load_into_a_table_created_without_key(spark, dataset):
    load(dataset, LoadSpec("users", users(spark, (1, "a", None), (2, "b", None)), write_disposition="replace"))
    assert dataset.version("users").key is None
    load(dataset, merge_spec(users(spark, (2, "B", None), (3, "c", None))))
    assert rows(dataset.table("users").select("id", "name")) == [(1, "a"), (2, "B"), (3, "c")]


def test_no_duplicates_across_runs(spark, dataset):
    for _ in range(3):
        load(dataset, merge_spec(users(spark, (1, "a", None), (2, "b", None))))
    assert dataset.table("users").count() == 2


@pytest.mark.parametrize("disposition", ["append", "upsert", "insert-only", "replace"])
def test_the_same_load_twice_changes_nothing(spark, dataset, disposition):
    one = LoadSpec("t", users(spark, (1, "a", None)), write_disposition=disposition, primary_key="id")
    load(dataset, one, load_id="L1")
    load(dataset, one, load_id="L1")
    assert dataset.table("t").count() == 1 and dataset.bookkeeping("_dlt_loads").count() == 1


def test_a_load_that_broke_off_goes_on(spark, dataset, monkeypatch):
    package = [LoadSpec("a", users(spark, (1, "a", None))), LoadSpec("b", users(spark, (2, "b", None)))]
    apply = loader._apply

    def fail_on_b(dataset, task, *rest):
        if task.table == "b":
            raise RuntimeError("lost")
        return apply(dataset, task, *rest)

    with monkeypatch.context() as patch:
        patch.setattr(loader, "_apply", fail_on_b)
        with pytest.raises(RuntimeError, match="lost"):
            load(dataset, package, load_id="L1")
    assert dataset.bookkeeping("_dlt_loads").count() == 0
    load(dataset, package, load_id="L1")
    assert (dataset.table("a").count(), dataset.table("b").count()) == (1, 1)
    assert dataset.bookkeeping("_dlt_loads").count() == 1


def test_one_package_may_name_a_table_once(spark, dataset):
    with pytest.raises(LoadError, match="twice"):
        load(dataset, [LoadSpec("t", users(spark)), LoadSpec("T", users(spark))])
    with pytest.raises(LoadError, match="kept by the loader"):
        load(dataset, LoadSpec("_dlt_loads", users(spark)))


def test_column_names_are_normalised_and_collisions_refused(spark, dataset):
    df = spark.createDataFrame([(1, 2.5)], "`Order ID` long, `Unit.Price` double")
    load(dataset, LoadSpec("t", df, write_disposition="merge", primary_key="Order ID"))
    assert dataset.table("t").columns[:2] == ["order_id", "unit_price"]
    with pytest.raises(LoadError, match="both"):
        load(dataset, LoadSpec("t", spark.createDataFrame([(1, 2)], "`a-b` int, `a_b` int")))


def test_type_conflict_is_found_before_any_write(spark, dataset):
    load(dataset, LoadSpec("t", spark.createDataFrame([(1,)], "id long")))
    with pytest.raises(SchemaConflictError, match="id"):
        load(dataset, [LoadSpec("u", users(spark)), LoadSpec("t", spark.createDataFrame([("x",)], "id string"))])
    assert dataset.version("u") is None


def test_package_files_with_different_schemas(spark, dataset, tmp_path):
    paths = [str(tmp_path / n) for n in ("a b", "c", "d")]
    spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string").coalesce(1).write.parquet(paths[0])
    spark.createDataFrame([(2, "z", 1.5)], "id long, v string, extra double").coalesce(1).write.parquet(paths[1])
    spark.createDataFrame([], "id long, v string").coalesce(1).write.parquet(paths[2])
    report = load(dataset, LoadSpec("t", paths, write_disposition="upsert", primary_key="id"))
    assert rows(dataset.table("t").select("id", "v", "extra")) == [(1, "x", None), (2, "z", 1.5)]
    assert sorted(r["rows"] for r in report.collect()) == [0, 1, 2]


def test_row_order_inside_a_file_decides(spark, dataset, tmp_path):
    path = str(tmp_path / "f")
    spark.createDataFrame([(1, "a"), (1, "b"), (1, "c")], "id int, v string").coalesce(1).write.parquet(path)
    load(dataset, LoadSpec("t", [path], write_disposition="upsert", primary_key="id"))
    assert rows(dataset.table("t").select("v")) == [("c",)]


def test_unknown_type_column_is_left_out(spark, dataset):
    load(dataset, LoadSpec("t", spark.range(2).withColumn("nothing", F.lit(None))))
    assert "nothing" not in dataset.table("t").columns


# -- nested ------------------------------------------------------------------------------


def test_many_files_are_listed_and_named_at_once(spark, tmp_path):
    rows = spark.range(0, 60).select("id", (F.col("id") % 40).alias("f"))
    rows.repartition("f").write.partitionBy("f").parquet(f"{tmp_path}/a b/in")
    files = fs.matching(spark, f"{tmp_path}/a b/in", "f=*/*.parquet")
    assert len(files) == 40 and files == sorted(files)
    odd = [*files, f"{tmp_path}/a b/in/f=1/50% of #1.parquet", f"{tmp_path}/a b/x/../y.parquet"]
    assert fs.uris(spark, odd) == [fs.uri(spark, f) for f in odd]
    assert fs.uris(spark, files[:1]) == [fs.uri(spark, files[0])] and fs.uris(spark, ["/a.parquet", "/b.parquet"]) == [fs.uri(spark, f) for f in ("/a.parquet", "/b.parquet")]
    before = set(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    with fs.listed_by_few(spark):
        assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism") == str(8 * spark.sparkContext.defaultParallelism)
        package = read_package(spark, files)
    new = set(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - before
    assert len(new) == 2  # one listing, one job for the footers
    got = package.groupBy("__file_seq").agg(F.count("*")).count()
    assert got == 40 and package.count() == 60


def test_ids_of_child_rows_are_made_again_where_they_are_read(spark, dataset, tmp_path):
    register(spark)
    lists = spark.range(3).select("id", F.expr("transform(sequence(0, 5), x -> struct(x as a, array(id, x) as b))").alias("items"))
    load(dataset, LoadSpec("o", lists, nested=True, order_by=["id"]), load_id="L1")
    load(dataset, LoadSpec("o", lists.withColumn("id", F.col("id") + 3), nested=True, order_by=["id"]), load_id="L2")
    made = {t: {r._dlt_id for r in dataset.table(t).collect()} for t in ("o", "o__items")}
    for table, parent in (("o__items", "o"), ("o__items__b", "o__items")):
        for part in dataset.version(table).parts:
            files = spark.read.parquet(f"{dataset.root}/public/{table}/data/{part['path']}")
            assert "_dlt_id" not in files.columns and "_dlt_parent_id" in files.columns
        read = spark.read.format("lodeworks").options(path=dataset.root, table=table).load()
        want = {hashlib.sha256(f"{r._dlt_parent_id}_{table}_{r._dlt_list_idx}".encode()).hexdigest() for r in dataset.table(table).collect()}
        for rows in (dataset.table(table), read, verified_read(dataset, table, str(tmp_path / table))):
            assert {r._dlt_id for r in rows.collect()} == want and rows.count() == len(want)
        assert {r._dlt_parent_id for r in read.collect()} == made[parent]
        some = min(want)
        assert dataset.table(table).where(F.col("_dlt_id") == some).count() == read.where(F.col("_dlt_id") == some).count() == 1
        delete_rows(dataset, table, spark.createDataFrame([(some,)], "_dlt_id string"), ["_dlt_id"])
        dataset.compact(table, masked_share=0.0)
        assert {r._dlt_id for r in dataset.table(table).collect()} == want - {some}
        assert {r._dlt_id for r in spark.read.format("lodeworks").options(path=dataset.root, table=table).load().collect()} == want - {some}


def nested_orders(spark):
    return spark.createDataFrame(
        [(1, [("a", [1, 2]), ("b", [])], ("x", (7,)), [[1], [2, 3]]), (2, [("c", None)], None, None)],
        "id long, items array<struct<sku:string,codes:array<int>>>, who struct<name:string,deep:struct<n:int>>, grid array<array<int>>",
    )


def test_child_tables_of_one_package(spark, dataset):
    load(dataset, LoadSpec("orders", nested_orders(spark), nested=True), load_id="L1")
    names = {n for n in dataset.table_names() if not n.startswith("_dlt")}
    assert names == {"orders", "orders__items", "orders__items__codes", "orders__grid", "orders__grid__list"}
    assert dataset.table("orders").columns == ["id", "who__name", "who__deep__n", "_dlt_load_id", "_dlt_id"]
    joined = dataset.sql(
        "select id, sku, i._dlt_list_idx n from orders o join orders__items i on i._dlt_parent_id = o._dlt_id"
    )
    assert rows(joined) == [(1, "a", 0), (1, "b", 1), (2, "c", 0)]
    deep = dataset.sql(
        "select sku, value from orders__items i join orders__items__codes c on c._dlt_parent_id = i._dlt_id"
    )
    assert rows(deep) == [("a", 1), ("a", 2)]
    assert rows(dataset.table("orders__grid__list").select("value")) == [(1,), (2,), (3,)]
    loads = {r[0] for n in names for r in dataset.table(n).select("_dlt_load_id").distinct().collect()}
    assert loads == {"L1"}


def test_nesting_limit(spark, dataset):
    load(dataset, LoadSpec("o", nested_orders(spark), nested=True, max_nesting=1))
    assert {n for n in dataset.table_names() if not n.startswith("_dlt")} == {"o", "o__items", "o__grid"}
    assert dict(dataset.table("o").dtypes)["who__deep"] == "string"
    assert dict(dataset.table("o__items").dtypes)["codes"] == "string"
    load(dataset, LoadSpec("p", nested_orders(spark), nested=True, max_nesting=0))
    assert dict(dataset.table("p").dtypes)["items"] == "string" and dataset.version("p__items") is None


def test_parent_ids_match_even_for_equal_rows(spark, dataset):
    twins = spark.createDataFrame([(1, [1]), (1, [1])], "id long, xs array<int>")
    load(dataset, LoadSpec("t", twins, nested=True))
    ids = {r[0] for r in dataset.table("t").select("_dlt_id").collect()}
    assert len(ids) == 2
    assert {r[0] for r in dataset.table("t__xs").select("_dlt_parent_id").collect()} == ids


def test_row_ids_are_the_same_on_every_run(spark, dataset, tmp_path):
    path = str(tmp_path / "f")
    spark.range(50).repartition(3).write.parquet(path)
    for name in ("a", "b"):
        load(dataset, LoadSpec(name, [path]), load_id=f"L-{name}")
    load(dataset, LoadSpec("c", fs.data_files(spark, path)), load_id="L-a2")
    ids = [{r[0] for r in dataset.table(n).select("_dlt_id").collect()} for n in "ab"]
    assert len(ids[0]) == 50 and not ids[0] & ids[1]


def test_declared_types(spark, dataset):
    df = spark.createDataFrame([("1.5", 7, "1" + "0" * 60)], "price string, n int, total string")
    columns = {
        "price": {"data_type": "decimal"},
        "n": {"data_type": "bigint"},
        "total": {"data_type": "wei"},
        "later": {"data_type": "date"},
    }
    load(dataset, LoadSpec("t", df, columns=columns))
    types = dict(dataset.table("t").dtypes)
    assert (types["price"], types["n"], types["total"], types["later"]) == ("decimal(38,9)", "bigint", "string", "date")
    assert dataset.version("t").schema["total"].metadata["logical"] == "wei"
    assert dataset.table("t").first()["total"] == "1" + "0" * 60


@pytest.mark.parametrize("disposition", ["append", "upsert", "insert-only", "replace"])
def test_row_ids_are_unique_even_if_keys_share_a_place(spark, dataset, disposition):
    df = spark.createDataFrame([(k, 1) for k in range(20)], "id long, at int")
    load(dataset, LoadSpec("t", df, write_disposition=disposition, primary_key="id", order_by=["at"]), load_id="L")
    ids = [r[0] for r in dataset.table("t").select("_dlt_id").collect()]
    assert len(set(ids)) == 20


def test_keyless_merge_keeps_equal_rows(spark, dataset):
    df = spark.createDataFrame([(1, 1), (1, 1)], "id long, at int")
    for _ in range(2):
        load(dataset, LoadSpec("t", df, write_disposition="merge", order_by=["at"]))
    assert dataset.table("t").count() == 4


def test_keyless_merge_on_ids_the_rows_bring(spark, dataset):
    def batch(*data):
        return LoadSpec("t", spark.createDataFrame(list(data), "_dlt_id string, v long"), write_disposition="merge")

    load(dataset, batch(("a", 1), ("b", 2)))
    load(dataset, batch(("b", 3), ("c", 4)))
    assert rows(dataset.table("t").select("_dlt_id", "v")) == [("a", 1), ("b", 3), ("c", 4)]


def test_changes_of_stored_rows_are_loads(spark, dataset):
    load(dataset, LoadSpec("t", spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, v string")), load_id="L1")
    change = spark.createDataFrame([(2, "B"), (9, "x")], "id long, v string")
    assert update_rows(dataset, "t", change, ["id"], load_id="L2") == 1
    assert update_rows(dataset, "t", change, ["id"], load_id="L2") == 0  # the same load again
    assert rows(dataset.table("t").select("id", "v", "_dlt_load_id")) == [(1, "a", "L1"), (2, "B", "L2"), (3, "c", "L1")]
    assert dataset.table("t").where("_dlt_id is null").isEmpty()
    assert delete_rows(dataset, "t", spark.createDataFrame([(1,), (7,)], "id long"), ["id"], load_id="L3") == 1
    assert rows(dataset.bookkeeping("_dlt_loads").select("load_id")) == [("L1",), ("L2",), ("L3",)]
    # a merge by row id still finds an id on every row
    load(dataset, LoadSpec("t", dataset.table("t").select("_dlt_id", "id", F.lit("z").alias("v")), write_disposition="merge"), load_id="L4")
    assert rows(dataset.table("t").select("id", "v")) == [(2, "z"), (3, "z")]
    for change in (delete_rows, update_rows):
        with pytest.raises(UndefinedTableError):
            change(dataset, "nope", spark.createDataFrame([(1,)], "id long"), ["id"])


def test_row_ids_tell_all_positions_apart(spark):
    places = [("a|b", "c"), ("a", "b|c"), (None, "a"), ("a", None), ("", "a"), ("-", "a"), ("a", "")]
    df = with_identity(spark.createDataFrame(places, "x string, y string"), "L", ["x", "y"])
    assert df.select("_dlt_id").distinct().count() == len(places)


def _order(spark, *orders):
    return spark.createDataFrame(list(orders), "id long, gone boolean, items array<struct<`Sku Name`: string, codes: array<string>>>")


def test_a_nested_row_that_is_merged_again_replaces_its_children(spark, dataset):
    def go(load_id, *orders):
        spec = LoadSpec("orders", _order(spark, *orders), write_disposition="merge", primary_key="id", nested=True, columns={"gone": {"hard_delete": True}})
        load(dataset, spec, load_id=load_id)

    def stored():
        return rows(
            dataset.sql(
                "select o.id, sku_name, value from orders o left join orders__items i on i._dlt_parent_id = o._dlt_id "
                "left join orders__items__codes c on c._dlt_parent_id = i._dlt_id"
            )
        )

    go("L1", (1, False, [("a", ["x", "y"]), ("b", [])]), (2, False, [("z", ["k"])]), (3, False, [("q", ["r"])]))
    assert stored() == [(1, "a", "x"), (1, "a", "y"), (1, "b", None), (2, "z", "k"), (3, "q", "r")]
    go("L2", (1, False, [("c", ["w"])]), (2, True, []))
    assert stored() == [(1, "c", "w"), (3, "q", "r")]
    # no child is left without its parent
    assert dataset.table("orders__items").count() == 2 and dataset.table("orders__items__codes").count() == 2
    assert "sku_name" in dataset.table("orders__items").columns


def test_nested_fields_that_become_one_column_are_refused(spark, dataset):
    df = spark.createDataFrame([(1, ("a", "b"))], "id long, who struct<`A b`: string, `a_B`: string>")
    with pytest.raises(LoadError, match="who__a_b"):
        load(dataset, LoadSpec("t", df, nested=True, order_by=["id"]))


def test_rows_that_share_a_place_in_the_order_are_refused(spark, dataset):
    def spec(*data):
        df = spark.createDataFrame(list(data), "id long, at long, v string")
        return LoadSpec("t", df, write_disposition="upsert", primary_key="id", order_by=["at"])

    with pytest.raises(DuplicateKeyError, match="ties"):
        load(dataset, spec((1, 5, "a"), (1, 5, "b"), (2, 1, "c")))
    load(dataset, spec((1, 5, "a"), (1, 5, "a"), (1, 4, "b"), (1, 4, "c")))
    assert rows(dataset.table("t").select("id", "v")) == [(1, "a")]
