import pytest
from conftest import rows
from pyspark.sql import functions as F

from lodeworks import (
    IncompleteReadError,
    LoadSpec,
    UndefinedTableError,
    UnverifiableReadError,
    export_batches,
    load,
    number_batches,
    query_source,
    table_source,
    verified_read,
    with_layout,
)
from lodeworks.plans import files as fs
from lodeworks.sources.package import read_package
from lodeworks.sources.series import read_series
from lodeworks.sources.verified import deliver, read_batches


@pytest.fixture
def source(spark, dataset):
    data = [("o1", 10.0, "eu"), ("o2", 20.0, "us"), ("o3", 30.0, "eu")]
    df = spark.createDataFrame(data, "order_id string, amount double, region string")
    load(dataset, with_layout(LoadSpec("orders", df), ["region"]))
    return dataset


def test_table_source(source):
    spec = table_source(source, "orders", included_columns=["order_id", "amount"], primary_key="order_id")
    assert (spec.name, spec.target, spec.primary_key) == ("orders", "orders", "order_id")
    assert rows(spec.data) == [("o1", 10.0), ("o2", 20.0), ("o3", 30.0)]
    assert table_source(source, "orders", name="copy", table_name="Copied-Orders").target == "copied_orders"
    assert table_source(source, "orders", limit="2").data.count() == 2
    assert table_source(source, "orders", limit=0).data.count() == 0


@pytest.mark.parametrize("table", ["orders; drop", "a.b", '"orders"', "", "1st", "orders "])
def test_table_must_be_a_plain_identifier(source, table):
    with pytest.raises(ValueError, match="identifier"):
        table_source(source, table)


def test_projection_is_checked(source):
    with pytest.raises(ValueError, match="bare string"):
        table_source(source, "orders", included_columns="order_id")
    with pytest.raises(ValueError, match="identifier"):
        table_source(source, "orders", included_columns=["order_id, amount"])
    with pytest.raises(ValueError):
        table_source(source, "orders", limit="1; drop")
    with pytest.raises(UndefinedTableError):
        table_source(source, "nothing")


def test_query_source_needs_a_name(source):
    with pytest.raises(TypeError):
        query_source(source, "select 1")
    spec = query_source(source, "select region, sum(amount) total from orders group by region", name="totals")
    assert rows(spec.data) == [("eu", 40.0), ("us", 20.0)]


def test_source_layout_is_not_copied(spark, source, tmp_path):
    from lodeworks import Dataset

    target = Dataset.init(spark, str(tmp_path / "target"))
    load(target, table_source(source, "orders", write_disposition="replace"))
    assert target.version("orders").partition_by == []
    assert target.table("orders").select("order_id").count() == 3


def test_projection_reaches_the_scan(source):
    spec = table_source(source, "orders", included_columns=["amount"])
    assert "ReadSchema: struct<amount:double>" in spec.data._jdf.queryExecution().executedPlan().toString()


def test_verified_read(spark, source, tmp_path):
    copy = verified_read(source, "orders", str(tmp_path / "copy"), batch_rows=1)
    assert copy.count() == 3 and len(fs.data_files(spark, str(tmp_path / "copy"))) == 3
    with pytest.raises(UndefinedTableError):
        verified_read(source, "nothing", str(tmp_path / "x"))


def test_short_long_and_unknown_reads(spark, tmp_path):
    df = spark.range(5)
    assert deliver(df, str(tmp_path / "a"), 5) == 5
    for number, expected in enumerate((4, 6)):
        with pytest.raises(IncompleteReadError, match=f"5 of {expected}"):
            deliver(df, str(tmp_path / f"b{number}"), expected)
    with pytest.raises(UnverifiableReadError):
        deliver(df, str(tmp_path / "c"), None)
    assert deliver(df.limit(0), str(tmp_path / "d"), 0) == 0


def test_lost_rows_are_noticed(source, tmp_path):
    """A part that vanishes from under a table cannot pass as a complete read."""
    from dataclasses import replace

    version = source.version("orders")
    source.publish("orders", replace(version, parts=version.parts[1:]))
    with pytest.raises(IncompleteReadError):
        verified_read(source, "orders", str(tmp_path / "copy"))


@pytest.mark.parametrize("size, files", [(2, [1, 2, 2]), (5, [5]), (50_000, [5]), (0, [5]), (-1, [5])])
def test_export_batches(spark, tmp_path, size, files):
    got = export_batches(spark.range(5).coalesce(1), str(tmp_path / "out"), size)
    assert sorted(r["rows"] for r in got.collect()) == files


def test_empty_export_carries_the_schema(spark, tmp_path):
    export_batches(spark.range(5).where("id > 9"), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).dtypes == [("id", "bigint")]


def test_numbered_batches_follow_a_total_order(spark):
    df = spark.range(1000).select(F.xxhash64("id").alias("h"), "id").repartition(7)
    got = number_batches(df, ["h", "id"], 300).groupBy("batch").agg(F.count("*").alias("n"), F.min("h"), F.max("h"))
    got = got.orderBy("batch").collect()
    assert [r["n"] for r in got] == [300, 300, 300, 100]
    assert all(a[3] < b[2] for a, b in zip(got, got[1:]))
    assert number_batches(df, ["h"], 0).select("batch").distinct().count() == 1


def test_package_order_is_the_order_given(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("z", "a")]
    for i, path in enumerate(paths):
        spark.range(3).withColumn("f", F.lit(i)).coalesce(1).write.parquet(path)
    got = read_package(spark, paths)
    assert rows(got.select("f", "__file_seq", "id", "__row_seq")) == [(f, f, i, i) for f in (0, 1) for i in range(3)]


def test_series_with_a_null_token(spark, tmp_path):
    (tmp_path / "s.csv").write_text("observation_date,X\n2024-01-01,1.5\n2024-01-02,.\n")
    got = read_series(spark, str(tmp_path / "s.csv"), "rate", date_column="observation_date")
    assert [(str(d), v) for d, v in rows(got)] == [("2024-01-01", 1.5), ("2024-01-02", None)]


def test_file_order_is_broadcast_by_its_size(spark, tmp_path):
    spark.range(30).repartition(3).write.parquet(str(tmp_path / "f"))
    plan = read_package(spark, [str(tmp_path / "f")])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("disposition", ["append", "replace", "upsert"])
def test_a_derived_table_is_checked_as_it_is_written(spark, dataset, disposition):
    from dataclasses import replace

    load(dataset, LoadSpec("t", spark.range(10)))
    spec = table_source(dataset, "t", name="copy", write_disposition=disposition, primary_key="id")
    assert spec.expected_rows == 10 and table_source(dataset, "t", limit=3).expected_rows == 3
    short = replace(spec, data=spec.data.where("id < 9"))
    with pytest.raises(IncompleteReadError, match="9 of 10"):
        load(dataset, short, load_id="short")
    assert dataset.version("copy").rows == 0
    load(dataset, spec, load_id="whole")
    assert dataset.table("copy").count() == 10


@pytest.mark.parametrize("size", [2, 50])
def test_batches_for_a_consumer(spark, size):
    df = spark.range(0, 11, 1, 3).withColumn("v", F.lit("x"))
    batches = list(read_batches(df, 11, size))
    assert sorted(i for b in batches for i in b.column("id").to_pylist()) == list(range(11))
    assert all(0 < b.num_rows <= size for b in batches) and len(batches) == (6 if size == 2 else 3)
    (empty,) = read_batches(df.limit(0), 0, size)
    assert empty.num_rows == 0 and empty.column_names == ["id", "v"]
    with pytest.raises(IncompleteReadError, match="11 of 12"):
        next(read_batches(df, 12, size))


def _jobs(spark):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))


def test_small_batches_come_together_and_large_ones_alone(spark, monkeypatch):
    df = spark.range(0, 3000, 1, 2).withColumn("v", F.when(F.col("id") >= 1500, F.repeat(F.lit("long"), 200)))
    before = _jobs(spark)
    batches = list(read_batches(df, 3000, 7))
    assert _jobs(spark) - before < 20  # a job for each of the 430 batches before
    assert [b.num_rows for b in batches] == 2 * ([7] * 214 + [2])
    assert [i for b in batches for i in b.column("id").to_pylist()] == list(range(3000))
    assert all(v == (None if k < 1500 else "long" * 200) for k, v in enumerate(v for b in batches for v in b.column("v").to_pylist()))
    monkeypatch.setattr("lodeworks.sources.verified._READ_AT_ONCE", 100_000)
    before = _jobs(spark)
    assert [b.num_rows for b in read_batches(df, 3000, 500)] == [500] * 6
    assert _jobs(spark) - before >= 5  # the long ones alone
    assert [b.num_rows for b in read_batches(df, None, 0)] == [1500, 1500]


def test_a_checked_query(spark, dataset):
    load(dataset, LoadSpec("t", spark.range(20)))
    spec = query_source(dataset, "select id from public.t where id > :low", name="some", args={"low": 4}, verified=True)
    assert spec.expected_rows == 15
    load(dataset, spec)
    assert dataset.table("some").count() == 15
    short = query_source(dataset, "select id from t", name="short", expected_rows=21)
    with pytest.raises(IncompleteReadError):
        load(dataset, short)


def test_a_copy_with_one_changed_value_is_refused(spark, dataset, tmp_path):
    df = spark.range(40).select("id", F.col("id").cast("string").alias("s"), F.array("id", F.lit(None)).alias("a"), F.create_map("id", F.lit(1)).alias("m"))
    load(dataset, LoadSpec("t", df))
    load(dataset, LoadSpec("t", df))
    version = dataset.version("t")
    sums, table = dataset.content_of("t", version), dataset.table("t")
    assert deliver(table.repartition(3), str(tmp_path / "same"), 80, sums=sums) == 80
    wrong = F.when(F.col("id") == 7, F.lit("x"))
    changes = {
        "value": table.withColumn("s", F.coalesce(wrong, "s")),
        "null": table.withColumn("s", F.when(F.col("id") != 7, F.col("s"))),
        "inside": table.withColumn("a", F.when(F.col("id") == 7, F.array("id")).otherwise(F.col("a"))),
        "map": table.withColumn("m", F.when(F.col("id") == 7, F.create_map("id", F.lit(2))).otherwise(F.col("m"))),
        "copies": table.where("id < 39").unionByName(table.where("id = 1")),
    }
    for name, changed in changes.items():
        with pytest.raises(IncompleteReadError, match="not with the values"):
            deliver(changed, str(tmp_path / name), 80, sums=sums)
        assert not (tmp_path / name).exists()


def test_content_of_masked_widened_and_partitioned_tables(spark, dataset, tmp_path):
    spec = LoadSpec("t", spark.range(30).select(F.col("id").cast("int"), (F.col("id") % 3).alias("k")), write_disposition="upsert", primary_key="id")
    load(dataset, with_layout(spec, ["k"]))
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    before = jobs()
    first = dataset.content_of("t", dataset.version("t"))
    assert jobs() == before  # from the version alone
    load(dataset, LoadSpec("t", spark.range(5, 8).select("id", F.lit(9).cast("long").alias("k"), F.lit("n").alias("new")), write_disposition="upsert", primary_key="id"))
    assert verified_read(dataset, "t", str(tmp_path / "a")).count() == 30
    assert dataset.content_of("t", dataset.version("t")) != first
    load(dataset, LoadSpec("t", spark.sql("select cast(1.50 as decimal(10,2)) as id, 0L as k"), write_disposition="append"))
    assert verified_read(dataset, "t", str(tmp_path / "b")).count() == 31
    dataset.compact("t", masked_share=0.0)
    assert verified_read(dataset, "t", str(tmp_path / "c")).count() == 31
