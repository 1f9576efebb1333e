import warnings

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lodeworks import IncompleteReadError, LayoutError, LoadSpec, load, with_layout
from lodeworks.operators import layout as lay
from lodeworks.plans import files as fs


def spec(spark, **options):
    df = spark.createDataFrame([("2024-01-05", 3, "a")], "event_date string, event_time long, tag string")
    return LoadSpec("t", df, **options)


def test_forms_of_a_partition_key():
    want = lay.PartitionKey("d", "day")
    assert [lay.read_key(lay.PartitionKey, e) for e in (("d", "DAY"), {"column": "d", "transform": "day"}, want)] == [want] * 3
    assert lay.read_key(lay.PartitionKey, "d") == lay.read_key(lay.PartitionKey, {"column": "d"}) == lay.PartitionKey("d", "identity")


@pytest.mark.parametrize("entry", [("d", "week"), "", {"transform": "day"}, ("a", "b", "c"), 7, {"column": "", "transform": "day"}])
def test_bad_partition_keys(entry):
    with pytest.raises(LayoutError):
        lay.read_key(lay.PartitionKey, entry)


def test_forms_of_a_sort_key():
    assert lay.read_key(lay.SortKey, "t") == lay.read_key(lay.SortKey, ("t",)) == lay.SortKey("t")
    assert lay.read_key(lay.SortKey, ("t", "DESC", "First")) == lay.SortKey("t", "desc", "first")
    assert lay.read_key(lay.SortKey, {"column": "t", "nulls": "last"}) == lay.SortKey("t", None, "last")


@pytest.mark.parametrize("entry", [("t", "up"), ("t", "asc", "middle"), "", (), ("a", "asc", "last", "x"), 7])
def test_bad_sort_keys(entry):
    with pytest.raises(LayoutError):
        lay.read_key(lay.SortKey, entry)


def test_with_layout_keeps_plain_dicts_in_order(spark):
    laid = with_layout(spec(spark), [("event_date", "identity")], ["event_time", ("tag", "asc", "last")])
    assert laid.partition_by == ({"column": "event_date", "transform": "identity"},)
    assert [k["column"] for k in laid.sorted_by] == ["event_time", "tag"]
    assert laid.sorted_by[0] == {"column": "event_time", "direction": None, "nulls": None}


@pytest.mark.parametrize("name", ["partition_by", "sorted_by"])
def test_empty_layout_is_refused(spark, name):
    with pytest.raises(LayoutError, match=name):
        with_layout(spec(spark), **{name: []})


def test_explicit_layout_beats_hints(spark):
    hinted = spec(spark, columns={"tag": {"partition": True, "sort": True}, "event_date": {"partition": True}})
    assert hinted.layout == lay.Layout((lay.PartitionKey("event_date"), lay.PartitionKey("tag")), (lay.SortKey("tag"),))
    assert with_layout(hinted, ["event_time"]).layout == lay.Layout((lay.PartitionKey("event_time"),), (lay.SortKey("tag"),))
    assert hinted.layout and not spec(spark).layout


def test_hints_in_field_metadata_count(spark):
    df = spec(spark).data
    df = df.withColumn("tag", F.col("tag").alias("tag", metadata={"partition": True}))
    assert LoadSpec("t", df).layout.partitions == (lay.PartitionKey("tag"),)


def test_missing_columns_are_sorted_and_unique(spark):
    laid = with_layout(spec(spark), ["zz", "tag"], ["aa", "zz"])
    assert laid.layout.lacks(["tag"]) == ["aa", "zz"]


def test_layout_on_an_unknown_column_fails_before_any_write(spark, dataset):
    with pytest.raises(LayoutError, match="nope"):
        load(dataset, with_layout(spec(spark), ["nope"]))
    assert dataset.table_names() == []


def test_time_transform_needs_a_time_column(spark, dataset):
    with pytest.raises(LayoutError, match="event_time"):
        load(dataset, with_layout(spec(spark), [("event_time", "day")]))


def test_comparison():
    stored = lay.Layout.read([("d", "day")], [("t", "asc", "last")])
    assert lay.Layout.read([("d", "DAY")], ["t"]).satisfied_by(stored)
    assert not lay.Layout.read([("d", "month")], ["t"]).satisfied_by(stored)
    assert not lay.Layout.read([("d", "day")], [("t", "desc")]).satisfied_by(stored)
    assert not lay.Layout.read([("d", "day")]).satisfied_by(stored)
    assert not lay.Layout.read(["b", "a"]).satisfied_by(lay.Layout.read(["a", "b"]))


def test_layout_is_fixed_at_creation(spark, dataset):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "id long, tag string")
    load(dataset, with_layout(LoadSpec("t", df), ["tag"]))
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        load(dataset, with_layout(LoadSpec("t", df), ["tag"]))
        load(dataset, LoadSpec("t", df))
    with pytest.warns(UserWarning, match="another layout"):
        load(dataset, with_layout(LoadSpec("t", df), ["id"]))
    assert dataset.version("t").partition_by == [{"column": "tag", "transform": "identity"}]
    assert dataset.table("t").count() == 8


def test_files_are_sorted_inside_each_partition(spark, dataset):
    df = spark.range(400).select((F.col("id") % 3).alias("k"), F.xxhash64("id").alias("v"), F.col("id"))
    df = df.withColumn("v", F.when(F.col("id") % 50 != 0, F.col("v")))
    load(dataset, with_layout(LoadSpec("t", df.repartition(4)), ["k"], [("v", "desc", "last")]))
    version = dataset.version("t")
    assert len(version.parts) == 3
    for part in version.parts:
        for file in fs.data_files(spark, f"{dataset.root}/public/t/data/{part['path']}"):
            got = [r["v"] for r in spark.read.parquet(file).orderBy(F.col("_metadata.row_index")).collect()]
            want = sorted((v for v in got if v is not None), reverse=True) + [v for v in got if v is None]
            assert got == want


def test_null_and_odd_partition_values_round_trip(spark, dataset):
    data = [(1, None), (2, "a/b c=d%20+e"), (3, ""), (4, "é[x]{y}*?")]
    df = spark.createDataFrame(data, "id long, tag string")
    load(dataset, with_layout(LoadSpec("t", df, write_disposition="upsert", primary_key="id"), ["tag"]))
    assert rows(dataset.table("t").select("id", "tag")) == data
    # a merge that moves one row to another partition and leaves the others where they are
    load(dataset, LoadSpec("t", spark.createDataFrame([(2, "new")], df.schema), write_disposition="upsert", primary_key="id"))
    assert rows(dataset.table("t").select("id", "tag")) == [(1, None), (2, "new"), (3, ""), (4, "é[x]{y}*?")]
    assert dataset.version("t").rows == 4


def test_range_on_a_partitioned_column_prunes_directories(spark, dataset):
    df = spark.range(240).select("id", F.timestamp_seconds(F.col("id") * 3600).alias("ts"), (F.col("id") % 5).alias("n"))
    load(dataset, with_layout(LoadSpec("t", df), [("ts", "day"), "n"]))
    got = dataset.table("t", between=("ts", "1970-01-03 00:00:00", "1970-01-03 23:00:00"))
    assert got.count() == 24
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(__p_ts_day" in plan
    assert dataset.table("t", between=("n", 2, 3)).count() == 96


def test_merge_masks_rows_of_the_partitions_it_touches(spark, dataset):
    df = spark.range(100).select("id", (F.col("id") % 4).alias("k"), F.lit("old").alias("v"))
    load(dataset, with_layout(LoadSpec("t", df, write_disposition="upsert", primary_key="id"), ["k"]))
    before = dataset.version("t").parts
    change = spark.createDataFrame([(4, 0, "new"), (8, 0, "new")], df.schema)
    load(dataset, LoadSpec("t", change, write_disposition="upsert", primary_key="id"))
    after = dataset.version("t").parts
    assert sum(p in after for p in before) == 3 and len(after) == 5
    (masked,) = (p for p in after if "mask" in p)
    assert masked["masked"] == 2 and masked["rows"] == 25 and masked["path"].endswith("=0")
    assert dataset.table("t").where("v = 'new'").count() == 2 and dataset.table("t").count() == 100
    load(dataset, LoadSpec("t", df.where("k = 0"), write_disposition="upsert", primary_key="id"))
    assert not any("mask" in p for p in dataset.version("t").parts) and dataset.table("t").where("v = 'old'").count() == 100
    assert dataset.version("t").rows == 100


def test_instants_are_partitioned_by_utc_whatever_the_session_zone(spark, dataset):
    df = spark.range(0, 96).select("id", F.timestamp_seconds(F.col("id") * 1800).alias("ts"))
    zones = ("America/Los_Angeles", "UTC", "Asia/Tokyo")
    try:
        spark.conf.set("spark.sql.session.timeZone", zones[0])
        load(dataset, with_layout(LoadSpec("t", df), [("ts", "day")]))
        assert sorted(p["path"].rsplit("=")[-1] for p in dataset.version("t").parts) == ["1970-01-01", "1970-01-02"]
        for zone in zones:
            spark.conf.set("spark.sql.session.timeZone", zone)
            low, high = F.timestamp_seconds(F.lit(3600 * 5)), F.timestamp_seconds(F.lit(3600 * 30))
            assert dataset.table("t", between=("ts", low, high)).count() == 51
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_identity_partitions_of_instants_prune_alike_in_every_zone(spark, dataset):
    df = spark.range(0, 48).select("id", F.timestamp_seconds(F.col("id") * 3600).alias("ts"))
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        load(dataset, with_layout(LoadSpec("t", df), ["ts"]))
        for zone in ("America/New_York", "UTC", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            low, high = F.timestamp_seconds(F.lit(3600 * 3)), F.timestamp_seconds(F.lit(3600 * 9))
            assert dataset.table("t", between=("ts", low, high)).count() == 7
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _files(spark, dataset, column):
    """Range of the column in every data file, per directory."""
    found = {}
    for part in dataset.version("t").parts:
        frame = spark.read.parquet(f"{dataset.root}/public/t/data/{part['path']}")
        got = frame.groupBy(F.col("_metadata.file_name")).agg(F.min(column), F.max(column), F.count("*")).collect()
        found[part["path"]] = sorted(tuple(r)[1:] for r in got)
    return found


@pytest.mark.parametrize("partition", [None, ["k"]])
def test_files_of_a_sorted_table_do_not_overlap(spark, dataset, partition):
    df = spark.range(4000).select((F.col("id") % 2).alias("k"), (F.xxhash64("id") % 5000).alias("v"), F.col("id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        load(dataset, with_layout(LoadSpec("t", df.repartition(4)), partition, ["v"]))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = _files(spark, dataset, "v")
    assert sum(len(f) for f in files.values()) >= 4
    for ranges in files.values():
        for (_, high, _), (low, _, _) in zip(ranges, ranges[1:]):
            assert high <= low
    assert rows(dataset.table("t").select("id")) == rows(df.select("id"))
    # a read of a few values opens the files whose range holds them
    version = dataset.version("t")
    kept = dataset._outside("t", version, "v", 100, 110)
    opened = sum(len(files[p["path"]]) - len(p.get("without", ())) for p in kept)
    assert opened == sum(low <= 110 and high >= 100 for f in files.values() for low, high, _ in f) < sum(map(len, files.values()))
    want = df.where("v between 100 and 110")
    got = dataset.table("t", between=("v", 100, 110))
    assert rows(got.select("id")) == rows(want.select("id"))


def test_a_sort_key_with_most_rows_is_cut_into_files_of_its_own(spark, dataset):
    df = spark.range(6000).select(F.when(F.col("id") % 3 != 0, F.lit(7)).otherwise(F.col("id")).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        load(dataset, with_layout(LoadSpec("t", df), None, [("v", "desc")]))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    (files,) = _files(spark, dataset, "v").values()
    assert len(files) == 4 and max(n for *_, n in files) < 3000
    assert sum(n for *_, n in files) == 6000


def test_expected_rows_of_a_sorted_table(spark, dataset):
    df = spark.range(50).select("id")
    load(dataset, with_layout(LoadSpec("t", df, expected_rows=50), None, ["id"]))
    with pytest.raises(IncompleteReadError, match="received 50 of 49"):
        load(dataset, LoadSpec("t", df, expected_rows=49))
    assert dataset.version("t").rows == dataset.table("t").count() == 50


def test_spans_outlive_masks_and_are_vacuumed_with_their_version(spark, dataset):
    df = spark.range(300).select("id", (F.col("id") * 7 % 300).alias("v"))
    load(dataset, with_layout(LoadSpec("t", df, write_disposition="upsert", primary_key="id"), None, ["v"]))
    load(dataset, LoadSpec("t", df.where("v between 20 and 25").withColumn("v", F.lit(1000).cast("long")), write_disposition="upsert", primary_key="id"))
    assert dataset.table("t", between=("v", 10, 30)).count() == 15
    assert dataset.table("t", between=("v", 1000, 1000)).count() == 6
    before = fs.children(spark, f"{dataset.root}/public/t/spans")
    dataset.compact("t")
    dataset.vacuum("t")
    assert len(before) == 2 and len(fs.children(spark, f"{dataset.root}/public/t/spans")) == 1
    assert dataset.table("t", between=("v", 10, 30)).count() == 15
