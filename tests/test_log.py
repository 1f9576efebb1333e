"""Version files, masks and key filters of a table."""

import json
from dataclasses import replace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lodeworks import ConcurrentPublishError, Dataset, LoadSpec, delete_rows, load, update_rows
from lodeworks.plans import dataset as dataset_module
from lodeworks.plans import files as fs
from lodeworks.plans import masks, tablelog


def scanned(df):
    """Rows that the file scans of a frame gave, which its filters on keys then see."""
    df.collect()
    return _scanned(df._jdf.queryExecution().executedPlan())


def _scanned(plan):
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return _scanned(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return _scanned(plan.plan())
    if kind == "FileSourceScanExec":
        return plan.metrics().apply("numOutputRows").value()
    children, total = plan.children().iterator(), 0
    while children.hasNext():
        total += _scanned(children.next())
    return total


def test_publishing_costs_what_changes_not_what_there_is(spark, dataset):
    load(dataset, LoadSpec("t", spark.range(3)))
    version = dataset.version("t")
    real = version.parts[0]
    sizes = {}
    for count in (5, 5000):
        parts = [real, *({**real, "path": f"__part=made-{count}-{k}"} for k in range(count))]
        base = dataset.publish("t", replace(dataset.version("t"), parts=parts, rows=count))
        appended = dataset.publish_append("t", base, [{**real, "path": "__part=one-more"}], 3)
        sizes[count] = len(fs.read_text(spark, dataset.log("t").file(appended.number)))
        again = Dataset(spark, dataset.root).version("t")
        assert [p["path"] for p in again.parts] == [p["path"] for p in parts] + ["__part=one-more"] and again.rows == count + 3
    assert appended.base and sizes[5000] < sizes[5]
    fewer = dataset.publish("t", replace(again, parts=[p for p in again.parts if not p["path"].endswith("7")] + [{**real, "path": "__part=late"}]))
    assert dataset.version("t").parts == fewer.parts and fewer.base != appended.base
    dataset.publish("t", replace(fewer, parts=[{**fewer.parts[0], "rows": 9}, *fewer.parts[1:]]))
    assert {**fewer.parts[0], "rows": 9} in dataset.version("t").parts and len(dataset.version("t").parts) == len(fewer.parts)
    names = fs.children(spark, f"{dataset.root}/public/t/checkpoints")
    assert len(names) == 2
    dataset.vacuum("t")
    assert fs.children(spark, f"{dataset.root}/public/t/checkpoints") == [dataset.version("t").base]


def test_a_lost_race_leaves_no_version(spark, dataset, monkeypatch):
    monkeypatch.setattr(tablelog, "DELTA", 1)
    load(dataset, LoadSpec("t", spark.range(3)))
    version = dataset.version("t")
    for k in range(3):
        load(dataset, LoadSpec("t", spark.range(k)))
    with pytest.raises(ConcurrentPublishError):
        dataset.publish("t", version)
    assert dataset.version("t").base and dataset.table("t").count() == 6 == Dataset(spark, dataset.root).version("t").rows


def test_two_first_loads_declare_the_log_once(spark, dataset):
    publish, other = dataset.publish, Dataset(spark, dataset.root)

    def overtaken(table, version):
        dataset.publish = publish
        load(other, LoadSpec("b", spark.range(2)))
        return publish(table, version)

    dataset.publish = overtaken
    load(dataset, LoadSpec("a", spark.range(1)))
    assert dataset.table("a").count() == 1 and dataset.table("b").count() == 2
    assert dataset.bookkeeping("_dlt_loads").count() == 2


def test_a_delete_writes_no_data_file_and_masks_add_up(spark, dataset):
    load(dataset, LoadSpec("t", spark.range(0, 300, 1, 3).withColumn("v", F.lit("a"))))
    home = f"{dataset.root}/public/t/data"
    before = fs.children(spark, home)
    for ids, left in (((7,), 299), ((7, 8, 299), 297), (range(100, 200), 197)):
        delete_rows(dataset, "t", spark.createDataFrame([(i,) for i in ids], "id long"), ["id"])
        assert dataset.table("t").count() == left == dataset.version("t").rows
    assert fs.children(spark, home) == before
    (part,) = dataset.version("t").parts
    assert part["masked"] == 103 and part["rows"] == 300
    assert masks.rows_by_part(masks.read_masks(spark, f"{dataset.root}/public/t", [part["mask"]])) == {part["path"].removeprefix("__part="): 103}
    assert rows(dataset.table("t").where("id between 5 and 10 or id > 296").select("id")) == sorted(((i,) for i in (5, 6, 9, 10, 297, 298)), key=lambda r: str(r[0]))
    update_rows(dataset, "t", spark.createDataFrame([(9, "b"), (150, "b")], "id long, v string"), ["id"])
    assert rows(dataset.table("t").where("v = 'b'").select("id")) == [(9,)] and dataset.table("t").count() == 197
    dataset.vacuum("t")
    assert fs.children(spark, f"{dataset.root}/public/t/masks") == [dataset.version("t").parts[0]["mask"]]
    assert delete_rows(dataset, "t", spark.range(1000), ["id"]) == 197
    assert dataset.version("t").parts == [] and dataset.table("t").count() == 0
    assert delete_rows(dataset, "t", spark.range(0), ["id"]) == 0


def test_scattered_keys_open_the_row_groups_that_may_hold_them(spark, dataset):
    """Forty files, each with keys from all over the range."""
    df = spark.range(40_000).select((F.col("id") * 977 % 1_000_003).alias("id"), F.lit(1).alias("v"))
    load(dataset, LoadSpec("t", df.repartition(40, F.xxhash64("id")), primary_key="id"))
    version, key = dataset.version("t"), ["id"]
    keys = df.select("id").limit(3)
    listed, bounds = dataset._sought(keys, key, {})
    for given, least, most in ((listed, 1, 40_000 * 8 // 40), ({}, 40_000, 40_000)):
        hits = dataset._matched_rows("t", version, keys, key, {}, given)
        assert least <= scanned(hits) <= most and hits.count() == 3
    assert bounds == {"id": (min(listed["id"]), max(listed["id"]))}


def test_few_and_many_keys_give_equal_rows(spark, dataset, monkeypatch):
    df = spark.range(500).select("id", (F.col("id") % 7).cast("string").alias("k"), F.lit("old").alias("v"))
    change = df.where("id % 5 = 0").withColumn("v", F.lit("new")).unionByName(df.limit(9).withColumn("id", F.col("id") + 900))
    left = []
    for name, few in (("a", 0), ("b", 1000)):
        monkeypatch.setattr(dataset_module, "_LISTED", few)
        load(dataset, LoadSpec(name, df, write_disposition="upsert", primary_key=["k", "id"]))
        load(dataset, LoadSpec(name, change, write_disposition="upsert", primary_key=["k", "id"]))
        load(dataset, LoadSpec(name, change.withColumn("v", F.lit("more")), write_disposition="insert-only", primary_key=["k", "id"]))
        delete_rows(dataset, name, df.where("id % 11 = 0").select("k", "id"), ["k", "id"])
        update_rows(dataset, name, df.where("id % 13 = 0").withColumn("v", F.lit("last")), ["k", "id"])
        left.append(rows(dataset.table(name).select("id", "k", "v")))
    assert left[0] == left[1] and len(left[0]) == 500 + 9 - 46


def test_parts_out_of_range_are_not_opened(spark, dataset):
    for low in (0, 100, 200):
        load(dataset, LoadSpec("t", spark.range(low, low + 50).coalesce(1), write_disposition="upsert", primary_key="id"))
    version = dataset.version("t")
    assert [p["range"] for p in version.parts] == [{"id": [low, low + 49]} for low in (0, 100, 200)]
    broken = f"{dataset.root}/public/t/data/{version.parts[0]['path']}"
    for name in fs.data_files(spark, broken):
        fs.delete(spark, name)
        fs.write_new(spark, name, "not parquet")
    assert delete_rows(dataset, "t", spark.range(210, 212), ["id"]) == 2
    assert json.loads(fs.read_text(spark, dataset.log("t").file(dataset.version("t").number)))["rows"] == 148


def test_compaction_packs_small_files_and_leaves_good_ones(spark, dataset):
    load(dataset, LoadSpec("t", spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v")).coalesce(1)))
    good = dataset.version("t").parts[0]
    for k in range(4):
        load(dataset, LoadSpec("t", spark.range(k, k + 3).select("id", F.lit("x").alias("v"))))
    dataset.compact("t", target_bytes=good["bytes"])
    parts = dataset.version("t").parts
    assert parts[0] == good and len(parts) == 2 and dataset.table("t").count() == 20_012 == dataset.version("t").rows
    number = dataset.version("t").number
    dataset.compact("t", target_bytes=good["bytes"])
    assert dataset.version("t").number == number
