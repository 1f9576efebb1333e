import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lodeworks import Dataset, LoadError, LoadSpec, load, load_incremental
from lodeworks.operators import bookkeeping as ops
from lodeworks.plans import dataset as dataset_module
from lodeworks.plans import files as fs
from lodeworks.plans import state


def batch(spark, *ids):
    return LoadSpec("t", spark.createDataFrame([(i,) for i in ids], "id long"))


def states(spark, *pipelines):
    data = [(p, f"load_{i:03d}", f"id_{p}{i}", f"s{i}") for i, p in enumerate(pipelines)]
    return spark.createDataFrame(data, "pipeline_name string, _dlt_load_id string, _dlt_id string, state string")


def test_one_log_row_per_load_and_one_version_per_schema(spark, dataset):
    for i in range(3):
        load(dataset, batch(spark, i), load_id=f"L{i}", schema_name="shop")
    wider = LoadSpec("t", spark.createDataFrame([(9, "x")], "id long, note string"))
    for i in (3, 4):
        load(dataset, wider, load_id=f"L{i}", schema_name="shop")
    log = dataset.bookkeeping("_dlt_loads")
    assert rows(log.select("load_id", "status", "schema_name")) == [(f"L{i}", 0, "shop") for i in range(5)]
    versions = dataset.bookkeeping("_dlt_version")
    assert rows(versions.select("version")) == [(1,), (2,)]
    hashes = [r[0] for r in log.orderBy("load_id").select("schema_version_hash").collect()]
    assert len(set(hashes[:3])) == 1 and len(set(hashes[3:])) == 1 and hashes[0] != hashes[4]
    assert state.get_stored_schema(dataset, "shop").first()["version"] == 2
    assert state.get_stored_schema(dataset).first()["version"] == 2
    assert state.get_stored_schema(dataset, "other").count() == 0
    assert state.get_stored_schema_by_hash(dataset, hashes[0]).first()["version"] == 1
    assert state.get_stored_schema_by_hash(dataset, "none").count() == 0


def test_never_loaded_reads_as_empty_but_a_broken_read_raises(spark, dataset):
    assert dataset.bookkeeping("_dlt_pipeline_state").count() == 0
    assert state.read_state(dataset, "p") is None
    load(dataset, batch(spark, 1), load_id="L1")
    fs.delete(spark, f"{dataset.root}/public/_dlt_loads/data")
    with pytest.raises(PySparkException):
        state.is_complete(dataset, "L1")


def test_state_counts_only_once_its_load_is_complete(spark, dataset):
    load(dataset, batch(spark, 1), load_id="L1", pipeline="p", state={"n": 1})
    state.save_state(dataset, "p", {"n": 2}, "L2")
    assert state.read_state(dataset, "p") == {"n": 1}
    state.complete_load(dataset, "L2", "default", None)
    assert state.read_state(dataset, "p") == {"n": 2}
    assert state.read_state(dataset, "it's another") is None


def test_latest_state_skips_failed_loads(spark):
    loads = spark.createDataFrame([("load_000", 0), ("load_001", 1), ("load_002", 0)], "load_id string, status int")
    got = ops.latest_state(states(spark, "p", "p", "q", "p"), loads)
    assert rows(got.select("pipeline_name", "state")) == [("p", "s0"), ("q", "s2")]
    assert ops.latest_state(states(spark, "p", "p", "q"), loads, "p").first()["state"] == "s0"


@pytest.mark.parametrize("keep, left", [(2, ["s3", "s4"]), (0, "all"), (4, "all"), (3, "all"), (1, ["s4"])])
def test_prune_rule(spark, keep, left):
    table = states(spark, *"ppppp")
    got = [r[0] for r in rows(ops.prune_state(table, keep).select("state"))]
    assert got == (["s0", "s1", "s2", "s3", "s4"] if left == "all" else left)


def test_prune_keeps_the_newest_of_each_pipeline(spark):
    got = ops.prune_state(states(spark, *"ababaaaab"), 2)
    assert rows(got.select("state")) == [("s3",), ("s6",), ("s7",), ("s8",)]


def test_newest_per_group_beyond_the_limit_of_the_engine(spark):
    df = spark.range(500).select(F.when(F.col("id") % 2 == 0, F.lit(0)).alias("g"), (F.col("id") - F.col("id") % 4).alias("at"), "id")
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "1")
    try:
        got = ops.newest_per_group(df, ["g"], ["id"], 5)
        assert rows(got.select("id")) == sorted([(i,) for i in range(490, 500)], key=str)
        # ties at the border: as many of them as fit
        tied = [r["at"] for r in ops.newest_per_group(df.where("g = 0"), ["g"], ["at"], 5).collect()]
        assert sorted(tied) == [488, 492, 492, 496, 496]
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def test_state_is_trimmed_after_loads(spark, dataset):
    for i in range(7):
        load(dataset, batch(spark, i), load_id=f"L{i}", pipeline="p", state=i, max_state_rows=2)
    left = rows(dataset.bookkeeping("_dlt_pipeline_state").select("_dlt_load_id"))
    assert left[-1] == ("L6",) and len(left) < 4
    assert state.read_state(dataset, "p") == 6


def test_trimming_never_fails_a_load(spark, dataset, monkeypatch):
    for i in range(3):
        load(dataset, batch(spark, i), load_id=f"L{i}", pipeline="p", state=i, max_state_rows=0)
    assert dataset.bookkeeping("_dlt_pipeline_state").count() == 3
    monkeypatch.setattr(dataset, "publish", fail_for_state(dataset.publish))
    with pytest.warns(UserWarning, match="could not trim"):
        load(dataset, batch(spark, 9), load_id="L9", max_state_rows=1)
    assert dataset.bookkeeping("_dlt_pipeline_state").count() == 3
    assert dataset.table("t").count() == 4


def fail_for_state(publish):
    def run(table, version):
        if table == "_dlt_pipeline_state":
            raise dataset_module.fs.ConcurrentPublishError("someone else")
        return publish(table, version)

    return run


def test_trimming_does_nothing_if_no_row_would_stay_or_go(spark, dataset, monkeypatch):
    for i in range(4):
        load(dataset, batch(spark, i), load_id=f"L{i}", pipeline="p", state=i, max_state_rows=0)
    before = dataset.version("_dlt_pipeline_state").number
    for moved in (lambda df, *_: df, lambda df, *_: df.limit(0)):
        monkeypatch.setattr(ops, "newest_per_group", moved)
        assert state.prune_pipeline_state(dataset, 1) == 0
    assert dataset.version("_dlt_pipeline_state").number == before


def test_bookkeeping_only_appends(spark, dataset):
    for i in range(6):
        before = dataset.version("_dlt_loads").parts if i else []
        load(dataset, batch(spark, i), load_id=f"L{i}")
        assert dataset.version("_dlt_loads").parts[: len(before)] == before
    assert dataset.bookkeeping("_dlt_loads").count() == 6 == dataset.version("_dlt_loads").rows
    dataset.compact("_dlt_loads")
    assert len(dataset.version("_dlt_loads").parts) == 1 and dataset.bookkeeping("_dlt_loads").count() == 6


def test_loads_of_two_pipelines_at_once_are_both_logged(spark, dataset):
    """Each publish of the one finds that the other got in between."""
    load(dataset, batch(spark, 0), load_id="L0")
    publish, raced = dataset.publish, []

    def overtaken(table, version):
        if (table, len(raced)) in (("t", 0), ("_dlt_loads", 1)):
            raced.append(table)
            if table == "t":
                load(Dataset(spark, dataset.root), batch(spark, 50), load_id="other")
            else:
                other = Dataset(spark, dataset.root)
                other.publish(table, other.version(table))
        return publish(table, version)

    dataset.publish = overtaken
    load(dataset, batch(spark, 1), load_id="L1")
    assert raced == ["t", "_dlt_loads"]
    assert rows(dataset.bookkeeping("_dlt_loads").select("load_id")) == [("L0",), ("L1",), ("other",)]
    assert dataset.table("t").count() == 3 == dataset.version("t").rows


@pytest.mark.parametrize("disposition", ["append", "replace", "upsert", "insert-only", "merge"])
def test_a_broken_load_is_not_applied_again_after_another(spark, dataset, monkeypatch, disposition):
    def spec(*ids):
        df = spark.createDataFrame([(i, "v") for i in ids], "id long, v string")
        return LoadSpec("t", df, write_disposition=disposition, primary_key="id")

    def broken(*_):
        raise RuntimeError("the driver died")

    with monkeypatch.context() as m:
        m.setattr(state, "complete_load", broken)
        with pytest.raises(RuntimeError):
            load(dataset, spec(1, 2), load_id="A")
    load(dataset, spec(3), load_id="B")
    after = rows(dataset.table("t").select("id"))
    report = load(dataset, spec(1, 2), load_id="A")
    assert rows(dataset.table("t").select("id")) == after and report.collect() == []
    assert state.completed(dataset, ["A", "B", "C"]) == {"A", "B"}
    load(dataset, spec(4), load_id="C")
    assert dataset.version("t").loads == ["C"]


# -- incremental -------------------------------------------------------------------------


def events(spark, *data):
    return LoadSpec("events", spark.createDataFrame(list(data), "id long, updated long"), primary_key="id")


def test_open_cursor_lands_each_row_once(spark, dataset):
    one, two = [(1, 10), (2, 20)], [(3, 30)]
    for seen in (one, one + two, one + two):
        load_incremental(dataset, events(spark, *seen), "updated", pipeline="p", closed=False)
    assert rows(dataset.table("events").select("id")) == [(1,), (2,), (3,)]
    assert state.read_state(dataset, "p")["events"] == {"cursor": "updated", "last_value": "30"}


def test_closed_cursor_reads_the_boundary_again(spark, dataset):
    for seen in ([(1, 10), (2, 20)], [(1, 10), (2, 20), (3, 20)], [(2, 20), (3, 20), (4, 21)]):
        load_incremental(dataset, events(spark, *seen), "updated", pipeline="p")
    assert rows(dataset.table("events").select("id")) == [(1,), (2,), (3,), (4,)]


def test_an_open_cursor_misses_late_rows_at_the_boundary(spark, dataset):
    for seen in ([(2, 20)], [(2, 20), (3, 20)]):
        load_incremental(dataset, events(spark, *seen), "updated", pipeline="p", closed=False)
    assert rows(dataset.table("events").select("id")) == [(2,)]


def test_closed_cursor_needs_a_key(spark, dataset):
    keyless = LoadSpec("events", spark.createDataFrame([(1, 10)], "id long, updated long"))
    load_incremental(dataset, keyless, "updated", pipeline="p", closed=True)
    with pytest.raises(LoadError, match="key"):
        load_incremental(dataset, keyless, "updated", pipeline="p", closed=True)


def test_rows_without_a_cursor_value(spark, dataset):
    seen = events(spark, (1, 10), (2, None), (3, 20))
    with pytest.raises(LoadError, match="null_cursors"):
        load_incremental(dataset, seen, "updated", pipeline="p")
    load_incremental(dataset, seen, "updated", pipeline="p", null_cursors="exclude")
    assert rows(dataset.table("events").select("id")) == [(1,), (3,)]
    for _ in range(2):
        load_incremental(dataset, events(spark, (1, 10), (2, None), (3, 20), (4, 20)), "updated", pipeline="p", null_cursors="include")
    assert rows(dataset.table("events").select("id")) == [(1,), (2,), (3,), (4,)]


def test_incremental_load_of_files(spark, dataset, tmp_path):
    for k in range(3):
        spark.range(10 * k, 10 * k + 10).select("id", F.col("id").alias("updated")).coalesce(1).write.parquet(str(tmp_path / str(k)))
        files = [str(tmp_path / str(n)) for n in range(k + 1)]
        load_incremental(dataset, LoadSpec("events", files, primary_key="id"), "updated", pipeline="p")
    assert dataset.table("events").count() == 30


def test_incomplete_run_does_not_move_the_cursor(spark, dataset):
    load_incremental(dataset, events(spark, (1, 10)), "updated", pipeline="p", load_id="L1")
    broken = events(spark, (1, 10), (2, 20))
    from dataclasses import replace

    stop = F.raise_error(F.lit("boom")).cast("long")
    bad = replace(broken, data=broken.data.withColumn("extra", F.when(F.col("id") == 2, stop)))
    with pytest.raises(Exception, match="boom"):
        load_incremental(dataset, bad, "updated", pipeline="p", load_id="L2")
    load_incremental(dataset, broken, "updated", pipeline="p", load_id="L3")
    assert rows(dataset.table("events").select("id")) == [(1,), (2,)]


def test_cursor_predicate_reaches_the_scan(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "f"))
    plan = ops.since(spark.read.parquet(str(tmp_path / "f")), "id", 3, up_to=7)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,3), LessThanOrEqual(id,7)]" in text
    assert plan.count() == 4


def test_instant_cursor_survives_a_change_of_session_zone(spark, dataset):
    def seen(n):
        rows_ = spark.range(n).select("id", F.timestamp_seconds(F.col("id") * 3600 + 1_700_000_000).alias("at"))
        return LoadSpec("events", rows_)

    try:
        for n, zone in ((3, "Asia/Tokyo"), (5, "America/Los_Angeles"), (5, "UTC")):
            spark.conf.set("spark.sql.session.timeZone", zone)
            load_incremental(dataset, seen(n), "at", pipeline="p")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert rows(dataset.table("events").select("id")) == [(i,) for i in range(5)]


@pytest.mark.parametrize("limit", ["1", "1000"])
def test_newest_rows_per_group_are_the_same_by_either_plan(spark, limit):
    """By ranks kept per task, and by counts laid out by range."""
    df = spark.range(400).select((F.col("id") % 7).alias("g"), F.when(F.col("id") % 11 > 0, F.col("id") % 50).alias("o"), F.col("id").alias("p"))
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", limit)
    try:
        got = rows(ops.newest_per_group(df, ["g"], ["o", "p"], 13))
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    placed = sorted(df.collect(), key=lambda r: (r.g, r.o is None, -(r.o or 0), -r.p))
    want = [tuple(r) for k, r in enumerate(placed) if sum(x.g == r.g for x in placed[:k]) < 13]
    assert got == sorted(want, key=lambda r: [(v is None, str(v)) for v in r])
