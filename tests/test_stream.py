import pytest
from conftest import rows

from pyspark.sql import functions as F

from lodeworks import LoadSpec, load, stream_load


def put(spark, path, *data):
    spark.createDataFrame(list(data), "id long, v string, n int").coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def run(spark, dataset, tmp_path):
    path = str(tmp_path / "in")
    put(spark, path)

    def go(**options):
        stream = spark.readStream.schema("id long, v string, n int").parquet(path)
        spec = LoadSpec("t", stream, **options)
        stream_load(dataset, spec, checkpoint=str(tmp_path / "check"), query_name="q").awaitTermination()

    return path, go


def test_upsert_over_micro_batches(spark, dataset, run):
    path, go = run
    put(spark, path, (1, "a", 0), (1, "b", 1), (2, "c", 0))
    go(write_disposition="upsert", primary_key="id", order_by=["n"])
    assert rows(dataset.table("t").select("id", "v")) == [(1, "b"), (2, "c")]
    put(spark, path, (2, "d", 0), (3, "e", 0))
    go(write_disposition="upsert", primary_key="id", order_by=["n"])
    assert rows(dataset.table("t").select("id", "v")) == [(1, "b"), (2, "d"), (3, "e")]
    go(write_disposition="upsert", primary_key="id", order_by=["n"])
    assert dataset.bookkeeping("_dlt_loads").count() == 2


def test_a_replayed_batch_changes_nothing(spark, dataset, run, tmp_path):
    """Every batch comes again with the same number, as after a crash before the commit."""
    path, go = run
    put(spark, path, (1, "a", 0), (2, "b", 0))
    go()
    for name in ("commits", "offsets"):
        for file in (tmp_path / "check" / name).iterdir():
            file.unlink()
    go()
    assert rows(dataset.table("t").select("id")) == [(1,), (2,)]


@pytest.fixture
def first(spark, dataset, tmp_path):
    from lodeworks.streaming.firstseen import stream_insert_only

    path = str(tmp_path / "in")
    put(spark, path)

    def go(**options):
        stream = spark.readStream.schema("id long, v string, n int").option("maxFilesPerTrigger", 1).parquet(path)
        stream = stream.select("*", F.timestamp_seconds("n").alias("at"))
        spec = LoadSpec("t", stream, primary_key="id", write_disposition="insert-only", columns={"gone": {"hard_delete": True}})
        stream_insert_only(dataset, spec, checkpoint=str(tmp_path / "check"), query_name="q", **options).awaitTermination()
        return rows(dataset.table("t").select("id", "v", "n"))

    return path, go


def test_insert_only_by_state(spark, dataset, first, monkeypatch):
    """All rows of the batch that brings a key first; keys the table had before, and a restart in the middle."""
    from lodeworks.plans import loader

    path, go = first
    load(dataset, LoadSpec("t", spark.createDataFrame([(5, "old", 0)], "id long, v string, n int"), primary_key="id"))
    put(spark, path, (1, "a", 0), (1, "b", 1), (5, "no", 0), (2, None, None))
    put(spark, path, (1, "late", 0), (3, "c", 0), (2**60 + 1, "big", None))
    want = [(1, "a", 0), (1, "b", 1), (2, None, None), (2**60 + 1, "big", None), (3, "c", 0), (5, "old", 0)]
    key = lambda r: [(v is None, str(v)) for v in r]
    monkeypatch.setattr(loader, "known_keys", None)  # nothing looks the target's keys up
    monkeypatch.setattr(type(dataset), "near", None)
    assert go() == sorted(want, key=key)
    put(spark, path, (3, "late", 1), (4, "d", 0))
    assert go() == sorted([*want, (4, "d", 0)], key=key)
    assert go() == sorted([*want, (4, "d", 0)], key=key)
    assert dataset.table("t").where("at = timestamp_seconds(1)").count() == 1


def test_a_crash_between_load_and_commit_changes_nothing(spark, dataset, first, monkeypatch):
    from lodeworks.streaming import microbatch

    path, go = first
    put(spark, path, (1, "a", 0), (2, "b", 0))
    go()
    put(spark, path, (1, "late", 0), (3, "c", 0), (3, "d", 1))

    def crashed(*args, **options):
        load(*args, **options)
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as m:
        m.setattr(microbatch, "load", crashed)
        with pytest.raises(Exception, match="lost the driver"):
            go()
    assert go() == [(1, "a", 0), (2, "b", 0), (3, "c", 0), (3, "d", 1)]
    assert dataset.version("t").rows == 4


def test_a_key_is_forgotten_after_its_time(spark, dataset, first):
    path, go = first
    put(spark, path, (1, "a", 0))
    go(remember_ms=1)
    put(spark, path, (1, "again", 0))
    assert go(remember_ms=1) == [(1, "a", 0), (1, "again", 0)]
