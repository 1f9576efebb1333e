"""The dataset as a Spark data source, and streams from its versions."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lodeworks import Dataset, LoadSpec, delete_rows, load, with_layout
from lodeworks.plans import files as fs
from lodeworks.plans import tablelog
from lodeworks.plans.loader import declare_tables
from lodeworks.sources import datasource
from lodeworks.sources.datasource import Log, register


@pytest.fixture
def read(spark, dataset):
    register(spark)

    def go(table="t", **options):
        return spark.read.format("lodeworks").options(path=dataset.root, table=table, **options).load()

    return go


def test_the_format_gives_the_table(spark, dataset, read):
    df = spark.range(100).select(
        "id", (F.col("id") % 3).cast("int").alias("k"), F.concat(F.lit("é x/"), F.col("id") % 5).alias("v"), F.timestamp_seconds(F.col("id") * 7777).alias("at"),
        F.when(F.col("id") % 2 > 0, F.array("id")).alias("a"), F.col("id").cast("decimal(12,2)").alias("d"), F.lit(1.5).alias("f"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("day"), F.struct(F.col("id").alias("x")).alias("s"),
    )
    load(dataset, with_layout(LoadSpec("t", df, write_disposition="upsert", primary_key="id"), ["v"]))
    load(dataset, LoadSpec("t", df.limit(7).withColumn("k", F.lit(2**40)).withColumn("new", F.lit("n")), write_disposition="upsert", primary_key="id"))
    delete_rows(dataset, "t", spark.range(50, 60), ["id"])
    got, want = read(), dataset.table("t")
    assert got.dtypes == want.dtypes and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    for test in ("id = 33", "id in (3, 4, 55)", "k > 5", "v like '%x/2' and id >= 90", "new is not null", "v = 'é x/1' and day < '2024-01-20'"):
        assert rows(got.where(test).select("id")) == rows(want.where(test).select("id")), test


def test_empty_tables_and_unknown_ones(spark, dataset, read):
    load(dataset, LoadSpec("t", spark.range(0).withColumn("v", F.lit("x"))))
    assert read().count() == 0 and read().columns[:2] == ["id", "v"]
    declare_tables(dataset, ["bare"])
    with pytest.raises(Exception, match="does not exist"):
        read("nope").count()
    with pytest.raises(Exception, match="needs the option table"):
        spark.read.format("lodeworks").option("path", dataset.root).load()


def test_batches_are_cut_and_never_combined(spark, dataset):
    load(dataset, LoadSpec("t", spark.range(0, 250, 1, 4)))
    version = dataset.version("t")
    files = datasource._planned(Log(dataset.root, "t"), version.parts, version.schema, 40)
    sizes = [[b.num_rows for b in datasource.read_file(f)] for f in files]
    assert len(files) == version.parts[0]["files"] and sum(map(sum, sizes)) == 250
    assert all(n == 40 for each in sizes for n in each[:-1]) and all(0 < each[-1] <= 40 for each in sizes)


def test_lost_files_and_rows_are_noticed(spark, dataset, read, monkeypatch):
    load(dataset, LoadSpec("t", spark.range(0, 250, 1, 4)))
    version = dataset.version("t")
    (file, *_) = datasource._planned(Log(dataset.root, "t"), version.parts, version.schema, 40)

    class Short(datasource.pq.ParquetFile):
        def iter_batches(self, **options):
            yield from list(super().iter_batches(**options))[:-1]

    monkeypatch.setattr(datasource.pq, "ParquetFile", Short)
    with pytest.raises(RuntimeError, match="incomplete read"):
        list(datasource.read_file(file))
    fs.delete(spark, f"{dataset.root}/public/t/{file.path}")
    with pytest.raises(Exception, match="incomplete read"):
        read().count()


def test_tables_of_many_parts(spark, dataset, read, monkeypatch):
    monkeypatch.setattr(tablelog, "DELTA", 3)
    df = spark.range(60).withColumn("k", F.col("id") % 6)
    load(dataset, with_layout(LoadSpec("t", df), ["k"]))
    load(dataset, LoadSpec("t", df.limit(5)))
    assert dataset.version("t").base and read().count() == 65


@pytest.fixture
def follow(spark, dataset, tmp_path):
    register(spark)
    out, check = str(tmp_path / "out"), str(tmp_path / "check")

    def go(**options):
        stream = spark.readStream.format("lodeworks").options(path=dataset.root, table="t", **options).load()
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", check).trigger(availableNow=True).start()
        query.awaitTermination()
        return rows(spark.read.parquet(out).select("id")) if fs.exists(spark, out) else []

    return go


def test_a_stream_gives_each_appended_row_once(spark, dataset, follow):
    ids = lambda *n: sorted(((i,) for i in n), key=lambda r: str(r[0]))
    load(dataset, LoadSpec("t", spark.range(3)))
    assert follow() == ids(0, 1, 2)
    assert follow() == ids(0, 1, 2)
    load(dataset, LoadSpec("t", spark.range(10, 12)))
    load(dataset, LoadSpec("t", spark.range(20, 21)))
    assert follow() == ids(0, 1, 2, 10, 11, 20)
    dataset.compact("t")
    load(dataset, LoadSpec("t", spark.range(30, 31)))
    with pytest.raises(Exception, match="changed stored rows"):
        follow()
    assert follow(on_rewrite="skip") == ids(0, 1, 2, 10, 11, 20, 30)
    delete_rows(dataset, "t", spark.range(1), ["id"])
    load(dataset, LoadSpec("t", spark.range(40, 41)))
    assert follow(on_rewrite="skip") == ids(0, 1, 2, 10, 11, 20, 30, 40)


def test_a_stream_whose_versions_are_gone_says_so(spark, dataset, follow):
    for k in range(3):
        load(dataset, LoadSpec("t", spark.range(k, k + 1)))
    dataset.vacuum("t")
    with pytest.raises(Exception, match="no longer kept"):
        follow()
    assert follow(start=dataset.version("t").number - 0) == []
    load(Dataset(spark, dataset.root), LoadSpec("t", spark.range(9, 10)))
