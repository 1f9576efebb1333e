from conftest import rows
from pyspark.sql import functions as F

from lodeworks import LoadSpec, load
from lodeworks.functions.jsontext import parse_json_text


def parsed(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, j string")
    return parse_json_text(df, ["j"])


def test_fields_of_all_rows_and_numbers_that_widen(spark):
    out = parsed(spark, '{"a": 1, "b": {"c": [1, 2]}}', '{"a": 2.5, "d": null}', None, '{"b": {"c": []}, "x y": true}')
    assert out.columns == ["id", "j"]
    got = {r["id"]: r["j"] for r in out.collect()}
    assert [float(got[0]["a"]), float(got[1]["a"]), got[3]["a"], got[2]] == [1.0, 2.5, None, None]
    assert got[0]["b"]["c"] == [1, 2] and got[3]["b"]["c"] == [] and got[3]["x y"] is True and got[1]["d"] is None


def test_places_of_several_types_are_text(spark):
    out = parsed(spark, '{"v": 1, "VARIANT": 5}', '{"v": "one"}', '{"v": {"deep": [1]}}')
    got = [r["j"] for r in out.orderBy("id").collect()]
    assert [g["v"] for g in got] == ["1", "one", '{"deep":[1]}']
    assert got[0]["VARIANT"] == 5


def test_text_that_is_no_json_is_kept_beside(spark):
    out = parsed(spark, '{"a": 1}', "not json", "", None)
    assert out.columns == ["id", "j", "j__text"]
    assert [(r["j"] and r["j"]["a"], r["j__text"]) for r in out.orderBy("id").collect()] == [(1, None), (None, "not json"), (None, ""), (None, None)]


def test_columns_without_a_schema_stay(spark):
    for texts in (['{"a": 1}', "[1]"], [None, "null"], [None], ["{}", "{}"]):
        out = parsed(spark, *texts)
        assert out.dtypes == [("id", "bigint"), ("j", "string")]
        assert [r["j"] for r in out.orderBy("id").collect()] == texts
    empty = spark.createDataFrame([], "id long, j string")
    assert parse_json_text(empty, ["j"]).dtypes == empty.dtypes


def test_lists_and_maps_become_children(spark, dataset):
    df = spark.createDataFrame([(1, '{"tags": [{"n": 1}, {"n": 2}], "k": "x"}'), (2, '{"tags": []}')], "id long, j string")
    df = df.withColumn("m", F.when(F.col("id") == 1, F.create_map(F.lit("a"), F.array(F.lit(1), F.lit(2)))))
    spec = LoadSpec("t", df, nested=True, primary_key="id", write_disposition="upsert", columns={"j": {"parse_json": True}})
    load(dataset, spec)
    load(dataset, spec)
    assert rows(dataset.table("t").select("id", "j__k")) == [(1, "x"), (2, None)]
    assert rows(dataset.table("t__j__tags").select("_dlt_list_idx", "n")) == [(0, 1), (1, 2)]
    assert rows(dataset.table("t__m").select("key")) == [("a",)]
    assert rows(dataset.table("t__m__value").select("value")) == [(1,), (2,)]
