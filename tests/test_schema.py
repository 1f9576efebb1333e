import pytest
from conftest import rows
from pyspark.sql import types as T

from lodeworks.errors import LoadError, SchemaConflictError
from lodeworks.functions.names import check_names, normalize_identifier
from lodeworks.functions.schema import conform, logical_type, merge_schemas, merge_types


@pytest.fixture(autouse=True)
def session(spark):
    """DDL text is parsed by a session."""


def kind(ddl):
    return T.StructType.fromDDL(f"x {ddl}")["x"].dataType


@pytest.mark.parametrize(
    "a, b, want",
    [
        ("int", "bigint", "bigint"),
        ("bigint", "double", "double"),
        ("int", "float", "double"),
        ("smallint", "float", "float"),
        ("float", "double", "double"),
        ("decimal(12,2)", "decimal(38,9)", "decimal(38,9)"),
        ("decimal(12,2)", "decimal(10,4)", "decimal(14,4)"),
        ("bigint", "decimal(38,9)", "decimal(38,9)"),
        ("int", "decimal(12,2)", "decimal(12,2)"),
        ("decimal(12,2)", "double", "double"),
        ("string", "binary", "binary"),
        ("array<int>", "array<bigint>", "array<bigint>"),
        ("map<string,int>", "map<string,bigint>", "map<string,bigint>"),
        ("struct<a:int>", "struct<a:bigint,b:string>", "struct<a:bigint,b:string>"),
        ("void", "date", "date"),
    ],
)
def test_widening(a, b, want):
    assert merge_types(kind(a), kind(b)).simpleString() == want
    assert merge_types(kind(b), kind(a)).simpleString() == want


@pytest.mark.parametrize(
    "a, b",
    [
        ("int", "string"),
        ("boolean", "int"),
        ("date", "timestamp"),
        ("timestamp", "timestamp_ntz"),
        ("boolean", "double"),
        ("decimal(38,2)", "decimal(38,9)"),
        ("array<int>", "int"),
    ],
)
def test_refused(a, b):
    with pytest.raises(SchemaConflictError):
        merge_types(kind(a), kind(b), "x")


def test_union_is_by_name_without_case():
    merged = merge_schemas(T.StructType.fromDDL("id int, V string"), T.StructType.fromDDL("v string, ID bigint, n date"))
    assert merged.simpleString() == "struct<id:bigint,V:string,n:date>"


def test_conform_leaves_a_fitting_frame_alone(spark):
    df = spark.createDataFrame([(1, [1])], "id long, xs array<int>")
    assert conform(df, df.schema) is df


def test_conform_at_any_depth(spark):
    df = spark.createDataFrame(
        [(1, [(1, "a")], {"k": (2,)}, (None,)), (2, None, None, None)],
        "id int, items array<struct<n:int,name:string>>, m map<string,struct<v:int>>, s struct<x:int>",
    )
    target = T.StructType.fromDDL(
        "s struct<x:bigint,y:string>, id bigint, items array<struct<name:string,n:bigint>>, "
        "m map<string,struct<v:bigint,w:date>>, extra string"
    )
    got = conform(df, target)
    assert got.schema.simpleString() == target.simpleString()
    first, second = got.orderBy("id").collect()
    assert first["items"][0].asDict() == {"name": "a", "n": 1}
    assert first["m"]["k"].asDict() == {"v": 2, "w": None}
    assert first["s"].asDict() == {"x": None, "y": None}
    assert second["items"] is None and second["m"] is None and second["s"] is None


def test_conform_never_drops_a_column(spark):
    with pytest.raises(SchemaConflictError, match="gone"):
        conform(spark.createDataFrame([(1, 2)], "id int, gone int"), T.StructType.fromDDL("id int"))


def test_logical_types():
    assert logical_type("decimal").simpleString() == "decimal(38,9)"
    assert logical_type("decimal", 12, 2).simpleString() == "decimal(12,2)"
    assert logical_type("wei").simpleString() == "string"
    with pytest.raises(SchemaConflictError):
        logical_type("interval")


@pytest.mark.parametrize("raw, want", [("Orders-Events", "orders_events"), ("_dlt_id", "_dlt_id"), ("", "unnamed"), ("a__b", "a__b")])
def test_identifiers(raw, want):
    assert normalize_identifier(raw) == want


def test_names_are_checked():
    with pytest.raises(LoadError, match="both"):
        check_names(["A b", "a_B"])
    with pytest.raises(LoadError, match="longer"):
        check_names(["x" * 256])


def test_nested_widening_survives_a_round_trip(spark, dataset):
    from lodeworks import LoadSpec, load

    load(dataset, LoadSpec("t", spark.createDataFrame([(1, (1,))], "id int, s struct<a:int>")))
    load(dataset, LoadSpec("t", spark.createDataFrame([(2, (2, "b"))], "id long, s struct<a:long,b:string>")))
    got = dataset.table("t").select("id", "s.a", "s.b")
    assert rows(got) == [(1, 1, None), (2, 2, "b")]
