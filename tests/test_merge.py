"""Load dispositions on hand-made rows."""

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lodeworks.errors import LoadError, NullKeyError, SchemaConflictError
from lodeworks.operators import merge


def frame(spark, data, ddl):
    return spark.createDataFrame(data, ddl)


def test_upsert_replaces_matches_and_inserts_the_rest(spark):
    old = frame(spark, [(1, "old"), (2, "keep")], "id long, v string")
    new = frame(spark, [(1, "new"), (3, "added")], "id long, v string")
    assert rows(merge.upsert(old, new, ["id"])) == [(1, "new"), (2, "keep"), (3, "added")]


def test_insert_only_never_changes_a_row(spark):
    old = frame(spark, [(1, "a")], "id long, v string")
    new = frame(spark, [(1, "b"), (2, "c")], "id long, v string")
    assert rows(merge.insert_only(old, new, ["id"])) == [(1, "a"), (2, "c")]


def test_append_fills_missing_columns(spark):
    old = frame(spark, [(1, "x")], "id long, extra string")
    new = frame(spark, [(2,)], "id long")
    assert rows(merge.append(old, new)) == [(1, "x"), (2, None)]


def test_new_column_is_null_on_old_rows(spark):
    old = frame(spark, [(1, "a"), (2, "b")], "id long, v string")
    new = frame(spark, [(2, "B", "gold"), (3, "c", "silver")], "id long, v string, tier string")
    want = [(1, "a", None), (2, "B", "gold"), (3, "c", "silver")]
    assert rows(merge.upsert(old, new, ["id"])) == want
    assert rows(merge.insert_only(old, new, ["id"])) == [(1, "a", None), (2, "b", None), (3, "c", "silver")]


def test_insert_only_without_new_rows_still_widens_the_schema(spark):
    old = frame(spark, [(1, "a")], "id int, v string")
    new = frame(spark, [(1, "b", "x")], "id long, v string, tier string")
    result = merge.insert_only(old, new, ["id"])
    assert rows(result) == [(1, "a", None)]
    assert dict(result.dtypes)["id"] == "bigint"


def test_whole_row_is_replaced(spark):
    old = frame(spark, [(1, "a", "gold")], "id long, v string, tier string")
    new = frame(spark, [(1, "b")], "id long, v string")
    assert rows(merge.upsert(old, new, ["id"])) == [(1, "b", None)]


def test_decimal_is_not_narrowed(spark):
    old = frame(spark, [(1,)], "id long").withColumn("bal", F.lit("5.25").cast("decimal(12,2)"))
    new = frame(spark, [(2,)], "id long").withColumn("bal", F.lit("1.5").cast("decimal(4,1)"))
    assert dict(merge.upsert(old, new, ["id"]).dtypes)["bal"] == "decimal(12,2)"


@pytest.mark.parametrize(
    "flags, want",
    [
        ([(1, "a2", False), (2, "b", True)], [(1, "a2", False), (3, "c", None)]),
        ([(1, "a2", None)], [(1, "a2", None), (2, "b", None), (3, "c", None)]),
        ([(1, "x", True), (1, "y", False)], [(2, "b", None), (3, "c", None)]),
    ],
)
def test_hard_delete_in_one_file(spark, flags, want):
    old = frame(spark, [(1, "a"), (2, "b"), (3, "c")], "id long, v string")
    new = frame(spark, [(*r, i) for i, r in enumerate(flags)], "id long, v string, deleted boolean, __row_seq long")
    assert rows(merge.upsert(old, new, ["id"], hard_delete="deleted")) == want


def test_hard_delete_by_a_non_boolean_column(spark):
    old = frame(spark, [(1, "a"), (2, "b")], "id long, v string")
    new = frame(spark, [(1, "a2", None), (2, "b2", "2024-01-01")], "id long, v string, deleted_at string")
    assert rows(merge.upsert(old, new, ["id"], hard_delete="deleted_at")) == [(1, "a2", None)]


def test_deleted_in_one_file_and_back_in_the_next(spark):
    old = frame(spark, [(1, "a")], "id long, v string")
    ddl = "id long, v string, deleted boolean, __file_seq int, __row_seq long"
    new = frame(spark, [(1, "x", True, 0, 0), (1, "y", False, 1, 0)], ddl)
    assert rows(merge.upsert(old, new, ["id"], hard_delete="deleted")) == [(1, "y", False)]


def test_last_duplicate_wins(spark):
    old = frame(spark, [(2, "k")], "id long, v string")
    new = frame(spark, [(1, "a", 0), (1, "b", 1)], "id long, v string, n int")
    result = merge.upsert(old, new, ["id"], order=["n"])
    assert rows(result) == [(1, "b", 1), (2, "k", None)]


def test_insert_only_keeps_all_rows_of_the_first_file(spark):
    old = frame(spark, [(9, "z")], "id long, v string")
    new = frame(spark, [(1, "a", 0), (1, "b", 0), (1, "c", 1)], "id long, v string, __file_seq int")
    assert rows(merge.insert_only(old, new, ["id"])) == [(1, "a"), (1, "b"), (9, "z")]


def test_insert_only_drops_flagged_rows(spark):
    old = frame(spark, [(100, None)], "id long, gone boolean")
    new = frame(spark, [(3, False), (4, True)], "id long, gone boolean")
    assert [r[0] for r in rows(merge.insert_only(old, new, ["id"], hard_delete="gone"))] == [100, 3]


def test_keyless_merge_uses_the_row_id(spark):
    old = frame(spark, [("a", 1), ("b", 2)], "_dlt_id string, value long")
    new = frame(spark, [("b", 3), ("c", 4)], "_dlt_id string, value long")
    assert rows(merge.upsert(old, new)) == [("a", 1), ("b", 3), ("c", 4)]


def test_delete_and_update_only(spark):
    old = frame(spark, [(1, "a"), (2, "b")], "id long, v string")
    assert rows(merge.delete_by_key(old, frame(spark, [(2,), (2,), (7,)], "id long"), ["id"])) == [(1, "a")]
    assert merge.delete_by_key(old, old, ["id"]).columns == ["id", "v"]
    assert rows(merge.update_only(old, frame(spark, [(2, "B"), (7, "x")], "id long, v string"), ["id"])) == [(1, "a"), (2, "B")]


@pytest.mark.parametrize("side", ["incoming", "existing"])
@pytest.mark.parametrize("action", [merge.upsert, merge.insert_only])
def test_null_key_is_refused_on_either_side(spark, side, action):
    good, bad = frame(spark, [(1, "a")], "id long, v string"), frame(spark, [(None, "x")], "id long, v string")
    old, new = (good, bad) if side == "incoming" else (bad, good)
    with pytest.raises(PySparkException, match="merge key column is null: id"):
        action(old, new, ["id"]).collect()


def test_missing_key_column_is_refused(spark):
    old = frame(spark, [(1, "a")], "id long, v string")
    with pytest.raises(NullKeyError, match="id"):
        merge.last_per_key(old.drop("id"), ["id"])


def test_flag_may_not_be_a_key(spark):
    old = frame(spark, [(1, True)], "id long, gone boolean")
    with pytest.raises(LoadError, match="gone"):
        merge.upsert(old, old, ["id", "gone"], hard_delete="gone")


def test_flag_absent_from_the_batch_is_ignored(spark):
    old = frame(spark, [(1, "a")], "id long, v string")
    assert rows(merge.upsert(old, old.withColumn("v", F.lit("b")), ["id"], hard_delete="gone")) == [(1, "b")]


def test_repeated_key_without_an_order_is_refused(spark):
    old = frame(spark, [(1, "a")], "id long, v string")
    with pytest.raises(PySparkException, match="no row order"):
        merge.upsert(old, old.union(old), ["id"]).collect()


def test_incompatible_types_are_refused_before_any_job(spark):
    old = frame(spark, [(1, "a")], "id long, v string")
    with pytest.raises(SchemaConflictError, match="v"):
        merge.append(old, old.withColumn("v", F.lit(1)))


def test_all_copies_of_a_violated_key_are_replaced(spark):
    old = frame(spark, [(1, "a"), (1, "b"), (2, "c")], "id long, v string")
    assert rows(merge.upsert(old, frame(spark, [(1, "n")], "id long, v string"), ["id"])) == [(1, "n"), (2, "c")]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    """The fold aggregates in each task first; no window over the raw batch."""
    new = spark.range(0, 1000, 1, 4).select(F.lit(1).alias("k"), F.col("id").alias("n"))
    plan = merge.last_per_key(new, ["k"], order=["n"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def test_an_empty_table_costs_no_join(spark):
    from lodeworks.functions.local import empty_frame

    new = spark.range(5).withColumn("v", F.lit("a"))
    plan = merge.insert_only(empty_frame(spark, new.schema), new, ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
