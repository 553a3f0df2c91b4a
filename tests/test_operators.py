import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataload.operators import dedup, keys, matching, quality, rows
from strataload.sources.schemas import LOAD_LOG_SCHEMA, short_text


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_first_per_key_is_deterministic_and_groups_null_keys(frame):
    df = frame("k string, v int", ("a", 2), ("a", 1), (None, 5), (None, 4), ("b", None), ("b", 7))
    for partitions in (1, 7):
        assert values(dedup.first_per_key(df.repartition(partitions), ["k"])) == [("a", 1), ("b", 7), (None, 4)]


def test_first_per_key_limits_before_the_shuffle(frame):
    plan = dedup.first_per_key(frame("k string, v int", ("a", 2)), ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_survivors(frame):
    df = frame("k string, pr int, a string, b string", ("x", 2, "A", "A"), ("x", 1, "C", "A"), ("x", 1, "B", "Z"))
    assert values(dedup.survivor_by_priority(df, "k", "pr", ["a", "b"])) == [("x", "B", "Z")]
    assert values(dedup.survivor_by_max(df.drop("pr"), "k", ["a", "b"])) == [("x", "C", "Z")]


def test_max_survivor_folds_null_keys_and_attributes(frame):
    df = frame("k string, a string", (None, None), (None, "m"), ("N/A", "q"), ("z", None))
    assert values(dedup.survivor_by_max(df, "k", ["a"])) == [("N/A", "q"), ("z", "N/A")]


def test_variants_are_aggregated_by_hash_before_the_survivor(frame):
    df = frame("k string, pr int, a string", ("x", 2, "A"))
    for result in (dedup.survivor_by_priority(df, "k", "pr", ["a"]), dedup.survivor_by_max(df, "k", ["a"])):
        assert "HashAggregate" in result._jdf.queryExecution().executedPlan().toString()


def test_numbering_is_dense_ordered_and_puts_nulls_last(spark):
    df = spark.range(5000).select(F.when(F.col("id") != 17, F.md5(F.col("id").cast("string"))).alias("k"), "id")
    for partitions in (1, 13):
        numbered = keys.number_rows(df.repartition(partitions), "n", ["k"], 40).collect()
        ordered = sorted(numbered, key=lambda r: r["n"])
        assert [r["n"] for r in ordered] == list(range(41, 5041))
        texts = [r["k"] for r in ordered]
        assert texts[-1] is None and texts[:-1] == sorted(texts[:-1])


def test_numbering_breaks_ties_by_the_other_columns(frame):
    df = frame("k string, v string", ("a", "z"), ("a", "b"), ("a", None))
    assert values(keys.number_rows(df, "n", ["k"]))[0:3] == [(1, "a", "b"), (2, "a", "z"), (3, "a", None)]


def test_numbering_nothing(frame):
    assert keys.number_rows(frame("k string"), "n", ["k"], 3).count() == 0


def test_key_base_ignores_the_default_row(frame):
    target = frame("id long", (-1,), (9,))
    only_default = frame("id long", (-1,))
    one = frame("k string", ("a",))
    assert values(keys.number_rows(one, "id", ["k"], keys.current_max_key(target, "id"))) == [(10, "a")]
    assert values(keys.number_rows(one, "id", ["k"], keys.current_max_key(only_default, "id"))) == [(1, "a")]


@pytest.mark.parametrize(
    "stored, expected",
    [
        ([], [("a",), ("b",), (None,)]),
        (["a"], [("b",)]),
        (["a", None], []),
    ],
)
def test_not_in_follows_three_valued_logic(frame, stored, expected):
    source = frame("x string", ("a",), ("b",), (None,))
    target = frame("k string", *[(s,) for s in stored])
    assert values(matching.rows_not_in(source, "x", target, "k")) == expected


def test_anti_join_keeps_null_keys(frame):
    source = frame("x string", ("a",), ("b",), (None,))
    target = frame("k string", ("a",), (None,))
    assert values(matching.rows_without_match(source, target, [("x", F.col("k"))])) == [("b",), (None,)]


def test_default_row_is_added_once(frame):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.StringType())])
    without = frame(schema, (1, "a"))
    with_it = frame(schema, (1, "a"), (-1, "other"))
    default = {"id": -1, "t": "N/A"}
    assert values(keys.missing_default_row(without, schema, "id", default)) == [(-1, "N/A")]
    assert values(keys.missing_default_row(with_it, schema, "id", default)) == []


def test_literal_rows_and_text_limits(spark):
    schema = T.StructType([T.StructField("id", T.IntegerType(), False), short_text("name", 15)])
    people = keys.literal_rows(spark, [(1, "Bob"), (2, "Alice"), (3, "Robert")], schema)
    assert values(people) == [(1, "Bob"), (2, "Alice"), (3, "Robert")]
    with pytest.raises(ValueError):
        keys.literal_rows(spark, [(4, "a name that is too long")], schema)
    with pytest.raises(Exception, match="longer than 15"):
        rows.conform(people.withColumn("name", F.repeat("name", 9)), schema).collect()


def test_row_changes(frame):
    df = frame("name string, status string", ("Alice", "Not fired"), ("Bob", None))
    changed = rows.update_where(df, F.col("status") == "Not fired", {"status": F.lit("Fired")})
    assert values(changed) == [("Alice", "Fired"), ("Bob", None)]
    assert values(rows.delete_where(df, F.col("status") == "Not fired")) == [("Bob", None)]


def test_missing_columns_are_added_once(frame):
    df = frame("a string", ("x",))
    wider = rows.add_missing_columns(df, {"source_id": T.StringType()})
    assert values(wider) == [("x", None)]
    assert rows.add_missing_columns(wider, {"source_id": T.StringType()}).columns == ["a", "source_id"]


def test_generated_pairs(spark):
    assert values(rows.number_pairs(spark, 3)) == [(1, 1), (2, 2), (3, 3)]


def test_reconcile_counts_distinct_rows_and_equates_nulls(frame):
    left = frame("id int, t string", (1, None), (2, "a"), (2, "a"), (3, "b"))
    right = frame("key int, u string", (1, None), (3, "c"), (4, None))
    assert values(quality.reconcile(left, right, "l", "r")) == [("l", 2), ("r", 2)]
    assert values(quality.reconcile(left, left.toDF("x", "y"), "l", "r")) == [("l", 0), ("r", 0)]


def test_reconcile_shuffles_each_row_once(frame):
    left = frame("id int, t string", (1, None))
    plan = quality.reconcile(left, left, "l", "r")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_member_and_table_counts(frame):
    df = frame("id long", (-1,), (1,), (2,))
    assert values(quality.member_counts({"t": (df, "id")})) == [("t", 3, 1, 2)]
    assert values(quality.table_counts({"t": df, "u": df.limit(0)})) == [("t", 3), ("u", 0)]


def test_active_version_checks(frame):
    df = frame(
        "id long, customer_src_id string, is_active string",
        (-1, "N/A", "Y"),
        (1, "a", "Y"),
        (2, "a", " y"),
        (3, "b", "Y"),
        (4, "b", "N"),
        (5, "c", "N"),
    )
    assert values(quality.not_exactly_one_active(df, "id")) == [("a", 2)]
    with pytest.raises(quality.ConstraintViolation):
        quality.one_active_check("customer_src_id", "id")(df)
    quality.one_active_check("customer_src_id", "id")(df.where("id <> 2"))


def test_unique_keys(frame):
    df = frame("id long, k string", (-1, "a"), (1, "a"), (2, " a "), (3, None), (4, None))
    assert values(quality.unique_violations(df, [F.trim("k")], F.col("id") != -1)) == [("a", 2)]
    assert values(quality.key_violations(frame("id long", (1,), (1,), (None,)), "id")) == [(1, 2), (None, 1)]
    quality.unique_text_check("k", "id")(df.where("id in (-1, 1)"))


def test_log_readers(frame):
    log = frame("procedure_name string, log_id long, status string", ("a", 1, "x"), ("a", 3, "y"), ("b", 2, "z"))
    assert values(quality.latest_entries(log)) == [("a", 3, "y"), ("b", 2, "z")]
    assert [r["log_id"] for r in quality.newest_entries(log, 2).collect()] == [3, 2]
    assert "TakeOrderedAndProject" in quality.newest_entries(log, 2)._jdf.queryExecution().executedPlan().toString()
    assert LOAD_LOG_SCHEMA.names[0] == "log_id"
