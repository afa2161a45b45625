import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import plan, rows
from placeload import latest_by_key, upsert, write_sharded

SCHEMA = "k int, v string, n int"


def frame(spark, values, schema=SCHEMA):
    return spark.createDataFrame(values, schema)


def test_insert_and_update(spark):
    target = frame(spark, [(1, "a", 0), (2, "b", 0)])
    incoming = frame(spark, [(2, "B", 1), (3, "c", 1)])
    assert rows(upsert(target, incoming, ["k"])) == [(1, "a", 0), (2, "B", 1), (3, "c", 1)]


def test_empty_sides(spark):
    some, none = frame(spark, [(1, "a", 0)]), frame(spark, [])
    assert rows(upsert(none, some, ["k"])) == [(1, "a", 0)]
    assert rows(upsert(some, none, ["k"])) == [(1, "a", 0)]
    assert rows(upsert(none, none, ["k"])) == []


def test_columns_are_matched_by_name(spark):
    incoming = frame(spark, [("B", 1, 9)], "v string, k int, n int")
    merged = upsert(frame(spark, [(1, "a", 0)]), incoming, ["k"])
    assert merged.columns == ["k", "v", "n"] and rows(merged) == [(1, "B", 9)]


def test_duplicates_need_an_order(spark):
    target, incoming = frame(spark, []), frame(spark, [(1, "a", 1), (1, "b", 2), (2, "c", 0)])
    with pytest.raises(Exception, match="not unique"):
        upsert(target, incoming, ["k"]).collect()
    with pytest.raises(Exception, match="not unique"):
        upsert(target, frame(spark, [(1, "a", 1), (1, "a", 1)]), ["k"]).count()
    assert rows(upsert(target, incoming, ["k"], ["n"])) == [(1, "b", 2), (2, "c", 0)]
    assert rows(upsert(target, incoming, ["k"], [-F.col("n")])) == [(1, "a", 1), (2, "c", 0)]


def test_null_order_loses(spark):
    incoming = frame(spark, [(1, "a", None), (1, "b", -5)])
    assert rows(latest_by_key(incoming, ["k"], ["n"])) == [(1, "b", -5)]


def test_ties_repeat_in_any_input_order(spark):
    values = [(1, f"v{i}", 0) for i in range(50)]
    found = {
        rows(latest_by_key(frame(spark, order).repartition(parts), ["k"], ["n"]))[0]
        for order in (values, values[::-1])
        for parts in (1, 3, 8)
    }
    assert len(found) == 1


def test_ties_with_nested_columns(spark):
    df = spark.sql("SELECT * FROM VALUES (1, map('a', 1)), (1, map('a', 2)), (2, NULL) AS t(k, m)")
    found = latest_by_key(df.withColumn("o", F.lit(0)), ["k"], ["o"]).collect()
    assert sorted(r.k for r in found) == [1, 2]


def test_null_key_raises(spark):
    incoming = frame(spark, [(None, "a", 0), (1, "b", 0)])
    for order in (None, ["n"]):
        with pytest.raises(Exception, match="NULL in key"):
            upsert(frame(spark, []), incoming, ["k"], order).collect()


@pytest.mark.parametrize("order", [None, ["n"]])
def test_null_keys_dropped_before_do_not_raise(spark, tmp_path, order):
    frame(spark, [(None, "a", 0), (1, "b", 0), (2, "c", 0)]).write.parquet(str(tmp_path / "l"))
    frame(spark, [(1, "x", 0), (None, "y", 0)]).write.parquet(str(tmp_path / "r"))
    left, right = spark.read.parquet(str(tmp_path / "l")), spark.read.parquet(str(tmp_path / "r"))
    for how in ("inner", "left_semi"):
        joined = left.join(right.select("k"), "k", how)
        assert rows(latest_by_key(joined, ["k"], order)) == [(1, "b", 0)]
    assert latest_by_key(left.where("v <> 'a'"), ["k"], order).count() == 2
    assert latest_by_key(left.where("k IS NOT NULL"), ["k"], order).count() == 2
    with pytest.raises(Exception, match="NULL in key"):
        latest_by_key(left.join(right.select("k"), "k", "left"), ["k"], order).count()


def test_two_column_key(spark):
    schema = "a int, `b.c` string, v int"
    target = frame(spark, [(1, "x", 0), (1, "y", 0)], schema)
    incoming = frame(spark, [(1, "y", 5), (2, "x", 6)], schema)
    assert rows(upsert(target, incoming, ["a", "b.c"])) == [(1, "x", 0), (1, "y", 5), (2, "x", 6)]


def test_bad_keys(spark):
    df = frame(spark, [])
    with pytest.raises(ValueError):
        upsert(df, df, ["missing"])
    with pytest.raises(ValueError):
        upsert(df, df, [])


def test_same_source_on_both_sides(spark):
    target = frame(spark, [(i, "a", i) for i in range(10)])
    incoming = target.where("k < 3").withColumn("v", F.lit("z"))
    assert rows(upsert(target, incoming, ["k"])) == [(i, "z" if i < 3 else "a", i) for i in range(10)]


def test_hot_key_is_reduced_before_its_shuffle(spark, tmp_path):
    spark.range(0, 9000, 1, 6).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("n")).write.parquet(str(tmp_path / "i"))
    incoming = spark.read.parquet(str(tmp_path / "i"))
    latest = latest_by_key(incoming, ["k"], ["n"])
    text = plan(latest)
    assert "row_number(), 1, Partial" in text and text.count("Exchange") == 1
    assert latest.where("k = 7").collect()[0].n == 8997
    assert latest.count() == 6000  # Key 7 is also the id of a row.
    checked = plan(latest_by_key(incoming, ["k"]))
    assert "row_number(), 2, Partial" in checked


def test_only_keys_are_joined(spark, tmp_path):
    spark.range(100).select(F.col("id").alias("k"), F.lit("x").alias("v")).write.parquet(str(tmp_path / "i"))
    incoming = spark.read.parquet(str(tmp_path / "i"))
    merged = upsert(incoming, incoming.where("k < 5"), ["k"])
    scans = [line for line in plan(merged).splitlines() if "FileScan" in line]
    assert any("ReadSchema: struct<k:bigint>" in s for s in scans)


def test_bucketed_target_is_not_shuffled(spark, name, tmp_path):
    write_sharded(spark.range(5000).select(F.col("id").alias("k"), F.lit("x").alias("v")), name, "k", 8, path=str(tmp_path / "t"))
    spark.range(4990, 5010).select(F.col("id").alias("k"), F.lit("y").alias("v")).write.parquet(str(tmp_path / "i"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = upsert(spark.table(name), spark.read.parquet(str(tmp_path / "i")), ["k"])
        text = plan(merged)
        assert "SortMergeJoin" in text and "Bucketed: true" in text
        target = next(line for line in text.splitlines() if "Bucketed: true" in line)
        before = text[: text.index(target)].splitlines()
        indent = target.index("FileScan")
        above = [line for line in before if "Exchange" in line and line.index("Exchange") < indent]
        assert not above
        assert merged.count() == 5010 and merged.where("v = 'y'").count() == 20
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


keys = st.integers(0, 5)
tables = st.dictionaries(keys, st.text("abc", max_size=2), max_size=6)


@settings(max_examples=12, deadline=None)
@given(tables, st.lists(st.tuples(keys, st.text("abc", max_size=2)), max_size=10))
def test_equals_a_dict_and_is_idempotent(spark, before, changes):
    target = frame(spark, [(k, v, -1) for k, v in before.items()])
    incoming = frame(spark, [(k, v, i) for i, (k, v) in enumerate(changes)])
    model = {k: (v, -1) for k, v in before.items()} | {k: (v, i) for i, (k, v) in enumerate(changes)}
    once = upsert(target, incoming, ["k"], ["n"])
    assert rows(once) == sorted(((k, v, n) for k, (v, n) in model.items()), key=repr)
    assert rows(upsert(once, incoming, ["k"], ["n"])) == rows(once)
