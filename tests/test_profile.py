import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from placeload import (
    column_types,
    keep_sketches,
    kept_sketches,
    merge_sketches,
    sketch_profile,
    width_profile,
    width_sketches,
)


@pytest.fixture(scope="module")
def loads(spark):
    """Rows with a load number, a text of few values, one of many and one that is NULL in a whole load."""
    n = F.col("id")
    return spark.range(60_000).select(
        (n % 4).alias("load"),
        F.concat(F.lit("k"), n % 7).alias("few"),
        F.repeat(F.lit("x"), (n % 100).cast("int")).alias("lengths"),
        F.concat(F.lit("name-"), n % 20_000).alias("many"),
        F.when(n % 4 != 1, F.lit("here")).alias("gone"),
        F.lit(None).cast("string").alias("never`d"),
        n.cast("int").alias("number"),
    )


@pytest.fixture(scope="module")
def merged(spark, loads):
    parts = [width_sketches(loads.where(F.col("load") == n)) for n in range(4)]
    return {r["column_name"]: r for r in sketch_profile(merge_sketches(parts[0].union(parts[1]).union(parts[2]).union(parts[3]))).collect()}


def test_exact_columns_equal_one_full_pass(loads, merged):
    whole = {r["column_name"]: r for r in width_profile(loads).collect()}
    assert merged.keys() == whole.keys() == {"few", "lengths", "many", "gone", "never`d"}
    for name, row in merged.items():
        assert row["rows"] == 60_000
        assert all(row[c] == whole[name][c] for c in ("max_length", "filled", "width")), name


def test_estimates_keep_to_the_stated_errors(loads, merged):
    assert merged["few"]["distinct_values"] == 7 and merged["few"]["few_values"]
    assert merged["gone"]["distinct_values"] == 1 and merged["lengths"]["distinct_values"] == 100
    # Three standard errors.
    assert abs(merged["many"]["distinct_values"] / 20_000 - 1) < 3 * 1.04 / 64 and not merged["many"]["few_values"]
    assert abs(merged["lengths"]["median_length"] - 50) <= 3 and abs(merged["lengths"]["p99_length"] - 99) <= 2


def test_one_pass_and_merged_parts_agree(spark, loads, merged):
    whole = {r["column_name"]: r for r in sketch_profile(merge_sketches(width_sketches(loads))).collect()}
    for name, row in whole.items():
        assert abs(row["distinct_values"] - merged[name]["distinct_values"]) <= 0.02 * max(1, row["distinct_values"])


def test_columns_without_a_value(spark, merged):
    row = merged["never`d"]
    assert (row["filled"], row["max_length"], row["width"], row["distinct_values"], row["few_values"]) == (0, None, 1, 0, True)
    assert row["median_length"] is None and row["p99_length"] is None
    empty = spark.createDataFrame([], "a string, b int")
    found = sketch_profile(merge_sketches(width_sketches(empty))).collect()
    assert [tuple(r) for r in found] == [("a", 0, 0, None, 1, 0, True, None, None)]
    with pytest.raises(ValueError):
        width_sketches(empty.select("b"))


def test_sketches_are_small_and_combined_before_the_shuffle(loads):
    text = plan(width_sketches(loads))
    assert text.count("Exchange SinglePartition") == 1 and "partial_hll_sketch_agg" in text
    assert all(len(r["distinct_sketch"] or b"") < 5000 and len(r["length_sketch"] or b"") < 8000 for r in width_sketches(loads).collect())


def test_kept_sketches_count_a_repeated_load_once(spark, loads, name, tmp_path):
    parts = [loads.where(F.col("load") == n) for n in range(2)]
    keep_sketches(parts[0].limit(10), name, "monday", str(tmp_path / "t"))
    keep_sketches(parts[0], name, "monday")
    keep_sketches(parts[1], name, "tuesday")
    kept = kept_sketches(spark, name)
    assert kept.groupBy("load").count().orderBy("load").collect() == [("monday", 5), ("tuesday", 5)]
    advice = sketch_profile(merge_sketches(kept))
    wanted = width_profile(parts[0].union(parts[1]))
    assert rows(advice.select("column_name", "max_length", "filled", "width")) == rows(wanted)
    assert column_types(advice) == column_types(wanted)


def test_new_columns_of_a_later_load(spark, name, tmp_path):
    keep_sketches(spark.createDataFrame([("a",)], "x string"), name, "1", str(tmp_path / "t"))
    keep_sketches(spark.createDataFrame([("b", "cc"), (None, None)], "x string, y string"), name, "2")
    found = sketch_profile(merge_sketches(kept_sketches(spark, name)))
    assert rows(found.select("column_name", "rows", "filled", "max_length", "distinct_values")) == [("x", 3, 2, 1, 2), ("y", 2, 1, 2, 1)]
