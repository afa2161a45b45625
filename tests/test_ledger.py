"""Loads that can be repeated, and rows whose schema is not that of their table."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeload import LoadConfig, adapted, apply_drift, drift, ledger_table, load_flat, load_places, scratch_path, settle, unsettled
from placeload.plans import jobs
from placeload.plans.drift import fits, least_common
from placeload.sources.tables import write_table


def add_files(spark, source, ids):
    places = spark.createDataFrame([(i, float(i % 80), 1.0) for i in ids], "id long, geocodes_mainEntry_latitude double, geocodes_mainEntry_longitude double")
    places.coalesce(1).write.mode("append").parquet(source)


@pytest.fixture
def daily(spark, name, tmp_path):
    source = str(tmp_path / "daily")
    add_files(spark, source, range(10))
    add_files(spark, source, range(10, 20))
    return LoadConfig(source, name, path=scratch_path(spark, name), ledger=f"{name}_ledger")


def ids(spark, name):
    return sorted(r["id"] for r in spark.table(name).collect())


@pytest.mark.parametrize("keys", [None, ["id"]])
def test_a_repeated_load_takes_late_files_only(spark, daily, keys):
    assert load_flat(spark, daily, keys).rows_in == 20
    assert load_flat(spark, daily, keys).rows_in == 0
    add_files(spark, daily.source, range(20, 25))
    assert load_flat(spark, daily, keys).rows_in == 5
    assert ids(spark, daily.dest_table) == list(range(25))
    assert ledger_table(spark, daily.ledger).where("state = 'done'").count() == 3


def test_a_replaced_file_is_new(spark, daily):
    load_flat(spark, daily, ["id"])
    spark.range(0, 10).selectExpr("id + 100 AS id", "1D AS geocodes_mainEntry_latitude", "1D AS geocodes_mainEntry_longitude").coalesce(1).write.mode("overwrite").parquet(daily.source)
    assert load_flat(spark, daily, ["id"]).rows_in == 10
    assert ids(spark, daily.dest_table) == list(range(20)) + list(range(100, 110))


def test_destinations_have_their_own_ledger_rows(spark, daily):
    from dataclasses import replace

    other = replace(daily, dest_table=f"{daily.dest_table}_b", path=scratch_path(spark, "b"))
    assert load_flat(spark, daily).rows_in == load_flat(spark, other).rows_in == 20


def failing(monkeypatch, when):
    plain = jobs.write_table

    def write(*args, **settings):
        if when == "after":
            plain(*args, **settings)
        raise OSError("interrupted")

    monkeypatch.setattr(jobs, "write_table", write)


@pytest.mark.parametrize("when", ["before", "after"])
def test_an_interrupted_append_is_not_repeated_blindly(spark, daily, monkeypatch, when):
    with monkeypatch.context() as patch:
        failing(patch, when)
        with pytest.raises(OSError, match="interrupted"):
            load_flat(spark, daily)
    (open_,) = unsettled(spark, daily.ledger, daily.dest_table)
    with pytest.raises(RuntimeError, match="did not end"):
        load_flat(spark, daily)
    settle(spark, daily.ledger, daily.dest_table, open_, loaded=when == "after")
    assert load_flat(spark, daily).rows_in == (0 if when == "after" else 20)
    assert ids(spark, daily.dest_table) == list(range(20))


def test_an_interrupted_keyed_load_is_repeated(spark, daily, monkeypatch):
    with monkeypatch.context() as patch:
        failing(patch, "after")
        with pytest.raises(OSError, match="interrupted"):
            load_flat(spark, daily, ["id"])
    assert load_flat(spark, daily, ["id"]).rows_in == 20 and ids(spark, daily.dest_table) == list(range(20))
    assert unsettled(spark, daily.ledger, daily.dest_table) == [] and load_flat(spark, daily, ["id"]).rows_in == 0


def test_ledgers_need_whole_appended_loads(spark, daily):
    with pytest.raises(ValueError, match="append"):
        load_places(spark, daily)
    with pytest.raises(ValueError, match="no limit"):
        LoadConfig("s", "d", limit=1, ledger="l")


def types(text):
    return T.StructType.fromDDL(text)


def actions(source, target, **settings):
    return {s.column: (s.action, s.result_type) for s in drift(types(source), types(target), **settings)}


def test_steps():
    found = actions("a INT, B BIGINT, c STRING, d DOUBLE, n VARCHAR(4), new DATE", "a BIGINT, b INT, c INT, d DOUBLE, n VARCHAR(8), lost STRING")
    assert found == {
        "a": ("cast", "bigint"), "b": ("widen", "bigint"), "c": ("refuse", None), "d": ("keep", "double"),
        "n": ("cast", "varchar(8)"), "lost": ("fill", "string"), "new": ("add", "date"),
    }
    assert actions("a BIGINT, b INT", "a INT", widen=False, add=False) == {"a": ("refuse", None), "b": ("refuse", None)}
    assert actions("x INT", "a INT NOT NULL")["a"] == ("refuse", None)
    assert actions("a STRING", "a VARCHAR(9)")["a"] == ("widen", "string")
    assert actions("a ARRAY<INT>", "a ARRAY<BIGINT>")["a"] == ("refuse", None)
    with pytest.raises(ValueError, match="case"):
        drift(T.StructType([T.StructField("a", T.IntegerType()), T.StructField("A", T.IntegerType())]), types("a INT"))


KINDS = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.DecimalType(5, 2), T.DecimalType(20, 0),
         T.DecimalType(38, 10), T.DateType(), T.TimestampNTZType(), T.TimestampType(), T.StringType(), T.VarcharType(3), T.VarcharType(7),
         T.BooleanType(), T.BinaryType(), T.NullType()]


def test_types_are_a_lattice():
    """An order, and a join that is the least of the types above both."""
    for a in KINDS:
        assert fits(a, a) and least_common(a, a) == a
        for b in KINDS:
            join = least_common(a, b)
            assert join == least_common(b, a)
            assert not (fits(a, b) and fits(b, a)) or a == b
            if join is not None:
                assert fits(a, join) and fits(b, join)
                assert all(fits(join, c) for c in KINDS if fits(a, c) and fits(b, c))
            for c in KINDS:
                assert not (fits(a, b) and fits(b, c)) or fits(a, c)
    assert least_common(T.LongType(), T.DoubleType()) is None
    assert least_common(T.IntegerType(), T.FloatType()) == T.DoubleType()
    assert least_common(T.DecimalType(5, 2), T.LongType()) == T.DecimalType(22, 2)


@pytest.mark.parametrize("partitioned", [False, True])
def test_a_table_is_widened_and_extended(spark, name, partitioned):
    parted = "PARTITIONED BY (p)" if partitioned else ""
    spark.sql(f"CREATE TABLE {name} (id INT, v VARCHAR(3), p STRING) USING parquet {parted}")
    write_table(spark.createDataFrame([(1, "abc", "x")], "id int, v string, p string"), name, "append")
    new = spark.createDataFrame([("long text", 2**40, 1.5, "y")], "V string, id long, extra double, p string")
    write_table(apply_drift(new, name), name, "append")
    order = [spark.table(name).columns.index(c) for c in ("id", "v", "p", "extra")]
    assert sorted(tuple(r[i] for i in order) for r in spark.table(name).collect()) == [(1, "abc", "x", None), (2**40, "long text", "y", 1.5)]
    assert [c.name for c in spark.catalog.listColumns(name) if c.isPartition] == (["p"] if partitioned else [])


def test_nothing_changes_when_a_column_is_refused(spark, name):
    write_table(spark.createDataFrame([(1, "a")], "id int, v string"), name)
    before = spark.table(name).schema
    with pytest.raises(ValueError, match="v: int into string"):
        apply_drift(spark.createDataFrame([(2**40, 5, 1)], "id long, v int, extra int"), name)
    assert spark.table(name).schema == before and rows(spark.table(name)) == [(1, "a")]


def test_adapted_rows(spark):
    steps = drift(types("a INT, `x.y` INT"), types("a BIGINT, lost DATE, `x.y` BIGINT"))
    df = spark.createDataFrame([(1, 2)], "a int, `x.y` int")
    assert adapted(df, steps).dtypes == [("a", "bigint"), ("lost", "date"), ("x.y", "bigint")]
    assert adapted(df, steps).select(F.col("a")).first() == (1,)
