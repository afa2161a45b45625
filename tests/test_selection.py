"""Ordered limits by selection, against a sort of all rows."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from conftest import plan
from pyspark.sql import functions as F

from placeload.operators import selection
from placeload.operators.selection import first_rows

N = 700
PLACE = ["_metadata.file_path", "_metadata.row_index"]


def mixed(n: int):
    """A row of every type, with ties, NULLs, NaN, common prefixes and values at the ends of a type."""
    draw = random.Random(n)
    some = lambda x: None if draw.random() < 0.1 else x
    return (
        n,
        some(draw.choice([0, 5, 5, 5, -3, draw.randrange(-50, 50)])),
        some(draw.choice([2**62 + draw.randrange(40), -(2**63), 2**63 - 1, 7])),
        some(draw.choice([float("nan"), float("inf"), float("-inf"), -0.0, 0.0, draw.gauss(0, 1), draw.gauss(0, 1)])),
        some(draw.choice(["", "a", "a\x00", "a\x00\x00b", "https://host/path/" + "é" * draw.randrange(4) + str(draw.randrange(99)), "☃" * 9])),
        some(bytes(draw.choices([0, 1, 255], k=draw.randrange(9)))),
        some(Decimal(draw.choice([0, 10**28, 10**28 + draw.randrange(30), -draw.randrange(10**20)])) / 100),
        some(date(1, 1, 1) + timedelta(days=draw.randrange(3_000_000))),
        some(datetime(1960, 1, 1) + timedelta(microseconds=draw.randrange(10**15))),
        some(draw.random() < 0.3),
    )


SCHEMA = (
    "id long, few int, far long, real double, text string, raw binary, money decimal(30,2), day date, at timestamp_ntz, flag boolean"
)


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("selection") / "t")
    rows = [mixed(n) for n in range(N)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("real_f", F.col("real").cast("float"))
    df.withColumn("instant", F.col("at").cast("timestamp")).repartition(4, "id").write.parquet(path)
    return spark.read.parquet(path)


COLUMNS = "few far real real_f text raw money day at instant flag".split()


@pytest.mark.parametrize("column", COLUMNS)
def test_every_type_in_every_direction(spark, table, monkeypatch, column):
    monkeypatch.setattr(selection, "SORTED", 60)
    for direction, limit in zip(("asc", "desc", "asc_nulls_last", "desc_nulls_first"), (333, 40, 690, 200), strict=True):
        order = getattr(F.col(column), direction)()
        wanted = {r.id for r in table.orderBy(order, *PLACE).limit(limit).collect()}
        assert {r.id for r in first_rows(table, limit, [order]).collect()} == wanted


@pytest.mark.parametrize("limit", [0, 1, 2, 99, 350, 699, 700, 5000])
def test_several_columns(table, monkeypatch, limit):
    monkeypatch.setattr(selection, "SORTED", 5)
    order = ["flag", F.col("few").desc(), (F.length("text") + 1).asc_nulls_last(), "money"]
    wanted = {r.id for r in table.orderBy(*order, *PLACE).limit(limit).collect()}
    assert {r.id for r in first_rows(table, limit, order).collect()} == wanted


def test_equal_rows_are_told_apart_by_place(spark, tmp_path):
    path = str(tmp_path / "equal")
    spark.range(0, 40_000, 1, 5).select(F.lit(1).alias("v"), "id").write.parquet(path)
    df = spark.read.parquet(path)
    small = {r.id for r in first_rows(df, 15_000, ["v"]).collect()}
    large = {r.id for r in first_rows(df, 31_111, ["v"]).collect()}
    assert len(small) == 15_000 and len(large) == 31_111 and small < large


def test_text_beyond_the_first_letters(spark, tmp_path, monkeypatch):
    """Keys that share sixty letters, so that each step has to look further into them."""
    monkeypatch.setattr(selection, "SORTED", 10)
    path = str(tmp_path / "urls")
    key = F.concat(F.repeat(F.lit("x"), F.lit(60)), F.conv(F.hash("id").cast("string"), 10, 36), F.repeat(F.lit("y"), F.lit(20)), "id")
    spark.range(0, 3000, 1, 3).select("id", key.alias("k")).write.parquet(path)
    df = spark.read.parquet(path)
    assert {r.id for r in first_rows(df, 1234, ["k"]).collect()} == {r.id for r in df.orderBy("k").limit(1234).collect()}


def test_nothing_is_written_or_shuffled(spark, tmp_path):
    """The result is one filter on the scan, and the leading column's part of it is pushed down."""
    path = str(tmp_path / "large")
    spark.range(0, 60_000, 1, 6).select("id", F.rand(1).alias("r")).write.parquet(path)
    df = spark.read.parquet(path)
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.rglob("*"))
    kept = first_rows(df, 20_000, ["id"])
    assert kept.count() == 20_000 and set(shared.rglob("*")) == before
    assert "Exchange" not in plan(kept) and "LessThanOrEqual(id,19999)" in plan(kept)
    assert "GreaterThanOrEqual(r," in plan(first_rows(df, 500, [F.col("r").desc()]))


def test_rows_sorted_are_few(spark, tmp_path, monkeypatch):
    """However large the limit, only what is left between two close values is sorted."""
    path = str(tmp_path / "many")
    spark.range(0, 200_000, 1, 8).select(F.hash("id").alias("h")).write.parquet(path)
    sorted_ = []
    taken = selection._taken
    monkeypatch.setattr(selection, "_taken", lambda rows, *rest: sorted_.append(rows.count()) or taken(rows, *rest))
    df = spark.read.parquet(path)
    assert first_rows(df, 123_456, ["h"]).count() == 123_456
    assert sorted_ and max(sorted_) <= selection.SORTED


def test_orders_that_are_refused(table):
    with pytest.raises(ValueError, match="order of array"):
        first_rows(table, 1, [F.array("few")])
    with pytest.raises(ValueError, match="negative"):
        first_rows(table, -1, ["few"])


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "none")
    spark.range(0).write.parquet(path)
    assert first_rows(spark.read.parquet(path), 5, ["id"]).count() == 0
