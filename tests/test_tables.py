from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from placeload import (
    ColumnDef,
    TableDef,
    create_or_replace,
    replace_rows,
    scratch_path,
    upsert,
    upsert_table,
    write_sharded,
    write_table,
)
from placeload.plans.tables import CATEGORIES, PLACES
from placeload.sources.tables import touched_partitions

SMALL = TableDef((ColumnDef("k", "INT", nullable=False), ColumnDef("v", "VARCHAR(3)")), ("k",))


def pairs(spark, values):
    return spark.createDataFrame(values, "k int, v string")


def test_definition():
    assert SMALL.not_null == ("k",) and SMALL.widths == {"v": 3}
    assert SMALL.column_ddl() == "`k` INT, `v` VARCHAR(3)"
    assert CATEGORIES.not_null == ("categoryIdentifier", "dt") and CATEGORIES.widths["parentCategory"] == 8
    assert PLACES.widths == {
        "placeIdentifier": 32, "name": 128, "storeId": 32, "localizedNames": 256, "realityScore": 16,
        "geocodes": 256, "socialMediaInfo": 256, "categories": 32, "chains": 64, "parent": 32,
    }
    with pytest.raises(ValueError):
        TableDef((ColumnDef("k", "INT"),), ("x",))


def test_create_or_replace_empties(spark, name):
    for _ in range(2):
        create_or_replace(spark, name, SMALL, scratch_path(spark, name))
        assert spark.table(name).count() == 0
        write_table(pairs(spark, [(1, "a")]), name, "append")
        assert rows(spark.table(name)) == [(1, "a")]


def test_create_or_replace_at_the_same_path(spark, name):
    path = scratch_path(spark, name)
    for _ in range(2):
        create_or_replace(spark, name, SMALL, path)
        assert spark.table(name).count() == 0
        write_table(pairs(spark, [(1, "a")]), name, "append")
    create_or_replace(spark, name, SMALL)
    assert spark.table(name).count() == 0


def test_create_does_not_take_rows_of_others(spark, name):
    path = scratch_path(spark, name)
    pairs(spark, [(1, "a")]).write.parquet(path)
    with pytest.raises(ValueError, match="already holds rows"):
        create_or_replace(spark, name, SMALL, path)
    assert not spark.catalog.tableExists(name) and spark.read.parquet(path).count() == 1


def test_managed_table(spark, name):
    for definition in (PLACES, CATEGORIES):
        create_or_replace(spark, name, definition)
        assert spark.table(name).columns == [c.name for c in definition.columns]


def test_widths_are_enforced(spark, name):
    create_or_replace(spark, name, SMALL)
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        write_table(pairs(spark, [(1, "abcd")]), name, "append")


def test_modes(spark, name):
    first, second = pairs(spark, [(1, "a")]), pairs(spark, [(2, "b")])
    write_table(first, name, "append")
    write_table(second, name, "append")
    assert rows(spark.table(name)) == [(1, "a"), (2, "b")]
    write_table(second, name, "overwrite_truncate")
    assert rows(spark.table(name)) == [(2, "b")]
    write_table(spark.range(3), name, "overwrite_create")
    assert spark.table(name).columns == ["id"]
    with pytest.raises(ValueError):
        write_table(first, name, "upsert")
    with pytest.raises(ValueError):
        write_table(first, name, buckets=4)


def test_truncate_keeps_widths_and_order_of_columns(spark, name):
    create_or_replace(spark, name, SMALL)
    write_table(spark.createDataFrame([("a", 1)], "v string, k int"), name)
    assert rows(spark.table(name)) == [(1, "a")]
    assert spark.table(name).schema["v"].metadata["__CHAR_VARCHAR_TYPE_STRING"] == "varchar(3)"


def test_column_mismatch(spark, name):
    create_or_replace(spark, name, SMALL)
    with pytest.raises(ValueError, match="extra"):
        write_table(spark.createDataFrame([(1, "a", 2)], "k int, v string, extra int"), name)
    with pytest.raises(Exception, match="v"):
        write_table(spark.createDataFrame([(1,)], "k int"), name)


def test_replace_rows_of_the_own_source(spark, name):
    create_or_replace(spark, name, SMALL, scratch_path(spark, name))
    write_table(pairs(spark, [(1, "a"), (2, "b")]), name, "append")
    for value in ("B", "C"):
        replace_rows(upsert(spark.table(name), pairs(spark, [(2, value)]), ["k"]), name)
        assert rows(spark.table(name)) == [(1, "a"), (2, value)]
    assert spark.table(name).schema["v"].metadata["__CHAR_VARCHAR_TYPE_STRING"] == "varchar(3)"
    before = [t.name for t in spark.catalog.listTables()]
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        replace_rows(pairs(spark, [(1, "abcd")]), name)
    assert rows(spark.table(name)) == [(1, "a"), (2, "C")]
    assert [t.name for t in spark.catalog.listTables()] == before


def test_replace_rows_in_a_schema(spark, name):
    spark.sql(f"CREATE SCHEMA {name}")
    write_table(pairs(spark, [(1, "a")]), f"{name}.t")
    replace_rows(spark.table(f"{name}.t").where("k > 1"), f"{name}.t")
    assert rows(spark.table(f"{name}.t")) == []
    with pytest.raises(ValueError):
        replace_rows(spark.table(f"{name}.t"), f"`{name}`.t")


def test_quote_in_path(spark, name):
    create_or_replace(spark, name, SMALL, scratch_path(spark, "it's a path"))
    write_table(pairs(spark, [(1, "a")]), name)
    assert rows(spark.table(name)) == [(1, "a")]
    replace_rows(pairs(spark, [(2, "b")]), name)
    assert rows(spark.table(name)) == [(2, "b")]


@pytest.fixture
def partitioned(spark, name):
    """30 rows in 3 days of 2 regions."""
    spark.sql(f"CREATE TABLE {name} (k INT, v STRING, day STRING, region STRING) USING parquet PARTITIONED BY (day, region)")
    spark.range(30).selectExpr(
        "CAST(id AS INT) k", "'old' v", "concat('d', id % 3) day", "if(id % 2 = 0, 'a', 'b') region"
    ).write.insertInto(name)
    return name


def files(spark, name):
    return {r[0] for r in spark.table(name).select("_metadata.file_path").distinct().collect()}


def test_upsert_rewrites_only_touched_partitions(spark, partitioned):
    before, content = files(spark, partitioned), rows(spark.table(partitioned))
    incoming = spark.createDataFrame(
        [(0, "new", "d0", "a"), (99, "new", "d0", "a"), (99, "new", "d7", "a")],
        "k int, v string, day string, region string",
    )
    upsert_table(incoming, partitioned, ["day", "region", "k"])
    want = [r for r in content if r[0] != 0] + [tuple(r) for r in incoming.collect()]
    assert rows(spark.table(partitioned)) == sorted(want, key=repr)
    gone = before - files(spark, partitioned)
    assert gone and all("day=d0/region=a" in f for f in gone)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_touched_partitions_prune_the_scan(spark, partitioned):
    incoming = spark.table(partitioned).where("day = 'd1' AND region = 'b'")
    condition = touched_partitions(incoming, partitioned, ["day", "region", "k"])
    text = plan(spark.table(partitioned).where(condition))
    assert "day" in text.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert spark.table(partitioned).where(condition).count() == 5
    assert touched_partitions(incoming, partitioned, ["k"]) is None
    assert spark.table(partitioned).where(touched_partitions(incoming.limit(0), partitioned, ["day", "region"])).count() == 0


def test_only_the_combinations_given_are_touched(spark, name, tmp_path):
    spark.range(100).selectExpr("id AS v", "id div 10 AS a", "id % 10 AS b").write.partitionBy("a", "b").option("path", str(tmp_path / "t")).saveAsTable(name)
    incoming = spark.table(name).where("a = b")
    assert spark.table(name).where(touched_partitions(incoming, name, ["a", "b"])).count() == 10


def test_upserts_of_a_managed_table_leave_one_directory(spark, name):
    """Also with a column that is called as the property that is looked up."""
    spark.range(10).selectExpr("id", "'x' AS Location").write.saveAsTable(name)
    for n in range(3):
        upsert_table(spark.range(n, n + 1).selectExpr("id", "'y' AS Location"), name, ["id"])
    assert sorted(rows(spark.table(name))) == [(k, "y" if k < 3 else "x") for k in range(10)]
    warehouse = Path(spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:"))
    assert len(list(warehouse.glob(f"{name}*"))) == 1
    spark.sql(f"DROP TABLE {name}")
    assert not list(warehouse.glob(f"{name}*"))


def test_truncating_ignores_the_sessions_overwrite_mode(spark, partitioned):
    one = spark.createDataFrame(spark.table(partitioned).limit(1).collect(), spark.table(partitioned).schema)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_table(one, partitioned, "overwrite_truncate")
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert spark.table(partitioned).count() == 1


def test_upsert_beyond_its_partitions_rewrites_the_table(spark, partitioned):
    incoming = spark.createDataFrame([(0, "new", "d2", "b")], "k int, v string, day string, region string")
    upsert_table(incoming, partitioned, ["k"])
    assert spark.table(partitioned).count() == 30
    assert rows(spark.table(partitioned).where("k = 0")) == [(0, "new", "d2", "b")]
    upsert_table(spark.table(partitioned).where("k = 1").withColumn("day", F.lit("d9")), partitioned, ["k"])
    assert rows(spark.table(partitioned).where("day = 'd9'")) == [(1, "old", "d9", "b")]
    assert [t.name for t in spark.catalog.listTables() if partitioned in t.name] == [partitioned]


def test_upsert_into_an_external_partitioned_table(spark, name, tmp_path):
    spark.sql(f"CREATE TABLE {name} (k INT, v STRING, day STRING) USING parquet PARTITIONED BY (day) LOCATION '{tmp_path}/t'")
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, day string")
    old.write.insertInto(name)
    for value in ("B", "C"):
        upsert_table(spark.createDataFrame([(2, value, "z")], "k int, v string, day string"), name, ["k"])
        assert rows(spark.table(name)) == [(1, "a", "x"), (2, value, "z")]
    assert rows(spark.read.parquet(f"{tmp_path}/t").select("k", "v", "day")) == rows(old)


def test_upsert_of_nothing(spark, partitioned):
    before = files(spark, partitioned)
    upsert_table(spark.table(partitioned).limit(0), partitioned, ["day", "region", "k"])
    assert files(spark, partitioned) == before and spark.table(partitioned).count() == 30


def test_upsert_into_a_bucketed_table(spark, name, tmp_path):
    write_sharded(spark.range(5000).select(F.col("id").alias("k"), F.lit("x").alias("v")), name, "k", 8, path=str(tmp_path / "t"))
    incoming = spark.range(4000, 6000, 1, 6).select(F.col("id").alias("k"), F.lit("y").alias("v"))
    upsert_table(incoming, name, ["k"])
    found = spark.table(name)
    assert found.count() == 6000 and found.where("v = 'y' AND k >= 4000").count() == 2000
    assert "Exchange" not in plan(found.groupBy("k").count())
    assert found.groupBy("k").count().where("count > 1").count() == 0
    # A file per bucket from the old rows, and no more than that from the new.
    assert len(files(spark, name)) <= 16


def test_hot_partition_is_written_by_several_tasks(spark, name, tmp_path):
    spark.sql(f"CREATE TABLE {name} (k BIGINT, pad STRING, p STRING) USING parquet PARTITIONED BY (p) LOCATION '{tmp_path}/t'")
    spark.range(0, 60_000, 1, 12).selectExpr(
        "id AS k", "sha2(CAST(id AS STRING), 256) AS pad", "if(id % 3 = 0, 'hot', concat('p', id % 5)) AS p"
    ).write.parquet(f"{tmp_path}/s")
    incoming = spark.read.parquet(f"{tmp_path}/s")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256kb")
    try:
        upsert_table(incoming, name, ["p", "k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert spark.table(name).count() == 60_000
    sizes = spark.table(name).where("p = 'hot'").groupBy(F.input_file_name()).count().collect()
    assert len(sizes) >= 3 and sum(r["count"] for r in sizes) == 20_000
