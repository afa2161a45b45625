import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from placeload import shard_by, shard_report, write_sharded


@pytest.fixture
def skewed(spark, tmp_path):
    """60,000 rows in 12 files; a third of them share one key, a tenth have none."""
    path = str(tmp_path / "skewed")
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 5000)
    spark.range(0, 60_000, 1, 12).select("id", key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("pad")).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def small_partitions(spark):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256kb")
    yield
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def sizes(df, path):
    df.write.parquet(path)
    found = df.sparkSession.read.parquet(path).groupBy(F.input_file_name()).count().collect()
    return [r["count"] for r in found]


def test_hot_key_is_split_over_tasks(spark, skewed, small_partitions, tmp_path):
    split = sizes(shard_by(skewed, "k", 8), str(tmp_path / "a"))
    assert sum(split) == 60_000 and max(split) < 10_000
    one_task = sizes(skewed.repartition(8, "k"), str(tmp_path / "b"))
    assert max(one_task) > 20_000


def test_hot_key_is_split_without_adaptive_execution(spark, skewed, tmp_path):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        split = sizes(shard_by(skewed, "k", 8), str(tmp_path / "a"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(split) == 60_000 and max(split) < 15_000 and len(split) == 8


def test_small_keys_stay_together(spark, tmp_path):
    spark.range(0, 8000, 1, 8).select((F.col("id") % 100).alias("k")).write.parquet(str(tmp_path / "s"))
    placed = shard_by(spark.read.parquet(str(tmp_path / "s")), "k", 8)
    per_key = placed.select("k", F.spark_partition_id().alias("p")).distinct().groupBy("k").count()
    assert per_key.where("count > 1").count() == 0


def test_report_is_the_bucket_layout(spark, skewed, name, tmp_path):
    skewed.repartition(8, "k").write.bucketBy(8, "k").option("path", str(tmp_path / "b")).saveAsTable(name)
    bucket = F.regexp_extract(F.col("_metadata.file_name"), r"_(\d+)\.c000", 1).cast("int")
    layout = spark.table(name).groupBy(bucket.alias("shard")).count()
    assert rows(shard_report(skewed, "k", 8)) == rows(layout)


def test_report_combines_before_its_shuffle(spark, skewed):
    assert "partial_count" in plan(shard_report(skewed, "k", 8))


def test_bad_shards(skewed):
    for operator in (shard_by, shard_report):
        with pytest.raises(ValueError):
            operator(skewed, "k", 0)


def test_balanced_keys_are_bucketed(spark, skewed, name, tmp_path):
    write_sharded(skewed, name, "id", 8, path=str(tmp_path / "b"))
    assert rows(spark.table(name)) == rows(skewed)
    grouped = spark.table(name).groupBy("id").count()
    assert "Exchange" not in plan(grouped) and grouped.count() == 60_000


def test_buckets_are_the_callers_choice(spark, name, tmp_path):
    spark.range(0, 60_000, 1, 8).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k")).write.parquet(str(tmp_path / "s"))
    df = spark.read.parquet(str(tmp_path / "s"))
    for bucketed in (True, False):
        write_sharded(df, name, "k", 64, path=str(tmp_path / f"b{bucketed}"), bucketed=bucketed)
        assert rows(spark.table(name)) == rows(df)
        assert any(c.isBucket for c in spark.catalog.listColumns(name)) == bucketed


def test_sharded_write_into_an_existing_table(spark, skewed, name, tmp_path):
    write_sharded(skewed, name, "id", 4, path=str(tmp_path / "b"))
    write_sharded(skewed.where("id < 10"), name, "id", 4, mode="append")
    assert spark.table(name).count() == 60_010
    assert "Exchange" not in plan(spark.table(name).groupBy("id").count())
