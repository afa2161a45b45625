"""In-memory rows with an explicit schema, counted by a nullable column."""

from pyspark.sql import types as T

from conftest import rows

SCHEMA = T.StructType(
    [T.StructField("name", T.StringType(), nullable=False), T.StructField("age", T.IntegerType())]
)
PEOPLE = [("Michael", None), ("Andy", 30), ("Justin", 19)]


def test_rows_and_schema(spark, capsys):
    df = spark.createDataFrame(PEOPLE, SCHEMA)
    assert df.schema == SCHEMA and df.collect() == PEOPLE
    df.show()
    df.printSchema()
    shown = capsys.readouterr().out
    assert "|Michael|NULL|" in shown and "name: string (nullable = false)" in shown


def test_null_is_a_group_of_its_own(spark):
    counts = spark.createDataFrame(PEOPLE, SCHEMA).groupBy("age").count()
    assert rows(counts) == [(19, 1), (30, 1), (None, 1)]
