"""The pipeline and the queries over the given tables."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from placeload.llm import oracle, queries

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    with duckdb.connect() as connection:
        for table in ("documents", "pages", "labels", "embeddings", "benchmark"):
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{DATA}/{table}.parquet')")
        yield connection


def test_registered():
    assert {*queries.registered(), "pipeline"} <= contract.queries().keys()
    assert sorted(int(n[2:].split("_")[0]) for n in queries.registered()) == list(range(1, 14))
    assert oracle.ORACLES.keys() <= queries.registered().keys()


@pytest.mark.parametrize("query", sorted(oracle.ORACLES))
def test_query_matches_its_sql(spark, database, query):
    df = queries.registered()[query](spark, DATA)
    columns = ", ".join(sorted(df.columns))
    wanted = database.execute(f"SELECT {columns} FROM ({oracle.ORACLES[query]})").fetchall()
    found = [tuple(r) for r in df.select(*sorted(df.columns)).collect()]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)


def test_held_out_accuracy(spark):
    data = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet")
    found = queries.op8_language_id(spark, data).filter("held_out AND lang_pred <> 'und'").join(docs, "doc_id")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.99
    scored = queries.op2_toxicity(spark, data).filter("held_out").join(labels, "doc_id")
    hit = scored.agg(F.avg((F.col("toxic") == F.col("predicted")).cast("int")), F.corr("toxic", "predicted")).first()
    assert hit[0] > 0.98 and hit[1] > 0.9


def test_line_labels_follow_quality(spark):
    data = "/root/testdata/sf0.1"
    found = queries.op4_line_quality(spark, data).filter("NOT base_failed").join(spark.read.parquet(f"{data}/labels.parquet"), "doc_id")
    kept = {r["quality"]: r["kept"] for r in found.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert kept[1] > 0.99 and kept[0] < 0.1


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    given, before = docs.columns, docs.count()
    assert len(corpus_pipeline.STAGES) == 5
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = str(tmp_path / name)
        stage(spark, docs, DATA).write.parquet(out)
        docs = spark.read.parquet(out)
        assert docs.columns == given and 0 < docs.count() <= before
        before = docs.count()
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    packed = corpus_pipeline.run(spark, DATA)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == ids
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0


def test_pipeline_on_nothing(spark, tmp_path):
    empty = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, DATA).count() == 0, name
