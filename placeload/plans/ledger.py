"""Which files a destination has been loaded from, so that a job can run again without loading them twice."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "dest string, path string, bytes long, modified timestamp, load_id string, state string"
STARTED, DONE, DROPPED = "started", "done", "dropped"


def ledger_table(spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    """The ledger, made if it is absent: rows are only ever added."""
    if not spark.catalog.tableExists(name):
        writer = spark.createDataFrame([], SCHEMA).write.format("parquet")
        (writer if path is None else writer.option("path", path)).saveAsTable(name)
    return spark.table(name)


def listing(spark: SparkSession, source: str) -> DataFrame:
    """The data files of a table: path, bytes, modified. Their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
    return files.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def states(spark: SparkSession, ledger: str, dest: str) -> DataFrame:
    """The last word on each file version: path, bytes, modified, load_id, state."""
    rank = F.when(F.col("state") == STARTED, 0).otherwise(1)
    own = ledger_table(spark, ledger).where(F.col("dest") == dest)
    by_load = own.groupBy("path", "bytes", "modified", "load_id").agg(F.max_by("state", rank).alias("state"))
    return by_load.where(F.col("state") != DROPPED)


def new_files(spark: SparkSession, source: str, ledger: str, dest: str, again: bool = False) -> DataFrame:
    """Files of ``source`` that ``dest`` was not loaded from: path, bytes, modified.

    A file that was replaced counts as new, by its size or time. Files of a load that did not end are left out, or
    taken with ``again``.
    """
    known = states(spark, ledger, dest)
    if again:
        known = known.where(F.col("state") == DONE)
    return listing(spark, source).join(known, ["path", "bytes", "modified"], "left_anti")


def unsettled(spark: SparkSession, ledger: str, dest: str) -> list[str]:
    """Loads that began and did not say that they ended."""
    mine = states(spark, ledger, dest).where(F.col("state") == STARTED)
    return sorted(r[0] for r in mine.select("load_id").distinct().collect())


def begin(files: DataFrame, ledger: str, dest: str) -> str:
    """Note that the files are about to be loaded; returns the load's id."""
    load_id = uuid.uuid4().hex
    _note(files, ledger, dest, load_id, STARTED)
    return load_id


def settle(spark: SparkSession, ledger: str, dest: str, load_id: str, loaded: bool = True) -> None:
    """Note that all files of a load are in the destination, or that none is."""
    files = states(spark, ledger, dest).where(F.col("load_id") == load_id).select("path", "bytes", "modified")
    _note(files, ledger, dest, load_id, DONE if loaded else DROPPED)


def _note(files: DataFrame, ledger: str, dest: str, load_id: str, state: str) -> None:
    noted = files.select(F.lit(dest).alias("dest"), "path", "bytes", "modified", F.lit(load_id).alias("load_id"), F.lit(state).alias("state"))
    noted.coalesce(1).write.insertInto(ledger)
    files.sparkSession.catalog.refreshTable(ledger)


def paths(files: DataFrame) -> Sequence[str]:
    """Paths for Spark's reader, which lists as many on the driver for any table."""
    return sorted(r[0] for r in files.select("path").collect())
