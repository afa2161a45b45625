"""Exact deduplication with the state of a stream.

Each document is reduced to a digest, its id and the place of its content (file and row).
These entries are read as a stream; a keyed state in RocksDB without expiry holds per digest the
smallest id, its place, and the number of documents. Documents that hit a digest which another
one holds are compared with that one's full text; should texts of one digest differ, they
are grouped again by the text itself.

Defined results: a NULL text counts as empty; white space runs count as one space; of rows with
the smallest id the first by file and row stays; a NULL id is larger than any other; an empty
table gives an empty result. Only ``doc_id`` and ``text`` are read, whatever else there is.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placeload.llm.common import SPACE, located, placed, without
from placeload.storage import materialize, scratch_path

STATE = "spark.sql.streaming.stateStore."
#: State on disk; changes are stored, not copies of the whole; no disk is taken in advance for each of many small stores.
SETTINGS = {
    STATE + "providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    STATE + "rocksdb.changelogCheckpointing.enabled": "true",
    STATE + "rocksdb.allowFAllocate": "false",
}


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Settings that a stream takes over when it starts; the session gets its own back."""
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def normalised(text: str) -> Column:
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), f"[{SPACE}]+", " ")


def digest_state(entries: DataFrame, path: str, files_per_batch: int = 64) -> DataFrame:
    """Per digest the holder and the number of rows, kept by a stream over the files at ``path``."""
    spark = entries.sparkSession
    updates = scratch_path(spark, "digests")
    with settings(spark, SETTINGS):
        query = (
            spark.readStream.schema(entries.schema)
            .option("maxFilesPerTrigger", files_per_batch)
            .parquet(path)
            .groupBy("digest")
            .agg(F.min("entry").alias("holder"), F.count(F.lit(1)).alias("group_size"))
            .writeStream.outputMode("update")
            .option("checkpointLocation", scratch_path(spark, "digest-state"))
            .trigger(availableNow=True)
            .foreachBatch(lambda batch, number: batch.write.mode("overwrite").parquet(f"{updates}/batch={number}"))
            .start()
        )
    query.awaitTermination()
    held = f"digest string, holder {entries.schema['entry'].dataType.simpleString()}, group_size long"
    if not query.lastProgress:
        return spark.createDataFrame([], held)
    # Each batch gives the state of the digests it touched: sizes only grow, holders only fall.
    # Written, so that a join with it can split the rows of a digest that very many have.
    return materialize(
        spark.read.schema(held + ", batch int")
        .parquet(updates)
        .groupBy("digest")
        .agg(F.min("holder").alias("holder"), F.max("group_size").alias("group_size")),
        "state",
    )


def exact_groups(docs: DataFrame, files_per_batch: int = 64, digest=lambda text: F.sha2(text, 256)) -> DataFrame:
    """One row per document: ``doc_id, file, pos, digest, holder, group_size``.

    ``holder`` is (no_id, doc_id, file, pos) of the row that stays. ``digest`` makes the key of
    the state from the normalised text; results do not depend on it.
    """
    rows = located(docs, "doc_id", "text")
    spark = docs.sparkSession
    path = scratch_path(spark, "entries")
    entry = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "pos").alias("entry")
    rows.select(digest(normalised("text")).alias("digest"), entry).write.parquet(path)
    entries = spark.read.parquet(path)
    groups = materialize(
        entries.join(digest_state(entries, path, files_per_batch), "digest").select("digest", "entry", "holder", "group_size"),
        "groups",
    )
    several = groups.filter("group_size > 1").select("digest", "entry", "holder", "entry.file", "entry.pos")
    texts = materialize(
        rows.select("file", "pos", normalised("text").alias("full_text")).join(several, ["file", "pos"]), "texts"
    )
    stays = F.expr("entry = holder")
    first = texts.filter(stays).select("digest", F.col("full_text").alias("held_text"))
    differing = materialize(
        texts.filter(~stays).join(first, "digest").filter("full_text <> held_text").select("digest", "entry", "full_text"),
        "differing",
    )
    if not differing.isEmpty():
        groups = _regrouped(groups, differing)
    return groups.select("entry.doc_id", "entry.file", "entry.pos", "digest", "holder", "group_size")


def _regrouped(groups: DataFrame, differing: DataFrame) -> DataFrame:
    """Texts that only share a digest with their holder form groups of their own."""
    own = differing.groupBy("digest", "full_text").agg(
        F.min("entry").alias("own_holder"), F.count(F.lit(1)).alias("own_size")
    )
    moved = differing.join(own, ["digest", "full_text"]).select("entry", "own_holder", "own_size")
    fewer = differing.groupBy("digest").agg(F.count(F.lit(1)).alias("fewer"))
    return (
        groups.join(moved, "entry", "left")
        .join(fewer, "digest", "left")
        .select(
            "digest",
            "entry",
            F.coalesce("own_holder", "holder").alias("holder"),
            F.coalesce("own_size", F.col("group_size") - F.coalesce("fewer", F.lit(0))).alias("group_size"),
        )
    )


def exact_dedup(docs: DataFrame, files_per_batch: int = 64) -> DataFrame:
    """Per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    groups = exact_groups(docs, files_per_batch)
    return groups.select(
        "doc_id",
        F.col("holder.doc_id").alias("keep_id"),
        "group_size",
        F.expr("file = holder.file AND pos = holder.pos").alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, files_per_batch: int = 64) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    docs = placed(docs)
    groups = exact_groups(docs, files_per_batch)
    return without(docs, groups.filter("NOT (file = holder.file AND pos = holder.pos)"))
