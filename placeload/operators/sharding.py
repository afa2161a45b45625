"""Distribution of rows by a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeload.functions.nested import quoted, row_hash


def shard_by(df: DataFrame, key: str, shards: int) -> DataFrame:
    """Bring rows of one key together, in about ``shards`` partitions.

    A rebalance hint rather than ``repartition``: at run time Spark splits a partition
    that is far above the advisory size, so a key with a third of all rows becomes several
    tasks, and joins small ones. One shuffle, no look at the data before.

    Adaptive execution does this. Where it is switched off the rows are sampled and split in
    ranges of the key, those of a hot key in ranges of a hash.
    """
    if shards < 1:
        raise ValueError(f"shards must be at least 1, got {shards}")
    return balanced(df, [key], shards)


def balanced(df: DataFrame, columns: Sequence[str], parts: int | None = None) -> DataFrame:
    """As ``shard_by``, for several columns; without ``parts`` as many as Spark's shuffles have."""
    keys, number = [F.col(quoted(c)) for c in columns], [] if parts is None else [parts]
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") != "true":
        return df.repartitionByRange(*number, *keys, row_hash(df.schema))
    return df.hint("rebalance", *number, *keys)


def shard_report(df: DataFrame, key: str, shards: int) -> DataFrame:
    """Rows per shard: ``shard``, ``rows``. Empty shards are left out.

    A row's shard is the bucket ``bucketBy(shards, key)`` would put it in.
    """
    if shards < 1:
        raise ValueError(f"shards must be at least 1, got {shards}")
    shard = F.pmod(F.hash(F.col(quoted(key))), F.lit(shards))
    return df.groupBy(shard.alias("shard")).agg(F.count(F.lit(1)).alias("rows"))
