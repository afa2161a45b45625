"""Reproducible shuffle and shards by a keyed permutation of global row numbers.

Rows are numbered in the order of id, size and checksum; a Feistel network with cycle walking
permutes the numbers 0 to N - 1. The image of a number gives shard (remainder) and slot
(quotient), so both can be computed for any row number without looking at other rows, and shard
sizes are at most one apart. The inverse gives the row of any shard and slot.

Defined results: a NULL text has no bytes and checksum 0; NULL ids come first; equal rows are interchangeable.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeload.llm.common import mix, numbered


def _round(half: np.ndarray, key: int, number: int) -> np.ndarray:
    seed = (key * 0x9E3779B97F4A7C15 + number * 0xD1B54A32D192ED03 + 0x632BE59BD9B4E019) & (2**64 - 1)
    return mix(mix(half ^ np.uint64(seed)) + np.uint64(seed))


def permute(numbers: np.ndarray, total: int, key: int = 0, rounds: int = 6, inverse: bool = False) -> np.ndarray:
    """The keyed permutation of 0 to ``total - 1``, or its inverse.

    The network works on pairs (left, right) below sides a and b with a * b just above the
    total, so few images lie outside; those are permuted again until they fall inside.
    """
    if total <= 0:
        return numbers.astype(np.uint64)
    a = max(1, math.isqrt(total - 1) + 1)
    b = -(-total // a)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x // np.uint64(b), x % np.uint64(b)
        steps = range(rounds)
        for n in reversed(steps) if inverse else steps:
            if n % 2:
                drift = _round(left, key, n) % np.uint64(b)
                right = (right + (np.uint64(b) - drift if inverse else drift)) % np.uint64(b)
            else:
                drift = _round(right, key, n) % np.uint64(a)
                left = (left + (np.uint64(a) - drift if inverse else drift)) % np.uint64(a)
        return left * np.uint64(b) + right

    image = once(numbers.astype(np.uint64))
    while (outside := image >= np.uint64(total)).any():
        image[outside] = once(image[outside])
    return image


def shard_rows(docs: DataFrame, shards: int = 24, key: int = 0) -> DataFrame:
    """Per document: doc_id, size, text_crc32, row_number, shard, slot."""
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    sized = docs.select(
        "doc_id", (F.octet_length(body) + 8).cast("long").alias("size"), F.crc32(body).cast("long").alias("text_crc32")
    )
    rows, total = numbered(sized, "doc_id", "size", "text_crc32")

    @F.pandas_udf("long")
    def place(number: pd.Series) -> pd.Series:
        return pd.Series(permute(number.to_numpy(), total, key).astype(np.int64))

    return rows.withColumn("place", place("row_number")).select(
        "*", (F.col("place") % shards).cast("int").alias("shard"), F.expr(f"place div {shards}").alias("slot")
    )
