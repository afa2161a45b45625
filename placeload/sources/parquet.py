"""Parquet table source with an optional limit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placeload.operators.selection import first_rows


def read_table(
    spark: SparkSession,
    path: str,
    limit: int | None = None,
    order_by: Sequence[str | Column] | str | Column | None = None,
    base_path: str | None = None,
) -> DataFrame:
    """Read a parquet directory, one partition of it, or a single file.

    A leaf directory such as ``table/dt=2023-03-14`` comes without its partition column
    unless ``base_path`` names the table's root. Reading the root and filtering on the
    partition column prunes to the same files.

    ``limit`` keeps that many rows, or all if there are fewer. With ``order_by`` they are
    the first in that order, in the table's order; see ``first_rows``. Otherwise any rows may be kept.
    """
    if order_by is not None and limit is None:
        raise ValueError("order_by only chooses the rows of a limit")
    reader = spark.read
    if base_path is not None:
        reader = reader.option("basePath", base_path)
    df = reader.parquet(path)
    if limit is None:
        return df
    if order_by is None:
        return row_cap(df, limit)
    return first_rows(df, limit, [order_by] if isinstance(order_by, (str, Column)) else list(order_by))


def row_cap(df: DataFrame, limit: int) -> DataFrame:
    """Exactly ``limit`` rows, or all if there are fewer, of a DataFrame that reads files.

    ``limit()`` would open every file and send all kept rows through one task. Instead, whole
    files are kept in order of their paths until the next would not fit, and the
    first rows of that one. Files are counted from their footers, in batches that grow fourfold until
    the limit is reached; those beyond are neither counted nor opened. The same rows are
    kept on every run.
    """
    if limit < 0:
        raise ValueError(f"limit must not be negative, got {limit}")
    if limit == 0:
        return df.where(F.lit(False))
    file = F.col("_metadata.file_path")
    # Listed paths have an empty authority where those of the metadata have none.
    files = sorted(f.replace(":///", ":/", 1) for f in df.inputFiles())
    left, at, width = limit, 0, 1
    beyond = F.lit(True)
    while True:
        # Ranges of paths keep the condition short however many files there are. The last one has no end.
        end = at + width
        batch = df.where(beyond & (file <= files[end - 1]) if end < len(files) else beyond)
        counts = batch.select(file.alias("file")).groupBy("file").count().orderBy("file")
        for last, rows in counts.toLocalIterator():
            if rows >= left:
                return df.where((file <= last) & ((file < last) | (F.col("_metadata.row_index") < left)))
            left -= rows
        if end >= len(files):
            return df
        beyond = file > files[end - 1]
        at, width = end, width * 4
