"""Tables whose files follow a curve over the map, read by a box of coordinates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placeload.functions.curve import Box, curve_key, curve_ranges
from placeload.functions.geo import geo_cell
from placeload.functions.nested import quoted, row_hash
from placeload.sources.tables import write_table

CURVE_NAME = "curve_key"


def write_clustered(
    df: DataFrame,
    name: str,
    latitude: Column | str,
    longitude: Column | str,
    resolution: int = 6,
    files: int | None = None,
    mode: str = "overwrite_create",
    path: str | None = None,
) -> None:
    """Write ``df`` in the order of ``curve_key``, with that key as an added last column.

    Rows are dealt out by ranges of the key, found from a sample, and sorted within each task, so that every
    file and row group holds a narrow range. Rows of a hot cell, or without a coordinate (NULL key), are
    split further by a hash of their columns. ``files`` is the number of ranges, by default
    that of Spark's shuffles. In ``append`` mode the new files are ordered among themselves.
    """
    if any(c.lower() == CURVE_NAME for c in df.columns):
        raise ValueError(f"there is a column {CURVE_NAME} already")
    if files is not None and files < 1:
        raise ValueError(f"files must be at least 1, got {files}")
    cell = geo_cell(latitude, longitude, resolution)
    keyed = df.select("*", cell.alias(CURVE_NAME)).withColumn(CURVE_NAME, curve_key(CURVE_NAME))
    number = [] if files is None else [files]
    dealt = keyed.repartitionByRange(*number, F.col(CURVE_NAME), row_hash(df.schema))
    write_table(dealt, name, mode, path, CURVE_NAME)


def read_box(
    spark: SparkSession,
    name: str,
    box: Box,
    latitude: Column | str,
    longitude: Column | str,
    resolution: int = 6,
    most: int = 32,
) -> DataFrame:
    """The rows of a clustered table whose coordinates lie in the box, edges included.

    ``resolution`` is that of the writing. The box becomes at most ``most`` ranges of the key, which the scan gets
    as a pushed filter, so row groups outside of them are not read; the coordinates decide on what is left.
    """
    df = spark.table(name)
    key = F.col(quoted(CURVE_NAME))
    near = reduce(Column.__or__, [key.between(low, high) for low, high in curve_ranges(box, resolution, most)])
    return df.where(near & box.holds(latitude, longitude)).drop(CURVE_NAME)
