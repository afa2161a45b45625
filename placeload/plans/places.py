"""The two shapes of a keyed place table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from placeload.functions.geo import geo_cell
from placeload.functions.nested import json_columns

KEY_NAME = "cell_key"

# Where the two source layouts keep a place's coordinates.
NESTED_LATITUDE = "geocodes.mainEntry.latitude"
NESTED_LONGITUDE = "geocodes.mainEntry.longitude"
FLAT_LATITUDE = "geocodes_mainEntry_latitude"
FLAT_LONGITUDE = "geocodes_mainEntry_longitude"


def _refuse_clash(df: DataFrame, key_name: str) -> None:
    if key_name.lower() in (c.lower() for c in df.columns):
        raise ValueError(f"the input already has a column {key_name!r}")


def places_frame(
    df: DataFrame,
    resolution: int = 3,
    latitude: str = NESTED_LATITUDE,
    longitude: str = NESTED_LONGITUDE,
    key_name: str = KEY_NAME,
    scalars: str = "keep",
) -> DataFrame:
    """The cell key first, then the input in its order with nested columns as JSON text."""
    _refuse_clash(df, key_name)
    key = geo_cell(latitude, longitude, resolution).alias(key_name)
    return df.select(key, *json_columns(df.schema, scalars))


def append_cell_key(
    df: DataFrame,
    resolution: int = 6,
    latitude: str = FLAT_LATITUDE,
    longitude: str = FLAT_LONGITUDE,
    key_name: str = KEY_NAME,
) -> DataFrame:
    """The input as it is, typed columns kept, then the cell key."""
    _refuse_clash(df, key_name)
    return df.withColumn(key_name, geo_cell(latitude, longitude, resolution))
