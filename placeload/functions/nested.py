"""Nested columns as JSON text, driven by the schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NESTED_TYPES = (T.StructType, T.ArrayType, T.MapType, T.VariantType)
TEXT_TYPES = (T.StringType, T.CharType, T.VarcharType)


def quoted(name: str) -> str:
    """A column name that Spark takes literally, dots and backticks included."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """A text as a SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def is_nested(field: T.StructField) -> bool:
    return isinstance(field.dataType, NESTED_TYPES)


def is_text(field: T.StructField) -> bool:
    return isinstance(field.dataType, TEXT_TYPES)


def json_columns(schema: T.StructType, scalars: str = "keep") -> list[Column]:
    """One Column per field of ``schema``: JSON text for nested ones, the rest as it is."""
    if scalars not in ("keep", "error"):
        raise ValueError(f"scalars must be 'keep' or 'error', got {scalars!r}")
    if scalars == "error":
        other = [f.name for f in schema if not (is_text(f) or is_nested(f))]
        if other:
            raise ValueError(f"neither text nor nested, so not writable as JSON: {other}")
    return [
        F.to_json(F.col(quoted(f.name))).alias(f.name) if is_nested(f) else F.col(quoted(f.name))
        for f in schema
    ]


def stringify_nested(df: DataFrame, scalars: str = "keep") -> DataFrame:
    """Turn every struct, array, map and variant column into JSON text.

    Text passes through unchanged and the column order stays. Other scalars keep their
    type with ``scalars="keep"``; ``"error"`` refuses them.

    JSON text follows ``to_json``: NULL fields are left out, a NULL column stays NULL,
    timestamps are cut to milliseconds.
    """
    return df.select(*json_columns(df.schema, scalars))


def row_hash(schema: T.StructType) -> Column:
    """A hash over all columns and which of them are NULL, to order rows that are otherwise equal."""
    values = [F.to_json(F.col(quoted(f.name))) if is_nested(f) else F.col(quoted(f.name)) for f in schema]
    return F.xxhash64(*[v.isNull() for v in values], *values)
