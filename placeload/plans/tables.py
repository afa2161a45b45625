"""Table definitions with keys, NOT NULL and text widths."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import SparkSession

from placeload.functions.nested import literal, quoted


@dataclass(frozen=True)
class ColumnDef:
    name: str
    type: str
    nullable: bool = True


@dataclass(frozen=True)
class TableDef:
    columns: tuple[ColumnDef, ...]
    primary_key: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        names = [c.name for c in self.columns]
        unknown = [k for k in self.primary_key if k not in names]
        if unknown:
            raise ValueError(f"primary key columns not in the table: {unknown}")

    @property
    def not_null(self) -> tuple[str, ...]:
        return tuple(c.name for c in self.columns if not c.nullable)

    @property
    def widths(self) -> dict[str, int]:
        """Widths of the VARCHAR(n) columns."""
        found = {c.name: re.fullmatch(r"(?i)\s*varchar\s*\(\s*(\d+)\s*\)\s*", c.type) for c in self.columns}
        return {name: int(match[1]) for name, match in found.items() if match}

    @property
    def types(self) -> dict[str, str]:
        return {c.name: c.type for c in self.columns}

    def column_ddl(self) -> str:
        return ", ".join(f"{quoted(c.name)} {c.type}" for c in self.columns)


# Destination of the nested load, after the key column.
PLACES = TableDef(
    columns=(
        ColumnDef("cell_key", "BIGINT"),
        ColumnDef("placeIdentifier", "VARCHAR(32)"),
        ColumnDef("name", "VARCHAR(128)"),
        ColumnDef("storeId", "VARCHAR(32)"),
        ColumnDef("description", "STRING"),
        ColumnDef("localizedNames", "VARCHAR(256)"),
        ColumnDef("realityScore", "VARCHAR(16)"),
        ColumnDef("address", "STRING"),
        ColumnDef("geocodes", "VARCHAR(256)"),
        ColumnDef("contactInfo", "STRING"),
        ColumnDef("socialMediaInfo", "VARCHAR(256)"),
        ColumnDef("operationsInfo", "STRING"),
        ColumnDef("categories", "VARCHAR(32)"),
        ColumnDef("chains", "VARCHAR(64)"),
        ColumnDef("parent", "VARCHAR(32)"),
    )
)

# Reference table of place categories.
CATEGORIES = TableDef(
    columns=(
        ColumnDef("categoryIdentifier", "VARCHAR(256)", nullable=False),
        ColumnDef("name", "VARCHAR(64)"),
        ColumnDef("logo_prefix", "VARCHAR(1)"),
        ColumnDef("logo_suffix", "VARCHAR(1)"),
        ColumnDef("logo_actualResolution_height", "INT"),
        ColumnDef("logo_actualResolution_width", "INT"),
        ColumnDef("parentCategory", "VARCHAR(8)"),
        ColumnDef("dt", "TIMESTAMP_NTZ", nullable=False),
    ),
    primary_key=("categoryIdentifier",),
)


def create_or_replace(
    spark: SparkSession, name: str, table: TableDef, path: str | None = None
) -> None:
    """Drop the table if it exists and create it empty, at ``path`` if given.

    The rows of the old table go, also those of an external one. A ``path`` that holds rows
    of anything else is refused.

    VARCHAR(n) is enforced by Spark on write. Keys and NOT NULL are not: the built-in
    catalog takes a NULL into a NOT NULL column and then plans as if it had none. So they
    stay out of the DDL; check the rows with ``check_constraints`` before writing.

    Several statements, hence not atomic.
    """
    if spark.catalog.tableExists(name):
        # DROP leaves the files of an external table, and TRUNCATE is not allowed on one.
        nothing = spark.createDataFrame([], spark.table(name).schema)
        nothing.write.insertInto(name, overwrite=True)
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": name})
    location = "" if path is None else f" LOCATION {literal(path)}"
    spark.sql(
        f"CREATE TABLE IDENTIFIER(:name) ({table.column_ddl()}) USING parquet{location}",
        args={"name": name},
    )
    if path is not None and not spark.table(name).isEmpty():
        spark.sql("DROP TABLE IDENTIFIER(:name)", args={"name": name})
        raise ValueError(f"{path} already holds rows")
