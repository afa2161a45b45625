"""Jobs for spark-submit: ``places``, ``flat`` and ``sql``.

    spark-submit --py-files placeload.zip \\
        --conf spark.placeload.source=s3a://bucket/table/dt=2023-03-14/ \\
        --conf spark.placeload.dest_table=geo.places  load.py places

    spark-submit ... load.py places --table places
    spark-submit ... load.py flat --keys placeIdentifier --order-by updated --columns "a INT NOT NULL, b VARCHAR(8)"
    spark-submit ... load.py sql script.sql --arg schema=geo --arg ds=2023-03-14
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from placeload import CATEGORIES, PLACES, ColumnDef, LoadConfig, TableDef, load_flat, load_places, run_in_full, run_script

TABLES = {"places": PLACES, "categories": CATEGORIES}


def names(text: str) -> list[str]:
    return [name.strip() for name in text.split(",") if name.strip()]


def bound(text: str) -> tuple[str, str]:
    name, separator, value = text.partition("=")
    if not separator or not name:
        raise argparse.ArgumentTypeError(f"name=value is needed, got {text!r}")
    return name, value


def definition(given: argparse.Namespace) -> TableDef | None:
    """The table to create if it is absent: a given one, or columns as in CREATE TABLE."""
    if given.columns is None:
        return TABLES.get(given.table)
    fields = StructType.fromDDL(given.columns).fields
    return TableDef(tuple(ColumnDef(f.name, f.dataType.simpleString(), f.nullable) for f in fields))


def arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    jobs = parser.add_subparsers(dest="job", required=True)
    places = jobs.add_parser("places", help="nested load")
    places.add_argument(
        "--mode",
        default="overwrite_truncate",
        choices=("overwrite_truncate", "overwrite_create", "append"),
    )
    flat = jobs.add_parser("flat", help="flat load; appends, or upserts by key")
    flat.add_argument("--keys", type=names)
    flat.add_argument("--order-by", type=names)
    for job in (places, flat):
        kind = job.add_mutually_exclusive_group()
        kind.add_argument("--table", choices=sorted(TABLES))
        kind.add_argument("--columns", help="columns as in CREATE TABLE")
    sql = jobs.add_parser("sql", help="statements of a file, in order")
    sql.add_argument("file")
    sql.add_argument("--arg", type=bound, action="append", default=[])
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> None:
    given = arguments(argv)
    spark = SparkSession.builder.getOrCreate()
    if given.job == "places":
        print(load_places(spark, LoadConfig.from_spark(spark), given.mode, definition(given)))
    elif given.job == "flat":
        print(load_flat(spark, LoadConfig.from_spark(spark), given.keys, given.order_by, definition(given)))
    else:
        text = spark.read.text(given.file, wholetext=True).first()["value"]
        result = run_script(spark, text, dict(given.arg))
        if result.columns:
            run_in_full(result, given.file)  # a failure may come at any row
            result.show()


if __name__ == "__main__":
    main()
