"""Catalog tables as a destination."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placeload.functions.nested import literal, quoted
from placeload.operators.sharding import balanced, shard_by
from placeload.operators.upsert import latest_by_key, rows_not_in
from placeload.sources.files import merge_files

MODES = ("overwrite_truncate", "overwrite_create", "append")

# The end of a directory that ``replace_rows`` made.
VERSION = r"-v[0-9a-f]{32}$"

OVERWRITE = "spark.sql.sources.partitionOverwriteMode"
_overwriting = Lock()


@contextmanager
def overwrite_mode(spark: SparkSession, mode: str) -> Iterator[None]:
    """Write with this overwrite mode, whatever the session's is; one such write at a time."""
    with _overwriting:
        before = spark.conf.get(OVERWRITE)
        spark.conf.set(OVERWRITE, mode)
        try:
            yield
        finally:
            spark.conf.set(OVERWRITE, before)


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite_truncate",
    path: str | None = None,
    sort_by: str | None = None,
    buckets: int | None = None,
    partitions: str = "static",
) -> None:
    """Write ``df`` into the parquet table ``name``, in its present partitions.

    ``overwrite_truncate`` and ``append`` keep an existing table with its column types
    and its layout, and match columns by name; ``overwrite_create`` makes the table anew.
    An absent table is created in every mode, at ``path`` if given. ``sort_by`` sorts
    within each task; with ``buckets`` it is also the bucket column of a new table. With
    ``partitions="dynamic"`` a truncating write only replaces the partitions it has rows of.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    if buckets is not None and sort_by is None:
        raise ValueError("buckets need sort_by")
    spark = df.sparkSession
    exists = spark.catalog.tableExists(name)
    if exists and mode != "overwrite_create":
        columns = spark.table(name).columns
        extra = {c.lower() for c in df.columns} - {c.lower() for c in columns}
        if extra:
            raise ValueError(f"{name} has no column {sorted(extra)}")
        df = df.select(*[quoted(c) for c in columns])
        if sort_by is not None:
            df = df.sortWithinPartitions(quoted(sort_by))
        with overwrite_mode(spark, partitions):
            df.write.insertInto(name, overwrite=mode == "overwrite_truncate")
        return
    if sort_by is not None and buckets is None:
        df = df.sortWithinPartitions(quoted(sort_by))
    writer = df.write.format("parquet").mode("overwrite")
    if buckets is not None:
        writer = writer.bucketBy(buckets, sort_by).sortBy(sort_by)
    if path is not None:
        writer = writer.option("path", path)
    with overwrite_mode(spark, "static"):
        writer.saveAsTable(name)


def write_sharded(
    df: DataFrame,
    name: str,
    key: str,
    shards: int,
    mode: str = "overwrite_create",
    path: str | None = None,
    bucketed: bool = True,
) -> None:
    """Write ``df`` with rows of one key next to each other, in one pass.

    A new table gets ``shards`` buckets on the key, so that later joins and groupings on
    it need no shuffle. But a bucket is read by one task: where ``shard_report`` shows one far
    above the others, take ``bucketed=False`` for sorted files that readers can split. An
    existing table that is kept also keeps its layout.
    """
    write_table(shard_by(df, key, shards), name, mode, path, key, shards if bucketed else None)


def replace_rows(df: DataFrame, name: str) -> None:
    """Make ``df`` the content of the table, also when ``df`` reads that table.

    The rows are written once, into a new directory beside the old one, through a table
    of the same columns, widths and layout. Then the table is pointed at it, or, as a
    partitioned table keeps a path per partition, the two tables trade names. A failed write
    leaves the table as it was. The old files go with the swap, but for those an external table was
    made with.
    """
    if "`" in name:
        raise ValueError(f"a plain dotted table name is needed, got {name!r}")
    spark = df.sparkSession
    version = uuid.uuid4().hex
    table, staged, old = (
        ".".join(map(quoted, n.split(".")))
        for n in (name, f"{name}_v{version}", f"{name}_old_v{version}")
    )
    before = _described(df, name, "Location").rstrip("/")
    ours = _described(df, name, "Type") == "MANAGED" or re.search(VERSION, before)
    path = re.sub(VERSION, "", before) + f"-v{version}"
    location = literal(path)
    spark.sql(f"CREATE TABLE {staged} LIKE {table} USING parquet LOCATION {location}")
    try:
        write_table(df, staged, "append")
    except Exception:
        spark.sql(f"DROP TABLE {staged}")
        raise
    if _columns(df, name, "isPartition"):
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
        spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
        spark.sql(f"DROP TABLE {old}")
    else:
        spark.sql(f"ALTER TABLE {table} SET LOCATION {location}")
        spark.sql(f"DROP TABLE {staged}")
    spark.catalog.refreshTable(name)
    if ours:
        folder = spark._jvm.org.apache.hadoop.fs.Path(before)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def merge_into(
    incoming: DataFrame,
    name: str,
    keys: Sequence[str],
    order_by: Sequence[str | Column] | None = None,
) -> tuple[DataFrame, Callable[[DataFrame], None]]:
    """An upsert into the table: the rows to write, and how to write them.

    Only the partitions that ``incoming`` can change are read and written, if the table is
    partitioned by part of its key; only the files that hold a changed row, if it is neither partitioned
    nor bucketed, see ``merge_files``. Otherwise its rows are written anew.
    """
    partitions, buckets = (_columns(incoming, name, kind) for kind in ("isPartition", "isBucket"))
    if not partitions and not buckets:
        return merge_files(incoming, name, _described(incoming, name, "Location"), keys, order_by)
    target = incoming.sparkSession.table(name)
    touched = touched_partitions(incoming, name, keys)
    if touched is not None:
        target = target.where(touched)
    kept, latest = rows_not_in(target, incoming, keys), latest_by_key(incoming, keys, order_by)
    # Else every task would write a file into every partition, or into every bucket. What is
    # read from a bucket stays in it.
    if partitions:
        merged = balanced(kept.unionByName(latest), partitions)
    elif buckets:
        number = int(_described(incoming, name, "Num Buckets"))
        # Without adaptive execution a hint does nothing, and this puts a bucket into one task.
        adaptive = incoming.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
        deal = balanced(latest, buckets, number) if adaptive else latest.repartition(number, *_cols(buckets))
        merged = kept.unionByName(deal)
    else:
        merged = kept.unionByName(latest)
    return merged, lambda df: (replace_rows if touched is None else replace_partitions)(df, name)


def upsert_table(
    incoming: DataFrame,
    name: str,
    keys: Sequence[str],
    order_by: Sequence[str | Column] | None = None,
) -> None:
    """Upsert ``incoming`` into the catalog table ``name``; see ``merge_into``."""
    rows, write = merge_into(incoming, name, keys, order_by)
    write(rows)


def _columns(df: DataFrame, name: str, kind: str) -> list[str]:
    return [c.name for c in df.sparkSession.catalog.listColumns(name) if getattr(c, kind)]


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(quoted(n)) for n in names]


def _described(df: DataFrame, name: str, property: str) -> str:
    rows = df.sparkSession.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:name)", args={"name": name}).collect()
    # Columns come first, and one may have the property's name.
    detail = [r["col_name"] for r in rows].index("# Detailed Table Information")
    return next(r["data_type"] for r in rows[detail:] if r["col_name"] == property)


def touched_partitions(incoming: DataFrame, name: str, keys: Sequence[str]) -> Column | None:
    """A condition that holds for just the partitions ``incoming`` can change.

    None if that may be all of them: the table has no partitions, or they do not follow from
    the key. The driver gets the partitions touched, as it gets those of any table it plans.
    """
    columns = _columns(incoming, name, "isPartition")
    if not columns or not set(columns) <= set(keys):
        return None
    found = incoming.select(*map(quoted, columns)).distinct().collect()
    if not found:
        return F.lit(False)
    # Whole combinations: the product of the single values would be far more.
    given = [F.struct(*[F.lit(row[c]).alias(c) for c in columns]) for row in found]
    return F.struct(*_cols(columns)).isin(given)


def replace_partitions(df: DataFrame, name: str) -> None:
    """Overwrite those partitions of the table that ``df`` has rows of, and no other.

    ``df`` may read the table: its new files are moved in place when all are written.
    """
    write_table(df, name, "overwrite_truncate", partitions="dynamic")
    df.sparkSession.catalog.refreshTable(name)


def rebuilt(spark: SparkSession, name: str, types: dict[str, str]) -> None:
    """Write the table ``name`` anew with these column types, in its layout, and give it the old one's name.

    A failed write leaves the table as it was.
    """
    if _columns(spark.table(name), name, "isBucket"):
        raise ValueError(f"{name} is bucketed: write it anew with write_sharded")
    table, version = ".".join(map(quoted, name.split("."))), uuid.uuid4().hex
    staged, old = (".".join(map(quoted, f"{name}{end}{version}".split("."))) for end in ("_v", "_old_v"))
    df = spark.table(name)
    partitions = _columns(df, name, "isPartition")
    columns = ", ".join(f"{quoted(c)} {types[c]}" for c in df.columns)
    parted = f" PARTITIONED BY ({', '.join(map(quoted, partitions))})" if partitions else ""
    location = re.sub(VERSION, "", _described(df, name, "Location").rstrip("/")) + f"-v{version}"
    spark.sql(f"CREATE TABLE {staged} ({columns}) USING parquet{parted} LOCATION {literal(location)}")
    try:
        write_table(balanced(df, partitions) if partitions else df, f"{name}_v{version}", "append")
    except BaseException:
        spark.sql(f"DROP TABLE {staged}")
        raise
    spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
    spark.sql(f"DROP TABLE {old}")
    spark.catalog.refreshTable(name)
