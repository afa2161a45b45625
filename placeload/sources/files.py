"""Upserts that rewrite only the files of a table which hold a changed row.

For catalog tables of plain files: not partitioned, not bucketed. The keys of the changes say which files are touched;
those are read, merged and written anew, all others stay as they are. New files are written into a hidden folder of the
table first. A list of the files they replace, put there last, makes the change final: from then on it is carried
through, by ``finish`` at the next upsert if this one is interrupted; a folder without the list never counts.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeload.functions.nested import literal, quoted
from placeload.operators.upsert import latest_by_key, rows_not_in
from placeload.storage import materialize

#: Spark leaves out what starts with an underscore.
FOLDER, REPLACED = "_upsert-", "_replaced"


def touched_files(incoming: DataFrame, name: str, keys: Sequence[str]) -> list[str]:
    """Paths of the table's files that hold a key of ``incoming``.

    Only the key columns are read. The range of the first key leaves out files and row groups by their
    least and largest value; what is left is joined with the distinct keys. The driver
    gets paths, at most as many as the table has files, which it lists to plan any query.
    """
    target = incoming.sparkSession.table(name)
    columns = [F.col(quoted(k)) for k in keys]
    wanted = incoming.select(*columns).distinct()
    first = columns[0]
    ranged = (T.NumericType, T.DateType, T.StringType)
    if isinstance(target.schema[keys[0]].dataType, ranged):
        low, high = incoming.agg(F.min(first), F.max(first)).first()
        if low is None:
            return []
        target = target.where((first >= F.lit(low)) & (first <= F.lit(high)))
    file = target.metadataColumn("_metadata")["file_path"]
    held = target.select(*columns, file.alias("_placeload_file")).join(wanted, list(keys), "left_semi")
    return sorted(r[0] for r in held.select("_placeload_file").distinct().collect())


def merge_files(
    incoming: DataFrame, name: str, location: str, keys: Sequence[str], order_by: Sequence[str | Column] | None
) -> tuple[DataFrame, Callable[[DataFrame], None]]:
    """The rows to write for an upsert into the table at ``location``, and how to write them."""
    spark = incoming.sparkSession
    finish(spark, name, location)
    latest = materialize(latest_by_key(incoming, keys, order_by), "latest")
    replaced = touched_files(latest, name, keys)
    latest = latest.select(*[F.col(quoted(c)) for c in spark.table(name).columns])
    merged = latest
    if replaced:
        # Their paths as they are: such a read lists nothing else.
        present = spark.read.schema(spark.table(name).schema).parquet(*replaced)
        merged = rows_not_in(present, latest, keys).unionByName(latest)
    return merged, lambda df: write_files(df, name, location, replaced)


def write_files(df: DataFrame, name: str, location: str, replaced: Sequence[str]) -> None:
    """Put the rows of ``df`` in the place of the files ``replaced``."""
    from placeload.sources.tables import write_table

    spark, version = df.sparkSession, uuid.uuid4().hex
    folder = f"{location.rstrip('/')}/{FOLDER}{version}"
    table = ".".join(map(quoted, name.split(".")))
    staged = ".".join(map(quoted, f"{name}_v{version}".split(".")))
    # A table of the same columns checks their widths.
    spark.sql(f"CREATE TABLE {staged} LIKE {table} USING parquet LOCATION {literal(folder)}")
    try:
        write_table(df, staged, "append")
    except BaseException:
        spark.sql(f"DROP TABLE {staged}")
        _delete(spark, folder)
        raise
    spark.sql(f"DROP TABLE {staged}")
    _write_list(spark, folder, replaced)
    finish(spark, name, location)


def finish(spark: SparkSession, name: str, location: str) -> None:
    """Carry through what an upsert had made final, and clear away what it had not.

    Each step can be repeated: new files are moved in, then old ones go, then the list. Readers that run
    in this moment may see files of both.
    """
    system, path = _filesystem(spark, location)
    if not system.exists(path):
        return
    changed = False
    for entry in system.listStatus(path):
        folder = entry.getPath()
        if not folder.getName().startswith(FOLDER):
            continue
        changed = True
        replaced = _read_list(spark, folder.toString())
        if replaced is not None:
            for file in system.listStatus(folder):
                if not file.getPath().getName().startswith(("_", ".")):
                    moved = _path(spark, f"{location.rstrip('/')}/{file.getPath().getName()}")
                    if not system.rename(file.getPath(), moved):
                        raise RuntimeError(f"{file.getPath()} could not be moved to {moved}")
            for old in replaced:
                system.delete(_path(spark, old), False)
        system.delete(folder, True)
    if changed:
        spark.catalog.refreshTable(name)


def _path(spark: SparkSession, text: str):
    return spark._jvm.org.apache.hadoop.fs.Path(text)


def _filesystem(spark: SparkSession, text: str):
    path = _path(spark, text)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _delete(spark: SparkSession, folder: str) -> None:
    system, path = _filesystem(spark, folder)
    system.delete(path, True)


def _write_list(spark: SparkSession, folder: str, replaced: Sequence[str]) -> None:
    """Written under another name first: the list is there as a whole or not at all."""
    system, path = _filesystem(spark, f"{folder}/{REPLACED}.part")
    stream = system.create(path, True)
    stream.write("\n".join(replaced).encode())
    stream.close()
    system.rename(path, _path(spark, f"{folder}/{REPLACED}"))


def _read_list(spark: SparkSession, folder: str) -> list[str] | None:
    system, path = _filesystem(spark, f"{folder}/{REPLACED}")
    if not system.exists(path):
        return None
    stream = system.open(path)
    try:
        text = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    return [line for line in text.split("\n") if line]
