"""Load jobs: read, key, convert, write, report."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeload.config import LoadConfig
from placeload.functions.nested import quoted
from placeload.operators.report import LoadReport, observed_write
from placeload.operators.sharding import shard_by
from placeload.operators.upsert import fail_if, latest_by_key, upsert
from placeload.plans.ledger import begin, new_files, paths, settle, unsettled
from placeload.plans.places import KEY_NAME, append_cell_key, places_frame
from placeload.plans.tables import TableDef, create_or_replace
from placeload.sources.jdbc import JdbcTarget, read_jdbc, row_count, table_exists, write_jdbc
from placeload.sources.parquet import read_table
from placeload.sources.staging import apply_latest, publish, swap
from placeload.sources.tables import merge_into, write_table
from placeload.storage import materialize

LOG = logging.getLogger(__name__)


def load_places(
    spark: SparkSession,
    config: LoadConfig,
    mode: str = "overwrite_truncate",
    table: TableDef | None = None,
) -> LoadReport:
    """Nested load: cell key first (resolution 3 by default), nested columns as JSON text.

    Reads the source once. Rows are shuffled only if ``config.shards`` is set. A destination
    that has to be created gets the column types of ``table``, and unbounded text without it;
    a NULL in one of its NOT NULL columns fails the load. With ``config.ledger`` only ``append`` makes sense.
    """
    if config.ledger is not None:
        if mode != "append":
            raise ValueError("a ledger needs mode='append': what was loaded before has to stay")
        return _from_ledger(spark, config, False, lambda one: load_places(spark, one, mode, table))
    source = _read(spark, config)
    rows = places_frame(source, 3 if config.resolution is None else config.resolution)
    return _store(rows, config, mode, table, _rows_before_limit(spark, config))


def load_flat(
    spark: SparkSession,
    config: LoadConfig,
    keys: Sequence[str] | None = None,
    order_by: Sequence[str | Column] | None = None,
    table: TableDef | None = None,
) -> LoadReport:
    """Flat load: typed columns, then the cell key (resolution 6 by default).

    Appends; with ``keys`` it updates the rows whose key the destination already has, and
    reports as ``rows_out`` the rows that the destination holds then, ``null_keys`` of those written. Over JDBC only the changed rows travel, see ``apply_changes``; ``config.jdbc_apply`` says how they
    are applied. ``"reload"`` writes the whole table; one with a text key is then read in ranges of the
    cell key, unless ``config.jdbc_split`` says how to split it. A database that updates on an existing
    primary key by itself needs no ``keys``: set its flag in ``config.jdbc_options`` and append.
    ``table`` is used as ``load_places`` uses it.

    With ``keys`` the rows are written once into the shared folder: the touched partitions,
    the keys and the latest rows are all taken from there.
    """
    if config.ledger is not None:
        return _from_ledger(spark, config, keys is not None, lambda one: load_flat(spark, one, keys, order_by, table))
    source = _read(spark, config)
    rows = append_cell_key(source, 6 if config.resolution is None else config.resolution)
    rows_in = _rows_before_limit(spark, config)
    if keys is None:
        return _store(rows, config, "append", table, rows_in)
    rows, seen = _staged(rows)
    rows_in = seen if rows_in is None else rows_in
    if not _exists(spark, config):
        return _store(latest_by_key(rows, keys, order_by), config, "append", table, rows_in)
    rows = _without_nulls(rows, table)

    if config.jdbc_url is None:
        merged, write = merge_into(rows, config.dest_table, keys, order_by)
        report = observed_write(merged, KEY_NAME, write, rows_in)
        # What Spark's footers say: files and partitions without a change were not written.
        return _logged(replace(report, rows_out=spark.table(config.dest_table).count()), config)
    target = jdbc_target(config)
    settings = {"num_partitions": config.num_partitions, "batch_size": config.batch_size}
    if config.jdbc_apply != "reload":
        latest = latest_by_key(rows, keys, order_by)
        report = observed_write(
            latest, KEY_NAME, lambda df: apply_latest(df, target, keys, config.jdbc_apply, **settings), rows_in
        )
        return _logged(replace(report, rows_out=row_count(spark, target)), config)
    ranges = config.num_partitions or spark.sparkContext.defaultParallelism
    column = None if config.jdbc_split else _range_column(rows, keys)
    present = read_jdbc(spark, target, column, ranges, config.jdbc_split)
    report = observed_write(
        upsert(present, rows, keys, order_by),
        KEY_NAME,
        lambda df: publish(materialize(df, "upsert"), target, True, write=write_jdbc, **settings),
        rows_in,
    )
    return _logged(report, config)


def _read(spark: SparkSession, config: LoadConfig) -> DataFrame:
    if config.files is None:
        return read_table(spark, config.source, config.limit)
    return spark.read.option("basePath", config.source).parquet(*config.files)


def _from_ledger(
    spark: SparkSession, config: LoadConfig, repeatable: bool, load: Callable[[LoadConfig], LoadReport]
) -> LoadReport:
    """Load the files that the ledger does not have, and note them.

    They are noted before and after. Where a load did not say that it ended, a keyed load takes its files
    again, since that changes nothing. Appending stops until ``settle`` says whether they had been loaded.
    """
    open_ = unsettled(spark, config.ledger, config.dest_table)
    if open_ and not repeatable:
        raise RuntimeError(f"loads {open_} into {config.dest_table} did not end: settle them, loaded or not")
    files = new_files(spark, config.source, config.ledger, config.dest_table, again=repeatable)
    files = materialize(files, "new-files")
    found = paths(files)
    if not found:
        for load_id in open_:
            settle(spark, config.ledger, config.dest_table, load_id, loaded=False)
        return _logged(LoadReport(0, 0, 0, 0.0), config)
    load_id = begin(files, config.ledger, config.dest_table)
    report = load(replace(config, ledger=None, files=tuple(found)))
    for done in (*open_, load_id):
        settle(spark, config.ledger, config.dest_table, done, loaded=done == load_id)
    return report


def jdbc_target(config: LoadConfig) -> JdbcTarget:
    return JdbcTarget(
        url=config.jdbc_url,
        table=config.dest_table,
        user=config.jdbc_user,
        password=config.jdbc_password,
        driver=config.jdbc_driver,
        options=config.jdbc_options,
    )


def _exists(spark: SparkSession, config: LoadConfig) -> bool:
    if config.jdbc_url is None:
        return spark.catalog.tableExists(config.dest_table)
    return table_exists(spark, jdbc_target(config))


def _range_column(rows: DataFrame, keys: Sequence[str]) -> str:
    """A column that JDBC can read in ranges: of the primary key if possible."""
    types = {f.name: f.dataType for f in rows.schema}
    ranged = (T.NumericType, T.DateType)
    return next((k for k in keys if isinstance(types[k], ranged)), KEY_NAME)


def _rows_before_limit(spark: SparkSession, config: LoadConfig) -> int | None:
    """Rows of the source, from its footers; None without a limit, when the load counts them."""
    return None if config.limit is None else spark.read.parquet(config.source).count()


def _staged(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` from the shared folder, and their number, counted by the stage that writes them."""
    seen = Observation()
    staged = materialize(rows.observe(seen, F.count(F.lit(1)).alias("rows")), "incoming")
    return staged, seen.get["rows"]


def _without_nulls(rows: DataFrame, table: TableDef | None) -> DataFrame:
    """``rows``, failing at a NULL where the definition allows none."""
    for name in table.not_null if table is not None else ():
        rows = rows.where(fail_if(F.col(quoted(name)).isNull(), f"NULL in column {name}"))
    return rows


def _store(
    rows: DataFrame,
    config: LoadConfig,
    mode: str,
    table: TableDef | None = None,
    rows_in: int | None = None,
) -> LoadReport:
    spark = rows.sparkSession
    rows = _without_nulls(rows, table)
    # Sharded before it is observed: the last stage counts each of its tasks once.
    if config.shards is not None:
        rows = shard_by(rows, KEY_NAME, config.shards)

    def write(df: DataFrame) -> None:
        if config.jdbc_url is None:
            sort_by = None if config.shards is None else KEY_NAME
            fresh = mode == "overwrite_create" or not _exists(spark, config)
            if table is not None and fresh:
                create_or_replace(spark, config.dest_table, table, config.path)
                write_table(df, config.dest_table, "append", sort_by=sort_by)
            else:
                write_table(df, config.dest_table, mode, config.path, sort_by)
        else:
            _write_jdbc(df, config, mode, None if table is None else table.types)

    report = observed_write(rows, KEY_NAME, write, rows_in)
    if config.jdbc_url is not None and mode != "append" and not config.jdbc_staged:
        _check_stored(spark, jdbc_target(config), report)
    return _logged(report, config)


def _write_jdbc(df: DataFrame, config: LoadConfig, mode: str, types: Mapping[str, str] | None) -> None:
    """Through a staging table, so that a load which fails, or writes rows twice, never shows.

    Appending goes straight to the table, where the driver's own flags for present keys work.
    """
    target, settings = jdbc_target(config), {"num_partitions": config.num_partitions, "batch_size": config.batch_size}
    if mode == "append" or not config.jdbc_staged:
        write_jdbc(df, target, mode, types=types, **settings)
        return
    exists = table_exists(df.sparkSession, target)
    if exists and mode == "overwrite_create":
        swap(df, target, types=types, write=write_jdbc, **settings)
    else:
        publish(df, target, exists, types=types, write=write_jdbc, **settings)


def _logged(report: LoadReport, config: LoadConfig) -> LoadReport:
    LOG.info("%s into %s: %s", config.source, config.dest_table, report)
    return report


def _check_stored(spark: SparkSession, target: JdbcTarget, report: LoadReport) -> None:
    """A task whose executor is lost right after its commit runs again and adds its rows twice."""
    stored = row_count(spark, target)
    if stored != report.rows_out:
        raise RuntimeError(
            f"{target.table} holds {stored} rows after {report.rows_out} were written: load it again"
        )
