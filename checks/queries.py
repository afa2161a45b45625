"""Every operator as a query over the given tables.

No given table has coordinates, so the place tables are derived from ``orders``. Tables a
query writes go to the shared folder, under names used once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import placeload as pl
from placeload.plans.places import FLAT_LATITUDE, FLAT_LONGITUDE, KEY_NAME
from placeload.storage import is_local

SHARDS = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pl.read_table(spark, f"{sf_dir}/{name}.parquet")


def fresh(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex}"


# --- place tables ---------------------------------------------------------------------

LATITUDE = """
    CASE WHEN o_custkey % 10 = 0 THEN NULL
         ELSE CAST((o_orderkey * 7919) % 17999 AS DOUBLE) / CAST(100 AS DOUBLE)
              - CAST(89.993 AS DOUBLE) END
"""
LONGITUDE = """
    CAST((o_orderkey * 104729) % 35999 AS DOUBLE) / CAST(100 AS DOUBLE)
        - CAST(179.993 AS DOUBLE)
"""


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("placeIdentifier"),
        F.col("o_orderpriority").alias("name"),
        F.struct(
            F.col("o_orderstatus").alias("status"),
            F.col("o_orderpriority").alias("prio"),
            F.nullif(F.col("o_custkey") % 10, F.lit(0)).alias("cust"),
        ).alias("address"),
        F.struct(
            F.struct(
                F.expr(LATITUDE).alias("latitude"), F.expr(LONGITUDE).alias("longitude")
            ).alias("mainEntry")
        ).alias("geocodes"),
        F.array("o_orderstatus", "o_orderpriority").alias("categories"),
    )


def flat_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_totalprice",
        F.expr(LATITUDE).alias(FLAT_LATITUDE),
        F.expr(LONGITUDE).alias(FLAT_LONGITUDE),
    )


def keyed(spark: SparkSession, sf_dir: str, resolution: int) -> DataFrame:
    key = pl.geo_cell("geocodes.mainEntry.latitude", "geocodes.mainEntry.longitude", resolution)
    return places(spark, sf_dir).select("placeIdentifier", key.alias(KEY_NAME))


# --- sources --------------------------------------------------------------------------


def q_read_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def q_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("rows"))


def q_limit_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.read_table(spark, f"{sf_dir}/orders.parquet", limit=1000, order_by="o_orderkey")


def q_limit_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An ordered limit taken from the sorted table instead of in one task."""
    path = f"{sf_dir}/orders.parquet"
    order = [F.col("o_totalprice").desc(), "o_orderkey"]
    return pl.read_table(spark, path, limit=1200, order_by=order)


def q_row_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An unordered cap may keep any rows, so their number is what can be compared."""
    path = pl.scratch_path(spark, "capped")
    table(spark, sf_dir, "lineitem").repartition(spark.sparkContext.defaultParallelism).write.parquet(path)
    kept = pl.read_table(spark, path, limit=5000)
    return kept.agg(F.count(F.lit(1)).alias("rows"))


def _by_status(spark: SparkSession, sf_dir: str) -> str:
    path = pl.scratch_path(spark, "by-status")
    table(spark, sf_dir, "orders").write.partitionBy("o_orderstatus").parquet(path)
    return path


def q_partition_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.read_table(spark, _by_status(spark, sf_dir) + "/o_orderstatus=F")


def q_partition_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _by_status(spark, sf_dir)
    return pl.read_table(spark, root + "/o_orderstatus=F", base_path=root)


def q_partition_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _by_status(spark, sf_dir)
    return pl.read_table(spark, root).where(F.col("o_orderstatus") == "F")


# --- projections ----------------------------------------------------------------------


def q_nested_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return places(spark, sf_dir).select(
        "placeIdentifier",
        F.col("geocodes.mainEntry.latitude").alias("latitude"),
        F.col("geocodes.mainEntry.longitude").alias("longitude"),
    )


def q_geo_cell_r3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(spark, sf_dir, 3)


def q_geo_cell_r6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(spark, sf_dir, 6)


def q_json_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.stringify_nested(places(spark, sf_dir))


def q_append_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.append_cell_key(flat_places(spark, sf_dir))


def q_constants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_key"),
        F.lit(6).alias("resolution"),
        F.lit("2023-03-14").alias("run_date"),
    )


# --- aggregates -----------------------------------------------------------------------


def q_group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.nullif(F.col("event_type"), F.lit("error")).alias("event_type")
    return table(spark, sf_dir, "events").select(kind).groupBy("event_type").count()


def q_cell_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(spark, sf_dir, 3).groupBy(KEY_NAME).agg(F.count(F.lit(1)).alias("rows"))


def q_shard_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.shard_report(keyed(spark, sf_dir, 3), KEY_NAME, SHARDS)


def q_width_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = [
        pl.width_profile(table(spark, sf_dir, name)) for name in ("customer", "part", "documents")
    ]
    return profiles[0].unionByName(profiles[1]).unionByName(profiles[2])


def q_profile_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads of orders, one of them run twice, profiled as they come and advised on from their sketches."""
    name, orders = fresh("profiles"), table(spark, sf_dir, "orders")
    for load in (0, 1, 1, 2):
        part = orders.where(F.pmod(F.xxhash64("o_orderkey"), F.lit(3)) == load)
        pl.keep_sketches(part, name, f"load-{load}", pl.scratch_path(spark, name))
    advice = pl.sketch_profile(pl.merge_sketches(pl.kept_sketches(spark, name)), few=16)
    # Sketches of so few distinct values have not begun to estimate.
    return advice.select(
        "column_name", "rows", "filled", "max_length", "width", "few_values",
        F.when(F.col("few_values"), F.col("distinct_values")).alias("values_if_few"),
    )


def q_constraint_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn(
        "l_returnflag", F.nullif(F.col("l_returnflag"), F.lit("R"))
    )
    documents = table(spark, sf_dir, "documents")
    return pl.constraint_violations(
        lines, keys=["l_orderkey", "l_linenumber"], not_null=["l_returnflag"]
    ).unionByName(pl.constraint_violations(documents, widths={"text": 256, "lang": 2}))


# --- keyed writes ---------------------------------------------------------------------

#: Where an order comes from, the second part of a key: tables with more than a million orders have the numbers that
#: ``_incoming`` gives to added ones, and the SQL keeps both.
ORIGIN = "origin"


def _present(orders: DataFrame) -> DataFrame:
    return orders.withColumn(ORIGIN, F.lit(0))


def _incoming(orders: DataFrame) -> DataFrame:
    changed = orders.where(F.col("o_orderkey") % 5 == 0).withColumn("o_totalprice", F.lit(0.0))
    added = orders.where(F.col("o_orderkey") < 10).withColumn(
        "o_orderkey", F.col("o_orderkey") + 1_000_000
    )
    if ORIGIN in orders.columns:
        added = added.withColumn(ORIGIN, F.lit(1))
    return changed.unionByName(added)


def q_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _present(table(spark, sf_dir, "orders"))
    return pl.upsert(orders, _incoming(orders), ["o_orderkey", ORIGIN]).drop(ORIGIN)


def q_upsert_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An upsert that reads and writes one partition of its table."""
    name = fresh("by_status")
    orders = table(spark, sf_dir, "orders")
    pl.run_sql(
        spark,
        f"""
        CREATE TABLE {name} (
            o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ,
            o_orderpriority STRING, o_orderstatus STRING)
        USING parquet PARTITIONED BY (o_orderstatus) LOCATION '{pl.scratch_path(spark, name)}'
        """,
    )
    pl.write_table(orders, name, "append")
    incoming = _incoming(orders.where(F.col("o_orderstatus") == "F"))
    pl.upsert_table(incoming, name, ["o_orderstatus", "o_orderkey"])
    return spark.table(name)


def q_upsert_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An upsert into a table of plain files, of which it rewrites those that hold a changed row."""
    name = fresh("plain")
    orders = _present(table(spark, sf_dir, "orders"))
    pl.write_table(orders, name, path=pl.scratch_path(spark, name))
    pl.upsert_table(_incoming(orders), name, ["o_orderkey", ORIGIN])
    return spark.table(name).drop(ORIGIN)


def q_latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.latest_by_key(table(spark, sf_dir, "events"), ["user_id"], order_by=["ts", "event_id"])


def q_create_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = fresh("customers")
    definition = pl.TableDef(
        columns=(
            pl.ColumnDef("c_custkey", "BIGINT", nullable=False),
            pl.ColumnDef("c_name", "VARCHAR(32)"),
            pl.ColumnDef("c_nationkey", "INT"),
            pl.ColumnDef("c_acctbal", "DOUBLE"),
            pl.ColumnDef("c_mktsegment", "VARCHAR(16)"),
        ),
        primary_key=("c_custkey",),
    )
    customers = table(spark, sf_dir, "customer")
    pl.check_constraints(customers, definition)
    for _ in range(2):
        pl.create_or_replace(spark, name, definition, pl.scratch_path(spark, name))
        pl.write_table(customers, name, "append")
    return spark.table(name)


def q_sharded_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = fresh("sharded")
    rows = keyed(spark, sf_dir, 3)
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pl.write_sharded(rows, name, KEY_NAME, shards, path=pl.scratch_path(spark, name))
    return spark.table(name)


# --- jobs -----------------------------------------------------------------------------


def q_load_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.places_frame(places(spark, sf_dir))


def _places_source(spark: SparkSession, sf_dir: str) -> str:
    path = pl.scratch_path(spark, "places")
    places(spark, sf_dir).write.parquet(path)
    return path


def q_load_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship job end to end, its settings taken from the Spark configuration."""
    name = fresh("places")
    prefix = f"spark.placeload.{name}."
    settings = {
        "source": _places_source(spark, sf_dir),
        "dest_table": name,
        "path": pl.scratch_path(spark, name),
        "shards": spark.conf.get("spark.sql.shuffle.partitions"),
    }
    for key, value in settings.items():
        spark.conf.set(prefix + key, value)
    try:
        config = pl.LoadConfig.from_spark(spark, prefix)
    finally:
        for key in settings:
            spark.conf.unset(prefix + key)
    for _ in range(2):  # The second run truncates what the first has loaded.
        pl.load_places(spark, config)
    return spark.table(name)


def q_load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load of half the rows and one of all of them."""
    name, source = fresh("reported"), _places_source(spark, sf_dir)
    config = pl.LoadConfig(
        source=source,
        dest_table=name,
        limit=spark.read.parquet(source).count() // 2,
        path=pl.scratch_path(spark, name),
    )
    capped = pl.load_places(spark, config)
    whole = pl.load_places(
        spark, pl.LoadConfig(source=config.source, dest_table=name, path=config.path)
    )
    return (
        capped.to_frame(spark)
        .select(F.lit("capped").alias("load"), "rows_in", "rows_out", F.lit(None).alias("null_keys"))
        .unionByName(
            whole.to_frame(spark).select(
                F.lit("whole").alias("load"), "rows_in", "rows_out", "null_keys"
            )
        )
    )


def q_load_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two flat loads into one table, the second updating and adding by key."""
    name = fresh("flat")
    rows = _present(flat_places(spark, sf_dir))
    for part, source in enumerate((rows, _incoming(rows))):
        path = pl.scratch_path(spark, f"flat-{part}")
        source.write.parquet(path)
        config = pl.LoadConfig(source=path, dest_table=name, path=pl.scratch_path(spark, name))
        pl.load_flat(spark, config, keys=["o_orderkey", ORIGIN])
    return spark.table(name).drop(ORIGIN)


def q_load_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load repeated: the second run finds nothing new, the third just a file that came late."""
    name, ledger = fresh("ledgered"), fresh("ledger")
    source, rows = pl.scratch_path(spark, "daily"), places(spark, sf_dir)
    config = pl.LoadConfig(source=source, dest_table=name, path=pl.scratch_path(spark, name), ledger=ledger)
    late = F.pmod(F.xxhash64("placeIdentifier"), F.lit(3)) == 0
    for part in (rows.where(~late), None, rows.where(late)):
        if part is not None:
            part.write.mode("append").parquet(source)
        pl.load_places(spark, config, "append")
    return spark.table(name)


def q_box_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The places of a box across the 180th meridian, from a table whose files follow the curve."""
    name, rows = fresh("clustered"), flat_places(spark, sf_dir)
    pl.write_clustered(rows, name, FLAT_LATITUDE, FLAT_LONGITUDE, path=pl.scratch_path(spark, name))
    return pl.read_box(spark, name, pl.Box(-20.5, 150.25, 48.0, -100.0), FLAT_LATITUDE, FLAT_LONGITUDE)


def q_curve_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every place lies on the curve, of the coarsest cells."""
    cells = keyed(spark, sf_dir, 0)
    return cells.select("placeIdentifier", pl.curve_key(KEY_NAME).alias("curve_key"))


def q_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The steps by which the orders fit a table made for narrower, other and fewer columns."""
    orders = table(spark, sf_dir, "orders")
    made_for = "o_orderkey INT, o_custkey DECIMAL(20,0), o_totalprice DOUBLE, o_orderstatus STRING, o_orderdate DATE, note STRING"
    return pl.drift_frame(spark, pl.drift(orders.schema, T.StructType.fromDDL(made_for)))


def q_widened_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of narrow columns that takes the orders after it was widened and got a column."""
    name = fresh("widened")
    orders = table(spark, sf_dir, "orders")
    narrow = orders.where("o_orderkey < 100").select(F.col("o_orderkey").cast("int").alias("o_orderkey"), "o_custkey", "o_orderstatus")
    pl.write_table(narrow, name, path=pl.scratch_path(spark, name))
    rows = orders.where("o_orderkey >= 100").select("o_orderkey", "o_orderstatus", "o_totalprice")
    pl.write_table(pl.apply_drift(rows, name), name, "append")
    return spark.table(name)


# --- JDBC -----------------------------------------------------------------------------


def jdbc_target(spark: SparkSession, name: str) -> pl.JdbcTarget:
    """The database named by ``spark.placeload.check.jdbc_url``.

    A local session without it uses the embedded database that Spark ships, in memory.
    Only its own process sees that one, so on a cluster these queries need the setting.
    """
    table_name = fresh(name).upper()
    url = spark.conf.get("spark.placeload.check.jdbc_url", None)
    if url:
        return pl.JdbcTarget(url, table_name)
    if not is_local(spark):
        raise RuntimeError(
            "set spark.placeload.check.jdbc_url to a database all executors can reach"
        )
    return pl.JdbcTarget(
        "jdbc:derby:memory:placeload;create=true",
        table_name,
        driver="org.apache.derby.iapi.jdbc.AutoloadedDriver",
    )


def q_jdbc_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = jdbc_target(spark, "orders")
    orders = table(spark, sf_dir, "orders")
    pl.write_jdbc(orders, target, "overwrite_create", {"o_orderpriority": 16, "o_orderstatus": 1})
    pl.write_jdbc(orders, target, "overwrite_truncate")
    return pl.read_jdbc(spark, target, "o_orderkey")


def q_jdbc_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = jdbc_target(spark, "orders")
    orders = table(spark, sf_dir, "orders")
    for _ in range(2):
        pl.write_jdbc(orders, target, "append", {"o_orderpriority": 16, "o_orderstatus": 1})
    return pl.read_jdbc(spark, target, "o_orderkey")


def q_jdbc_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = jdbc_target(spark, "orders")
    orders = table(spark, sf_dir, "orders")
    pl.write_jdbc(orders, target, "append", {"o_orderpriority": 16, "o_orderstatus": 1})
    pl.upsert_jdbc(_incoming(orders), target, ["o_orderkey"], partition_column="o_orderkey")
    return pl.read_jdbc(spark, target, "o_orderkey")


def q_jdbc_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table published, replaced as a whole in one transaction, then exchanged for a new one."""
    target = jdbc_target(spark, "orders")
    orders, types = table(spark, sf_dir, "orders"), {"o_orderpriority": "VARCHAR(16)", "o_orderstatus": "VARCHAR(1)"}
    pl.publish(orders.where("o_orderkey < 10"), target, False, types=types)
    pl.publish(orders.where("o_orderkey >= 10"), target, True)
    pl.apply_changes(orders.where("o_orderkey < 20"), target, ["o_orderkey"], how="replace")
    kept = pl.materialize(pl.read_jdbc(spark, target, "o_orderkey"), "published")
    pl.swap(kept.withColumn("o_totalprice", F.col("o_totalprice") * 2), target, types=types)
    return pl.read_jdbc(spark, target, "o_orderkey")


def q_jdbc_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column types of a table created with widths from a profile of its rows."""
    target = jdbc_target(spark, "part")
    part = table(spark, sf_dir, "part")
    pl.write_jdbc(part, target, "overwrite_create", pl.column_types(pl.width_profile(part)))
    pl.write_jdbc(part, target, "overwrite_truncate")
    return _described(spark, target)


def q_schema_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = jdbc_target(spark, "orders")
    pl.write_jdbc(table(spark, sf_dir, "orders"), target, "append")
    return _described(spark, target)


def _described(spark: SparkSession, target: pl.JdbcTarget) -> DataFrame:
    fields = pl.target_schema(spark, target).fields
    rows = [
        (f.name, f.metadata.get("__CHAR_VARCHAR_TYPE_STRING", f.dataType.simpleString()))
        for f in fields
    ]
    return spark.createDataFrame(rows, "column_name string, column_type string")


# --- SQL ------------------------------------------------------------------------------


def q_run_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fresh("orders")
    table(spark, sf_dir, "orders").createOrReplaceTempView(orders)
    return pl.run_sql(
        spark,
        """
        SELECT o_orderpriority AS priority, count(*) AS orders
        FROM IDENTIFIER(:orders)
        WHERE o_orderstatus = :status
        GROUP BY o_orderpriority;
        """,
        {"orders": orders, "status": "F"},
    )


def q_sql_script(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, found = fresh("orders"), fresh("found")
    table(spark, sf_dir, "orders").createOrReplaceTempView(orders)
    return pl.run_script(
        spark,
        f"""
        SELECT 1;
        SELECT :ds;
        CREATE TEMPORARY VIEW {found} AS
            SELECT o_custkey, o_orderdate FROM {orders} WHERE o_orderstatus = 'O';
        SELECT o_custkey AS customer, count(*) AS orders, max(:ds) AS run_date
        FROM {found} GROUP BY o_custkey;
        """,
        {"ds": "2023-03-14"},
    )


def q_sql_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = fresh("schema")
    pl.run_sql(spark, "CREATE SCHEMA IDENTIFIER(:schema)", {"schema": schema})
    pl.write_table(
        table(spark, sf_dir, "orders"), f"{schema}.loaded", path=pl.scratch_path(spark, schema)
    )
    return pl.run_sql(
        spark,
        """
        SELECT o_orderkey AS order_key, o_orderdate AS order_date
        FROM IDENTIFIER(:schema || '.loaded')
        WHERE o_orderdate >= CAST(:ds AS TIMESTAMP_NTZ)
        """,
        {"schema": schema, "ds": "1996-01-01"},
    )


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: value for name, value in globals().items() if name.startswith("q_")}
