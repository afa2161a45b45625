from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from placeload import (
    ColumnDef,
    LoadConfig,
    TableDef,
    append_cell_key,
    create_or_replace,
    geo_cell,
    load_flat,
    load_places,
    places_frame,
    read_jdbc,
    scratch_path,
    target_schema,
    write_jdbc,
)
from placeload.plans.tables import PLACES

PLACE = """
    CAST(id AS STRING) placeIdentifier, concat('place ', id) name, CAST(NULL AS STRING) storeId,
    'some text' description, map('de', 'Ort') localizedNames, struct(0.5D AS score) realityScore,
    struct('s' AS street, CAST(NULL AS STRING) AS locality) address,
    struct(struct(if(id % 10 = 0, NULL, CAST(id % 90 AS DOUBLE)) AS latitude, CAST(id % 180 AS DOUBLE) AS longitude) AS mainEntry) geocodes,
    struct('1' AS phone) contactInfo, map('x', 'y') socialMediaInfo,
    struct(array(struct(1 AS day, '9' AS open)) AS hours) operationsInfo,
    array('a', 'b') categories, array('c') chains, CAST(NULL AS STRING) parent
"""


@pytest.fixture(scope="module")
def places(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("places") / "dt=2023-03-14")
    spark.sql(f"SELECT {PLACE} FROM range(0, 1000, 1, 6)").write.parquet(path)
    return path


@pytest.fixture(scope="module")
def flat(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("flat") / "f")
    spark.range(0, 100, 1, 3).selectExpr(
        "id", "CAST(id AS DOUBLE) / 2 AS geocodes_mainEntry_latitude",
        "CAST(id AS DOUBLE) AS geocodes_mainEntry_longitude", "DATE '2023-03-14' AS dt",
    ).write.parquet(path)
    return path


def jdbc_config(source, jdbc, **settings):
    return LoadConfig(source, jdbc.table, jdbc_url=jdbc.url, jdbc_driver=jdbc.driver, **settings)


def test_frame(spark, places):
    source = spark.read.parquet(places)
    df = places_frame(source)
    assert df.columns == ["cell_key", *source.columns]
    assert df.dtypes == [("cell_key", "bigint"), *[(c, "string") for c in source.columns]]
    row = df.where("placeIdentifier = '13'").first()
    assert row.geocodes == '{"mainEntry":{"latitude":13.0,"longitude":13.0}}'
    assert (row.address, row.categories, row.localizedNames) == ('{"street":"s"}', '["a","b"]', '{"de":"Ort"}')
    assert row.operationsInfo == '{"hours":[{"day":1,"open":"9"}]}' and row.storeId is None


def test_frames_do_not_share_state(spark, places):
    source = spark.read.parquet(places)
    assert places_frame(source).columns == places_frame(source).columns


def test_name_clash(spark, places, flat):
    for make, path in ((places_frame, places), (append_cell_key, flat)):
        source = spark.read.parquet(path).withColumn("CELL_KEY", F.lit(1))
        with pytest.raises(ValueError, match="cell_key"):
            make(source)
        assert "other" in make(source, key_name="other").columns


def test_load_into_a_table(spark, places, name):
    config = LoadConfig(places, name, path=scratch_path(spark, name))
    for _ in range(2):
        report = load_places(spark, config)
        assert (report.rows_in, report.rows_out, report.null_keys) == (1000, 1000, 100)
        assert report.seconds > 0
    assert rows(spark.table(name)) == rows(places_frame(spark.read.parquet(places)))


def test_load_into_a_defined_table(spark, places, name):
    create_or_replace(spark, name, PLACES, scratch_path(spark, name))
    load_places(spark, LoadConfig(places, name))
    assert spark.table(name).count() == 1000
    assert spark.table(name).schema["name"].metadata["__CHAR_VARCHAR_TYPE_STRING"] == "varchar(128)"


def varchars(schema):
    key = "__CHAR_VARCHAR_TYPE_STRING"
    return {f.name: f.metadata[key] for f in schema if key in f.metadata}


WIDTHS = {column: f"varchar({width})" for column, width in PLACES.widths.items()}


@pytest.mark.parametrize("mode", ["overwrite_truncate", "append", "overwrite_create"])
def test_created_table_has_the_defined_widths(spark, places, name, mode):
    load_places(spark, LoadConfig(places, name, path=scratch_path(spark, name)), mode, PLACES)
    assert varchars(spark.table(name).schema) == WIDTHS and spark.table(name).count() == 1000


@pytest.mark.parametrize("mode", ["overwrite_truncate", "append", "overwrite_create"])
def test_created_jdbc_table_has_the_defined_widths(spark, places, jdbc, mode, tmp_path):
    # Spark binds a NULL text as CLOB here, which this database refuses for a VARCHAR.
    filled = spark.read.parquet(places).na.fill("", ["storeId", "parent"])
    filled.write.parquet(str(tmp_path / "filled"))
    report = load_places(spark, jdbc_config(str(tmp_path / "filled"), jdbc), mode, PLACES)
    assert report.rows_out == 1000 and varchars(target_schema(spark, jdbc)) == WIDTHS


def test_recreated_destination(spark, places, name):
    config = LoadConfig(places, name)
    load_places(spark, config)
    assert not varchars(spark.table(name).schema)
    load_places(spark, config, "overwrite_create", PLACES)
    assert varchars(spark.table(name).schema) and spark.table(name).count() == 1000
    load_places(spark, config, "overwrite_truncate", PLACES)
    assert varchars(spark.table(name).schema) and spark.table(name).count() == 1000


def test_sharded_load(spark, places, name):
    report = load_places(spark, LoadConfig(places, name, shards=4, path=scratch_path(spark, name)))
    assert (report.rows_in, report.rows_out, report.null_keys) == (1000, 1000, 100)
    assert spark.table(name).count() == 1000


@pytest.mark.parametrize("limit, kept", [(0, 0), (10, 10), (1000, 1000), (5000, 1000)])
def test_limited_load(spark, places, name, limit, kept):
    report = load_places(spark, LoadConfig(places, name, limit=limit, path=scratch_path(spark, name)))
    assert (report.rows_in, report.rows_out) == (1000, kept) and spark.table(name).count() == kept


@pytest.mark.parametrize("shards", [None, 6])
def test_load_over_jdbc(spark, places, jdbc, shards):
    config = jdbc_config(places, jdbc, shards=shards, num_partitions=2)
    for _ in range(2):
        report = load_places(spark, config)
        assert (report.rows_in, report.rows_out, report.null_keys) == (1000, 1000, 100)
    assert rows(read_jdbc(spark, jdbc)) == rows(places_frame(spark.read.parquet(places)))
    assert target_schema(spark, jdbc).names[0] == "cell_key"


def test_load_over_jdbc_without_a_writer_cap(spark, flat, jdbc):
    config = jdbc_config(flat, jdbc, num_partitions=None)
    for _ in range(2):
        report = load_flat(spark, config, keys=["id"])
        assert (report.rows_in, report.rows_out, report.null_keys) == (100, 100, 0)
    assert read_jdbc(spark, jdbc).count() == 100


def test_rows_stored_twice_are_noticed(spark, places, jdbc, monkeypatch):
    from placeload.plans import jobs

    def write_twice(df, target, mode, **settings):
        write_jdbc(df, target, mode, **settings)
        write_jdbc(df.limit(5), target, "append", **settings)

    monkeypatch.setattr(jobs, "write_jdbc", write_twice)
    with pytest.raises(RuntimeError, match="1005 rows after 1000"):
        load_places(spark, jdbc_config(places, jdbc))


@pytest.mark.parametrize("shards", [None, 4])
def test_empty_source(spark, places, flat, name, jdbc, tmp_path, shards):
    spark.read.parquet(places).limit(0).write.parquet(str(tmp_path / "e"))
    spark.read.parquet(flat).where("id < 0").write.parquet(str(tmp_path / "f"))
    nested = LoadConfig(str(tmp_path / "e"), name, shards=shards)
    over_jdbc = replace(jdbc_config(nested.source, jdbc), shards=shards)
    again = LoadConfig(str(tmp_path / "f"), f"{name}_flat", shards=shards)
    for report in (
        load_places(spark, nested),
        load_places(spark, over_jdbc),
        load_places(spark, replace(nested, source=places, limit=0)),
        load_flat(spark, again, keys=["id"]),
        load_flat(spark, again, keys=["id"]),
    ):
        assert (report.rows_out, report.null_keys) == (0, 0)


def test_resolution(spark, places, name):
    load_places(spark, LoadConfig(places, name, resolution=0))
    assert spark.table(name).agg(F.max("cell_key")).first()[0] < 4 * 2**58


def test_flat_load_appends(spark, flat, name):
    for n in (1, 2):
        report = load_flat(spark, LoadConfig(flat, name))
        assert (report.rows_in, report.rows_out, report.null_keys) == (100, 100, 0)
        assert spark.table(name).count() == 100 * n
    assert spark.table(name).dtypes[-2:] == [("dt", "date"), ("cell_key", "bigint")]
    key = geo_cell("geocodes_mainEntry_latitude", "geocodes_mainEntry_longitude", 6)
    assert spark.table(name).where(F.col("cell_key") != key).count() == 0


@pytest.mark.parametrize("sink", ["table", "jdbc"])
def test_flat_load_updates(spark, flat, name, jdbc, sink, tmp_path):
    changed = str(tmp_path / "changed")
    spark.read.parquet(flat).where("id >= 90").union(
        spark.read.parquet(flat).where("id < 10").withColumn("id", F.col("id") + 100)
    ).withColumn("dt", F.lit("2024-01-01").cast("date")).write.parquet(changed)
    config = LoadConfig(flat, name) if sink == "table" else jdbc_config(flat, jdbc)
    first = load_flat(spark, config, keys=["id"])
    second = load_flat(spark, replace(config, source=changed), keys=["id"])
    assert (first.rows_in, first.rows_out) == (100, 100)
    assert (second.rows_in, second.rows_out) == (20, 110)
    loaded = spark.table(name) if sink == "table" else read_jdbc(spark, jdbc)
    assert loaded.count() == 110 and loaded.where("dt = DATE '2024-01-01'").count() == 20


@pytest.mark.parametrize("limit", [None, 30])
def test_rows_in_counts_before_limit_and_duplicates(spark, flat, name, limit, tmp_path):
    source = str(tmp_path / "twice")
    spark.read.parquet(flat).withColumn("id", F.col("id") % 40).write.parquet(source)
    config = LoadConfig(source, name, limit=limit)
    for _ in range(2):
        report = load_flat(spark, config, keys=["id"], order_by=["geocodes_mainEntry_latitude"])
        assert report.rows_in == 100 and report.rows_out >= 30
    if limit is None:
        kept = spark.table(name).agg(F.count("*"), F.min("geocodes_mainEntry_latitude")).first()
        assert report.rows_out == 40 and kept == (40, 30.0)
    assert load_flat(spark, config).rows_in == 100


@pytest.mark.parametrize("sink", ["table", "jdbc"])
def test_definition_types_and_not_null(spark, flat, name, jdbc, sink):
    columns = (ColumnDef("id", "BIGINT", False), ColumnDef("geocodes_mainEntry_latitude", "DOUBLE", False),
               ColumnDef("geocodes_mainEntry_longitude", "DECIMAL(9,2)"), ColumnDef("dt", "DATE"), ColumnDef("cell_key", "BIGINT"))
    config = LoadConfig(flat, name) if sink == "table" else jdbc_config(flat, jdbc)
    load_flat(spark, config, table=TableDef(columns))
    schema = spark.table(name).schema if sink == "table" else target_schema(spark, jdbc)
    assert schema["geocodes_mainEntry_longitude"].dataType.simpleString() == "decimal(9,2)"
    with pytest.raises(Exception, match="NULL in column cell_key"):
        bad = TableDef(tuple(replace(c, nullable=c.name != "cell_key") for c in columns))
        load_flat(spark, replace(config, source=_without_places(spark, flat)), table=bad)


def _without_places(spark, flat):
    path = scratch_path(spark, "nowhere")
    nothing = F.lit(None).cast("double")
    spark.read.parquet(flat).withColumn("geocodes_mainEntry_latitude", nothing).write.parquet(path)
    return path


def test_load_plan_has_one_scan_and_no_shuffle_or_python(spark, places):
    text = plan(places_frame(spark.read.parquet(places)))
    assert text.count("FileScan") == 1 and "Exchange" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_key_alone_reads_only_the_coordinates(spark, places):
    text = plan(spark.read.parquet(places).select(geo_cell("geocodes.mainEntry.latitude", "geocodes.mainEntry.longitude")))
    assert "ReadSchema: struct<geocodes:struct<mainEntry:struct<latitude:double,longitude:double>>>" in text


def test_load_is_one_job(spark, places, name):
    tracker, config = spark.sparkContext.statusTracker(), LoadConfig(places, name)
    rows_read = spark.read.parquet(places).rdd.getNumPartitions()
    spark.sparkContext.setJobGroup(name, "load")
    try:
        load_places(spark, config)
        stages = [
            tracker.getStageInfo(stage).numTasks
            for job in tracker.getJobIdsForGroup(name)
            for stage in tracker.getJobInfo(job).stageIds
        ]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # The schema of the source from one footer, then all its partitions once.
    assert sorted(stages) == sorted([1, rows_read])


def test_upsert_reads_jdbc_in_ranges(spark):
    from placeload.plans.jobs import _range_column

    df = spark.createDataFrame([], "id long, code string, day date, cell_key long")
    assert _range_column(df, ["code", "id"]) == "id"
    assert _range_column(df, ["day"]) == "day"
    assert _range_column(df, ["code"]) == "cell_key"
