import pytest

import load
from conftest import rows


@pytest.fixture
def settings(spark, name, tmp_path):
    spark.sql(
        """SELECT id, CAST(id AS DOUBLE) AS geocodes_mainEntry_latitude,
           CAST(id AS DOUBLE) AS geocodes_mainEntry_longitude,
           struct(struct(CAST(id AS DOUBLE) AS latitude, CAST(id AS DOUBLE) AS longitude) AS mainEntry) AS geocodes
           FROM range(10)"""
    ).write.parquet(str(tmp_path / "s"))
    values = {"source": str(tmp_path / "s"), "dest_table": name}
    for key, value in values.items():
        spark.conf.set(f"spark.placeload.{key}", value)
    yield name
    for key in values:
        spark.conf.unset(f"spark.placeload.{key}")


def test_places(spark, settings, capsys):
    load.main(["places"])
    load.main(["places", "--mode", "append"])
    assert spark.table(settings).count() == 20
    assert "rows_in=10, rows_out=10" in capsys.readouterr().out


def test_flat(spark, settings):
    load.main(["flat"])
    load.main(["flat", "--keys", "id"])
    assert spark.table(settings).count() == 10
    load.main(["flat"])
    load.main(["flat", "--keys", "id", "--order-by", "id"])
    assert spark.table(settings).distinct().count() == 10


def test_definition_of_the_created_table(spark, settings):
    ddl = "id BIGINT NOT NULL, geocodes_mainEntry_latitude DOUBLE, geocodes_mainEntry_longitude DOUBLE, geocodes STRING"
    load.main(["flat", "--keys", "id", "--columns", ddl.replace("geocodes STRING", "geocodes STRUCT<mainEntry: STRUCT<latitude: DOUBLE, longitude: DOUBLE>>, cell_key DECIMAL(20,0)")])
    assert spark.table(settings).count() == 10 and dict(spark.table(settings).dtypes)["cell_key"] == "decimal(20,0)"


def test_sql_file(spark, name, tmp_path, capsys):
    (tmp_path / "s.sql").write_text(
        "CREATE TABLE IDENTIFIER(:t) (d STRING) USING parquet;\n"
        "INSERT INTO IDENTIFIER(:t) VALUES (:ds);\nSELECT * FROM IDENTIFIER(:t);\n"
    )
    load.main(["sql", str(tmp_path / "s.sql"), "--arg", f"t={name}", "--arg", "ds=2023-03-14"])
    assert rows(spark.table(name)) == [("2023-03-14",)]
    assert "|2023-03-14|" in capsys.readouterr().out


def test_sql_file_runs_its_last_query_in_full(spark, tmp_path):
    (tmp_path / "f.sql").write_text("SELECT IF(id = 1000, raise_error('late'), id) FROM range(0, 2000, 1, 1)")
    with pytest.raises(Exception, match="late"):
        load.main(["sql", str(tmp_path / "f.sql")])


@pytest.mark.parametrize("argv", [[], ["other"], ["sql"], ["sql", "f", "--arg", "x"], ["places", "--mode", "x"]])
def test_bad_arguments(argv):
    with pytest.raises(SystemExit):
        load.main(argv)
