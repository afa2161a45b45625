from __future__ import annotations

import contextlib
import io
import sys
import uuid
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from placeload import JdbcTarget  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("session")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("placeload-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.maxMetadataStringLength", "1000")
        .config("spark.sql.warehouse.dir", str(work / "warehouse"))
        .config("spark.checkpoint.dir", str(work / "shared"))
        .config("spark.driver.extraJavaOptions", f"-Dderby.stream.error.file={work}/derby.log")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def jdbc(spark):
    """A table name nobody used yet in the database embedded in this process."""
    return JdbcTarget(
        "jdbc:derby:memory:tests;create=true",
        f"T_{uuid.uuid4().hex}".upper(),
        driver="org.apache.derby.iapi.jdbc.AutoloadedDriver",
    )


@pytest.fixture
def name():
    return f"t_{uuid.uuid4().hex}"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df) -> str:
    """The physical plan as ``explain`` prints it."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()
