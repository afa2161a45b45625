"""What a load did, measured while it ran."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from placeload.functions.nested import quoted

SCHEMA = "rows_in long, rows_out long, null_keys long, seconds double"


@dataclass(frozen=True)
class LoadReport:
    rows_in: int
    rows_out: int
    null_keys: int
    seconds: float

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([asdict(self)], SCHEMA)


def observed_write(
    df: DataFrame, key: str, write: Callable[[DataFrame], None], rows_in: int | None = None
) -> LoadReport:
    """Run ``write(df)`` and report on the rows that passed, without a second scan.

    ``rows_in`` is the size of the source where it differs from the rows written. Counts
    are taken in the stage of ``df``'s last operator: make that the stage that writes, since
    an earlier one may run some of its tasks again when an executor is lost.
    """
    seen = Observation()
    started = time.monotonic()
    write(
        df.observe(
            seen,
            F.count(F.lit(1)).alias("rows_out"),
            F.count_if(F.col(quoted(key)).isNull()).alias("null_keys"),
        )
    )
    seconds = time.monotonic() - started
    rows_out = seen.get["rows_out"]
    return LoadReport(
        rows_in=rows_out if rows_in is None else rows_in,
        rows_out=rows_out,
        null_keys=seen.get["null_keys"],
        seconds=seconds,
    )
