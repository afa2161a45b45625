"""SQL text with bound parameters."""

from __future__ import annotations

import logging
import re
import time
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

LOG = logging.getLogger(__name__)

# A statement goes up to a ";" that is in no literal, quoted name or comment.
COMMENT = r"--[^\n]*|/\*.*?\*/"
STATEMENT = re.compile(
    rf"""(?:'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`|{COMMENT}|[^;])+""", re.DOTALL
)


def run_sql(spark: SparkSession, text: str, args: Mapping[str, Any] | None = None) -> DataFrame:
    """Run one statement; a failure raises, for a query when its rows are used.

    Values go in as ``:name``, table and schema names as ``IDENTIFIER(:name)``. They are
    bound, never pasted into the text.
    """
    started = time.monotonic()
    result = spark.sql(text, args=dict(args) if args else None)
    # A query has only been planned by now; run_in_full logs its rows.
    if not result.columns:
        LOG.info("%.1f s for: %s", time.monotonic() - started, text.strip())
    return result


def run_in_full(result: DataFrame, text: str = "") -> int:
    """Run a query to its last row and log rows and seconds; the rows go nowhere."""
    seen, started = Observation(), time.monotonic()
    result.observe(seen, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
    rows = seen.get["rows"]
    LOG.info("%d rows in %.1f s for: %s", rows, time.monotonic() - started, text.strip())
    return rows


def run_script(spark: SparkSession, text: str, args: Mapping[str, Any] | None = None) -> DataFrame:
    """Run statements separated by ``;`` in order; the first that fails raises.

    The last result is returned, unless a query not yet run: it may be large. Queries before
    it run in full and their rows are discarded. Spark's own ``BEGIN ... END`` block is not
    used since it collects every result; pass such a block to ``run_sql``.
    """
    parts = STATEMENT.findall(text)
    statements = [p for p in parts if re.sub(COMMENT, "", p, flags=re.DOTALL).strip()]
    if not statements:
        raise ValueError("the script has no statement")
    for statement in statements[:-1]:
        result = run_sql(spark, statement, args)
        if result.columns:
            run_in_full(result, statement)
    return run_sql(spark, statements[-1], args)
