"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from placeload.storage import materialize

#: Code points that separate words, as a character class without its brackets.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(doc_id: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; NULL ids count as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % divisor


def located(docs: DataFrame, *columns: str | Column) -> DataFrame:
    """``columns`` with ``file`` and ``pos``: the row's place, the same in every reading.

    Rows that do not come straight from files are written to the shared folder first, since
    only then do they have a place that a lost executor cannot change.
    """
    rows = with_place(docs, *columns)
    return rows if rows is not None else with_place(materialize(docs.select(*columns), "located"), "*")


def with_place(docs: DataFrame, *columns: str | Column) -> DataFrame | None:
    """``columns`` with the row's place, or None for rows that do not come straight from files.

    The place is asked of the rows themselves, so a column of their own that is called ``_metadata`` does no harm.
    """
    try:
        place = docs.metadataColumn("_metadata")
        return docs.select(*columns, place["file_path"].alias("file"), place["row_index"].alias("pos"))
    except AnalysisException:
        return None


def placed(docs: DataFrame) -> DataFrame:
    """``docs``, read from files so that its rows have a place."""
    return docs if with_place(docs) is not None else materialize(docs, "documents")


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` (see ``placed``) with all its columns, less the rows at the places (file, pos) of ``gone``."""
    gone = gone.select("file", "pos").alias("gone")
    place = docs.metadataColumn("_metadata")
    at = [place["file_path"] == F.col("gone.file"), place["row_index"] == F.col("gone.pos")]
    return docs.join(gone, at, "left_anti")


def first_by(rows: DataFrame, group: str, most: int, *order: str | Column, parts: int = 64) -> DataFrame:
    """At most ``most`` rows of each value of ``group``, those that come first.

    Spark cuts the groups before it shuffles them; what is left of all tasks is cut in ``parts`` of a group
    before the last of it meets.
    """
    name, part = unused(rows, "rank"), unused(rows, "part")
    kept = rows.withColumn(part, F.pmod(F.xxhash64(*order), F.lit(parts)))
    for keys in ((group, part), (group,)):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        kept = kept.withColumn(name, rank).filter(F.col(name) <= most).drop(name)
    return kept.drop(part)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unused(docs: DataFrame, name: str) -> str:
    """``name``, or a longer one where ``docs`` has a column of that name already."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(rows: DataFrame, *order: str) -> tuple[DataFrame, int]:
    """``rows`` with ``row_number`` from 0 in the given order, and their count.

    Rows are dealt by range and sorted inside each part; only the parts' counts are collected.
    The place of a row breaks ties, so that a value which fills many parts is split.
    """
    spark = rows.sparkSession
    tie = F.monotonically_increasing_id().alias("tie")
    ranged = (
        rows.select("*", tie)
        .repartitionByRange(partitions(spark), *order, "tie")
        .sortWithinPartitions(*order, "tie")
        .withColumn("within", F.monotonically_increasing_id())
        .drop("tie")
    )
    stored = materialize(ranged, "numbered")
    part = F.shiftright("within", 33)
    counts = stored.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    starts, total = [], 0
    for part_id, n in counts:
        starts.append((part_id, total))
        total += n
    begin = spark.createDataFrame(starts, "part long, begin long")
    inside = F.col("within").bitwiseAND(F.lit((1 << 33) - 1))
    joined = stored.withColumn("part", part).join(begin, "part")
    return joined.withColumn("row_number", F.col("begin") + inside).drop("part", "within", "begin"), total


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers (the finalizer of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def uniform(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from 64-bit hashes."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def chunks(rows: Iterable, size: Callable, most: int) -> Iterator[list]:
    """Consecutive rows, together of about ``most`` in ``size``; a larger row stands alone."""
    held, total = [], 0
    for row in rows:
        if held and total + size(row) > most:
            yield held
            held, total = [], 0
        held.append(row)
        total += size(row)
    if held:
        yield held
