"""Profiles that add up: sketches of the text columns of each load, merged instead of a new scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeload.functions.nested import is_text, quoted
from placeload.operators.quality import WIDTH_CLASSES
from placeload.operators.upsert import latest_by_key
from placeload.sources.tables import write_table

#: Registers of a sketch of distinct values, as a power of two: its standard error is 1.04 / sqrt(2 ** 12), 1.6 %.
DISTINCT_BITS = 12
#: Size of a sketch of lengths: a rank is off by at most 1.65 % of the values, with 99 % confidence.
RANK_SIZE = 200


def width_sketches(df: DataFrame) -> DataFrame:
    """One row per text column: what ``merge_sketches`` can add up and ``sketch_profile`` reads.

    Columns: ``column_name``, ``rows``, ``filled`` (values that are not NULL), ``max_length``, and sketches of the
    distinct values and of the lengths, NULL where nothing is filled. One aggregation over all columns, combined
    before its only, one-row shuffle; a sketch is a few kilobytes whatever the number of rows.
    """
    names = [f.name for f in df.schema if is_text(f)]
    if not names:
        raise ValueError("no text column to profile")
    found = []
    for name in names:
        value = F.col(quoted(name)).cast("string")
        filled, length = F.count(value), F.length(value)
        found.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.count(F.lit(1)).alias("rows"),
                filled.alias("filled"),
                F.max(length).alias("max_length"),
                # By their hash, as the sketch passes over an empty text.
                F.when(filled > 0, F.hll_sketch_agg(F.when(value.isNotNull(), F.xxhash64(value)), DISTINCT_BITS)).alias("distinct_sketch"),
                F.when(filled > 0, F.kll_sketch_agg_bigint(length.cast("long"), RANK_SIZE)).alias("length_sketch"),
            )
        )
    return df.agg(F.array(*found).alias("found")).select(F.inline("found"))


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """The sketches of all parts as those of the whole, one row per column name.

    Counts and greatest lengths are exact. A part without a value of a column adds only its rows.
    """
    merged = sketches.groupBy("column_name").agg(
        F.sum("rows").alias("rows"),
        F.sum("filled").alias("filled"),
        F.max("max_length").alias("max_length"),
        F.expr("hll_union_agg(distinct_sketch) FILTER (WHERE filled > 0)").alias("distinct_sketch"),
        F.expr("kll_merge_agg_bigint(length_sketch) FILTER (WHERE filled > 0)").alias("length_sketch"),
    )
    for sketch in ("distinct_sketch", "length_sketch"):
        merged = merged.withColumn(sketch, F.when(F.col("filled") > 0, F.col(sketch)))
    return merged


def sketch_profile(sketches: DataFrame, few: int = 256) -> DataFrame:
    """Width advice read from sketches, in no scan of the data.

    Columns: ``column_name``, ``rows``, ``filled``, ``max_length``, ``width`` (the narrowest VARCHAR that holds it, NULL if
    beyond the widest class) as ``width_profile`` gives them, exact; ``distinct_values`` (estimate, 0 where nothing is filled),
    ``few_values`` (at most ``few`` of them, so a dictionary serves), ``median_length`` and ``p99_length`` (estimates, NULL where
    nothing is filled). ``column_types`` takes the result.
    """
    fits = [F.when(F.coalesce("max_length", F.lit(0)) <= w, F.lit(w)) for w in WIDTH_CLASSES]
    distinct = F.when(F.col("filled") > 0, F.hll_sketch_estimate("distinct_sketch")).otherwise(F.lit(0))
    at = {"median_length": 0.5, "p99_length": 0.99}
    lengths = [
        F.when(F.col("filled") > 0, F.kll_sketch_get_quantile_bigint("length_sketch", F.lit(rank))).alias(name)
        for name, rank in at.items()
    ]
    return sketches.select(
        "column_name",
        "rows",
        "filled",
        "max_length",
        F.coalesce(*fits).alias("width"),
        distinct.alias("distinct_values"),
        (distinct <= few).alias("few_values"),
        *lengths,
    )


def keep_sketches(df: DataFrame, table: str, load: str, path: str | None = None) -> None:
    """Append the sketches of one load to the catalog table of them, made if absent.

    ``load`` names the load. One that is profiled again, because it ran again, counts once: ``kept_sketches`` takes the
    latest of each name.
    """
    taken = width_sketches(df).select(F.lit(load).alias("load"), F.current_timestamp().alias("taken"), "*")
    write_table(taken.coalesce(1), table, "append", path)


def kept_sketches(spark: SparkSession, table: str) -> DataFrame:
    """The sketches of every load, the latest where a load has several: rows for ``merge_sketches``."""
    kept = spark.table(table)
    names = [c for c in kept.columns if c not in ("load", "taken")]
    return latest_by_key(kept, ["load", "column_name"], ["taken"]).select("load", *names)
