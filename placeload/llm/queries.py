"""The operators' queries over the given tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeload.llm.common import table
from placeload.llm.exact_dedup import exact_dedup
from placeload.llm.hard_negatives import hard_negatives
from placeload.llm.language_id import identify
from placeload.llm.lexical_search import lexical_search
from placeload.llm.line_quality import line_quality
from placeload.llm.near_dedup import near_dedup
from placeload.llm.packing import pack, token_pieces
from placeload.llm.piece_sampling import sampled_segmentations
from placeload.llm.sharding import shard_rows
from placeload.llm.simhash import simhash_dedup
from placeload.llm.suffix_dedup import suffix_dedup
from placeload.llm.toxicity import score_toxicity
from placeload.llm.url_filter import filter_urls

#: Rules of the URL filter: action, host, path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampled_segmentations(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), RULES)


def op4_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("labels")


def op5_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shard_rows(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op6_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(token_pieces(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json")))


def op11_angular_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))


def op12_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def registered() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
