"""URL filter by hash prefixes, in the way of safe-browsing lists.

Every distinct URL is expanded into host suffixes and path prefixes; an expression's digest
is SHA-256 of host and path. Only the first bytes of the digests and the URL's number are joined with the
first bytes of the rules' digests. What meets there is written as candidates; then the full digests
confirm, and the longest rule decides (then the longer host, then block before allow).
Expressions deeper than the deepest rule cannot match and are not made; that is no cap, since
the depth is read from the rules.

Defined results: without ``://`` or for a NULL URL host and path are empty and no rule fits;
a URL no rule fits gets ``default``; equal URLs get equal verdicts; ids may repeat or be NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeload.storage import materialize

LETTERS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (letters A to Z lowered) and path, without user, query or fragment being looked at."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, *LETTERS), path


def expression_digest(host: Column, path: Column) -> Column:
    """Host and path with a separator neither can hold, as SHA-256."""
    return F.unhex(F.sha2(F.concat(host, F.lit("?"), path), 256))


def folder(path: Column) -> Column:
    """The path up to its last slash: the part that lies on a prefix boundary."""
    return F.regexp_extract(path, r"^(.*/)?", 0)


def host_suffix(n: str) -> Column:
    """The last ``n`` labels of ``host``; ``n`` is a number or column in SQL."""
    return F.expr(f"array_join(reverse(slice(reverse(split(host, '[.]')), 1, {n})), '.')")


def path_prefix(n: str) -> Column:
    """``path`` up to its ``n``-th slash."""
    return F.expr(f"IF({n} = 0, '', concat(array_join(slice(split(path, '/'), 1, {n}), '/'), '/'))")


def verdicts(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]],
    default: str = "allow",
    prefix_bytes: int = 4,
    url: str = "url",
) -> DataFrame:
    """Per distinct ``url``: host, path, rule, verdict. ``rules`` are (allow or block, host, path)."""
    spark = pages.sparkSession
    listed = spark.createDataFrame(list(rules), "action string, rule_host string, rule_path string").select(
        F.translate("rule_host", *LETTERS).alias("rule_host"),
        "rule_path",
        "action",
        F.size(F.split("rule_host", r"\.")).alias("labels"),
        (F.length("rule_path") - F.length(F.translate("rule_path", "/", ""))).alias("slashes"),
        F.concat("rule_host", "rule_path").alias("rule_text"),
    )
    full = expression_digest(F.col("rule_host"), folder(F.col("rule_path")))
    listed = listed.withColumn("rule_digest", full).withColumn("prefix", F.substring("rule_digest", 1, prefix_bytes))
    # Written, so that Spark knows how many there are, and can split what is joined with one that very many URLs match.
    listed = materialize(listed, "rules")
    labels = max((host.count(".") + 1 for _, host, _ in rules), default=0)
    slashes = max((path.count("/") for _, _, path in rules), default=0)

    host, path = url_parts(F.col("url"))
    urls = pages.select(F.col(url).alias("url")).distinct()
    urls = urls.select("url", host.alias("host"), path.alias("path"))
    urls = materialize(urls.withColumn("key", F.monotonically_increasing_id()), "urls")
    candidates = materialize(prefix_hits(urls, listed, labels, slashes, prefix_bytes), "candidates")
    # A rule that a candidate may fit says which of the URL's expressions that is; its full digest decides.
    expression = expression_digest(host_suffix("labels"), path_prefix("slashes"))
    confirmed = (
        candidates.join(listed, "prefix")
        .join(urls, "key")
        .withColumn("digest", expression)
        .filter("size(split(host, '[.]')) >= labels AND size(split(path, '/')) > slashes AND digest = rule_digest")
        .filter((host_suffix("labels") == F.col("rule_host")) & F.expr("startswith(path, rule_path)"))
    )
    best = confirmed.groupBy("key").agg(
        F.max(
            F.struct(
                F.length("rule_text").alias("long"),
                F.length("rule_host").alias("host_long"),
                F.col("action").alias("action"),  # block is the greater word
                "rule_text",
            )
        ).alias("best")
    )
    best = materialize(best, "best")
    return urls.join(best, "key", "left").select(
        "url",
        "host",
        "path",
        F.col("best.rule_text").alias("rule"),
        F.coalesce("best.action", F.lit(default)).alias("verdict"),
    )


def prefix_hits(urls: DataFrame, listed: DataFrame, labels: int, slashes: int, prefix_bytes: int) -> DataFrame:
    """Per URL that shares a short hash prefix with a rule: key and prefix. Nothing else is dealt out."""
    some = urls.filter("host <> ''")
    suffixes = some.withColumn("n", F.explode(F.expr(f"sequence(1, greatest(1, least(size(split(host, '[.]')), {labels})))")))
    suffixes = suffixes.withColumn("suffix", host_suffix("n")).drop("n")
    expressions = suffixes.withColumn("n", F.explode(F.expr(f"sequence(0, least(size(split(path, '/')) - 1, {slashes}))")))
    digest = expression_digest(F.col("suffix"), path_prefix("n"))
    short = expressions.select("key", F.substring(digest, 1, prefix_bytes).alias("prefix"))
    return short.join(listed.select("prefix").distinct(), "prefix").distinct()


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]], default: str = "allow") -> DataFrame:
    """Per row of ``pages``: page_id, host, path, rule, verdict."""
    judged = verdicts(pages, rules, default).select(F.col("url").alias("judged_url"), "host", "path", "rule", "verdict")
    given = pages.select("page_id", "url")
    host, path = url_parts(F.col("url"))
    # Written, so that Spark can split the pages of a URL that very many have.
    matched = materialize(judged.filter("rule IS NOT NULL").select("judged_url", "rule", "verdict"), "matched")
    return given.join(matched, given["url"] == matched["judged_url"], "left").select(
        "page_id", host.alias("host"), path.alias("path"), "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )
