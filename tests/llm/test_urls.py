"""The URL filter's plan, collisions of prefixes and hot URLs."""

from __future__ import annotations

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from placeload.llm import url_filter
from placeload.llm.queries import RULES


def plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


@pytest.fixture
def no_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.files.maxPartitionBytes": "256k",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def simple(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    host = rest
    for sign in "/?#":
        host = host.split(sign)[0]
    path = rest[len(host) :].split("?")[0].split("#")[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), a, h + p) for a, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    _, _, action, rule = max(fits, default=(0, 0, "allow", None))
    return host, path, rule, action


URLS = [
    "http://example.com/en/a", "https://www.EXAMPLE.com/en/?q", "http://a.b.example.com/en/x/y#z", "http://example.com/english", "http://x.net/es/1",
    "http://net/fr/", "http://notnet/fr/", "http://x.net/de/", "no url", None, "", "http://", "http://.com/", "http://com", "ftp://com/", "http://x.com?/en/",
    "a://b://example.com/en/", "http://www.example.com./en/", "http://example.com//en/",
]


@pytest.mark.parametrize("prefix_bytes", [4, 1])
def test_against_all_rules(spark, prefix_bytes):
    """With one byte many expressions share a prefix with a rule that they do not fit."""
    more = [f"http://h{n}.{'net' if n % 3 else 'example.com'}/{'en' if n % 2 else 'es'}/{n}" for n in range(400)]
    pages = spark.createDataFrame([(u,) for u in URLS + more], "url string").repartition(3)
    found = url_filter.verdicts(pages, RULES, prefix_bytes=prefix_bytes).collect()
    assert {r["url"]: tuple(r)[1:] for r in found} == {u: simple(u) for u in URLS + more}


def test_prefix_is_the_only_key(spark, no_broadcast):
    """Digests, hosts and paths are not dealt out with the prefixes, and the filter is no part of that join."""
    urls = spark.createDataFrame([(n, f"h{n}.com", "/a/") for n in range(5)], "key long, host string, path string")
    rules = spark.createDataFrame([(bytes(4),)], "prefix binary")
    text = plan(url_filter.prefix_hits(urls, rules, 2, 2, 4))
    joins = [line for line in text.splitlines() if "Join" in line]
    assert len(joins) == 1 and joins[0].count("prefix#") == 2 and "digest" not in joins[0]
    dealt = [line for line in text.splitlines() if "Exchange hashpartitioning(prefix#" in line]
    assert dealt and "suffix" not in text.split("Exchange hashpartitioning(prefix#")[1].split("Project")[0]


def test_half_the_pages_have_one_url(spark, no_broadcast, tmp_path):
    """The rows of a hot URL, and those without any, are split over tasks."""
    url = F.expr("CASE WHEN id % 2 = 0 THEN 'http://www.example.com/en/hot' WHEN id % 7 = 0 THEN NULL ELSE concat('http://h', id % 1000, '.net/es/') END")
    spark.range(0, 200_000, 1, 6).select(F.col("id").alias("page_id"), url.alias("url"), F.repeat(F.lit("x"), F.lit(3)).alias("rule")).write.parquet(str(tmp_path / "p"))
    judged = url_filter.filter_urls(spark.read.parquet(str(tmp_path / "p")), RULES)
    counts = {tuple(r)[:2]: r["count"] for r in judged.groupBy("rule", "verdict").count().collect()}
    assert counts == {("www.example.com/en/", "allow"): 100_000, (None, "allow"): 14_286, ("net/es/", "block"): 85_714}
    rows = judged.groupBy(F.spark_partition_id()).count()
    sizes = [r["count"] for r in rows.collect()]
    assert sum(sizes) == 200_000 and max(sizes) < 60_000
