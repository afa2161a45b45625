"""Ranked lexical search: hashed max-sketches bound the scores, descending bounds are rescored exactly.

A document's impact of a term is ``(10**9 * tf) div (1000 * tf + 8 * m)``; its score for an item is the sum of
weight times impact over the item's terms. A sketch folds the impacts of all terms of a document into an array by
a hash of the term, keeping the maximum at each place. What a lookup finds is therefore never below the term's impact. A
document has two such arrays under independent hashes, each with at least ``ROOM`` places a distinct term, and a
lookup takes the lesser of both. All terms of all items of a block are looked up in a document at once, which bounds
its score for every item. Of each group of documents an item then rescored exactly those of the highest bounds, in
descending order, until a bound is below the item's tenth score so far; the others cannot enter its list.

The items are taken in blocks of bounded size. A block reads the documents twice, without moving a text: once for the
statistics (documents, terms, documents per term of the block), once for the search. Each task returns its best
``most`` documents of every item, and a window over those gives the ranks.

Defined results: NULL and empty texts have no terms and are not counted; an item without terms gets no row; rows with the
same id are documents of their own; NULL ids come after all others of an equal score; every row of the items is ranked by itself.
Texts of any length are read in slices of whole terms; an item is held as a whole.
"""

from __future__ import annotations

import math
from bisect import insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placeload.llm.common import chunks
from placeload.storage import materialize

MOST = 10
#: Places of a sketch for each distinct term, at least.
ROOM = 8
#: Documents whose bounds are compared before any is rescored, and the bytes they may have together.
GROUP, GROUP_BYTES = 1024, 1 << 22
#: Items of a block, and the bytes they may have together.
ITEMS, ITEM_BYTES = 1024, 1 << 20
#: Bytes of a text whose terms are counted at once.
SLICE = 1 << 19

U = np.uint64
#: ASCII letters, small, digits, and all bytes of further characters; anything else separates terms.
_TERM = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def term_counts(body: bytes) -> Counter:
    """How often each term occurs in a text in UTF-8."""
    body = body.translate(_TERM)
    if len(body) <= SLICE:
        return Counter(body.split())
    counts, at = Counter(), 0
    while at < len(body):
        stop = body.find(b" ", at + SLICE)
        stop = len(body) if stop < 0 else stop
        counts.update(body[at:stop].split())
        at = stop
    return counts


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def length_part(n: int, documents: int, terms: int) -> int:
    return 100 - 75 + (75 * n * documents) // terms


def hashes(terms: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh64_digest, terms)), ">u8").astype(np.uint64)


def sketch(counts: Counter, m: int) -> tuple[np.ndarray, np.ndarray]:
    """The coordinatewise maxima of a document's impacts, under two hashes."""
    places = 1 << max(6, (ROOM * len(counts) - 1).bit_length())
    at = hashes(list(counts))
    tf = np.fromiter(counts.values(), np.int64, len(counts))
    order = np.argsort(tf, kind="stable")  # a place keeps what is written last, the largest
    impact = (1_000_000_000 * tf[order]) // (1000 * tf[order] + 8 * m)
    found = []
    for shift in (0, 32):
        folded = np.zeros(places, np.int64)
        folded[((at[order] >> U(shift)) & U(places - 1)).astype(np.int64)] = impact
        found.append(folded)
    return found[0], found[1]


class Lookup:
    """The terms of a block's items that any document holds, item by item, with their weights."""

    def __init__(self, items: list[Counter], weights: dict[bytes, int]):
        self.items = [{t: weights[t] * times for t, times in counts.items() if t in weights} for counts in items]
        terms = [t for item in self.items for t in item]
        at = hashes(terms) if terms else np.zeros(0, np.uint64)
        self.low, self.high = at & U(0xFFFFFFFF), at >> U(32)
        self.weights = np.array([w for item in self.items for w in item.values()], np.int64)
        self.some = np.array([n for n, item in enumerate(self.items) if item], np.int64)
        self.starts = np.cumsum([0] + [len(item) for item in self.items if item])[:-1]

    def bounds(self, counts: Counter, m: int) -> np.ndarray:
        """For every item of ``some`` a number that the document's score does not exceed."""
        first, second = sketch(counts, m)
        last = U(len(first) - 1)
        impact = np.minimum(first[(self.low & last).astype(np.int64)], second[(self.high & last).astype(np.int64)])
        return np.add.reduceat(impact * self.weights, self.starts)

    def score(self, item: int, counts: Counter, m: int) -> int:
        total = 0
        for term, w in self.items[item].items():
            tf = counts.get(term)
            if tf:
                total += w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
        return total


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, bytes]]:
    for batch in batches:
        yield from zip(batch.column("doc_id").to_pylist(), (b.as_py() or b"" for b in batch.column("body")), strict=True)


def statistics(rows: DataFrame, terms: list[bytes]) -> tuple[int, int, dict[bytes, int]]:
    """Documents with a term, all their terms, and the documents that hold each of ``terms``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: n for n, t in enumerate(terms)}
        holding, documents, total = Counter(), 0, 0
        for _, body in _bodies(batches):
            counts = term_counts(body)
            if counts:
                documents += 1
                total += counts.total()
                holding.update(counts.keys() & number.keys())
        names = [-2, -1, *(number[t] for t in holding)]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array([documents, total, *holding.values()], pa.int64())], ["term", "n"])

    found = dict(rows.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect())
    return found.get(-2, 0), found.get(-1, 0), {terms[k]: n for k, n in found.items() if k >= 0}


def search_block(rows: DataFrame, items: list[tuple[int | None, bytes]], most: int) -> DataFrame:
    """The best documents of a block's items: number of the item, score, doc_id."""
    counted = [term_counts(body) for _, body in items]
    documents, total, holding = statistics(rows, sorted(set().union(*counted)))
    lookup = Lookup(counted, {t: weight(documents, n) for t, n in holding.items()})

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in items]
        least = np.zeros(len(lookup.some), np.int64)  # a score of an item has to exceed 0 and reach this

        def rescore(group: list[tuple]) -> None:
            bounds = np.stack([b for _, _, _, b in group])
            open_ = (bounds >= np.maximum(least, 1)).any(axis=0).nonzero()[0]
            for column in open_.tolist():
                item = int(lookup.some[column])
                held, of_item = best[item], bounds[:, column]
                for n in np.argsort(-of_item, kind="stable").tolist():
                    if of_item[n] < max(least[column], 1):
                        break
                    doc_id, counts, m, _ = group[n]
                    score = lookup.score(item, counts, m)
                    if score > 0:
                        insort(held, (-score, doc_id is None, doc_id or 0))
                        del held[most:]
                        if len(held) == most:
                            least[column] = -held[-1][0]

        def sized() -> Iterator[tuple[int, tuple]]:
            for doc_id, body in _bodies(batches):
                counts = term_counts(body)
                if counts and len(lookup.some):
                    m = length_part(counts.total(), documents, total)
                    yield len(body) + GROUP_BYTES // GROUP, (doc_id, counts, m, lookup.bounds(counts, m))

        for group in chunks(sized(), lambda row: row[0], GROUP_BYTES):
            rescore([row for _, row in group])
        found = [(n, -score, None if no_id else doc_id) for n, held in enumerate(best) for score, no_id, doc_id in held]
        columns = [pa.array([row[k] for row in found], pa.int64()) for k in range(3)]
        yield pa.RecordBatch.from_arrays(columns, ["item", "score", "doc_id"])

    return rows.mapInArrow(search, "item long, score long, doc_id long")


def lexical_search(docs: DataFrame, items: DataFrame, most: int = MOST) -> DataFrame:
    """Per item its ``most`` best documents: item_id, rank (from 1), doc_id, score."""
    spark = docs.sparkSession
    body = F.coalesce(F.col("text").cast("string").cast("binary"), F.lit("").cast("binary")).alias("body")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body)
    asked = ((r["item_id"], bytes(r["body"])) for r in items.select(F.col("item_id").cast("long").alias("item_id"), body).toLocalIterator())
    result = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    for block in chunks(asked, lambda row: len(row[1]) + ITEM_BYTES // ITEMS, ITEM_BYTES):
        names = spark.createDataFrame([(n, item_id) for n, (item_id, _) in enumerate(block)], "item long, item_id long")
        ranked = search_block(rows, block, most).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
        ranked = ranked.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        result = result.unionByName(materialize(ranked, "ranked"))
    return result
