"""SimHash near-duplicates: fingerprints of three-word shingles, linked by a self-join of a binary trie.

A bit of a document's fingerprint is 1 if it is set in over half of the XXH64 hashes of its shingles, repeats
included. Fingerprints link at ``errors`` or fewer differing bits; a component is all that links reach.

The distinct fingerprints are the leaves of a binary trie, one bit a level. The trie is joined with itself from
the root down: a pair of nodes carries the bits in which their paths differ, its children are the pairs of
their children, and a pair over its error budget is dropped with all below it. Of two halves with together
at most ``errors`` differing bits one has at most ``errors // 2``, so two tries are walked, one for either
order of the halves: the budget is ``errors // 2`` along the first half of the bits and ``errors`` below.

The upper levels are walked by joins of node tables, four bits at a time, for as long as a pair of nodes
holds more than ``leaf`` fingerprints, so that common prefixes are split as far as needed and no task gets more than that
for a pair. The levels below are walked inside the tasks, bit by bit, in frontiers of bounded length, where two single
leaves compare the rest of their bits at once. Each task returns a spanning forest of the links it finds, and
the components follow from all forests. Equal fingerprints are one leaf, however many documents have them.

Defined results: a text without words (NULL, empty, blanks) has fingerprint zero, linked like any other; fewer words
than a shingle are one shingle; repeated rows share fingerprint and component; a NULL id takes no part in the
smallest id, so a component of NULL ids only has a NULL id. Texts of any length are read in slices of whole words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeload.llm.near_dedup import components
from placeload.storage import materialize

SHINGLE, ERRORS, SEED = 3, 3, 42
#: A pair of trie nodes with at most so many fingerprints is joined by one task; larger ones are split first.
LEAF = 4096
#: Bits by which a large pair of nodes is split.
STEP = 4
#: Bytes of a text whose shingles are made at once.
SLICE = 1 << 19
#: Fingerprints read at once, and pairs of nodes followed at once, in a task.
READ, WIDE = 1 << 17, 1 << 18

U = np.uint64
_GAP = re.compile(rb"[\x20\x09-\x0D]")
#: Which of its eight bits each byte has, the highest first.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def words_of(body: bytes) -> Iterator[list[bytes]]:
    """The words of a text, slice by slice."""
    at = 0
    while at < len(body):
        gap = _GAP.search(body, at + SLICE)
        stop = gap.start() if gap else len(body)
        yield body[at:stop].lower().split()
        at = stop


def fingerprint(body: bytes, shingle: int = SHINGLE) -> int:
    """The SimHash of a text in UTF-8; zero without words."""
    held: list[bytes] = []
    counts, total = np.zeros(8 * 256, np.int64), 0
    for words in words_of(body):
        held += words
        if len(held) < shingle:
            continue
        parts = map(b" ".join, zip(*(held[n:] for n in range(shingle)), strict=False))
        hashes = np.frombuffer(b"".join(map(xxhash.xxh64_digest, parts, repeat(SEED))), np.uint8).reshape(-1, 8)
        counts += np.bincount((hashes + np.arange(0, 8 * 256, 256)).ravel(), minlength=8 * 256)
        total += len(hashes)
        held = held[len(held) - shingle + 1 :]
    if not total:
        return xxhash.xxh64_intdigest(b" ".join(held), SEED) if held else 0
    ones = np.concatenate([counts[256 * n : 256 * n + 256] @ _BITS for n in range(8)])
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Per row: doc_id, fp (the fingerprint as a signed number)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(b.as_py() or b"", shingle) for b in batch.column("body")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("body"))
    return rows.mapInArrow(sign, "doc_id long, fp long")


def prefix(depth: int):
    """The trie node at ``depth`` on the path to ``key``."""
    return F.shiftrightunsigned("key", 64 - depth) if depth else F.lit(0).cast("long")


def node_pairs(keys: DataFrame, errors: int, leaf: int) -> list[tuple[int, DataFrame]]:
    """Pairs of nodes (trie, a, b, gap) within the budget, by depth, each with at most ``leaf`` keys."""
    size = F.count(F.lit(1))
    root = F.lit(0).cast("long")
    pairs = keys.groupBy("trie").agg(size.alias("n_a")).select(
        "trie", root.alias("a"), root.alias("b"), F.lit(0).alias("gap"), "n_a", F.col("n_a").alias("n_b")
    )
    found, depth = [], 0
    together = F.when(F.col("a") == F.col("b"), F.col("n_a")).otherwise(F.col("n_a") + F.col("n_b"))
    while True:
        pairs = materialize(pairs, "trie-pairs")
        found.append((depth, pairs.filter((together <= leaf) & (together > 1)).select("trie", "a", "b", "gap")))
        wide = pairs.filter((together > leaf) & (together > 2))
        if wide.isEmpty():
            return found
        depth += STEP
        nodes = keys.groupBy("trie", prefix(depth).alias("node")).agg(size.alias("n"))
        nodes = materialize(nodes.withColumn("above", F.shiftrightunsigned("node", STEP)), "trie-nodes")
        left = nodes.select("trie", F.col("above").alias("a"), F.col("node").alias("to_a"), F.col("n").alias("n_a"))
        right = nodes.select("trie", F.col("above").alias("b"), F.col("node").alias("to_b"), F.col("n").alias("n_b"))
        apart = F.bit_count(F.col("to_a").bitwiseXOR(F.col("to_b")).bitwiseAND(F.lit((1 << STEP) - 1)))
        pairs = (
            wide.select("trie", "a", "b", "gap")
            .join(left, ["trie", "a"])
            .join(right, ["trie", "b"])
            .filter("a <> b OR to_a <= to_b")
            .withColumn("gap", F.col("gap") + apart)
            .filter(F.col("gap") <= (errors // 2 if depth <= 32 else errors))
            .select("trie", F.col("to_a").alias("a"), F.col("to_b").alias("b"), "gap", "n_a", "n_b")
        )


def walk(keys: np.ndarray, pairs: np.ndarray, depth: int, errors: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Leaf pairs within the budget below the pairs of nodes at ``depth``.

    A node is a range of ``keys``, which are sorted inside it. Rows of ``pairs``: begin and end of one
    node, begin and end of the other, the bits in which their paths differ.
    """
    ones: dict[int, np.ndarray] = {}
    open_ = [(depth, pairs)]
    while open_:
        depth, f = open_.pop()
        if f.shape[1] > WIDE:
            open_ += [(depth, f[:, n : n + WIDE]) for n in range(0, f.shape[1], WIDE)]
            continue
        single = (f[1] - f[0] == 1) & (f[3] - f[2] == 1)
        a, b = f[0, single], f[2, single]
        rest = keys[a] ^ keys[b]
        near = (np.bitwise_count(rest) <= errors) & (np.bitwise_count(rest >> U(32)) <= errors // 2) & (a != b)
        if near.any():
            yield a[near], b[near]
        f = f[:, ~single]
        if depth == 64 or not f.shape[1]:
            continue
        if depth not in ones:
            set_ = (keys >> U(63 - depth)) & U(1)
            ones[depth] = np.concatenate([[0], np.cumsum(set_, dtype=np.int32)]).astype(np.int32)
        up = ones[depth]
        cut_a, cut_b = f[1] - (up[f[1]] - up[f[0]]), f[3] - (up[f[3]] - up[f[2]])
        budget = errors // 2 if depth < 32 else errors
        own, roomy = f[0] == f[2], f[4] < budget
        below = [
            np.stack([f[0], cut_a, f[2], cut_b, f[4]]),
            np.stack([cut_a, f[1], cut_b, f[3], f[4]]),
            np.stack([f[0], cut_a, cut_b, f[3], f[4] + 1])[:, roomy],
            np.stack([cut_a, f[1], f[2], cut_b, f[4] + 1])[:, roomy & ~own],
        ]
        f = np.concatenate(below, axis=1)
        alone = (f[0] == f[2]) & (f[1] - f[0] < 2)
        f = f[:, (f[1] > f[0]) & (f[3] > f[2]) & ~alone]
        if f.shape[1]:
            open_.append((depth + 1, f))


def forest(names: np.ndarray, found: Iterator[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int]]:
    """Of the links between positions of ``names`` those that connect what is not connected yet."""
    values, name = np.unique(names, return_inverse=True)
    root = np.arange(len(values))
    kept = []

    def top(n: int) -> int:
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for a, b in found:
        a, b = name[a], name[b]
        while (root[root] != root).any():
            root = root[root]
        open_ = root[a] != root[b]
        for x, y in zip(a[open_].tolist(), b[open_].tolist(), strict=True):
            one, other = top(x), top(y)
            if one != other:
                root[max(one, other)] = min(one, other)
                kept.append((int(values[x]), int(values[y])))
    return kept


def trie_links(prints: DataFrame, errors: int = ERRORS, leaf: int = LEAF) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that connect all within ``errors`` bits of each other."""
    turned = F.shiftleft("fp", 32).bitwiseOR(F.shiftrightunsigned("fp", 32))
    both = F.array(F.struct(F.lit(0).alias("trie"), F.col("fp").alias("key")), F.struct(F.lit(1).alias("trie"), turned.alias("key")))
    keys = materialize(prints.select(F.inline(both)), "trie")
    pairs = held = None
    for depth, of_depth in node_pairs(keys, errors, leaf):
        at = F.lit(depth).alias("depth")
        wanted = of_depth.select("trie", F.explode(F.array("a", "b")).alias("node")).distinct()
        members = keys.select("trie", prefix(depth).alias("node"), "key").join(wanted, ["trie", "node"], "left_semi")
        # At most ``leaf`` keys each.
        members = members.groupBy("trie", "node").agg(F.collect_list("key").alias("keys")).select("trie", at, "node", "keys")
        of_depth = of_depth.select("trie", at, "a", "b", "gap")
        pairs = of_depth if pairs is None else pairs.unionByName(of_depth)
        held = members if held is None else held.unionByName(members)
    held = materialize(held, "trie-keys")
    other = held.select("trie", "depth", F.col("node").alias("b"), F.col("keys").alias("keys_b"))
    held = held.select("trie", "depth", F.col("node").alias("a"), F.col("keys").alias("keys_a"))
    # A node with itself needs its keys once.
    joined = pairs.join(held, ["trie", "depth", "a"]).withColumn("b", F.expr("nullif(b, a)")).join(other, ["trie", "depth", "b"], "left")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _read(batch):
                kept = _links(rows, errors)
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in kept], pa.int64()), pa.array([y for _, y in kept], pa.int64())], ["a", "b"])

    return joined.select("trie", "depth", "gap", "keys_a", "keys_b").mapInArrow(link, "a long, b long")


def _read(batch: pa.RecordBatch) -> Iterator[list[tuple]]:
    """The batch's rows (trie, depth, gap, keys of a, keys of b), about ``READ`` keys at a time."""
    held, total = [], 0
    columns = [batch.column(n) for n in range(5)]
    for n in range(batch.num_rows):
        a, b = columns[3][n].values.to_numpy(), columns[4][n].values
        row = (*(columns[k][n].as_py() for k in range(3)), a.view(np.uint64), None if b is None else b.to_numpy().view(np.uint64))
        size = len(a) + (0 if b is None else len(b.to_numpy()))
        if held and total + size > READ:
            yield held
            held, total = [], 0
        held.append(row)
        total += size
    if held:
        yield held


def _links(rows: list[tuple], errors: int) -> list[tuple[int, int]]:
    keys, names, by_depth, at = [], [], {}, 0
    for trie, depth, gap, a, b in rows:
        begin = []
        for part in (a,) if b is None else (a, b):
            part = np.sort(part)
            keys.append(part)
            # The fingerprint itself, as a signed number.
            names.append((part if trie == 0 else (part << U(32)) | (part >> U(32))).view(np.int64))
            begin.append((at, at + len(part)))
            at += len(part)
        by_depth.setdefault(depth, []).append((*begin[0], *begin[-1], gap))
    keys, names = np.concatenate(keys), np.concatenate(names)

    def found() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for depth, pairs in by_depth.items():
            yield from walk(keys, np.array(pairs).T, depth, errors)

    return forest(names, found())


def simhash_classes(docs: DataFrame, errors: int = ERRORS, shingle: int = SHINGLE, leaf: int = LEAF) -> DataFrame:
    """Per row: doc_id, fp, component_id (the smallest id that links reach), links' ends taken from the trie join."""
    signed = materialize(fingerprints(docs, shingle), "fingerprints")
    prints = materialize(signed.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = components(trie_links(prints.select("fp"), errors, leaf))
    rooted = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = materialize(rooted, "rooted")
    # Written, so that Spark can split the documents of a component or fingerprint that very many share.
    classes = materialize(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "classes")
    classed = materialize(rooted.join(classes, "root").select("fp", "component_id"), "classed")
    return signed.join(classed, "fp").select("doc_id", "fp", "component_id")


def simhash_dedup(docs: DataFrame, errors: int = ERRORS) -> DataFrame:
    """Per document: doc_id, fingerprint (16 lowercase hex digits), component_id."""
    return simhash_classes(docs, errors).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
