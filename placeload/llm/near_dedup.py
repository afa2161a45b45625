"""Near-duplicates by BagMinHash signatures of five-word shingles, banded and verified.

A document is the multiset of its shingles. Each shingle has, for every interval of the weight scale
(0 to 1, 1 to 2, 2 to 4, 4 to 8, ...), a Poisson process of points seeded by shingle and interval
alone; a point has a time, a register and a height inside the interval, and counts for a document if
the height is below the shingle's weight there. A register keeps its earliest time, so two documents
agree in a register with the probability of their weighted Jaccard similarity. Times beyond those
that fill all registers are never drawn; if a register stays empty, the horizon doubles.

Documents of equal words are one node. Nodes that agree in a band meet in a bucket. Each is verified
against the bucket's smallest node; components of the verified links come next. Buckets that still hold
more than one component are searched for further links: what is outside a bucket's largest component meets the whole
bucket, in blocks of bounded number and bytes, each task comparing only what is not connected yet and returning one link
per connection. No link is lost to the blocks, no pairs are listed, and no bucket has to fit into one task.

Defined results: a text without words is a class of its own; fewer than five words are one shingle; a NULL
id never becomes a class id unless all ids of the class are NULL; equal rows share a class; of equal ids the first in file
and place counts. A text is held as a whole by its task, with about fifty bytes of working memory for each of its own.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeload.llm.common import chunks, located, mix, placed, uniform, without
from placeload.storage import materialize

WORDS, SIMILAR = 5, 0.8
#: Registers are BANDS * ROWS; at a similarity of 0.8 a pair shares no band once in 20,000 times.
BANDS, ROWS = 25, 5
#: Nodes of a bucket compared in one task are at most about twice this.
BLOCK = 512
#: Bytes of text of such a task are at most about twice this, or those of its two longest texts.
BLOCK_BYTES = 4 << 20
#: Bytes of text whose shingles are made at once, and what a text counts for besides, however short.
CHUNK, SMALL = 1 << 20, 64

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = mix(np.arange(256, dtype=np.uint64) + U(0xA0761D6478BD642F))
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[:1] = 1
    return np.cumprod(p, dtype=np.uint64)


def shingle_hashes(bodies: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text the distinct hashes of its shingles and how often each occurs."""
    data = np.frombuffer(b"\n".join(bodies) + b"\n", np.uint8)
    space = _SPACE[data]
    starts = (~space & np.concatenate([[True], space[:-1]])).nonzero()[0]
    stops = (space & np.concatenate([[False], ~space[:-1]])).nonzero()[0]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(_BASE, len(data)), out=sums[1:])
    words = mix((sums[stops] - sums[starts]) * _powers(_INVERSE, len(data))[starts])
    edges = np.searchsorted(starts, np.cumsum([0] + [len(b) + 1 for b in bodies]))
    full = np.zeros(max(0, len(words) - WORDS + 1), np.uint64)
    for n in range(WORDS):
        full = full * U(0xD1342543DE82EF95) + words[n : n + len(full)]
    full = mix(full)
    found = []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        if b - a >= WORDS:
            hashes = np.sort(full[a : b - WORDS + 1])
        else:
            one = int(b - a)
            for w in words[a:b].tolist():
                one = (one * 0xD1342543DE82EF95 + w) & (2**64 - 1)
            hashes = mix(np.array([one] if b > a else [], np.uint64))
        new = np.ones(len(hashes), bool)
        new[1:] = hashes[1:] != hashes[:-1]
        at = new.nonzero()[0]
        found.append((hashes[at], np.diff(at, append=len(hashes))))
    return found


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], registers: int) -> np.ndarray:
    """BagMinHash: for each multiset (hashes, whole weights) the earliest time in each register."""
    times = np.full((len(bags), registers), np.inf)
    open_ = [n for n, (h, _) in enumerate(bags) if len(h)]
    horizon = np.array([registers * (np.log(registers) + 3) / max(1, w.sum()) for _, w in bags])
    while open_:
        owner = np.repeat(open_, [len(bags[n][0]) for n in open_])
        shingle = np.concatenate([bags[n][0] for n in open_])
        weight = np.concatenate([bags[n][1] for n in open_])
        low, high = 0, 1
        while len(owner):
            _points(times, owner, shingle, weight - low, high - low, horizon[owner], low)
            more = weight > high
            owner, shingle, weight = owner[more], shingle[more], weight[more]
            low, high = high, max(2, 2 * high)
        open_ = [n for n in open_ if np.isinf(times[n]).any()]
        horizon[open_] *= 2
    return times


def _points(times, owner, shingle, inside, rate, horizon, low) -> None:
    """Draw the points of one interval until the horizon: ``inside`` of its ``rate`` heights count."""
    registers = times.shape[1]
    state = mix(mix(shingle) + U(((low + 1) * 0x9E3779B97F4A7C15) & (2**64 - 1)))
    share = np.minimum(1.0, inside / rate)
    now = np.zeros(len(owner))
    flat = times.reshape(-1)
    while len(owner):
        state = state + U(0x9E3779B97F4A7C15)
        drawn = mix(state)
        now = now - np.log(uniform(drawn)) / rate
        stay = now <= horizon
        owner, state, share, now, horizon = owner[stay], state[stay], share[stay], now[stay], horizon[stay]
        where = mix(drawn[stay] ^ U(0x2545F4914F6CDD1D))
        register = (where % U(registers)).astype(np.int64)
        if rate > 1:
            counts = uniform(mix(where)) < share
            np.minimum.at(flat, (owner * registers + register)[counts], now[counts])
        else:
            np.minimum.at(flat, owner * registers + register, now)


def band_hashes(times: np.ndarray, bands: int, rows: int) -> np.ndarray:
    bits = np.ascontiguousarray(times).view(np.uint64).reshape(len(times), bands, rows)
    found = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(times), bands)).copy()
    for n in range(rows):
        found = mix(found * U(0xD1342543DE82EF95) + bits[:, :, n])
    return found.view(np.int64)


def body_of(text) -> bytes:
    return text.encode() if isinstance(text, str) else b""


def bag(text: str) -> Counter:
    """The multiset of shingles itself, for verification."""
    words = body_of(text).split()
    if len(words) < WORDS:
        return Counter([tuple(words)] if words else [])
    return Counter(zip(*(words[n:] for n in range(WORDS)), strict=False))


def overlap(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity."""
    if len(a) > len(b):
        a, b = b, a
    common = sum(min(n, b[s]) for s, n in a.items() if s in b)
    either = a.total() + b.total() - common
    return common / either if either else 0.0


def banded(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per row: doc_id, file, pos, node (digest of its words, NULL without any) and its bands."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A buffer of the batch is read piece by piece; only the texts of a chunk are Python's.
            bodies = ((n, body.as_py() or b"") for n, body in enumerate(batch.column("body")))
            for held in chunks(bodies, lambda r: len(r[1]) + SMALL, CHUNK):
                bags = shingle_hashes([body for _, body in held])
                found = band_hashes(signatures(bags, bands * rows), bands, rows)
                some = np.array([len(hashes) > 0 for hashes, _ in bags])
                digests = [hashlib.blake2b(b" ".join(body.split()), digest_size=16).digest() for _, body in held]
                nodes = pa.array([d if s else None for d, s in zip(digests, some, strict=True)], pa.binary())
                offsets = pa.array(np.arange(len(held) + 1, dtype=np.int32) * bands)
                lists = pa.ListArray.from_arrays(offsets, pa.array(found.ravel(), pa.int64()))
                part = batch.slice(held[0][0], len(held))
                columns = [part.column("doc_id"), part.column("file"), part.column("pos"), nodes, lists]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "file", "pos", "node", "bands"])

    body = F.col("text").cast("string").cast("binary").alias("body")
    return located(docs, F.col("doc_id").cast("long").alias("doc_id"), body).mapInArrow(
        sign, "doc_id long, file string, pos long, node binary, bands array<long>"
    )


def components(links: DataFrame) -> DataFrame:
    """Connected components of ``links`` (a, b): node and its component's smallest node.

    Large-star and small-star steps in turn; a node's smallest neighbour is an aggregate that is
    joined back, so a node with very many links is never gathered. Each step is written to
    the shared folder.
    """
    pairs = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    pairs = materialize(pairs, "links")
    before = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialize(large.filter("a <> b").distinct(), "large")
        small = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        pairs = large.join(small, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        pairs = materialize(pairs.unionByName(small.select("a", F.col("m").alias("b"))).filter("a <> b").distinct(), "links")
        # Settled once every node has one link, to a root that has none, and nothing changes.
        state = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state


def verified(pairs: DataFrame, texts: DataFrame, similar: float) -> DataFrame:
    """Those of ``pairs`` (a, b) whose texts overlap enough."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, held = None, Counter()
        for batch in batches:
            good = []
            for b, text_a, text_b in zip(batch["b"].array, batch["text_a"].array, batch["text_b"].array, strict=True):
                if b != last:
                    last, held = b, bag(text_b)
                good.append(overlap(bag(text_a), held) >= similar)
            yield batch.loc[good, ["a", "b"]]

    first = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(first, "a").join(second, "b").select("a", "b", "text_a", "text_b").mapInPandas(check, "a binary, b binary")


def dealt_out(members: DataFrame, roots: DataFrame, sizes: DataFrame, block: int, block_bytes: int) -> DataFrame:
    """Per task (bucket, low, high) its members: node, root and side.

    Members of the bucket's largest component need not meet each other. They are cut into sides, as are all others, and
    each side of the others meets itself, the other sides, and each side of the largest component; so one
    stray beside a component of any size takes that component to tasks just once. A bucket of two was compared as
    a whole already; of buckets with the same nodes one is searched.
    """
    rooted = members.join(roots, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root"))
    rooted = rooted.join(sizes, "node")
    number = F.xxhash64("node").cast("decimal(38,0)")
    by_root = rooted.groupBy("bucket", "root").agg(
        F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"), F.sum(number).alias("all")
    )
    total = by_root.groupBy("bucket").agg(
        F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.sum("all").alias("all"), F.count(F.lit(1)).alias("roots"),
        F.max(F.struct("n", "bytes", "root")).alias("most"),
    )
    mixed = total.filter("n > 2 AND roots > 1").groupBy("all", "n").agg(F.min(F.struct("bucket", "bytes", "most")).alias("one"))

    def sides(n, size):
        return F.greatest(F.ceil(n / block), F.ceil(size / block_bytes), F.lit(1)).cast("int")

    most = F.col("one.most")
    mixed = mixed.select(
        "one.bucket",
        most["root"].alias("most"),
        sides(most["n"], most["bytes"]).alias("large"),
        sides(F.col("n") - most["n"], F.col("one.bytes") - most["bytes"]).alias("small"),
    )
    # Written, so that Spark can split the nodes of a bucket that very many share.
    placed = rooted.join(materialize(mixed, "mixed"), "bucket").withColumn("inside", F.col("root") == F.col("most"))
    of = F.pmod(F.xxhash64("node", F.lit(1)), F.when(F.col("inside"), F.col("large")).otherwise(F.col("small"))).cast("int")
    placed = placed.withColumn("side", F.when(F.col("inside"), F.col("small") + of).otherwise(of))
    others = F.when(F.col("inside"), F.col("small")).otherwise(F.col("small") + F.col("large"))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), others - 1)))
    return met.select(
        "bucket", "node", "root", "side", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high")
    )


def further_links(
    members: DataFrame, roots: DataFrame, texts: DataFrame, similar: float, block: int, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Links between different components of a bucket, at least one for each two that have any.

    ``members``: bucket, node. Tasks are cut by number of texts and by their bytes, see ``dealt_out``.
    """
    sizes = texts.select("node", F.octet_length("text").alias("bytes"))
    dealt = dealt_out(members, roots, sizes, block, block_bytes).join(texts.select("node", "text"), "node")

    def search(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node")
        nodes, side = group["node"].tolist(), group["side"].to_numpy()
        root = pd.factorize(group["root"])[0]
        apart = group["low"].iloc[0] != group["high"].iloc[0]
        texts = group["text"].tolist()
        bags = shingle_hashes([body_of(t) for t in texts])
        total = np.array([counts.sum() for _, counts in bags])
        mine = np.cumsum([0] + [len(hashes) for hashes, _ in bags])
        owners, weights = np.repeat(np.arange(len(nodes)), np.diff(mine)), np.concatenate([c for _, c in bags])
        names, shingles = np.unique(np.concatenate([h for h, _ in bags]), return_inverse=True)
        order = np.argsort(shingles, kind="stable")
        cut = np.searchsorted(shingles[order], np.arange(len(names) + 1))
        links = []
        for n in range(len(nodes)):
            if (root[n + 1 :] == root[n]).all():
                continue
            own = shingles[mine[n] : mine[n + 1]]
            width = cut[own + 1] - cut[own]
            spot = order[np.repeat(cut[own], width) + np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)]
            least = np.minimum(np.repeat(weights[mine[n] : mine[n + 1]], width), weights[spot])
            common = np.bincount(owners[spot], least, len(nodes))
            near = common >= similar * (total + total[n] - common)
            near &= (root != root[n]) & (np.arange(len(nodes)) > n)
            if apart:
                near &= side != side[n]
            for m in near.nonzero()[0]:
                # Hashes found them; the shingles themselves decide.
                if root[m] != root[n] and overlap(bag(texts[m]), bag(texts[n])) >= similar:
                    links.append((nodes[m], nodes[n]))
                    root[root == root[m]] = root[n]
        return pd.DataFrame(links, columns=["a", "b"]).astype(object)

    return dealt.groupBy("bucket", "low", "high").applyInPandas(search, "a binary, b binary")


def near_classes(docs: DataFrame, similar: float = SIMILAR, bands: int = BANDS, rows: int = ROWS, block: int = BLOCK) -> DataFrame:
    """Per row: doc_id, file, pos, holder (no_id, doc_id, file, pos of the class's first row), class_size."""
    docs = placed(docs.select("doc_id", "text"))
    signed = materialize(banded(docs, bands, rows), "signed")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "pos")
    nodes = signed.filter("node IS NOT NULL").groupBy("node").agg(F.min(row).alias("holder"), F.count(F.lit(1)).alias("size"))
    nodes = materialize(nodes, "nodes")
    # Equal words have equal bands: those of the holder are taken.
    one = nodes.select("node", "holder.file", "holder.pos")
    filed = signed.select("node", "file", "pos", "bands").join(one, ["node", "file", "pos"], "left_semi")
    filed = filed.select("node", F.explode("bands").alias("bucket"))
    buckets = filed.groupBy("bucket").agg(F.min("node").alias("least"), F.max("node").alias("most")).filter("least <> most")
    # Written, so that the join can split the nodes of a bucket that very many share.
    buckets = materialize(buckets.select("bucket", "least"), "buckets")
    members = materialize(filed.join(buckets, "bucket"), "members")
    pairs = members.filter("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b")).distinct()
    wanted = nodes.join(members.select("node").distinct(), "node", "left_semi").select("node", "holder.file", "holder.pos")
    texts = materialize(located(docs, "text").join(wanted, ["file", "pos"]).select("node", "text"), "texts")
    links = materialize(verified(pairs, texts, similar), "verified")
    roots = components(links)
    more = materialize(further_links(members, roots, texts, similar, block), "further")
    if not more.isEmpty():
        roots = components(links.unionByName(more))
    classed = nodes.join(roots, "node", "left").select("node", "holder", "size", F.coalesce("root", "node").alias("root"))
    # Written, so that Spark can split the nodes of a class, or the rows of a node, that very many share.
    classed = materialize(classed, "classed")
    classes = classed.groupBy("root").agg(F.min("holder").alias("holder"), F.sum("size").alias("class_size"))
    of_node = classed.select("node", "root").join(materialize(classes, "classes"), "root")
    of_node = materialize(of_node.select("node", "holder", "class_size"), "of-node")
    own = F.when(F.col("node").isNull(), row)
    return signed.join(of_node, "node", "left").select(
        "doc_id", "file", "pos", F.coalesce("holder", own).alias("holder"), F.coalesce("class_size", F.lit(1)).alias("class_size")
    )


def near_dedup(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """Per document: doc_id, class_id (the smallest id of its class), class_size, kept (the class's first row)."""
    return near_classes(docs, similar).select(
        "doc_id",
        F.col("holder.doc_id").alias("class_id"),
        "class_size",
        F.expr("file = holder.file AND pos = holder.pos").alias("kept"),
    )


def drop_near_copies(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """The first row of each class, with all columns of ``docs``."""
    docs = placed(docs)
    return without(docs, near_classes(docs, similar).filter("NOT (file = holder.file AND pos = holder.pos)"))
