"""Searches and links over all rows, against brute force on hard cases."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash

from placeload.llm import hard_negatives as hard
from placeload.llm import lexical_search as lexical
from placeload.llm import queries, simhash
from placeload.llm.oracle import ORACLES

DATA = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, fp string, Component_ID int, _metadata string"


def sortable(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("query", sorted(set(ORACLES) & {"op11_angular_negatives", "op13_lexical_search"}))
def test_query_against_its_sql(spark, query):
    df = getattr(queries, query)(spark, DATA)
    with duckdb.connect() as database:
        for name in ("documents", "embeddings", "benchmark"):
            database.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{DATA}/{name}.parquet')")
        found = database.execute(ORACLES[query])
        names = [d[0] for d in found.description]
        assert sortable(df.select(*names).collect()) == sortable(found.fetchall())


# --- links between fingerprints


def simple_print(text: str | None) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    parts = [" ".join(words[n : n + 3]) for n in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints: list[int], errors: int = 3) -> list[int]:
    """For each fingerprint the smallest that can be reached."""
    values = sorted(set(prints))
    root = {v: v for v in values}

    def top(v):
        while root[v] != v:
            v = root[v]
        return v

    given = np.array(values, np.uint64)
    for v in values:
        for n in (np.bitwise_count(given ^ np.uint64(v)) <= errors).nonzero()[0]:
            one, other = top(v), top(values[n])
            root[max(one, other)] = min(one, other)
    return [top(p) for p in prints]


BASE = "Mouse river stone cloud table winter green lamp forest bridge copper silent meadow candle harbor the of and "
TEXTS = [
    (1, BASE * 40), (2, BASE * 40 + "end"), (3, BASE.upper() * 40), (4, None), (5, ""), (6, " \n\t"), (7, "a"), (8, "A"), (9, "a b"),
    (9, "a b"), (None, "a b c"), (None, BASE * 40 + " other words"), (13, "é ☃ Ä ä"), (14, "é ☃ Ä Ä"), (15, "a\x00b c d e f"), (-2, "a B\x0bc"),
    (17, "x" * 5000), (18, "x y " * 3000), (19, BASE * 41), (None, None),
]


@pytest.mark.parametrize("piece", [1 << 19, 64])
def test_fingerprints(monkeypatch, piece):
    monkeypatch.setattr(simhash, "SLICE", piece)
    for _, text in TEXTS:
        assert simhash.fingerprint((text or "").encode()) == simple_print(text)


@pytest.mark.parametrize("leaf", [2, 4096])
def test_simhash(spark, leaf):
    docs = spark.createDataFrame([(i, t, None, "f", 1, "m") for i, t in TEXTS], DOCS).repartition(3)
    prints = [simple_print(t) for _, t in TEXTS]
    reached = groups(prints)
    wanted = []
    for (i, _), p, g in zip(TEXTS, prints, reached, strict=True):
        ids = [j for (j, _), h in zip(TEXTS, reached, strict=True) if h == g and j is not None]
        wanted.append((i, p - (1 << 64) if p >> 63 else p, min(ids, default=None)))
    assert sortable(simhash.simhash_classes(docs, leaf=leaf).collect()) == sortable(wanted)
    found = simhash.simhash_dedup(docs)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    assert {r["fingerprint"] for r in found.collect()} == {f"{p:016x}" for p in prints}
    assert simhash.simhash_dedup(docs.limit(0)).collect() == []


@pytest.mark.parametrize("leaf", [2, 50, 4096])
def test_no_link_is_lost(spark, leaf):
    """Dense and chained fingerprints, hot prefixes, both ends of the range, against all pairs."""
    random.seed(leaf)
    prints = {0, 1, 2**64 - 1, 7, 2**63}
    for centre in [random.getrandbits(64) for _ in range(12)]:
        for _ in range(20):
            for _ in range(random.choice([0, 1, 2, 2, 3, 4, 6])):
                centre ^= 1 << random.randrange(64)
            prints.add(centre)
    prints |= {0xABCDEF0123400000 | random.getrandbits(18) for _ in range(120)}
    prints |= {random.getrandbits(18) << 40 | 0x12345 for _ in range(120)}
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    df = spark.createDataFrame([(s,) for s in signed.values()], "fp long")
    links = simhash.trie_links(df, 3, leaf).collect()
    assert all(0 < ((r["a"] ^ r["b"]) & (2**64 - 1)).bit_count() <= 3 for r in links)
    back = {s: p for p, s in signed.items()}
    roots = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(links, "a long, b long")).collect()}
    order = sorted(prints)
    classes: dict = {}
    for p in order:
        classes.setdefault(roots.get(signed[p], signed[p]), []).append(p)
    wanted: dict = {}
    for p, g in zip(order, groups(order), strict=True):
        wanted.setdefault(g, []).append(p)
    assert sorted(classes.values()) == sorted(wanted.values()) and len(back) == len(prints)


def test_links_of_a_task_are_a_forest():
    """A dense group gives one link less than it has members, not all its pairs."""
    prints = np.array([1 << n for n in range(64)] + [0], np.uint64)
    kept = simhash._links([(0, 0, 0, prints, None)], 3)
    assert len(kept) == len(prints) - 1


def test_frontier_is_cut(monkeypatch):
    prints = np.array(sorted({random.Random(n).getrandbits(10) for n in range(600)}), np.uint64)
    whole = simhash._links([(0, 0, 0, prints, None)], 3)
    monkeypatch.setattr(simhash, "WIDE", 50)
    assert len(simhash._links([(0, 0, 0, prints, None)], 3)) == len(whole)


# --- ranked search


def simple_terms(text: str | None) -> Counter:
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return Counter(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low))


def simple_search(docs, items, most=10):
    counted = [(i, simple_terms(t)) for i, t in docs]
    n_docs, total = sum(1 for _, c in counted if c), sum(c.total() for _, c in counted)
    rows = []
    for item_id, text in items:
        scored = []
        for doc_id, counts in counted:
            score = 0
            for term, times in simple_terms(text).items():
                df = sum(1 for _, c in counted if term in c)
                if term in counts:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                    m = 25 + (75 * counts.total() * n_docs) // total
                    score += times * w * ((1_000_000_000 * counts[term]) // (1000 * counts[term] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        rows += [(item_id, n + 1, d, -s) for n, (s, _, _, d) in enumerate(sorted(scored)[:most])]
    return rows


VOCABULARY = [f"w{n}" for n in range(60)] + ["É", "naïve", "日本", "ab-cd", "x_y", "Tea", "tea", "TEA", "٣"]


def some_docs():
    draw = random.Random(4)
    docs = [(n % 50 if n % 9 else None, " ".join(draw.choices(VOCABULARY, k=draw.choice([0, 1, 5, 30, 200])))) for n in range(120)]
    docs += [(k, "w1 w2 w3 tea") for k in range(200, 240)] + [(7, None), (8, ""), (9, "?!")]
    items = [(1, "w1 w2 w3 tea"), (1, "w1 W1 unknown"), (2, None), (3, ""), (4, "only unknown"), (5, "日本 naïve É"), (None, "w9 w10 w11 ab"), (6, " ".join(VOCABULARY))]
    return docs, items


@pytest.mark.parametrize("small", [False, True])
def test_lexical_search(spark, monkeypatch, small):
    if small:  # blocks of one or two items, groups of few documents, texts in slices, crowded sketches
        for name, value in (("ITEMS", 2), ("ITEM_BYTES", 8), ("GROUP", 4), ("GROUP_BYTES", 64), ("SLICE", 7), ("ROOM", 1)):
            monkeypatch.setattr(lexical, name, value)
    docs, items = some_docs()
    table = spark.createDataFrame([(i, t, None, "x", 0, "m") for i, t in docs], DOCS).repartition(4)
    asked = spark.createDataFrame([(i, t, 3) for i, t in items], "item_id long, text string, doc_id int")
    found = lexical.lexical_search(table, asked)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sortable(found.collect()) == sortable(simple_search(docs, items))


def test_search_of_nothing(spark):
    docs = spark.createDataFrame([], DOCS)
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.lexical_search(docs, items).collect() == []
    assert lexical.lexical_search(docs, items.limit(0)).collect() == []


def test_bounds_are_never_below_scores():
    draw = random.Random(9)
    bags = [Counter(t.encode() for t in draw.choices(VOCABULARY, k=draw.randrange(1, 300))) for _ in range(40)]
    lookup = lexical.Lookup(bags[:7], {t.encode(): draw.randrange(9000) for t in VOCABULARY[:50]})
    for bag in bags:
        m = draw.randrange(25, 900)
        bounds = lookup.bounds(bag, m)
        assert all(bounds[n] >= lookup.score(n, bag, m) for n in range(7))


def test_few_documents_are_rescored(spark, monkeypatch):
    """With the best documents first in a group, the rest is left to its bounds."""
    docs = [(n, " ".join(f"t{(n * k) % 997}" for k in range(1, 60))) for n in range(1, 900)]
    weights = {f"t{n}".encode(): 100 + n for n in range(997)}
    item = lexical.term_counts(docs[4][1].encode())
    lookup = lexical.Lookup([item], weights)
    bags = [lexical.term_counts(t.encode()) for _, t in docs]
    bounds = np.array([lookup.bounds(b, 100)[0] for b in bags])
    scores = np.array([lookup.score(0, b, 100) for b in bags])
    assert (bounds >= np.sort(scores)[-10]).sum() < 60


# --- hard negatives


def simple_negatives(rows, every=100):
    kept = []
    for n, (i, vector, label) in enumerate(rows):
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        kept.append((i, [math.floor(256 * x) for x in vector], label, n))
    out = []
    for anchor in kept:
        if anchor[0] is None or anchor[0] % every:
            continue
        scored = [(sum(x * y for x, y in zip(anchor[1], v)), i, label) for i, v, label, n in kept if n != anchor[3]]  # noqa: B905
        scored = [(min(max(s, -(2**63)), 2**63 - 1), i, label) for s, i, label in scored]
        scored.sort(key=lambda r: (-r[0], r[1] is None, r[1] or 0))
        for p, i, _ in [r for r in scored if r[2] == anchor[2]][:5]:
            good = [r for r in scored if r[2] != anchor[2] and 30 * p <= 100 * r[0] <= 90 * p][:10]
            out += [(anchor[0], i, k + 1, r[1], p, r[0]) for k, r in enumerate(good)]
    return out


def vectors(seed, n, width=6, copies=()):
    draw = random.Random(seed)
    rows = [(k, [np.float32(draw.gauss(0, 0.4)).item() for _ in range(width)], draw.randrange(3)) for k in range(n)]
    return rows + [(n + k, list(rows[c][1]), rows[c][2]) for k, c in enumerate(copies)]


HARD = vectors(3, 260, copies=[5] * 90 + [100] * 30) + [
    (600, None, 1), (700, [0.5] * 6, None), (800, [float("nan")] * 6, 1), (900, [float("inf")] + [0.0] * 5, 1), (901, [None] * 6, 1),
    (1000, [0.0] * 6, 1), (1100, [], 2), (1200, [0.9, 0.9], 0), (1300, [0.9, 0.9, 0.0, 0.0], 0), (1400, [-0.5] * 6, 2), (1400, [-0.5] * 6, 2),
    (None, [0.5] * 6, 1), (None, [0.5] * 6, 0), (200, [0.3] * 6, 1), (200, [0.3] * 6, 1),
]
VECTORS = "vec_id long, embedding array<float>, label int, row string, near int, Score long"


@pytest.mark.parametrize("run", [512, 3])
def test_hard_negatives(spark, monkeypatch, run):
    monkeypatch.setattr(hard, "RUN", run)
    if run == 3:
        monkeypatch.setattr(hard, "ANCHORS", 2)
        monkeypatch.setattr(hard, "PAIRS", 4)
    df = spark.createDataFrame([(i, v, label, "r", 0, 0) for i, v, label in HARD], VECTORS).repartition(3)
    found = hard.hard_negatives(df)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sortable(found.collect()) == sortable(simple_negatives(HARD))
    assert hard.hard_negatives(df.limit(0)).collect() == []


def test_scores_beyond_doubles_are_exact(spark):
    rows = [(0, [2.0**22, 1.0, 3.0], 1), (1, [2.0**22, 5.0, 1.0], 1), (2, [2.0**21, 0.0, 7.0], 2), (3, [2.0**21, 1.0, 7.0], 3), (4, [1e30, 0.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    # The shifted label of anchor 0 is 2; ids that 7 divides are moved on, others not.
    assert sortable(hard.hard_negatives(df).collect()) == sortable(simple_negatives(rows))


def test_bounds_hold():
    draw = np.random.default_rng(2)
    given = np.floor(256 * draw.normal(0, 0.3, (200, 5)))
    given[:20] = given[20:40]
    given[40] = 0
    norms = np.linalg.norm(given, axis=1)
    angles = hard.angles_to(given, norms, hard.spread_out(given, 4))
    rows = hard.Rows(np.arange(200), np.arange(200), np.zeros(200, bool), np.zeros(200, int), norms, angles, given)
    low, high = hard.pair_bounds(rows, rows)
    scores = given @ given.T
    assert (low <= scores).all() and (scores <= high).all()
    low, high = hard.run_bounds(rows, rows.part(slice(10, 60)))
    assert (low[:, None] <= scores[:, 10:60]).all() and (scores[:, 10:60] <= high[:, None]).all()


def test_rows_outside_the_window_are_not_scored(spark, monkeypatch):
    """Two far groups of vectors: those on the other side are left to their bounds."""
    draw = np.random.default_rng(7)
    near = draw.normal(0, 0.01, (300, 8)) + np.eye(8)[0]
    far = draw.normal(0, 0.01, (300, 8)) - np.eye(8)[0]
    vectors_ = np.floor(256 * np.concatenate([near, far]))
    norms = np.linalg.norm(vectors_, axis=1)
    angles = hard.angles_to(vectors_, norms, hard.spread_out(vectors_, 8))
    rows = hard.Rows(np.arange(600), np.arange(600), np.zeros(600, bool), np.arange(600) % 2, norms, angles, vectors_)
    _, high = hard.run_bounds(rows.part(slice(0, 1)), rows.part(slice(300, 600)))
    assert high[0] < 0.3 * 256**2


def test_queries_are_registered():
    assert {"op11_angular_negatives", "op12_simhash_trie", "op13_lexical_search"} <= set(queries.registered())
