"""Labels of lines that are learnt from labels of documents."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from placeload.llm import line_quality as lq

GOOD = "The {} stood by the river and the long winter was nearly over."
JUNK = "{}$$$ win### now*** {}&&& free%%%"
NAMES = "stone cloud table lamp forest bridge copper candle harbor meadow".split()


def text(kinds, seed=0):
    names = itertools.cycle(NAMES[seed % 10 :] + NAMES[: seed % 10])
    return "\n".join((JUNK if k else GOOD).format(f"{next(names)}{n}", n) for n, k in enumerate(kinds))


def score(field, x, y):
    e = x @ field.emit
    return sum(e[k, v] for k, v in enumerate(y)) + sum(field.step[a, b] for a, b in zip(y, y[1:], strict=False))


def random_field(rng):
    return lq.Field(rng.normal(size=(lq.N_FEATURES, 2)), rng.normal(size=(2, 2)))


def test_likelihood_and_slopes_against_all_labellings():
    rng = np.random.default_rng(5)
    sequences = [rng.normal(size=(n, lq.N_FEATURES)) for n in (1, 4, 2, 6, 3)]
    labels = [rng.integers(0, 2, len(s)) for s in sequences]
    field, runs = random_field(rng), lq.Runs(sequences)

    def likelihood(at):
        every = [[score(at, s, y) for y in itertools.product((0, 1), repeat=len(s))] for s in sequences]
        return sum(score(at, s, y) - np.logaddexp.reduce(z) for s, y, z in zip(sequences, labels, every, strict=True))

    found, by_emit, by_step = runs.gradient(labels, field)
    assert found == pytest.approx(likelihood(field))
    for part, slopes in ((0, by_emit), (1, by_step)):
        for at in np.ndindex(slopes.shape):
            sides = []
            for move in (1e-5, -1e-5):
                moved = [field.emit.copy(), field.step.copy()]
                moved[part][at] += move
                sides.append(likelihood(lq.Field(*moved)))
            assert slopes[at] == pytest.approx((sides[0] - sides[1]) / 2e-5, abs=1e-5)


def test_agreeing_labels():
    rng = np.random.default_rng(8)
    for n in range(1, 8):
        field, x, sizes = random_field(rng), rng.normal(size=(n, lq.N_FEATURES)), rng.integers(1, 50, n)
        x[:, 0] = 1
        free = field.decode(x)
        for bad in (False, True):
            labels = lq.agreeing(field, x, sizes, bad)
            assert (2 * sizes[labels == 0].sum() < sizes.sum()) == bad
            if (2 * sizes[free == 0].sum() < sizes.sum()) == bad:
                assert (labels == free).all()


@pytest.fixture(scope="module")
def learnt(spark):
    """Good documents with a line of junk, and junk with a line of prose, at places that move."""
    rows, labels = [], []
    for n in range(80):
        bad = n % 2
        kinds = [bad] * 7
        kinds[n % 7] = 1 - bad
        rows.append((n, text(kinds, n)))
        labels.append((n, 1 - bad, 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return lq.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


@pytest.mark.parametrize("kinds", [[0, 1] * 4, [0, 0, 1, 1, 0, 0], [1, 0, 0, 0], [0] * 6, [1] * 6, [0], [1]])
def test_lines_of_one_text_get_their_own_labels(learnt, kinds):
    assert learnt.decode(lq.lines_of(text(kinds, 3))[0]).tolist() == kinds


def test_content_share_follows_the_lines(spark, learnt):
    docs = spark.createDataFrame([(1, text([0, 0, 0, 1])), (2, text([1, 1, 1, 0]))], "doc_id long, text string")
    found = {r["doc_id"]: r for r in lq.judge_lines(docs, learnt).collect()}
    assert found[1]["labels"] == [0, 0, 0, 1] and found[2]["labels"] == [1, 1, 1, 0]
    assert 0.5 < found[1]["content_share"] < 1 and 0 < found[2]["content_share"] < 0.5
    # The words of these lines repeat, which the base rules refuse.
    assert found[1]["base_failed"] and not found[1]["kept"]
    words = " ".join(f"{a} {b}" for a in NAMES for b in NAMES[:3])
    mixed = [f"The {words} stood by the river.", JUNK.format("lamp", 1), f"Nearly {words[::-1]} was over."]
    docs = spark.createDataFrame([(1, "\n".join(mixed)), (2, "\n".join([words.replace(" ", "$$$ "), mixed[1]]))], "doc_id long, text string")
    found = {r["doc_id"]: r for r in lq.judge_lines(docs, learnt).collect()}
    assert found[1]["labels"] == [0, 1, 0] and found[1]["kept"] and not found[1]["base_failed"]
    assert found[2]["labels"] == [1, 1] and not found[2]["kept"] and not found[2]["base_failed"]


def test_hard_rows_and_labels(spark):
    """NULLs, rows of one id, an id labelled twice, labels of unknown documents, a long line, a column that clashes."""
    rows = [(n, text([n % 2] * 3, n), 1) for n in range(20)] + [(3, None, 1), (None, text([0]), 1), (4, "", 1), (5, "x" * 300_000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    labels = [(n, 1 - n % 2, None) for n in range(20)] + [(2, None, 0), (None, 1, 0), (99, 0, 0), (0, 1, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = lq.line_quality(docs, labels)
    assert found.count() == len(rows)
    again = lq.line_quality(docs.repartition(5, F.rand(3)), labels)
    assert sorted(map(str, found.collect())) == sorted(map(str, again.collect()))
    one_kind = lq.line_quality(docs, labels.where("quality = 1")).where("n_lines > 0")
    assert one_kind.where("n_content_lines < n_lines").count() == 0
    assert lq.line_quality(docs.limit(0), labels).collect() == []


def test_held_out_accuracy_and_line_labels(spark):
    """On sf0.1's labels beside the sample, and on texts put together from held-out good and junk lines."""
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(2)) == 0
    field = lq.fit(docs, labels.where(~held))
    rows = lq.judge_lines(docs.join(labels.where(held), "doc_id", "semi"), field).join(labels, "doc_id").collect()
    rows = [r for r in rows if r["quality"] is not None and r["n_lines"]]
    good = [r["content_share"] >= 0.5 for r in rows if r["quality"] == 1]
    bad = [r["content_share"] < 0.5 for r in rows if r["quality"] == 0]
    assert len(good) > 1000 and len(bad) > 100
    assert np.mean(good) > 0.99 and np.mean(bad) > 0.7
    assert any(0 < r["n_content_lines"] < r["n_lines"] for r in rows)
    prose = docs.join(labels.where(held & (F.col("quality") == 1)), "doc_id").orderBy("doc_id").limit(200).collect()
    lines = [line for r in prose for line in (r["text"] or "").split("\n") if len(line.split()) > 5]
    lost = found = 0
    for n in range(0, 300, 3):
        mixed = [lines[n], JUNK.format("lamp", n), JUNK.format("stone", n) * 2, lines[n + 1], lines[n + 2]]
        got = field.decode(lq.lines_of("\n".join(mixed))[0])
        lost, found = lost + got[[0, 3, 4]].sum(), found + got[[1, 2]].sum()
    assert lost <= 30 and found >= 160
