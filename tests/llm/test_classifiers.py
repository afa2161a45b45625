"""Classifiers: restoration against all readings, fits against their conditions, samples within their bounds."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from placeload.llm import language_id, toxicity

ROWS = "doc_id long, text string, lang string, _metadata string, rank int, file string"


def row(i, text, lang=None):
    return (i, text, lang, "m", 1, "f")


@pytest.fixture(scope="module")
def restorer():
    draw = random.Random(2)
    counts = np.zeros(toxicity.SIDE**3, np.int64)
    words = ["idiot", "loser", "trash", "stone", "river", "moss", "good", "it", "is"]
    for _ in range(400):
        c = [0, 0, *toxicity.classes(" ".join(draw.choices(words, k=6))).tolist(), 0]
        for a, b, x in zip(c, c[1:], c[2:], strict=False):
            counts[(a * toxicity.SIDE + b) * toxicity.SIDE + x] += 1
    return toxicity.Restorer(toxicity.log_model(counts))


def all_readings(restorer, word, single=False):
    """The best score of all ways through the lattice, each scored as a whole."""
    runs = [(k, len(list(g))) for k, g in itertools.groupby(word)]
    at, ways = 0, []
    for sign, n in runs:
        ways.append(restorer._choices(sign, n, 0 < at and at + n < len(word), single))
        at += n
    best = {}
    for way in itertools.product(*ways):
        text = "".join(t for t, _ in way)
        score, a, b = sum(c for _, c in way), 0, 0
        for c in [*toxicity.classes(text).tolist(), 0]:
            score += restorer.model[a][b][c]
            a, b = b, c
        best[text] = max(best.get(text, -np.inf), score)
    return best


@pytest.mark.parametrize("word", ["1d10t", "l0$er", "tr@sh", "i.d.i.o.t", "iiidiot", "m0oss", "s-t*o#n%e", "g00d", "!d!0t", "1s", "$$$", "a", "|055", "i d i o t", "5t0ne5", "riiiver"])
@pytest.mark.parametrize("single", [False, True])
def test_restoration_is_the_best_of_all_readings(restorer, word, single):
    scores = all_readings(restorer, word, single)
    best = max(scores.values())
    assert scores[restorer.restore(word, single)] >= best - 1e-6


def test_sparse_fit_meets_its_conditions():
    """Where there is a weight the errors of its rows add up to the penalty; where there is none, to no more."""
    draw = np.random.default_rng(1)
    found = [sorted(set(draw.integers(0, 12, 4).tolist())) for _ in range(300)]
    y = np.array([float(0 in f or (3 in f and draw.random() < 0.7)) for f in found])
    weight = np.full(300, 1 / 300)
    for l1 in (0.004, 0.02):
        w, b = toxicity.fit_sparse(found, y, weight, 12, l1, steps=6000)
        z = np.array([b + w[f].sum() for f in found])
        errors = weight * (y - 1 / (1 + np.exp(-z)))
        pull = np.array([sum(e for e, f in zip(errors, found, strict=True) if n in f) for n in range(12)])
        assert w[0] > 0 and abs(errors.sum()) < 1e-3
        assert np.allclose(pull[w != 0], l1 * np.sign(w[w != 0]), atol=1e-3) and (abs(pull[w == 0]) <= l1 + 1e-3).all()
    assert not toxicity.fit_sparse(found, y, weight, 12, 10.0)[0].any()


def test_machine_against_a_plain_fit():
    """The squared hinge loss of a fitted machine is that of a plain descent."""
    draw = np.random.default_rng(3)
    x = draw.normal(0, 0.3, (80, 6))
    positive = x[:, 0] + 0.2 * draw.normal(size=80) > 0.1
    w, b, _ = language_id.fit_svm(x, positive, c=5.0, steps=2000)

    y = np.where(positive, 1.0, -1.0)
    weight = np.where(positive, 0.5 / positive.sum(), 0.5 / (~positive).sum())

    def loss(w, b):
        return 0.5 * (w @ w + b * b) + 5.0 * weight @ np.maximum(0, 1 - y * (x @ w + b)) ** 2

    v = np.zeros(7)
    for _ in range(20000):
        slack = np.maximum(0, 1 - y * (x @ v[:6] + v[6]))
        g = v - 10.0 * np.append(x.T @ (weight * y * slack), weight @ (y * slack))
        v -= 0.02 * g
    assert loss(w, b) <= loss(v[:6], v[6]) * 1.001


@pytest.fixture
def hot(spark, tmp_path):
    """3,000 rows of one id, and a few others, some NULL."""
    given = [row(4, f"das ist wort {n} und mehr", "de") for n in range(3000)] + [row(i, f"the word {i} and more", "en") for i in range(1000, 1040)]
    given += [row(None, "one more", "en"), row(7, None, "en"), row(8, "x", None), row(9, "", "fr")]
    spark.createDataFrame(given, ROWS).repartition(4).write.parquet(str(tmp_path / "hot"))
    return spark.read.parquet(str(tmp_path / "hot"))


@pytest.mark.parametrize("stored", [True, False])
def test_samples_keep_their_bounds(spark, hot, stored):
    """Rows are bounded, not ids."""
    docs = hot if stored else hot.withColumn("lang", F.col("lang"))
    rows = language_id.sample(docs, 5, 400).groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in rows} == {"de": 5, "en": 5, "fr": 1}
    assert language_id.sample(docs, 5, 1).select("lang").distinct().collect()[0][0] == "de"
    labels = [(4, 1, 1), (4, 0, 0), (None, 1, 1), (5000, 1, 1), *((i, 1, 0) for i in range(1000, 1040)), (8, 1, None)]
    marked = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    sampled = toxicity.sample(docs, marked, 5).groupBy("toxic").count().collect()
    assert {r["toxic"]: r["count"] for r in sampled} == {1: 5, 0: 5}


def test_fits_on_hard_rows(spark, hot):
    labels = spark.createDataFrame([(4, 1, 1), (4, 1, 1), (9, 1, 0), (None, 0, 1), (1001, 1, 0), (1002, None, None)], "doc_id long, quality int, toxic int")
    scored = toxicity.score_toxicity(hot, labels).collect()
    assert len(scored) == hot.count() and all(0 <= r["score"] <= 1 for r in scored)
    found = language_id.identify(hot).collect()
    assert len(found) == hot.count() and {r["lang_pred"] for r in found} <= {"de", "en", "fr", "und"}
    long = spark.createDataFrame([row(1, "the word and more " * 200_000), row(2, "1d10t" * 200_000), row(3, " ")], ROWS)
    assert len(toxicity.score_toxicity(long, labels).collect()) == len(language_id.identify(long).collect()) == 3


def test_families_against_the_rest():
    """As many machines as families, so the model does not grow with the square of the languages."""
    draw = np.random.default_rng(5)
    langs = np.array([f"l{n % 30}" for n in range(300)], object)
    x = draw.normal(0, 0.1, (300, 40)).astype(np.float32)
    x[np.arange(300), np.arange(300) % 30] += 2.0
    model = language_id.Rest(x, langs)
    assert len(model.weights) == 30
    assert sum(model.predict(v)[0] == lang for v, lang in zip(x, langs, strict=True)) > 290
    assert language_id.Rest(x, np.array(["one"] * 300, object)).predict(x[0]) == ("one", 1.0)


@pytest.mark.parametrize("languages", [3, 12])
def test_reads_do_not_grow_with_the_languages(spark, tmp_path, languages):
    given = [row(n, f"w{n % 7} text", f"x{n % languages}") for n in range(240)]
    spark.createDataFrame(given, ROWS).write.parquet(str(tmp_path / "l"))
    spark.sparkContext.setJobGroup(f"languages-{languages}", "sample")
    try:
        language_id.sample(spark.read.parquet(str(tmp_path / "l")), 4, 400).count()
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"languages-{languages}"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 15


def test_words_without_weight_are_not_described(restorer, monkeypatch):
    """Plain words skip the lattice and words that no weight begins their features; scores are those of all features."""
    weights = {"idiot": 2.0, "^idio": 0.5, "^losers": 0.25, "ab": 0.125, "trash": -1.0, "^stone": 0.75}
    plain = [f"{a}{b}{c}" for a, b, c in itertools.permutations("bcdegkmprt", 3)]
    draw = random.Random(4)
    odd = ["1d10t", "idiots!!!", "(loserss)", "ab", "abc", "ßtoné", "stonés,", "tr@sh$$$", "iidiot", "日本", "x²½", "a_b", "...", "42", "stoney"]
    texts = [" \t".join(draw.choices(odd + plain, k=9)) for _ in range(300)] + ["i d i o t x", "a  b\x1cc", " a b ", "", None]

    def all_features(text):
        text = (text or "").lower()
        words = {w for t in toxicity.WORD.findall(text) for w in restorer.token(t)} | set(restorer.spaced(text))
        hits = sorted({f for w in words for f in toxicity.features(w)} & weights.keys())
        return 1 / (1 + np.exp(-(-1.0 + sum(weights[f] for f in hits))))

    expected = [all_features(t) for t in texts]
    scorer = toxicity.Scorer(np.array(restorer.model, np.float32), weights, -1.0)
    assert [scorer.score(t) for t in texts] == expected
    monkeypatch.setattr(toxicity.Scorer, "REMEMBERED", 300)
    assert [scorer.score(t) for t in texts] == expected
    calls = []
    monkeypatch.setattr(toxicity, "features", lambda word: calls.append(word) or [])
    monkeypatch.setattr(toxicity.Restorer, "readings", lambda *given: calls.append(given) or [])
    toxicity.Scorer(np.array(restorer.model, np.float32), weights, -1.0).score(" ".join(plain))
    assert not calls


def test_trigrams_are_counted_within_each_text(spark):
    texts = ["ab", "", None, "Äb c日", "ab"]
    counts = np.zeros((toxicity.SIDE,) * 3, np.int64)
    for text in filter(None, texts):
        c = [0, 0, *toxicity.classes(text.lower()).tolist(), 0]
        for at in zip(c, c[1:], c[2:], strict=False):
            counts[at] += 1
    found = toxicity.trigram_counts(spark.createDataFrame([row(n, t) for n, t in enumerate(texts)], ROWS))
    assert (found.reshape(counts.shape) == counts).all()
