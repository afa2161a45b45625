"""Toxicity by noisy-channel restoration of disguised words.

A character trigram model is counted over the whole corpus. Words that a disguise could have
made (digits or signs among letters, repeated letters, letters apart by signs or blanks)
become a lattice of what each sign may stand for; Viterbi decoding under model and channel
picks the restored word, whatever the length. Where a disguise has several readings (a token as a whole and its
parts between signs, letters that occur twice as two and as one, letters apart by unlike blanks), the words of
all of them count, so that no reading hides another. The model knows the letters of Latin-1; words of other
scripts count as they are written, nothing in them is restored. A sparse logistic regression on the restored words and their
first letters gives the score. Of the sample's features those may have a weight that 0.4 per cent of its toxic rows have (two at
least), three times as often as the others, the 4,000 most frequent of these. It is fitted on a bounded sample of the labelled rows
(``PER_CLASS`` of either label, by hash of the id, rows of one id by place); all else covers all data.

Defined results: rows with the same id are rows of their own; texts of any length are read as a whole, word by word; NULL and empty texts score the base rate; a doc_id that is NULL counts as an
empty text in the hold-out rule; rows with several labels train with the largest; without labels of both kinds
every score is 0.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeload.llm.common import chunks, first_by, id_remainder, located, placed, unused
from placeload.storage import materialize

#: Labelled rows of either label the classifier is fitted on, at most.
PER_CLASS = 3000
#: Letters that a sign may stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "li", "+": "t", "€": "e", "(": "c",
}
#: Log probabilities of the channel: a sign for a letter, a sign kept, a sign or blank put between letters, a repetition.
SWAP, KEEP, BETWEEN, REPEAT = -1.5, -4.0, -1.0, -0.7
WORD = re.compile(r"\S+")
#: Signs that part words, and those that stay inside one; both may stand between letters or between words.
PARTING = "#%&*\"[]<>{}=~^`"
PARTED = re.compile(rf"[^{re.escape(PARTING)}]+")
JOINED = re.compile(r"[^.,;:/_\-|'’?]+")
SPACED = re.compile(r"(?<!\S)(?:\S\s++){2,}\S(?!\S)")
DISGUISED = re.compile(rf"[0-9@$!|+€(]|([^\W\d_])\1\1|[^\W\d_][._\-{re.escape(PARTING)}][^\W\d_][._\-{re.escape(PARTING)}]")
TWICE = re.compile(r"([^\W\d_])\1")
OUTER = ".,;:!?'’)-_/" + PARTING
OPENING = OUTER.replace("!", "")
#: In every text with letters that stand apart: a sign by itself, and one more after it.
APART = re.compile(r"\s\S\s++\S(?!\S)")
BLANKS = re.compile(r"\s+")
LETTER = re.compile(r"[^\W\d_]+")

# Characters of the model: Latin-1 letters in lower case, everything else is a gap.
CLASSES = np.zeros(256, np.int64)
for _n, _c in enumerate([*range(97, 123), *range(0xDF, 0xF7), *range(0xF8, 0x100)]):
    CLASSES[_c] = _n + 1
SIDE = 64


def classes(text: str) -> np.ndarray:
    return CLASSES[np.frombuffer(text.encode("latin-1", "replace"), np.uint8)]


def trigrams(text: str) -> np.ndarray:
    c = np.concatenate([[0, 0], classes(text), [0]])
    return (c[:-2] * SIDE + c[1:-1]) * SIDE + c[2:]


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """How often each trigram occurs in all texts; at most SIDE ** 3 numbers reach the driver."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(SIDE**3, np.int64)
        for batch in batches:
            found = (trigrams(text.lower()) for text in batch["text"].array if isinstance(text, str) and text)
            for several in chunks(found, len, 1 << 20):
                total += np.bincount(np.concatenate(several), minlength=SIDE**3)
        at = total.nonzero()[0]
        yield pd.DataFrame({"trigram": at, "n": total[at]})

    counts = np.zeros(SIDE**3, np.int64)
    rows = docs.select("text").mapInPandas(count, "trigram long, n long").groupBy("trigram").agg(F.sum("n").alias("n"))
    for trigram, n in rows.collect():
        counts[trigram] = n
    return counts


def log_model(counts: np.ndarray) -> np.ndarray:
    """Log probability of a character after two others, smoothed by the shorter contexts."""
    three = counts.reshape(SIDE, SIDE, SIDE).astype(np.float64)
    two, one = three.sum(0), three.sum((0, 1))
    p1 = (one + 1) / (one.sum() + SIDE)
    p2 = (two + 5 * p1) / (two.sum(1, keepdims=True) + 5)
    return np.log((three + 5 * p2) / (three.sum(2, keepdims=True) + 5)).astype(np.float32)


class Restorer:
    """Viterbi decoding of words under a character model."""

    def __init__(self, model: np.ndarray):
        self.model = model.tolist()
        self.once: dict[str, str] = {}

    def _choices(self, sign: str, run: int, inner: bool, single: bool) -> list[tuple[str, float]]:
        if sign == " ":
            return [(" ", -2.0), ("", BETWEEN)]
        if sign.isalpha():
            if run < 3:
                return [(sign * run, 0.0), (sign, REPEAT)] if single and run == 2 else [(sign * run, 0.0)]
            return [(sign, REPEAT), (sign * 2, 2 * REPEAT), (sign * run, KEEP * (run - 2))]
        found = [(sign, KEEP * run)]
        for letter in STANDS_FOR.get(sign, ""):
            found += [(letter * n, SWAP * n) for n in {1, min(run, 2)}]
        if inner and (sign in "._-'|+" or sign in PARTING):
            found.append(("", BETWEEN))
        if run >= 2 and sign in "$!|+":
            found.append(("", BETWEEN * 2))
        return found

    def restore(self, word: str, single: bool = False) -> str:
        """The likeliest plain form of a disguised word (in lower case); ``single``: letters that occur twice may be one."""
        best: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
        for found in re.finditer(r"(.)\1*", word, re.S):
            inner = 0 < found.start() and found.end() < len(word)
            after: dict[tuple[int, int], tuple[float, tuple]] = {}
            for text, channel in self._choices(found[1], len(found[0]), inner, single):
                codes = classes(text).tolist()
                for (a, b), (score, path) in best.items():
                    score += channel
                    for c in codes:
                        score += self.model[a][b][c]
                        a, b = b, c
                    if (a, b) not in after or after[a, b][0] < score:
                        after[a, b] = (score, (text, path))
            best = after
        _, path = max(((s + self.model[a][b][0], p) for (a, b), (s, p) in best.items()), key=lambda x: x[0])
        parts = []
        while path:
            parts.append(path[0])
            path = path[1]
        return "".join(parts[::-1])

    def readings(self, word: str, disguised: bool) -> list[str]:
        """Plain words of a lattice, then those it has only if letters that occur twice may be one."""
        found = LETTER.findall(self.restore(word) if disguised else word)
        if TWICE.search(word):
            found += further(found, LETTER.findall(self.restore(word, True) if disguised else TWICE.sub(self._once, word)))
        return found

    def _once(self, twice: re.Match) -> str:
        """The likelier of one letter and two, in a lattice without other arcs: the ways meet after the next character."""
        word, at = twice.string, twice.start()
        near = (word[at - 1] if at else " ") + twice[1] + word[at + 2 : at + 3]
        if near not in self.once:
            b, s, c = classes(near).tolist() if len(near) == 3 else [*classes(near).tolist(), 0]
            model = self.model
            self.once[near] = twice[1] if REPEAT + model[b][s][c] > model[b][s][s] + model[s][s][c] else twice[0]
        return self.once[near]

    def token(self, token: str) -> list[str]:
        """Plain words of a token as it stands in a text, then those that only its parts have."""
        token = token.rstrip(OUTER).lstrip(OPENING)
        if len(token) > 3 and token[-3:] == token[-1] * 3 and not token[-1].isalpha():
            token = token.rstrip(token[-1])
        if token.isalpha() and not TWICE.search(token):
            return [token]  # nothing to restore, and nothing but letters
        if not LETTER.search(token):
            return []
        disguised = DISGUISED.search(token) is not None
        found = self.readings(token, disguised)
        if disguised:
            parts = PARTED.findall(token)
            parts = parts if len(parts) > 1 else JOINED.findall(token)
            if len(parts) > 1:
                found += further(found, [w for p in parts if len(p) > 1 for w in self.token(p)])
        return found

    def spaced(self, text: str) -> list[str]:
        """Plain words of letters that stand apart, then those that only stretches apart by equal blanks have."""
        found = []
        if not APART.search(text):
            return found
        for run in SPACED.finditer(text):
            letters = run[0].split()
            found += LETTER.findall(self.restore(" ".join(letters)))
            begin, parts = 0, []
            for _, equal in itertools.groupby(BLANKS.findall(run[0])):
                end = begin + len(list(equal))
                parts.append(letters[begin : end + 1])
                begin = end
            if len(parts) > 1:
                found += further(found, [w for p in parts if len(p) > 2 for w in LETTER.findall(self.restore(" ".join(p)))])
        return found


def further(found: list[str], others: list[str]) -> list[str]:
    """Words of ``others`` that are not found yet."""
    known = set(found)
    return [w for w in dict.fromkeys(others) if w not in known]


def features(word: str) -> list[str]:
    return [word, *("^" + word[:n] for n in (4, 5, 6) if len(word) > n)]


class Scorer:
    """Weights of restored words, remembered for the tokens met lately."""

    #: Characters of the tokens remembered, and 64 for each.
    REMEMBERED = 32_000_000

    def __init__(self, model: np.ndarray, weights: dict[str, float], bias: float):
        self.restorer, self.weights, self.bias = Restorer(model), weights, bias
        #: First letters of all words that have a weight.
        self.begins = {f.removeprefix("^")[:4] for f in weights}
        #: Tokens with weights, and those without any.
        self.known: dict[str, tuple] = {}
        self.others: set[str] = set()
        self.size = 0

    def parts(self, words: list[str]) -> tuple:
        return tuple(f for w in words if w[:4] in self.begins for f in features(w) if f in self.weights)

    def look_up(self, token: str) -> tuple:
        """Weights of a token's words; it is remembered."""
        self.size += len(token) + 64
        if self.size > self.REMEMBERED:
            self.known.clear()
            self.others.clear()
            self.size = len(token) + 64
        parts = self.parts(self.restorer.token(token))
        if parts:
            self.known[token] = parts
        else:
            self.others.add(token)
        return parts

    def score(self, text: str | None) -> float:
        hits: set[str] = set()
        if isinstance(text, str) and text:
            text = text.lower()
            for token in set(text.split()) - self.others:
                hits.update(self.known.get(token) or self.look_up(token))
            hits.update(self.parts(self.restorer.spaced(text)))
        z = self.bias + sum(self.weights[f] for f in sorted(hits))
        return float(1 / (1 + np.exp(-min(max(z, -40), 40))))


def sample(docs: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """Labelled training rows, toxic and text: at most ``per_class`` of either label, whatever ids repeat.

    Ids are chosen by hash, then rows of these by hash and place.
    """
    docs = placed(docs.select("doc_id", "text"))
    marked = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    learning = marked.filter(id_remainder("doc_id", 4) != 2).filter("toxic IN (0, 1)")
    ids = first_by(learning, "toxic", per_class, F.xxhash64("doc_id"), "doc_id")
    rows = located(docs, "doc_id").join(ids, "doc_id")
    chosen = first_by(rows, "toxic", per_class, F.xxhash64("doc_id"), "doc_id", "file", "pos").select("file", "pos", "toxic")
    chosen = materialize(chosen, "toxic-places")
    return located(docs, "text").join(chosen, ["file", "pos"]).select("toxic", "text")


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Scorer:
    counts = labels.filter("toxic IS NOT NULL").filter(id_remainder("doc_id", 4) != 2).groupBy("toxic").count().collect()
    natural = {int(t): n for t, n in counts}
    model = log_model(trigram_counts(docs))

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restorer = Restorer(model)
        for batch in batches:
            found = []
            for text in batch["text"].array:
                text = text.lower() if isinstance(text, str) else ""
                words = {w for token in set(text.split()) for w in restorer.token(token)}
                words.update(restorer.spaced(text))
                found.append(sorted({f for w in words for f in features(w)}))
            yield pd.DataFrame({"toxic": batch["toxic"], "found": found})

    rows = materialize(
        sample(docs, labels, per_class).mapInPandas(describe, "toxic int, found array<string>"), "toxic-sample"
    )
    sizes = dict(rows.groupBy("toxic").count().collect())
    if not (sizes.get(0) and sizes.get(1) and natural.get(1)):
        return Scorer(model, {}, -40.0)
    one = (F.col("toxic") == 1).cast("int")
    useful = (
        rows.select(one.alias("toxic"), F.explode("found").alias("f"))
        .groupBy("f")
        .agg(F.sum("toxic").alias("with"), F.count(F.lit(1)).alias("docs"))
        .filter(f"with >= greatest(2, {0.004 * sizes[1]}) AND with / {sizes[1]} > 3 * (docs - with) / {sizes[0]}")
        .orderBy(F.desc("with"), "f")
        .limit(4000)
    )
    names = [r["f"] for r in useful.select("f").collect()]
    index = {f: n for n, f in enumerate(names)}

    def chosen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [[index[f] for f in fs if f in index] for fs in batch["found"]]
            yield pd.DataFrame({"toxic": batch["toxic"], "found": found})

    data = rows.mapInPandas(chosen, "toxic int, found array<int>").collect()
    data.sort(key=lambda r: (r["toxic"], r["found"]))
    y = np.array([r["toxic"] for r in data], np.float64)
    weight = np.where(y == 1, natural[1] / sizes[1], natural.get(0, 1) / sizes[0])
    weights, bias = fit_sparse([r["found"] for r in data], y, weight / weight.sum(), len(names))
    return Scorer(model, {f: float(w) for f, w in zip(names, weights, strict=True) if w}, bias)


def fit_sparse(found: list[list[int]], y: np.ndarray, weight: np.ndarray, width: int, l1: float = 4e-5, steps: int = 600):
    """Logistic regression with an L1 penalty by accelerated proximal gradient."""
    row = np.repeat(np.arange(len(found)), [len(f) for f in found])
    col = np.array([x for f in found for x in f], np.int64)
    most = max((len(f) for f in found), default=0) + 1
    rate = 4.0 / most * 4
    w, b = np.zeros(width), float(np.log((weight @ y + 1e-6) / (weight @ (1 - y) + 1e-6)))
    v, c, t = w.copy(), b, 1.0
    last = np.inf
    for _ in range(steps):
        z = c + np.bincount(row, v[col], len(found))
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        loss = -(weight * (y * np.log(p + 1e-12) + (1 - y) * np.log(1 - p + 1e-12))).sum() + l1 * np.abs(v).sum()
        if loss > last:
            rate, t, v, c = rate * 0.5, 1.0, w, b
            last = np.inf
            continue
        last = loss
        g = weight * (p - y)
        new = v - rate * np.bincount(col, g[row], width)
        new = np.sign(new) * np.maximum(np.abs(new) - rate * l1, 0)
        new_b = c - rate * g.sum()
        s = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = new + (t - 1) / s * (new - w), new_b + (t - 1) / s * (new_b - b)
        w, b, t = new, new_b, s
    return w, float(b)


_scorers: dict = {}


def score_column(scorer: Scorer, text: str = "text"):
    """The score of a text column."""
    settings = (scorer.restorer.model, scorer.weights, scorer.bias)
    model = np.array(settings[0], np.float32)
    weights, bias = settings[1:]
    name = (len(weights), bias, hash(tuple(sorted(weights.items()))), float(model.sum()))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        if name not in _scorers:
            _scorers.clear()
            _scorers[name] = Scorer(model, weights, bias)
        return pd.Series([_scorers[name].score(t) for t in texts.array], dtype="float64")

    return score(F.col(text))


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, per_class: int = PER_CLASS) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    scorer = fit(docs, labels, per_class)
    return docs.select(
        "doc_id", (id_remainder("doc_id", 4) == 2).alias("held_out"), score_column(scorer).alias("score")
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, per_class: int = PER_CLASS) -> DataFrame:
    """The rows of ``docs`` below the threshold, with all their columns."""
    scorer, score = fit(docs, labels, per_class), unused(docs, "score")
    return docs.withColumn(score, score_column(scorer)).filter(F.col(score) < threshold).drop(score)
