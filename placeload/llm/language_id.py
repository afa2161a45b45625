"""Language identification in two steps: the family first, then the language within it.

Texts become hashed byte trigrams of their letters (square roots of shares). Linear support
vector machines, one for each family against the rest, choose the family by the largest margin; one for each pair of its
languages, trained on these two alone, votes for the language. They are fitted on at most
``PER_LANGUAGE`` rows of each of the ``LANGUAGES`` most frequent languages, chosen by hash of the id, rows of one id by place.

Defined results: ties go to the larger sum of margins, then to the first in the alphabet; rows with the same id are rows
of their own; texts of any length are read as a whole, with about thirty bytes of working memory for each of theirs; a NULL text or one without a letter is ``und`` with score 0, as is every text if
nothing could be learned; equal texts get equal results; a language without a known family is a family of its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeload.llm.common import first_by, id_remainder, located, placed
from placeload.storage import materialize

#: Rows of each language the classifiers are fitted on, at most.
PER_LANGUAGE = 500
#: Languages that are learned, those with the most rows, at most.
LANGUAGES = 400
#: Families of languages by code.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz",
    "indic": "hi bn ur mr gu pa ne",
    "sinitic": "zh yue",
}
FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
BITS = 12
WIDTH = 1 << BITS
LETTERISH = re.compile(r"[^\W\d_]")

# Bytes below 128 that are no letters separate words; the others stand for themselves.
BYTES = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], np.uint32)


def has_letter(text: str) -> bool:
    return any(found[0].isalpha() for found in LETTERISH.finditer(text))


def trigram_counts(text: str) -> np.ndarray:
    b = BYTES[np.frombuffer(f" {text.lower()} ".encode(), np.uint8)]
    key = (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761)
    return np.bincount(key >> np.uint32(32 - BITS), minlength=WIDTH)


def described(counts: np.ndarray) -> np.ndarray:
    return np.sqrt(counts / max(1, counts.sum()))


def fit_svm(x: np.ndarray, positive: np.ndarray, c: float = 30.0, steps: int = 150) -> tuple[np.ndarray, float, float]:
    """Linear SVM with squared hinge loss; also the scale that makes a probability of its margin."""
    y = np.where(positive, 1.0, -1.0)
    weight = np.where(positive, 0.5 / max(1, positive.sum()), 0.5 / max(1, (~positive).sum()))
    data = np.hstack([x, np.ones((len(x), 1))])
    rate = 1.0 / (1.0 + 2 * c * 2.0)
    w, v, t = np.zeros(data.shape[1]), np.zeros(data.shape[1]), 1.0
    for _ in range(steps):
        slack = np.maximum(0, 1 - y * (data @ v))
        new = v - rate * (v - 2 * c * (data.T @ (weight * y * slack)))
        s = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, w, t = new + (t - 1) / s * (new - w), new, s
    margin = y * (data @ w)
    scales = np.array([0.5, 1, 2, 4, 8])
    loss = [np.log1p(np.exp(-np.clip(k * margin, -40, 40))) @ weight for k in scales]
    return w[:-1], float(w[-1]), float(scales[int(np.argmin(loss))])


class Machines:
    """One linear machine for each pair of classes; the class with the most votes wins, then the larger margins."""

    def __init__(self, x: np.ndarray, names: np.ndarray):
        self.classes = sorted(set(names))
        self.pairs = list(combinations(range(len(self.classes)), 2))
        fitted = []
        for a, b in self.pairs:
            among = np.isin(names, [self.classes[a], self.classes[b]])
            fitted.append(fit_svm(x[among], names[among] == self.classes[a]))
        self.weights = np.array([f[0] for f in fitted]).reshape(-1, x.shape[1])
        self.bias = np.array([f[1] for f in fitted])
        self.scale = np.array([f[2] for f in fitted])

    def predict(self, x: np.ndarray) -> tuple[str, float]:
        if not self.pairs:
            return self.classes[0], 1.0
        sure = 1 / (1 + np.exp(-np.clip(self.scale * (self.weights @ x + self.bias), -40, 40)))
        votes, total = np.zeros(len(self.classes)), np.zeros(len(self.classes))
        for (a, b), p in zip(self.pairs, sure, strict=True):
            votes[a if p >= 0.5 else b] += 1
            total[a] += p
            total[b] += 1 - p
        best = max(range(len(self.classes)), key=lambda n: (votes[n], total[n]))
        return self.classes[best], float(total[best] / (len(self.classes) - 1))


class Rest:
    """One linear machine for each class against all others; the largest probability wins, the first of equal ones."""

    def __init__(self, x: np.ndarray, names: np.ndarray):
        self.classes = sorted(set(names))
        fitted = [fit_svm(x, names == c) for c in self.classes] if len(self.classes) > 1 else []
        self.weights = np.array([f[0] for f in fitted]).reshape(-1, x.shape[1])
        self.bias, self.scale = np.array([f[1] for f in fitted]), np.array([f[2] for f in fitted])

    def predict(self, x: np.ndarray) -> tuple[str, float]:
        if len(self.classes) == 1:
            return self.classes[0], 1.0
        sure = 1 / (1 + np.exp(-np.clip(self.scale * (self.weights @ x + self.bias), -40, 40)))
        best = int(sure.argmax())
        return self.classes[best], float(sure[best])


class Identifier:
    def __init__(self, x: np.ndarray, langs: np.ndarray):
        families = np.array([FAMILY.get(lang.lower(), lang) for lang in langs], object)
        self.family = Rest(x, families)
        self.within = {f: Machines(x[families == f], langs[families == f]) for f in self.family.classes}

    def predict(self, text: str | None) -> tuple[str, float]:
        if not isinstance(text, str) or not has_letter(text):
            return "und", 0.0
        x = described(trigram_counts(text))
        family, p = self.family.predict(x)
        lang, q = self.within[family].predict(x)
        return lang, p * q


def sample(docs: DataFrame, per_language: int, languages: int) -> DataFrame:
    """Rows to learn from: lang and text. At most ``per_language`` of each, whatever ids repeat.

    Rows are chosen by hash of the id, then by place; a read of ids and languages finds their places.
    """
    docs = placed(docs.select("doc_id", "text", "lang"))
    learning = docs.filter("lang IS NOT NULL AND text IS NOT NULL").filter(id_remainder("doc_id", 5) != 0)
    rows = located(learning, "doc_id", "lang")
    common = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).select("lang")
    chosen = first_by(rows, "lang", per_language, F.xxhash64("doc_id"), "doc_id", "file", "pos").join(common, "lang", "left_semi")
    chosen = materialize(chosen.select("file", "pos"), "language-places")
    return located(learning, "lang", "text").join(chosen, ["file", "pos"]).select("lang", "text")


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, languages: int = LANGUAGES) -> Identifier | None:
    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for lang, text in zip(batch["lang"].array, batch["text"].array, strict=True):
                counts = trigram_counts(text) if has_letter(text) else np.zeros(0, np.int64)
                at = counts.nonzero()[0]
                rows.append((lang, at.astype(np.int32), counts[at].astype(np.int32)))
            yield pd.DataFrame(rows, columns=["lang", "at", "n"])

    rows = sample(docs, per_language, languages).mapInPandas(describe, "lang string, at array<int>, n array<int>")
    rows = materialize(rows, "language-sample").collect()  # bounded: rows per language times languages times WIDTH
    rows = sorted((r for r in rows if r["at"]), key=lambda r: (r["lang"], r["at"], r["n"]))
    if not rows:
        return None
    x = np.zeros((len(rows), WIDTH), np.float32)
    for n, row in enumerate(rows):
        x[n, row["at"]] = row["n"]
        x[n] = described(x[n])
    return Identifier(x, np.array([r["lang"] for r in rows], object))


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score."""
    model = fit(docs, per_language)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        found = [model.predict(t) if model else ("und", 0.0) for t in texts.array]
        return pd.DataFrame(found, columns=["lang_pred", "score"])

    return docs.select(
        "doc_id", (id_remainder("doc_id", 5) == 0).alias("held_out"), predict("text").alias("found")
    ).select("doc_id", "held_out", "found.lang_pred", "found.score")
