"""Quality by line labels: a linear-chain conditional random field marks content and boilerplate.

Each line of a text is described by its words, signs, letter case, digits, end and whether it
repeats an earlier line. Viterbi decoding gives each line a label in the light of its neighbours; the
share of bytes in content lines decides whether the document stays.

Only documents have labels, so the labels of lines are learnt (hard expectation maximisation). At first a field without
transitions tells the lines of good documents from those of bad ones, line by line. Then decoding and refitting take
turns, ``ROUNDS`` times: a run of lines takes its likeliest labels among those that agree with its document's label, which is that at
least half of the bytes are content in a good one and less than half in a bad one. More rounds would let the transitions
confirm themselves until every document has one label throughout. The field is fitted by gradient ascent on at most ``PER_CLASS`` documents
of either quality label, cut into runs of lines (``RUNS`` of them at most, by checksum).

Defined results: a NULL text has no words and fails the base rules; a text without lines of words has a
content share of 0; without labels of both kinds every line is content. A tie of labels is content. A document labelled more than
once has its least label; rows of one doc_id are judged each by itself, and all of them are in the sample if their id is. A text is
held whole by one task, with some 130 bytes for each of its lines.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeload.storage import materialize

#: Documents of either label the field is fitted on, at most; and runs of lines from them, at most.
PER_CLASS = 400
RUNS, RUN = 3000, 40
#: How often the labels of lines are taken for granted and the field fitted to them.
ROUNDS = 2
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\r\x0b\x0c"
UPPER = bytes(range(65, 91))
DIGITS = b"0123456789"
MARKS = b"!?@=_{}[]~^\\/"
CONTINUED = bytes(range(128, 192))
N_FEATURES = 14


def base_counts(text: str | None) -> dict[str, int]:
    """Words, their code points, signs, repeated lines and words in repeated windows of five."""
    body = text.encode() if isinstance(text, str) else b""
    words = body.split()
    repeated = 0
    windows = list(zip(words, words[1:], words[2:], words[3:], words[4:], strict=False))
    if len(set(windows)) < len(windows):
        times = Counter(windows)
        until = 0
        for n, window in enumerate(windows):
            if times[window] > 1:
                repeated += n + 5 - max(until, n)
                until = n + 5
    seen: set[bytes] = set()
    dup_lines = 0
    for line in body.split(b"\n"):
        if line in seen:
            dup_lines += 1
        elif line.strip(SPACES):
            seen.add(line)
    return {
        "n_words": len(words),
        "word_chars": len(body.translate(None, SPACES + CONTINUED)),
        "n_symbols": len(body) - len(body.translate(None, SYMBOLS)),
        "n_dup_lines": dup_lines,
        "n_repeat_words": repeated,
    }


def lines_of(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Features of the lines with a word, and the number of their bytes."""
    rows, sizes, seen = [], [], set()
    for line in (text.encode() if isinstance(text, str) else b"").split(b"\n"):
        line = line.strip(SPACES)
        if not line:
            continue
        size, words = len(line), line.count(b" ") + 1
        signs = size - len(line.translate(None, SYMBOLS))
        marks = size - len(line.translate(None, MARKS))
        upper = size - len(line.translate(None, UPPER))
        digits = size - len(line.translate(None, DIGITS))
        again = line in seen
        seen.add(line)
        rows.append(
            (
                1.0, words < 3, 3 <= words < 6, words >= 12, signs > 0, min(1.0, 10 * signs / size), signs > words / 2,
                min(1.0, 20 * marks / size), upper > 0.5 * size, upper / size, min(1.0, 5 * digits / size),
                line[-1] in b".!?", again, size > 8 * words,
            )
        )
        sizes.append(size)
    return np.array(rows, np.float64).reshape(-1, N_FEATURES), np.array(sizes, np.int64)


class Field:
    """Linear-chain conditional random field over two labels: 0 content, 1 boilerplate."""

    def __init__(self, emit: np.ndarray, step: np.ndarray):
        self.emit, self.step = emit, step  # features x 2, 2 x 2

    def decode(self, x: np.ndarray) -> np.ndarray:
        """The likeliest labels (Viterbi); content wins ties."""
        score = (x @ self.emit).tolist()
        if not score:
            return np.zeros(0, np.int64)
        (s00, s01), (s10, s11) = self.step.tolist()
        a, b = score[0]
        came = []
        for e0, e1 in score[1:]:
            from_a, from_b = a + s00, b + s10
            to_a, to_b = a + s01, b + s11
            came.append((from_a < from_b, to_a < to_b))
            a, b = (from_b if from_a < from_b else from_a) + e0, (to_b if to_a < to_b else to_a) + e1
        label = int(b > a)
        labels = [label]
        for back in reversed(came):
            label = int(back[label])
            labels.append(label)
        return np.array(labels[::-1])


class Runs:
    """Runs of lines side by side, padded to the longest: what the likelihood is summed over."""

    def __init__(self, sequences: list[np.ndarray]):
        longest = max(len(s) for s in sequences)
        self.x = np.zeros((len(sequences), longest, N_FEATURES))
        self.mask = np.zeros((len(sequences), longest), bool)
        for n, s in enumerate(sequences):
            self.x[n, : len(s)], self.mask[n, : len(s)] = s, True

    def gradient(self, labels: list[np.ndarray], field: Field) -> tuple[float, np.ndarray, np.ndarray]:
        """Log-likelihood of the labels and its slopes by ``emit`` and ``step``, from forward and backward sums."""
        x, mask, step = self.x, self.mask, field.step
        longest = mask.shape[1]
        truth, pairs = np.zeros((*mask.shape, 2)), np.zeros((2, 2))
        for n, y in enumerate(labels):
            truth[n, np.arange(len(y)), y] = 1
            np.add.at(pairs, (y[:-1], y[1:]), 1)
        e = x @ field.emit
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[:, 0] = e[:, 0]
        for t in range(1, longest):
            new = np.logaddexp(alpha[:, t - 1, :1] + step[0], alpha[:, t - 1, 1:] + step[1]) + e[:, t]
            alpha[:, t] = np.where(mask[:, t, None], new, alpha[:, t - 1])
        for t in range(longest - 2, -1, -1):
            after = e[:, t + 1] + beta[:, t + 1]
            new = np.logaddexp(step[:, 0] + after[:, :1], step[:, 1] + after[:, 1:])
            beta[:, t] = np.where(mask[:, t + 1, None], new, 0)
        total = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
        node = np.exp(alpha + beta - total[:, None, None]) * mask[:, :, None]
        after = (e + beta)[:, 1:]
        edge = np.exp(alpha[:, :-1, :, None] + step + after[:, :, None, :] - total[:, None, None, None])
        edge = (edge * mask[:, 1:, None, None]).sum((0, 1))
        likelihood = (e * truth).sum() + (pairs * step).sum() - total.sum()
        return float(likelihood), np.einsum("ntf,ntl->fl", x, truth - node), pairs - edge


def fit_field(runs: Runs, labels: list[np.ndarray], chained: bool = True, steps: int = 60, ridge: float = 1e-3) -> Field:
    """The field under which these labels of the lines are likeliest; without transitions if not ``chained``."""
    weight = 1 / runs.mask.sum()
    emit, step = np.zeros((N_FEATURES, 2)), np.zeros((2, 2))
    square_e, square_s = np.full_like(emit, 1e-8), np.full_like(step, 1e-8)
    for _ in range(steps):
        _, g_e, g_s = runs.gradient(labels, Field(emit, step))
        g_e, g_s = g_e * weight - ridge * emit, (g_s * weight - ridge * step) * chained
        square_e, square_s = square_e + g_e**2, square_s + g_s**2
        emit, step = emit + 0.5 * g_e / np.sqrt(square_e), step + 0.5 * g_s / np.sqrt(square_s)
    return Field(emit, step)


def agreeing(field: Field, x: np.ndarray, sizes: np.ndarray, bad: bool) -> np.ndarray:
    """The likeliest labels of lines that agree with the label of their document.

    Where they do not agree on their own, the label that is missing gets the least bonus, the same on every line, with which they do.
    """

    def agree(labels: np.ndarray) -> bool:
        return bool(2 * sizes[labels == 0].sum() < sizes.sum()) == bad

    best = field.decode(x)
    if agree(best):
        return best
    low, high, best = 0.0, 64.0, np.full(len(x), int(bad))
    for _ in range(12):
        bonus = (low + high) / 2
        emit = field.emit.copy()
        emit[0, int(bad)] += bonus  # The first feature is 1 on every line.
        labels = Field(emit, field.step).decode(x)
        if agree(labels):
            best, high = labels, bonus
        else:
            low = bonus
    return best


def learn(sequences: list[np.ndarray], sizes: list[np.ndarray], bad: list[bool], rounds: int = ROUNDS) -> Field:
    """A field learnt from runs of lines of which only the document's label is known."""
    runs = Runs(sequences)
    field = fit_field(runs, [np.full(len(s), int(b)) for s, b in zip(sequences, bad, strict=True)], chained=False)
    for _ in range(rounds):
        field = fit_field(runs, [agreeing(field, *run) for run in zip(sequences, sizes, bad, strict=True)])
    return field


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Field:
    marked = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = None
    for label in (0, 1):
        part = marked.filter(F.col("quality") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for quality, text in zip(batch["quality"].array, batch["text"].array, strict=True):
                x, sizes = lines_of(text)
                for n in range(0, len(x), RUN):
                    run = x[n : n + RUN]
                    rows.append((quality, zlib.crc32(run.tobytes()), run.ravel(), sizes[n : n + RUN]))
            yield pd.DataFrame(rows, columns=["quality", "at", "rows", "sizes"])

    runs = docs.select("doc_id", "text").join(chosen, "doc_id").mapInPandas(describe, "quality int, at long, rows array<double>, sizes array<long>")
    sampled = materialize(runs.orderBy("at", "quality", "rows", "sizes").limit(RUNS), "line-sample")
    found = [(r["quality"] <= 0, np.array(r["rows"]).reshape(-1, N_FEATURES), np.array(r["sizes"])) for r in sampled.collect()]
    found.sort(key=lambda f: (f[0], len(f[1]), f[1].tobytes(), f[2].tobytes()))
    if len({bad for bad, _, _ in found}) < 2:
        return Field(np.array([[1.0, 0.0]] + [[0.0, 0.0]] * (N_FEATURES - 1)), np.zeros((2, 2)))
    bad, sequences, sizes = zip(*found, strict=True)
    return learn(list(sequences), list(sizes), list(bad))


def judge_lines(docs: DataFrame, field: Field, content_share: float = 0.5) -> DataFrame:
    """Per document: doc_id, base counts, base_failed, n_lines, n_content_lines, content_share, kept, labels.

    ``labels`` has one number per line with a word: 0 content, 1 boilerplate.
    """
    schema = (
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
        " base_failed boolean, n_lines long, n_content_lines long, content_share double, kept boolean, labels array<int>"
    )

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].array, batch["text"].array, strict=True):
                base = base_counts(text)
                failed = base["n_words"] < 10 or 100 * base["n_repeat_words"] > 20 * base["n_words"]
                x, sizes = lines_of(text)
                found = field.decode(x)
                share = float(sizes[found == 0].sum() / sizes.sum()) if len(sizes) else 0.0
                rows.append(
                    {"doc_id": doc_id, **base, "base_failed": failed, "n_lines": len(found)}
                    | {"n_content_lines": int((found == 0).sum()), "content_share": share}
                    | {"kept": not failed and share >= content_share, "labels": found.astype(np.int32)}
                )
            made = pd.DataFrame(rows)
            if len(made):
                made["doc_id"] = made["doc_id"].astype("Int64")
                yield made

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(judge, schema)


def line_quality(docs: DataFrame, labels: DataFrame, content_share: float = 0.5) -> DataFrame:
    return judge_lines(docs, fit(docs, labels), content_share)
