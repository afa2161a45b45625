"""Hard negatives by angular triangle filtering.

Vectors are scaled to whole numbers, ``floor(256 * x)``, and a score is their inner product. The index stores for every
row its norm and its angles to a few reference directions. For an anchor and a row with angles a and r to the same
direction, the angle between them is at least ``|a - r|`` and at most ``min(a + r, 2 pi - a - r)``; the narrowest such
interval of all directions, turned into cosines and multiplied by both norms, bounds the score. The angles are
widened by more than their rounding before, and the bounds after. The index is ordered by nearest direction and angle to
it, so runs of rows have narrow ranges of angles and norms: first whole runs are compared with an anchor, then the rows
of runs that are left. Only rows whose bounds overlap the window that an anchor looks for get the whole-number product.
The window of the positives is open above and has the least score of the best so far below; those of the negatives
are 30 to 90 per cent of each positive's score, narrowed likewise.

Anchors are a stated set and taken in blocks of bounded size; a block reads the index twice, once for its positives,
once for the negatives of each. Every task returns its best rows for each window, and a window function over those ranks.

Defined results: rows with a NULL label, vector or component, or a component that is not finite, take no part, nor does an
empty table give any row. Shorter vectors count as if filled with zeros; a vector of zeros has score 0 with all. Rows
with the same id are rows of their own; NULL ids come after all others of an equal score and are no anchors. Anchors
without positives, and positives without negatives, give no row. Scores beyond 64 bits are cut to the largest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placeload.llm.common import chunks, partitions
from placeload.storage import materialize

POSITIVES, NEGATIVES = 5, 10
#: Windows of the negatives, in per cent of the positive's score.
FROM, TO = 30, 90
#: Reference directions, chosen far apart from a sample of so many rows.
DIRECTIONS, SAMPLE = 8, 1024
#: Anchors of a block.
ANCHORS = 2048
#: Rows of a run, and pairs of anchors and rows bounded at once.
RUN, PAIRS = 512, 1 << 19
#: What angles are widened by, and bounds by this part of both norms.
WIDENED = 1e-6

LEAST, LARGEST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def whole(vector: list, width: int) -> np.ndarray:
    found = np.zeros(width)
    found[: len(vector)] = np.floor(256.0 * np.asarray(vector, np.float64))
    return found


def angles_to(vectors: np.ndarray, norms: np.ndarray, directions: np.ndarray) -> np.ndarray:
    unit = vectors / np.where(norms > 0, norms, 1.0)[:, None]
    return np.arccos(np.clip(unit @ directions.T, -1.0, 1.0))


def spread_out(vectors: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` directions of the vectors, each as far as can be from those before."""
    norms = np.linalg.norm(vectors, axis=1)
    unit = vectors[norms > 0] / norms[norms > 0, None]
    if not len(unit):
        return np.eye(1, vectors.shape[1])
    chosen, nearest = [0], unit @ unit[0]
    while len(chosen) < min(most, len(unit)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, unit @ unit[chosen[-1]])
    return unit[chosen]


def taking_part(rows: DataFrame, vector: str, shift_every: int = 7, labels: int = 10) -> DataFrame:
    """vec_id, label (moved on by one for ids that ``shift_every`` divides), vector; without rows that take no part."""
    values = F.col(vector).cast("array<double>")
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    moved = F.when(F.col("vec_id") % shift_every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    rows = rows.filter(F.col("label").isNotNull() & F.col(vector).isNotNull()).filter(~bad)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), moved.cast("long").alias("label"), values.alias("vector"))


def angular_index(rows: DataFrame, directions: int = DIRECTIONS) -> tuple[DataFrame, int]:
    """The rows (see ``taking_part``) with scaled vector, norm and angles, in runs of near angles; the vectors' length."""
    row = F.monotonically_increasing_id().alias("row")
    width = rows.agg(F.max(F.size("vector"))).first()[0] or 1
    sample = rows.orderBy(F.xxhash64("vector"), "vec_id").limit(SAMPLE).collect()
    chosen = spread_out(np.array([whole(r["vector"], width) for r in sample] or [np.zeros(width)]), directions)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = np.array([whole(v, width) for v in batch.column("vector").to_pylist()]).reshape(-1, width)
            norms = np.linalg.norm(vectors, axis=1)
            angles = angles_to(vectors, norms, chosen)
            near = angles.argmin(axis=1)
            columns = {name: batch.column(name) for name in ("row", "vec_id", "label")}
            columns |= {"near": pa.array(near, pa.int32()), "angle": pa.array(angles[np.arange(len(near)), near], pa.float64())}
            columns |= {"norm": pa.array(norms, pa.float64()), "angles": _lists(angles), "vector": _lists(vectors)}
            yield pa.RecordBatch.from_pydict(columns)

    schema = "row long, vec_id long, label long, near int, angle double, norm double, angles array<double>, vector array<double>"
    index = rows.select(row, "vec_id", "label", "vector").mapInArrow(measure, schema)
    # The row's number last, so that very many equal vectors are split.
    order = ["near", "angle", "row"]
    ranged = index.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    return materialize(ranged.select("row", "vec_id", "label", "norm", "angles", "vector"), "angular"), width


def _lists(values: np.ndarray) -> pa.Array:
    offsets = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel(), pa.float64()))


class Rows:
    """Rows of the index as arrays."""

    def __init__(self, row, vec_id, no_id, label, norm, angles, vectors):
        self.row, self.vec_id, self.no_id, self.label = row, vec_id, no_id, label
        self.norm, self.angles, self.vectors = norm, angles, vectors

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> Rows:
        n = batch.num_rows
        ids = batch.column("vec_id")
        return cls(
            batch.column("row").to_numpy(),
            ids.fill_null(0).to_numpy(),
            ids.is_null().to_numpy(zero_copy_only=False),
            batch.column("label").to_numpy(),
            batch.column("norm").to_numpy(),
            batch.column("angles").flatten().to_numpy().reshape(n, -1),
            batch.column("vector").flatten().to_numpy().reshape(n, -1),
        )

    def part(self, which) -> Rows:
        return Rows(*(x[which] for x in (self.row, self.vec_id, self.no_id, self.label, self.norm, self.angles, self.vectors)))

    def __len__(self) -> int:
        return len(self.row)


def score_bounds(nearest: np.ndarray, farthest: np.ndarray, norm: np.ndarray, least: np.ndarray, most: np.ndarray):
    """Bounds of the scores of pairs at angles ``nearest`` to ``farthest``, of norms ``norm`` and ``least`` to ``most``."""
    high = np.cos(np.clip(nearest - WIDENED, 0.0, np.pi))
    low = np.cos(np.clip(farthest + WIDENED, 0.0, np.pi))
    slack = WIDENED * norm * most + 1.0
    return norm * np.where(low >= 0, low * least, low * most) - slack, norm * np.where(high >= 0, high * most, high * least) + slack


def run_bounds(anchors: Rows, run: Rows):
    """For each anchor the bounds of its scores with all rows of the run."""
    least, most = run.angles.min(axis=0), run.angles.max(axis=0)
    nearest = np.maximum(least - anchors.angles, anchors.angles - most).max(axis=1)
    farthest = np.minimum(anchors.angles + most, 2 * np.pi - anchors.angles - least).min(axis=1)
    return score_bounds(nearest, farthest, anchors.norm, run.norm.min(), run.norm.max())


def pair_bounds(anchors: Rows, run: Rows):
    """For each anchor and row the bounds of their score."""
    nearest = np.zeros((len(anchors), len(run)))
    farthest = np.full((len(anchors), len(run)), np.pi)
    for n in range(anchors.angles.shape[1]):
        a, r = anchors.angles[:, n, None], run.angles[None, :, n]
        np.maximum(nearest, np.abs(a - r), out=nearest)
        together = a + r
        np.minimum(farthest, np.minimum(together, 2 * np.pi - together), out=farthest)
    norm = run.norm[None, :]
    return score_bounds(nearest, farthest, anchors.norm[:, None], norm, norm)


def products(anchors: Rows, run: Rows, a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Whole inner products of the pairs (a, r). Sums of whole numbers below 2**53 are exact in doubles."""
    if anchors.norm[a].max(initial=0.0) * run.norm[r].max(initial=0.0) < 2.0**53:
        if 8 * len(a) > len(anchors) * len(run):
            return (anchors.vectors @ run.vectors.T)[a, r].astype(np.int64)
        return np.einsum("ij,ij->i", anchors.vectors[a], run.vectors[r]).astype(np.int64)
    found = (sum(int(x) * int(y) for x, y in zip(anchors.vectors[m], run.vectors[n], strict=True)) for m, n in zip(a, r, strict=True))
    return np.array([min(max(x, int(LEAST)), int(LARGEST)) for x in found], np.int64)


class Best:
    """The first ``most`` rows of each window: by score, the highest first, then id, NULL last, then row."""

    def __init__(self, windows: int, most: int):
        self.most = most
        self.least = np.full(windows, LEAST)
        self.held = [np.zeros(0, np.int64) for _ in range(5)]  # window, score, no_id, vec_id, row
        self.waiting: list[list[np.ndarray]] = []

    def add(self, window, score, rows: Rows) -> None:
        self.waiting.append([window, score, rows.no_id.astype(np.int64), rows.vec_id, rows.row])
        if sum(len(x[0]) for x in self.waiting) > max(PAIRS // 4, len(self.held[0])):
            self.settle()

    def settle(self) -> None:
        joined = [np.concatenate(x) for x in zip(self.held, *self.waiting, strict=True)]
        window, score, no_id, vec_id, row = joined
        order = np.lexsort((row, vec_id, no_id, ~score, window))
        joined = [x[order] for x in joined]
        place = np.arange(len(window)) - np.searchsorted(joined[0], joined[0])
        last = place == self.most - 1
        self.least[joined[0][last]] = joined[1][last]
        self.held = [x[place < self.most] for x in joined]
        self.waiting = []

    def rows(self) -> dict[str, pa.Array]:
        self.settle()
        window, score, no_id, vec_id, row = self.held
        return {
            "window": pa.array(window, pa.int64()),
            "score": pa.array(score, pa.int64()),
            "vec_id": pa.array(vec_id, pa.int64(), mask=no_id.astype(bool)),
            "row": pa.array(row, pa.int64()),
        }


class Windows:
    """Scores that each anchor looks for: several windows an anchor, ``least`` to ``most``."""

    def __init__(self, least: np.ndarray, most: np.ndarray):
        self.least, self.most = least, most

    def narrowed(self, best: Best) -> tuple[np.ndarray, np.ndarray]:
        """The windows above what their best rows have already; empty ones match nothing."""
        least = np.maximum(self.least, best.least.reshape(self.least.shape))
        empty = self.least > self.most
        return np.where(empty, LARGEST, least), np.where(empty, LEAST, self.most)


def scan(batches: Iterator[pa.RecordBatch], anchors: Rows, windows: Windows, same: bool, most: int) -> Best:
    """The best rows of every window, of the anchor's label (but not the anchor) or of all others."""
    best = Best(windows.least.size, most)
    per = windows.least.shape[1]
    step = max(1, PAIRS // RUN)
    for batch in batches:
        rows = Rows.of(batch)
        for at in range(0, len(rows), RUN):
            run = rows.part(slice(at, at + RUN))
            low, high = run_bounds(anchors, run)
            least, upto = windows.narrowed(best)
            open_ = ((high >= least.min(axis=1)) & (low <= upto.max(axis=1))).nonzero()[0]
            for n in range(0, len(open_), step):
                which = open_[n : n + step]
                some = anchors.part(which)
                least, upto = (x[which] for x in windows.narrowed(best))
                low, high = pair_bounds(some, run)
                alike = some.label[:, None] == run.label[None, :]
                alike = alike & (some.row[:, None] != run.row[None, :]) if same else ~alike
                a, r = (alike & (high >= least.min(axis=1)[:, None]) & (low <= upto.max(axis=1)[:, None])).nonzero()
                score = products(some, run, a, r)
                for k in range(per):
                    good = (score >= least[a, k]) & (score <= upto[a, k])
                    if good.any():
                        best.add(which[a[good]] * per + k, score[good], run.part(r[good]))
    return best


FOUND = "window long, score long, vec_id long, row long"


def ranked(found: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("window").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def mine_block(index: DataFrame, anchors: Rows, positives: int, negatives: int) -> DataFrame:
    """The hard negatives of a block of anchors."""

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = np.full((len(anchors), 1), LEAST)
        best = scan(batches, anchors, Windows(open_, np.full_like(open_, LARGEST)), True, positives)
        yield pa.RecordBatch.from_pydict(best.rows())

    shape = (len(anchors), positives)
    least, upto = np.ones(shape, np.int64), np.zeros(shape, np.int64)
    ids, no_id, scores = np.zeros(shape, np.int64), np.zeros(shape, bool), np.zeros(shape, np.int64)
    for r in ranked(index.mapInArrow(nearest, FOUND), positives).collect():
        at = r["window"], r["rank"] - 1
        scores[at], no_id[at], ids[at] = r["score"], r["vec_id"] is None, r["vec_id"] or 0
        # Whole numbers of Python: 90 times a score can be beyond 64 bits.
        least[at], upto[at] = -(-FROM * r["score"] // 100), TO * r["score"] // 100

    def hard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = scan(batches, anchors, Windows(least, upto), False, negatives).rows()
        window = found["window"].to_numpy()
        anchor_id = pa.array(anchors.vec_id[window // positives], pa.int64())
        positive_id = pa.array(ids.ravel()[window], pa.int64(), mask=no_id.ravel()[window])
        found |= {"anchor_id": anchor_id, "positive_id": positive_id, "positive_score": pa.array(scores.ravel()[window], pa.int64())}
        yield pa.RecordBatch.from_pydict(found)

    found = index.mapInArrow(hard, f"{FOUND}, anchor_id long, positive_id long, positive_score long")
    return ranked(found, negatives).select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def hard_negatives(rows: DataFrame, vector: str = "embedding", every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """Per anchor (an id that ``every`` divides), positive and rank: negative_id and both scores."""
    spark = rows.sparkSession
    index, _ = angular_index(taking_part(rows, vector))
    result = spark.createDataFrame(
        [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    )
    asked = index.filter(F.col("vec_id") % every == 0)
    for block in chunks(asked.toLocalIterator(), lambda _: 1, ANCHORS):
        whole_, doubles = ([np.array([r[c] for r in block], t) for c in names] for names, t in ((("row", "vec_id", "label"), np.int64), (("norm", "angles", "vector"), float)))
        anchors = Rows(whole_[0], whole_[1], np.zeros(len(block), bool), whole_[2], *doubles)
        result = result.unionByName(materialize(mine_block(index, anchors, positives, negatives), "mined"))
    return result
