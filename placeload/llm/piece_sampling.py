"""Distinct sampled segmentations: Gumbel top-k without replacement over the piece lattice.

A text's lattice has an arc for every piece of the vocabulary at every place. Pieces weigh as Zipf's
law gives by their rank in the vocabulary; the model file has merge ranks, no probabilities. Sums
of the lattice from its end are exact bounds, so the search is an A-star search that never expands a wrong
node: the best perturbed segmentation is drawn arc by arc, every node on it leaves its other
arcs behind with their largest Gumbel value, truncated at that of the path; the next segmentation starts at the
largest value left behind. k segmentations cost k paths. The value of the best one not taken is the
threshold that turns a log probability into the probability of being among the k.

Pieces do not cross the start of a word, so the lattice is a chain of words. Words are never cut, whatever
their length; in long ones the sums are scaled anew on the way, since only their ratios count. Random
numbers are hashes of the row's key, the sample, the word and the step.

Defined results: a NULL text counts as empty, which has one segmentation, of no piece; a text with fewer
than k segmentations gives all of them; equal rows give equal samples; a NULL id seeds as 0.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeload.llm.common import chunks, mix, uniform

#: Segmentations of each text.
SAMPLES = 2
#: Characters from a word's end up to which its sums need no scaling, and of text worked on at once.
UNSCALED, CHUNK = 32, 3_000_000
#: Sums below the first are scaled by the second. Words longer than all but so many are summed one by one.
SMALL, LARGE, FEW = 1e-150, 1e150, 8
#: Log probability of a character that no piece has and that is written as bytes.
UNKNOWN = -12.0
#: Node values below this are only drawn if a choice could depend on them.
DEEP = -120.0
#: Parts of the range of a place's random number, each with the arc it starts in (a power of two).
PARTS = 4
#: No standard Gumbel value from a 53-bit number is larger than this.
GUMBEL = 38.0

BLANK = "▁"
U = np.uint64
_STEP = U(0x9E3779B97F4A7C15)
_vocabularies: dict = {}


class Vocabulary:
    """Pieces of a SentencePiece model: hashes by length, weights, bytes."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.pieces: dict[int, bytes] = {}
        self.first_byte = model.piece_to_id("<0x00>")
        by_length: dict[int, list[tuple[np.ndarray, int]]] = {}
        rank = 0
        weights = np.full(model.get_piece_size(), -np.inf)
        for n in range(model.get_piece_size()):
            if model.is_byte(n):
                self.pieces[n] = bytes([int(model.id_to_piece(n)[3:5], 16)])
            elif not (model.is_control(n) or model.is_unknown(n) or model.is_unused(n)):
                piece = model.id_to_piece(n)
                self.pieces[n] = piece.replace(BLANK, " ").encode()
                by_length.setdefault(len(piece), []).append((code_points(piece), n))
                weights[n] = -math.log(rank + 2.7)
                rank += 1
        self.table = np.empty(len(weights), object)
        self.table[:] = [self.pieces.get(n, b"") for n in range(len(weights))]
        top = weights.max()
        self.log = weights - (top + math.log(np.exp(weights - top).sum()))
        self.log = np.append(self.log, UNKNOWN)  # the last entry stands for bytes
        self.known: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, int]] = {}
        for length, found in by_length.items():
            hashes = np.zeros(len(found), np.uint64)
            points = np.array([p for p, _ in found])
            for k in range(length):
                hashes = rolled(hashes, points[:, k])
            order = np.argsort(hashes)
            # Where the hashes that begin with the same 18 bits start, and how many there are of them at most.
            begin = (hashes[order] >> U(46)).astype(np.int64)
            slot = np.full(1 << 18, -1, np.int16 if len(begin) < 1 << 15 else np.int32)
            slot[begin[::-1]] = np.arange(len(begin), dtype=slot.dtype)[::-1]
            most = int(np.bincount(begin).max())
            padded = np.append(hashes[order], np.zeros(most, np.uint64))
            self.known[length] = (padded, np.array([n for _, n in found], np.int32)[order], slot, most)
        self.longest = max(self.known)

    def decode(self, ids) -> str:
        """The text of a segmentation: bytes of its pieces, without the blank put before it."""
        return self.written(ids)[1:].decode("utf-8", "replace")

    def written(self, ids) -> bytes:
        """The bytes of a segmentation, with the blank put before it."""
        return b"".join(self.table[np.asarray(ids, np.int64)].tolist())


def rolled(hashes: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Hashes of strings, from those without their last character."""
    return (hashes + points + U(1)) * U(0xD1342543DE82EF95)


def vocabulary(path: str) -> Vocabulary:
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


class Lattice:
    """Arcs of the distinct words of some texts, and sums over the ways to their end."""

    def __init__(self, texts: list[str], words: Vocabulary):
        points = [code_points((" " + t).replace(" ", BLANK)) if t else np.zeros(0, np.uint32) for t in texts]
        sizes = np.array([len(p) for p in points])
        all_points = np.concatenate(points) if points else np.zeros(0, np.uint32)
        self.empty = not len(all_points)
        if self.empty:
            return
        ends = np.cumsum(sizes)
        blank = all_points == ord(BLANK)
        begins = blank & np.concatenate([[True], ~blank[:-1]])
        begins[(ends - sizes)[sizes > 0]] = True
        at = begins.nonzero()[0]
        length = np.diff(at, append=len(all_points))
        self.doc = np.searchsorted(ends, at, side="right")
        self.first_word = np.searchsorted(self.doc, np.arange(len(texts) + 1))
        self.ordinal = (np.arange(len(at)) - self.first_word[self.doc]).astype(np.uint64)
        # Distinct words, by the hash of their characters.
        name = length.astype(np.uint64)
        live = (length <= UNSCALED).nonzero()[0]
        for k in range(UNSCALED if len(live) else 0):
            if k:
                live = live[length[live] > k]
            name[live] = rolled(name[live], all_points[at[live] + k])
        for n in (length > UNSCALED).nonzero()[0]:
            held = all_points[at[n] : at[n] + length[n]].tobytes()
            name[n] = int.from_bytes(hashlib.blake2b(held, digest_size=8).digest(), "little")
        _, first, word = np.unique(name, return_index=True, return_inverse=True)
        width = length[first]
        self.start = (np.cumsum(width) - width)[word]
        total = int(width.sum())
        spots = np.repeat(at[first] - (np.cumsum(width) - width), width) + np.arange(total)
        self.points = all_points[spots]
        self.rest = (np.repeat(np.cumsum(width), width) - np.arange(total)).astype(np.int32)
        self._arcs(words, np.cumsum(width), width)

    def _arcs(self, words: Vocabulary, ends: np.ndarray, width: np.ndarray) -> None:
        """Arcs in order of their place: length, piece and probability given the place."""
        total = len(self.points)
        found, hashes, live = [], np.zeros(total, np.uint64), np.arange(total, dtype=np.int32)
        count = np.zeros(total, np.int16)
        for k in range(words.longest):
            if k:
                stay = (self.rest[live] > k).nonzero()[0]
                live, hashes = live[stay], hashes[stay]
            hashes = rolled(hashes, self.points[live + k])
            if k + 1 not in words.known:
                continue
            keys, ids, slot, most = words.known[k + 1]
            begin = slot[hashes >> U(46)]
            some = (begin >= 0).nonzero()[0]
            spot, wanted = begin[some].astype(np.int32), hashes[some]
            hit = keys[spot] == wanted
            for _ in range(1, most):
                spot += ~hit
                hit = keys[spot] == wanted
            hit &= spot < len(ids)
            place, piece = live[some[hit]], ids[spot[hit]]
            if k == 0:
                known = np.zeros(total, bool)
                known[place] = True
                raw = (~known).nonzero()[0]  # no piece: written as bytes
                place = np.concatenate([place, raw])
                piece = np.concatenate([piece, np.full(len(raw), len(words.log) - 1, np.int32)])
            count[place] += 1
            found.append((k + 1, place, piece))
        self.first = np.concatenate([[0], np.cumsum(count, dtype=np.int64)])
        size = int(self.first[-1])
        self.length, self.piece = np.empty(size, np.int8), np.empty(size, np.int32)
        fill = self.first[:-1].copy()
        for k, place, piece in found:
            slot = fill[place]
            self.length[slot], self.piece[slot] = k, piece
            fill[place] = slot + 1
        place = np.repeat(np.arange(total, dtype=np.int32), count)
        weight = np.exp(words.log)[self.piece]
        rest = self.rest[place]
        # Small numbers are sorted by their digits.
        order = np.argsort(rest.astype(np.int16) if rest.max(initial=0) < 1 << 15 else rest, kind="stable")
        cuts = np.searchsorted(rest[order], np.arange(1, UNSCALED + 2))
        near = order[: cuts[UNSCALED]]
        # From here in order of the rest, so that each step works on a slice. Arcs to the end lead to a sum of 1.
        start, sums = place[near], weight[near]
        target = np.where(self.length[near] == rest[near], total, start + self.length[near])
        ahead = np.zeros(total + 1)
        ahead[total] = 1.0
        for d in range(UNSCALED):
            arcs = slice(cuts[d], cuts[d + 1])
            sums[arcs] *= ahead[target[arcs]]
            np.add.at(ahead, start[arcs], sums[arcs])
        ahead[total] = 0.0
        weight[near] = sums / ahead[start]
        if len(near) < size:
            self._long_words(weight, ahead, place, order, words.longest, ends, width)
        self.share = weight
        # The arc drawn by u at a place is where place + u falls in one increasing list.
        until = np.cumsum(weight)
        self.until = until - (np.concatenate([[0.0], until])[self.first[:-1]] - np.arange(total))[place]
        # The arc at which the search starts for each PARTS-th of a place.
        ended = np.bincount(np.ceil(self.until * PARTS).astype(np.int64), minlength=total * PARTS)
        self.guide = np.cumsum(ended[: total * PARTS], dtype=np.int32)
        self.last = (self.first[1:] - 1).astype(np.int32)

    def _long_words(self, weight, ahead, place, order, longest: int, ends: np.ndarray, width: np.ndarray) -> None:
        """Weights, given the place, of arcs more than UNSCALED characters before the end of their word."""
        many = int(np.sort(width)[-FEW]) if len(width) >= FEW else 0
        many = max(many, UNSCALED)
        cuts = np.searchsorted(self.rest[place[order]], np.arange(UNSCALED + 1, many + 2))
        for a, b in itertools.pairwise(cuts):
            arcs = order[a:b]
            weight[arcs] *= ahead[place[arcs] + self.length[arcs]]
            np.add.at(ahead, place[arcs], weight[arcs])
            weight[arcs] /= ahead[place[arcs]]
            spots = np.unique(place[arcs])
            spots = spots[ahead[spots] < SMALL]
            ahead[spots[:, None] + np.arange(longest)] *= LARGE
        for n in (width > many).nonzero()[0]:
            begin, stop = ends[n] - width[n], ends[n] - many
            first = self.first[begin : stop + 1]
            low = first[0]
            own, lengths = weight[low : first[-1]].tolist(), self.length[low : first[-1]].tolist()
            first = (first - low).tolist()
            sums = ahead[stop : stop + longest][::-1].tolist()  # the last one is that of the next place
            for k in range(len(first) - 2, -1, -1):
                a, b = first[k], first[k + 1]
                given = [own[j] * sums[-lengths[j]] for j in range(a, b)]
                total = sum(given)
                own[a:b] = [g / total for g in given]
                sums.append(total)
                if total < SMALL:
                    sums = [x * LARGE for x in sums[-longest:]]
            weight[low : low + len(own)] = own

    def draw(self, place: np.ndarray, u: np.ndarray) -> np.ndarray:
        """One arc of each place: the first whose end in ``until`` lies beyond place + u."""
        spot, last = place + u, self.last[place]
        arc = np.minimum(self.guide[(spot * PARTS).astype(np.int64)], last)
        behind = ((self.until[arc] <= spot) & (arc < last)).nonzero()[0]
        while len(behind):
            arc[behind] += 1
            now = arc[behind]
            behind = behind[(self.until[now] <= spot[behind]) & (now < last[behind])]
        return arc

    def walk(self, place: np.ndarray, word: np.ndarray, step: np.ndarray, seed: np.ndarray) -> dict[str, np.ndarray]:
        """Draw arcs from ``place`` to the end of each word; the nodes come in order of word and step."""
        token, first, now = np.arange(len(place)), step, place
        turn = step.astype(np.uint64)
        seed = mix(seed + self.ordinal[word] * U(64) + turn % U(64) + (turn // U(64) << U(40)))
        found, count = [], np.zeros(len(place), np.int64)
        while len(now):
            if found and len(found) % 256 == 0:
                seed = mix(seed + U(len(found)))
            arc = self.draw(now, uniform(mix(seed + U(len(found) % 256 << 56))))
            found.append((token, now, arc))
            count[token] += 1
            ahead = self.length[arc]
            stay = self.rest[now] > ahead
            now, token, seed = (now + ahead)[stay], token[stay], seed[stay]
        begin = np.cumsum(count) - count
        places, arcs = np.empty(count.sum(), np.int64), np.empty(count.sum(), np.int64)
        for n, (token, now, arc) in enumerate(found):
            slot = begin[token] + n
            places[slot], arcs[slot] = now, arc
        steps = np.arange(len(places)) - np.repeat(begin - first, count)
        return {"word": np.repeat(word, count), "step": steps, "place": places, "arc": arcs}


class Path:
    """One segmentation of one text: its nodes, the log probability before each, its Gumbel value."""

    def __init__(self, lattice: Lattice, nodes: dict[str, np.ndarray], first: int, taken: np.ndarray, value: float):
        self.nodes, self.first, self.value = nodes, first, value
        p = lattice.share[nodes["arc"]]
        self.log = np.concatenate([[0.0], np.cumsum(np.log(p))])
        # What the other arcs of each node weigh; at the node it left another path those taken before do not count.
        self.others = np.maximum(0.0, 1.0 - p)
        self.taken = taken
        if len(self.others):
            if len(taken):
                self.others[first] = max(0.0, 1.0 - lattice.share[taken].sum() - p[first])
        self.open: np.ndarray | None = None

    def left_behind(self, seed: int) -> tuple[float, int]:
        """The largest value of what this path leaves behind, and its node."""
        if self.open is None:
            deep = int(np.searchsorted(-self.log[:-1], -DEEP, side="right"))
            self._draw(seed, self.first, max(deep, self.first))
            if deep < len(self.others) and self._largest()[0] < DEEP + GUMBEL:
                self._draw(seed, self.first, len(self.others))
        value, n = self._largest()
        return value, self.first + n if n >= 0 else n

    def _draw(self, seed: int, a: int, b: int) -> None:
        """Exponential numbers at the rates of what the nodes leave behind: the least has the largest Gumbel value."""
        u = uniform(mix(np.arange(a, b, dtype=np.uint64) * U(2) + U(1) + mix(np.array([seed], np.uint64))))
        self.drawn = -np.log(u)
        with np.errstate(divide="ignore"):
            self.open = self.drawn / np.where(self.others[a:b] > 1e-12, np.exp(self.log[a:b]) * self.others[a:b], 0.0)

    def _largest(self) -> tuple[float, int]:
        n = int(self.open.argmin()) if len(self.open) else -1
        if n < 0 or np.isinf(self.open[n]):
            return -np.inf, n
        phi = self.log[self.first + n] + np.log(self.others[self.first + n])
        return float(-np.logaddexp(-self.value, -phi + np.log(self.drawn[n]))), n


def sample_pieces(texts: list[str], keys: list[int], words: Vocabulary, k: int) -> list[list[tuple]]:
    """For each text up to k distinct segmentations: (ids, log probability, perturbed value, inclusion probability)."""
    lattice = Lattice(texts, words)
    if lattice.empty:
        return [[(np.zeros(0, np.int32), 0.0, 0.0, 1.0)] for _ in texts]
    seeds = mix(np.array([key & (2**64 - 1) for key in keys], np.uint64) + U(0x1234567))
    count, word = np.diff(lattice.first_word), np.arange(len(lattice.doc))
    nodes = lattice.walk(lattice.start, word, np.zeros(len(word), np.int64), seeds[lattice.doc])
    cuts = np.searchsorted(nodes["word"], lattice.first_word)
    paths: list[list[Path]] = []
    none = np.zeros(0, np.int64)
    for d in range(len(texts)):
        own = {name: v[cuts[d] : cuts[d + 1]] for name, v in nodes.items()}
        top = -math.log(-math.log(uniform(mix(seeds[d : d + 1] + U(99)))[0]))
        paths.append([Path(lattice, own, 0, none, top)] if count[d] else [])
    thresholds = np.full(len(texts), -np.inf)
    for n in range(1, k + 1):
        turns = []
        for d, mine in enumerate(paths):
            if len(mine) < n:
                continue
            seed = int(seeds[d])
            value, node, parent = max(
                ((*p.left_behind(seed + 7919 * m & (2**64 - 1)), m) for m, p in enumerate(mine)), key=lambda x: x[0]
            )
            thresholds[d] = value
            if n < k and value > -np.inf:
                turns.append((d, mine[parent], node, value))
        if turns:
            _extend(lattice, paths, turns, seeds, n)
    return [
        [(*_ids(lattice, p, words), p.value, _inclusion(p, thresholds[d])) for p in mine] or [(np.zeros(0, np.int32), 0.0, 0.0, 1.0)]
        for d, mine in enumerate(paths)
    ]


def _extend(lattice: Lattice, paths: list[list[Path]], turns: list, seeds: np.ndarray, n: int) -> None:
    """Start the next path of some texts where another one left its best arcs behind."""
    starts = []
    for d, parent, node, value in turns:
        place, arc = parent.nodes["place"][node], parent.nodes["arc"][node]
        gone = np.append(parent.taken, arc) if node == parent.first else np.array([arc])
        share = lattice.share[lattice.first[place] : lattice.first[place + 1]].copy()
        share[gone - lattice.first[place]] = 0.0
        u = uniform(mix(seeds[d : d + 1] + U(n * 1_000_003 + 17)))[0] * share.sum()
        new = int(lattice.first[place]) + int(min(np.searchsorted(np.cumsum(share), u, side="right"), share.nonzero()[0][-1]))
        parent.open[node - parent.first] = np.inf
        starts.append((d, parent, node, value, gone, place, new))
    begin, word, step, seed = [], [], [], []
    for d, parent, node, _, _, place, new in starts:
        w, s = parent.nodes["word"][node], parent.nodes["step"][node]
        later = np.arange(w + 1, lattice.first_word[d + 1])
        if lattice.rest[place] > lattice.length[new]:
            begin.append([place + lattice.length[new]]), word.append([w]), step.append([s + 1])
            seed.append(seeds[d : d + 1] + U(n))
        begin.append(lattice.start[later]), word.append(later), step.append(np.zeros(len(later), np.int64))
        seed.append(np.full(len(later), seeds[d] + U(n)))
    drawn = lattice.walk(*(np.concatenate(x).astype(np.int64) for x in (begin, word, step)), mix(np.concatenate(seed)))
    for d, parent, node, value, gone, place, new in starts:
        a, b = np.searchsorted(drawn["word"], [parent.nodes["word"][node], lattice.first_word[d + 1]])
        own = {}
        turn = {"word": parent.nodes["word"][node], "step": parent.nodes["step"][node], "place": place, "arc": new}
        for name, v in parent.nodes.items():
            own[name] = np.concatenate([v[:node], [turn[name]], drawn[name][a:b]])
        paths[d].append(Path(lattice, own, node, gone, value))


def _ids(lattice: Lattice, path: Path, words: Vocabulary) -> tuple[np.ndarray, float]:
    ids = lattice.piece[path.nodes["arc"]]
    raw = (ids == len(words.log) - 1).nonzero()[0]
    if len(raw):
        written = [list(chr(lattice.points[path.nodes["place"][n]]).encode("utf-8", "surrogatepass")) for n in raw]
        width = np.ones(len(ids), np.int64)
        width[raw] = [len(w) for w in written]
        out = np.repeat(ids, width)
        out[np.repeat(ids == len(words.log) - 1, width)] = [b + words.first_byte for w in written for b in w]
        ids = out
    return ids, float(path.log[-1])


def _inclusion(path: Path, threshold: float) -> float:
    """The probability that a segmentation of this log probability exceeds the threshold."""
    return float(-math.expm1(-math.exp(min(700.0, path.log[-1] - threshold)))) if threshold > -np.inf else 1.0


def sampled_segmentations(docs: DataFrame, path: str, samples: int = SAMPLES, seed: int = 0, with_ids: bool = False) -> DataFrame:
    """Per document and sample: doc_id, sample, n_pieces, log_prob, perturbed, inclusion, ids_crc32, round_trip.

    ``round_trip``: whether the decoded ids are the text. The ids themselves come if asked for.
    """
    schema = (
        "doc_id long, sample int, n_pieces long, log_prob double, perturbed double, inclusion double,"
        " ids_crc32 long, round_trip boolean"
    ) + ", ids array<int>" * with_ids

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = vocabulary(path)
        for batch in batches:
            given = ((None if pd.isna(i) else int(i), t if isinstance(t, str) else "") for i, t in zip(batch["doc_id"].array, batch["text"].array, strict=True))
            for held in chunks(given, lambda r: len(r[1]), CHUNK):
                keys = [(i or 0) * 0x10001 + seed for i, _ in held]
                rows = []
                for (doc_id, text), found in zip(held, sample_pieces([t for _, t in held], keys, words, samples), strict=True):
                    whole = f" {text}".encode() if text else b""
                    for n, (ids, log, value, inclusion) in enumerate(found):
                        crc = zlib.crc32(ids.astype("<u4").tobytes())
                        row = (doc_id, n, len(ids), log, value, inclusion, crc, words.written(ids) == whole)
                        rows.append((*row, ids) if with_ids else row)
                names = [x.split()[0] for x in schema.split(", ")]
                made = pd.DataFrame(rows, columns=names)
                made["doc_id"] = made["doc_id"].astype("Int64")
                yield made

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(draw, schema)
