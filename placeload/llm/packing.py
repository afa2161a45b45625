"""Packing of token sequences from the histogram of their lengths, shortest pack first.

Documents become ids with a closing id, cut into pieces of at most ``length``. Only the
histogram of piece lengths (at most ``length`` numbers) reaches the driver. Lengths are placed
longest first, each on the pattern with the most room that can take it; a pattern is a list of
lengths with the number of sequences that have it, so thousands of documents are placed in
one step. Every pattern takes a run of ranks of each of its lengths, and a piece finds its sequence by
its rank among the pieces of its length.

Size of what is sent to every task: each step either uses up a length (at most ``length`` steps add a
pattern) or a pattern, so there are at most 2 * ``length`` patterns, whatever the input.

Defined results: a written-out special token is that token, as ``tokenizers`` reads it; NULL and empty texts are the closing id alone; equal rows are packed each;
an empty table gives no piece.
"""

from __future__ import annotations

import heapq
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeload.llm.common import numbered
from placeload.storage import materialize

_encoders: dict = {}


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class Encoder:
    """Ids of a byte-level BPE file of ``tokenizers``, made by its own merge ranks.

    As ``tokenizers`` does, added tokens such as the end of a text are split out of it first, wherever they stand.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        letters = byte_letters()
        given = described.get("added_tokens", [])
        self.added = {x["content"]: x["id"] for x in given}
        #: Whether added tokens are taken just as they are written.
        self.literal = not any(x[flag] for x in given for flag in ("single_word", "lstrip", "rstrip", "normalized"))
        longest = sorted(map(re.escape, self.added), key=len, reverse=True)
        self.apart = re.compile(f"({'|'.join(longest)})") if longest else None
        vocabulary = described["model"]["vocab"].items()
        ranks = {bytes(letters[c] for c in piece): n for piece, n in vocabulary if piece not in self.added}
        self.fast = tiktoken.Encoding("piece", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.plain = Tokenizer.from_file(path)

    def ids(self, text: str) -> list[int]:
        if self.apart is None or not self.apart.search(text):
            return self._between(text)
        if not self.literal:
            return self.plain.encode(text, add_special_tokens=False).ids
        found = []
        for n, part in enumerate(self.apart.split(text)):
            found += [self.added[part]] if n % 2 else self._between(part)
        return found

    def _between(self, text: str) -> list[int]:
        """The ids of a text without added tokens."""
        try:
            return self.fast.encode_ordinary(text)
        except BaseException as problem:  # its regular expressions give up on very long runs
            if type(problem).__name__ not in ("PanicException", "ValueError"):
                raise
            return self.plain.encode(text, add_special_tokens=False).ids


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def token_pieces(docs: DataFrame, vocabulary: str, length: int = 2048, close: int = 1, with_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, and the ids themselves if asked for."""
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary).ids
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"].array, batch["text"].array, strict=True):
                ids = np.array([*encode(text if isinstance(text, str) else ""), close], "<u4")
                for start in range(0, len(ids), length):
                    piece = ids[start : start + length]
                    row = (doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids))
                    out.append((*row, piece.astype(np.int32)) if with_ids else row)
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
            made = pd.DataFrame(out, columns=names)
            made["doc_id"] = made["doc_id"].astype("Int64")
            yield made

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(cut, schema)


def patterns(histogram: dict[int, int], length: int) -> list[tuple[list[int], int]]:
    """Lists of lengths, each with the number of sequences that hold it."""
    packs: list[tuple[int, int, tuple, int]] = []  # used, age, chain of lengths, count
    full: list[tuple[tuple, int]] = []
    age = 0
    shortest = min(histogram, default=0)
    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        while left:
            if packs and packs[0][0] + size <= length:
                used, _, chain, count = heapq.heappop(packs)
                taken = min(left, count)
                if count > taken:
                    heapq.heappush(packs, (used, age, chain, count - taken))
                    age += 1
            else:
                used, chain, taken = 0, (), left
            left -= taken
            if used + size + shortest > length:
                full.append(((size, chain), taken))
            else:
                heapq.heappush(packs, (used + size, age, (size, chain), taken))
                age += 1
    found = []
    for chain, count in [*full, *((p[2], p[3]) for p in packs)]:
        lengths = []
        while chain:
            lengths.append(chain[0])
            chain = chain[1]
        found.append((lengths[::-1], count))
    return found


def placements(histogram: dict[int, int], length: int) -> np.ndarray:
    """Runs of row numbers (pieces in order of length): begin, first sequence, pieces per sequence, offset, length."""
    begin, total = {}, 0
    for size in sorted(histogram):
        begin[size] = total
        total += histogram[size]
    rows, sequence = [], 0
    for lengths, count in patterns(histogram, length):
        offset = 0
        for size in dict.fromkeys(lengths):
            times = lengths.count(size)
            rows.append((begin[size], sequence, times, offset, size))
            begin[size] += count * times
            offset += times * size
        sequence += count
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, length: int = 2048) -> DataFrame:
    """``pieces`` (doc_id, start, length and whatever else) with sequence_id and offset."""
    stored = materialize(pieces, "pieces")
    counts = stored.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most ``length`` rows
    runs = placements({int(x["length"]): x["n"] for x in counts}, length)
    rows, _ = numbered(stored, "length", "doc_id", "start")

    @F.pandas_udf("sequence_id long, offset long")
    def find(number: pd.Series) -> pd.DataFrame:
        n = number.to_numpy()
        begin, first, times, offset, size = runs[np.searchsorted(runs[:, 0], n, side="right") - 1].T
        return pd.DataFrame({"sequence_id": first + (n - begin) // times, "offset": offset + (n - begin) % times * size})

    return rows.withColumn("found", find("row_number")).select(
        *stored.columns, "found.sequence_id", "found.offset"
    )
