"""Best-two-fit packing of token pieces into sequences.

A document's tokens and an end token are cut into pieces of at most a sequence. Pieces of one length are
alike, so packing is done on the count of each length: a bin is filled greedily with the longest pieces that
fit, then its smallest piece is replaced by two unpacked ones that fill the gap more tightly. The bin is
repeated as often as its pieces last. That plan has as many numbers as there are lengths, whatever the
number of documents; Spark ranks the pieces of each length and joins them with their places.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postsignal.llm.common import batches, staged

CAPACITY = 1024
END = 2
TOKENIZER = "byte_bpe_50k"
#: Pieces of one length that are ranked together, about.
RANKED = 100_000
#: Distinct words whose tokens a task remembers.
REMEMBERED = 200_000
_SPECIAL = "<|endoftext|>"
_SPACES = re.compile("[\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")
_BESIDE = ("  ", " \n", "\n ", " \t", "\t ", " \r", "\r ", "\x0b", "\x0c")


class _Words(dict):
    """Token bytes of a word after a space, encoded at first use."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found = self.encode(f" {word}")
        return found


class Encoder:
    """Token ids of texts as little-endian 32-bit numbers, equal to those of the tokenizer file.

    A byte-level tokenizer begins a new word at every space between two other characters, so texts are split
    there and each word is encoded once. Texts with other white space next to a space are encoded whole, and
    those that hold the special token by the tokenizer file itself.
    """

    def __init__(self, name: str):
        import base64

        import public_tokenizers
        import tiktoken

        self.file = public_tokenizers.path(f"{name}.json")
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.plain = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.words = _Words(self._whole)
        self.own = None

    def _whole(self, text: str) -> bytes:
        return np.array(self.plain.encode_ordinary(text), "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if _SPECIAL in text:
            if self.own is None:
                from tokenizers import Tokenizer

                self.own = Tokenizer.from_file(self.file)
            return np.array(self.own.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if any(pair in text for pair in _BESIDE) or not text.isascii() and _SPACES.search(text):
            return self._whole(text)
        first, *words = text.split(" ")
        return self._whole(first) + b"".join(map(self.words.__getitem__, words))


@lru_cache(maxsize=2)
def encoder(name: str) -> Encoder:
    return Encoder(name)


def cuts(length: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of a document's pieces: all but the first are full."""
    n = -(-length // capacity)
    first = length - (n - 1) * capacity
    return [(0, first), *((first + i * capacity, capacity) for i in range(n - 1))]


def token_pieces(documents: DataFrame, capacity: int = CAPACITY, name: str = TOKENIZER, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every piece of every row, with its ``ids`` if asked for.

    A null text is empty and gives one piece, the end token. Repeated rows give repeated pieces.
    """
    end = np.array([END], "<u4").tobytes()

    def work(parts):
        encode = encoder(name).encode
        for part in parts:
            rows: list[tuple] = []
            held = 0
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1)):
                ids = encode(text.as_py() or "") + end
                for piece, (start, length) in enumerate(cuts(len(ids) // 4, capacity)):
                    data = ids[4 * start : 4 * (start + length)]
                    rows.append((doc_id, piece, start, length, zlib.crc32(data), data if with_ids else None))
                    held += len(data) if with_ids else 0
                if len(rows) >= 10_000 or held > 1 << 22:
                    yield batch(rows)
                    rows, held = [], 0
            if rows:
                yield batch(rows)

    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]

    def batch(rows):
        columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
        return pa.record_batch(columns[: 5 + with_ids], names[: 5 + with_ids])

    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return batches(documents, work, schema + ", ids binary" * with_ids)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Bins as lists of lengths, longest first, and how often each is used."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    bins = []
    while left.any():
        filled: list[int] = []
        gap = capacity
        while gap and (fits := np.flatnonzero(left[: gap + 1])).size:
            filled.append(int(fits[-1]))
            left[filled[-1]] -= 1
            gap -= filled[-1]
        while gap and len(filled) > 1 and (pair := _tighter(left, filled[-1], gap)):
            gap += filled[-1] - sum(pair)
            left[filled.pop()] += 1
            for length in pair:
                left[length] -= 1
            filled = sorted([*filled, *pair], reverse=True)
        used = Counter(filled)
        times = 1 + min(int(left[length]) // n for length, n in used.items())
        for length, n in used.items():
            left[length] -= n * (times - 1)
        bins.append((filled, times))
    return bins


def _tighter(left: np.ndarray, smallest: int, gap: int) -> tuple[int, int] | None:
    """Two unpacked lengths that together are longer than ``smallest`` and fit best where it was."""
    room = gap + smallest
    lengths = np.flatnonzero(left[: room + 1])
    if not len(lengths):
        return None
    at = np.searchsorted(lengths, room - lengths, side="right") - 1
    twice = (at >= 0) & (lengths[np.maximum(at, 0)] == lengths) & (left[lengths] < 2)
    at = at - twice
    total = np.where(at >= 0, lengths + lengths[np.maximum(at, 0)], 0)
    best = int(np.argmax(total))
    return (int(lengths[best]), int(lengths[at[best]])) if total[best] > smallest else None


def places(spark: SparkSession, bins: list[tuple[list[int], int]]) -> DataFrame:
    """``length, low, high, sequence, offset``: pieces of a length with ranks from low up to high go there."""
    rows, taken, sequence = [], Counter(), 0
    for lengths, times in bins:
        offset = 0
        for length in lengths:
            rows.append((length, taken[length], taken[length] + times, sequence, offset))
            taken[length] += times
            offset += length
        sequence += times
    return spark.createDataFrame(rows, "length long, low long, high long, sequence long, offset long")


def packed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with ``sequence_id`` and ``offset``: sequences are gapless from offset 0 and hold ``capacity`` at most.

    ``pieces`` is a table read from Parquet files: the places of its rows there spread equal rows over the shares of a length.
    """
    spark = pieces.sparkSession
    columns = pieces.columns
    pieces = pieces.select("*", F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("place"))
    keys = ["doc_id", "piece", "start", "length", "ids_crc32", "place"]
    counts = {row.length: row["count"] for row in pieces.groupBy("length").count().collect()}
    shares = max(1, max(counts.values(), default=0) // RANKED)
    salted = pieces.withColumn("salt", F.pmod(F.col("place"), F.lit(shares)))
    sizes = salted.groupBy("length", "salt").count()
    before = sizes.select(
        "length",
        "salt",
        (F.sum("count").over(Window.partitionBy("length").orderBy("salt")) - F.col("count")).alias("before"),
    )
    within = Window.partitionBy("length", "salt").orderBy(*keys)
    ranked = salted.withColumn("rank", F.row_number().over(within) - 1).join(before, ["length", "salt"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("before")).drop("salt", "before")
    # At most a few thousand rows: bounded by the number of lengths.
    slots = F.broadcast(places(spark, plan(counts, capacity)))
    placed = ranked.join(slots, "length").filter("rank >= low AND rank < high")
    sequence = F.col("sequence") + F.col("rank") - F.col("low")
    return placed.select(*columns, sequence.alias("sequence_id"), "offset")


def pack_documents(documents: DataFrame, capacity: int = CAPACITY, name: str = TOKENIZER) -> DataFrame:
    """Pieces of all rows of ``documents`` (``doc_id``, ``text``) with their places. An empty table gives no rows."""
    return packed(staged(token_pieces(documents, capacity, name), "pieces"), capacity)
