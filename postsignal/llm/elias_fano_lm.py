"""LM scoring with an Elias-Fano n-gram trie (after Pibiri and Venturini, 2017).

A bigram model with Dirichlet smoothing, p(w | v) = (c(v w) + MU p1(w)) / (c(v) + MU), where p1 is the add-one
unigram model; every text begins with a start mark and ends with an end token. Words are known by 64-bit hashes.

Texts are cut into blocks. Counts never travel per token: a block sends each distinct word and word pair once,
packed by shard, and gets back their counts. A pair's shard is chosen by its context, or by both words where the
context is frequent. A shard holds its part of the trie in memory-mapped levels: the contexts, monotone pointers
to their successors, and the successors, made monotone by their context's base and searched inside its range;
with them the quantised numerators of the smoothed probabilities.
"""

from __future__ import annotations

import tempfile

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsignal.llm.common import NOT_SPACE, batch_rows, batches, grouped, mix, pack, remainder, slices, staged, unpack

#: Weight of the shorter context in the smoothing.
MU = 4.0
#: Tokens of a block, and words or pairs of a shard, about.
BLOCK_TOKENS = 800_000
SHARD_ROWS = 1_500_000
#: A context with more than this share of all tokens is dealt over all shards (so there are at most its inverse).
COMMON_SHARE = 1 / 1000
#: Bits of a successor's hash inside its context.
SUCCESSOR_BITS = 40
_START, _END = mix(np.array([1, 2], np.uint64))
_ONE = np.uint64(1)


class EliasFano:
    """A sorted sequence of unsigned numbers: low bits packed, high bits in unary, read from a mapped file."""

    def __init__(self, values: np.ndarray):
        values = values.astype(np.uint64)
        n = len(values)
        self.n = n
        self.base = values[0] if n else np.uint64(0)
        values = values - self.base
        top = int(values[-1]) if n else 0
        self.width = max(0, (top // max(n, 1)).bit_length() - 1)
        high = (values >> np.uint64(self.width)).astype(np.int64)
        ones = high + np.arange(n)
        bits = np.zeros((int(high[-1]) if n else 0) + n + 1, np.uint8)
        bits[ones] = 1
        words = np.zeros(-(-len(bits) // 64) + 1, np.uint64)
        packed = np.packbits(bits, bitorder="little")
        words.view(np.uint8)[: len(packed)] = packed
        low = np.zeros(n * self.width // 64 + 2, np.uint64)
        if self.width:
            value = values & np.uint64((1 << self.width) - 1)
            at = np.arange(n, dtype=np.int64) * self.width
            shift = (at & 63).astype(np.uint64)
            np.bitwise_or.at(low, at >> 6, value << shift)
            over = (at & 63) + self.width > 64
            np.bitwise_or.at(low, (at[over] >> 6) + 1, value[over] >> (np.uint64(64) - shift[over]))
        self.low, self.high = _mapped(low), _mapped(words)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.high), dtype=np.int64)))

    def _low(self, at: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(at), np.uint64)
        place = at.astype(np.int64) * self.width
        shift = (place & 63).astype(np.uint64)
        value = self.low[place >> 6] >> shift
        over = (place & 63) + self.width > 64
        value[over] |= self.low[(place[over] >> 6) + 1] << (np.uint64(64) - shift[over])
        return value & np.uint64((1 << self.width) - 1)

    def _select(self, rank: np.ndarray, ones: bool) -> np.ndarray:
        """Place of the set (or unset) bit with so many like it before it."""
        before = self.before if ones else np.arange(len(self.before)) * 64 - self.before
        word = np.searchsorted(before, rank, side="right") - 1
        bits = self.high[word] if ones else ~self.high[word]
        left = rank - before[word]
        place = np.zeros(len(rank), np.int64)
        for step in (32, 16, 8, 4, 2, 1):
            part = (bits >> place.astype(np.uint64)) & np.uint64((1 << step) - 1)
            held = np.bitwise_count(part).astype(np.int64)
            go = left >= held
            left -= np.where(go, held, 0)
            place += np.where(go, step, 0)
        return word * 64 + place

    def access(self, at: np.ndarray) -> np.ndarray:
        high = (self._select(at.astype(np.int64), True) - at).astype(np.uint64)
        return ((high << np.uint64(self.width)) | self._low(at)) + self.base

    def successor(self, values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The first place in ``[first, last)`` that holds the value or more, or ``last``."""
        values = np.maximum(values, self.base) - self.base
        high = np.minimum((values >> np.uint64(self.width)).astype(np.int64), int(len(self.high) * 64 - self.n - 1))
        # Numbers with these high bits stand between two unset bits.
        begin = np.where(high > 0, self._select(np.maximum(high - 1, 0), False) - high + 1, 0)
        end = np.minimum(self._select(high, False) - high, self.n)
        low, up = np.maximum(np.minimum(begin, self.n), first), np.minimum(end, last)
        low = np.minimum(low, last)
        wanted = values & np.uint64((1 << self.width) - 1)
        while (open_ := low < up).any():
            middle = (low + up) >> 1
            less = np.zeros(len(low), bool)
            less[open_] = self._low(middle[open_]) < wanted[open_]
            low, up = np.where(open_ & less, middle + 1, low), np.where(open_ & ~less, middle, up)
        return low


def _mapped(array: np.ndarray) -> np.ndarray:
    """The array in a file of the task's own that goes when it is closed."""
    file = tempfile.TemporaryFile()
    array.tofile(file)
    file.flush()
    return np.memmap(file, dtype=array.dtype, mode="r", shape=array.shape)


def quantised(counts: np.ndarray) -> np.ndarray:
    """Counts as 16-bit codes: exact up to 2^15, then in steps of a tenth of a percent."""
    large = counts > 1 << 15
    codes = np.where(large, 0, counts).astype(np.float64)
    codes[large] = np.minimum((1 << 15) + np.rint(np.log(counts[large] / 2**15) / np.log(1.001)), 65535)
    return codes.astype(np.uint16)


def restored(codes: np.ndarray) -> np.ndarray:
    codes = codes.astype(np.float64)
    return np.where(codes <= 1 << 15, codes, 2.0**15 * 1.001 ** (codes - 2**15))


class Trie:
    """Contexts and their successors with quantised values; ``keys`` are context places and successor hashes."""

    def __init__(self, contexts: np.ndarray, keys: np.ndarray, counts: np.ndarray):
        own = keys >> np.uint64(SUCCESSOR_BITS)
        kept, sizes = np.unique(own, return_counts=True)
        self.contexts = EliasFano(contexts[kept.astype(np.int64)])
        self.pointers = EliasFano(np.concatenate(([0], np.cumsum(sizes))))
        # A context's base is its place in the trie, so the whole level rises.
        place = np.repeat(np.arange(len(kept), dtype=np.uint64), sizes)
        successor = keys & np.uint64((1 << SUCCESSOR_BITS) - 1)
        self.successors = EliasFano((place << np.uint64(SUCCESSOR_BITS)) | successor)
        self.values = _mapped(quantised(counts)) if len(counts) else np.empty(0, np.uint16)

    def codes(self, contexts: np.ndarray, successors: np.ndarray) -> np.ndarray:
        """The code of every pair, 0 where the trie has none."""
        out = np.zeros(len(contexts), np.uint16)
        n = self.contexts.n
        if not n:
            return out
        place = self.contexts.successor(contexts, np.zeros(len(contexts), np.int64), np.full(len(contexts), n))
        at = np.flatnonzero(place < n)
        at = at[self.contexts.access(place[at]) == contexts[at]]
        place = place[at]
        first, last = self.pointers.access(place).astype(np.int64), self.pointers.access(place + 1).astype(np.int64)
        value = (place.astype(np.uint64) << np.uint64(SUCCESSOR_BITS)) | successors[at]
        found = self.successors.successor(value, first, last)
        hit = np.flatnonzero(found < last)
        hit = hit[self.successors.access(found[hit]) == value[hit]]
        out[at[hit]] = self.values[found[hit]]
        return out


def _shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shards as ranges of the hashes, so that sorted hashes stay together."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _blocks(documents: DataFrame) -> DataFrame:
    """Texts as codes into their block's sorted words; every text ends with the end token."""

    def work(parts):
        own = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        size = 0

        def block(number):
            hashes = np.concatenate([h[2] for h in held])
            words, codes = np.unique(hashes, return_inverse=True)
            codes = codes.astype(np.uint32)
            ids = [i for h in held for i in h[0]]
            lengths = np.concatenate([h[1] for h in held])
            out = [h for g in held for h in g[3]]
            columns = [
                pa.array([own + number]),
                pa.array([ids], pa.list_(pa.int64())),
                pa.array([lengths.tolist()], pa.list_(pa.int64())),
                pa.array([out], pa.list_(pa.bool_())),
                pa.array([len(words)]),
                pa.array([words.tobytes()], pa.binary()),
                pa.array([pa.compress(codes.tobytes(), codec="zstd", asbytes=True)], pa.binary()),
            ]
            return pa.record_batch(columns, ["block", "ids", "lengths", "held", "n_words", "words", "codes"])

        number = 0
        for part in parts:
            ids, out = part.column(0).to_pylist(), part.column(2).to_pylist()
            for texts in slices(part.column(1)):
                _, _, hashes, bounds = texts.tokens(NOT_SPACE)
                hashes = np.insert(hashes, bounds[1:], _END)
                rows = slice(texts.rows.start, texts.rows.stop)
                held.append((ids[rows], np.diff(bounds) + 1, hashes, out[rows]))
                size += len(hashes)
                if size >= BLOCK_TOKENS:
                    yield block(number)
                    held, size, number = [], 0, number + 1
        if held:
            yield block(number)

    schema = "block long, ids array<long>, lengths array<long>, held array<boolean>, n_words long, words binary, codes binary"
    return batches(documents, work, schema)


def _opened(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A block's words, codes, and lengths and held-out marks of its texts."""
    lengths = np.array(row["lengths"], np.int64)
    codes = np.frombuffer(pa.decompress(row["codes"], decompressed_size=int(lengths.sum()) * 4, codec="zstd", asbytes=True), np.uint32)
    return np.frombuffer(row["words"], np.uint64), codes, lengths, np.array(row["held"], bool)


def _word_rows(blocks: DataFrame, shards: int) -> DataFrame:
    def work(parts):
        for part in parts:
            for row in part.to_pylist():
                words, codes, lengths, held = _opened(row)
                counts = np.bincount(codes[np.repeat(~held, lengths)], minlength=len(words))
                words = np.append(words, _START)
                order = np.argsort(words)
                words, counts = words[order], np.append(counts, (~held).sum())[order]
                shard = _shard(words, shards)
                cuts = np.searchsorted(shard, np.arange(shards + 1))
                out = [(s, row["block"], b - a, words[a:b].tobytes(), pack(counts[a:b].astype(np.uint32))) for s, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
                yield pa.record_batch([pa.array(c) for c in zip(*out)], ["shard", "block", "n", "words", "counts"])

    return batches(blocks, work, "shard long, block long, n long, words binary, counts binary")


def _word_counts(rows: DataFrame, common: float) -> DataFrame:
    """Replies to the blocks: total counts of their words; in a shard's first reply its sums and largest words."""

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        words = np.concatenate([np.frombuffer(w, np.uint64) for w in pdf["words"]])
        counts = np.concatenate([unpack(c, n, np.uint32) for c, n in zip(pdf["counts"], pdf["n"])])
        names, at = np.unique(words, return_inverse=True)
        total = np.bincount(at, weights=counts, minlength=len(names)).astype(np.int64)
        ends = np.cumsum(pdf["n"].to_numpy())
        mine = names != _START
        tokens = int(total[mine].sum())
        # Words above the share of this shard's own tokens include all above the share of all tokens.
        often = names[mine & (total > tokens * common)][: int(1 / common)]
        first = np.arange(len(pdf)) == 0
        return pd.DataFrame(
            {
                "block": pdf["block"],
                "shard": pdf["shard"],
                "n": pdf["n"],
                "data": [pack(total[at[e - n : e]]) for e, n in zip(ends, pdf["n"])],
                "tokens": np.where(first, tokens, 0),
                "distinct": np.where(first, int((total[mine] > 0).sum()), 0),
                "often": [list(zip(often.view(np.int64).tolist(), total[np.searchsorted(names, often)].tolist())) if f else [] for f in first],
            }
        )

    schema = "block long, shard long, n long, data binary, tokens long, distinct long, often array<struct<word: long, n: long>>"
    return grouped(rows, "shard", work, schema)


def _pairs(words: np.ndarray, codes: np.ndarray, lengths: np.ndarray, often: np.ndarray, shards: int) -> tuple[np.ndarray, ...]:
    """A block's distinct pairs, ordered by shard, context and successor: shards, contexts, successors, and per token its pair."""
    starts = np.cumsum(lengths) - lengths
    start = len(words)
    before = np.empty(len(codes), np.int64)
    before[1:] = codes[:-1]
    before[starts] = start
    key = (before << 32) | codes
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    pair = np.empty(len(key), np.int64)
    pair[order] = np.cumsum(new) - 1
    distinct = ordered[new]
    context, successor = np.append(words, _START)[distinct >> 32], words[distinct & 0xFFFFFFFF]
    routed = mix(context)
    hot = np.isin(context, often)
    routed[hot] = mix(routed[hot] ^ successor[hot])
    shard = _shard(routed, shards)
    rank = np.lexsort((successor & np.uint64((1 << SUCCESSOR_BITS) - 1), context, shard))
    place = np.empty(len(rank), np.int64)
    place[rank] = np.arange(len(rank))
    return shard[rank], context[rank], successor[rank] & np.uint64((1 << SUCCESSOR_BITS) - 1), place[pair]


def _pair_rows(blocks: DataFrame, often, shards: int) -> DataFrame:
    def work(parts):
        for part in parts:
            for row in part.to_pylist():
                words, codes, lengths, held = _opened(row)
                shard, context, successor, pair = _pairs(words, codes, lengths, often.value, shards)
                counts = np.bincount(pair[np.repeat(~held, lengths)], minlength=len(shard)).astype(np.uint32)
                cuts = np.searchsorted(shard, np.arange(shards + 1))
                out = []
                for s, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    if b > a:
                        names, sizes = np.unique(context[a:b], return_counts=True)
                        low, high = successor[a:b].astype(np.uint32), (successor[a:b] >> np.uint64(32)).astype(np.uint8)
                        out.append((s, row["block"], b - a, len(names), names.tobytes(), pack(sizes.astype(np.uint32)), low.tobytes() + high.tobytes(), pack(counts[a:b])))
                yield pa.record_batch([pa.array(c) for c in zip(*out)], ["shard", "block", "n", "names", "contexts", "sizes", "successors", "counts"])

    schema = "shard long, block long, n long, names long, contexts binary, sizes binary, successors binary, counts binary"
    return batches(blocks, work, schema)


def _pair_codes(rows: DataFrame) -> DataFrame:
    """Replies to the blocks: the codes of their pairs, looked up in the shard's trie of training pairs."""

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        names = np.unique(np.concatenate([np.frombuffer(c, np.uint64) for c in pdf["contexts"]]))
        keys = []
        for n, k, contexts, sizes, successors in zip(*(pdf[c] for c in ("n", "names", "contexts", "sizes", "successors"))):
            place = np.searchsorted(names, np.frombuffer(contexts, np.uint64)).astype(np.uint64)
            low, high = np.frombuffer(successors, np.uint32, n), np.frombuffer(successors, np.uint8, n, 4 * n)
            own = low.astype(np.uint64) | (high.astype(np.uint64) << np.uint64(32))
            keys.append((np.repeat(place, unpack(sizes, k, np.uint32)) << np.uint64(SUCCESSOR_BITS)) | own)
        keys = np.concatenate(keys)
        counts = np.concatenate([unpack(c, n, np.uint32) for c, n in zip(pdf["counts"], pdf["n"])])
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
        distinct = ordered[new]
        total = np.add.reduceat(counts[order].astype(np.int64), np.flatnonzero(new))
        at = np.empty(len(keys), np.int32)
        at[order] = np.cumsum(new) - 1
        del keys, counts, order, ordered, new
        trie = Trie(names, distinct[total > 0], total[total > 0])
        codes = np.empty(len(distinct), np.uint16)
        for low in range(0, len(distinct), 1 << 18):
            part = distinct[low : low + (1 << 18)]
            context = names[(part >> np.uint64(SUCCESSOR_BITS)).astype(np.int64)]
            codes[low : low + len(part)] = trie.codes(context, part & np.uint64((1 << SUCCESSOR_BITS) - 1))
        ends = np.cumsum(pdf["n"].to_numpy())
        return pd.DataFrame(
            {"block": pdf["block"], "shard": pdf["shard"], "n": pdf["n"], "data": [pack(codes[at[e - n : e]]) for e, n in zip(ends, pdf["n"])]}
        )

    return grouped(rows, "shard", work, "block long, shard long, n long, data binary")


def model_scores(documents: DataFrame, parts: int = 7, out: int = 2) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    The model learns from rows whose crc32(doc_id as text) mod ``parts`` is not ``out``; a null id counts as the
    empty text. A null or empty text is the end token alone. Repeated rows count and stay. With no text to learn
    from, every word is as likely. An empty table gives no rows. Other columns are not read.
    """
    spark = documents.sparkSession
    held = (remainder(F.col("doc_id"), parts) == out).alias("held")
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held)
    blocks = staged(_blocks(texts), "blocks")
    size = blocks.select(F.sum("n_words").alias("words"), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b)).alias("tokens")).first()
    if size.words is None:
        return spark.createDataFrame([], SCHEMA)
    word_shards = max(1, -(-size.words // SHARD_ROWS))
    with batch_rows(spark, 2):
        counts = staged(_word_counts(_word_rows(blocks, word_shards), COMMON_SHARE), "counts")
    total = counts.agg(F.sum("tokens").alias("tokens"), F.sum("distinct").alias("distinct")).first()
    frequent = counts.select(F.explode("often").alias("o")).select("o.*").filter(F.col("n") > total.tokens * COMMON_SHARE)
    often = np.sort(np.array([row.word for row in frequent.collect()] + [_START.view(np.int64)], np.int64).view(np.uint64))
    often = spark.sparkContext.broadcast(often)
    pair_shards = max(1, -(-size.tokens // SHARD_ROWS))
    with batch_rows(spark, 2):
        codes = staged(_pair_codes(_pair_rows(blocks, often, pair_shards)), "codes")

    def gathered(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("shard", "n", "data"))).alias(name))

    joined = blocks.join(gathered(counts, "word_data"), "block").join(gathered(codes, "pair_data"), "block")
    n, v = int(total.tokens), int(total.distinct)

    def score(parts_):
        for part in parts_:
            for i in range(part.num_rows):
                row = part.slice(i, 1).to_pylist()[0]
                words, code, lengths, _ = _opened(row)
                own = np.concatenate([unpack(r["data"], r["n"], np.int64) for r in row["word_data"]])
                with_start = np.sort(np.append(words, _START))
                at = np.searchsorted(with_start, words)
                count, start = own[at], own[np.searchsorted(with_start, _START)]
                *_, pair = _pairs(words, code, lengths, often.value, pair_shards)
                joint = restored(np.concatenate([unpack(r["data"], r["n"], np.uint16) for r in row["pair_data"]]))[pair]
                likely = (count + 1) / (n + v + 1)
                starts = np.cumsum(lengths) - lengths
                before = np.empty(len(code))
                before[1:] = count[code[:-1]]
                before[starts] = start
                each = np.log10((joint + MU * likely[code]) / (before + MU))
                yield pa.record_batch(
                    [
                        pa.array(row["ids"], pa.int64()),
                        pa.array(row["held"], pa.bool_()),
                        pa.array(lengths),
                        pa.array(np.add.reduceat((count > 0)[code].astype(np.int64), starts)),
                        pa.array(np.full(len(lengths), n)),
                        pa.array(np.add.reduceat(np.log10(likely)[code], starts)),
                        pa.array(np.add.reduceat(each, starts)),
                    ],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    scored = batches(joined.select("ids", "lengths", "held", "words", "codes", "word_data", "pair_data"), score, SCHEMA)
    with batch_rows(spark, 1):
        return staged(scored, "scores")


SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
