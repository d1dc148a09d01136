"""Sharding: a uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

Gustedt, "Efficient sampling of random permutations" (2008). A block is a run of rows of one file. How many
rows of each block go to each shard is drawn first: the rows of the matrix are multivariate hypergeometric, its
row sums are the blocks' sizes and its column sums the shards' sizes. Then every block permutes its rows and
deals them out in that order, the rows are exchanged, and every shard permutes what it got.

All of it is Spark expressions. The matrix is drawn for a bounded number of groups of blocks, then inside each
group, so no task holds more than one group. Permutations are keyed bijections of places (Hoang, Morris and
Rogaway, "An enciphering scheme based on a card shuffle", 2012): a row finds its shard and slot from its own
place, so no block or shard is ever gathered, sorted or held, and a lost task finds the same places again.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsignal.llm.common import staged

SHARDS = 24
SEED = 11
#: Rows of a file that make a block, groups of blocks, rounds of a permutation, rows that are exchanged together.
BLOCK_ROWS = 1 << 20
GROUPS = 1024
ROUNDS = 40
CHUNK = 1 << 13
#: Samples up to this size are drawn one by one, larger ones by ratio of uniforms.
SMALL = 16
ATTEMPTS = 256
LAW = "rows"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _uniform(*key: Column) -> Column:
    """A number between 0 and 1, ends excluded, that the key decides."""
    return (F.shiftrightunsigned(F.xxhash64(*key), 11) + 0.5) * 2.0**-53


def _log_factorial(k: Column) -> Column:
    """ln k! of a whole number as a double: exact below 16, by Stirling's series above."""
    table = F.array(*(F.lit(math.lgamma(i + 1)) for i in range(16)))

    def value(x):
        tail = (1 / 12 - (1 / 360 - 1 / (1260 * x * x)) / (x * x)) / x
        return F.when(x <= 16, F.get(table, x.cast("int") - 1)).otherwise((x - 0.5) * F.ln(x) - x + 0.5 * math.log(2 * math.pi) + tail)

    return _let(k + 1.0, value)


def _one_by_one(good: Column, total: Column, sample: Column, *key: Column) -> Column:
    """Good ones among ``sample`` draws without replacement."""

    def draw(taken, i):
        hit = (i < sample) & (_uniform(*key, i) * (total - i) < good - taken)
        return taken + F.when(hit, 1).otherwise(0).cast("long")

    return F.aggregate(F.sequence(F.lit(0).cast("long"), sample), F.lit(0).cast("long"), draw)


def _by_ratio(few: Column, many: Column, sample: Column, *key: Column) -> Column:
    """The same by ratio of uniforms (Stadlober 1990): ``few`` of the good ones, ``sample`` at most half of all.

    An attempt succeeds with a probability of about 0.7 and does not depend on the others, so one of ``ATTEMPTS``
    always does.
    """
    few, many, sample = (c.cast("double") for c in (few, many, sample))
    total = few + many

    def weight(k):
        # Minus the logarithm of the factorials below the binomial coefficients.
        return F.aggregate(F.array(k, few - k, sample - k, many - sample + k), F.lit(0.0), lambda a, x: a - _log_factorial(x))

    def attempts(known):
        def judge(u, i):
            place = F.floor(known["mean"] + known["width"] * (_uniform(*key, i, F.lit(1)) - 0.5) / u).cast("double")
            return _let(place, lambda k: F.when(k.between(0, known["most"]), F.when(2 * F.ln(u) <= weight(k) - known["top"], k)))

        tries = F.sequence(F.lit(0), F.lit(ATTEMPTS - 1))
        return F.aggregate(tries, F.lit(None).cast("double"), lambda found, i: F.coalesce(found, _let(_uniform(*key, i, F.lit(0)), lambda u: judge(u, i))))

    deviation = F.sqrt((total - sample) * sample * few / total * many / total / (total - 1) + 0.5)
    known = F.struct(
        (sample * few / total + 0.5).alias("mean"),
        (2 * math.sqrt(2 / math.e) * deviation + (3 - 2 * math.sqrt(3 / math.e))).alias("width"),
        F.least(few, sample).alias("most"),
        _let(F.floor((sample + 1) * (few + 1) / (total + 2)).cast("double"), weight).alias("top"),
    )
    return _let(known, attempts).cast("long")


def hypergeometric(good: Column, bad: Column, sample: Column, *key: Column) -> Column:
    """How many of ``sample`` things drawn from ``good`` and ``bad`` ones are good: a draw that ``key`` decides."""

    def drawn(p):
        few, many = F.least(p["good"], p["bad"]), F.greatest(p["good"], p["bad"])
        fewer = F.when(p["n"] <= SMALL, _one_by_one(few, few + many, p["n"], *key)).otherwise(_by_ratio(few, many, p["n"], *key))
        found = _let(fewer, lambda z: F.when(p["good"] <= p["bad"], z).otherwise(p["n"] - z))
        # What is left out is drawn where it is fewer.
        return _let(found, lambda z: F.when(p["n"] == p["sample"], z).otherwise(p["good"] - z))

    parts = F.struct(good.alias("good"), bad.alias("bad"), sample.alias("sample"), F.least(sample, good + bad - sample).alias("n"))
    return _let(parts, drawn)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def matrix_row(capacity: Column, rows: Column, shards: int, *key: Column) -> Column:
    """A multivariate hypergeometric draw: how many of ``rows`` fill each shard's ``capacity`` (an array)."""

    def fill(state, shard):
        room = F.get(capacity, shard)
        return _let(
            hypergeometric(room, state["pool"] - room, state["rows"], *key, shard),
            lambda x: F.struct(
                (state["rows"] - x).alias("rows"), (state["pool"] - room).alias("pool"), F.concat(state["out"], F.array(x)).alias("out")
            ),
        )

    first = F.struct(rows.alias("rows"), _sum(capacity).alias("pool"), F.array().cast("array<bigint>").alias("out"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(shards - 1)), first, fill, lambda state: state["out"])


def _matrix(nodes: Column, capacity: Column, shards: int, seed: Column) -> Column:
    """For each of the ``nodes`` (key, rows), in order: key, rows, counts by shard, and the counts of the nodes before."""

    def add(a, b):
        return F.zip_with(a, b, lambda x, y: x + y)

    def take(state, node):
        return _let(
            matrix_row(state["left"], node["rows"], shards, seed, F.xxhash64(node["key"])),
            lambda own: F.struct(
                F.zip_with(state["left"], own, lambda x, y: x - y).alias("left"),
                add(state["starts"], own).alias("starts"),
                F.concat(state["out"], F.array(F.struct(node["key"].alias("key"), node["rows"].alias("rows"), own.alias("counts"), state["starts"].alias("starts")))).alias("out"),
            ),
        )

    zeros = F.array_repeat(F.lit(0).cast("long"), shards)
    empty = F.filter(F.transform(nodes, lambda n: F.struct(n["key"].alias("key"), n["rows"].alias("rows"), zeros.alias("counts"), zeros.alias("starts"))), lambda n: F.lit(False))
    first = F.struct(capacity.alias("left"), zeros.alias("starts"), empty.alias("out"))
    return F.aggregate(nodes, first, take, lambda state: state["out"])


def permuted(place: Column, size: Column, *key: Column) -> Column:
    """A bijection of 0 to ``size - 1`` that ``key`` decides: in each round a place may swap with its partner."""

    def swap(at, i):
        partner = F.pmod(F.pmod(F.xxhash64(*key, i), size) - at, size)
        return _let(partner, lambda other: F.when(F.xxhash64(*key, i, F.greatest(at, other)) < 0, other).otherwise(at))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), place, swap)


def communication_matrix(blocks: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``file, block, rows, counts, starts, sizes``: how many rows each block gives each shard, the blocks before it
    gave, and each shard's size; ``blocks`` are ``file, block, rows``."""
    grouped = blocks.select(
        F.pmod(F.xxhash64("file", "block"), F.lit(GROUPS)).alias("group"), F.struct(F.struct("file", "block").alias("key"), "rows").alias("node")
    )
    totals = grouped.groupBy("group").agg(F.sum("node.rows").alias("rows"))
    every = totals.agg(
        F.array_sort(F.collect_list(F.struct(F.col("group").alias("key"), "rows"))).alias("nodes"), F.coalesce(F.sum("rows"), F.lit(0)).alias("n")
    )
    each = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.floor(F.col("n") / shards) + F.when(s < F.col("n") % shards, 1).otherwise(0))
    every = every.withColumn("sizes", each)
    groups = every.select("sizes", F.explode(_matrix(F.col("nodes"), F.col("sizes"), shards, F.lit(seed))).alias("g"))
    groups = groups.select(F.col("g.key").alias("group"), "sizes", F.col("g.counts").alias("capacity"), F.col("g.starts").alias("before"))
    inside = grouped.groupBy("group").agg(F.array_sort(F.collect_list("node")).alias("nodes")).join(groups, "group")
    cells = inside.select("sizes", "before", F.explode(_matrix(F.col("nodes"), F.col("capacity"), shards, F.lit(seed + 1))).alias("b"))
    starts = F.zip_with("before", "b.starts", lambda x, y: x + y)
    return cells.select("b.key.file", "b.key.block", "b.rows", "b.counts", starts.alias("starts"), "sizes")


def shuffled(rows: DataFrame, shards: int = SHARDS, seed: int = SEED, in_place: bool = False) -> DataFrame:
    """All rows and columns of ``rows`` with ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard).

    Shards differ by at most one row; which rows share a shard and their order are as good as random, and the same
    for the same table and seed. Rows come dealt by shard and run of slots, in the order of slots. Nulls, empty
    texts and repeated rows are rows like any other: a row's place, not its values, decides. An empty table gives
    none. Columns named ``shard`` or ``slot`` are replaced.

    The table is written to the shared folder first, so that places are fixed; ``in_place`` leaves that out for a
    table read from Parquet files with all their rows. The matrix is joined by block: broadcast where Spark
    finds it small, else the rows are dealt by block for it.
    """
    columns = [c for c in rows.columns if c.lower() not in ("shard", "slot")]
    table = (rows if in_place else staged(rows, "rows")).select(*(f"`{c}`" for c in columns), "_metadata")
    names = [f"{what}{'_' * max(map(len, columns), default=0)}" for what in ("file", "place", "block", "cell")]
    file, place, block, cell = names
    table = table.withColumns({file: F.col("_metadata.file_path"), place: F.col("_metadata.row_index")}).drop("_metadata")
    table = table.withColumn(block, F.floor(F.col(place) / BLOCK_ROWS))
    blocks = table.groupBy(F.col(file).alias("file"), F.col(block).alias("block")).agg(
        F.count("*").alias("rows"), (F.max(place) - F.min(place) + 1).alias("span"), F.min(place).alias("first")
    )
    blocks = staged(blocks, "blocks")
    if not blocks.filter((F.col("rows") != F.col("span")) | (F.col("first") % BLOCK_ROWS != 0)).isEmpty():
        raise ValueError("in_place needs all rows of the files, each once")
    matrix = staged(communication_matrix(blocks.drop("span", "first"), shards, seed), "matrix")
    cells = matrix.select(F.col("file").alias(file), F.col("block").alias(block), F.struct("rows", "counts", "starts", "sizes").alias(cell))
    own = table.join(cells, [file, block])

    local = permuted(F.col(place) - F.col(block) * BLOCK_ROWS, F.col(f"{cell}.rows"), F.lit(seed + 2), F.col(file), F.col(block))
    own = own.withColumn(place, local)

    def deal(state, count):
        """The shard whose share of the block holds the place, and the place inside that share."""
        here = state["shard"].isNull() & (state["at"] < count)
        return F.struct(
            F.when(here, state["next"]).otherwise(state["shard"]).alias("shard"),
            F.when(state["shard"].isNull() & ~here, state["at"] - count).otherwise(state["at"]).alias("at"),
            (state["next"] + 1).alias("next"),
        )

    first = F.struct(F.lit(None).cast("int").alias("shard"), F.col(place).alias("at"), F.lit(0).alias("next"))
    own = own.withColumn(place, F.aggregate(f"{cell}.counts", first, deal))
    shard, at = F.col(f"{place}.shard"), F.col(f"{place}.at")
    own = own.select(
        *(f"`{c}`" for c in columns),
        shard.alias("shard"),
        permuted(F.get(F.col(f"{cell}.starts"), shard) + at, F.get(F.col(f"{cell}.sizes"), shard), F.lit(seed + 3), shard).alias("slot"),
    )
    return own.repartition(F.col("shard"), F.floor(F.col("slot") / CHUNK)).sortWithinPartitions("shard", "slot")


def shard_digest(rows: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of shuffled documents; a null text has no bytes."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return rows.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit(LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
