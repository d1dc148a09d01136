"""Order without a total sort: numbers for rows of files, and the value at a rank.

Both work on counts. A rank is found by its leading digits first: rows are counted by the digits that are left of a
place value, the count that holds the rank gives those digits, and only its rows are counted by the next ones. So no
step has more than ``RADIX`` counters a key, whether the values are dense or scattered over all 64 bits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsignal.sinks.tables import stage

#: Counters of a key in one step, as a power of two.
DIGIT_BITS = 16
RADIX = 1 << DIGIT_BITS
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_TIMES = (T.TimestampType, T.TimestampNTZType)


def running_before(rows: DataFrame, order: list[str], count: str, out: str) -> DataFrame:
    """``rows`` with the sum of ``count`` over all rows before, by ``order`` (unique).

    The rows are dealt by ranges of the order and written; each file's sum and smallest row give what lies before it.
    One window runs inside a file, and one over the files, of which there are as many as shuffle partitions.
    """
    dealt = stage(rows.repartitionByRange(*order).sortWithinPartitions(*order), "ranges")
    dealt = dealt.select("*", F.col("_metadata.file_path").alias("_range"))
    files = dealt.groupBy("_range").agg(F.sum(count).alias("_sum"), F.min(F.struct(*order)).alias("_first"))
    ahead = Window.orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("_range", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_ahead"))
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(count).over(inside), F.lit(0)) + F.col("_ahead")
    return dealt.join(files, "_range").withColumn(out, before.cast("bigint")).drop("_range", "_ahead")


def numbered_lines(lines: DataFrame, place: str, out: str) -> DataFrame:
    """``lines`` with ``out``, a bigint that counts them from 0 by file, block and line; ``place`` goes.

    ``place`` is a struct of ``file``, ``block`` and ``line``; the lines of a block have consecutive ``line`` numbers.
    Two passes: the rows of each block, then each row's number in its block behind those of the blocks before.
    """
    rows = lines.withColumns({"_file": F.col(place)["file"], "_block": F.col(place)["block"], "_line": F.col(place)["line"]})
    blocks = rows.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_line").alias("_start"))
    blocks = running_before(blocks, ["_file", "_block"], "_n", "_before").drop("_n")
    met = rows.drop(place).join(blocks, ["_file", "_block"])
    number = F.col("_before") + F.col("_line") - F.col("_start")
    return met.withColumn(out, number).drop("_file", "_block", "_line", "_start", "_before")


def _digits(value: Column, shift: int) -> Column:
    return F.shiftright(value.cast("bigint"), shift)


def _as_long(value: Column, kind: T.DataType) -> Column:
    return F.unix_micros(value.cast("timestamp")) if isinstance(kind, _TIMES) else value.cast("bigint")


def _as_was(value: Column, kind: T.DataType) -> Column:
    return F.timestamp_micros(value).cast(kind) if isinstance(kind, _TIMES) else value.cast(kind)


def _shift(low: int, high: int) -> int:
    """The smallest place value (as a power of two) that leaves fewer than ``RADIX`` values from ``low`` to ``high``."""
    shift = 0
    while (high >> shift) - (low >> shift) >= RADIX:
        shift += 1
    return shift


def _descend(rows: DataFrame, state: DataFrame, keys: list[str], field: str) -> DataFrame:
    """``keys, _rank`` (among the rows with the value) and ``_value`` of ``field`` at each key's ``_rank``, smallest first.

    Keys with fewer rows have no row in the result.
    """
    ends = rows.agg(F.min(field).alias("low"), F.max(field).alias("high")).first()
    if ends.low is None:
        return state.limit(0).withColumn("_value", F.lit(None).cast("bigint"))
    shift = _shift(ends.low, ends.high)
    counted = rows
    while True:
        counted = counted.withColumn("_digits", _digits(F.col(field), shift))
        counts = counted.groupBy(*keys, "_digits").agg(F.count(F.lit(1)).alias("_n"))
        earlier = Window.partitionBy(*keys).orderBy("_digits").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("_less", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).join(state, keys)
        holds = (F.col("_less") < F.col("_rank")) & (F.col("_less") + F.col("_n") >= F.col("_rank"))
        rank = (F.col("_rank") - F.col("_less")).alias("_rank")
        found = stage(counts.where(holds).select(*keys, rank, F.col("_digits").alias("_value")), "rank")
        if shift == 0:
            return found
        held = found.select(*keys, F.col("_value").alias("_held"))
        counted = rows.withColumn("_held", _digits(F.col(field), shift)).join(held, [*keys, "_held"], "left_semi")
        state, shift = found.select(*keys, "_rank"), max(0, shift - DIGIT_BITS)


def value_at_rank(rows: DataFrame, rank: int | DataFrame, order: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """``keys, order``: the value of ``order`` at a rank (from 1) within each key; keys with fewer rows have none.

    ``order`` is an integer, a time or a struct of these, compared field by field; rows in which a part of it is null
    have no place. ``rank`` is one for all keys, or a table ``keys, rank`` (keys without a rank have no result).
    """
    kind = rows.schema[order].dataType
    fields = [f"{order}.{f.name}" for f in kind.fields] if isinstance(kind, T.StructType) else [order]
    kinds = [f.dataType for f in kind.fields] if isinstance(kind, T.StructType) else [kind]
    if not all(isinstance(k, (*_INTEGERS, *_TIMES)) for k in kinds):
        raise ValueError(f"{order} must be an integer, a time or a struct of these")
    # Rows without keys share one, so that every window has a partition.
    own = list(keys) or ["_all"]
    places = rows.select(*(keys or [F.lit(0).alias("_all")]), *(_as_long(F.col(f), k).alias(f"_f{i}") for i, (f, k) in enumerate(zip(fields, kinds))))
    places = stage(places.where(reduce(Column.__and__, (F.col(f"_f{i}").isNotNull() for i in range(len(fields))))), "places")
    if isinstance(rank, DataFrame):
        state = rank.select(*keys, F.col("rank").cast("bigint").alias("_rank")).where("_rank >= 1")
    else:
        state = places.select(*own).distinct().withColumn("_rank", F.lit(rank).cast("bigint")).where("_rank >= 1")
    chosen = None
    for i in range(len(fields)):
        found = _descend(places, state, own, f"_f{i}")
        state = found.select(*own, "_rank")
        if i + 1 < len(fields):
            places = places.join(found.select(*own, F.col("_value").alias(f"_f{i}")), [*own, f"_f{i}"], "left_semi")
        values = found.select(*own, F.col("_value").alias(f"_v{i}"))
        chosen = values if chosen is None else chosen.join(values, own)
    parts = [_as_was(F.col(f"_v{i}"), k) for i, k in enumerate(kinds)]
    if isinstance(kind, T.StructType):
        value = F.struct(*(p.alias(f.name) for p, f in zip(parts, kind.fields)))
    else:
        value = parts[0]
    return chosen.select(*keys, value.alias(order))
