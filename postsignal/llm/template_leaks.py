"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders. Windows of canonical words of the benchmark are joined
by hash with those of the documents, so a question with other numbers or names still matches. Matches on one
alignment of a document with an item must fill the slots consistently: equal values stay equal and different
values stay different.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsignal.llm.common import (
    ALPHANUMERIC,
    COUNT_ROWS,
    LOWER,
    Texts,
    batches,
    byte_class,
    count_rows,
    mix,
    slices,
    staged,
    total_counts,
)

#: Words of a window, and ordinary words that a canonical one must hold.
WINDOW = 8
LITERALS = 5
#: An item is found where so much of its words is covered, or so many words in a row.
COVERAGE = 0.5
RUN = 25
#: Items of fewer words are found only as the whole text of a document.
SHORT = 4
#: Places of the filter that document windows pass before the join (its size does not grow).
FILTER = 1 << 22

# Words that stand for numbers, and units of measure.
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
    "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
).split()
UNIT_WORDS = (
    "mm cm m km inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers "
    "g kg mg gram grams kilogram kilograms ounce ounces pound pounds ton tons ml l liter liters litre litres "
    "second seconds minute minutes hour hours day days week weeks month months year years "
    "cent cents dollar dollars euro euros percent degree degrees mph kph watt watts volt volts joule joules"
).split()

_DIGIT, _CAPITAL, _SMALL = byte_class((48, 57)), byte_class((65, 90)), byte_class((97, 122), (128, 255))
_POINT, _STOP = byte_class((44, 44), (46, 46)), byte_class((33, 33), (46, 46), (63, 63), (10, 10))
_KEYS = np.random.default_rng(3).integers(1, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
WINDOWS = "place int, window long, slots array<long>, literal boolean, size int, words int"


def _known(words: list[str]) -> np.ndarray:
    return Texts(range(1), [" ".join(words).encode()]).tokens(ALPHANUMERIC)[2]


_NUMBERS, _UNITS = _known(NUMBER_WORDS), _known(UNIT_WORDS)


def canonical(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words with placeholders, whether each is one, the words themselves, and ``bounds``.

    A number is digits with points or commas inside, or a number word. A name is a capital with small letters
    that does not begin a sentence.
    """
    raw = texts.data
    inside = _inside(texts)
    digit, point = _DIGIT[raw], _POINT[raw]
    starts, ends, words, bounds = texts.runs(LOWER[raw], inside)
    stops = np.concatenate(([0], np.cumsum(_STOP[raw] & ~inside)))
    before = np.concatenate(([0], ends[:-1]))
    opens = stops[starts] > stops[before]
    opens[bounds[:-1][bounds[:-1] < len(starts)]] = True
    digits = np.concatenate(([0], np.cumsum(digit | (point & inside))))
    number = (digits[ends] - digits[starts] == ends - starts) | np.isin(words, _NUMBERS)
    unit = np.isin(words, _UNITS)
    follows = raw[np.minimum(starts + 1, len(raw) - 1)]
    name = _CAPITAL[raw[starts]] & _SMALL[follows] & (ends - starts > 1) & ~opens & ~number & ~unit
    slot = number | unit | name
    return np.where(number, _KEYS[40], np.where(unit, _KEYS[41], np.where(name, _KEYS[42], words))), slot, words, bounds


def windows(texts: Texts, size: int = WINDOW) -> tuple[np.ndarray, ...]:
    """Place, text and hash of every window with enough ordinary words; the slice's slots, words and bounds."""
    template, slot, words, bounds = canonical(texts)
    n = max(0, len(template) - size + 1)
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total += template[i : i + n] * _KEYS[i]
    text = np.repeat(np.arange(len(texts.rows)), np.diff(bounds))
    slots = np.concatenate(([0], np.cumsum(slot)))
    good = (text[:n] == text[size - 1 : size - 1 + n]) & (slots[size : size + n] - slots[:n] <= size - LITERALS)
    at = np.flatnonzero(good)
    return at, text[at], mix(total[at]), slot, words, bounds


def literal_windows(texts: Texts, sizes: list[int], whole: bool) -> Iterator[tuple]:
    """Size, place, text and hash of windows of a case-folded slice, and its bounds.

    Texts of ``WINDOW`` words or more give their windows of that size. Sizes below it are those of whole items:
    with ``whole`` a text gives only itself, otherwise all its windows, below ``SHORT`` only itself.
    """
    inside = _inside(texts)
    words, bounds = texts.runs(LOWER[texts.data], inside)[2:]
    lengths = np.diff(bounds)
    text = np.repeat(np.arange(len(texts.rows)), lengths)
    for size in (*sizes, WINDOW):
        n = max(0, len(words) - size + 1)
        good = text[:n] == text[size - 1 : size - 1 + n]
        if size < WINDOW and (whole or size < SHORT):
            good &= lengths[text[:n]] == size
        at = np.flatnonzero(good)
        total = np.full(len(at), size, np.uint64)
        for i in range(size):
            total += words[at + i] * _KEYS[20 + i]
        yield size, at, text[at], mix(total), bounds


def _inside(texts: Texts) -> np.ndarray:
    raw = texts.data
    inside = ALPHANUMERIC[raw]
    digit, point = _DIGIT[raw], _POINT[raw]
    inside[1:-1] |= point[1:-1] & digit[:-2] & digit[2:]
    return inside


def _record(ids: pa.Array, rows, places, window, values, literal: bool, size: int, words) -> pa.RecordBatch:
    n = len(window)
    return pa.record_batch(
        [
            ids.take(pa.array(rows)),
            pa.array(places.astype(np.int32)),
            pa.array(window.view(np.int64)),
            pa.array(values, pa.list_(pa.int64())),
            pa.array(np.full(n, literal)),
            pa.array(np.full(n, size, np.int32)),
            pa.array(words.astype(np.int32)),
        ],
        ["id", "place", "window", "slots", "literal", "size", "words"],
    )


def _window_rows(texts: Texts, folded: Texts, ids: pa.Array, keep: np.ndarray | None, sizes: list[int]) -> Iterator[pa.RecordBatch]:
    def passed(window):
        return slice(None) if keep is None else keep[(window % np.uint64(FILTER)).astype(np.int64)]

    at, text, window, slot, words, bounds = windows(texts)
    good = passed(window)
    at, text, window = at[good], text[good], window[good]
    values = [words[a : a + WINDOW][slot[a : a + WINDOW]].view(np.int64) for a in at.tolist()]
    yield _record(ids, texts.rows.start + text, at - bounds[text], window, values, False, WINDOW, np.diff(bounds)[text])
    for size, at, text, window, bounds in literal_windows(folded, sizes, keep is None):
        good = passed(window)
        at, text, window = at[good], text[good], window[good]
        yield _record(ids, texts.rows.start + text, at - bounds[text], window, [[]] * len(at), True, size, np.diff(bounds)[text])


def _rows(frame: DataFrame, sizes: list[int], keep=None) -> DataFrame:
    def work(parts):
        for part in parts:
            for texts in slices(part.column(1)):
                own = part.column(1).slice(texts.rows.start, len(texts.rows)).to_pylist()
                folded = Texts(texts.rows, [(t or "").casefold().encode("utf-8", "surrogatepass") for t in own])
                yield from _window_rows(texts, folded, part.column(0), None if keep is None else keep.value, sizes)

    return batches(frame, work, f"id long, {WINDOWS}")


def _covered(places, size):
    """Words under windows of one size at sorted places, and the most of them in a row."""
    none = F.struct(F.lit(0).alias("all"), F.lit(0).alias("run"), F.lit(0).alias("most"), F.lit(0).alias("end"))

    def step(had, place):
        added = F.least(size, place + size - had["end"])
        run = F.when(place <= had["end"], had["run"] + added).otherwise(size)
        return F.struct((had["all"] + added).alias("all"), run.alias("run"), F.greatest(had["most"], run).alias("most"), (place + size).alias("end"))

    return F.aggregate(places, none, step)


def leaks(documents: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, run: int = RUN) -> DataFrame:
    """Documents that hold benchmark items: one row per document and item, ``doc_id, item_id`` and more.

    ``n_windows`` of the item's ``item_windows`` places match on the best alignment, ``coverage`` is the share of
    its words that they cover, ``n_changed`` counts slots whose value differs, ``place`` is the word at which the
    first match begins. An item is found by ``coverage`` or by ``run`` words in a row. Where the slots of an
    alignment clash, only its literal windows count. Items of fewer than ``WINDOW`` words are searched as a whole,
    with their values; those below ``SHORT`` only as a whole document. Null texts count as empty. A document is an id
    and a text, known by a hash of both: repeated rows count as one, and texts that share an id, or have none, are each
    judged alone and reported under that id. Empty tables give no rows. Other columns are not read.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    items = staged(_rows(items.distinct(), list(range(1, WINDOW))), "windows")
    sizes = sorted(r["size"] for r in items.filter(F.col("size") < WINDOW).select("size").distinct().collect())

    def mark(parts):
        places = np.zeros(FILTER, np.int64)
        for part in parts:
            places[(part.column(0).to_numpy().view(np.uint64) % np.uint64(FILTER)).astype(np.int64)] = 1
        yield from count_rows(places)

    marks = total_counts(batches(items.select("window"), mark, COUNT_ROWS), FILTER) > 0
    keep = documents.sparkSession.sparkContext.broadcast(marks)
    texts = documents.select(F.col("doc_id").cast("long").alias("own_id"), F.col("text").cast("string").alias("text"))
    texts = texts.withColumn("id", F.xxhash64(F.col("own_id").isNull(), "own_id", F.col("text").isNull(), "text"))
    found = _rows(texts.select("id", "text"), sizes, keep).drop("literal", "size", "words")
    found = found.withColumnsRenamed({"id": "doc_id", "place": "doc_place", "slots": "doc_slots"})
    own = items.withColumnsRenamed({"id": "item_id", "place": "item_place", "slots": "item_slots"})
    pairs = found.join(own, "window").select(
        "doc_id",
        "item_id",
        (F.col("doc_place") - F.col("item_place")).alias("shift"),
        "item_place",
        "literal",
        "size",
        "words",
        F.arrays_zip("item_slots", "doc_slots").alias("slots"),
    )
    # An alignment has at most the item's windows, so its slots are few.
    aligned = pairs.groupBy("doc_id", "item_id", "shift").agg(
        F.collect_set("item_place").alias("places"),
        F.collect_set(F.when(F.col("literal"), F.col("item_place"))).alias("literal_places"),
        F.max("size").alias("size"),
        F.max("words").alias("words"),
        F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"),
    )
    filled = F.size("slots")
    fits = (F.size(F.array_distinct("slots.item_slots")) == filled) & (F.size(F.array_distinct("slots.doc_slots")) == filled)
    changed = F.size(F.filter("slots", lambda s: s["item_slots"] != s["doc_slots"]))
    aligned = aligned.select(
        "doc_id",
        "item_id",
        "shift",
        "size",
        "words",
        F.array_sort(F.when(fits, F.col("places")).otherwise(F.col("literal_places"))).alias("places"),
        F.when(fits, changed).otherwise(0).alias("n_changed"),
    ).filter(F.size("places") > 0)
    aligned = aligned.withColumn("covered", _covered(F.col("places"), F.col("size"))).select(
        "doc_id",
        "item_id",
        F.size("places").cast("long").alias("n_windows"),
        "n_changed",
        (F.element_at("places", 1) + F.col("shift")).alias("place"),
        (F.col("covered.all") / F.col("words")).alias("coverage"),
        F.col("covered.most").alias("run"),
    )
    aligned = aligned.filter((F.col("coverage") >= coverage) | (F.col("run") >= run))
    best = aligned.groupBy("doc_id", "item_id").agg(
        F.max_by(
            F.struct("n_windows", "n_changed", "place", "coverage"), F.struct("coverage", "n_windows", -F.col("n_changed"), -F.col("place"))
        ).alias("best")
    )
    best = staged(best.withColumnRenamed("doc_id", "id"), "leaks")
    totals = own.groupBy("item_id").agg(F.countDistinct("item_place").alias("item_windows"))
    names = texts.select("id", "own_id").join(best.select("id"), "id", "left_semi").distinct()
    met = best.join(names, "id").alias("b").join(totals.alias("t"), F.col("b.item_id").eqNullSafe(F.col("t.item_id")))
    return met.select(
        F.col("b.own_id").alias("doc_id"), "b.item_id", "b.best.n_windows", "b.best.n_changed", "b.best.place", "t.item_windows", "b.best.coverage"
    )
