"""Vector codes: product quantization whose nearest entries are found by Orchard's search.

Orchard, "A fast nearest-neighbor search algorithm" (1991). Vectors are whole numbers, cut into parts; each
part position has a codebook. Every entry of a codebook keeps a list of the others by distance from itself. A
search holds a current entry and walks its list; an entry that is nearer to the query becomes the current one
and the walk goes on with its list; entries compared once are marked and skipped. When the next one in
the list is farther from the current entry than twice the query's distance, no later one can be nearer.

A round is one pass over the vectors: tasks search and send the sums and counts of their parts, one row for each
entry, so what the driver gets is as large as the codebooks, however many vectors there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsignal.llm.common import batches, staged

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Components are below this in absolute value, so that sums of squares stay whole numbers of 64 bits.
LARGEST = 1 << 17
#: Vectors that are searched together.
BLOCK = 4096


@dataclass(frozen=True)
class Codebook:
    """Entries of one part position, their squared distances, and each one's list of the others, nearest first."""

    entries: np.ndarray

    @property
    def gaps(self) -> np.ndarray:
        apart = self.entries[:, None, :] - self.entries[None, :, :]
        return (apart * apart).sum(axis=2)

    def lists(self) -> tuple[np.ndarray, np.ndarray]:
        """For each entry, the others by distance and then index, and those squared distances."""
        gaps = self.gaps
        n = len(gaps)
        order = np.lexsort((np.broadcast_to(np.arange(n), (n, n)), gaps))
        others = order[order != np.arange(n)[:, None]].reshape(n, n - 1)
        return others, np.take_along_axis(gaps, others, axis=1)


def bounds(dimension: int, parts: int = PARTS) -> list[int]:
    """Where the parts begin and end: equal ones, or the first ones longer by a component."""
    return [i * (dimension // parts) + min(i, dimension % parts) for i in range(parts + 1)]


def nearest(queries: np.ndarray, book: Codebook) -> tuple[np.ndarray, np.ndarray]:
    """Index of each query's nearest entry (of several, the lowest) and the squared distance, by Orchard's search."""
    others, gaps = book.lists()
    n, rest = len(queries), len(book.entries) - 1
    current, best = np.zeros(n, np.int64), ((queries - book.entries[0]) ** 2).sum(axis=1)
    seen = np.zeros((n, rest + 1), bool)
    seen[:, 0] = True
    active, at = np.arange(n), np.zeros(n, np.int64)
    while rest and len(active):
        here, place = current[active], at[active]
        # (twice the distance) squared; an entry exactly there may tie, so only farther ones end the walk.
        going = gaps[here, place] <= 4 * best[active]
        active, here, place = active[going], here[going], place[going]
        other = others[here, place]
        at[active] += 1
        new = ~seen[active, other]
        ask, other = active[new], other[new]
        seen[ask, other] = True
        apart = ((queries[ask] - book.entries[other]) ** 2).sum(axis=1)
        better = (apart < best[ask]) | ((apart == best[ask]) & (other < current[ask]))
        moved = ask[better]
        current[moved], best[moved], at[moved] = other[better], apart[better], 0
        active = active[at[active] < rest]
    return current, best


def _whole(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, size, grid`` of rows whose vector has no null or non-finite component; ``grid``: 32-bit numbers."""

    def work(parts):
        for part in parts:
            column = part.column(1)
            rows, kept = [], []
            for row in range(part.num_rows):
                value = column[row]
                if not value.is_valid or value.values.null_count:
                    continue
                vector = value.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if np.isfinite(vector).all():
                    grid = np.floor(SCALE * vector)
                    if len(grid) and np.abs(grid).max() >= LARGEST * SCALE:
                        raise ValueError(f"a component is {LARGEST} or more in absolute value")
                    kept.append(row)
                    rows.append(grid.astype("<i4").tobytes())
            at = pa.array(kept, pa.int64())
            sizes = pa.array([len(r) // 4 for r in rows], pa.int32())
            yield pa.record_batch([part.column(0).take(at), part.column(2).take(at), sizes, pa.array(rows, pa.binary())], ["vec_id", "label", "size", "grid"])

    return batches(vectors, work, "vec_id long, label string, size int, grid binary")


def _blocks(part: pa.RecordBatch, at: int) -> Iterator[tuple[slice, np.ndarray]]:
    for low in range(0, part.num_rows, BLOCK):
        rows = slice(low, min(part.num_rows, low + BLOCK))
        data = b"".join(part.column(at)[rows].to_pylist())
        yield rows, np.frombuffer(data, "<i4").reshape(rows.stop - rows.start, -1).astype(np.int64)


def _refined(grids: DataFrame, books: list[Codebook], edges: list[int]) -> list[Codebook]:
    """One round: every entry becomes the floor of the mean of its parts; an entry without parts stays."""

    def work(parts):
        counts = [np.zeros(len(b.entries), np.int64) for b in books]
        sums = [np.zeros_like(b.entries) for b in books]
        for part in parts:
            for _, grid in _blocks(part, 0):
                for p, book in enumerate(books):
                    own = grid[:, edges[p] : edges[p + 1]]
                    found, _ = nearest(own, book)
                    counts[p] += np.bincount(found, minlength=len(book.entries))
                    np.add.at(sums[p], found, own)
        rows = [(p, e, int(counts[p][e]), sums[p][e].tolist()) for p in range(len(books)) for e in range(len(books[p].entries)) if counts[p][e]]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 4, kinds)], ["part", "entry", "n", "sums"])

    sent = batches(grids.select("grid"), work, "part int, entry int, n long, sums array<long>")
    width = max(b - a for a, b in zip(edges, edges[1:]))
    # Sums of all vectors may outgrow 64 bits, so they are added as decimals.
    totals = [F.sum(F.get("sums", F.lit(i)).cast("decimal(20,0)")).alias(f"s{i}") for i in range(width)]
    entries = [b.entries.copy() for b in books]
    for row in sent.groupBy("part", "entry").agg(F.sum("n").alias("n"), *totals).collect():
        entries[row.part][row.entry] = [int(row[f"s{i}"]) // row.n for i in range(edges[row.part + 1] - edges[row.part])]
    return [Codebook(e) for e in entries]


def codebooks_digest(books: list[Codebook]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for e in b.entries.tolist() for x in e).encode()).hexdigest()


def codebooks(grids: DataFrame, dimension: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[Codebook]:
    """The codebooks after ``rounds``, begun with the vectors of the smallest ids (a null id is the largest; equal ids by vector)."""
    first = grids.orderBy(F.col("vec_id").asc_nulls_last(), "grid").limit(entries).select("grid").collect()
    start = np.array([np.frombuffer(r.grid, "<i4") for r in first], np.int64).reshape(len(first), dimension)
    edges = bounds(dimension, parts)
    books = [Codebook(start[:, a:b]) for a, b in zip(edges, edges[1:])]
    for _ in range(rounds):
        books = _refined(grids, books, edges)
    return books


def encoded(grids: DataFrame, books: list[Codebook], dimension: int) -> DataFrame:
    """``vec_id, label, code, error``: two hex digits a part, and the sum of the parts' squared distances."""
    edges = bounds(dimension, len(books))

    def work(parts):
        for part in parts:
            codes, errors = [], np.zeros(part.num_rows, np.int64)
            for rows, grid in _blocks(part, 2):
                found = np.zeros((len(grid), len(books)), np.uint8)
                for p, book in enumerate(books):
                    found[:, p], apart = nearest(grid[:, edges[p] : edges[p + 1]], book)
                    errors[rows] += apart
                codes += [row.tobytes().hex() for row in found]
            yield pa.record_batch([part.column(0), part.column(1), pa.array(codes, pa.string()), pa.array(errors)], ["vec_id", "label", "code", "error"])

    return batches(grids.select("vec_id", "label", "grid"), work, "vec_id long, label string, code string, error long")


def compressed(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every row of ``vectors`` (``vec_id, embedding, label``) that is kept.

    Rows whose vector is null or holds null or non-finite components are dropped, and so are those without the
    length of the vector with the smallest id. Fewer vectors than ``entries`` give as many entries. Repeated rows
    are vectors of their own with equal codes; a null id or label stays null. A length that is no multiple of
    ``parts`` makes the first parts longer by one. An empty table gives no rows. Other columns are not read.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must be between 1 and 256")
    table = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"), F.col("label").cast("string"))
    grids = staged(_whole(table), "grids")
    first = grids.orderBy(F.col("vec_id").asc_nulls_last(), "grid").select("size").first()
    dimension = first.size if first else 0
    grids = grids.filter(F.col("size") == dimension)
    books = codebooks(grids, dimension, parts, entries, rounds) if first else [Codebook(np.empty((0, 0), np.int64))]
    coded = staged(encoded(grids, books, dimension), "codes")
    by_label = coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    done = coded.join(by_label, F.col("label").eqNullSafe(F.col("of_label")))
    return done.select("vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
