"""Helpers of the operators: staged tables, hashed tokens of whole texts, connected components.

Texts are worked on in Arrow batches inside tasks. A token, a run of tokens or a set is known by a
64-bit hash that does not depend on the batch, the task or the machine.
"""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes of text that a task hashes at a time; one longer text is taken alone.
SLICE_BYTES = 1 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[str, np.ndarray] = {}


#: Folders of local applications that name none.
_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``; a local session without that setting gets one of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if context.applicationId not in _FOLDERS:
            _FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="postsignal-llm-")
        root = _FOLDERS[context.applicationId]
    return f"{root.rstrip('/')}/{name}_{uuid.uuid4().hex}"


def staged(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: later readers and lost executors reread it."""
    spark = frame.sparkSession
    path = shared_folder(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the files of shuffles that no frame needs any more, which it does when the driver collects garbage."""
    spark.sparkContext._jvm.java.lang.System.gc()


_SHIPPED: set[str] = set()
_BATCH, _BATCH_BYTES = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
#: Rows that a task of Python gets at a time.
BATCH_ROWS = 1000


@contextmanager
def _within(spark: SparkSession, name: str, value: int):
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def batch_rows(spark: SparkSession, rows: int):
    """Within it, frames that are written use batches of so many rows: for rows of megabytes."""
    return _within(spark, _BATCH, rows)


def batch_bytes(spark: SparkSession, size: int):
    """Within it, frames that are written use batches of about so many bytes at most."""
    return _within(spark, _BATCH_BYTES, size)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application: their path need not hold it.

    Rows hold whole texts, so batches are cut to ``BATCH_ROWS`` where the session has no smaller number.
    """
    context = spark.sparkContext
    if int(spark.conf.get(_BATCH, "10000")) > BATCH_ROWS:
        spark.conf.set(_BATCH, BATCH_ROWS)
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        base = f"{tempfile.mkdtemp(prefix='postsignal-code-')}/postsignal_code"
        context.addPyFile(shutil.make_archive(base, "zip", package.parent, package.name))
        _SHIPPED.add(context.applicationId)


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32(doc_id as text) mod ``parts``; a null id counts as the empty text."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")), F.lit(0)) % parts


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A table over the 256 bytes that is true inside the inclusive ranges."""
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: Bytes of tokens between white space, and bytes of words of letters, digits and all beyond ASCII.
NOT_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
ALPHANUMERIC = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finalizer of SplitMix64)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: np.uint64, name: str, n: int) -> np.ndarray:
    if name not in _POWERS or len(_POWERS[name]) < n:
        steps = np.full(max(n, SLICE_BYTES + 4096), base, dtype=np.uint64)
        steps[0] = 1
        _POWERS[name] = np.cumprod(steps)
    return _POWERS[name]


def _span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each byte span, from prefix sums of bytes weighted by powers of an odd number."""
    total = np.empty(len(data) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(_BYTE[data] * _powers(_STEP, "up", len(data))[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * _powers(_BACK, "down", len(data) + 1)[starts])


class Texts:
    """A slice of texts as one byte array with a line feed after each, and their tokens.

    ``rows``: the texts' places in the batch. ``bounds``: tokens of text i are ``bounds[i]`` to ``bounds[i + 1]``.
    """

    def __init__(self, rows: range, texts: list[bytes]):
        self.rows = rows
        self.data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        self.offsets = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))

    def tokens(self, inside: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and hashes of all runs of bytes of a class, and ``bounds``."""
        data = LOWER[self.data] if lower else self.data
        return self.runs(data, inside[data])

    def runs(self, data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The same for the bytes marked in ``inside``, hashed as they are in ``data``."""
        mask = np.zeros(len(data) + 1, dtype=np.int8)
        mask[1:] = inside
        edges = np.flatnonzero(np.diff(mask))
        if len(edges) % 2:
            edges = np.append(edges, len(data))
        starts, ends = edges[::2], edges[1::2]
        hashes = np.empty(len(starts), dtype=np.uint64)
        at = 0
        while at < len(starts):
            to = max(at + 1, int(np.searchsorted(ends, starts[at] + SLICE_BYTES, side="right")))
            low, high = starts[at], ends[to - 1]
            hashes[at:to] = _span_hashes(data[low:high], starts[at:to] - low, ends[at:to] - low)
            at = to
        return starts, ends, hashes, np.searchsorted(starts, self.offsets)


def slices(texts: pa.Array | pa.ChunkedArray) -> Iterator[Texts]:
    """Cut a column of texts into slices of ``SLICE_BYTES`` or one longer text; a null counts as empty."""
    held: list[bytes] = []
    first = size = 0
    for row in range(len(texts)):
        value = texts[row].as_py() or ""
        text = value.encode("utf-8", "surrogatepass") if isinstance(value, str) else bytes(value)
        if held and size + len(text) > SLICE_BYTES:
            yield Texts(range(first, row), held)
            held, first, size = [], row, 0
        held.append(text)
        size += len(text)
    if held:
        yield Texts(range(first, first + len(held)), held)


def batches(frame: DataFrame, work, schema: str) -> DataFrame:
    """Apply a function from record batches to record batches; empty batches are left out."""

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(part for part in parts if part.num_rows)

    ship(frame.sparkSession)
    return frame.mapInArrow(run, schema)


def grouped(frame: DataFrame, key: str, work, schema: str) -> DataFrame:
    """Apply a function from one pandas frame to another to every group of a key; groups must be bounded."""
    ship(frame.sparkSession)
    return frame.groupBy(key).applyInPandas(work, schema)


def pack(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values).tobytes(), codec="lz4", asbytes=True) if len(values) else b""


def unpack(data: bytes, n: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize * n
    return np.frombuffer(pa.decompress(data, decompressed_size=size, codec="lz4", asbytes=True), dtype=kind) if n else np.empty(0, kind)


#: Counters travel in pieces of this many.
_PIECE = 1 << 17
COUNT_ROWS = "place long, counts binary"


def count_rows(counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A task's vector of counters as packed pieces; pieces without a count are left out."""
    for at in range(0, len(counts), _PIECE):
        if (piece := counts[at : at + _PIECE]).any():
            data = pack(np.pad(piece, (0, _PIECE - len(piece))).astype(np.int64))
            yield pa.record_batch([pa.array([at], pa.int64()), pa.array([data], pa.binary())], ["place", "counts"])


def total_counts(parts: DataFrame, size: int) -> np.ndarray:
    """The sum of all tasks' counters: ``size`` numbers, however large the input."""

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(_PIECE, np.int64)
        for data in pdf["counts"]:
            total += unpack(data, _PIECE, np.int64)
        return pd.DataFrame({"place": pdf["place"][:1], "salt": pdf["salt"][:1], "counts": [pack(total)]})

    # Sums of 64 tasks' counters, then of 64 such sums, and so on: no task holds many.
    parts = parts.withColumn("salt", F.spark_partition_id())
    for _ in range(3):
        parts = parts.withColumn("salt", F.floor(F.col("salt") / 64).cast("int"))
        parts = parts.groupBy("place", "salt").applyInPandas(add, "place long, salt int, counts binary")
    total = np.zeros(-(-size // _PIECE) * _PIECE, np.int64)
    for row in parts.select("place", "counts").toLocalIterator():
        total[row.place : row.place + _PIECE] += unpack(row.counts, _PIECE, np.int64)
    return total[:size]


def labelled(labels: DataFrame, column: str, folds: int = 5) -> DataFrame:
    """``doc_id, label`` to learn from: rows whose crc32(doc_id as text) mod ``folds`` is not 0.

    Null ids and labels are left out; of several labels of one document the largest counts.
    """
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("label"))
    rows = rows.filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & (remainder(F.col("doc_id"), folds) != 0))
    return rows.groupBy("doc_id").agg((F.max("label") > 0).cast("int").alias("label"))


def one_per_id(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """``doc_id, text`` and the columns of ``ids`` (a bounded number, one row per ``doc_id``): of several texts of
    one id, one that its hash picks. The rows of an id are cut to one per task ahead of the shuffle."""
    rows = documents.select("doc_id", "text").filter("doc_id IS NOT NULL")
    met = rows.join(F.broadcast(ids), "doc_id")
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), F.col("text").asc_nulls_last())
    return met.withColumn("place of the text", F.row_number().over(first)).filter("`place of the text` = 1").drop("place of the text")


def labelled_sample(documents: DataFrame, labels: DataFrame, column: str, size: int) -> tuple[DataFrame, dict[int, float]]:
    """``doc_id, text, label`` of labelled documents, one row per id, and each label's documents per sampled one.

    Only labels of documents that are there count. Each label has up to half of ``size`` documents, those whose
    hashed ids are smallest, and what one label leaves the other may take.
    """
    known = documents.select("doc_id").filter("doc_id IS NOT NULL").join(labelled(labels, column), "doc_id")
    known = staged(known.groupBy("doc_id").agg(F.max("label").alias("label")), "labelled")
    numbers = {row.label: row.n for row in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = {label: min(n, max(size // 2, size - sum(m for other, m in numbers.items() if other != label))) for label, n in numbers.items()}
    picked = known.limit(0)
    for label, most in share.items():
        picked = picked.union(known.filter(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    weights = {label: numbers[label] / share[label] for label in numbers if share[label]}
    return one_per_id(documents, staged(picked, "sample")), weights


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of every node of an undirected graph ``a, b``: the smallest node it reaches.

    Labels move along edges and are then replaced by their own labels, so paths shorten by halves. Every
    round is a written table; the rounds end when no label changes.
    """
    both = staged(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges"
    )
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("component")), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("component").alias("near"))
        met = labels.join(near, labels.node == near.a).select(
            "node", F.least("component", "near").alias("to"), F.col("component").alias("was")
        )
        own = labels.select(F.col("node").alias("at"), F.col("component").alias("then"))
        after = staged(
            met.join(own, F.col("to") == F.col("at")).select("node", F.least("to", "then").alias("component"), "was"), "labels"
        )
        labels = after.select("node", "component")
        if after.filter("component <> was").isEmpty():
            return labels
