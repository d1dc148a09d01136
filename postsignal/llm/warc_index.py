"""WARC archives of pages and their index, merged from sorted runs.

Pages are written as gzipped WARC records; of pages with equal payloads all but one become revisits. The
archives are then read back record by record, and every archive gives a run of captures sorted by URL key and
timestamp. The key space is cut into ranges; each run is sliced at the cuts, and the slices of a range are
merged by a loser tree, so ranges in order are the history of all captures.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsignal.llm.common import batches, grouped, shared_folder, staged

#: Payloads of fewer bytes never become revisits.
LEAST_BYTES = 1000
#: Compressed bytes after which a new archive begins, captures of a range about, and keys that place the cuts.
ARCHIVE_BYTES = 8 << 20
RANGE_ROWS = 100_000
CUT_KEYS = 20_000
#: Pages carry no capture time; a page is taken to be captured so many seconds after this as its id says.
EPOCH = np.datetime64("2020-01-01T00:00:00")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURE = (
    "urlkey: string, timestamp: string, page_id: long, payload_bytes: long, payload_digest: string, "
    "record_type: string, refers_to: long, archive: string, offset: long, length: long"
)
FIELDS = [part.split(":")[0] for part in CAPTURE.split(", ")]
_STRUCT = pa.struct([(n, pa.string() if "string" in k else pa.int64()) for n, k in (part.split(":") for part in CAPTURE.split(", "))])


def url_key(url: str | None) -> str:
    """The host's labels from last to first, then path and query, all in lower case."""
    try:
        parts = urlsplit((url or "").strip().lower())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return (url or "").lower()
    labels = ",".join(reversed(host.removeprefix("www.").split(".")))
    return f"{labels}{f':{port}' if port else ''}){parts.path or '/'}{f'?{parts.query}' if parts.query else ''}"


def _plain(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def _stamp(page_id: int | None) -> str:
    seconds = (page_id or 0) % (1 << 31)
    return f"{EPOCH + np.timedelta64(seconds, 's')}Z"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record as a gzip member; a revisit keeps the HTTP headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    coded = base64.b32encode(bytes.fromhex(digest)).decode()
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:x-page:{page_id if page_id is not None else 'none'}>"),
        ("WARC-Date", _stamp(page_id)),
        *([("WARC-Target-URI", _plain(url))] if url else []),
        ("WARC-Payload-Digest", f"sha1:{coded}"),
        *([("WARC-Refers-To", f"<urn:x-page:{refers_to}>"), ("WARC-Profile", _PROFILE)] if refers_to is not None else []),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(head.encode() + block + b"\r\n\r\n") + squeeze.flush()


def members(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and content of every gzip member."""
    view, at = memoryview(data), 0
    while at < len(view):
        expand, out, to = zlib.decompressobj(31), [], at
        while not expand.eof:
            if to >= len(view):
                raise ValueError("the archive ends inside a record")
            piece = view[to : to + (1 << 16)]
            out.append(expand.decompress(piece))
            to += len(piece)
        to -= len(expand.unused_data)
        yield at, to - at, b"".join(out)
        at = to


def _number(value: str | None) -> int | None:
    found = re.fullmatch(r"<urn:x-page:(-?[0-9]+)>", value or "")
    return int(found[1]) if found else None


def capture(content: bytes, archive: str, offset: int, length: int) -> dict:
    """What the index keeps of a record; a response's payload must have the digest and length that its headers name."""
    head, _, block = content.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = block[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    size = int(re.search(rb"\r\nContent-Length: ([0-9]+)", http)[1])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"the payload at {offset} of {archive} is not what its headers say")
    values = (url_key(fields.get("WARC-Target-URI")), fields["WARC-Date"], _number(fields["WARC-Record-ID"]), size, digest, kind, _number(fields.get("WARC-Refers-To")), archive, offset, length)
    return dict(zip(FIELDS, values))


def _order(row: dict) -> tuple:
    return row["urlkey"], row["timestamp"], row["page_id"] if row["page_id"] is not None else -1, row["archive"], row["offset"]


class LoserTree:
    """Merges sorted runs: an inner node keeps the loser of its match, so the next winner replays one path."""

    def __init__(self, runs: Iterable[Iterable], key=lambda x: x):
        self.runs = [iter(run) for run in runs]
        self.key = key
        self.k = len(self.runs)
        self.heads: list = [None] * self.k
        self.keys: list = [None] * self.k
        self.losers = [-1] * self.k
        for run in range(self.k):
            self._advance(run)
        self.winner = self._play(1) if self.k > 1 else 0

    def _advance(self, run: int) -> None:
        self.heads[run] = next(self.runs[run], None)
        self.keys[run] = None if self.heads[run] is None else self.key(self.heads[run])

    def _before(self, a: int, b: int) -> bool:
        """Whether run a's head goes first: ended runs go last, equal keys by run."""
        if self.keys[a] is None or self.keys[b] is None:
            return self.keys[a] is not None
        return (self.keys[a], a) < (self.keys[b], b)

    def _play(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        first, last = (a, b) if self._before(a, b) else (b, a)
        self.losers[node] = last
        return first

    def __iter__(self) -> Iterator:
        while self.k and self.heads[self.winner] is not None:
            yield self.heads[self.winner]
            run = self.winner
            self._advance(run)
            node = (run + self.k) // 2
            while node >= 1:
                if self._before(self.losers[node], run):
                    self.losers[node], run = run, self.losers[node]
                node //= 2
            self.winner = run


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write every row of ``pages`` (``page_id, url, html``) to archives in ``folder``; the rows returned name them.

    Of rows with equal payloads of at least ``LEAST_BYTES`` bytes, that with the largest ``page_id`` is a
    response and the others revisit it. A task writes files of its own, and only finished tasks name theirs.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "large": F.octet_length("payload") >= LEAST_BYTES})
    last = rows.filter("large").groupBy("digest").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).filter("n > 1")
    # Small payloads get a key of their own: none meet in the join.
    key = F.when(F.col("large"), F.col("digest")).otherwise(F.concat(F.lit("-"), F.xxhash64("page_id", "digest").cast("string")))
    rows = rows.withColumn("key", key).join(last.select(F.col("digest").alias("key"), "last"), "key", "left")
    revisits = F.when(~F.col("last").eqNullSafe(F.col("page_id")), F.col("last"))

    def work(parts):
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        out, name, size = None, "", 0
        for part in parts:
            for page_id, url, data, digest, refers in zip(*(part.column(i).to_pylist() for i in range(5))):
                if out is None:
                    name, size = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{path}/{name}", compression=None)
                coded = record(page_id, url, data, digest, refers)
                out.write(coded)
                size += len(coded)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    out = None
                    yield pa.record_batch([pa.array([name])], ["archive"])
        if out is not None:
            out.close()
            yield pa.record_batch([pa.array([name])], ["archive"])

    return batches(rows.select("page_id", "url", "payload", "digest", revisits.alias("refers")), work, "archive string")


def runs(archives: DataFrame, folder: str) -> DataFrame:
    """``run, captures`` of the named archives: each archive's captures in order of URL key, timestamp and page."""
    files = archives.sparkSession.read.format("binaryFile").load(folder)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("archive"), "content").join(archives, "archive")

    def work(parts):
        for part in parts:
            for name, content in zip(part.column(0).to_pylist(), part.column(1)):
                found = [capture(data, name, at, n) for at, n, data in members(content.as_py())]
                found.sort(key=_order)
                yield pa.record_batch([pa.array([name]), pa.array([found], pa.list_(_STRUCT))], ["run", "captures"])

    return batches(files, work, f"run string, captures array<struct<{CAPTURE}>>")


def merged(sorted_runs: DataFrame) -> DataFrame:
    """All captures with ``part`` and ``place``, by which they are in order of URL key, timestamp and page."""
    spark = sorted_runs.sparkSession
    total = sorted_runs.agg(F.sum(F.size("captures"))).first()[0] or 0
    keys = sorted_runs.select(F.explode("captures").alias("c")).select("c.urlkey", "c.timestamp", F.coalesce("c.page_id", F.lit(-1)).alias("p"))
    parts = max(1, -(-total // RANGE_ROWS))
    sample = keys.sample(min(1.0, CUT_KEYS / max(total, 1)), seed=7) if parts > 1 else keys.limit(0)
    sample = sorted(tuple(row) for row in sample.collect())
    cuts = spark.sparkContext.broadcast([sample[len(sample) * i // parts] for i in range(1, parts)] if sample else [])

    def sliced(batches_):
        for part in batches_:
            for name, found in zip(part.column(0).to_pylist(), part.column(1)):
                found = found.as_py()
                places = [_order(row)[:3] for row in found]
                ends = [0, *(bisect_left(places, cut) for cut in cuts.value), len(found)]
                own = [(i, name, found[a:b]) for i, (a, b) in enumerate(zip(ends, ends[1:])) if b > a]
                if own:
                    ids, names, rows = zip(*own)
                    yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(names), pa.array(rows, pa.list_(_STRUCT))], ["part", "run", "captures"])

    slices = batches(sorted_runs.select("run", "captures"), sliced, f"part long, run string, captures array<struct<{CAPTURE}>>")

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("run", kind="stable")
        rows = list(LoserTree((list(captures) for captures in pdf["captures"]), key=_order))
        out = pd.DataFrame(rows, columns=FIELDS)
        for name in ("page_id", "refers_to"):
            out[name] = pd.array([row[name] for row in rows], "Int64")
        return out.assign(part=pdf["part"].iloc[0], place=np.arange(len(out)))

    return grouped(slices, "part", merge, f"part long, place long, {CAPTURE.replace(':', '')}")


def archived(pages: DataFrame) -> DataFrame:
    """Write, read back and index all ``pages``: a row per page in its place of the merged index.

    A null html is an empty payload; a null url has the key of an empty host. Repeated rows are records of
    their own, and a row that equals the response's in id and payload is a response too. A null ``page_id`` stays
    null and revisits whatever page has its payload. An empty table gives no rows. Other columns are not read.
    """
    folder = shared_folder(pages.sparkSession, "warc")
    if "://" not in folder:
        folder = f"file://{folder.removeprefix('file:')}"
    names = staged(write_archives(pages, folder), "archives")
    if names.isEmpty():
        return pages.sparkSession.createDataFrame([], f"part long, place long, {CAPTURE.replace(':', '')}")
    return merged(staged(runs(names, folder), "runs"))
