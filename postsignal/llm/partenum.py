"""N-gram Jaccard join by PartEnum signatures, and the groups of similar documents that it links.

Arasu, Ganti and Kaushik, "Efficient exact set-similarity joins" (2006). Sets fall into size bands such
that similar sets lie in one band or in two neighbouring ones. A band bounds the elements in which two
similar sets may differ by ``k``. The domain of shingle hashes is split into ``n1`` parts of ``n2`` smaller
parts each; some part holds at most ``k1`` differences, so the sets agree on some ``n2 - k1`` of its
smaller parts. Every such subset gives one signature: the hash of the set's elements inside it.

There are more parts than needed, so similar sets share several signatures. A set therefore sends only
as many as must still include a shared one, those with the rarest shingles first: a passage that many
documents share brings no pairs. Sets that hold nothing rarer send *common* signatures too; these travel
as plain rows, which joins may split, and the others packed by bucket.

Within the sets of a signature only pairs with the smallest one are checked at first. All sets met with one
smallest set are a family; a second pass compares the members of a family that are not connected by then. So
a group of copies costs its size, not its square, and no link between different components stays unchecked:
components are exact. Both passes first compare parity sketches: bit j tells whether an odd number of elements
hashes to j, so two sketches never differ in more bits than the sets in elements. Whole sets travel only for
pairs that pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsignal.llm.common import (
    COUNT_ROWS,
    NOT_SPACE,
    Texts,
    batch_bytes,
    batch_rows,
    batches,
    components,
    count_rows,
    grouped,
    mix,
    pack,
    release,
    slices,
    staged,
    total_counts,
    unpack,
)

WORDS = 5
#: Similarity as a ratio of whole numbers.
NUMERATOR, DENOMINATOR = 75, 100
#: Counters of the shingle frequency sketch (its size does not grow with the input).
COUNTERS = 1 << 22
#: Packed signatures of about this many rows make one bucket.
BUCKET_ROWS = 1 << 19
#: A shingle found in more than this share of all sets makes its signatures common.
COMMON_SHARE = 1 / 500
#: Members of a family that are compared at a time, and the most bits of a parity sketch.
FAMILY = 2048
MOST_BITS = 1 << 17
#: Bytes of sketches of families that a task compares, about, and rows of whole sets that it gets at a time.
BUNDLE_BYTES = 16 << 20
SET_ROWS = 64
#: Bytes of a batch of texts, sketches or signatures.
BATCH_BYTES = 8 << 20
#: Parts over those needed, so that rare signatures can be picked.
SPARE = 1.25
_KEYS = np.random.default_rng(8).integers(1, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(words: np.ndarray, n: int = WORDS) -> np.ndarray:
    """The distinct hashes of a text's n-word runs, sorted; a shorter text is one run, an empty one has none."""
    if not len(words):
        return np.empty(0, np.uint64)
    size = min(n, len(words))
    total = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        total += words[i : i + len(total)] * _KEYS[i]
    hashes = np.sort(mix(total + np.uint64(size)))
    return hashes[np.concatenate(([True], hashes[1:] != hashes[:-1]))]


def set_key(shingles: np.ndarray) -> int:
    """A set's 64-bit name, equal for equal sets."""
    total = mix(shingles ^ _KEYS[9]).sum(dtype=np.uint64, keepdims=True) + _KEYS[10:11] * np.uint64(len(shingles))
    return int(mix(total).view(np.int64)[0])


def text_sets(part: Texts, n: int = WORDS) -> Iterator[tuple[int, np.ndarray]]:
    _, _, hashes, bounds = part.tokens(NOT_SPACE)
    for i, row in enumerate(part.rows):
        yield row, shingle_set(hashes[bounds[i] : bounds[i + 1]], n)


@lru_cache(maxsize=None)
def band_of(size: int, num: int = NUMERATOR, den: int = DENOMINATOR) -> tuple[int, int, int]:
    """Place of the size band that holds ``size``, its largest size, and the largest size of the band before."""
    place, low, before = 0, 1, 0
    while True:
        high = max(low, low * den // num)
        if size <= high:
            return place, high, before
        place, low, before = place + 1, high + 1, high


@lru_cache(maxsize=None)
def scheme(largest: int, num: int = NUMERATOR, den: int = DENOMINATOR) -> tuple[int, int, int, int]:
    """``n1, n2, k1`` and the number of signatures to send, for sets of which the smaller has up to ``largest`` elements.

    Differences kill signatures; at worst the first one in a part kills most. Of all signatures at least
    ``left`` stay shared, so all but ``left - 1`` of them must hold a shared one.
    """
    k = (largest + largest * den // num) * (den - num) // (den + num)
    n2, k1 = (3, 1) if largest <= 64 else (2, 1)
    n1 = max(1, int(np.ceil((k + 1) / (k1 + 1) * SPARE)))
    per_part = [len([s for s in combinations(range(n2), n2 - k1) if not set(s) & set(range(e))]) for e in range(k1 + 2)]
    drops = sorted(((per_part[e] - per_part[e + 1]) for e in range(k1 + 1) for _ in range(n1)), reverse=True)
    left = n1 * per_part[0] - sum(drops[:k])
    return n1, n2, k1, n1 * per_part[0] - max(left, 1) + 1


def signatures(shingles: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The signatures that a set sends, and for each how often its rarest shingle occurs by the sketch."""
    place, high, before = band_of(len(shingles))
    found, rare = [], []
    for band, largest in ((place, high), (place - 1, before)):
        if band < 0:
            continue
        n1, n2, k1, send = scheme(largest)
        spread = mix(shingles ^ _KEYS[11])
        part = (spread % np.uint64(n1 * n2)).astype(np.int64)
        sums = np.zeros(n1 * n2, np.uint64)
        np.add.at(sums, part, mix(shingles ^ _KEYS[12]))
        least = np.full(n1 * n2, np.iinfo(np.int64).max)
        np.minimum.at(least, part, counts[(shingles % np.uint64(len(counts))).astype(np.int64)])
        sums, least = sums.reshape(n1, n2), least.reshape(n1, n2)
        places = np.arange(n1, dtype=np.uint64) * np.uint64(64) + _KEYS[13:14] * np.uint64(band)
        own, often = [], []
        for j, subset in enumerate(combinations(range(n2), n2 - k1)):
            total = mix(places + np.uint64(j)).copy()
            for s in subset:
                total += mix(sums[:, s] + _KEYS[20 + s])
            own.append(mix(total))
            often.append(least[:, list(subset)].min(axis=1))
        sig, count = np.concatenate(own), np.concatenate(often)
        first = np.lexsort((sig, count))[:send]
        found.append(sig[first])
        rare.append(count[first])
    sig, count = np.concatenate(found), np.concatenate(rare)
    return sig, count


def similar(a: np.ndarray, b: np.ndarray, num: int = NUMERATOR, den: int = DENOMINATOR) -> bool:
    """Whether two sorted sets have a Jaccard similarity of ``num / den`` or more."""
    if min(len(a), len(b)) * den < num * max(len(a), len(b)):
        return False
    at = np.searchsorted(b, a)
    shared = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return den * shared >= num * (len(a) + len(b) - shared)


def _sets(documents: DataFrame, n: int) -> DataFrame:
    def work(parts):
        for part in parts:
            ids, keys, sizes = part.column(0).to_pylist(), np.zeros(part.num_rows, np.int64), np.zeros(part.num_rows, np.int64)
            for texts in slices(part.column(1)):
                for row, shingles in text_sets(texts, n):
                    keys[row], sizes[row] = set_key(shingles), len(shingles)
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(keys), pa.array(sizes)], ["doc_id", "node", "n_shingles"])

    return batches(documents, work, "doc_id long, node long, n_shingles long")


def _sketch(documents: DataFrame, n: int) -> np.ndarray:
    """Documents per shingle, in ``COUNTERS`` hashed counters of 32 bits, over all documents; full ones stay full."""

    def work(parts):
        counts = np.zeros(COUNTERS, np.int32)
        for part in parts:
            for texts in slices(part.column(1)):
                for _, shingles in text_sets(texts, n):
                    np.add.at(counts, (shingles % np.uint64(COUNTERS)).astype(np.int64), 1)
        yield from count_rows(counts)

    total = total_counts(batches(documents, work, COUNT_ROWS), COUNTERS)
    return np.minimum(total, np.iinfo(np.int32).max).astype(np.int32)


def _sent(documents: DataFrame, counts, buckets: int, common: int, n: int) -> DataFrame:
    """Packed signatures by bucket: ``bucket, common, n, data`` with pairs of signature and node, once in a batch."""

    def rows(sig, node, bucket, is_common):
        order = np.lexsort((node, sig, bucket))
        sig, node, bucket = sig[order], node[order], bucket[order]
        new = np.concatenate(([True], (sig[1:] != sig[:-1]) | (node[1:] != node[:-1]))) if len(sig) else np.empty(0, bool)
        sig, node, bucket = sig[new], node[new], bucket[new]
        ids, firsts = np.unique(bucket, return_index=True)
        lasts = np.append(firsts[1:], len(bucket))
        names, places = np.unique(node, return_inverse=True)
        for id_, low, high in zip(ids.tolist(), firsts.tolist(), lasts.tolist()):
            own, at = np.unique(places[low:high], return_inverse=True)
            gaps = np.diff(sig[low:high], prepend=np.uint64(0))
            yield id_, is_common, high - low, len(own), pack(gaps), pack(names[own]), pack(at.astype(np.uint32))

    def work(parts):
        known = counts.value
        held: list[tuple] = []
        size = 0

        def flush():
            sig = np.concatenate([h[0] for h in held])
            often = np.concatenate([h[1] for h in held])
            node = np.repeat(np.array([h[2] for h in held], np.int64), [len(h[0]) for h in held])
            hot = often > common
            spread = (mix(sig[hot] + node[hot].astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
            out = [*rows(sig[~hot], node[~hot], (sig[~hot] >> np.uint64(40)).astype(np.int64) % buckets, False), *rows(sig[hot], node[hot], spread, True)]
            kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["bucket", "common", "n", "names", "gaps", "nodes", "at"])

        for part in parts:
            for texts in slices(part.column(1)):
                for _, shingles in text_sets(texts, n):
                    if len(shingles):
                        held.append((*signatures(shingles, known), set_key(shingles)))
                        size += len(held[-1][0])
                    if size > BUCKET_ROWS:
                        yield flush()
                        held, size = [], 0
        if held:
            yield flush()

    return batches(documents, work, "bucket long, common boolean, n long, names long, gaps binary, nodes binary, at binary")


def _shared(sent: DataFrame) -> DataFrame:
    """``sig, node, least`` of signatures that several sets sent; a common one has a null ``least``."""

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for is_common in (False, True):
            rows = pdf[pdf["common"] == is_common]
            if not len(rows):
                continue
            sig = np.concatenate([np.cumsum(unpack(g, n, np.uint64)) for g, n in zip(rows["gaps"], rows["n"])])
            node = np.concatenate([unpack(x, m, np.int64)[unpack(a, n, np.uint32)] for x, a, n, m in zip(rows["nodes"], rows["at"], rows["n"], rows["names"])])
            if is_common:
                out.append(pd.DataFrame({"sig": sig.view(np.int64), "node": node, "least": pd.array([None] * len(sig), "Int64")}))
                continue
            order = np.argsort(sig, kind="stable")
            sig, node = sig[order], node[order]
            first = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1])))
            least, most = np.minimum.reduceat(node, first), np.maximum.reduceat(node, first)
            times = np.diff(np.append(first, len(sig)))
            several = np.repeat(least != most, times)
            out.append(pd.DataFrame({"sig": sig[several].view(np.int64), "node": node[several], "least": pd.array(np.repeat(least, times)[several], "Int64")}))
        return pd.concat(out).drop_duplicates()

    return grouped(sent, "bucket", work, "sig long, node long, least long")


def parity(shingles: np.ndarray) -> bytes:
    """The parity sketch of a set: four times as many bits as the next power of two, 64 to ``MOST_BITS``."""
    bits = min(MOST_BITS, max(64, 4 << (len(shingles) - 1).bit_length()))
    at = np.bincount((mix(shingles ^ _KEYS[30]) % np.uint64(bits)).astype(np.int64), minlength=bits)
    return np.packbits((at % 2).astype(np.uint8)).tobytes()


def _folded(sketch: np.ndarray, width: int) -> np.ndarray:
    """Sketches (one in a row) as sketches of ``width`` bytes: halves are added bit by bit, parities stay right."""
    while sketch.shape[-1] > width:
        half = sketch.shape[-1] // 2
        sketch = sketch[..., :half] ^ sketch[..., half:]
    return sketch


def _may_link(size: int, sketch: np.ndarray, sizes: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Whether a set may be similar to others that have sketches of the same width."""
    apart = np.bitwise_count(others ^ sketch).sum(axis=1, dtype=np.int64)
    near = np.minimum(sizes, size) * DENOMINATOR >= np.maximum(sizes, size) * NUMERATOR
    return near & (apart * (DENOMINATOR + NUMERATOR) <= (sizes + size) * (DENOMINATOR - NUMERATOR))


def _with_sets(pairs: DataFrame, sets: DataFrame, what: str) -> DataFrame:
    left = sets.select(F.col("node").alias("a"), F.col("size").alias("size_a"), F.col(what).alias("what_a"))
    right = sets.select(F.col("node").alias("b"), F.col("size").alias("size_b"), F.col(what).alias("what_b"))
    both = pairs.join(left, "a").join(right, "b")
    near = F.least("size_a", "size_b") * DENOMINATOR >= F.greatest("size_a", "size_b") * NUMERATOR
    return both.filter(near).select("a", "b", "size_a", "size_b", "what_a", "what_b")


def _promising(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose sketches allow a link."""

    def work(parts):
        for part in parts:
            keep = []
            for m, n, x, y in zip(*(part.column(i).to_pylist() for i in range(2, 6))):
                x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
                width = min(len(x), len(y))
                keep.append(bool(_may_link(m, _folded(x, width), np.array([n]), _folded(y, width)[None])[0]))
            yield pa.record_batch([part.column(0), part.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return batches(_with_sets(pairs, sets, "sketch"), work, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose sets are similar."""

    def work(parts):
        for part in parts:
            keep = [
                similar(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64))
                for x, y in zip(part.column(4), part.column(5))
            ]
            yield pa.record_batch([part.column(0), part.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return batches(_with_sets(pairs, sets, "data"), work, "a long, b long")


def _compared(node: np.ndarray, component: np.ndarray, own: np.ndarray, size: np.ndarray, sketch: np.ndarray) -> Iterator[np.ndarray]:
    """Pairs of one or two blocks of a family, ordered by size, that may link and are not connected."""
    if (component == component[0]).all():
        return
    two = (own != own[0]).any()
    width = np.array([len(s) for s in sketch])
    last = np.searchsorted(size, size * DENOMINATOR // NUMERATOR, side="right")
    for w in np.unique(width):
        level = np.flatnonzero((width == w) | (width == 2 * w))
        folded = np.stack([_folded(np.frombuffer(sketch[i], np.uint8), w) for i in level])
        for place in range(int((width[level] == w).sum())):
            i = level[place]
            rest = slice(place + 1, place + 1 + int(last[i] - i - 1))
            at = level[rest]
            may = (component[at] != component[i]) & ((own[at] != own[i]) | (not two))
            if may.any():
                hit = np.flatnonzero(may)
                hit = hit[_may_link(size[i], folded[place], size[at[hit]], folded[rest][hit])]
                apart = np.bitwise_count(folded[rest][hit] ^ folded[place]).sum(axis=1, dtype=np.int64)
                other, mine = component[at[hit]], np.full(len(hit), component[i])
                yield np.column_stack((np.full(len(hit), node[i]), node[at[hit]], np.minimum(mine, other), np.maximum(mine, other), apart))


def _closest(pairs: np.ndarray, most: int) -> np.ndarray:
    """The pairs that are among the ``most`` with the closest sketches of one of their components."""
    own = np.concatenate((pairs[:, 2], pairs[:, 3]))
    at = np.tile(np.arange(len(pairs)), 2)
    order = np.lexsort((pairs[at, 1], pairs[at, 0], pairs[at, 4], own))
    own, at = own[order], at[order]
    first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
    rank = np.arange(len(own)) - np.repeat(first, np.diff(np.append(first, len(own))))
    return pairs[np.unique(at[rank < most]), :2]


def _between_components(pairs: DataFrame, labels: DataFrame, sets: DataFrame, most: int | None) -> DataFrame:
    """Pairs ``a, b`` of members of one family in different components whose sketches allow a link.

    With ``most``, only so many for every component of a family, the closest; else all of them.

    A family is compared in blocks of up to ``FAMILY`` members, so no task holds more than two blocks.
    """
    members = pairs.select(F.col("a").alias("family"), F.col("b").alias("node"))
    members = members.union(pairs.select("a", F.col("a").alias("node"))).distinct().join(labels, "node", "left")
    members = members.select("family", "node", F.coalesce("component", "node").alias("component"))
    mixed = members.groupBy("family").agg(
        F.count("*").alias("size"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    mixed = mixed.filter("low < high").select("family", F.ceil(F.col("size") / FAMILY).alias("blocks"))
    rows = members.join(mixed, "family").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.withColumn("key", F.xxhash64("family", F.least("own", "other"), F.greatest("own", "other")))
    rows = staged(rows.join(sets.select("node", "size", F.length("sketch").alias("bytes")), "node"), "families")

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["key", "size", "node"], kind="stable")
        columns = [pdf[c].to_numpy() for c in ("node", "component", "own", "size", "sketch")]
        key = pdf["key"].to_numpy()
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.empty(0, np.int64)
        out = [np.empty((0, 2), np.int64)]
        for low, high in zip(first, np.append(first[1:], len(key))):
            if found := list(_compared(*(c[low:high] for c in columns))):
                found = np.concatenate(found)
                out.append(_closest(found, most) if most and len(found) else found[:, :2])
        ends = np.concatenate(out)
        return pd.DataFrame({"a": ends.min(axis=1), "b": ends.max(axis=1)} if len(ends) else {"a": [], "b": []}, dtype="int64")

    # Many blocks are small, so a task takes them in bundles.
    bundles = 1 + int(rows.agg(F.sum(F.col("bytes") + 64)).first()[0] or 0) // BUNDLE_BYTES
    rows = rows.join(sets.select("node", "sketch"), "node")
    rows = rows.select(F.pmod(F.col("key"), F.lit(bundles)).alias("bundle"), "key", "node", "component", "own", "size", "sketch")
    found = grouped(rows, "bundle", work, "a long, b long")
    return found.distinct().join(pairs, ["a", "b"], "left_anti")


def similar_groups(documents: DataFrame, n: int = WORDS) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``documents`` (``doc_id``, ``text``).

    Two documents link when the Jaccard similarity of their sets of n-word runs is 75 % or more; a component
    is named by its smallest ``doc_id``. A null or empty text, or one without words, has 0 shingles and is
    its own component. Repeated rows stay. A null ``doc_id`` names no component: such a row gets the smallest
    id it is linked to, or null. Other columns are not read.
    """
    with batch_bytes(documents.sparkSession, BATCH_BYTES):
        return _similar_groups(documents, n)


def _similar_groups(documents: DataFrame, n: int) -> DataFrame:
    spark = documents.sparkSession
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keys = staged(_sets(documents, n), "sets")
    classes = keys.filter("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("first_id"), F.max("n_shingles").alias("size"))
    total = classes.agg(F.count("*").alias("sets"), F.sum("size").alias("shingles")).first()
    counts = spark.sparkContext.broadcast(_sketch(documents, n))
    buckets = max(1, -(-int(total.shingles or 0) * 2 // 3 // BUCKET_ROWS))
    common = max(64, int(total.sets * COMMON_SHARE), int(4 * (total.shingles or 0) / COUNTERS))
    shared = staged(_shared(_sent(documents, counts, buckets, common, n)), "shared")
    counts.destroy()
    release(spark)

    # Common signatures meet here, in aggregations and joins that Spark can split.
    hot = shared.filter("least IS NULL").select("sig", "node").distinct()
    ends = hot.groupBy("sig").agg(F.min("node").alias("least"), F.max("node").alias("most")).filter("least < most")
    stars = shared.filter("least < node").select(F.col("least").alias("a"), F.col("node").alias("b")).distinct()
    hot_stars = hot.join(ends, "sig").filter("least < node").select(F.col("least").alias("a"), F.col("node").alias("b"))
    pairs = staged(stars.union(hot_stars).distinct(), "pairs")
    release(spark)

    met = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    chosen = keys.join(met, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    texts = documents.join(chosen.filter("doc_id IS NOT NULL"), "doc_id", "left_semi")

    def contents(parts):
        for part in parts:
            found = [(set_key(s), len(s), parity(s), s.tobytes()) for t in slices(part.column(1)) for _, s in text_sets(t, n) if len(s)]
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            columns = zip(*found) if found else ((), (), (), ())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["node", "size", "sketch", "data"])

    # A set may come more than once where rows share a doc_id; any one will do. Sets that only rows without an id hold are read by their key.
    nameless = documents.filter("doc_id IS NULL")
    found = batches(texts.union(nameless), contents, "node long, size long, sketch binary, data binary").join(met, "node", "left_semi")
    sets = staged(found.groupBy("node").agg(*(F.first(c).alias(c) for c in ("size", "sketch", "data"))), "contents")
    release(spark)

    def links(candidates: DataFrame) -> DataFrame:
        candidates = staged(candidates, "candidates")
        with batch_rows(spark, SET_ROWS):
            found = staged(_verified(candidates, sets), "links")
        release(spark)
        return found

    edges = links(_promising(pairs, sets))
    labels = components(edges)
    # First the likeliest pairs of every component, which connect most of them, then all that are left.
    for most in (2, None):
        more = links(_between_components(pairs, labels, sets, most))
        if not more.isEmpty():
            edges = edges.union(more)
            labels = components(edges)

    named = keys.join(labels, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "node").alias("component"), "node"
    )
    full = named.filter("n_shingles > 0")
    names = full.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    linked = full.join(names, "component").select("doc_id", "n_shingles", "component_id")
    return linked.union(named.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
