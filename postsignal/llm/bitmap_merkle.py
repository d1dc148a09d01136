"""Merkle manifest of a dataset: leaf coordinates by rank queries on bitmaps, levels reduced by keyed slot arrays.

Every source has bitmaps of its document ids, one for each run of 32,768 ids, merged from those of all tasks, and a
directory of how many rows lie before each bitmap. An id's place among the leaves of its source is the directory's
count plus the bits set before its own: nothing is sorted. Rows that share an id are placed by their leaves,
through a directory of leaf prefixes. 16 consecutive nodes are the slots of one array, keyed by
source and run; the arrays' digests are the nodes of the next level. Proofs go down again the same way: a run's
path to the root is joined once and shared by its 16 slots.

All of it is Spark expressions; texts are read once, and only digests travel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postsignal.llm.common import staged

FANOUT = 16
#: Ids in a bitmap; bitmaps in a block of the directory; hex digits of a leaf in the directory of a repeated id.
BITS = 1 << 15
BLOCK = 1 << 10
PREFIX = 3
#: Copies of one row that are numbered together.
COPIES = 1 << 16
#: One in so many documents is tampered with in the demonstration.
TAMPERED = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
OUTPUT = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf(*values: Column) -> Column:
    """The digest of a row: each value as its number of UTF-8 bytes, a colon and itself, or ``-`` if null."""
    texts = [v.cast("string") for v in values]
    return digest(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)))


def tampered(doc_id: Column) -> Column:
    """Whether 5 divides crc32 of the id; a null id counts as the empty text, whose crc32 is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")), F.lit(0)) % TAMPERED == 0


def _leaves(documents: DataFrame) -> DataFrame:
    """``source, doc_id, leaf, changed`` and the id's ``bucket`` and ``bit``; digests as 32 bytes."""
    doc_id, source, lang, n_chars, text = (F.col(c) for c in COLUMNS)
    altered = F.when(tampered(doc_id), F.translate(text.cast("string"), UPPER, LOWER)).otherwise(text.cast("string"))
    return documents.select(
        source.cast("string").alias("source"),
        doc_id.cast("long").alias("doc_id"),
        F.unhex(leaf(doc_id, source, lang, n_chars, text)).alias("leaf"),
        F.unhex(leaf(doc_id, source, lang, n_chars, altered)).alias("changed"),
        F.floor(doc_id.cast("long") / BITS).alias("bucket"),
        doc_id.cast("long").bitwiseAND(BITS - 1).alias("bit"),
    )


def _before(rows: DataFrame, group: list[str], place: str, block: Column, count: str, out: str) -> DataFrame:
    """``rows`` with the sum of ``count`` over smaller ``place`` in the group, by sums of blocks and inside a block.

    Null places come first. No window is larger than a block, or than the blocks of a group.
    """
    rows = staged(rows.withColumn("block", block), "directory")
    blocks = rows.groupBy(*group, "block").agg(F.sum(count).alias("block_rows"))
    ahead = Window.partitionBy(*group).orderBy(F.col("block").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*(F.col(g).alias(f"of_{g}") for g in [*group, "block"]), F.coalesce(F.sum("block_rows").over(ahead), F.lit(0)).alias("blocks_before"))
    inside = Window.partitionBy(*group, "block").orderBy(F.col(place).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum(count).over(inside), F.lit(0)))
    same = [F.col(g).eqNullSafe(F.col(f"of_{g}")) for g in [*group, "block"]]
    rows = rows.join(blocks, same).withColumn(out, F.col("inside") + F.col("blocks_before"))
    return rows.drop("inside", "blocks_before", "block", *(f"of_{g}" for g in [*group, "block"]))


def directory(leaves: DataFrame) -> DataFrame:
    """``of_source, of_bucket, ids, rows, repeated, before``: a bitmap of the ids, the rows they name, the bits of
    repeated ids and their rows beyond the first, and the rows of the source with smaller ids. Null ids have no bitmap."""
    ids = leaves.groupBy("source", "bucket", "bit").agg(F.count("*").alias("n"))
    buckets = ids.groupBy("source", "bucket").agg(
        F.bitmap_construct_agg("bit").alias("ids"),
        F.sum("n").alias("rows"),
        F.collect_list(F.when(F.col("n") > 1, F.struct("bit", (F.col("n") - 1).alias("more")))).alias("repeated"),
    )
    ranked = _before(buckets, ["source"], "bucket", F.floor(F.col("bucket") / BLOCK), "rows", "before")
    return ranked.withColumnsRenamed({"source": "of_source", "bucket": "of_bucket"})


def rank(ids: Column, bit: Column) -> Column:
    """Bits set in a bitmap before ``bit``: whole bytes by their popcount, then the bits of the last byte."""
    byte = (bit / 8).cast("int")
    whole = F.bitmap_count(F.substring(ids, F.lit(1), byte))
    last = F.conv(F.hex(F.substring(ids, byte + 1, F.lit(1))), 16, 10).cast("int")
    mask = F.call_function("shiftleft", F.lit(1), (bit % 8).cast("int")) - 1
    return whole + F.bit_count(F.coalesce(last, F.lit(0)).bitwiseAND(mask))


def coordinates(leaves: DataFrame) -> DataFrame:
    """``source, doc_id, leaf, changed, place``: each leaf's place in its source, from 0, by id and then by leaf."""
    where = directory(leaves)
    found = leaves.join(where, F.col("source").eqNullSafe(F.col("of_source")) & F.col("bucket").eqNullSafe(F.col("of_bucket")))
    more = F.aggregate(F.filter("repeated", lambda e: e["bit"] < F.col("bit")), F.lit(0).cast("long"), lambda a, e: a + e["more"])
    place = F.col("before") + F.when(F.col("bit").isNull(), 0).otherwise(rank(F.col("ids"), F.col("bit")) + more)
    shared = F.when(F.col("bit").isNull(), True).otherwise(F.exists("repeated", lambda e: e["bit"] == F.col("bit")))
    placed = staged(found.select("source", "doc_id", "leaf", "changed", place.cast("long").alias("place"), shared.alias("shared")), "places")
    once = placed.filter(~F.col("shared")).drop("shared")

    # Rows that share an id: equal rows are counted, and each leaf is ranked by those of smaller leaves.
    kinds = placed.filter("shared").groupBy("source", "doc_id", "leaf", "changed", "place").agg(F.count("*").alias("n"))
    kinds = _before(kinds, ["source", "doc_id"], "leaf", F.substring(F.hex("leaf"), 1, PREFIX), "n", "smaller")
    chunks = kinds.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPIES))))
    chunks = chunks.repartition("source", "doc_id", "leaf", "chunk")
    last = F.least(F.col("n") - 1, (F.col("chunk") + 1) * COPIES - 1)
    copies = chunks.withColumn("copy", F.explode(F.sequence(F.col("chunk") * COPIES, last)))
    place = F.col("place") + F.col("smaller") + F.col("copy")
    return once.unionByName(copies.select("source", "doc_id", "leaf", "changed", place.alias("place")))


#: A source's only node: it stays as it is.
_LONE = "place = 0 AND size(slots) = 1"
_PATH = "array<struct<before:string,after:string>>"


def _levels(nodes: DataFrame, largest: int, keep: Column) -> list[DataFrame]:
    """Levels of slot arrays over ``nodes`` (``source, place, digest``), the lowest first, until each source has one node.

    A row is ``FANOUT`` consecutive nodes as ``slots``, their run's ``place`` and its ``digest``.
    """
    levels = []
    while not levels or largest > 1:
        slot = F.struct((F.col("place") % FANOUT).alias("slot"), F.lower(F.hex("digest")).alias("digest"), keep.alias("keep"))
        runs = nodes.groupBy("source", F.floor(F.col("place") / FANOUT).alias("place")).agg(F.array_sort(F.collect_list(slot)).alias("slots"))
        levels.append(staged(runs.withColumn("digest", F.unhex(digest(F.concat_ws("", F.col("slots.digest"))))), "runs"))
        nodes, largest = levels[-1].filter(f"NOT ({_LONE})").select("source", "place", "digest"), -(-largest // FANOUT)
        keep = F.lit(None).cast("int")
    return levels


def _tops(levels: list[DataFrame]) -> DataFrame:
    """``source, digest`` (text) of each source's last node, and the ``level`` whose row holds or is it."""
    only = F.get("slots", F.lit(0))["digest"]
    tops = [runs.filter(_LONE).select("source", only.alias("digest"), F.lit(i).alias("level")) for i, runs in enumerate(levels)]
    last = levels[-1].filter(f"NOT ({_LONE})").select("source", F.lower(F.hex("digest")).alias("digest"), F.lit(len(levels) - 1).alias("level"))
    for more in tops:
        last = last.unionByName(more)
    return last


def _descended(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """``source, place, path, digest, keep`` of the lowest nodes and all other columns of ``tops``.

    ``tops``: ``source, level, path`` of the last nodes. A path holds, from a node up, the digests before and after it.
    """
    more = [c for c in tops.columns if c not in ("source", "level", "path")]
    paths = None
    for i in reversed(range(len(levels))):
        entering = tops.filter(F.col("level") == i).select("source", F.lit(0).cast("long").alias("place"), "path", *more)
        paths = entering if paths is None else paths.select(*entering.columns).unionByName(entering)
        above = paths.withColumnsRenamed({"source": "of_source", "place": "of_place"})
        runs = levels[i].withColumn("lone", F.expr(_LONE))
        met = runs.join(above, F.col("source").eqNullSafe(F.col("of_source")) & (F.col("place") == F.col("of_place")))
        each = met.select("source", "place", "slots", "lone", "path", *more, F.posexplode("slots").alias("at", "slot"))
        digests, at = F.col("slots.digest"), F.col("at")
        before, after = F.concat_ws("", F.slice(digests, 1, at)), F.concat_ws("", F.slice(digests, at + 2, F.lit(FANOUT)))
        own = F.concat(F.array(F.struct(before.alias("before"), after.alias("after"))), F.col("path"))
        paths = each.select(
            "source",
            (F.col("place") * FANOUT + at).alias("place"),
            F.when(F.col("lone"), F.col("path")).otherwise(own).alias("path"),
            *more,
            F.col("slot.digest").alias("digest"),
            F.col("slot.keep").alias("keep"),
        )
        if i:
            paths = staged(paths, "paths")
    return paths


def _numbered(tops: DataFrame) -> DataFrame:
    """``tops`` with ``place``, the source's place in order, null first: from files that are dealt and sorted by it."""
    order = F.col("source").asc_nulls_first()
    files = staged(tops.repartitionByRange(order).sortWithinPartitions(order), "sources")
    files = files.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    counts = files.groupBy("file").agg(F.count("*").alias("n"), F.min(F.struct(F.col("source").isNotNull(), "source")).alias("first"))
    ahead = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("file", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    return files.join(counts, "file").withColumn("place", F.col("ahead") + F.col("row")).drop("file", "row", "ahead")


def manifest(documents: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row (``doc_id, source, lang, n_chars, text``).

    The tree is that of the rows as they are; ``folded_root`` starts from the tampered leaf where the row is tampered
    with, and ``verified`` tells whether it still gives the root. Nulls are hashed as ``-``, empty texts as ``0:``.
    A null source is one source, the first. Rows without an id come before those with one; rows of one id follow
    each other by leaf, equal rows in a row. An empty table gives no rows. Other columns are not read.
    """
    leaves = staged(_leaves(documents), "leaves")
    placed = staged(coordinates(leaves).withColumnRenamed("leaf", "digest"), "coordinates")
    sizes = placed.groupBy("source").agg(F.count("*").alias("n")).agg(F.max("n").alias("largest"), F.count("*").alias("sources")).first()
    if not sizes.sources:
        return placed.select("doc_id", *(F.lit(None).cast("string").alias(c) for c in OUTPUT[1:-1]), F.lit(None).cast("boolean").alias("verified"))
    levels = _levels(placed, sizes.largest, F.struct("doc_id", "changed"))
    numbered = staged(_numbered(_tops(levels)), "numbered")

    nodes = numbered.select(F.lit(None).cast("string").alias("source"), "place", F.unhex("digest").alias("digest"))
    above = _levels(nodes, sizes.sources, F.lit(None).cast("int"))
    last = _tops(above)
    root = last.first().digest
    ends = _descended(above, last.select("source", "level", F.array().cast(_PATH).alias("path"))).select("place", "path")
    tops = numbered.join(ends, "place").select("source", "level", "path", F.col("digest").alias("subroot"))
    rows = _descended(levels, staged(tops, "subroots"))

    siblings = F.aggregate("path", F.lit(""), lambda a, p: F.concat(a, p["before"], p["after"]))
    folded = F.aggregate("path", F.lower(F.hex("keep.changed")), lambda h, p: digest(F.concat(p["before"], h, p["after"])))
    done = rows.select(
        F.col("keep.doc_id").alias("doc_id"),
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(root).alias("root"),
        digest(siblings).alias("proof_sha256"),
        folded.alias("folded_root"),
    )
    return done.withColumn("verified", F.col("folded_root") == F.col("root"))
