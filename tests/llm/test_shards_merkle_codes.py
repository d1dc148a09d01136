"""Uniform shards, the Merkle manifest and vector codes: against brute force, and on odd rows."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from postsignal.llm import bitmap_merkle, orchard_codes, uniform_shards
from postsignal.llm.common import staged

LONG = "Long Text " * 20_000
CLASHING = "doc_id long, text string, lang string, source string, n_chars long, shard int, slot string, file int, place int, leaf string, n long"


def as_text(row):
    return tuple(map(str, row))


def documents(spark, rows):
    return spark.createDataFrame([(*r, 5, "old", 1, 2, "leaf", 3) for r in rows], CLASHING)


@pytest.fixture(scope="module")
def odd_rows():
    pick = random.Random(12)
    ids = [None, -5, -40_000, 7, 7, 7, 8, *range(30_000, 34_000, 37)]
    own = [(pick.choice(ids), pick.choice([None, "", "Ab", "é X"]), pick.choice([None, "en"]), pick.choice([None, "", "a", "b", "é"]), pick.choice([None, 3])) for _ in range(600)]
    return [*own, *own[:4], (1 << 40, LONG, "en", "only one", 9), (1 << 40, LONG, "en", "only one", 9)]


# --- shards


@pytest.mark.parametrize("good, bad, sample", [(300, 500, 200), (500, 300, 700), (20, 1000, 30), (5, 3, 4), (7, 9, 16), (0, 9, 4), (9, 0, 4), (4, 4, 0)])
def test_draws_follow_the_hypergeometric_law(spark, good, bad, sample):
    rows = spark.range(4000).select(*(F.lit(x).cast("long").alias(n) for n, x in (("g", good), ("b", bad), ("s", sample))), "id")
    drawn = np.array([r.x for r in rows.select(uniform_shards.hypergeometric(F.col("g"), F.col("b"), F.col("s"), F.lit(5), F.col("id")).alias("x")).collect()])
    law = np.random.default_rng(1).hypergeometric(good, bad, sample, 400_000)
    low, high = int(law.min()), int(law.max())
    expected = np.bincount(law - low, minlength=high - low + 1) / 100
    found = np.bincount(np.clip(drawn - low, 0, high - low), minlength=high - low + 1)
    often = expected > 8
    surprise = ((found[often] - expected[often]) ** 2 / expected[often]).sum()
    assert drawn.min() >= max(0, sample - bad) and drawn.max() <= min(good, sample)
    assert surprise < often.sum() + 5 * np.sqrt(2 * often.sum())


def test_draws_from_billions(spark):
    row = [F.lit(x).cast("long") for x in (10**9, 10**10, 10**6)]
    drawn = np.array([r.x for r in spark.range(2000).select(uniform_shards.hypergeometric(*row, F.col("id")).alias("x")).collect()])
    assert abs(drawn.mean() - 1e6 / 11) < 40 and 260 < drawn.std() < 315


def test_a_matrix_has_the_sums_of_blocks_and_shards(spark):
    blocks = spark.createDataFrame([(f"f{i}", 0, n) for i, n in enumerate([1, 0, 700, 33, 5000, 2, 2, 90])], "file string, block long, rows long")
    cells = uniform_shards.communication_matrix(blocks, 7, 3).collect()
    counts = np.array([r.counts for r in cells])
    assert counts.min() >= 0 and (counts.sum(axis=1) == [r.rows for r in cells]).all()
    assert (counts.sum(axis=0) == cells[0].sizes).all() and max(cells[0].sizes) - min(cells[0].sizes) <= 1
    for s in range(7):  # every block starts where those before it end
        spans = sorted((r.starts[s], r.counts[s]) for r in cells if r.counts[s])
        assert [a for a, _ in spans] == [sum(n for _, n in spans[:i]) for i in range(len(spans))]


@pytest.mark.parametrize("size", [1, 2, 3, 17, 1000])
def test_permutations_are_bijections(spark, size):
    places = [r.p for r in spark.range(size).select(uniform_shards.permuted(F.col("id"), F.lit(size), F.lit(4)).alias("p")).collect()]
    assert sorted(places) == list(range(size)) and (size < 17 or places != sorted(places))


def test_every_place_is_as_likely(spark):
    """All 24 orders of 4 rows, over many keys, come equally often."""
    rows = spark.range(6000).select("id", *(uniform_shards.permuted(F.lit(i).cast("long"), F.lit(4), F.col("id")).alias(f"p{i}") for i in range(4)))
    orders = Counter(tuple(r[1:]) for r in rows.collect())
    assert len(orders) == 24 and sum((n - 250) ** 2 / 250 for n in orders.values()) < 60


def test_shards_hold_all_rows_once(spark, odd_rows):
    docs = documents(spark, odd_rows)
    for shards in (1, 24):
        out = uniform_shards.shuffled(docs.repartition(3), shards, seed=5)
        assert out.columns == [c for c in docs.columns if c not in ("shard", "slot")] + ["shard", "slot"]
        rows = out.collect()
        assert Counter(as_text(r[:-2]) for r in rows) == Counter(as_text(r) for r in docs.drop("shard", "slot").collect())
        sizes = Counter(r.shard for r in rows)
        assert len(sizes) == shards and max(sizes.values()) - min(sizes.values()) <= 1
        for s in sizes:
            assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))


def test_shards_and_slots_repeat_and_do_not_depend_on_each_other(spark, tmp_path):
    spark.range(4000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'same' ELSE CAST(id AS STRING) END AS text").repartition(5).write.parquet(f"{tmp_path}/docs")
    table = spark.read.parquet(f"{tmp_path}/docs")
    once, again, other = ({r.doc_id: (r.shard, r.slot) for r in uniform_shards.shuffled(table, 4, seed=s, in_place=True).collect()} for s in (1, 1, 2))
    assert once == again and 850 < sum(once[i][0] == other[i][0] for i in once) < 1150
    together = sum(once[i][0] == once[i + 1][0] for i in range(3999))
    assert 900 < together < 1100


def test_digest_of_shards(spark, odd_rows):
    rows = uniform_shards.shard_digest(uniform_shards.shuffled(documents(spark, odd_rows))).collect()
    expected = Counter((str(r[0]), len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in odd_rows)
    assert Counter((str(r.doc_id), r["size"], r.text_crc32) for r in rows) == expected
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}
    assert uniform_shards.shuffled(documents(spark, [])).count() == 0
    with pytest.raises(ValueError):
        uniform_shards.shuffled(staged(spark.range(100), "some").filter("id <> 50").withColumn("doc_id", F.col("id")), in_place=True)


def test_main_path_of_shards_is_native(spark):
    plan = uniform_shards.shard_digest(uniform_shards.shuffled(documents(spark, [(1, "a", None, None, 1)])))
    text = plan._jdf.queryExecution().toString()
    assert not any(word in text for word in ("Python", "Pandas", "Arrow", "Window", "CartesianProduct", "NestedLoop"))


# --- manifest


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def encoded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def lowered(text):
    return text and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def tree(nodes):
    levels = []
    while len(nodes) > 1:
        levels.append(nodes)
        nodes = [digest(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
    return levels, nodes[0]


def path(levels, i):
    for nodes in levels:
        run = nodes[i // 16 * 16 : i // 16 * 16 + 16]
        yield "".join(run[: i % 16]), "".join(run[i % 16 + 1 :])
        i //= 16


def manifest_by_hand(rows):
    if not rows:
        return
    groups = {}
    for doc_id, text, lang, source, n_chars in rows:
        own = digest(*map(encoded, (doc_id, source, lang, n_chars, text)))
        broken = doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 == 0
        changed = digest(*map(encoded, (doc_id, source, lang, n_chars, lowered(text)))) if broken else own
        groups.setdefault(source, []).append((doc_id is not None, doc_id or 0, own, changed, doc_id))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = [tree([r[2] for r in sorted(groups[s], key=lambda r: r[:4])]) for s in order]
    tops, root = tree([t[1] for t in trees])
    for k, source in enumerate(order):
        for i, (_, _, own, changed, doc_id) in enumerate(sorted(groups[source], key=lambda r: r[:4])):
            steps = [*path(trees[k][0], i), *path(tops, k)]
            folded = changed
            for before, after in steps:
                folded = digest(before, folded, after)
            yield doc_id, own, trees[k][1], root, digest(*(b + a for b, a in steps)), folded, folded == root


@pytest.mark.parametrize("rows", [slice(None), slice(0, 1), slice(0, 3), slice(0, 0), slice(-2, None)])
def test_manifest_equals_trees_by_hand(spark, odd_rows, rows):
    found = bitmap_merkle.manifest(documents(spark, odd_rows[rows]))
    assert found.columns == list(bitmap_merkle.OUTPUT)
    assert sorted(map(as_text, found.collect())) == sorted(map(as_text, manifest_by_hand(odd_rows[rows])))


def test_manifest_of_sources_of_unlike_depth(spark):
    rows = [(i, f"Text {i}", "en", "deep" if i < 300 else f"s{i % 20}", i) for i in range(340)]
    assert sorted(map(as_text, bitmap_merkle.manifest(documents(spark, rows)).collect())) == sorted(map(as_text, manifest_by_hand(rows)))


def test_rank_counts_the_bits_before(spark):
    bits = sorted(random.Random(1).sample(range(bitmap_merkle.BITS), 900))
    table = spark.createDataFrame([(b,) for b in bits], "bit long").selectExpr("bit", "1 AS k")
    whole = table.groupBy("k").agg(F.bitmap_construct_agg("bit").alias("ids"))
    found = table.join(whole, "k").select("bit", bitmap_merkle.rank(F.col("ids"), F.col("bit")).alias("rank")).collect()
    assert all(bits[r["rank"]] == r.bit for r in found) and len(found) == len(bits)


def test_many_copies_are_numbered_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(bitmap_merkle, "COPIES", 4)
    rows = [(3, "same", "en", "a", 4)] * 37 + [(3, f"other {i}", "en", "a", 4) for i in range(30)] + [(2, "x", None, "a", 1)]
    assert sorted(map(as_text, bitmap_merkle.manifest(documents(spark, rows)).collect())) == sorted(map(as_text, manifest_by_hand(rows)))


# --- codes


def codes_by_hand(rows, parts=8, entries=16, rounds=6):
    kept = [(i, np.floor(4096 * np.array(v, float)).astype(np.int64), n) for i, v, n in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    if not kept:
        return []
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1].astype("<i4").tobytes()))
    kept = [k for k in kept if len(k[1]) == len(kept[0][1])]
    grid, edges = np.array([k[1] for k in kept]), orchard_codes.bounds(len(kept[0][1]), parts)
    cut = [grid[:, a:b] for a, b in zip(edges, edges[1:])]
    books = [c[:entries].copy() for c in cut]

    def assigned():
        apart = [((c[:, None] - b[None]) ** 2).sum(axis=2) for c, b in zip(cut, books)]
        return [a.argmin(axis=1) for a in apart], sum(a.min(axis=1) for a in apart)

    for _ in range(rounds):
        for own, book, c in zip(assigned()[0], books, cut):
            for e in set(own.tolist()):
                book[e] = c[own == e].sum(axis=0) // (own == e).sum()
    own, error = assigned()
    name = hashlib.sha256(",".join(str(x) for b in books for r in b.tolist() for x in r).encode()).hexdigest()
    by_label = Counter()
    for (_, _, label), e in zip(kept, error):
        by_label[label] += int(e)
    return [(k[0], "".join(f"{o[i]:02x}" for o in own), int(error[i]), by_label[k[2]], name) for i, k in enumerate(kept)]


@pytest.fixture(scope="module")
def vectors():
    pick = np.random.default_rng(5)
    rows = [
        (int(pick.integers(0, 60)) if pick.random() < 0.9 else None, [float(x) for x in pick.integers(-2, 3, 11) / 4096], None if pick.random() < 0.3 else int(pick.integers(0, 3)))
        for _ in range(300)
    ]
    odd = [(1, None, 1), (2, [1.0, None] + [0.0] * 9, 1), (3, [float("nan")] * 11, 1), (4, [float("inf")] * 11, 0), (70, [1.0, 2.0], 1), (71, [], 1)]
    return [*rows, *odd, rows[0], rows[0]]


@pytest.mark.parametrize("rows", [slice(None), slice(0, 1), slice(0, 5), slice(0, 0), slice(300, 304)])
def test_codes_equal_brute_force(spark, vectors, rows):
    table = spark.createDataFrame([(*v, "x", 1.0) for v in vectors[rows]], "vec_id long, embedding array<double>, label int, code string, error double")
    found = orchard_codes.compressed(table)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(as_text, found.collect())) == sorted(map(as_text, codes_by_hand(vectors[rows])))


def test_search_finds_the_nearest_and_skips_entries():
    pick = np.random.default_rng(6)
    entries = np.concatenate((pick.integers(-500, 500, (200, 6)) + pick.choice([-9000, 0, 9000], (200, 1)), np.repeat(pick.integers(-5, 5, (1, 6)), 5, axis=0)))
    queries = np.concatenate((entries[::3] + pick.integers(-40, 40, (69, 6)), pick.integers(-10_000, 10_000, (400, 6))))
    found, best = orchard_codes.nearest(queries, orchard_codes.Codebook(entries))
    apart = ((queries[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (found == apart.argmin(axis=1)).all() and (best == apart.min(axis=1)).all()


def test_large_components_are_refused(spark):
    table = spark.createDataFrame([(1, [1e9] * 8, 0)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="absolute value"):
        orchard_codes.compressed(table).count()
