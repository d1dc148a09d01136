import random

import pytest
from pyspark.sql import functions as F

from postsignal.operators import dedupe
from postsignal.operators.clean import clean_posts
from postsignal.operators.rows import first_posts


def clean(spark, rows):
    return spark.createDataFrame(rows, "ingest_seq bigint, tweet_id string, content_clean string")


def raw(spark, rows):
    return spark.createDataFrame(
        rows, "ingest_seq bigint, tweet_id string, username string, content string"
    )


def test_first_row_of_each_key_wins_in_any_input_order(spark):
    random.seed(5)
    rows = [
        (i, random.choice([None, "", "1", "2", "3", str(i)]), random.choice(["x", "y", "1", None]))
        for i in range(500)
    ]
    for shuffle in (1, 7):
        random.shuffle(rows)
        got = {r[0] for r in dedupe.dedupe_posts(clean(spark, rows).repartition(shuffle)).select("ingest_seq").collect()}
        # One row stands for every key, and no earlier row has it.
        keys = {seq: tweet_id if tweet_id else f"{content}" for seq, tweet_id, content in rows}
        assert len({keys[seq] for seq in got}) == len(got) and {keys[seq] for seq in got} == set(keys.values())
        assert all(min(seq for seq, k in keys.items() if k == keys[kept]) == kept for kept in got)


def test_hot_key_is_cut_before_the_shuffle(spark):
    plan = dedupe.dedupe_posts(clean(spark, [(1, "a", "b")]))._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_same_id_with_other_text_is_a_duplicate(make_posts):
    posts = make_posts({"tweet_id": "1", "content": "a"}, {"tweet_id": "1", "content": "a duplicate"})
    rows = dedupe.dedupe_posts(clean_posts(posts, carry=("ingest_seq",))).collect()
    assert [r.content for r in rows] == ["a"]


def test_unseen_posts_across_batches(spark):
    first = raw(spark, [(0, "1", "u", "same"), (1, "1", "u", "same"), (2, "2", "u", "same"), (3, None, "U", "A  b")])
    new = dedupe.unseen_posts(first, spark.createDataFrame([], "dedupe_key string"))
    assert sorted(r.ingest_seq for r in new.collect()) == [0, 2, 3]
    second = raw(spark, [(4, "2", "v", "x"), (5, "", "u", "a b"), (6, "", "w", "a b"), (7, "3", "u", "z")])
    later = dedupe.unseen_posts(second, new)
    assert sorted(r.ingest_seq for r in later.collect()) == [6, 7]


def test_seen_keys_in_a_bucketed_table(spark):
    table = "seen_keys_test"
    assert dedupe.seen_keys(spark, table).count() == 0
    for batch, wanted in (([(0, "1", "u", "a"), (1, "2", "u", "b")], [0, 1]), ([(2, "2", "u", "b"), (3, "3", "u", "c")], [3])):
        posts = dedupe.unseen_posts(raw(spark, batch), dedupe.seen_keys(spark, table)).persist()
        assert sorted(r.ingest_seq for r in posts.collect()) == wanted
        dedupe.append_seen_keys(posts, table, buckets=4)
        posts.unpersist()
    assert dedupe.seen_keys(spark, table).count() == 3
    spark.sql(f"DROP TABLE {table}")


def test_keys_hit(spark):
    seen = spark.createDataFrame([("a",), ("b",)], "dedupe_key string")
    batch = spark.createDataFrame([("b",), ("c",)], "dedupe_key string")
    kept = {r[0] for r in dedupe.keys_hit(seen, batch).collect()}
    assert kept == {"b"}


def sequential_counts(rows, limit):
    counts, seen = {}, {}
    for run, batch, _, tweet_id, content in sorted(rows):
        ids = seen.setdefault(run, set())
        if not tweet_id or not content or (limit is not None and len(ids) >= limit):
            continue
        new, duplicates = counts.get((run, batch), (0, 0))
        counts[run, batch] = (new, duplicates + 1) if tweet_id in ids else (new + 1, duplicates)
        ids.add(tweet_id)
    return counts


@pytest.mark.parametrize("limit", [None, 1, 6, 1000])
def test_new_and_duplicate_counts(spark, monkeypatch, limit):
    monkeypatch.setattr("postsignal.operators.order.RADIX", 4)
    monkeypatch.setattr("postsignal.operators.order.DIGIT_BITS", 2)
    random.seed(11)
    rows = [
        (f"r{random.randint(0, 2)}", random.randint(0, 6), i, random.choice(["", None, *"abcdefgh"]), random.choice(["t", "t", ""]))
        for i in range(300)
    ]
    frame = spark.createDataFrame(rows, "run string, batch int, pos int, tweet_id string, content string")
    got = dedupe.count_new_per_batch(frame.repartition(4), "batch", "pos", ("run",), limit).collect()
    assert {(r.run, r.batch): (r.new_records, r.duplicates) for r in got} == sequential_counts(rows, limit)
    single = [("one", *row[1:]) for row in rows]
    whole = spark.createDataFrame(single, frame.schema).drop("run")
    got = dedupe.count_new_per_batch(whole, "batch", "pos", limit=limit).collect()
    assert {("one", r.batch): (r.new_records, r.duplicates) for r in got} == sequential_counts(single, limit)


@pytest.mark.parametrize("limit", [0, 1, 99, 100, 101, 999, 1000, 5000])
def test_first_posts_by_cutoff(spark, monkeypatch, limit):
    monkeypatch.setattr("postsignal.operators.order.RADIX", 16)
    monkeypatch.setattr("postsignal.operators.order.DIGIT_BITS", 4)
    posts = spark.range(1000).select((F.col("id") * 3 + 7).alias("ingest_seq")).repartition(5)
    got = first_posts(posts, limit)
    assert sorted(r[0] for r in got.collect()) == [i * 3 + 7 for i in range(min(limit, 1000))]


def test_first_posts_by_struct_order(spark):
    place = F.struct(
        (F.col("id") % 3).alias("file"), F.lit(0).alias("block"), F.col("id").alias("line")
    )
    posts = spark.range(90).select(place.alias("ingest_seq"), "id").repartition(4)
    wanted = sorted(range(90), key=lambda i: (i % 3, i))[:40]
    got = first_posts(posts, 40).select("id").collect()
    assert sorted(r[0] for r in got) == sorted(wanted)


def test_rows_without_an_order_value_have_no_place(spark):
    posts = spark.createDataFrame([(None,), (5,), (1,), (9_000_000_000_000,)], "ingest_seq bigint")
    assert sorted(r[0] for r in first_posts(posts, 2).collect()) == [1, 5]
    assert sorted(r[0] for r in first_posts(posts, 10).collect()) == [1, 5, 9_000_000_000_000]


def test_negative_limit(spark):
    with pytest.raises(ValueError):
        first_posts(spark.range(3).withColumnRenamed("id", "ingest_seq"), -1)
