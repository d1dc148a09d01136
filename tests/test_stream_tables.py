"""Streams that restart between micro-batches: key history, late posts, buckets that late posts correct."""

import json
import random
import re
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from postsignal.operators.buckets import aggregate_signals
from postsignal.operators.clean import clean_posts
from postsignal.operators.dedupe import dedupe_posts
from postsignal.operators.features import add_signals
from postsignal.sources import jsonl
from postsignal.streaming import feed
from postsignal.streaming.history import KeyHistory
from postsignal.streaming.live_buckets import bucket_parts, buckets_of_parts, merge_parts

START = datetime(2026, 7, 1, tzinfo=timezone.utc)
NOW = START + timedelta(days=40)


def record(i, minutes, content=None, **changes):
    at = (START + timedelta(minutes=minutes)).isoformat()
    return {
        "tweet_id": str(i), "username": f"u{i % 5}", "display_name": "D", "timestamp": at, "content": content or f"bullish rally {i}",
        "like_count": i % 7, "view_count": 10 * i, "reply_count": 1, "retweet_count": None, **changes,
    }


def batches():
    """Three micro-batches with rejects, repeats, late, undated and future posts."""
    random.seed(2)
    first = [record(i, i * 10) for i in range(300)] + [record(900, 0, timestamp=None), "{"]
    second = [record(i, i * 10) for i in range(280, 420)] + [record(500 + i, 5 * i) for i in range(20)] + [record(901, 0, timestamp="2999-01-01"), "[]"]
    third = [record(i, i * 10) for i in range(400, 450)] + [record(600 + i, 700 + i) for i in range(15)] + [record(900, 0, timestamp=None), record(902, 4300)]
    return first, second, third


def run(spark, folder, tables, check, **options):
    query = feed.ingest_lines(feed.read_lines(spark, str(folder)), str(tables), str(check), "6 hours", "1h", NOW, **options)
    query.awaitTermination()
    assert query.exception() is None


def test_no_line_is_lost(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    total = 0
    for number, rows in enumerate(batches()):
        (folder / f"{number}.jsonl").write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows) + "\n")
        total += len(rows)
        run(spark, folder, tmp_path / "t", tmp_path / "check")  # each micro-batch begins with a restart
    read = lambda name: spark.read.parquet(str(tmp_path / "t" / name))
    duplicates = read("ingest_batches").agg(F.sum("duplicates")).first()[0]
    late = {(r.tweet_id, r.batch_id) for r in read("late").collect()}
    assert read("rejects").count() == 2 and duplicates == 20 + 20 + 1
    # Behind the watermark: six hours before the latest post of earlier batches, dates in the future not counted.
    assert {i for i, b in late if b == 1} == {str(500 + i) for i in range(20)}
    assert {i for i, b in late if b == 2} >= {str(600 + i) for i in range(15)} and "902" not in {i for i, _ in late}
    assert read("posts").count() + len(late) + duplicates + 2 == total
    kept = {r.tweet_id for r in read("posts").collect()}
    assert {"900", "901", "902"} <= kept and read("new_posts").count() == len(kept) + len(late)

    # The buckets of all batches equal those of one batch over the same posts, open and corrected ones too.
    posts = jsonl.read_posts(spark, str(folder), mode=jsonl.QUARANTINE).posts
    whole = aggregate_signals(add_signals(dedupe_posts(clean_posts(posts, carry=("ingest_seq",))), NOW)).collect()
    live = feed.live_buckets(spark, str(tmp_path / "t")).collect()
    assert [(r.timestamp, r.tweet_count) for r in live] == [(r.timestamp, r.tweet_count) for r in whole] and len(live) > 50
    for ours, theirs in zip(live, whole):
        assert tuple(ours)[2:] == pytest.approx(tuple(theirs)[2:], abs=1e-9)


def test_parts_add_up_in_any_order(spark):
    random.seed(6)
    rows = [(START + timedelta(minutes=random.randint(0, 300)), random.gauss(1e6, 1), random.choice([None, random.gauss(1e4, 1e-2)]), 0.5, 1.0) for _ in range(400)]
    scored = spark.createDataFrame(rows, "timestamp timestamp, engagement_score double, composite_signal double, recency_decay double, lexical_sentiment double")
    scored = scored.withColumn("part", F.pmod(F.xxhash64("engagement_score"), F.lit(5)))
    parts = [bucket_parts(scored.where(F.col("part") == i)) for i in range(5)]
    merged = merge_parts(parts[0].union(parts[1])).union(merge_parts(parts[2].union(parts[3]))).union(parts[4])
    ours, theirs = buckets_of_parts(merged).collect(), aggregate_signals(scored).collect()
    assert len(ours) == len(theirs) >= 5
    for a, b in zip(ours, theirs):
        assert (a.timestamp, a.tweet_count) == (b.timestamp, b.tweet_count)
        assert tuple(a)[2:] == pytest.approx(tuple(b)[2:], rel=1e-6)
    nothing = buckets_of_parts(bucket_parts(scored.limit(0)))
    assert nothing.count() == 0 and nothing.columns == aggregate_signals(scored).columns


def digests(spark, low, high):
    return spark.range(low, high).select(F.sha2(F.col("id").cast("string"), 256).alias("dedupe_key"))


def test_key_history_opens_few_files(spark, tmp_path):
    history = KeyHistory(spark, str(tmp_path / "keys"), fanin=4)
    for batch in range(21):
        history.merge("f", batch)
        known = history.known(digests(spark, batch * 50 - 10, batch * 50 + 50), "f", batch)
        assert known.join(digests(spark, batch * 50 - 10, batch * 50), "dedupe_key", "left_semi").count() == (10 if batch else 0)
        assert known.join(digests(spark, batch * 50, batch * 50 + 50), "dedupe_key", "left_semi").count() == 0
        history.add(digests(spark, batch * 50, batch * 50 + 50).coalesce(1), "f", batch)
    history.merge("f", 21)
    levels = sorted(r.level for r in history.runs())
    assert levels == [0, 1, 2] and sum(4**level for level in levels) == 21
    one = digests(spark, 333, 334)
    opened = history.known(one, "f", 21)
    files = opened.inputFiles()
    everything = len(list((tmp_path / "keys" / "runs").rglob("*.parquet")))
    assert opened.join(one, "dedupe_key").count() == 1
    read = {f for f in files if "prefix=" not in f or f"prefix={one.first()[0][: len(f.split('prefix=')[1].split('/')[0])]}/" in f}
    scanned = opened._jdf.queryExecution().executedPlan().toString()
    assert len(read) <= 3 < everything and len(re.findall(r"PartitionFilters: \[[^\]]*prefix", scanned)) == 2


def test_a_retried_batch_meets_no_keys_of_its_own(spark, tmp_path):
    history = KeyHistory(spark, str(tmp_path / "keys"))
    history.add(digests(spark, 0, 5), "f", 0)
    history.add(digests(spark, 5, 9), "f", 1)
    assert history.known(digests(spark, 0, 9), "f", 1).count() == 5  # as at its first attempt
    history.add(digests(spark, 5, 9), "f", 1)
    assert history.known(digests(spark, 0, 9), "f", 2).count() == 9
    assert history.known(digests(spark, 0, 9), "other", 0).count() == 9
