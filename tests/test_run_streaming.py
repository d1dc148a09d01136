import json
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from postsignal.operators.buckets import aggregate_signals
from postsignal.operators.clean import clean_posts
from postsignal.operators.dedupe import dedupe_posts
from postsignal.operators.features import add_signals
from postsignal.operators.health import run_metrics, source_health
from postsignal.operators.tfidf import fit_terms
from postsignal.plans.signal_run import RunOptions, run_from_files, signal_buckets
from postsignal.schema import CLEAN_FIELDS, FAILED, SUCCESS, ParameterError
from postsignal.streaming import feed

START = datetime(2026, 7, 1, tzinfo=timezone.utc)
NOW = START + timedelta(days=2)


def record(i, minutes=None, content=None, **changes):
    at = START + timedelta(minutes=i if minutes is None else minutes)
    return {
        "tweet_id": str(i), "username": f"u{i % 5}", "display_name": "U", "timestamp": at.isoformat(),
        "content": content or random.choice(["nifty bullish rally", "bearish crash", "flat day"]) + f" {i}",
        "like_count": i % 7, "view_count": 10 * i, "reply_count": 1, "retweet_count": None, **changes,
    }


def write(folder, name, records):
    folder.mkdir(exist_ok=True)
    lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(folder)


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


def batch_posts(spark, folder):
    from postsignal.sources.jsonl import read_posts

    return read_posts(spark, folder).posts


def test_run_writes_every_output(spark, tmp_path):
    random.seed(1)
    records = [record(i) for i in range(200)] + [record(7, content="copy"), record(500, timestamp=None)]
    source = write(tmp_path / "in", "posts.jsonl", records)
    options = RunOptions(as_of=NOW, top_k_terms=5, by_date=True)
    result = run_from_files(spark, source, None, str(tmp_path / "out"), options=options)
    assert (result.status, result.source_name) == (SUCCESS, "primary_jsonl")
    assert result.counts == {"cleaned": 202, "deduped": 201, "features": 201, "undated": 1, "buckets": 4}
    tweets = spark.read.parquet(result.paths["tweets"])
    assert [c for c in tweets.columns if c.startswith("tfidf_")] == [f"tfidf_{t.term}" for t in result.terms]
    assert tweets.where("tweet_id = '7' AND content = 'copy'").count() == 0
    written = spark.read.parquet(result.paths["aggregated"])
    assert written.agg(F.sum("tweet_count")).first()[0] == 200
    lazy = signal_buckets(batch_posts(spark, source), as_of=NOW)
    key = lambda r: r.timestamp
    for ours, theirs in zip(sorted(written.collect(), key=key), sorted(lazy.collect(), key=key), strict=True):
        assert ours.tweet_count == theirs.tweet_count
        assert ours.composite_signal_mean == pytest.approx(theirs.composite_signal_mean)
    assert spark.read.parquet(result.paths["series"]).count() == 4


def test_run_falls_back_and_survives_no_source(spark, tmp_path):
    good = write(tmp_path / "good", "p.jsonl", [record(i) for i in range(10)])
    bad = write(tmp_path / "bad", "p.jsonl", [record(1), "{"])
    result = run_from_files(spark, bad, good, str(tmp_path / "out"), limit=6, options=RunOptions(as_of=NOW))
    assert (result.source_name, result.status, result.counts["features"]) == ("sample_jsonl", SUCCESS, 6)
    nothing = run_from_files(spark, bad, None, str(tmp_path / "none"), options=RunOptions(as_of=NOW))
    assert (nothing.status, nothing.counts["features"], nothing.counts["buckets"]) == (FAILED, 0, 0)
    with pytest.raises(ValueError):
        RunOptions(every="often")


def test_options_reach_the_run(spark, tmp_path):
    source = write(tmp_path / "in", "p.jsonl", [record(1, minutes=0, content="Moon निफ्टी"), record(2, minutes=0, content="rally"), "{"])
    words = (("moon",), ("rally",))
    options = RunOptions(as_of=START + timedelta(hours=1), half_life_hours=1.0, lexicons=words, keep_marks=True, mode="quarantine")
    result = run_from_files(spark, source, None, str(tmp_path / "out"), options=options)
    rows = {r.tweet_id: r for r in spark.read.parquet(result.paths["tweets"]).collect()}
    assert {i: (r.lexical_sentiment, r.recency_decay) for i, r in rows.items()} == {"1": (1.0, 0.5), "2": (-1.0, 0.5)}
    assert rows["1"].content_clean == "moon निफ्टी" and [rows[i].ingest_seq for i in "12"] == [0, 1]
    for wrong in ({"half_life_hours": 0}, {"mode": "lenient"}):
        with pytest.raises(ParameterError):
            RunOptions(**wrong)


def test_input_order_does_not_matter(spark, make_posts):
    random.seed(9)
    records = [{**record(i, minutes=i % 50), "tweet_id": str(i % 60), "like_count": "1", "view_count": "2"} for i in range(120)]
    for r in records:
        r["reply_count"] = "1"
    posts = make_posts(*records)
    whole = signal_buckets(posts, "10m", NOW).collect()
    shuffled = signal_buckets(posts.orderBy(F.rand(3)).repartition(6), "10m", NOW).collect()
    assert [(r.timestamp, r.tweet_count) for r in whole] == [(r.timestamp, r.tweet_count) for r in shuffled]
    assert [r.composite_signal_mean for r in whole] == pytest.approx([r.composite_signal_mean for r in shuffled])


@pytest.mark.parametrize("salts", [0, 4])
def test_stream_equals_batch_on_closed_buckets(spark, tmp_path, salts):
    random.seed(4)
    folder = tmp_path / "in"
    first = [record(i) for i in range(150)]
    copies = [dict(first[i]) for i in range(0, 100, 5)]
    write(folder, "a.jsonl", first + copies)
    write(folder, "b.jsonl", [record(i) for i in range(150, 400)] + [dict(first[149])])
    write(folder, "c.jsonl", [record(9999, minutes=60 * 48)])

    lines = feed.read_lines(spark, str(folder), max_files=1)
    deduped = feed.dedupe_stream(feed.clean_stream(lines), "6 hours", salts=salts)
    stream = feed.bucket_stream(add_signals(deduped, NOW), "1h")
    finish(feed.write_stream(stream, str(tmp_path / "out"), str(tmp_path / "check")))

    posts = clean_posts(batch_posts(spark, str(folder)), carry=("ingest_seq",))
    wanted = aggregate_signals(add_signals(dedupe_posts(posts), NOW)).where(F.col("timestamp") < START + timedelta(hours=24))
    got = {r.timestamp: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    expected = {r.timestamp: r for r in wanted.collect()}
    assert got.keys() == expected.keys() and len(got) == 7
    for at, row in expected.items():
        assert got[at].tweet_count == row.tweet_count
        assert got[at].composite_signal_mean == pytest.approx(row.composite_signal_mean)


def test_stream_rejects_and_scoring(spark, tmp_path):
    folder = write(tmp_path / "in", "a.jsonl", [record(1, content="nifty rally"), "{", record(2, content="flat day", view_count=-1), ""])
    finish(
        feed.write_good_and_rejected(
            feed.read_lines(spark, folder), str(tmp_path / "posts"), str(tmp_path / "rejects"), str(tmp_path / "c1")
        )
    )
    posts = spark.read.parquet(str(tmp_path / "posts"))
    assert [r.tweet_id for r in posts.collect()] == ["1"] and set(CLEAN_FIELDS) < set(posts.columns)
    assert spark.read.parquet(str(tmp_path / "rejects")).count() == 2

    terms = fit_terms(posts.withColumn("ingest_seq", F.lit(0).cast("bigint")), 2)
    stream = feed.score_stream(feed.clean_stream(feed.read_lines(spark, folder)), terms)
    finish(feed.write_stream(stream, str(tmp_path / "scored"), str(tmp_path / "c2")))
    scored = {r.tweet_id: r for r in spark.read.parquet(str(tmp_path / "scored")).collect()}
    assert scored.keys() == {"1", "2"}
    assert scored["1"].tfidf_nifty > 0 == scored["2"].tfidf_nifty


def test_arrival_dedupe_brings_every_post_once(spark, tmp_path):
    undated, future = dict(timestamp=None), dict(timestamp="2999-01-01T00:00:00+00:00")
    write(tmp_path / "in", "a.jsonl", [record(1), record(2, **undated)])
    write(tmp_path / "in", "b.jsonl", [record(2, **undated), record(3, **future), record(1)])
    write(tmp_path / "in", "c.jsonl", [record(4, minutes=-60 * 24 * 400), record(2, **undated), record(3, **future)])
    posts = feed.with_arrival_time(feed.clean_stream(feed.read_lines(spark, str(tmp_path / "in"), max_files=1)))
    deduped = feed.dedupe_stream(posts, "1 hour", "arrived_at")
    finish(feed.write_stream(deduped, str(tmp_path / "out"), str(tmp_path / "check")))
    assert sorted(r.tweet_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["1", "2", "3", "4"]


def test_new_checkpoint_keeps_rejects_and_posts(spark, tmp_path):
    for name in ("first", "second"):
        folder = write(tmp_path / name, "a.jsonl", [record(1, content=name), "{"])
        lines = feed.read_lines(spark, folder)
        out = (str(tmp_path / "posts"), str(tmp_path / "rejects"), str(tmp_path / f"check_{name}"))
        finish(feed.write_good_and_rejected(lines, *out))
    assert sorted(r.content for r in spark.read.parquet(str(tmp_path / "posts")).collect()) == ["first", "second"]
    assert spark.read.parquet(str(tmp_path / "rejects")).count() == 2


def test_ingest_with_health_is_exact_and_repeatable(spark, tmp_path):
    folder = tmp_path / "in"
    schema = "ingest_seq bigint, tweet_id string, username string, content string, source_name string, run_id string"
    batches = [
        [(0, "1", "u", "a", "s", "r"), (1, "1", "u", "a", "s", "r"), (2, "2", "u", "b", "s", "r")],
        [(3, "2", "u", "b", "s", "r"), (4, "3", "u", "c", "s", "r"), (5, "3", "u", "c", "t", "r")],
        [(6, "1", "u", "a", "s", "r"), (7, "2", "u", "b", "s", "r")],
    ]
    tables = str(tmp_path / "tables")

    def run(checkpoint):
        stream = spark.readStream.schema(schema).json(str(folder))
        finish(feed.ingest_with_health(stream, tables, str(tmp_path / checkpoint)))

    for number, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(folder))
        run("check")
    posts = spark.read.parquet(f"{tables}/posts")
    assert sorted(r.ingest_seq for r in posts.collect()) == [0, 2, 4]
    health = spark.read.parquet(f"{tables}/ingest_batches").drop("feed_id", "batch_id")
    counts = {(r.source_name, r.batch_seq): (r.new_records, r.duplicates) for r in health.collect()}
    assert counts == {("s", 0): (2, 1), ("s", 1): (1, 1), ("t", 1): (0, 1), ("s", 2): (0, 2)}
    last = {r.source_name: r for r in run_metrics(source_health(health)).collect()}
    assert (last["s"].total_collected, last["s"].total_duplicates, last["s"].empty_run) == (3, 4, 1)

    # A second feed with a checkpoint of its own goes on from the tables.
    other = tmp_path / "other"
    spark.createDataFrame([(8, "1", "u", "a", "s", "q"), (9, "9", "u", "d", "s", "q")], schema).coalesce(1).write.json(str(other))
    stream = spark.readStream.schema(schema).json(str(other))
    finish(feed.ingest_with_health(stream, tables, str(tmp_path / "other_check")))
    assert sorted(r.ingest_seq for r in spark.read.parquet(f"{tables}/posts").collect()) == [0, 2, 4, 9]
    row = spark.read.parquet(f"{tables}/ingest_batches").where("run_id = 'q'").first()
    assert (row.batch_seq, row.new_records, row.duplicates) == (0, 1, 1)


def test_calendar_buckets_do_not_stream(spark):
    stream = spark.readStream.format("rate").load().select(F.col("timestamp"))
    with pytest.raises(ValueError):
        feed.bucket_stream(stream, "1mo")
