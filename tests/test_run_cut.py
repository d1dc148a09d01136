"""Runs cut at their first stop against a loop over their batches, and the live run with its ledger."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from postsignal import schema as S
from postsignal.operators.run_cut import StopRules, cut_posts, cut_runs
from postsignal.plans.live_run import live_run
from postsignal.plans.signal_run import RunOptions
from postsignal.schema import ParameterError, SourceThresholds
from postsignal.sinks.ledger import Attempt, latest, ledger
from postsignal.sources import runs as R

START = datetime(2026, 7, 1, tzinfo=timezone.utc)
BATCH = "source_name string, run_id string, batch_seq bigint, batch_at timestamp, new_records bigint, duplicates bigint, login_wall boolean"
RUN = "source_name string, run_id string, started_at timestamp, row_limit bigint, degraded_before_start boolean, error_kind string, error_message string"


def by_loop(batches, run, rules):
    """The run as one process would live through it: (status, message, records, duplicates, batches)."""
    _, _, started, limit, before, kind, message = run
    limit_ = 10**9 if limit is None else limit
    if before:
        return S.THROTTLED, R.ALREADY_DEGRADED, 0, 0, 0
    limits, total, dups, empty, tries, n, end = rules.thresholds, 0, 0, 0, 0, 0, "full" if limit_ < 1 else None
    for _, _, _, at, new, dup, wall in sorted(batches, key=lambda b: b[2]) if limit_ >= 1 else []:
        seconds = (at - started).total_seconds()
        if rules.timeout_seconds is not None and seconds >= rules.timeout_seconds:
            end = "time"
            break
        if wall:
            end = "wall"
            break
        n, total, dups, empty = n + 1, total + new, dups + dup, 0 if new else empty + 1
        if total >= limit_:
            end = "full"
            break
        slow = n >= limits.rolling_batches and total / (max(seconds, 1.0) / 60) < limits.min_records_per_minute
        if empty >= limits.max_empty_run or (dups and dups / (total + dups) > limits.max_duplicate_ratio) or slow:
            if tries >= rules.max_retries:
                end = "rate"
                break
            tries += 1
    records = min(total, limit_)
    if end == "wall":
        return S.LOGIN_REQUIRED, R.LOGIN_WALL, records, dups, n
    if end == "rate":
        return S.THROTTLED, R.RETRIES_EXHAUSTED, records, dups, n
    if end is None and kind:
        return S.FAILED, message, records, dups, n
    if not records:
        return S.THROTTLED, R.NO_RECORDS, records, dups, n
    if limit is not None and records < limit:
        return S.PARTIAL, R.TOO_FEW_RECORDS, records, dups, n
    return S.SUCCESS, None, records, dups, n


def cases():
    random.seed(8)
    runs, batches = [], []
    for i in range(60):
        name = f"r{i}"
        runs.append(("s", name, START, random.choice([None, 0, 5, 30, 10_000]), i % 17 == 3, "other" if i % 7 == 2 else None, "boom" if i % 7 == 2 else None))
        places = sorted(random.sample(range(200), random.choice([0, 1, 4, 40])))
        for seq in places:
            new = random.choice([0, 0, 1, 2, 9]) if i % 3 else random.choice([0, 6])
            batches.append(("s", name, seq, START + timedelta(minutes=seq + 1), new, random.choice([0, 0, 1, 12]), random.random() < 0.02))
    batches.append(("s", "unknown", 0, START, 3, 0, False))
    return runs, batches


RULES = [
    StopRules(SourceThresholds(max_empty_run=3, max_duplicate_ratio=0.85), 0),
    StopRules(SourceThresholds(max_empty_run=2, max_duplicate_ratio=0.5, min_records_per_minute=0.6), 3, 6000.0),
]


@pytest.mark.parametrize("rules", RULES)
def test_runs_end_where_a_loop_ends_them(spark, rules):
    runs, batches = cases()
    cut = cut_runs(spark.createDataFrame(batches, BATCH).repartition(4), spark.createDataFrame(runs, RUN), rules, segment_width=7)
    got = {r.run_id: (r.status, r.error_message, r.n_records, r.total_duplicates, r.total_batches) for r in cut.runs.collect()}
    expected = {run[1]: by_loop([b for b in batches if b[1] == run[1]], run, rules) for run in runs}
    assert got == expected and len({v[0] for v in expected.values()}) == 5
    counted = {r.run_id: r["count"] for r in cut.batches.groupBy("run_id").count().collect()}
    assert counted == {run: v[4] for run, v in expected.items() if v[4]}


def test_windows_run_inside_segments(spark):
    runs, batches = cases()
    frame = spark.createDataFrame(batches, BATCH)
    from postsignal.operators.health import source_health

    plan = source_health(frame, segment_width=7)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and "batch_seq" in line]
    assert windows and all("_segment" in line for line in windows)


def test_posts_of_the_batches_that_count(spark):
    posts = [("s", "a", 0, 0, "1", "x"), ("s", "a", 0, 1, "1", "x"), ("s", "a", 0, 2, "2", "y"), ("s", "a", 1, 3, "3", "z"), ("s", "a", 1, 4, "4", "z"),
             ("s", "b", 0, 5, "1", "x"), ("s", "b", 1, 6, "9", "q"), ("s", "c", 0, 7, "5", "x"), ("s", "b", 0, 8, "", "x"), ("s", "b", 0, 9, "7", "")]
    frame = spark.createDataFrame(posts, "source_name string, run_id string, batch_seq bigint, ingest_seq bigint, tweet_id string, content string")
    batches = [("s", "a", 0, START, 2, 1, False), ("s", "a", 1, START, 2, 0, False), ("s", "b", 0, START, 1, 0, False), ("s", "b", 1, START, 1, 0, True)]
    runs = [("s", "a", START, 3, False, None, None), ("s", "b", START, None, False, None, None), ("s", "d", START, 5, False, None, None)]
    cut = cut_runs(spark.createDataFrame(batches, BATCH), spark.createDataFrame(runs, RUN))
    assert sorted(r.ingest_seq for r in cut_posts(frame, cut).collect()) == [0, 2, 3, 5]
    assert {r.run_id: (r.status, r.n_records) for r in cut.runs.collect()} == {"a": (S.SUCCESS, 3), "b": (S.LOGIN_REQUIRED, 1), "d": (S.THROTTLED, 0)}


def test_negative_retries():
    with pytest.raises(ParameterError):
        StopRules(max_retries=-1)


def raw_posts(spark, n):
    rows = [(i, i // 10, "s", f"r{i % 2}", str(i), f"u{i}", "U", (START + timedelta(minutes=i)).isoformat(), f"nifty rally {i}", [], []) for i in range(n)]
    frame = spark.createDataFrame(
        rows, "ingest_seq bigint, batch_seq bigint, source_name string, run_id string, tweet_id string, username string, display_name string, "
        "timestamp string, content string, hashtags array<string>, mentions array<string>"
    )
    return frame.select("*", *(F.lit(3).cast("bigint").alias(c) for c in S.COUNT_FIELDS), F.lit("u").alias("url"))


def test_live_run_publishes_once(spark, tmp_path):
    posts = raw_posts(spark, 100)
    captures = posts.groupBy("source_name", "run_id", "batch_seq").agg(F.min(F.to_timestamp("timestamp")).alias("batch_at"))
    captures = captures.withColumn("login_wall", (F.col("run_id") == "r1") & (F.col("batch_seq") == 3))
    runs = spark.createDataFrame([("s", f"r{i}", START, 1000, False, None, None) for i in range(2)], RUN)
    fallback = posts.drop("batch_seq").where("ingest_seq < 7").withColumn("tweet_id", F.concat(F.lit("f"), "tweet_id"))
    rules = StopRules(SourceThresholds(min_records_per_minute=0.0))
    done = live_run(captures, posts, runs, fallback, str(tmp_path / "out"), rules, RunOptions(as_of=START + timedelta(days=1), by_date=True))
    assert {r.run_id: (r.status, r.n_records) for r in done.runs.collect()} == {"r0": (S.PARTIAL, 50), "r1": (S.LOGIN_REQUIRED, 15)}
    features = done.attempt.table("tweets_features")
    assert {r.tweet_id for r in features.collect()} == {str(i) for i in range(0, 100, 2)} | {"f1", "f3", "f5"}
    row = ledger(spark, str(tmp_path / "out")).first()
    assert row.counts == done.counts and row.counts["snapshot_posts"] == 65 and row.counts["tweets_features"] == 53
    assert row.statuses == {S.PARTIAL: 1, S.LOGIN_REQUIRED: 1}
    assert latest(spark, str(tmp_path / "out")).tables == done.attempt.tables


def test_a_failed_attempt_leaves_no_row(spark, tmp_path):
    root = str(tmp_path / "out")
    good = Attempt(spark, root)
    good.write("numbers", spark.range(3))
    assert good.publish() == {"numbers": 3}
    bad = Attempt(spark, root)
    bad.write("numbers", spark.range(9))
    with pytest.raises(Exception):
        bad.write("broken", spark.range(2).select(F.raise_error(F.lit("no")).alias("x")))
    assert [r.attempt for r in ledger(spark, root).collect()] == [good.name]
    assert latest(spark, root).table("numbers").count() == 3


def test_a_hot_day_is_split_and_others_are_not(spark, tmp_path):
    from postsignal.sinks.tables import write_dated

    day = F.when(F.col("id") < 900, F.lit(0)).otherwise(F.col("id") % 5)
    posts = spark.range(1000).withColumn("timestamp", F.timestamp_seconds(day * 86_400)).repartition(8)
    posts = posts.withColumn("timestamp", F.when(F.col("id") % 97 != 0, F.col("timestamp")))
    path = write_dated(posts, str(tmp_path / "dated"), rows_per_file=100)
    files = {d.name: len(list(d.glob("*.parquet"))) for d in (tmp_path / "dated").glob("event_date=*")}
    assert 9 <= files.pop("event_date=1970-01-01") <= 20
    assert set(files.values()) == {1} and len(files) == 5
    assert spark.read.parquet(path).count() == 1000
