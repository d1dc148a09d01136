import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from postsignal import schema as S
from postsignal.operators.clean import clean_posts
from postsignal.sinks import tables as sinks
from postsignal.sources import articles, jsonl, runs

AT = datetime(2026, 7, 1, tzinfo=timezone.utc)


def record(tweet_id="1", **changes):
    """A post as a JSON object with every key; counts follow from the id's length."""
    size = len(tweet_id)
    post = {name: size + place for place, name in enumerate(S.COUNT_FIELDS)}
    post |= dict(tweet_id=tweet_id, username="mira", display_name="Mira K", content=f"gold at {size} #METALS @otto")
    post |= dict(timestamp="2025-03-09T17:45:00+01:00", hashtags=["METALS"], mentions=["otto"], url=f"https://example.org/mira/status/{tweet_id}")
    return post | changes


def write_lines(path, *lines):
    path.write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n", encoding="utf-8")
    return str(path)


def test_closed_schema_and_defaults(spark, tmp_path):
    bare = {k: None for k in S.REQUIRED_FIELDS}
    path = write_lines(tmp_path / "in.jsonl", record("1", extra={"a": 1}), "", "   ", bare, record("2", like_count="7"))
    read = jsonl.read_posts(spark, path)
    assert (read.status, read.run["n_records"], read.run["error_message"]) == (S.SUCCESS, 3, None)
    rows = read.posts.orderBy("ingest_seq").collect()
    assert [r.tweet_id for r in rows] == ["1", None, "2"]
    assert rows[1].hashtags == [] and rows[1].mentions == [] and rows[1].like_count is None
    assert rows[2].like_count == "7" and rows[0].hashtags == ["METALS"]
    assert rows[0].source_name == "sample_jsonl" and rows[0].collector_status == S.SUCCESS
    assert set(read.posts.columns) == {"ingest_seq", *S.POST_FIELDS, *S.ENVELOPE_FIELDS}


BAD = ["{", "[1]", "5", "{'a': 1}", '{"a": 1} x', json.dumps(record()) * 2, json.dumps({k: v for k, v in record().items() if k != "content"})]


@pytest.mark.parametrize("bad", BAD)
def test_one_bad_line_fails_a_strict_run(spark, tmp_path, bad):
    path = write_lines(tmp_path / "in.jsonl", record("1"), bad)
    read = jsonl.read_posts(spark, path)
    assert (read.status, read.run["n_records"], read.posts.count()) == (S.FAILED, 0, 0)
    assert "in.jsonl" in read.run["error_message"]


def test_quarantine_keeps_the_rest(spark, tmp_path):
    path = write_lines(tmp_path / "in.jsonl", record("1"), *BAD, record("2", view_count=-1), record("3", view_count="x"))
    read = jsonl.read_posts(spark, path, mode=jsonl.QUARANTINE)
    assert [r.tweet_id for r in read.posts.collect()] == ["1"]
    reasons = [r.reason for r in read.rejects.orderBy("ingest_seq").collect()]
    assert reasons == [jsonl.NOT_AN_OBJECT] * 6 + [f"{jsonl.MISSING_KEY}: content"] + [f"{jsonl.BAD_COUNT}: view_count"] * 2


def test_missing_file_and_empty_file_are_failed_runs(spark, tmp_path):
    missing = jsonl.read_posts(spark, str(tmp_path / "none.jsonl"))
    assert missing.status == S.FAILED and missing.posts.count() == 0
    empty = jsonl.read_posts(spark, write_lines(tmp_path / "empty.jsonl", " "))
    assert empty.status == S.FAILED and "no records" in empty.run["error_message"]
    both = jsonl.runs_frame(spark, [missing, empty])
    assert both.where(F.col("status") == S.FAILED).count() == 2


def test_limit_takes_the_first_lines(spark, tmp_path):
    path = write_lines(tmp_path / "in.jsonl", *(record(str(i)) for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        read = jsonl.read_posts(spark, path, limit=700)
        assert read.run["n_records"] == 700
        assert sorted(int(r.tweet_id) for r in read.posts.collect()) == list(range(700))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    none = jsonl.read_posts(spark, path, limit=0)
    assert none.status == S.FAILED and none.posts.count() == 0
    with pytest.raises(ValueError):
        jsonl.read_posts(spark, path, limit=-1)


RUN_COLUMNS = (
    "source_name string, run_id string, raw_status string, error_kind string, error_message string, "
    "n_records bigint, row_limit bigint, degraded_before_start boolean, started_at timestamp, ended_at timestamp"
)

CASES = [
    ("ok", "SUCCESS", None, None, 5, 5, False, S.SUCCESS, None, 5),
    ("short", "SUCCESS", None, None, 3, 5, False, S.PARTIAL, runs.TOO_FEW_RECORDS, 3),
    ("empty", "SUCCESS", None, None, 0, 5, False, S.THROTTLED, runs.NO_RECORDS, 0),
    ("timeout", "PARTIAL", None, "slow page", 2, 5, False, S.PARTIAL, "slow page", 2),
    ("empty timeout", "PARTIAL", None, "slow page", 0, 5, False, S.THROTTLED, "slow page", 0),
    ("login", "LOGIN_REQUIRED", None, "login wall", 0, 5, False, S.LOGIN_REQUIRED, "login wall", 0),
    ("login raised", "SUCCESS", "login_wall", "wall", 1, 5, False, S.LOGIN_REQUIRED, "wall", 1),
    ("rate", "SUCCESS", "rate_limited", "retries", 4, 5, False, S.THROTTLED, "retries", 4),
    ("crash", "SUCCESS", "other", "boom", 4, 5, False, S.FAILED, "boom", 4),
    ("before", "SUCCESS", None, None, 4, 5, True, S.THROTTLED, runs.ALREADY_DEGRADED, 0),
    ("unknown start", "SUCCESS", None, None, 5, 5, None, S.SUCCESS, None, 5),
]


@pytest.fixture
def classified(spark):
    rows = [("feed", name, raw, kind, message, n, limit, early, AT, AT) for name, raw, kind, message, n, limit, early, *_ in CASES]
    return runs.classify_live_runs(spark.createDataFrame(rows, RUN_COLUMNS))


def test_run_status(classified):
    got = {r.run_id: (r.status, r.error_message, r.n_records) for r in classified.collect()}
    assert got == {name: tuple(wanted) for name, *_, status, message, n in CASES for wanted in [(status, message, n)]}


def test_fallback_replaces_degraded_runs_only(spark, classified):
    rows = [("feed", case[0], f"p-{case[0]}") for case in CASES]
    primary = spark.createDataFrame(rows, "source_name string, run_id string, tweet_id string")
    fallback = primary.withColumn("tweet_id", F.concat(F.lit("f-"), "run_id"))
    got = {r.run_id: r.tweet_id[0] for r in runs.select_source(primary, fallback, classified).collect()}
    assert got == {case[0]: "f" if case[7] in S.FALLBACK_STATUSES else "p" for case in CASES}
    enveloped = runs.with_run_envelopes(primary, classified)
    assert {r.run_id: r.collector_status for r in enveloped.collect()} == {case[0]: case[7] for case in CASES}


def test_posts_without_a_run_row_stay(spark):
    classified = spark.createDataFrame(
        [("s", "r1", "SUCCESS"), ("s", "r2", "FAILED"), ("s", "r3", None)], "source_name string, run_id string, status string"
    ).selectExpr("*", "timestamp '2031-01-01' AS started_at", "timestamp '2031-01-02' AS ended_at")
    keys = [("s", "r1"), ("s", "r2"), ("s", "r3"), ("s", "gone"), (None, "r1"), ("s", None)]
    primary = spark.createDataFrame([(*k, i) for i, k in enumerate(keys)], "source_name string, run_id string, post int")
    fallback = primary.withColumn("post", F.col("post") + 10)
    enveloped = {r.post: r.collector_status for r in runs.with_run_envelopes(primary, classified).collect()}
    assert enveloped == {0: "SUCCESS", 1: "FAILED", 2: None, 3: None, 4: None, 5: None}
    assert sorted(r.post for r in runs.select_source(primary, fallback, classified).collect()) == [0, 2, 3, 4, 5, 11]


def test_choose_source(spark, tmp_path):
    good = jsonl.read_posts(spark, write_lines(tmp_path / "good.jsonl", record("sample-1")))
    bad = jsonl.read_posts(spark, str(tmp_path / "none.jsonl"))
    assert jsonl.choose_source(bad, good) is good
    assert jsonl.choose_source(good, bad) is good
    assert jsonl.choose_source(bad, bad) is bad


def test_unknown_status(spark):
    with pytest.raises(ValueError):
        runs.with_envelope(spark.range(1), "s", "OK", AT, AT)


def test_extract_posts(spark):
    columns = (
        "hrefs array<string>, text string, body_text string, datetime string, reply_raw array<string>, "
        "retweet_raw array<string>, like_raw array<string>, view_raw array<string>"
    )
    link = ["https://x.com/explore", "https://x.com/ann/status/42?s=20", "https://x.com/bob/status/7"]
    rows = [
        (link, " Buy #NIFTY, @bob ", "\n Ann \nmore", "2026-07-01", ["Reply", "3 replies"], [], ["1.2K"], None),
        (link[:1], "no link", "x", None, [], [], [], []),
        (link, "  ", "no text", None, [], [], [], []),
        (None, "text", "x", None, [], [], [], []),
    ]
    found = articles.extract_posts(spark.createDataFrame(rows, columns)).collect()
    assert len(found) == 1
    row = found[0]
    assert (row.tweet_id, row.username, row.display_name, row.url) == ("42", "ann", "Ann", "https://x.com/ann/status/42")
    assert (row.content, row.hashtags, row.mentions) == ("Buy #NIFTY, @bob", ["NIFTY"], ["bob"])
    assert (row.reply_count, row.retweet_count, row.like_count, row.view_count) == (3, None, 1200, None)
    assert row.follower_count is None and row.timestamp == "2026-07-01"


def test_snapshot_and_documents(spark, tmp_path, make_posts):
    posts = make_posts(record("123", like_count="3"), record("124"), record("9"))
    posts = posts.withColumns({"source_name": F.lit("feed"), "run_id": F.when(F.col("tweet_id") != "9", "a")})
    rows = [("feed", "a", 2, 0.5), ("feed", "b", 0, 0.0), ("feed", None, 1, 0.0)]
    metrics = spark.createDataFrame(rows, "source_name string, run_id string, total_collected int, duplicate_ratio double")
    path = sinks.write_snapshot(posts, metrics, str(tmp_path / "snap"))
    lines = [json.loads(r.value) for r in spark.read.text(f"{path}/posts").collect()]
    documents = [json.loads(line["document"]) for line in lines]
    assert sorted(d["tweet_id"] for d in documents) == ["123", "124", "9"]
    assert list(documents[0]) == list(S.POST_FIELDS)
    summary = spark.read.json(f"{path}/summary").collect()
    assert {r.metrics.run_id: (r.tweet_count, r.metrics.total_collected) for r in summary} == {"a": (2, 2), "b": (0, 0), None: (1, 1)}


def test_last_of_repeated_keys_and_numbers_without_a_name(spark, tmp_path):
    twice = json.dumps(record("1"))[:-1] + ', "content": "later", "like_count": 44}'
    odd = json.dumps(record("2", content='NaN said \"Infinity\", -Infinity', like_count=float("nan"), view_count=float("-inf")))
    path = write_lines(tmp_path / "in.jsonl", twice, odd)
    read = jsonl.read_posts(spark, path)
    first, second = read.posts.orderBy("ingest_seq").collect()
    assert (first.content, first.like_count) == ("later", "44")
    assert (second.content, second.like_count, second.view_count) == ('NaN said \"Infinity\", -Infinity', "NaN", "-Infinity")
    assert [r.like_count for r in clean_posts(read.posts).orderBy("tweet_id").collect()] == [44, 0]
    kept = jsonl.read_posts(spark, path, mode=jsonl.QUARANTINE)
    assert [r.tweet_id for r in kept.posts.collect()] == ["1"] and kept.rejects.first().reason.startswith(jsonl.BAD_COUNT)


def test_lines_are_scanned_once(spark, tmp_path):
    path = write_lines(tmp_path / "in.jsonl", *(record(str(i)) for i in range(50)))
    read = jsonl.read_posts(spark, path, limit=20)
    for frame in (read.posts, read.rejects):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Scan text" not in plan and "Scan parquet" in plan
    assert [r.ingest_seq for r in read.posts.orderBy("ingest_seq").collect()] == list(range(20))


def test_run_documents(spark, classified):
    document = json.loads(sinks.run_documents(classified.where("run_id = 'short'")).first().document)
    assert document["status"] == "PARTIAL" and document["error_message"] == runs.TOO_FEW_RECORDS
    assert datetime.fromisoformat(document["started_at"]) == AT


def test_parquet_round_trip_by_date(spark, tmp_path):
    posts = spark.createDataFrame([("1", AT)], "tweet_id string, timestamp timestamp")
    path = sinks.write_table(sinks.with_event_date(posts), str(tmp_path / "a/b/posts"), ("event_date",))
    read = spark.read.parquet(path)
    assert read.first().tweet_id == "1"
    plan = read.where("event_date = '2026-07-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_shared_folder(spark):
    assert sinks.shared_folder(spark, "/out") == (spark.conf.get("spark.checkpoint.dir", None) or "/out")
