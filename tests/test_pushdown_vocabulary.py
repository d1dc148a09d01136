"""Filters through cleaning against filters after it, and vocabularies of any size against counters."""

import math
import random
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from postsignal.operators import tfidf as T
from postsignal.operators.clean import clean_posts
from postsignal.operators.pushdown import CleanFilter, clean_posts_where
from postsignal.schema import ParameterError

ZONES = [timezone.utc, timezone(timedelta(hours=14)), timezone(timedelta(hours=-12)), timezone(timedelta(hours=23, minutes=59))]


def notations(at):
    year, week, day = at.isocalendar()
    yield at.isoformat()
    yield at.strftime("%Y%m%dT%H%M%S%z")
    yield at.strftime("%Y-%m-%d")
    yield f"{year:04d}-W{week:02d}-{day}"
    yield f"{year:04d}W{week:02d}{day}T{at:%H%M%S}"


def random_posts():
    random.seed(31)
    times = []
    for year in (2023, 2024, 2025, 2026):
        for _ in range(40):
            at = datetime(year, 1, 1, tzinfo=timezone.utc) + timedelta(minutes=random.choice([random.randint(-3000, 6000), random.randint(0, 525_000)]))
            times += list(notations(at.astimezone(random.choice(ZONES))))
    words = ["Rally now", "ＲＡＬＬＹ", "crash", "rall y", "naïve rally", ""]
    return [
        {"tweet_id": str(i % 50), "username": "u", "timestamp": random.choice([t, t, t, None, "soon"]), "content": random.choice(words), "view_count": random.choice([None, "5", "50", "x", "50.7"])}
        for i, t in enumerate(times)
    ]


FILTERS = [
    CleanFilter(since=datetime(2024, 1, 1), until=datetime(2024, 12, 31, 12)),
    CleanFilter(since=datetime(2024, 12, 30), until=datetime(2025, 1, 2)),
    CleanFilter(until=datetime(2023, 1, 2)),
    CleanFilter(since=datetime(2026, 1, 1, tzinfo=timezone(timedelta(hours=5))), tweet_ids=("1", "2", "3", "4", "5", "6", "7")),
    CleanFilter(least={"view_count": 50}, words=("rally",)),
    CleanFilter(least={"view_count": 0}, tweet_ids=("9",), source_names=("feed",)),
]


@pytest.mark.parametrize("number", range(len(FILTERS)))
def test_no_post_is_lost_ahead_of_cleaning(spark, make_posts, number):
    wanted = FILTERS[number]
    posts = make_posts(*random_posts()).withColumn("source_name", F.when(F.col("ingest_seq") % 3 == 0, "feed"))
    after = clean_posts(posts, carry=("ingest_seq",)).where(wanted.cleaned())
    found = clean_posts_where(posts, wanted, carry=("ingest_seq",))
    ids = [r.ingest_seq for r in found.collect()]
    assert sorted(ids) == sorted(r.ingest_seq for r in after.collect()) and ids
    assert posts.where(wanted.raw(posts)).count() < posts.count()


def test_filters_reach_the_scan(spark, make_posts, tmp_path):
    path = str(tmp_path / "posts")
    posts = make_posts(*random_posts()).withColumn("source_name", F.when(F.col("ingest_seq") % 3 == 0, "feed").otherwise("other"))
    posts.write.partitionBy("source_name").parquet(path)
    wanted = CleanFilter(datetime(2024, 3, 1), datetime(2024, 4, 1), ("1",), ("feed",), {"view_count": 50})
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        plan = clean_posts_where(spark.read.parquet(path), wanted).select("tweet_id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [isnotnull(source_name" in plan
    pushed = plan.split("PushedFilters: ")[1].split("ReadSchema")[0]
    for part in ("GreaterThanOrEqual(timestamp,2024-02-29)", "LessThan(timestamp,2024-04-03)", "EqualTo(tweet_id,1)", "IsNotNull(view_count)"):
        assert part in pushed, pushed
    assert "display_name" not in plan.split("ReadSchema: ")[1]


def test_typed_times_and_wrong_filters(spark, make_posts):
    posts = make_posts({"tweet_id": "1"}, {"tweet_id": "2"}).withColumn("timestamp", F.timestamp_seconds(F.col("ingest_seq") * 86_400))
    wanted = CleanFilter(datetime(1970, 1, 2), datetime(1970, 1, 3))
    assert [r.tweet_id for r in clean_posts_where(posts, wanted).collect()] == ["2"]
    assert clean_posts_where(posts, CleanFilter(source_names=("a",))).count() == 0
    for wrong in ({"least": {"likes": 1}}, {"words": ("Two words",)}, {"words": ("",)}):
        with pytest.raises(ParameterError):
            CleanFilter(**wrong)


def by_hand(texts, top_k):
    """Terms by count and first place, and every text's sparse vector."""
    import re

    words = [re.findall("[a-zA-Z][a-zA-Z0-9_]+", (t or "").lower()) for t in texts]
    counts, documents, first = Counter(w for own in words for w in own), Counter(w for own in words for w in set(own)), {}
    for i, own in enumerate(words):
        for place, w in enumerate(dict.fromkeys(own)):
            first.setdefault(w, (i, place))
    kept = sorted(counts, key=lambda w: (-counts[w], first[w]))[:top_k]
    idf = {w: math.log((1 + len(texts)) / (1 + documents[w])) + 1 for w in kept}
    index = {w: i for i, w in enumerate(kept)}
    vectors = [{index[w]: n / len(own) * idf[w] for w, n in Counter(own).items() if w in index} for own in words]
    return index, vectors


@pytest.mark.parametrize("top_k", [0, 1, 40, 300, 10_000])
def test_sparse_vectors(spark, top_k):
    random.seed(top_k)
    texts = [" ".join(random.choice(["aa", "bb", "cc", "Dd"]) + str(random.randint(0, 150)) for _ in range(random.randint(0, 30))) for _ in range(80)] + [None, "", "1 2"]
    posts = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "ingest_seq bigint, content_clean string").repartition(3)
    terms = T.vocabulary_table(posts, top_k)
    index, vectors = by_hand(texts, top_k)
    assert {r.term: r["index"] for r in terms.collect()} == index
    got = {r.ingest_seq: dict(zip(r.indices, r["values"], strict=True)) for r in T.tfidf_sparse(posts, terms).collect()}
    assert len(got) == len(texts)
    for i, expected in enumerate(vectors):
        assert got[i] == pytest.approx(expected) and list(got[i]) == sorted(got[i])


def test_a_hundred_thousand_terms(spark):
    text = F.concat_ws(" ", *(F.concat(F.lit("t"), (F.col("id") * 50 + i).cast("string")) for i in range(50)), F.lit("common"))
    posts = spark.range(2400).select(F.col("id").alias("ingest_seq"), text.alias("content_clean"))
    terms = T.vocabulary_table(posts, 100_000)
    found = terms.agg(F.count("*").alias("n"), F.max("index").alias("last"), F.min_by("term", "index").alias("first"), F.max_by("term", "index").alias("least")).first()
    assert tuple(found) == (100_000, 99_999, "common", "t99998")
    vectors = T.tfidf_sparse(posts, terms)
    sizes = vectors.groupBy(F.size("indices").alias("n")).count().collect()
    assert {r.n: r["count"] for r in sizes} == {51: 1999, 50: 1, 1: 400}
    plan = T._counted_words(posts, "content_clean").groupBy("term").agg(F.sum("n"), F.count("*"))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
