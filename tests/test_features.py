import math
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from postsignal.operators import tfidf
from postsignal.operators.clean import clean_posts
from postsignal.operators.features import add_features, add_signals
from postsignal.schema import CLEAN_SCHEMA, FEATURE_FIELDS, ParameterError, SourceThresholds

NOW = datetime(2026, 7, 1, 12, tzinfo=timezone.utc)


def post(tweet_id, content, minutes_ago=0, likes="3"):
    return {
        "tweet_id": tweet_id, "username": "Desk_One", "display_name": "Desk One", "content": content,
        "timestamp": (NOW - timedelta(minutes=minutes_ago)).isoformat(), "hashtags": ["Oil"],
        "mentions": ["OPS"], "reply_count": "2", "retweet_count": "4", "like_count": likes,
        "view_count": "50", "follower_count": "730", "following_count": "12",
    }


def corpus(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "ingest_seq bigint, content_clean string")


# Worked out by hand: 4 posts, corpus counts gold 4, oil 3, tin 2, zinc 1.
HAND_TEXTS = ["gold gold oil", "oil tin", "gold oil tin zinc", "gold 1 q"]
HAND_POSTS_WITH = {"gold": 3, "oil": 3, "tin": 2, "zinc": 1}
HAND_SHARES = {
    (0, "gold"): 2 / 3, (0, "oil"): 1 / 3, (1, "oil"): 1 / 2, (1, "tin"): 1 / 2,
    (2, "gold"): 1 / 4, (2, "oil"): 1 / 4, (2, "tin"): 1 / 4, (2, "zinc"): 1 / 4, (3, "gold"): 1.0,
}


@pytest.mark.parametrize("k", [0, 1, 3, 60])
def test_tfidf_of_a_hand_made_corpus(spark, k):
    posts = corpus(spark, HAND_TEXTS)
    fitted = tfidf.fit_terms(posts.repartition(5), k)
    terms = ["gold", "oil", "tin", "zinc"][:k]
    assert [t.term for t in fitted] == terms
    wide = tfidf.tfidf_wide(posts, fitted)
    assert wide.columns == posts.columns + [f"tfidf_{t}" for t in terms]
    for row in wide.collect():
        for term in terms:
            wanted = HAND_SHARES.get((row.ingest_seq, term), 0) * (1 + math.log(5 / (1 + HAND_POSTS_WITH[term])))
            assert row[f"tfidf_{term}"] == pytest.approx(wanted, abs=1e-12)
    if k:
        long = {(r.ingest_seq, r.term) for r in tfidf.tfidf_long(posts, fitted).collect()}
        assert long == {key for key in HAND_SHARES if key[1] in terms}


def test_tfidf_properties_of_random_posts(spark):
    random.seed(3)
    words = [f"w{i}" for i in range(40)] + ["a", "7up", "x_1", "caf\u00e9s"]
    texts = [" ".join(random.choices(words, k=random.randint(0, 30))) for _ in range(120)] + ["", None, "1 2 3"]
    posts = corpus(spark, texts)
    fitted = tfidf.fit_terms(posts.repartition(5), 1000)
    assert [t.corpus_count for t in fitted] == sorted((t.corpus_count for t in fitted), reverse=True)
    by_rarity = sorted(fitted, key=lambda t: t.document_count)
    assert [t.idf for t in by_rarity] == sorted((t.idf for t in fitted), reverse=True)
    idf = {t.term: t.idf for t in fitted}
    shares = {}
    for r in tfidf.tfidf_long(posts, fitted).collect():
        shares[r.ingest_seq] = shares.get(r.ingest_seq, 0) + r.tfidf / idf[r.term]
    # With every term in the vocabulary the shares of a post add up to one.
    assert all(total == pytest.approx(1) for total in shares.values()) and 110 <= len(shares) <= 120


def test_ties_go_to_the_first_occurrence(spark):
    posts = corpus(spark, ["zz yy", "xx zz yy", "ww"])
    fitted = tfidf.fit_terms(posts.repartition(3), 3)
    assert [(t.rank, t.term) for t in fitted] == [(1, "zz"), (2, "yy"), (3, "xx")]


def test_struct_order_column(spark):
    posts = corpus(spark, ["bb aa", "aa bb cc"]).withColumn(
        "place", F.struct(F.lit("file").alias("f"), F.col("ingest_seq").alias("n"))
    )
    assert [t.term for t in tfidf.fit_terms(posts, 3, order="place")] == ["bb", "aa", "cc"]


def test_vocabulary_plan_groups_by_term_only(spark):
    plan = tfidf.vocabulary(corpus(spark, ["a b"]))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(term" in plan
    assert plan.count("Exchange hashpartitioning") == 1
    assert "SortAggregate" not in plan and "Cartesian" not in plan


def test_scoring_does_not_shuffle_posts(spark):
    terms = [tfidf.Term(1, "nifty", 2, 1, 3)]
    for frame in (
        tfidf.tfidf_wide(corpus(spark, ["nifty a"]), terms),
        tfidf.tfidf_long(corpus(spark, ["nifty a"]), terms),
    ):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "Python" not in plan


def test_clean_row(spark, make_posts):
    raw = "Oil\u2003\u2603 @B #Tin"
    cleaned = clean_posts(make_posts(post("1", raw)))
    assert [(f.name, f.dataType) for f in cleaned.schema] == [(f.name, f.dataType) for f in CLEAN_SCHEMA]
    row = cleaned.first()
    assert (row.content, row.content_clean, row.follower_count) == (raw, "oil @b #tin", 730)
    assert (row.username, row.display_name, row.hashtags_norm, row.mentions_norm) == ("desk_one", "Desk One", ["oil"], ["ops"])


def test_empty_frames_keep_the_schema(make_posts):
    empty = clean_posts(make_posts(post("1", "x")).limit(0))
    features = add_features(empty, [], NOW)
    assert features.columns == [*CLEAN_SCHEMA.fieldNames(), *FEATURE_FIELDS]
    assert features.count() == 0


def test_features_keep_direction(make_posts):
    posts = make_posts(post("up", "oil rally", 1), post("down", "oil crash", 1), post("flat", "oil rally crash", 1), post("twice", "rally Rally RALLY", 1))
    cleaned = clean_posts(posts, carry=("ingest_seq",))
    rows = {r.tweet_id: r for r in add_features(cleaned, tfidf.fit_terms(cleaned), NOW).collect()}
    assert rows["up"].composite_signal > 0 == rows["flat"].composite_signal > rows["down"].composite_signal
    assert [rows[k].lexical_sentiment for k in ("up", "down", "flat", "twice")] == [1.0, -1.0, 0.0, 1.0]
    assert rows["up"].tfidf_oil > 0 == rows["twice"].tfidf_oil


def test_signal_values(make_posts):
    posts = make_posts(
        post("now", "buy"), post("old", "buy", 12 * 60), post("future", "buy", -60),
        {**post("none", "buy"), "timestamp": None},
    )
    rows = {r.tweet_id: r for r in add_signals(clean_posts(posts), NOW).collect()}
    engagement = 3 + 2 * 4 + 2 + 0.25 * math.log(51)
    assert rows["now"].engagement_score == pytest.approx(engagement)
    decays = {name: row.recency_decay for name, row in rows.items()}
    assert decays == {"now": 1.0, "old": pytest.approx(0.5), "future": 1.0, "none": 0.0}
    assert rows["old"].composite_signal == pytest.approx(math.log1p(engagement) * 0.5)


def test_plan_has_no_python(make_posts):
    plan = add_signals(clean_posts(make_posts(post("1", "x"))), NOW)._jdf.queryExecution().toString()
    assert "Python" not in plan


@pytest.mark.parametrize(
    "bad", [{"max_empty_run": 0}, {"max_duplicate_ratio": 1.5}, {"rolling_batches": 0}]
)
def test_bad_thresholds(bad):
    with pytest.raises(ParameterError):
        SourceThresholds(**bad)


def test_too_many_terms(spark):
    with pytest.raises(ValueError):
        tfidf.fit_terms(corpus(spark, ["a"]), -1)
