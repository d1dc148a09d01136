"""Queries on tables whose ids or sizes differ from the driver's small ones."""

import re
from datetime import datetime

import pytest

from postsignal.functions.text import TOKEN_PATTERN
from postsignal.operators import tfidf as T
from postsignal.operators.clean import clean_posts
from postsignal.operators.features import add_features
from postsignal.plans import driver_tables as tables
from postsignal.plans import queries as registry


@pytest.fixture
def tables_of(spark, tmp_path):
    """Writes documents with these ids and texts, and an event for each."""

    def write(texts: dict[int, str]) -> str:
        documents = [(i, text, "en", "web", len(text or "")) for i, text in texts.items()]
        events = [(i, datetime(2024, 1, 2), i % 50, "view", 1.0, "{}") for i in texts]
        for name, rows in (("documents", documents), ("events", events)):
            spark.createDataFrame(rows, tables.SCHEMAS[name]).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


def _order_value(i):
    return None if i % 11 == 4 else (i - 300) * 9_000_000_000_001 + i % 7


@pytest.mark.parametrize("start", [0, 1_024_700, 5_000_000_000])
def test_limit_by_cutoff_orders_values_beyond_64_bits(spark, tables_of, start):
    ids = [*range(start, start + 300), 7_000_000_000]
    found = registry.queries()["limit_posts_by_cutoff"](spark, tables_of({i: "a text" for i in ids})).collect()
    expected = sorted((i for i in ids if _order_value(i) is not None), key=_order_value)[: registry.LIMIT // 5]
    assert sorted(r.ingest_seq for r in found) == expected
    held = {i: v if abs(v := _order_value(i)) < 1 << 63 else None for i in expected}
    assert {r.ingest_seq: r.order_value for r in found} == held


def _plan(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_counted_words_interpret_no_lambda(spark):
    posts = spark.createDataFrame([(1, "bb a1 Bb bbb 9a1 bb_ bb"), (2, "x 1"), (3, None)], "ingest_seq bigint, content_clean string")
    words = T._counted_words(posts, "content_clean", "ingest_seq")
    assert "lambda" not in _plan(words)
    rows = {(r.ingest_seq, r.n_tokens, r.term, r.n) for r in words.collect()}
    # 9a1 holds the token a1.
    own = {(1, 7, "a1", 2), (1, 7, "bb", 3), (1, 7, "bb_", 1), (1, 7, "bbb", 1)}
    assert rows == own | {(2, None, None, None), (3, None, None, None)}


def test_vocabulary_table_is_written(spark):
    """Spark then knows its size and broadcasts it without a shuffle of all words."""
    posts = spark.createDataFrame([(1, "aa bb"), (2, "bb")], "ingest_seq bigint, content_clean string")
    terms = T.vocabulary_table(posts, 5)
    assert "Relation" in _plan(terms).splitlines()[0]


def test_nfkc_texts_are_changed_once(spark, tables_of):
    found = registry.queries()["normalize_nfkc"](spark, tables_of({1: "a text"}))
    assert _plan(found).count("translate(") == 1


def test_tags_are_read_after_the_sort(spark, tables_of):
    above, below = _plan(registry._ordered_posts(spark, tables_of({1: "a #tag"}))).split("Sort [", 1)
    assert "regexp_extract_all" in above and "regexp_extract_all" not in below


def _optimized(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_features_cut_the_tokens_of_a_post_once(make_posts):
    posts = clean_posts(make_posts({"content": "gold rally gold"}, {"content": "oil crash"}), ("ingest_seq",))
    terms = T.fit_terms(posts)
    features = add_features(posts, terms)
    assert _optimized(features).count(f", {TOKEN_PATTERN}, 0)") == 1  # two before: for the lexicons and for the terms
    assert {r.ingest_seq: r.lexical_sentiment for r in features.collect()} == {0: 1.0, 1: -1.0}
    assert "_words" not in features.columns and "_words" not in add_features(posts, []).columns


def test_terms_are_counted_in_a_line_of_hits(spark):
    texts = ["go go gold go_ gold gold go", "gold", "", None, "7go goo", "go gold go gold"]
    posts = spark.createDataFrame(list(enumerate(texts)), "ingest_seq bigint, content_clean string")
    terms = [T.Term(rank, term, 1, 1, 1) for rank, term in enumerate(["go", "gold", "go_", "absent", "a.c", "g+"], 1)]
    wide = T.tfidf_wide(posts, terms)
    assert "map_from_entries" not in _optimized(wide)  # a comparison of each pair of hits before
    words = [re.findall("[a-z][a-z0-9_]+", text or "") for text in texts]
    for row in wide.collect():
        for term in terms:
            found = words[row.ingest_seq]
            wanted = found.count(term.term) / len(found) * term.idf if found else 0.0
            assert row[f"tfidf_{term.term}"] == pytest.approx(wanted, abs=1e-12)
