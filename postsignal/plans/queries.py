"""Every operator as a query over the driver's tables: ``name -> (spark, sf_dir) -> DataFrame``.

Timestamps leave as ``timestamp_ntz`` in UTC and doubles are rounded to six places, so that other
engines give equal values.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postsignal.functions import scalars, signals, text
from postsignal.operators import buckets as B
from postsignal.operators import dedupe as D
from postsignal.operators import health as H
from postsignal.operators import tfidf as T
from postsignal.operators.clean import clean_posts
from postsignal.operators.features import add_features, add_signals
from postsignal.operators.pushdown import CleanFilter, clean_posts_where
from postsignal.operators.rows import first_posts, spread, with_required_values
from postsignal.operators.run_cut import StopRules, cut_runs
from postsignal.plans import driver_tables as tables
from postsignal.plans.live_run import LiveRun
from postsignal.plans.live_run import live_run as live_run_plan
from postsignal.plans.signal_run import RunOptions, post_signals, run_from_files
from postsignal.schema import COUNT_FIELDS, POST_FIELDS, SUCCESS, SourceThresholds
from postsignal.sinks.ledger import ledger
from postsignal.sinks.tables import (
    new_folder,
    post_documents,
    run_documents,
    stage,
    write_snapshot,
)
from postsignal.sources import articles, jsonl, runs
from postsignal.streaming import feed

Query = Callable[[SparkSession, str], DataFrame]

LIMIT = 500
#: Signs that NFKC rewrites: a ligature, wide letters, a numeral, a fraction, a unit, a wide space, letter and accent.
NFKC_SAMPLE = "ﬁnal ＲＡＬＬＹ Ⅷ ½ ㎏\u3000cafe\u0301 ＃ｔａｇ"
STREAM_DELAY = "2 days"
LATE_DELAY = "5 days"
#: Terms of the sparse vectors' vocabulary.
SPARSE_TERMS = 700
_QUERIES: dict[str, Query] = {}


def _register(query: Query) -> Query:
    def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, sf_dir)

    _QUERIES[query.__name__] = in_utc
    return query


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _ntz(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz").alias(name)


def _round(value: Column | str, name: str | None = None) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return F.round(column, 6).alias(name or str(value))


def _count_or_none(count: Column, name: str) -> Column:
    """A missing count shows as -1: client frames turn integers with nulls into floats."""
    return F.coalesce(count, F.lit(-1).cast("bigint")).alias(name)


def _joined(name: str) -> Column:
    return F.array_join(name, "|").alias(name)


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_posts(tables.posts(spark, sf_dir), carry=("ingest_seq",))


def _deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.dedupe_posts(_clean(spark, sf_dir))


def _staged_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated texts, written once for the vocabulary fit and the scoring."""
    return stage(_deduped(spark, sf_dir).select("ingest_seq", "content_clean"), "texts")


# Scalar functions


@_register
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = tables.posts(spark, sf_dir)
    return posts.select("ingest_seq", text.normalize_text(F.col("content")).alias("content_clean"))


@_register
def normalize_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = _clean(spark, sf_dir)
    return clean.select("ingest_seq", _joined("hashtags_norm"), _joined("mentions_norm"))


@_register
def parse_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = tables.posts(spark, sf_dir)
    parsed = posts.withColumn("timestamp", scalars.parse_timestamp(F.col("timestamp")))
    return parsed.select("ingest_seq", _ntz("timestamp"))


@_register
def safe_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("view_count").cast("string")
    raw = (
        F.when(F.col("ingest_seq") % 5 == 0, number)
        .when(F.col("ingest_seq") % 5 == 1, F.concat(F.lit(" "), number, F.lit(" ")))
        .when(F.col("ingest_seq") % 5 == 2, F.concat(number, F.lit(".9")))
        .when(F.col("ingest_seq") % 5 == 3, F.lit(""))
    )
    posts = tables.posts(spark, sf_dir)
    return posts.select("ingest_seq", scalars.safe_int(raw).alias("count"))


@_register
def parse_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    captured = tables.articles(spark, sf_dir)
    counts = {
        name: scalars.parse_count(F.get(f"{name}_raw", 0)) for name in ("like", "view")
    }
    return captured.select(
        "ingest_seq", *(_count_or_none(count, f"{name}_count") for name, count in counts.items())
    )


@_register
def first_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    captured = tables.articles(spark, sf_dir)
    candidates = [F.get("reply_raw", 0), F.get("reply_raw", 1), F.get("view_raw", 0)]
    return captured.select("ingest_seq", scalars.first_count(*candidates).alias("count"))


@_register
def extract_hashtags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.posts(spark, sf_dir).select("ingest_seq", _joined("hashtags"))


@_register
def extract_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.posts(spark, sf_dir).select("ingest_seq", _joined("mentions"))


@_register
def url_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return tables.posts(spark, sf_dir).select(
        "ingest_seq",
        scalars.url_without_query(url).alias("bare_url"),
        scalars.post_id_from_url(url).alias("post_id"),
        scalars.username_from_url(url).alias("url_username"),
    )


@_register
def display_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    captured = tables.articles(spark, sf_dir)
    return captured.select("ingest_seq", text.first_line(F.col("body_text")).alias("display_name"))


@_register
def dedupe_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = tables.posts(spark, sf_dir)
    both = D.with_record_key(posts).withColumnRenamed("dedupe_key", "record_key")
    clean = clean_posts(both, carry=("ingest_seq", "record_key"))
    return D.with_cleaned_key(clean).select(
        "ingest_seq", "record_key", F.col("dedupe_key").alias("cleaned_key")
    )


@_register
def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = tables.posts(spark, sf_dir)
    words = posts.select("ingest_seq", text.tokens(F.col("content")).alias("words"))
    return words.select(
        "ingest_seq", F.size("words").alias("n_tokens"), F.array_join("words", " ").alias("tokens")
    )


@_register
def sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = _clean(spark, sf_dir).select("ingest_seq", text.tokens(F.col("content_clean")).alias("words"))
    score = signals.lexical_sentiment(F.col("words"))
    return words.select("ingest_seq", score.alias("lexical_sentiment"))


@_register
def engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = add_signals(_clean(spark, sf_dir), tables.AS_OF)
    return scored.select("ingest_seq", _round("engagement_score"))


@_register
def recency_decay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decay as of a fixed time, and as of the end of each post's own day."""
    clean = _clean(spark, sf_dir)
    day_end = F.date_trunc("day", "timestamp") + F.expr("INTERVAL 1 DAY")
    return clean.select(
        "ingest_seq",
        _round(
            signals.recency_decay(F.col("timestamp"), scalars.as_of_column(tables.AS_OF)),
            "recency_decay",
        ),
        _round(signals.recency_decay(F.col("timestamp"), day_end), "decay_in_day"),
    )


@_register
def composite_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = add_signals(_clean(spark, sf_dir), tables.AS_OF)
    return scored.select("ingest_seq", _round("composite_signal"))


@_register
def search_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = tables.table(spark, sf_dir, "documents")
    return documents.select("doc_id", scalars.search_url(F.col("text")).alias("search_url"))


# Projections, filters and sources


@_register
def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = runs.with_envelope(
        tables.posts(spark, sf_dir), "batch_feed", SUCCESS, tables.AS_OF, tables.AS_OF
    )
    cleaned = clean_posts(posts, carry=("ingest_seq",))
    shown = {"hashtags_norm": _joined, "mentions_norm": _joined}
    times = ("timestamp", "collected_started_at", "collected_ended_at")
    shown.update({name: _ntz for name in times})
    return cleaned.select(*(shown.get(name, F.col)(name) for name in cleaned.columns))


#: What ``clean_where`` wants: a week, two of the feeds, some likes, a word.
WANTED = CleanFilter(
    datetime(2024, 1, 2), datetime(2024, 1, 3, 7), source_names=("feed_0", "feed_2"), least={"view_count": 2000}, words=("user_",)
)


@_register
def clean_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned posts by conditions on cleaned columns that reach the raw ones."""
    found = clean_posts_where(tables.posts(spark, sf_dir), WANTED, carry=("ingest_seq",))
    return found.select("ingest_seq", _ntz("timestamp"), "source_name", "view_count", "content_clean")


@_register
def normalize_nfkc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalized texts in which NFKC changes letters, digits, signs and spaces."""
    posts = tables.posts(spark, sf_dir)
    changed = F.concat(F.lit(NFKC_SAMPLE + " "), F.translate("content", "aeiou0123", "ａｅｉｏｕ０１２３"))
    # A column of its own: inside the conditional the text would be changed again for each use.
    changed_posts = posts.select("ingest_seq", changed.alias("content"))
    return changed_posts.select("ingest_seq", text.normalize_text(F.col("content")).alias("content_clean"))


@_register
def required_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_required_values(tables.posts(spark, sf_dir)).select("ingest_seq", "tweet_id", "content")


@_register
def marker_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = tables.captured_pages(spark, sf_dir)
    return pages.select("page_id", articles.login_wall(F.col("page_text")).alias("login_wall"))


@_register
def status_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = tables.captured_pages(spark, sf_dir)
    hrefs = F.regexp_extract_all(F.concat("html", "extra_link"), F.lit('href="([^"]*)"'), 1)
    return pages.select("page_id", articles.first_status_url(hrefs).alias("status_url"))


@_register
def extract_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = articles.extract_posts(tables.articles(spark, sf_dir), carry=("ingest_seq",))
    shown = {"hashtags": _joined("hashtags"), "mentions": _joined("mentions")}
    shown.update({name: _count_or_none(F.col(name), name) for name in COUNT_FIELDS})
    return found.withColumns(shown)


def _json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts as JSON lines; some are cut off, lack a key, are no object, carry another key, a key twice or a count of NaN."""
    posts = tables.posts(spark, sf_dir)
    kind = F.col("ingest_seq") % 23
    fields = F.struct(*POST_FIELDS)
    without_content = F.struct(*(name for name in POST_FIELDS if name != "content"))
    with_nulls = {"ignoreNullFields": "false"}
    whole = F.to_json(fields, with_nulls)
    line = (
        F.when(kind == 1, F.substring(whole, F.lit(1), F.length(whole) - 1))
        .when(kind == 2, F.to_json(without_content, with_nulls))
        .when(kind == 3, F.concat(F.lit("["), whole, F.lit("]")))
        .when(kind == 4, F.concat(F.lit('{"other": 1, '), F.substring(whole, F.lit(2), F.length(whole))))
        .when(kind == 5, F.concat(whole, F.lit(" {}")))
        .when(kind == 6, F.concat(F.lit('{"content": "NaN", '), F.substring(whole, F.lit(2), F.length(whole))))
        .when(kind == 7, F.regexp_replace(whole, '"reply_count":[0-9]+', '"reply_count": NaN'))
        .otherwise(whole)
    )
    return posts.select("ingest_seq", line.alias("line"))


@_register
def jsonl_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = jsonl.post_columns(jsonl.parse_lines(_json_lines(spark, sf_dir)), "ingest_seq")
    return posts.withColumns({"hashtags": _joined("hashtags"), "mentions": _joined("mentions")})


@_register
def jsonl_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = jsonl.reject_columns(jsonl.parse_lines(_json_lines(spark, sf_dir)), "ingest_seq")
    return rejects.select("ingest_seq", "reason")


@_register
def limit_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = tables.posts(spark, sf_dir).select("ingest_seq", "tweet_id", "content")
    return first_posts(posts, LIMIT)


@_register
def limit_posts_by_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first posts by order values that are scattered over all 64 bits; some posts have none.

    Large ids make values that outgrow 64 bits. So the order is that of the exact value in two integers; a value that a
    bigint cannot hold leaves as null, and its post keeps its place.
    """
    posts = tables.posts(spark, sf_dir).select("ingest_seq", "tweet_id", "content")
    ids = F.col("ingest_seq").cast("decimal(20,0)")
    value = F.when(F.col("ingest_seq") % 11 != 4, (ids - 300) * F.lit(9_000_000_000_001) + F.col("ingest_seq") % 7)
    half = F.lit(1 << 62)
    low = F.pmod("_value", half)
    parts = F.struct(((F.col("_value") - low) / half).cast("bigint").alias("high"), low.cast("bigint").alias("low"))
    placed = posts.withColumn("_value", value).withColumn("_place", F.when(F.col("_value").isNotNull(), parts))
    first = first_posts(placed, LIMIT // 5, "_place")
    return first.withColumn("order_value", F.col("_value").try_cast("bigint")).drop("_value", "_place")


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.classify_live_runs(tables.source_runs(spark, sf_dir))


@_register
def run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _runs(spark, sf_dir).select("source_name", "run_id", "n_records", "status", "error_message")


def _loose_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts of which some know no run."""
    return tables.posts(spark, sf_dir).withColumn("run_id", F.when(F.col("ingest_seq") % 41 != 7, F.col("run_id")))


def _known_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run rows of which one is missing."""
    return _runs(spark, sf_dir).where((F.col("source_name") != "feed_1") | (F.col("run_id") != "run_0"))


@_register
def envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = _loose_posts(spark, sf_dir).select("ingest_seq", "tweet_id", "source_name", "run_id")
    return runs.with_run_envelopes(posts, _known_runs(spark, sf_dir)).withColumns(
        {
            "collected_started_at": _ntz("collected_started_at"),
            "collected_ended_at": _ntz("collected_ended_at"),
        }
    )


@_register
def fallback_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    primary = _loose_posts(spark, sf_dir).select("ingest_seq", "tweet_id", "content", "source_name", "run_id")
    replacement_id = F.concat(F.lit("fallback-"), F.col("ingest_seq").cast("string"))
    fallback = primary.withColumn("tweet_id", replacement_id)
    return runs.select_source(primary, fallback, _known_runs(spark, sf_dir))


#: When the runs of ``run_cut`` and ``live_run`` end.
CUT_RULES = StopRules(SourceThresholds(max_empty_run=4, max_duplicate_ratio=0.6, min_records_per_minute=0.0005), 2, 20 * 86_400.0)


@_register
def run_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run at its first stop: why it ended, what it had by then, its status."""
    batches = tables.run_batches(spark, sf_dir)
    cut = cut_runs(batches, tables.capture_runs(spark, batches), CUT_RULES, segment_width=16)
    return cut.runs.select(
        "source_name", "run_id", "status", "error_message", "stop_reason", "n_records", "total_duplicates",
        "total_batches", "last_batch", _ntz("ended_at"), _round("duplicate_ratio"), _round("records_per_minute"),
    )


@_register
def run_cut_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batches that count."""
    batches = tables.run_batches(spark, sf_dir)
    cut = cut_runs(batches, tables.capture_runs(spark, batches), CUT_RULES, segment_width=16)
    return cut.batches.select("source_name", "run_id", "batch_seq", "new_records", "duplicates")


def _live(spark: SparkSession, sf_dir: str) -> LiveRun:
    posts, captures = tables.live_posts(spark, sf_dir), tables.captures(spark, sf_dir)
    replacement = F.concat(F.lit("fallback-"), F.col("ingest_seq").cast("string"))
    fallback = tables.posts(spark, sf_dir).withColumn("tweet_id", replacement).where(F.col("ingest_seq") % 3 != 1).drop("event_ts")
    runs_ = tables.capture_runs(spark, captures)
    return live_run_plan(captures, posts, runs_, fallback, new_folder(spark, "live"), CUT_RULES, RunOptions(as_of=tables.AS_OF))


@_register
def live_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From captured batches to published posts with signals: cut, status, fallback, cleaning, dedupe, scores."""
    features = _live(spark, sf_dir).attempt.table("tweets_features")
    return features.select(
        "ingest_seq", "tweet_id", "source_name", "run_id", "collector_status",
        _round("engagement_score"), "lexical_sentiment", _round("composite_signal"),
    )


@_register
def run_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the live run published: rows of each table and runs of each status."""
    attempt = _live(spark, sf_dir).attempt
    row = ledger(spark, attempt.root)
    counted = row.select(F.explode("counts").alias("name", "n")).where(F.col("name") != "signals_aggregated")
    counted = counted.where(F.col("name") != "composite_signal")
    return counted.unionByName(row.select(F.explode("statuses").alias("name", "n")))


@_register
def file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of the lines of several files, as the written features keep them."""
    source = _posts_as_files(spark, sf_dir)
    result = run_from_files(spark, source, None, new_folder(spark, "run"), options=RunOptions(as_of=tables.AS_OF))
    return spark.read.parquet(result.paths["tweets"]).select("ingest_seq", "tweet_id", "content_clean")


@_register
def post_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return post_documents(tables.posts(spark, sf_dir), "ingest_seq")


@_register
def run_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_documents(_runs(spark, sf_dir))


# Deduplication


@_register
def dedupe_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    deduped = _deduped(spark, sf_dir)
    return deduped.select("ingest_seq", "tweet_id", "username", "content_clean", _ntz("timestamp"))


@_register
def dedupe_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All posts, after the posts of one feed have been seen in an earlier batch."""
    posts = tables.posts(spark, sf_dir)
    seen = D.with_record_key(posts.where(F.col("source_name") == "feed_0")).select("dedupe_key")
    return D.unseen_posts(posts, seen.distinct()).select("ingest_seq", "dedupe_key")


def _placed_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts with the hour they were collected in as their batch."""
    posts = tables.posts(spark, sf_dir)
    return posts.withColumn("batch_at", F.date_trunc("hour", "event_ts").cast("timestamp_ntz"))


@_register
def dedupe_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.count_new_per_batch(_placed_posts(spark, sf_dir), "batch_at", "ingest_seq")


@_register
def dedupe_batches_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of each run up to the run's 20th new id."""
    placed = _placed_posts(spark, sf_dir)
    return D.count_new_per_batch(
        placed, "batch_at", "ingest_seq", run=("source_name", "run_id"), limit=20
    )


# TF-IDF and features


@_register
def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.vocabulary(_deduped(spark, sf_dir)).select(
        "term", "corpus_count", "document_count", "corpus_size", _round("idf")
    )


@_register
def tfidf_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    deduped = _staged_texts(spark, sf_dir)
    scores = T.tfidf_long(deduped, T.fit_terms(deduped))
    return scores.select("ingest_seq", "term", _round("tf"), _round("idf"), _round("tfidf"))


@_register
def tfidf_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The term columns by their rank in the vocabulary, since the terms depend on the data."""
    deduped = _staged_texts(spark, sf_dir)
    terms = T.fit_terms(deduped)
    wide = T.tfidf_wide(deduped, terms)
    ranked = [_round(f"tfidf_{t.term}", f"tfidf_rank_{t.rank}") for t in terms]
    return wide.select("ingest_seq", *ranked)


@_register
def tfidf_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse vectors over a vocabulary table, one row for each of their values."""
    deduped = _staged_texts(spark, sf_dir)
    vectors = T.tfidf_sparse(deduped, T.vocabulary_table(deduped, SPARSE_TERMS))
    return vectors.select("ingest_seq", F.inline(F.arrays_zip("indices", "values"))).select(
        "ingest_seq", F.col("indices").alias("index"), _round("values", "tfidf")
    )


@_register
def post_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned, deduplicated posts with every feature; the term columns by their rank, since the terms depend on the data."""
    deduped = stage(_deduped(spark, sf_dir), "posts_clean")
    terms = T.fit_terms(deduped)
    features = add_features(deduped, terms, tables.AS_OF)
    return features.select(
        "ingest_seq",
        "tweet_id",
        _ntz("timestamp"),
        _round("engagement_score"),
        "lexical_sentiment",
        _round("recency_decay"),
        _round("composite_signal"),
        *(_round(f"tfidf_{t.term}", f"tfidf_rank_{t.rank}") for t in terms),
    )


# Buckets


def _signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return post_signals(tables.posts(spark, sf_dir), tables.AS_OF)


def _shown_buckets(buckets: DataFrame) -> DataFrame:
    rounded = [_round(name) for name in buckets.columns[2:]]
    return buckets.select(_ntz("timestamp"), "tweet_count", *rounded)


@_register
def signal_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown_buckets(B.aggregate_signals(_signals(spark, sf_dir), "1h"))


@_register
def signal_buckets_90m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown_buckets(B.aggregate_signals(_signals(spark, sf_dir), "1h30m"))


@_register
def signal_buckets_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown_buckets(B.aggregate_signals(_signals(spark, sf_dir), "1w"))


@_register
def signal_buckets_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown_buckets(B.aggregate_signals(_signals(spark, sf_dir), "1mo"))


@_register
def undated_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.count_undated(_clean(spark, sf_dir))


@_register
def signal_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = B.signal_series(B.aggregate_signals(_signals(spark, sf_dir), "1h"))
    return series.select(_ntz("timestamp"), _round("composite_signal_mean"))


# Files and runs


def _ordered_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts in ingest order; tags and mentions come after the sort, which runs its input twice, for ranges and for rows."""
    return tables.with_entities(tables.raw_posts(spark, sf_dir).orderBy("ingest_seq"))


def _posts_as_files(spark: SparkSession, sf_dir: str) -> str:
    """Posts as JSON lines; the files, and the lines in them, are in ingest order."""
    path = new_folder(spark, "posts_jsonl")
    post_documents(_ordered_posts(spark, sf_dir)).write.text(path)
    return path


@_register
def file_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The posts read back from JSON lines, with the envelope of the run that read them."""
    read = jsonl.read_posts(spark, _posts_as_files(spark, sf_dir))
    return read.posts.select(
        "tweet_id", "username", "content", "like_count", "url", "source_name", "collector_status"
    )


@_register
def file_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status rows of a good run, and of a strict one over files with bad lines."""
    good = jsonl.read_posts(spark, _posts_as_files(spark, sf_dir), source_name="good")
    path = new_folder(spark, "bad_jsonl")
    _json_lines(spark, sf_dir).select("line").write.text(path)
    strict = jsonl.read_posts(spark, path, source_name="strict")
    quarantine = jsonl.read_posts(spark, path, mode=jsonl.QUARANTINE, source_name="quarantine")
    chosen = jsonl.choose_source(strict, good)
    found = jsonl.runs_frame(spark, [good, strict, quarantine, chosen])
    return found.select("source_name", "status", "n_records")


@_register
def batch_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run, from JSON lines to the written buckets."""
    source = _posts_as_files(spark, sf_dir)
    options = RunOptions(as_of=tables.AS_OF)
    result = run_from_files(spark, source, None, new_folder(spark, "run"), options=options)
    return _shown_buckets(spark.read.parquet(result.paths["aggregated"]))


@_register
def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of a JSON snapshot of all posts, one row for each run with its metrics."""
    metrics = H.run_metrics(H.source_health(tables.ingest_batches(spark, sf_dir)))
    folder = write_snapshot(tables.posts(spark, sf_dir), metrics, new_folder(spark, "snapshot"))
    summary = spark.read.json(f"{folder}/summary")
    fields = ("source_name", "run_id", "total_collected", "total_duplicates", "total_batches", "empty_run", "degraded")
    return summary.select("tweet_count", *(f"metrics.{name}" for name in fields))


# Streams


def _post_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The posts as a stream of events joined with the documents they stand for."""
    reader = spark.readStream.schema(tables.SCHEMAS["events"])
    events = reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    documents = spread(tables.table(spark, sf_dir, "documents"), "doc_id")
    return tables.with_entities(spark.sql(tables.POSTS, documents=documents, events=events))


def _streamed(frame: DataFrame) -> DataFrame:
    """Run a stream over all there is and read its output."""
    spark = frame.sparkSession
    root = new_folder(spark, "stream")
    feed.write_stream(frame, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out")


@_register
def stream_signal_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly buckets of the posts as a stream: those the watermark has closed."""
    cleaned = clean_posts(_post_stream(spark, sf_dir))
    scored = add_signals(cleaned, tables.AS_OF).withWatermark("timestamp", STREAM_DELAY)
    return _shown_buckets(_streamed(feed.bucket_stream(scored)))


@_register
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys of the posts that pass the stream's dedupe."""
    cleaned = clean_posts(_post_stream(spark, sf_dir), carry=("event_ts",))
    timed = cleaned.withColumn("event_time", F.col("event_ts").cast("timestamp"))
    deduped = feed.dedupe_stream(timed, "60 days", "event_time", salts=4)
    return _streamed(D.with_cleaned_key(deduped).select("dedupe_key"))


@_register
def stream_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TF-IDF of all posts in a stream, with the vocabulary of the deduplicated batch."""
    terms = T.fit_terms(_deduped(spark, sf_dir))
    cleaned = clean_posts(_post_stream(spark, sf_dir), carry=("ingest_seq",))
    total = sum((F.col(f"tfidf_{t.term}") for t in terms), F.lit(0.0))
    scored = feed.score_stream(cleaned, terms)
    return _streamed(scored.select("ingest_seq", "engagement_score", total.alias("tfidf_total"))).select(
        "ingest_seq", _round("engagement_score"), _round("tfidf_total")
    )


@_register
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Health rows of a stream that drops every post seen before."""
    root = new_folder(spark, "ingest")
    posts = _post_stream(spark, sf_dir)
    feed.ingest_with_health(posts, f"{root}/tables", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/tables/ingest_batches").select(
        "source_name", "run_id", "batch_seq", "new_records", "duplicates"
    )


def _arriving(frame: DataFrame, folder: str, start: Callable[[], None]) -> None:
    """Bring a third of the rows at a time, each by a stream that starts again from its checkpoint."""
    for part in range(3):
        rows = frame.where(F.col("ingest_seq") % 3 == part)
        if "line" in frame.columns:
            rows.select("line").write.mode("append").text(folder)
        else:
            rows.write.mode("append").parquet(folder)
        start()


@_register
def stream_ingest_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Health rows of three micro-batches with a restart before each."""
    root, posts = new_folder(spark, "ingest"), tables.posts(spark, sf_dir)

    def start() -> None:
        stream = spark.readStream.schema(posts.schema).parquet(f"{root}/in")
        feed.ingest_with_health(stream, f"{root}/tables", f"{root}/checkpoint").awaitTermination()

    _arriving(posts, f"{root}/in", start)
    return spark.read.parquet(f"{root}/tables/ingest_batches").select(
        "source_name", "run_id", "batch_seq", "new_records", "duplicates"
    )


@_register
def stream_dedupe_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts that three micro-batches brought first, by the key history, and the batch."""
    root, posts = new_folder(spark, "ingest"), tables.posts(spark, sf_dir)

    def start() -> None:
        stream = spark.readStream.schema(posts.schema).parquet(f"{root}/in")
        feed.ingest_with_health(stream, f"{root}/tables", f"{root}/checkpoint").awaitTermination()

    _arriving(posts, f"{root}/in", start)
    return spark.read.parquet(f"{root}/tables/posts").select("ingest_seq", "dedupe_key", F.col("batch_id").cast("bigint"))


def _ingested_lines(spark: SparkSession, sf_dir: str) -> str:
    """Tables of ``ingest_lines`` over three micro-batches of JSON lines; posts that others may equal in one batch are left out."""
    root = new_folder(spark, "lines")
    lines = _json_lines(spark, sf_dir).where(~(F.col("ingest_seq") % 10).isin(3, 4))

    def start() -> None:
        stream = feed.read_lines(spark, f"{root}/in")
        feed.ingest_lines(stream, f"{root}/tables", f"{root}/checkpoint", LATE_DELAY, "1h", tables.AS_OF).awaitTermination()

    _arriving(lines, f"{root}/in", start)
    return f"{root}/tables"


@_register
def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the lines of each micro-batch went: rejects, duplicates, late posts, posts."""
    root = _ingested_lines(spark, sf_dir)

    def counted(name: str, rows: Column) -> DataFrame:
        table = spark.read.parquet(f"{root}/{name}").groupBy(F.col("batch_id").cast("bigint").alias("batch_id"))
        return table.agg(rows.alias("n")).select("batch_id", F.lit("duplicates" if name == "ingest_batches" else name).alias("kind"), "n")

    ones = F.count(F.lit(1))
    parts = [counted(name, ones) for name in ("rejects", "late", "posts")] + [counted("ingest_batches", F.sum("duplicates"))]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])


@_register
def stream_live_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buckets after three micro-batches, late posts among them."""
    return _shown_buckets(feed.live_buckets(spark, _ingested_lines(spark, sf_dir)))


# Source health


@_register
def source_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    health = H.source_health(tables.ingest_batches(spark, sf_dir), segment_width=100)
    return health.select(
        "source_name",
        "run_id",
        "batch_seq",
        _ntz("batch_at"),
        "total_batches",
        "total_collected",
        "total_duplicates",
        "empty_run",
        _round("records_per_minute"),
        _round("new_per_batch"),
        _round("duplicate_ratio"),
        "degraded",
    )


@_register
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = H.run_metrics(H.source_health(tables.ingest_batches(spark, sf_dir)))
    rounded = {name: _round(name) for name in ("records_per_minute", "new_per_batch", "duplicate_ratio")}
    return metrics.select(*(rounded.get(name, F.col(name)) for name in metrics.columns))
