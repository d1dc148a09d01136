"""The batch run: read, clean, dedupe, score, aggregate, write."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postsignal.functions.signals import HALF_LIFE_HOURS, NEGATIVE_TERMS, POSITIVE_TERMS
from postsignal.operators.buckets import aggregate_signals, parse_every, signal_series
from postsignal.operators.clean import clean_posts
from postsignal.operators.dedupe import dedupe_posts
from postsignal.operators.features import add_features, add_signals
from postsignal.operators.tfidf import DEFAULT_TERMS, Term, fit_terms
from postsignal.schema import FALLBACK_STATUSES, ParameterError
from postsignal.sinks.ledger import Attempt
from postsignal.sources.jsonl import QUARANTINE, STRICT, SourceRead, choose_source, read_posts, runs_frame


@dataclass(frozen=True)
class RunOptions:
    """Parameters of a run. ``as_of`` fixes the age of posts; by default it is the start of the run.

    ``lexicons``: positive and negative words. ``keep_marks`` keeps combining marks, such as Indic vowel signs, in
    cleaned texts. ``mode`` says what a bad line does when files are read.
    """

    every: str = "1h"
    top_k_terms: int = DEFAULT_TERMS
    as_of: datetime | None = None
    by_date: bool = False
    half_life_hours: float = HALF_LIFE_HOURS
    lexicons: tuple[tuple[str, ...], tuple[str, ...]] = (POSITIVE_TERMS, NEGATIVE_TERMS)
    keep_marks: bool = False
    mode: str = STRICT

    def __post_init__(self) -> None:
        parse_every(self.every)
        if not self.half_life_hours > 0:
            raise ParameterError("half_life_hours must be positive")
        if self.mode not in (STRICT, QUARANTINE):
            raise ParameterError(f"unknown mode: {self.mode!r}")

    def cleaned(self, posts: DataFrame, carry: tuple[str, ...]) -> DataFrame:
        return clean_posts(posts, carry, self.keep_marks)

    def featured(self, posts: DataFrame, terms: list[Term], as_of: datetime) -> DataFrame:
        return add_features(posts, terms, as_of, self.half_life_hours, self.lexicons)


@dataclass(frozen=True)
class RunResult:
    """Written folders, the vocabulary, and how many rows each stage had."""

    paths: dict[str, str]
    terms: list[Term]
    counts: dict[str, int]
    status: str
    source_name: str
    elapsed_seconds: float


def post_signals(posts: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Raw posts to deduplicated posts with signals, as one lazy plan.

    Signals depend on their own row alone, so they are computed ahead of the dedupe: a reader that
    wants no text, such as the bucket aggregate, then has no text in the shuffle.
    """
    return dedupe_posts(add_signals(clean_posts(posts, carry=("ingest_seq",)), as_of))


def signal_buckets(posts: DataFrame, every: str = "1h", as_of: datetime | None = None) -> DataFrame:
    """Raw posts to time buckets, as one lazy plan."""
    return aggregate_signals(post_signals(posts, as_of), every)


def run_signals(
    spark: SparkSession,
    primary: SourceRead,
    fallback: SourceRead | None,
    output_dir: str,
    options: RunOptions = RunOptions(),
) -> RunResult:
    """Run everything, write post features, buckets and the chart series, and publish them.

    The deduplicated posts are written once as a table of the attempt: the vocabulary fit and the scoring
    both need them, and a lost executor then costs a re-read and not a new dedupe. The buckets are
    computed from the written features, where only five columns are read. Counts come from the written
    tables. A run without posts is published too, with its status.
    """
    started = datetime.now(timezone.utc)
    as_of = options.as_of or started
    source = primary if fallback is None else choose_source(primary, fallback)
    reads = [primary] if fallback is None else [primary, fallback]
    attempt = Attempt(spark, output_dir)
    attempt.write("runs", runs_frame(spark, reads))

    posts = attempt.write("posts_clean", dedupe_posts(options.cleaned(source.posts, ("ingest_seq",))))
    terms = fit_terms(posts, options.top_k_terms)
    features = attempt.write("tweets_features", options.featured(posts, terms, as_of), options.by_date)
    buckets = attempt.write("signals_aggregated", aggregate_signals(features, options.every))
    attempt.write("composite_signal", signal_series(buckets))

    undated = features.where(F.col("timestamp").isNull()).count()
    counts = attempt.publish(attempt.table("runs"), {"undated": undated, "cleaned": source.run["n_records"]})
    names = {"posts_clean": "deduped", "tweets_features": "features", "signals_aggregated": "buckets"}
    counts = {names.get(name, name): n for name, n in counts.items() if name not in ("runs", "composite_signal")}
    shown = {"tweets": "tweets_features", "aggregated": "signals_aggregated", "series": "composite_signal"}
    paths = {name: attempt.tables[table] for name, table in shown.items()}
    elapsed = (datetime.now(timezone.utc) - started).total_seconds()
    return RunResult(paths, terms, counts, source.status, source.run["source_name"], elapsed)


def run_from_files(
    spark: SparkSession,
    primary_path: str,
    fallback_path: str | None,
    output_dir: str,
    limit: int | None = None,
    options: RunOptions = RunOptions(),
) -> RunResult:
    """``run_signals`` over JSON lines; the fallback is only read when the primary is degraded."""
    primary = read_posts(spark, primary_path, options.mode, limit, "primary_jsonl")
    fallback = None
    if fallback_path is not None and primary.status in FALLBACK_STATUSES:
        fallback = read_posts(spark, fallback_path, options.mode, limit)
    return run_signals(spark, primary, fallback, output_dir, options)
