"""The live run: captured batches of many source runs to published outputs.

Every run is cut at its first stop, classified by what it had collected by then, replaced by its fallback where its
status asks for that, and goes through cleaning, dedupe, scoring and aggregation with all others. Outputs, status rows,
counters and the snapshot are published together.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsignal.operators.buckets import aggregate_signals, signal_series
from postsignal.operators.dedupe import count_new_per_batch, dedupe_posts
from postsignal.operators.health import RUN
from postsignal.operators.run_cut import RunCut, StopRules, cut_posts, cut_runs
from postsignal.operators.tfidf import Term, fit_terms
from postsignal.plans.signal_run import RunOptions
from postsignal.sinks.ledger import Attempt
from postsignal.sources.runs import select_source, with_run_envelopes

KEYS = list(RUN)
#: Columns of the snapshot's run rows.
RUN_COLUMNS = (
    *KEYS, "status", "started_at", "ended_at", "n_records", "error_message", "stop_reason",
    "total_batches", "total_duplicates", "duplicate_ratio", "records_per_minute",
)


@dataclass(frozen=True)
class LiveRun:
    """The published attempt, the status rows of its runs, the vocabulary and the rows of each table."""

    attempt: Attempt
    runs: DataFrame
    terms: list[Term]
    counts: dict[str, int]


def captured_batches(captures: DataFrame, posts: DataFrame) -> DataFrame:
    """``captures`` (``RUN, batch_seq, batch_at`` and, where known, ``login_wall``) with the new and repeated posts of each."""
    counts = count_new_per_batch(posts, "batch_seq", "ingest_seq", RUN)
    zero = F.lit(0).cast("bigint")
    filled = {name: F.coalesce(name, zero) for name in ("new_records", "duplicates")}
    return captures.join(counts, [*KEYS, "batch_seq"], "left").withColumns(filled)


def collected(captures: DataFrame, posts: DataFrame, runs: DataFrame, rules: StopRules = StopRules()) -> tuple[DataFrame, RunCut]:
    """The posts that every run had collected when it ended, and the cut."""
    cut = cut_runs(captured_batches(captures, posts), runs, rules)
    return cut_posts(posts, cut), cut


def live_run(
    captures: DataFrame,
    posts: DataFrame,
    runs: DataFrame,
    fallback: DataFrame | None,
    output_dir: str,
    rules: StopRules = StopRules(),
    options: RunOptions = RunOptions(),
) -> LiveRun:
    """Run everything and publish it.

    ``posts`` and ``fallback``: raw posts with ``RUN`` and ``ingest_seq``; ``posts`` with ``batch_seq`` too. ``runs`` as
    for ``cut_runs``. A run that ends degraded is published with its status, as one that does not.
    """
    spark = posts.sparkSession
    as_of = options.as_of or datetime.now(timezone.utc)
    attempt = Attempt(spark, output_dir)
    taken, cut = collected(captures, posts, runs, rules)
    attempt.snapshot(taken, cut.runs.select(*RUN_COLUMNS), *KEYS, "ingest_seq")
    status = attempt.table("snapshot_runs")
    chosen = taken if fallback is None else select_source(taken.select(*fallback.columns), fallback, status)
    cleaned = options.cleaned(with_run_envelopes(chosen, status), ("ingest_seq", "run_id"))
    deduped = attempt.write("posts_clean", dedupe_posts(cleaned))
    terms = fit_terms(deduped, options.top_k_terms)
    features = attempt.write("tweets_features", options.featured(deduped, terms, as_of), options.by_date)
    buckets = attempt.write("signals_aggregated", aggregate_signals(features, options.every))
    attempt.write("composite_signal", signal_series(buckets))
    undated = features.where(F.col("timestamp").isNull()).count()
    return LiveRun(attempt, status, terms, attempt.publish(status, {"undated": undated}))
