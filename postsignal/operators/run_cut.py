"""Where collection runs end: the first batch at which a stop condition holds, and what counts up to there.

A run goes through its batches in order. Ahead of a batch it ends when its time is up or the page shows a login
wall; after a batch, when it has as many posts as it wanted, or when the source is degraded once more than there are
retries. Each condition's first batch comes from an aggregation, the n-th degraded one from a rank by digits, and
health itself from summaries of segments: no window runs over a whole run.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsignal.operators.dedupe import first_per_key
from postsignal.operators.health import RUN, SEGMENT_WIDTH, duplicate_ratio, records_per_minute, source_health
from postsignal.operators.lookup import join_runs
from postsignal.operators.order import value_at_rank
from postsignal.operators.rows import with_required_values
from postsignal.schema import SUCCESS, ParameterError, SourceThresholds
from postsignal.sinks.tables import stage
from postsignal.sources.runs import LOGIN_WALL, RETRIES_EXHAUSTED, classify_live_runs

KEYS = list(RUN)
#: Why a run ended, in the order in which the conditions are looked at.
TIME_UP, LOGIN, FULL, THROTTLE, NO_MORE = "time_up", "login_wall", "full", "throttled", "no_more_batches"
_ORDER = (TIME_UP, LOGIN, FULL, THROTTLE)


@dataclass(frozen=True)
class StopRules:
    """When a run ends. Without ``timeout_seconds`` time is never up."""

    thresholds: SourceThresholds = field(default_factory=SourceThresholds)
    # Fixed value: the default number of retries.
    max_retries: int = 3
    timeout_seconds: float | None = None

    def __post_init__(self) -> None:
        if self.max_retries < 0:
            raise ParameterError("max_retries must not be negative")


def _flag(frame: DataFrame, name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False)) if name in frame.columns else F.lit(False)


def run_stops(health: DataFrame, runs: DataFrame, rules: StopRules) -> DataFrame:
    """``RUN, stop_batch, stop_reason``: the first stop of each run; runs that no condition ends have no row.

    A run that wants fewer than one post, or started degraded, ends ahead of its batches and has no row either.
    """
    limits = runs.select(*KEYS, "row_limit")
    rows = join_runs(health, limits, KEYS, "left")
    elapsed = (F.unix_micros("batch_at") - F.unix_micros("run_started_at")) / F.lit(1e6)
    late = F.lit(False) if rules.timeout_seconds is None else elapsed >= rules.timeout_seconds
    full = F.coalesce(F.col("total_collected") >= F.col("row_limit"), F.lit(False))
    why = F.when(late, 0).when(_flag(health, "login_wall"), 1).when(full, 2)
    firsts = rows.where(why.isNotNull()).groupBy(*KEYS).agg(F.min(F.struct("batch_seq", why.alias("why"))).alias("stop"))
    throttled = value_at_rank(health.where("degraded"), rules.max_retries + 1, "batch_seq", RUN)
    throttled = throttled.select(*KEYS, F.struct("batch_seq", F.lit(3).alias("why")).alias("stop"))
    stops = firsts.unionByName(throttled).groupBy(*KEYS).agg(F.min("stop").alias("stop"))
    reason = F.element_at(F.array(*map(F.lit, _ORDER)), F.col("stop.why") + 1)
    return stops.select(*KEYS, F.col("stop.batch_seq").alias("stop_batch"), reason.alias("stop_reason"))


def _counted(rows: DataFrame, stops: DataFrame, skipped: DataFrame) -> DataFrame:
    """Rows of the batches that a run went through."""
    met = join_runs(join_runs(rows, skipped, KEYS, "left_anti"), stops, KEYS, "left")
    before = F.col("stop_reason").isin(TIME_UP, LOGIN)
    through = F.col("stop_batch").isNull() | (F.col("batch_seq") < F.col("stop_batch")) | ((F.col("batch_seq") == F.col("stop_batch")) & ~before)
    return met.where(through)


def _skipped(runs: DataFrame) -> DataFrame:
    """Runs that end ahead of their first batch."""
    return runs.where(_flag(runs, "degraded_before_start") | F.coalesce(F.col("row_limit") < 1, F.lit(False))).select(*KEYS)


@dataclass(frozen=True)
class RunCut:
    """``runs``: one row per run with its status, counts and metrics at its end; ``batches``: those that count."""

    runs: DataFrame
    batches: DataFrame
    stops: DataFrame


def cut_runs(batches: DataFrame, runs: DataFrame, rules: StopRules = StopRules(), segment_width: int = SEGMENT_WIDTH) -> RunCut:
    """End every run at its first stop and classify it by what it had then.

    ``batches``: ``RUN, batch_seq, batch_at, new_records, duplicates`` and, where known, ``login_wall`` (seen ahead of
    the batch). ``runs``: ``RUN, started_at, row_limit`` (null: no limit) and, where known, ``degraded_before_start``,
    ``error_kind`` and ``error_message`` of what broke off the capture, which count if nothing ended the run earlier.
    Rates count from ``started_at`` (null: the first batch). Runs without batches keep their row; batches of runs
    without a row are left out. A batch's duplicates count whole, its new records up to the limit.
    """
    known = stage(join_runs(batches, runs.select(*KEYS), KEYS, "left_semi"), "run_batches")
    health = stage(source_health(known, rules.thresholds, segment_width, runs), "run_health")
    stops = stage(run_stops(health, runs, rules), "run_stops")
    through = _counted(health, stops, _skipped(runs))
    ends = through.groupBy(*KEYS).agg(
        F.max("batch_seq").alias("last_batch"),
        F.max("total_batches").alias("total_batches"),
        F.max("total_collected").alias("total_collected"),
        F.max("total_duplicates").alias("total_duplicates"),
        F.max("batch_at").alias("last_batch_at"),
    )
    rows = join_runs(join_runs(runs, ends, KEYS, "left"), stops, KEYS, "left")
    rows = rows.withColumn("stop_reason", F.when(F.col("row_limit") < 1, FULL).otherwise(F.col("stop_reason")))
    zero = F.lit(0).cast("bigint")
    # ``least`` and ``greatest`` pass over nulls: no limit stays none.
    collected = F.least(F.coalesce("total_collected", zero), F.when(F.col("row_limit").isNotNull(), F.greatest("row_limit", zero)))
    own_kind = F.when(F.col("stop_reason") == LOGIN, "login_wall").when(F.col("stop_reason") == THROTTLE, "rate_limited")
    own_message = F.when(F.col("stop_reason") == LOGIN, LOGIN_WALL).when(F.col("stop_reason") == THROTTLE, RETRIES_EXHAUSTED)
    going_on = F.col("stop_reason").isNull()
    given = {name: F.col(name) if name in runs.columns else F.lit(None).cast("string") for name in ("error_kind", "error_message")}
    duplicates = F.coalesce("total_duplicates", zero)
    elapsed = (F.unix_micros("last_batch_at") - F.unix_micros("started_at")) / F.lit(1e6)
    rows = rows.select(
        *KEYS,
        "started_at",
        "row_limit",
        _flag(runs, "degraded_before_start").alias("degraded_before_start"),
        F.lit(SUCCESS).alias("raw_status"),
        F.when(going_on, given["error_kind"]).otherwise(own_kind).alias("error_kind"),
        F.when(going_on, given["error_message"]).otherwise(own_message).alias("error_message"),
        collected.alias("n_records"),
        duplicates.alias("total_duplicates"),
        F.coalesce("total_batches", zero).alias("total_batches"),
        "last_batch",
        F.coalesce("last_batch_at", "started_at").alias("ended_at"),
        F.coalesce("stop_reason", F.lit(NO_MORE)).alias("stop_reason"),
        duplicate_ratio(collected, duplicates).alias("duplicate_ratio"),
        F.coalesce(records_per_minute(collected, elapsed), F.lit(0.0)).alias("records_per_minute"),
    )
    return RunCut(classify_live_runs(rows), through.select(*batches.columns), stops)


def cut_posts(posts: DataFrame, cut: RunCut, batch: str = "batch_seq", position: str = "ingest_seq") -> DataFrame:
    """The posts that each run collected: the first of each id, of the batches that count, up to the run's limit.

    ``posts``: ``RUN``, the batch and the place in it. Posts without id or content and of unknown runs are left out.
    """
    rows = join_runs(with_required_values(posts), cut.runs.select(*KEYS), KEYS, "left_semi").withColumn("batch_seq", F.col(batch))
    rows = _counted(rows, cut.stops, _skipped(cut.runs)).drop("stop_batch", "stop_reason")
    place = F.struct(F.col(batch).alias("batch"), F.col(position).alias("position"))
    firsts = first_per_key(rows.withColumns({"_place": place, "_id": F.struct(*KEYS, "tweet_id")}), "_id", "_place").drop("_id")
    firsts = stage(firsts, "run_posts")
    ranks = cut.runs.where(F.col("row_limit") >= 1).select(*KEYS, F.col("row_limit").alias("rank"))
    last = value_at_rank(firsts, ranks, "_place", RUN).withColumnRenamed("_place", "_last")
    kept = join_runs(firsts, last, KEYS, "left").where(F.col("_last").isNull() | (F.col("_place") <= F.col("_last")))
    kept = kept.drop("_last", "_place")
    return kept if batch == "batch_seq" else kept.drop("batch_seq")
