"""Source health over a table of collection batches.

A batch row has ``source_name, run_id, batch_seq, batch_at, new_records, duplicates``; ``batch_seq``
is an integer that orders the batches of a run, without repeats.

Every value "as of a batch" is a running sum or maximum over its run. One window per run would put a
long run into one task, so a run is cut into segments of ``segment_width`` sequence numbers: windows
run inside segments, a second window adds up one summary row per segment, and a join on the segment
brings both together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postsignal.schema import SourceThresholds

RUN = ("source_name", "run_id")
SEGMENT_WIDTH = 10_000

_BEFORE = (Window.unboundedPreceding, -1)
_UP_TO = (Window.unboundedPreceding, Window.currentRow)


def duplicate_ratio(new: Column, duplicates: Column) -> Column:
    """Share of duplicates among all rows seen; 0 when nothing was seen."""
    return F.coalesce(F.try_divide(duplicates, new + duplicates), F.lit(0.0))


def records_per_minute(new: Column, elapsed_seconds: Column) -> Column:
    return new / (F.greatest(elapsed_seconds, F.lit(1.0)) / F.lit(60.0))


def is_degraded(thresholds: SourceThresholds) -> Column:
    """Too many empty batches in a row, too many duplicates, or too slow once warmed up."""
    return (
        (F.col("empty_run") >= thresholds.max_empty_run)
        | (
            (F.col("duplicate_ratio") > thresholds.max_duplicate_ratio)
            & (F.col("total_duplicates") > 0)
        )
        | (
            (F.col("total_batches") >= thresholds.rolling_batches)
            & (F.col("records_per_minute") < thresholds.min_records_per_minute)
        )
    )


def _running_totals(batches: DataFrame, width: int, runs: DataFrame | None) -> DataFrame:
    """Add total_batches, total_collected, total_duplicates, empty_run, run start and run length."""
    rows = batches.withColumn("_segment", F.floor(F.col("batch_seq") / F.lit(width)).cast("bigint"))
    inside = Window.partitionBy(*RUN, "_segment").orderBy("batch_seq").rowsBetween(*_UP_TO)
    # Place of the last batch with new records, counted inside the segment.
    rows = rows.withColumn("_n", F.count(F.lit(1)).over(inside)).withColumns(
        {
            "_new": F.sum("new_records").over(inside),
            "_dup": F.sum("duplicates").over(inside),
            "_last": F.max(F.when(F.col("new_records") > 0, F.col("_n"))).over(inside),
        }
    )
    # The last row of a segment holds its totals.
    segments = rows.groupBy(*RUN, "_segment").agg(
        F.max("_n").alias("_n"),
        F.max("_new").alias("_new"),
        F.max("_dup").alias("_dup"),
        F.max("_last").alias("_last"),
        F.min("batch_at").alias("_start"),
    )
    across = Window.partitionBy(*RUN).orderBy("_segment")
    whole = Window.partitionBy(*RUN)

    def before(name: str) -> Column:
        return F.coalesce(F.sum(name).over(across.rowsBetween(*_BEFORE)), F.lit(0).cast("bigint"))

    segments = segments.select(
        *RUN,
        "_segment",
        "_last",
        before("_n").alias("_n_before"),
        before("_new").alias("_new_before"),
        before("_dup").alias("_dup_before"),
        F.sum("_n").over(whole).alias("run_batches"),
        F.min("_start").over(whole).alias("run_started_at"),
    )
    last_before = F.max(F.col("_last") + F.col("_n_before")).over(across.rowsBetween(*_BEFORE))
    segments = segments.withColumn("_last_before", last_before).drop("_last")
    if runs is not None:  # one row per segment meets its run, not every batch
        starts = runs.select(*RUN, F.col("started_at").alias("_started_at"))
        started = F.coalesce("_started_at", "run_started_at")
        segments = segments.join(starts, [*RUN], "left").withColumn("run_started_at", started).drop("_started_at")
    joined = rows.join(segments, [*RUN, "_segment"])
    total = F.col("_n_before") + F.col("_n")
    last = F.coalesce(F.col("_last") + F.col("_n_before"), F.col("_last_before"), F.lit(0))
    return joined.select(
        *batches.columns,
        "run_batches",
        "run_started_at",
        total.alias("total_batches"),
        (F.col("_new_before") + F.col("_new")).alias("total_collected"),
        (F.col("_dup_before") + F.col("_dup")).alias("total_duplicates"),
        (total - last).alias("empty_run"),
    )


def _rolling_mean(rows: DataFrame, batches: int, width: int) -> DataFrame:
    """Mean of new_records over the last ``batches`` batches, by windows over short segments.

    ``total_batches`` numbers a run without gaps. The last rows of a segment are also given to the
    next one, where they only serve as history.
    """
    width = max(width, batches)
    place = F.col("total_batches") - 1
    own = F.floor(place / F.lit(width)).cast("bigint")
    is_tail = place % width >= width - (batches - 1)
    homes = F.when(is_tail, F.array(own, own + 1)).otherwise(F.array(own))
    spread = rows.withColumns({"_own": own, "_home": homes}).withColumn("_home", F.explode("_home"))
    window = Window.partitionBy(*RUN, "_home").orderBy("total_batches").rowsBetween(1 - batches, 0)
    mean = F.avg("new_records").over(window)
    return (
        spread.withColumn("new_per_batch", mean).where(F.col("_home") == F.col("_own")).drop("_own", "_home")
    )


def source_health(
    batches: DataFrame,
    thresholds: SourceThresholds = SourceThresholds(),
    segment_width: int = SEGMENT_WIDTH,
    runs: DataFrame | None = None,
) -> DataFrame:
    """Every batch with the run's metrics as of it and whether the source counts as degraded.

    The rate counts from the run's ``started_at`` in ``runs``; without it, from the first batch.
    """
    rows = _running_totals(batches, segment_width, runs)
    rows = _rolling_mean(rows, thresholds.rolling_batches, segment_width)
    elapsed = (F.unix_micros("batch_at") - F.unix_micros("run_started_at")) / F.lit(1_000_000.0)
    measured = rows.withColumns(
        {
            "records_per_minute": records_per_minute(F.col("total_collected"), elapsed),
            "duplicate_ratio": duplicate_ratio(F.col("total_collected"), F.col("total_duplicates")),
        }
    )
    return measured.withColumn("degraded", is_degraded(thresholds))


def run_metrics(health: DataFrame) -> DataFrame:
    """The metrics record of each run: its state as of the last batch."""
    return health.where(F.col("total_batches") == F.col("run_batches")).select(
        *RUN,
        "total_collected",
        "total_duplicates",
        "total_batches",
        "empty_run",
        "records_per_minute",
        "new_per_batch",
        "duplicate_ratio",
        "degraded",
    )
