"""Run status, run envelopes and the choice between a primary and a fallback source."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsignal import schema as S
from postsignal.operators.lookup import join_runs

# Messages a run gets when it ends without one of its own.
ALREADY_DEGRADED = "throttling metrics were already above threshold"
NO_RECORDS = "source returned no records before stop condition"
TOO_FEW_RECORDS = "collection ended before desired record count"
LOGIN_WALL = "login wall detected"
RETRIES_EXHAUSTED = "possible throttling persisted after retries were exhausted"

RUN_KEYS = ["source_name", "run_id"]


def _error_status() -> Column:
    kind = F.col("error_kind")
    return (
        F.when(kind == "rate_limited", S.THROTTLED)
        .when(kind == "login_wall", S.LOGIN_REQUIRED)
        .when(kind.isNotNull(), S.FAILED)
    )


def classify_live_runs(runs: DataFrame) -> DataFrame:
    """Final status of live runs from their raw status, record count, limit and error.

    Reads ``raw_status, error_kind, error_message, n_records, row_limit, degraded_before_start``. A
    run that started degraded has no records; every other run keeps what it collected.
    """
    raw, n, limit = F.col("raw_status"), F.col("n_records"), F.col("row_limit")
    started_degraded = F.coalesce("degraded_before_start", F.lit(False))
    failed = F.col("error_kind").isNotNull()
    empty = (n == 0) & raw.isin(S.SUCCESS, S.PARTIAL)
    short = (raw == S.SUCCESS) & (n < limit)
    status = (
        F.when(started_degraded, S.THROTTLED)
        .when(failed, _error_status())
        .when(empty, S.THROTTLED)
        .when(short, S.PARTIAL)
        .otherwise(raw)
    )
    message = F.col("error_message")
    error = (
        F.when(started_degraded, ALREADY_DEGRADED)
        .when(failed, message)
        .when(empty, F.coalesce(message, F.lit(NO_RECORDS)))
        .when(short, F.coalesce(message, F.lit(TOO_FEW_RECORDS)))
        .otherwise(message)
    )
    kept = F.when(started_degraded, F.lit(0).cast("bigint")).otherwise(n)
    return runs.withColumns({"status": status, "error_message": error, "n_records": kept})


def classify_file_run(n_records: int, error: str | None, path: str) -> tuple[str, str | None]:
    """Status and message of a file source: any record is success, none is failure."""
    if error is not None:
        return S.FAILED, error
    if n_records > 0:
        return S.SUCCESS, None
    return S.FAILED, f"sample file has no records: {path}"


def triggers_fallback(status: Column) -> Column:
    return status.isin(*S.FALLBACK_STATUSES)


def with_envelope(
    posts: DataFrame, source_name: str, status: str, started_at: datetime, ended_at: datetime
) -> DataFrame:
    """Attach one run's envelope to its posts."""
    if status not in S.STATUSES:
        raise ValueError(f"unknown status: {status!r}")
    return posts.withColumns(
        {
            "source_name": F.lit(source_name),
            "collector_status": F.lit(status),
            "collected_started_at": F.lit(started_at).cast("timestamp"),
            "collected_ended_at": F.lit(ended_at).cast("timestamp"),
        }
    )


def with_run_envelopes(posts: DataFrame, runs: DataFrame) -> DataFrame:
    """Attach the envelope of each post's own run, found by ``source_name`` and ``run_id``.

    A post whose run has no row, or whose key is null, stays with a null envelope.
    """
    envelopes = runs.select(
        *RUN_KEYS,
        F.col("status").alias("collector_status"),
        F.col("started_at").alias("collected_started_at"),
        F.col("ended_at").alias("collected_ended_at"),
    )
    return join_runs(posts, envelopes, RUN_KEYS, "left")


def select_source(primary: DataFrame, fallback: DataFrame, runs: DataFrame) -> DataFrame:
    """Primary posts of usable runs, and the fallback posts of the others.

    ``runs`` holds the primary runs. SUCCESS and PARTIAL keep their posts. Any other status drops
    them, even if there are some, and takes the fallback posts of the same run whatever their own
    status. Primary posts of a run without a row, or with a null key or status, are kept: nothing says
    that they should be replaced. Both inputs carry ``source_name`` and ``run_id`` of the primary run.
    """
    replaced = runs.where(triggers_fallback(F.col("status"))).select(*RUN_KEYS)
    return join_runs(primary, replaced, RUN_KEYS, "left_anti").unionByName(
        join_runs(fallback, replaced, RUN_KEYS, "left_semi")
    )
