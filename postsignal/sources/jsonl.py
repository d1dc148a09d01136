"""Posts from JSON lines: closed schema, required keys, and one status row per run."""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import Row

from postsignal.functions.text import WHITESPACE
from postsignal.operators.order import numbered_lines
from postsignal.operators.rows import first_posts
from postsignal.schema import (
    COUNT_FIELDS,
    FAILED,
    FALLBACK_STATUSES,
    POST_FIELDS,
    POST_SCHEMA,
    REQUIRED_FIELDS,
    SOURCE_RUN_SCHEMA,
)
from postsignal.sinks.tables import stage
from postsignal.sources.runs import classify_file_run, with_envelope

STRICT = "strict"
QUARANTINE = "quarantine"
DEFAULT_SOURCE_NAME = "sample_jsonl"

NOT_AN_OBJECT = "not a JSON object"
MISSING_KEY = "missing required key"
BAD_COUNT = "count is not a non-negative whole number"


@dataclass(frozen=True)
class SourceRead:
    """Posts of one run with their envelope, the lines left out, and the run's status row."""

    posts: DataFrame
    rejects: DataFrame
    run: Row

    @property
    def status(self) -> str:
        return self.run["status"]


def _text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank lines with their place: file, block of the file, line inside the block.

    The place sorts as (file name, line number) however Spark groups blocks into tasks. Blank lines go before
    lines are counted, so a block's lines have consecutive numbers.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line")
    )
    lines = lines.where(F.col("line").rlike(f"[^{WHITESPACE}]"))
    place = F.struct("file", "block", F.monotonically_increasing_id().alias("line"))
    return lines.select(place.alias("place"), "line")


@contextmanager
def _repeated_keys(spark: SparkSession):
    """Within it, frames are built whose JSON parser takes the last of repeated keys."""
    name = "spark.sql.variant.allowDuplicateKeys"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


# Everything up to a number that JSON has no name for, strings taken whole, so that none is found inside one.
_UNNAMED = r'\G((?:[^"NI-]++|"(?:[^"\\]++|\\.)*+"|-(?!Infinity))*+)(NaN|-?Infinity)'


def _document(line: Column) -> Column:
    """The line's value inside an array. NaN and infinities, which JSON does not know, become texts of that name."""
    wrapped = F.concat(F.lit("["), line, F.lit("]"))
    named = F.regexp_replace(wrapped, _UNNAMED, '$1"$2"')
    return F.when(line.contains("NaN") | line.contains("Infinity"), F.try_parse_json(named)).otherwise(F.try_parse_json(wrapped))


def _field(document: Column, name: str) -> Column:
    kind = POST_SCHEMA[name].dataType.simpleString()
    return F.try_variant_get(document, f"$[0].{name}", kind)


def _reject_reason(line: Column, document: Column, check_counts: bool) -> Column:
    starts_object = line.rlike(r"^[ \t\r\n]*\{")
    is_single = document.isNotNull() & F.variant_get(document, "$[1]", "variant").isNull()
    # An absent key reads as NULL, a null value as the variant null.
    absent = [
        F.when(F.variant_get(document, f"$[0].{name}", "variant").isNull(), F.lit(name))
        for name in REQUIRED_FIELDS
    ]
    missing = F.concat_ws(", ", *absent)
    reason = F.when(~(starts_object & is_single), NOT_AN_OBJECT).when(
        missing != "", F.concat(F.lit(MISSING_KEY + ": "), missing)
    )
    if check_counts:
        for name in COUNT_FIELDS:
            value = _field(document, name)
            bad = value.isNotNull() & ~F.coalesce(value.try_cast("bigint") >= 0, F.lit(False))
            reason = reason.when(bad, f"{BAD_COUNT}: {name}")
    return reason


def parse_lines(lines: DataFrame, check_counts: bool = False, column: str = "line") -> DataFrame:
    """Add ``post`` (closed schema, other keys dropped) and ``reason`` (null for a good line).

    A line is parsed inside an array, because the parser stops at the end of a value: anything after
    the object then shows as an error or as a second element. Of a repeated key the last value counts; a count
    of NaN or infinity is one that cannot be read. The lambda binds the parsed value, and ``inline`` keeps filters on ``reason`` above it, so that
    each line is parsed exactly once.
    """
    line = F.col(column)

    def read(document: Column) -> Column:
        fields = (_field(document, name).alias(name) for name in POST_FIELDS)
        reason = _reject_reason(line, document, check_counts)
        return F.struct(F.struct(*fields).alias("post"), reason.alias("reason"))

    with _repeated_keys(lines.sparkSession):
        return lines.select("*", F.inline(F.transform(F.array(_document(line)), read)))


def post_columns(parsed: DataFrame, *carry: str) -> DataFrame:
    """Good lines as post columns, absent tag and mention lists as empty lists."""
    empty = F.array().cast(T.ArrayType(T.StringType()))
    fields = [
        F.coalesce(F.col(f"post.{name}"), empty).alias(name)
        if name in ("hashtags", "mentions")
        else F.col(f"post.{name}").alias(name)
        for name in POST_FIELDS
    ]
    return parsed.where(F.col("reason").isNull()).select(*carry, *fields)


def reject_columns(parsed: DataFrame, *carry: str, column: str = "line") -> DataFrame:
    return parsed.where(F.col("reason").isNotNull()).select(*carry, F.col(column).alias("line"), "reason")


def read_posts(
    spark: SparkSession,
    path: str,
    mode: str = STRICT,
    limit: int | None = None,
    source_name: str = DEFAULT_SOURCE_NAME,
    run_id: str = "run-0",
) -> SourceRead:
    """Read a JSON lines file or folder as one run; never raises for bad input.

    ``strict``: one bad line fails the run, which then has no posts. ``quarantine``: bad lines go to
    ``rejects`` and the rest is used. The text is scanned and parsed once, into a table in the shared folder
    that keeps each line's values and verdict: status, posts and rejects all come from it. ``ingest_seq`` counts
    the non-blank lines of all files from 0, by file name and line.
    """
    if mode not in (STRICT, QUARANTINE):
        raise ValueError(f"unknown mode: {mode!r}")
    if limit is not None and limit < 0:
        raise ValueError("limit must not be negative")
    started_at = datetime.now(timezone.utc)
    error: str | None = None
    n_good = n_records = 0
    nothing = spark.createDataFrame([], T.StructType([T.StructField("line", T.StringType())]))
    parsed = parse_lines(nothing.withColumn("ingest_seq", F.lit(0).cast("bigint")))
    try:
        lines = stage(parse_lines(_text_lines(spark, path), check_counts=mode == QUARANTINE), "lines")
        bad = F.col("reason").isNotNull()
        counts = lines.agg(
            F.count_if(~bad).alias("good"), F.count_if(bad).alias("bad"), F.min(F.when(bad, F.struct("place", "reason"))).alias("first")
        ).first()
        if mode == STRICT and counts["bad"]:
            error = f"invalid post in {counts['first']['place']['file']}: {counts['first']['reason']}"
        else:
            n_good = counts["good"]
            n_records = n_good if limit is None else min(n_good, limit)
        parsed = numbered_lines(lines, "place", "ingest_seq")
    except Exception as failure:  # a source that cannot be read is a status, not a crash
        error = str(failure)
    status, message = classify_file_run(n_records, error, path)
    ended_at = datetime.now(timezone.utc)
    posts = post_columns(parsed, "ingest_seq")
    if status == FAILED:
        posts = posts.limit(0)
    elif limit is not None and limit < n_good:
        posts = first_posts(posts, limit)
    enveloped = with_envelope(posts, source_name, status, started_at, ended_at)
    run = Row(*SOURCE_RUN_SCHEMA.fieldNames())(
        source_name, run_id, status, started_at, ended_at, n_records, message
    )
    return SourceRead(enveloped, reject_columns(parsed, "ingest_seq"), run)


def choose_source(primary: SourceRead, fallback: SourceRead) -> SourceRead:
    """The primary run unless its status asks for the fallback; then that one, whatever its status."""
    return fallback if primary.status in FALLBACK_STATUSES else primary


def runs_frame(spark: SparkSession, reads: list[SourceRead]) -> DataFrame:
    """The status rows of several runs as a table."""
    return spark.createDataFrame([read.run for read in reads], SOURCE_RUN_SCHEMA)
