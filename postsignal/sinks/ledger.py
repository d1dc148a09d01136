"""The ledger of runs: what an attempt wrote becomes visible by one row, and by nothing else.

An attempt writes all its tables into a folder of its own. When they are there, their rows are counted from the
written files, and one row goes into the ledger: the tables, their counts, and how many source runs ended with
which status. Spark commits that row as one file, so readers see the whole attempt or none of it. An
attempt that fails leaves files that no row names; a repeated one has another folder.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsignal.schema import STATUSES
from postsignal.sinks.tables import post_documents, write_dated, write_table

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("attempt", T.StringType()),
        T.StructField("published_at", T.TimestampType()),
        T.StructField("tables", T.MapType(T.StringType(), T.StringType())),
        T.StructField("counts", T.MapType(T.StringType(), T.LongType())),
        T.StructField("statuses", T.MapType(T.StringType(), T.LongType())),
    ]
)


@dataclass
class Attempt:
    """One attempt to write the outputs of a run below ``root``."""

    spark: SparkSession
    root: str
    name: str = field(default_factory=lambda: uuid.uuid4().hex)
    tables: dict[str, str] = field(default_factory=dict)

    @property
    def folder(self) -> str:
        return f"{self.root.rstrip('/')}/attempts/{self.name}"

    def write(self, name: str, frame: DataFrame, by_date: bool = False) -> DataFrame:
        """Write a Parquet table of the attempt and read it back."""
        path = f"{self.folder}/{name}"
        self.tables[name] = write_dated(frame, path) if by_date else write_table(frame, path)
        return self.table(name)

    def snapshot(self, posts: DataFrame, runs: DataFrame, *carry: str) -> None:
        """The collected posts as JSON documents beside the rows of their runs, degraded ones too."""
        self.write("snapshot_posts", post_documents(posts, *carry))
        self.write("snapshot_runs", runs)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.tables[name])

    def publish(self, runs: DataFrame | None = None, extra: dict[str, int] | None = None) -> dict[str, int]:
        """Count the written tables and add the attempt's row to the ledger; ``runs`` have a ``status``."""
        counts = {name: self.table(name).count() for name in self.tables} | (extra or {})
        statuses = {} if runs is None else {r.status: r.n for r in runs.groupBy("status").agg(F.count("*").alias("n")).collect() if r.status in STATUSES}
        row = (self.name, datetime.now(timezone.utc), self.tables, counts, statuses)
        self.spark.createDataFrame([row], LEDGER_SCHEMA).coalesce(1).write.mode("append").parquet(ledger_path(self.root))
        return counts


def ledger_path(root: str) -> str:
    return f"{root.rstrip('/')}/ledger"


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """All published attempts below ``root``."""
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path(root))


def latest(spark: SparkSession, root: str) -> Attempt | None:
    """The attempt that was published last; of several at once, the one with the largest name."""
    row = ledger(spark, root).orderBy(F.desc("published_at"), F.desc("attempt")).first()
    return None if row is None else Attempt(spark, root, row.attempt, dict(row.tables))
