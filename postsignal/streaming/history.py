"""Keys that a feed has seen, kept so that a batch opens only the files that may hold its keys.

Every batch adds its new keys as one small run. ``FANIN`` runs of a level are merged into one run of the next level,
which is split by one more leading hex digit of the keys: a run of level ``n`` has ``16 ** n`` folders of about a
batch's size each. A batch reads the few runs of level 0 and, of every other run, the folders of its own keys' digits.
The manifest says which runs there are; a run counts once its row is there, and no longer when another one names it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postsignal.sinks.tables import write_table

FANIN = 16
KEY = "dedupe_key"
MANIFEST = "run string, level int, feed_id string, last_batch bigint, replaces array<string>"
#: Levels are split by at most so many digits.
MOST_DIGITS = 4


@dataclass(frozen=True)
class Run:
    name: str
    level: int
    feed_id: str
    last_batch: int

    @property
    def digits(self) -> int:
        return min(self.level, MOST_DIGITS)


def _prefix(key: Column, digits: int) -> Column:
    return F.substring(key, 1, digits)


@dataclass(frozen=True)
class KeyHistory:
    """The key table of several feeds below ``root``. Keys are lower-case hex digests."""

    spark: SparkSession
    root: str
    fanin: int = FANIN

    def _folder(self, run: str) -> str:
        return f"{self.root}/runs/{run}"

    def _publish(self, run: Run, replaces: list[str]) -> None:
        row = [(run.name, run.level, run.feed_id, run.last_batch, replaces)]
        self.spark.createDataFrame(row, MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.root}/manifest")

    def runs(self) -> list[Run]:
        """The runs that count; one row per batch and merge is read."""
        try:
            rows = self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest").collect()
        except AnalysisException:  # no batch has been here
            return []
        gone = {name for row in rows for name in row.replaces}
        return sorted({Run(r.run, r.level, r.feed_id, r.last_batch) for r in rows if r.run not in gone}, key=lambda r: r.name)

    def add(self, keys: DataFrame, feed_id: str, batch_id: int) -> None:
        """Write a batch's new keys as a run; a repeated batch overwrites its own."""
        run = Run(f"{feed_id}_{batch_id}", 0, feed_id, batch_id)
        write_table(keys.select(KEY), self._folder(run.name))
        self._publish(run, [])

    def _read(self, run: Run, prefixes: list[str] | None) -> DataFrame:
        reader = self.spark.read
        if not run.digits:
            return reader.schema(f"{KEY} string").parquet(self._folder(run.name))
        frame = reader.schema(f"{KEY} string, prefix string").parquet(self._folder(run.name))
        if prefixes is not None:
            frame = frame.where(F.col("prefix").isin(sorted({p[: run.digits] for p in prefixes})))
        return frame.select(KEY)

    def known(self, keys: DataFrame, feed_id: str, batch_id: int) -> DataFrame:
        """The keys seen before this batch, in the files that may hold some of ``keys``."""
        others = [r for r in self.runs() if not (r.feed_id == feed_id and r.last_batch >= batch_id)]
        if not others:
            return self.spark.createDataFrame([], f"{KEY} string")
        digits = max(r.digits for r in others)
        # At most 16 ** MOST_DIGITS prefixes, however many keys.
        prefixes = [r[0] for r in keys.select(_prefix(F.col(KEY), digits)).distinct().collect()] if digits else None
        return reduce(DataFrame.unionAll, [self._read(r, prefixes) for r in others])

    def merge(self, feed_id: str, batch_id: int) -> None:
        """Merge full levels of the feed's runs of batches before ``batch_id``, which no retry can write again."""
        level = 0
        while True:
            own = [r for r in self.runs() if r.level == level and r.feed_id == feed_id and r.last_batch < batch_id]
            if not own:
                return
            if len(own) >= self.fanin:
                run = Run(f"{feed_id}_{max(r.last_batch for r in own)}_level{level + 1}", level + 1, feed_id, max(r.last_batch for r in own))
                keys = reduce(DataFrame.unionAll, [self._read(r, None) for r in own])
                split = keys.withColumn("prefix", _prefix(F.col(KEY), run.digits)).repartition("prefix").sortWithinPartitions("prefix", KEY)
                write_table(split, self._folder(run.name), ("prefix",))
                self._publish(run, [r.name for r in own])
            level += 1
