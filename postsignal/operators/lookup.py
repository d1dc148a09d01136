"""Joins of posts with per-run tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def join_runs(posts: DataFrame, runs: DataFrame, on: list[str], how: str) -> DataFrame:
    """Join posts with a table of runs that is unique on ``on``.

    Nothing is counted beforehand: adaptive execution broadcasts a run table that turns out small and
    splits the partition of a huge run.
    """
    return posts.join(runs, on, how)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
