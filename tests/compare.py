"""Run a registered query and its DuckDB statement and compare them as sorted rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value: object) -> object:
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, (pd.Timestamp,)):
        return value.to_pydatetime().isoformat()
    if hasattr(value, "item"):
        return value.item()
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    plain = [tuple(_plain(v) for v in row) for row in frame.itertuples(index=False, name=None)]
    return sorted(plain, key=repr)


def differences(spark_frame: pd.DataFrame, duck_frame: pd.DataFrame) -> list[str]:
    if sorted(spark_frame.columns) != sorted(duck_frame.columns):
        return [f"columns {sorted(spark_frame.columns)} / {sorted(duck_frame.columns)}"]
    ours, theirs = rows(spark_frame), rows(duck_frame)
    if len(ours) != len(theirs):
        return [f"{len(ours)} rows / {len(theirs)} rows"]
    return [f"{a!r:.600} / {b!r:.600}" for a, b in zip(ours, theirs) if a != b][:3]
