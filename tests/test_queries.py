"""Every registered query against its DuckDB statement on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_points
from compare import connect, differences
from postsignal.plans import oracles
from postsignal.plans import queries as registry

DATA = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = connect(DATA)
    yield connection
    connection.close()


def test_every_query_has_a_statement():
    assert set(oracles.oracle_sql()) == set(registry.queries())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_duckdb(spark, duck, name):
    ours = entry_points.queries()[name](spark, DATA).toPandas()
    theirs = duck.execute(entry_points.oracle_sql()[name]).df()
    assert len(ours) > 0
    assert differences(ours, theirs) == []


def test_entry(spark):
    frame = entry_points.entry(spark)
    assert frame.columns[:2] == ["timestamp", "tweet_count"] and frame.count() > 0
