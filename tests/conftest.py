import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("postsignal-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_posts(spark):
    """Raw posts from dicts; absent fields are null, ``ingest_seq`` is the position."""
    from postsignal.schema import POST_SCHEMA
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("ingest_seq", T.LongType()), *POST_SCHEMA.fields])

    def make(*records: dict):
        rows = []
        for position, record in enumerate(records):
            values = {"hashtags": [], "mentions": [], **record}
            rows.append(
                tuple([values.get("ingest_seq", position)] + [values.get(n) for n in POST_SCHEMA.fieldNames()])
            )
        return spark.createDataFrame(rows, schema)

    return make
