"""The registered queries on the driver's smallest tables, and the pipeline stage by stage."""

from pathlib import Path

import pytest

import corpus_pipeline
from compare import connect, differences
from postsignal.llm import queries as registry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="driver tables are not here")


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_duckdb(spark, name):
    duck = connect(DATA)
    ours, theirs = registry.queries()[name](spark, DATA).toPandas(), duck.execute(registry.oracle_sql()[name]).df()
    assert len(ours) > 0 and differences(ours, theirs) == []


def test_stages_keep_columns_and_clean_rows(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.staged(stage(spark, docs, DATA), name)
        assert after.columns == docs.columns
        kept = [r.doc_id for r in after.collect()]
        assert len(set(kept)) == len(kept) and set(kept) <= rows and len(kept) > 0.7 * len(rows)
        docs, rows = after, set(kept)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, DATA).toPandas()
    assert set(pieces.doc_id) == rows and pieces.groupby("sequence_id").length.sum().max() <= 1024


def test_stages_take_odd_rows(spark):
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    rows = [(1, "some text", "x"), (1, "some text", "x"), (None, None, None), (None, "no id", ""), (2, "", None), (3, long, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, frame, DATA).columns == docs.columns
            stage(spark, frame, DATA).count()
        assert corpus_pipeline.STAGES[-1][1](spark, frame, DATA).count() >= 0
    once = [r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, DATA).collect()]
    assert sorted(once, key=str) == [1, 2, 3, None, None]


def test_rows_that_share_an_id_are_kept_or_dropped_by_themselves(spark, tmp_path):
    texts = {n: " ".join(f"{n}{i * 7 % 31}" for i in range(30)) for n in "xyzuv"}
    rows = [(5, "x"), (7, "x"), (5, "y"), (3, "y"), (None, "z"), (None, "z"), (None, "u"), (9, "u"), (2, "v"), (2, "v")]
    docs = spark.createDataFrame([(i, texts[t], t) for i, t in rows], "doc_id long, text string, source string")
    kept = corpus_pipeline.near_duplicates(spark, docs, DATA).collect()
    assert sorted((r.source, r.doc_id) for r in kept) == [("u", 9), ("v", 2), ("x", 5), ("y", 3), ("z", None)]

    item = "A farmer sells 12 apples to Anna and keeps 30 apples for the market near 12 old houses in town"
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    changed = item.replace("12", "7").replace("30", "55")
    rows = [(None, item), (None, "clean words"), (None, None), (4, changed), (4, item.replace("12", "8").replace("30", "9")), (4, "other words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = corpus_pipeline.decontamination(spark, docs, str(tmp_path)).collect()
    assert {(r.doc_id, r.text) for r in left} == {(None, "clean words"), (None, None), (4, "other words")} and len(left) == 3
