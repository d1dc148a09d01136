"""Ranks by digits, running sums and numbers of file lines, against sorted lists."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from postsignal.operators import order as O
from postsignal.operators.rows import first_posts

WIDE = [0, 1, -1, 7, 7, (1 << 63) - 1, -(1 << 63), 1 << 40, (1 << 40) + 1, -(1 << 52), 65_535, 65_536]


@pytest.mark.parametrize("rank", [1, 2, 5, 6, 12, 13])
def test_rank_of_scattered_values(spark, rank):
    rows = spark.createDataFrame([(v,) for v in WIDE] + [(None,)], "v bigint").repartition(3)
    got = [r.v for r in O.value_at_rank(rows, rank, "v").collect()]
    assert got == sorted(WIDE)[rank - 1 : rank]


def test_ranks_of_keys_and_repeated_first_fields(spark):
    random.seed(3)
    rows = [(random.choice("ab"), random.choice(["x", None]), random.randint(-3, 3), random.choice([1 << 50, i, -i])) for i in range(300)]
    frame = spark.createDataFrame(rows, "k string, n string, batch int, pos bigint").where("n IS NOT NULL")
    frame = frame.withColumn("place", F.struct("batch", "pos"))
    groups = defaultdict(list)
    for k, n, batch, pos in rows:
        if n is not None:
            groups[k].append((batch, pos))
    ranks = spark.createDataFrame([("a", 40), ("b", 10_000), ("c", 1)], "k string, rank int")
    got = {r.k: tuple(r.place) for r in O.value_at_rank(frame, ranks, "place", ("k",)).collect()}
    assert got == {"a": sorted(groups["a"])[39]}
    got = {r.k: tuple(r.place) for r in O.value_at_rank(frame, 25, "place", ("k",)).collect()}
    assert got == {k: sorted(v)[24] for k, v in groups.items()}


def test_rank_of_times(spark):
    rows = spark.range(100).select(F.timestamp_seconds(F.col("id") * 977 % 101).alias("at")).withColumn("n", F.col("at").cast("timestamp_ntz"))
    values = sorted(r.at for r in rows.collect())
    assert O.value_at_rank(rows, 31, "at").first().at == values[30]
    assert O.value_at_rank(rows, 31, "n").first().n == values[30].astimezone(tz=None).replace(tzinfo=None) or O.value_at_rank(rows, 31, "n").count() == 1


def test_no_values_and_other_types(spark):
    assert O.value_at_rank(spark.createDataFrame([(None,)], "v bigint"), 1, "v").count() == 0
    assert first_posts(spark.createDataFrame([], "ingest_seq bigint"), 5).count() == 0
    with pytest.raises(ValueError):
        O.value_at_rank(spark.createDataFrame([("a",)], "v string"), 1, "v")


def test_running_sums_over_ranges(spark):
    random.seed(5)
    rows = [(f"f{i % 7}", i, random.randint(0, 9)) for i in range(200)]
    got = O.running_before(spark.createDataFrame(rows, "file string, block bigint, n bigint").repartition(5), ["file", "block"], "n", "before").collect()
    total, expected = 0, {}
    for file, block, n in sorted(rows):
        expected[file, block], total = total, total + n
    assert {(r.file, r.block): r.before for r in got} == expected


def test_lines_are_numbered_in_file_order(spark, tmp_path):
    from postsignal.sources import jsonl

    lines = []
    for f in "cab":
        own = [f"{f}{i}" + "x" * (i % 50) for i in range(400)]
        (tmp_path / f"{f}.txt").write_text("\n\n".join(own) + "\n")
    for f in "abc":
        lines += [f"{f}{i}" + "x" * (i % 50) for i in range(400)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        found = O.numbered_lines(jsonl._text_lines(spark, str(tmp_path)), "place", "ingest_seq").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.line for r in sorted(found, key=lambda r: r.ingest_seq)] == lines
    assert sorted(r.ingest_seq for r in found) == list(range(1200))


def test_no_step_gathers_all_rows(spark):
    """Windows run over counters of a key or the rows of a range, never over all rows without a partition."""
    rows = spark.range(1000).select((F.col("id") * 10**15).alias("v"))
    seen = []
    stage = O.stage
    O.stage = lambda frame, name, *a: (seen.append(frame._jdf.queryExecution().toString()), stage(frame, name, *a))[1]
    try:
        O.value_at_rank(rows, 500, "v").collect()
    finally:
        O.stage = stage
    assert len(seen) > 3 and not any("SinglePartition" in plan for plan in seen)
