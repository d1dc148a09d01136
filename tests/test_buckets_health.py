import random
from collections import defaultdict
from datetime import datetime, timedelta, timezone
from statistics import mean, stdev

import pytest
from pyspark.sql import functions as F

from postsignal.operators import buckets, health
from postsignal.schema import BUCKET_SCHEMA, SourceThresholds

START = datetime(2026, 6, 29, 0, 0, tzinfo=timezone.utc)


def scored(spark, rows):
    return spark.createDataFrame(
        rows,
        "timestamp timestamp, engagement_score double, composite_signal double, recency_decay double, "
        "lexical_sentiment double",
    )


def starts(frame):
    return [r[0] for r in frame.select(F.date_format("timestamp", "yyyy-MM-dd HH:mm")).collect()]


def test_hourly_statistics(spark):
    random.seed(2)
    rows = [
        (START + timedelta(minutes=random.randint(0, 900)), random.random(), random.gauss(0, 1), random.random(), 1.0)
        for _ in range(300)
    ]
    groups = defaultdict(list)
    for row in rows:
        groups[row[0].replace(minute=0)].append(row)
    got = buckets.aggregate_signals(scored(spark, rows + [(None, 1.0, 1.0, 0.0, 0.0)])).collect()
    assert [r.tweet_count for r in got] == [len(groups[k]) for k in sorted(groups)]
    for row, key in zip(got, sorted(groups)):
        signal = [r[2] for r in groups[key]]
        assert row.composite_signal_mean == pytest.approx(mean(signal))
        assert row.composite_signal_sum == pytest.approx(sum(signal))
        assert row.engagement_score_mean == pytest.approx(mean(r[1] for r in groups[key]))
        assert row.recency_decay_mean == pytest.approx(mean(r[3] for r in groups[key]))
        wanted = stdev(signal) if len(signal) > 1 else None
        assert row.composite_signal_std == (wanted if wanted is None else pytest.approx(wanted))


def test_single_rows_and_nulls(spark):
    row = buckets.aggregate_signals(scored(spark, [(START, 1.0, None, 0.0, 0.0)])).first()
    assert (row.composite_signal_sum, row.composite_signal_std, row.composite_signal_mean) == (0.0, None, None)


@pytest.mark.parametrize(
    "every, wanted",
    [
        ("1h", ["2026-06-29 00:00", "2026-07-01 13:00", "2026-07-06 02:00"]),
        ("1h30m", ["2026-06-29 00:00", "2026-07-01 13:30", "2026-07-06 01:30"]),
        ("1d", ["2026-06-29 00:00", "2026-07-01 00:00", "2026-07-06 00:00"]),
        ("1w", ["2026-06-29 00:00", "2026-07-06 00:00"]),
        ("1mo", ["2026-06-01 00:00", "2026-07-01 00:00"]),
        ("1q", ["2026-04-01 00:00", "2026-07-01 00:00"]),
        ("1y", ["2026-01-01 00:00"]),
    ],
)
def test_widths(spark, every, wanted):
    times = [START, START + timedelta(days=2, hours=13, minutes=40), START + timedelta(days=7, hours=2)]
    frame = scored(spark, [(t, 1.0, 1.0, 1.0, 1.0) for t in times])
    assert starts(buckets.aggregate_signals(frame, every)) == wanted


@pytest.mark.parametrize("every", ["", "h", "0h", "1x", "5i", "1mo2d", "1h ", "-1h", "10ns"])
def test_bad_widths(every):
    with pytest.raises(ValueError):
        buckets.parse_every(every)


def test_empty_and_undated(spark):
    empty = buckets.aggregate_signals(scored(spark, []))
    assert [(f.name, f.dataType) for f in empty.schema] == [(f.name, f.dataType) for f in BUCKET_SCHEMA]
    assert empty.count() == 0
    undated = buckets.count_undated(scored(spark, [(None, 1.0, 1.0, 1.0, 1.0), (START, 1.0, 1.0, 1.0, 1.0)]))
    assert undated.first()[0] == 1


def test_series_and_plan(spark):
    aggregated = buckets.aggregate_signals(scored(spark, [(START, 1.0, 2.0, 1.0, 1.0)]))
    assert buckets.signal_series(aggregated).columns == ["timestamp", "composite_signal_mean"]
    plan = aggregated._jdf.queryExecution().executedPlan().toString()
    assert "partial_avg" in plan and "partial_stddev_samp" in plan


BATCHES = (
    "source_name string, run_id string, batch_seq bigint, batch_at timestamp, new_records bigint, "
    "duplicates bigint"
)


def sequential_health(rows, limits):
    """The metrics as a loop over the batches of each run would keep them."""
    result, runs = {}, defaultdict(list)
    for row in rows:
        runs[row[:2]].append(row)
    for run, batches in runs.items():
        batches.sort(key=lambda r: r[2])
        began = min(r[3] for r in batches)
        total_new = total_dup = empty = 0
        for place, (_, _, seq, at, new, dup) in enumerate(batches, start=1):
            total_new, total_dup = total_new + new, total_dup + dup
            empty = 0 if new else empty + 1
            window = [r[4] for r in batches[max(0, place - limits.rolling_batches) : place]]
            rate = total_new / (max((at - began).total_seconds(), 1.0) / 60.0)
            ratio = total_dup / (total_new + total_dup) if total_new + total_dup else 0.0
            degraded = (
                empty >= limits.max_empty_run
                or (ratio > limits.max_duplicate_ratio and total_dup > 0)
                or (place >= limits.rolling_batches and rate < limits.min_records_per_minute)
            )
            result[(*run, seq)] = (place, total_new, total_dup, empty, rate, mean(window), ratio, degraded)
    return result


@pytest.mark.parametrize("width", [1, 3, 7, 10_000])
def test_health_matches_a_sequential_loop(spark, width):
    random.seed(width)
    rows = []
    for run in range(4):
        for seq in sorted(random.sample(range(400), 1 if run == 3 else 90)):
            new = random.choice([0, 0, 0, 1, 5]) if run else 0
            rows.append((f"s{run % 2}", f"r{run}", seq, START + timedelta(seconds=31 * seq), new, random.randint(0, 9)))
    limits = SourceThresholds(max_empty_run=2, rolling_batches=4, max_duplicate_ratio=0.7)
    wanted = sequential_health(rows, limits)
    random.shuffle(rows)
    frame = spark.createDataFrame(rows, BATCHES)
    result = health.source_health(frame, limits, segment_width=width)
    got = {
        (r.source_name, r.run_id, r.batch_seq): (
            r.total_batches, r.total_collected, r.total_duplicates, r.empty_run,
            r.records_per_minute, r.new_per_batch, r.duplicate_ratio, r.degraded,
        )
        for r in result.collect()
    }
    assert got.keys() == wanted.keys()
    for key, values in wanted.items():
        assert got[key] == pytest.approx(values), key
    last = health.run_metrics(result).collect()
    assert len(last) == 4
    for row in last:
        ends = max(seq for s, r, seq in wanted if (s, r) == (row.source_name, row.run_id))
        assert row.total_collected == wanted[row.source_name, row.run_id, ends][1]


@pytest.mark.parametrize(
    "batches, limits, degraded",
    [
        ([(0, 0), (0, 0)], {"max_empty_run": 2}, True),
        ([(0, 0), (0, 0)], {"max_empty_run": 3}, False),
        ([(1, 4)], {"max_duplicate_ratio": 0.5}, True),
        ([(1, 1)], {"max_duplicate_ratio": 0.5}, False),
        ([(0, 0)], {"max_duplicate_ratio": 0.0}, False),
        ([(1, 0)] * 5, {}, False),
        ([(1, 0)] + [(1, 0)] * 3 + [(0, 0)], {"min_records_per_minute": 0.5}, True),
    ],
)
def test_degraded_cases(spark, batches, limits, degraded):
    rows = [("s", "r", i, START + timedelta(minutes=3 * i), n, d) for i, (n, d) in enumerate(batches)]
    result = health.source_health(spark.createDataFrame(rows, BATCHES), SourceThresholds(**limits))
    assert health.run_metrics(result).first().degraded is degraded


def test_no_window_holds_a_whole_run(spark):
    frame = spark.createDataFrame([("s", "r", 0, START, 1, 0)], BATCHES)
    plan = health.source_health(frame)._jdf.queryExecution().executedPlan().toString()
    assert "_segment" in plan and "SinglePartition" not in plan
