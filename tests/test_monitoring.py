import random

import helpers as h
import pytest

from eventmart.operators import monitoring as m


def test_hours_without_events_count_zero_and_are_flagged(spark):
    rows = [h.event(i, when=f"2025-10-01 {hour:02d}:30:00", offset=i)
            for i, hour in enumerate([0] * 4 + [1] * 4 + [2] * 4 + [4] * 40)]
    got = {str(r.hour)[11:13]: (r.events, r.baseline, r.flag)
           for r in m.volume_anomalies(h.events(spark, *rows)).collect()}
    assert got == {"00": (4, None, "OK"), "01": (4, 4.0, "OK"), "02": (4, 4.0, "OK"),
                   "03": (0, 4.0, "LOW"), "04": (40, 3.0, "HIGH")}


def test_baseline_only_covers_seven_days(spark):
    rows = [h.event(1, when="2025-10-01 00:10:00"), h.event(1, when="2025-10-08 01:10:00")]
    last = m.volume_anomalies(h.events(spark, *rows)).orderBy("hour").tail(1)[0]
    assert (last.events, last.baseline) == (1, 0.0)


def test_baselines_equal_one_window_over_all_hours(spark):
    rng = random.Random(3)
    rows = [h.event(i, when=f"2025-{rng.randint(9, 10):02d}-{rng.randint(1, 30):02d} "
                            f"{rng.randint(0, 23):02d}:10:00", offset=i) for i in range(300)]
    found = m.volume_anomalies(h.events(spark, *rows)).orderBy("hour").collect()
    for i, row in enumerate(found):
        before = [r.events for r in found[max(0, i - 168):i]]
        assert row.baseline == (pytest.approx(sum(before) / len(before)) if before else None)


def test_lag_of_partitions_read_and_never_read(spark, rows):
    latest = spark.createDataFrame([(0, 9), (1, 9), (2, 9)],
                                   "kafka_partition BIGINT, latest_offset BIGINT")
    done = m.partition_progress(h.events(spark, h.event(offset=9), h.event(partition=1, offset=5)))
    assert rows(m.partition_lag(latest, done, 4)) == [
        (0, 9, 9, 0, "OK"), (1, 9, 5, 4, "OK"), (2, 9, None, 10, "LAGGING")]


def brute(offsets):
    gaps = []
    for p in sorted({p for p, _ in offsets}):
        seen = sorted({o for q, o in offsets if q == p})
        gaps += [(p, a + 1, b - 1, b - a - 1) for a, b in zip(seen, seen[1:]) if b - a > 1]
    return gaps


@pytest.mark.parametrize("offsets", [
    [(0, 0), (0, 1), (0, 3)],
    [(0, 5)],
    [(0, 32767), (0, 32768), (0, 32770), (1, 65535), (1, 65536)],
    [(0, 0), (0, 200_000)],
    [(0, 10), (0, 10), (0, 12), (0, 12)]])
def test_missing_offsets(spark, rows, offsets):
    df = spark.createDataFrame(offsets, "kafka_partition BIGINT, kafka_offset BIGINT")
    assert rows(m.missing_offsets(df)) == sorted(brute(offsets), key=lambda r: [str(v) for v in r])


def test_missing_offsets_against_brute_force(spark):
    rng = random.Random(11)
    offsets = [(p, o) for p in range(3) for o in range(100_000) if rng.random() > 0.01]
    df = spark.createDataFrame(offsets, "kafka_partition BIGINT, kafka_offset BIGINT")
    assert sorted(map(tuple, m.missing_offsets(df).collect())) == brute(offsets)
    for r in m.offset_ranges(df).collect():
        seen = [o for p, o in offsets if p == r.kafka_partition]
        assert (r.expected, r.actual) == (max(seen) - min(seen) + 1, len(seen))


def test_days_to_backfill(spark, rows):
    expected = m.daily_counts(h.events(spark, h.event(1), h.event(2), h.event(
        3, when="2025-10-02 10:00:00")))
    actual = m.daily_counts(h.events(spark, h.event(1)))
    got = [(str(r.event_date), r.expected, r.actual, r.missing, r.backfill)
           for r in m.daily_gaps(expected, actual).orderBy("event_date").collect()]
    assert got == [("2025-10-01", 2, 1, 1, True), ("2025-10-02", 1, 0, 1, True)]


def test_field_drift(spark, rows):
    texts = ['{"a":1,"b":2}', '{"a":1,"c":3}', "not json", None]
    df = spark.createDataFrame([(t,) for t in texts], "value STRING")
    assert rows(m.field_drift(df, ["a", "b"])) == [
        ("a", 2, 0, "OK"), ("b", 1, 1, "MISSING_FIELD"), ("c", 1, 0, "UNKNOWN_FIELD")]
