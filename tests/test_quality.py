import helpers as h
import pytest
from pyspark.sql import functions as F

from eventmart.operators import monitoring, quality

AS_OF = "2025-10-01 12:00:00"


def results(spark, rows, facts=0, expected=None, as_of=AS_OF, dead=None):
    events = h.events(spark, *rows)
    fact = spark.range(facts)
    built = quality.checks(events, fact, monitoring.partition_progress(events),
                           len(rows) if expected is None else expected, as_of, dead)
    return {r.check_name: (r.status, r.metric) for r in quality.report(built).collect()}


GOOD = [h.event(i, f"s{i}", offset=i) for i in range(4)]


def test_good_events_pass_everything(spark):
    got = results(spark, GOOD, facts=4)
    assert {s for s, _ in got.values()} == {"PASS"} and len(got) == 10
    assert got["row_count_parity"][1] == "clickhouse=4 expected=4"
    assert got["ingestion_lag"][1] == "p95_lag_sec=1 max_lag_sec=1"
    assert got["ingestion_freshness"][1] == (
        "max_event_time=2025-10-01 10:00:00 max_ingested_at=2025-10-01 10:00:01")


@pytest.mark.parametrize("check, status, metric, change", [
    ("row_count_parity", "FAIL", "clickhouse=4 expected=5", dict(expected=5)),
    ("referential_integrity_users", "FAIL", "unmatched_users=1",
     dict(rows=[*GOOD[:3], h.event(9, city="UNKNOWN", offset=3)])),
    ("null_premium_on_purchase", "FAIL", "null_purchase_premiums=1",
     dict(rows=[*GOOD[:3], h.event(9, premium=None, offset=3)])),
    ("premium_on_non_purchase", "WARN", "non_purchase_with_premium=1",
     dict(rows=[*GOOD[:3], h.event(9, kind="view", offset=3)])),
    ("duplicate_events", "FAIL", "extra_duplicate_rows=2",
     dict(rows=[*GOOD, GOOD[0], GOOD[0]])),
    ("ingestion_freshness", "FAIL", None, dict(as_of="2025-10-03 00:00:00")),
    ("denorm_purchase_coverage", "FAIL", "fact_rows=5 purchase_events=4", dict(facts=5)),
    ("offset_continuity", "FAIL", "missing_in_offset_ranges=2",
     dict(rows=[*GOOD, h.event(9, offset=6)])),
    ("ingestion_lag", "WARN", "p95_lag_sec=900 max_lag_sec=900",
     dict(rows=[h.event(i, offset=i, lag=900) for i in range(3)]))])
def test_each_check_notices(spark, check, status, metric, change):
    got = results(spark, **{"rows": GOOD, "facts": 4, **change})
    assert got[check][0] == status
    assert metric is None or got[check][1] == metric


def test_empty_tables(spark):
    got = {k: s for k, (s, _) in results(spark, [], expected=1).items()}
    assert got == {
        "row_count_parity": "FAIL", "referential_integrity_users": "PASS",
        "null_premium_on_purchase": "PASS", "premium_on_non_purchase": "PASS",
        "duplicate_events": "PASS", "ingestion_freshness": "FAIL",
        "denorm_purchase_coverage": "PASS", "kafka_consumer_errors": "PASS",
        "offset_continuity": "PASS", "ingestion_lag": "WARN"}
    assert results(spark, [], expected=0)["row_count_parity"][0] == "PASS"


def test_percentile_is_interpolated_over_rows(spark):
    lags = [1, 1, 1, 5, 9, 20]
    profile = quality.event_profile(
        h.events(spark, *[h.event(i, offset=i, lag=n) for i, n in enumerate(lags)]))
    assert profile.first().p95_lag == pytest.approx(9 + 0.75 * 11)


def test_dead_letters_fail_the_consumer_check_when_given(spark):
    assert results(spark, GOOD, dead=spark.range(0))["kafka_consumer_errors"] == (
        "PASS", "assignments=1 dead_letters=0")
    assert results(spark, GOOD, dead=spark.range(2))["kafka_consumer_errors"] == (
        "FAIL", "assignments=1 dead_letters=2")


def row(spark, status):
    return lambda: spark.createDataFrame([("c", status, "m")],
                                         "check_name STRING, status STRING, metric STRING")


def test_gate_counts_failures_and_warnings(spark):
    built = {s: row(spark, s) for s in ("PASS", "WARN", "FAIL")}
    got = quality.gate(quality.report(built)).first()
    assert (got.failures, got.warnings) == (1, 1)
    result = quality.run_gate(built)
    assert (result.failures, result.warnings, len(result.rows)) == (1, 1, 3)


def test_gate_counts_errors_and_skips_empty_results(spark):
    def broken():
        raise RuntimeError("connection refused")
    result = quality.run_gate({"a": broken, "b": row(spark, "PASS"),
                               "c": lambda: row(spark, "PASS")().limit(0)})
    assert (result.failures, result.warnings) == (1, 0)
    assert [r[1] for r in result.rows] == ["ERROR", "PASS"]


def test_row_checks_share_one_scan(spark):
    events = h.events(spark, *GOOD)
    built = quality.checks(events, spark.range(4), monitoring.partition_progress(events), 4, AS_OF)
    built = {k: v for k, v in built.items() if k in (
        "row_count_parity", "referential_integrity_users", "ingestion_lag")}
    report = quality.report(built)
    report.collect()
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan


@pytest.mark.parametrize("values", [
    [], [7], [1, 2], [0] * 19 + [100_000], list(range(0, 90_000, 37)), [-5_000, 4095, 4096, 4096, 9000]])
def test_percentile_equals_sparks(spark, values):
    counts = spark.createDataFrame([(v,) for v in values] + [(None,)], "lag BIGINT").groupBy(
        "lag").agg(F.count(F.lit(1)).alias("n"))
    found = quality.weighted_percentile(counts, "lag", 0.95).collect()
    wanted = counts.where("lag IS NOT NULL").agg(F.percentile("lag", F.lit(0.95), F.col("n"))).first()[0]
    assert [r.value for r in found] == [wanted if wanted is None else pytest.approx(wanted)]


def test_the_whole_report_reads_the_events_four_times(spark, tmp_path):
    """Profile, duplicates, consumers and offsets; the profile's own read is done when it is built."""
    h.events(spark, *GOOD).write.parquet(str(tmp_path / "events"))
    events = spark.read.parquet(str(tmp_path / "events"))
    report = quality.report(quality.checks(events, spark.range(4), monitoring.partition_progress(events), 4, AS_OF))
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f"{tmp_path.name}/events") <= 3 and plan.count("FileScan parquet") <= 6
    assert len(report.collect()) == 10
