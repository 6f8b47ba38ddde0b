import json
from datetime import datetime

import helpers as h
import pytest

from eventmart.plans import backfill, jobs
from eventmart.schemas import ENVELOPE, EVENTS_FILE, USERS, USERS_FILE
from eventmart.sources.tables import write_batch

NOW = "2025-10-01 12:00:00"


@pytest.fixture
def files(spark):
    visits = [("2025-10-02 08:15:30", 41, "night", "purchase", "email", 250.5)] * 2 + [
        ("2025-10-12 19:00:00", 52, "day", "quote", "social", None),
        ("2025-10-07 23:59:59", 63, "late", "quote", "social", None)]
    people = [(41, "2023-06-30", "Porto", "android"), (52, "2023-07-01", "Lyon", "desktop")]
    return spark.createDataFrame(visits, EVENTS_FILE), spark.createDataFrame(people, USERS_FILE)


WINDOW = ("2025-10-01", "2025-10-07")


def test_window_is_filtered_enriched_and_distinct(files):
    out = backfill.enrich_window(*files, *WINDOW)
    assert out.columns == list(backfill.COLUMNS)
    got = {r.user_id: r for r in out.collect()}
    assert out.count() == 2
    assert got[41].city == "Porto" and got[41].signup_date == "2023-06-30"
    assert got[63].city == got[63].device_type == "UNKNOWN" and got[63].signup_date is None


def test_window_with_users_too_many_to_broadcast(files, rows):
    assert rows(backfill.enrich_window(*files, *WINDOW, max_bytes=0)) == rows(
        backfill.enrich_window(*files, *WINDOW))


def test_dry_run_counts(files):
    got = backfill.dry_run(*files, *WINDOW)
    assert (got["source_rows"], got["window_rows"], got["unmatched"]) == (4, 2, 1)
    assert [r.user_id for r in got["sample"]] == [41, 63]


def test_loading_a_window_twice_leaves_one_row_each(spark, files, rows, tmp_path):
    root = str(tmp_path)
    for label, at in (("a", "2025-11-01 00:00:00"), ("b", "2025-11-02 00:00:00")):
        backfill.load_window(backfill.enrich_window(*files, *WINDOW), root, label, at)
    out = backfill.read_backfill(spark, root)
    assert rows(out, "user_id") == [(41,), (63,)]
    assert {str(r[0]) for r in out.select("_backfilled_at").collect()} == {"2025-11-02 00:00:00"}


@pytest.fixture
def house(spark, tmp_path):
    made = jobs.Warehouse(spark, str(tmp_path / "house"))
    write_batch(h.users(spark, (1, "Rome", "ios"), (2, "Bari", "web")), made.root, USERS, "base")
    return made


def stream(spark, path, *events):
    values = [json.dumps({"event_time": "2025-10-01 10:00:00", "user_id": u, "session_id": s,
                          "event_type": kind, "channel": "web", "premium_amount": 100.0})
              for u, s, kind in events]
    spark.createDataFrame([("k", v, "user_events", 0, i, datetime(2025, 10, 1, 10))
                           for i, v in enumerate(values)], ENVELOPE).write.parquet(f"{path}/in")
    return spark.readStream.schema(ENVELOPE).parquet(f"{path}/in")


def test_full_run_then_late_order_then_monitoring(spark, house, rows, tmp_path):
    source = stream(spark, tmp_path, (1, "s1", "purchase"), (2, "s2", "purchase"))
    report = jobs.full_run(house, h.tables(spark, h.third(1, 1, "s1")),
                           h.financials(spark, h.payment(1), h.payment(2)), source,
                           str(tmp_path / "checkpoint"), ingested_at=NOW)
    got = {k: [tuple(r) for r in v.collect()] for k, v in report.items()}
    assert got["users"] == [(2,)]
    assert got["enrichment_coverage"] == [(0, 2)]
    assert got["fact_product_lines"] == [("third", 1, 90.0, 3.0)]

    jobs.seed(house, h.tables(spark, h.third(1, 1, "s1"), h.third(2, 2, "s2")),
              h.financials(spark, h.payment(1), h.payment(2)))
    assert rows(house.facts(), "order_id") == [(1,)]
    result = jobs.monitoring(house, 2, NOW)
    assert rows(house.facts(), "order_id") == [(1,), (2,)]
    assert (result.failures, result.warnings, len(result.rows)) == (0, 1, 10)
    assert [r for r in result.rows if r[1] == "WARN"] == [
        ("ingestion_lag", "WARN", "p95_lag_sec=7200 max_lag_sec=7200")]
    assert jobs.reconcile(house) == 0

    jobs.reset(house)
    assert house.events().count() == house.facts().count() == house.orders().count() == 0
    assert house.users().count() == 2


def test_ingest_cycle_reports_a_shortfall(spark, house, tmp_path):
    source = stream(spark, tmp_path, (1, "s1", "view"))
    result = jobs.ingest_cycle(house, source, str(tmp_path / "checkpoint"), expected=2, as_of=NOW)
    assert ("row_count_parity", "FAIL", "clickhouse=1 expected=2") in result.rows
    assert result.failures == 1


def test_stored_purchases_denormalize_in_one_go(spark, house, rows, tmp_path):
    source = stream(spark, tmp_path, (1, "s1", "purchase"))
    jobs.ingest(house, source, str(tmp_path / "checkpoint"), ingested_at=NOW)
    assert house.facts().count() == 0
    jobs.seed(house, h.tables(spark, h.third(1, 1, "s1")), h.financials(spark, h.payment(1)))
    for _ in range(2):
        jobs.denormalize_stored(house)
    assert rows(house.stored_facts(), "order_id", "net_amount") == [(1, 90.0)]


def test_csv_files_load_into_tables(spark, house, rows, tmp_path):
    from eventmart.schemas import FINANCIAL_ORDER
    (tmp_path / "f.csv").write_text(
        "order_id,payment_method,installments,discount_amount,tax_amount,net_amount,"
        "payment_status,paid_at\n1,wallet,3,0.5,0.09,1.5,paid,2025-10-01 10:00:00\n")
    jobs.load_csv(house, str(tmp_path / "f.csv"), FINANCIAL_ORDER, "file")
    assert rows(house.financials(), "order_id", "net_amount") == [(1, 1.5)]
