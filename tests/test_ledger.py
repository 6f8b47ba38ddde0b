"""The reconcile ledger, the stored rollup, and purchases and orders as two streams."""

from pathlib import Path

import helpers as h
import pytest

from eventmart.operators.aggregates import revenue_by_line_and_day
from eventmart.operators.orders import product_orders_all
from eventmart.plans import jobs, ledger, rollup
from eventmart.schemas import (
    EVENTS_ENRICHED, FACT_PURCHASES, FINANCIAL_ORDER, PRODUCT_TABLES, SEEN_BATCHES)
from eventmart.sources.tables import drop_batches, read_table, stored_batches, write_batch
from eventmart.streaming import joined, live

DAYS = [f"2025-10-{day:02d} 10:00:00" for day in range(1, 31)]


@pytest.fixture
def house(spark, tmp_path):
    made = jobs.Warehouse(spark, str(tmp_path / "house"))
    write_batch(h.financials(spark, *[h.payment(i, net=10.0 * i) for i in range(1, 10)]), made.root, FINANCIAL_ORDER, "all")
    return made


def arrive(house, label, events=(), orders=()):
    spark = house.spark
    write_batch(h.events(spark, *events), house.root, EVENTS_ENRICHED, label)
    jobs.seed_products(house, h.tables(spark, *orders), label)


def spoil(house, table, label):
    """Make a batch unreadable, footers included."""
    for file in Path(house.root, table.name, f"batch={label}").rglob("*.parquet"):
        file.write_bytes(b"no longer parquet")
        file.with_name(f".{file.name}.crc").unlink(missing_ok=True)


def test_open_orders_meet_new_events_only(spark, house, rows):
    arrive(house, "a", [h.event(1, "s1"), h.event(2, "s2")], [h.third(1, 1, "s1"), h.third(3, 3, "s3"), h.third(4, 4, "s4")])
    assert ledger.reconcile_new(house) == ledger.Run(1, 2)
    first = stored_batches(spark, house.root, FACT_PURCHASES)
    # What a run adds is new to the next one.
    assert ledger.reconcile_new(house) == ledger.Run(0, 2)
    for table in (EVENTS_ENRICHED, *PRODUCT_TABLES.values()):
        spoil(house, table, "a")
    spoil(house, FACT_PURCHASES, next(iter(first)))
    assert ledger.reconcile_new(house) == ledger.Run(0, 2)
    # A purchase for an open order comes: the run reads its batch, and none of the old ones.
    arrive(house, "b", [h.event(3, "s3")])
    assert ledger.reconcile_new(house) == ledger.Run(1, 1)
    assert len(stored_batches(spark, house.root, FACT_PURCHASES)) == 4


def test_late_order_finds_an_old_purchase(house, rows):
    arrive(house, "a", [h.event(1, "s1"), h.event(2, "s2")], [h.third(1, 1, "s1")])
    ledger.reconcile_new(house)
    arrive(house, "b", orders=[h.third(2, 2, "s2"), h.third(5, 1, "s1")])
    assert ledger.reconcile_new(house) == ledger.Run(2, 0)
    assert rows(house.stored_facts(), "order_id", "net_amount") == [(1, 10.0), (2, 20.0), (5, 50.0)]
    assert jobs.reconcile(house) == 0


def test_orders_sent_again_and_facts_from_elsewhere(house, rows):
    arrive(house, "a", [h.event(1, "s1")], [h.third(1, 1, "s1"), h.third(2, 2, "s2", premium=1.0), h.third(3, 3, "s3")])
    ledger.reconcile_new(house)
    # Order 1 comes again after it has its fact; order 2 comes again, newer, while it is open; order 3
    # gets its fact from the stream.
    arrive(house, "b", [h.event(2, "s2"), h.event(3, "s3")],
           [h.third(1, 1, "s1"), h.third(2, 2, "s2", premium=7.0, when=DAYS[4])])
    spark = house.spark
    write_batch(house.stored_facts().limit(1).selectExpr(
        *[("3L AS order_id" if c == "order_id" else c) for c in FACT_PURCHASES.columns]), house.root, FACT_PURCHASES, "stream")
    assert ledger.reconcile_new(house) == ledger.Run(1, 0)
    assert rows(house.stored_facts(), "order_id", "order_premium") == [(1, 100.0), (2, 7.0), (3, 100.0)]
    assert ledger.reconcile_new(house) == ledger.Run(0, 0)
    assert len(stored_batches(spark, house.root, SEEN_BATCHES)) == 2


def test_run_cut_off_before_its_ledger_is_written(house, rows):
    arrive(house, "a", [h.event(1, "s1")], [h.third(1, 1, "s1"), h.third(2, 2, "s2")])
    ledger.reconcile_new(house)
    drop_batches(house.spark, house.root, SEEN_BATCHES, list(stored_batches(house.spark, house.root, SEEN_BATCHES)))
    assert ledger.reconcile_new(house) == ledger.Run(0, 1)
    assert rows(house.stored_facts(), "order_id") == [(1,)]


def wanted_revenue(house):
    return sorted((r.product_line, str(r.day)[:10], r.revenue, r.orders) for r in revenue_by_line_and_day(house.facts()).collect())


def stored_revenue(house, since=None):
    return sorted((r.product_line, str(r.day), r.revenue, r.orders) for r in rollup.revenue(house, since).collect())


def test_rollup_follows_copies_erasure_and_late_orders(house, spark):
    arrive(house, "a", [h.event(u, f"s{u}", when=DAYS[u]) for u in (1, 2, 3)], [h.third(u, u, f"s{u}") for u in (1, 2, 3)])
    jobs.denormalize_stored(house)
    assert rollup.refresh(house) == 1 and rollup.refresh(house) == 0
    assert stored_revenue(house) == wanted_revenue(house) and len(stored_revenue(house)) == 3
    # Order 2 comes again with an earlier purchase and moves to that day, order 3 with a later one and stays.
    write_batch(house.stored_facts().where("order_id > 1").selectExpr(*[
        "event_time + make_interval(0, 0, 0, if(order_id = 2, -1, 1)) AS event_time" if c == "event_time" else c
        for c in FACT_PURCHASES.columns]), house.root, FACT_PURCHASES, "copies")
    rollup.refresh(house)
    assert stored_revenue(house) == wanted_revenue(house)
    assert {(r[1], r[3]) for r in stored_revenue(house)} == {("2025-10-02", 2), ("2025-10-04", 1)}
    arrive(house, "b", [h.event(4, "s4", when=DAYS[3])], [h.third(4, 4, "s4")])
    ledger.reconcile_new(house)
    subjects = spark.createDataFrame([(3,), (9,)], "user_id long")
    rollup.erase(house, subjects, "r1")
    assert stored_revenue(house) == wanted_revenue(house) and house.facts().where("user_id = 3").isEmpty()
    # The same request again, as after a crash, takes nothing back twice.
    rollup.erase(house, subjects, "r1")
    assert stored_revenue(house) == wanted_revenue(house)
    assert stored_revenue(house, "2025-10-04") == [r for r in wanted_revenue(house) if r[1] >= "2025-10-04"]


def test_compaction_spares_what_jobs_have_not_seen(house):
    arrive(house, "a", [h.event(1, "s1")], [h.third(1, 1, "s1")])
    arrive(house, "b", [h.event(2, "s2")], [h.third(2, 2, "s2"), h.third(3, 3, "s3")])
    assert jobs.compact(house, EVENTS_ENRICHED, [202510]) == 0
    ledger.reconcile_new(house)
    rollup.refresh(house)
    arrive(house, "c", [h.event(3, "s3")])
    assert jobs.compact(house, EVENTS_ENRICHED, [202510]) == 2
    assert set(stored_batches(house.spark, house.root, EVENTS_ENRICHED)) == {"c"}
    assert ledger.reconcile_new(house) == ledger.Run(1, 0)
    # The first batch of facts is counted, the second is not.
    assert jobs.compact(house, FACT_PURCHASES, [202510]) == 0
    rollup.refresh(house)
    assert stored_revenue(house) == wanted_revenue(house)
    ledger.reconcile_new(house)
    rollup.refresh(house)
    assert jobs.compact(house, FACT_PURCHASES, [202510]) == 2
    rollup.refresh(house)
    assert stored_revenue(house) == wanted_revenue(house) and house.facts().count() == 3


def test_refresh_cut_off_is_done_again(house, spark):
    arrive(house, "a", [h.event(1, "s1")], [h.third(1, 1, "s1")])
    jobs.denormalize_stored(house)
    rollup.refresh(house)
    from eventmart.schemas import COUNTED_BATCHES
    drop_batches(spark, house.root, COUNTED_BATCHES, ["run-00000001"])
    rollup.refresh(house)
    assert stored_revenue(house) == wanted_revenue(house)


def test_streams_join_and_forget(house, spark, tmp_path):
    """The order first, a run late, and past the watermark; state goes once the watermark is past it."""
    join = joined.OrderJoin(house.root, house.financials, delay="2 days")
    events, product, checkpoint = (str(tmp_path / x) for x in ("events", "orders", "checkpoint"))

    def run(came, sent):
        frames = (h.events(spark, *came), product_orders_all(h.tables(spark, *sent), collapse=False))
        for frame, folder in zip(frames, (events, product), strict=True):
            joined.append(frame, folder)
        query = join.start(*(joined.folder_stream(spark, f, p) for f, p in zip(frames, (events, product), strict=True)), checkpoint)
        live.wait(query, 300)
        found = sorted(r.order_id for r in house.stored_facts().collect())
        return found, joined.state_counts(query.recentProgress)

    # Order 2 is there before its purchase; 3 lacks its order; 5's session matches but is hours apart.
    found, (dropped, held) = run(
        [h.event(1, "s1", when=DAYS[0]), h.event(3, "s3", when=DAYS[0]), h.event(4, "s4", when=DAYS[1]), h.event(5, "s5", when=DAYS[1])],
        [h.third(1, 1, "s1", when=DAYS[0]), h.third(2, 2, "s2", when=DAYS[1]), h.third(5, 5, "s5", when=DAYS[1].replace("10:", "14:"))])
    assert (found, dropped, held) == ([1], 0, 7)
    # Order 4 is a run late and in time: the watermark still lies before its day.
    found, (dropped, held) = run(
        [h.event(2, "s2", when=DAYS[1]), h.event(6, "s6", when=DAYS[9])], [h.third(4, 4, "s4", when=DAYS[1]), h.third(6, 6, "s6", when=DAYS[9])])
    assert (found, dropped, held) == ([1, 2, 4, 6], 0, 2)
    # Order 3 comes past the watermark.
    found, (dropped, held) = run([h.event(7, "s7", when=DAYS[20])], [h.third(3, 3, "s3", when=DAYS[0]), h.third(7, 7, "s7", when=DAYS[20])])
    assert (found, dropped, held) == ([1, 2, 4, 6, 7], 1, 2)
    assert {r.net_amount for r in house.stored_facts().collect()} == {10.0, 20.0, 40.0, 60.0, 70.0}
    arrive(house, "all", [h.event(3, "s3", when=DAYS[0])], [h.third(3, 3, "s3", when=DAYS[0])])
    assert ledger.reconcile_new(house) == ledger.Run(1, 0)
    assert not read_table(spark, house.root, FACT_PURCHASES).where("order_id = 3").isEmpty()
