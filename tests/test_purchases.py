import random
from datetime import datetime

import helpers as h
import pytest

from eventmart.operators import orders as o
from eventmart.operators import purchases as p
from eventmart.schemas import FACT_PURCHASES


def build(spark, events, thirds, payments, **options):
    return p.denormalize(h.events(spark, *events), o.product_orders_all(h.tables(spark, *thirds)),
                         h.financials(spark, *payments), **options)


def test_fact_row_joins_event_order_and_payment(spark):
    out = build(spark, [h.event(), h.event(2, "s2", "view")], [h.third(1)], [h.payment(1)])
    assert out.columns == FACT_PURCHASES.columns
    row = out.first()
    assert out.count() == 1
    assert (row.order_id, row.city, row.net_amount, row.payment_method, row.event_premium) == (
        1, "Rome", 90.0, "wallet", 100.0)


def test_no_payment_gives_defaults_or_nulls(spark):
    row = build(spark, [h.event()], [h.third(1)], []).first()
    assert (row.payment_method, row.installments, row.net_amount, row.paid_at) == (
        "", 0, 0.0, datetime(1970, 1, 1))
    row = build(spark, [h.event()], [h.third(1)], [], use_nulls=True).first()
    assert (row.payment_method, row.installments, row.net_amount, row.paid_at) == (None,) * 4


def test_a_missing_event_premium_stays_null(spark):
    assert build(spark, [h.event(premium=None)], [h.third(1)], []).first().event_premium is None


def test_latest_payment_version_counts(spark, rows):
    out = build(spark, [h.event()], [h.third(1)],
                [h.payment(1, 1.0), h.payment(1, 2.0, "2025-10-02 10:00:00")])
    assert rows(out, "order_id", "net_amount") == [(1, 2.0)]


def test_two_purchases_and_two_orders_in_a_session(spark, rows):
    events = [h.event(when="2025-10-01 10:00:00"), h.event(when="2025-10-01 11:00:00", offset=1)]
    thirds = [h.third(1), h.third(2)]
    assert build(spark, events, thirds, [], one_per_order=False).count() == 4
    once = build(spark, events, thirds, [])
    assert rows(once, "order_id", "event_time") == [(1, h.T0), (2, h.T0)]


def test_one_per_order_equals_the_join_deduplicated_afterwards(spark, rows):
    rng = random.Random(5)
    events = [h.event(rng.randint(1, 3), f"s{rng.randint(1, 3)}", rng.choice(["purchase", "view"]),
                      f"2025-10-01 10:00:{rng.randint(0, 59):02d}", offset=i)
              for i in range(60)]
    thirds = [h.third(rng.randint(1, 12), rng.randint(1, 3), f"s{rng.randint(1, 3)}")
              for _ in range(25)]
    payments = [h.payment(i) for i in range(1, 8)]
    once = build(spark, events, thirds, payments)
    pairs = build(spark, events, thirds, payments, one_per_order=False)
    want = {}
    for r in pairs.collect():
        key = (r.event_time, r.user_id, r.session_id)
        if r.order_id not in want or key < want[r.order_id]:
            want[r.order_id] = key
    got = {r.order_id: (r.event_time, r.user_id, r.session_id) for r in once.collect()}
    assert got == want and len(got) == once.count()


def test_a_hot_session_gives_one_row_per_order(spark):
    events = [h.event(1, "hot", when=f"2025-10-01 10:{i // 60:02d}:{i % 60:02d}", offset=i)
              for i in range(500)]
    thirds = [h.third(i, 1, "hot") for i in range(1, 301)]
    out = build(spark, events, thirds, [])
    assert out.count() == 300
    assert out.select("event_time").distinct().count() == 1


def test_reconcile_adds_late_orders_once(spark, rows):
    events = h.events(spark, h.event(1, "s1"), h.event(2, "s2", offset=1))
    early = o.product_orders_all(h.tables(spark, h.third(1, 1, "s1")))
    every = o.product_orders_all(h.tables(spark, h.third(1, 1, "s1"), h.third(2, 2, "s2")))
    paid = h.financials(spark, h.payment(1), h.payment(2))
    facts = p.denormalize(events, early, paid)
    assert rows(facts, "order_id") == [(1,)]
    added = p.reconcile(events, every, paid, facts)
    assert rows(added, "order_id", "session_id") == [(2, "s2")]
    assert p.reconcile(events, every, paid, facts.unionByName(added)).count() == 0


def test_reconcile_gives_one_row_for_duplicate_purchases(spark, rows):
    events = h.events(spark, h.event(), h.event(offset=1))
    every = o.product_orders_all(h.tables(spark, h.third(1)))
    none = p.denormalize(events, every, h.financials(spark)).limit(0)
    assert rows(p.reconcile(events, every, h.financials(spark), none), "order_id") == [(1,)]


def test_purchases_without_fact(spark, rows):
    events = h.events(spark, h.event(1, "s1"), h.event(2, "s2", offset=1),
                      h.event(3, "s3", "view", offset=2))
    facts = p.denormalize(events, o.product_orders_all(h.tables(spark, h.third(1, 1, "s1"))),
                          h.financials(spark))
    assert rows(p.purchases_without_fact(events, facts), "user_id") == [(2,)]


@pytest.mark.parametrize("limit, kept", [(p.BROADCAST_BYTES, 1), (0, 2)])
def test_key_filter_only_filters_for_few_keys(spark, limit, kept):
    events = h.events(spark, h.event(1, "s1"), h.event(2, "s2", offset=1))
    keys = spark.createDataFrame([(1, "s1"), (1, "s1")], "user_id BIGINT, session_id STRING")
    assert p.key_filter(keys, p.SESSION, limit)(events).count() == kept


def test_last_dedup_and_payment_join_share_one_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        out = build(spark, [h.event()], [h.third(1)], [h.payment(1)])
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", True)
    assert plan.count("Exchange hashpartitioning(order_id") == 2
