"""Orders in hash buckets by session."""

import re

import helpers as h
import pytest

from eventmart.operators.orders import product_orders_all
from eventmart.operators.purchases import SESSION, denormalize, denormalize_in_buckets, purchase_side
from eventmart.sources import buckets
from eventmart.sources.buckets import SLOT, OrderBuckets


@pytest.fixture
def orders(spark):
    # Sessions of several orders, an order in two versions, and an order of an unknown session.
    rows = [h.third(i, i % 40, f"s{i % 40}", premium=float(i)) for i in range(1, 60)]
    rows += [h.third(7, 7, "s7", premium=1.5, when="2025-10-02 10:00:00"), h.third(99, 99, None)]
    return h.tables(spark, *rows)


@pytest.fixture
def store(spark, tmp_path, orders):
    made = OrderBuckets(str(tmp_path), buckets=8, per_bucket=4)
    made.add(product_orders_all(orders, collapse=False))
    return made


def batch(spark):
    return h.events(spark, h.event(3, "s3"), h.event(3, "s3", when="2025-10-01 09:00:00"), h.event(7, "s7"),
                    h.event(19, "s19"), h.event(19, "other"), h.event(5, "s5", kind="view"), h.event(99, None))


def payments(spark):
    return h.financials(spark, h.payment(3), h.payment(43, net=5.0))


def test_facts_equal_the_plain_join(spark, orders, store, rows):
    wanted = denormalize(batch(spark), product_orders_all(orders), payments(spark))
    columns = [c for c in wanted.columns if c != "attributes"]
    found = denormalize_in_buckets(batch(spark), store, lambda: payments(spark))
    assert rows(found, *columns) == rows(wanted, *columns) and found.count() == 6
    assert denormalize_in_buckets(batch(spark).limit(0), store, lambda: payments(spark)).collect() == []


def test_adding_again_changes_nothing(spark, orders, store, rows):
    before = rows(store.read(spark).drop("attributes"))
    store.add(product_orders_all(orders, collapse=False))
    assert rows(store.read(spark).drop("attributes")) == before and len(before) == 60


def test_order_side_is_not_shuffled_and_few_buckets_are_opened(spark, store):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        side = purchase_side(batch(spark)).withColumn(SLOT, store.slot())
        slots = [r[0] for r in side.where("user_id = 3").select(SLOT).distinct().collect()]
        plan = store.read(spark, slots).join(side, [SLOT, *SESSION])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SelectedBucketsCount: 1 out of 8" in plan
    # One exchange, of the batch; the lines of the plan from the table's scan up to the join have none.
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    order_side = plan[plan.index("Window"):plan.index("FileScan parquet")]
    assert "Exchange" not in order_side


def test_hot_buckets_are_salted(spark, orders, store, rows, monkeypatch):
    monkeypatch.setattr(buckets, "HOT_TIMES", 0.5)
    hot = OrderBuckets(store.root, 8, 4, hot_bytes=0)
    assert 0 < len(hot.hot_slots(spark)) and store.hot_slots(spark) == []
    plain = denormalize_in_buckets(batch(spark), store, lambda: payments(spark)).drop("attributes")
    salted = denormalize_in_buckets(batch(spark), hot, lambda: payments(spark)).drop("attributes")
    assert rows(salted) == rows(plain)


def test_files_stay_when_another_session_attaches(spark, store):
    spark.sql(f"DROP TABLE {store.name}")
    assert store.read(spark).count() == 60
