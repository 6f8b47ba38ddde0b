from decimal import Decimal

import helpers as h
from pyspark.sql import functions as F

from eventmart.functions.values import PRODUCT_LINES
from eventmart.operators import orders as o
from eventmart.schemas import FINANCIAL_ORDER


def sample(spark):
    return h.events(spark, h.event(1, "s-a", premium=1000000.0, offset=0),
                    h.event(2, "s-b", "view", premium=None, offset=1),
                    h.event(3, "s-c", premium=None, offset=2))


def test_only_purchases_become_orders_and_no_premium_is_zero(spark, rows):
    out = o.orders_from_purchases(sample(spark), o.lineage_order_id(1))
    assert rows(out, "order_id", "user_id", "premium") == [(1, 1, 1000000.0), (3, 3, 0.0)]


def test_lines_split_without_loss_and_counts_agree(spark):
    data = h.events(spark, *[h.event(i, f"s{i}", offset=i) for i in range(40)])
    all_orders = o.orders_from_purchases(data, o.lineage_order_id(1))
    parts = o.split_by_line(all_orders)
    counts = {r.product_line: r.orders for r in o.line_counts(all_orders).collect()}
    assert set(parts) == set(PRODUCT_LINES)
    assert {k: p.count() for k, p in parts.items() if p.count()} == counts
    ids = {r.order_id for p in parts.values() for r in p.select("order_id").collect()}
    assert ids == set(range(1, 41))


def test_one_payment_per_order_with_the_same_ids(spark, rows):
    placed = o.orders_from_purchases(sample(spark), o.lineage_order_id(1))
    paid = o.financial_rows(placed, F.lit(0.1), payment_method=F.lit("wallet"),
                            installments=F.lit(3), payment_status=F.lit("paid"))
    assert paid.columns == FINANCIAL_ORDER.columns
    assert rows(paid, "order_id") == rows(placed, "order_id")
    first = paid.filter("order_id = 1").first()
    assert (first.discount_amount, first.tax_amount, first.net_amount) == (
        100000.0, 81000.0, 981000.0)


def test_lineage_ids_are_unique_over_partitions(spark):
    data = h.events(spark, *[h.event(1, f"s{p}{n}", partition=p, offset=n)
                             for p in range(3) for n in range(4)])
    ids = [r[0] for r in data.select(o.lineage_order_id(3).cast("long")).collect()]
    assert sorted(ids) == list(range(1, 13))


def test_union_folds_the_attributes_of_each_line(spark):
    tables = h.tables(
        spark, h.third(1, years=10),
        body=[(2, 1, "s2", 5.0, h.T0, 12345678.5, "Kia", Decimal("1.10"))],
        medical=[(3, 1, "s3", 5.0, h.T0, "gold", 4, 0)],
        fire=[(4, 1, "s4", 5.0, h.T0, "commercial", 120, 2.5e7)])
    got = {r.product_line: r.attributes for r in o.product_orders_all(tables).collect()}
    assert got == {
        "third": {"vehicle_type": "car", "coverage_tier": "base", "no_claim_years": "10"},
        "body": {"vehicle_value": "12345678.5", "vehicle_brand": "Kia", "franchise_pct": "1.1"},
        "medical": {"plan_tier": "gold", "insured_count": "4", "has_dental": "0"},
        "fire": {"property_type": "commercial", "building_area": "120",
                 "coverage_amount": "25000000"}}


def test_versions_collapse_unless_asked_not_to(spark, rows):
    tables = h.tables(spark, h.third(1, premium=1.0),
                      h.third(1, premium=2.0, when="2025-10-02 10:00:00"))
    assert rows(o.product_orders_all(tables), "premium") == [(2.0,)]
    assert rows(o.product_orders_all(tables, collapse=False), "premium") == [(1.0,), (2.0,)]
    assert o.order_keys(tables).count() == 2
