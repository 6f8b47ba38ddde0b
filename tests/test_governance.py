import helpers as h
import pytest

from eventmart.operators import governance as g
from eventmart.operators import orders as o
from eventmart.operators import purchases as p
from eventmart.operators import reports
from eventmart.operators.aggregates import daily_metrics, daily_states


@pytest.fixture(scope="module")
def facts(spark):
    events = h.events(spark, h.event(1, "s1", city="Rome"), h.event(2, "s2", city="Bari", offset=1))
    return p.denormalize(
        events, o.product_orders_all(h.tables(spark, h.third(1, 1, "s1"), h.third(2, 2, "s2"))),
        h.financials(spark, h.payment(1, 150000.0), h.payment(2, 250000.0)))


def test_mask_buckets_money_and_drops_exact_columns(facts):
    out = g.masked_purchases(facts)
    assert out.columns == ["event_time", "user_id", "city", "device_type", "channel",
                           "product_line", "attributes", "net_amount_bucket", "payment_method",
                           "payment_status"]
    assert sorted(r.net_amount_bucket for r in out.collect()) == [200000.0, 200000.0]


def test_restricted_rows(facts, rows):
    assert rows(g.restrict(facts, city="Rome"), "order_id") == [(1,)]


def test_each_audience_sees_its_tables(spark, facts):
    events = h.events(spark, h.event(1))
    known = {"events_agg_daily_v": daily_metrics(events), "fact_purchases": facts,
             "events_enriched": events, "financial_order": h.financials(spark)}
    assert {a: set(g.tables_for(a, known)) for a in g.AUDIENCES} == {
        "analyst": {"events_agg_daily_v", "fact_purchases_masked"},
        "data_scientist": {"events_agg_daily_v", "fact_purchases_masked", "events_enriched"},
        "finance": {"fact_purchases", "financial_order"}}
    assert "net_amount" not in g.tables_for("analyst", known)["fact_purchases_masked"].columns
    assert g.tables_for("analyst", known, city="Bari")["fact_purchases_masked"].count() == 1
    names = g.publish_views("finance", known)
    assert spark.table(names[0]).count() == 2


@pytest.mark.parametrize("when, kept", [
    ("2024-04-01 00:00:00", 0), ("2024-04-01 00:00:01", 1), ("2023-04-01 00:00:00", 0)])
def test_retention_keeps_rows_younger_than_eighteen_months(spark, when, kept):
    df = h.events(spark, h.event(when=when))
    assert g.retained(df, "2025-10-01 00:00:00").count() == kept


def test_retention_at_the_end_of_a_short_month(spark):
    df = h.events(spark, h.event(when="2024-02-29 12:00:00"))
    assert g.retained(df, "2025-08-29 11:59:59").count() == 1
    assert g.retained(df, "2025-08-31 00:00:00").count() == 0


def test_erasure(spark, rows):
    df = h.events(spark, h.event(1), h.event(2), h.event(3))
    gone = spark.createDataFrame([(2,), (2,), (7,)], "user_id BIGINT")
    assert rows(g.erased(df, gone), "user_id") == [(1,), (3,)]


def test_reports(spark, facts):
    events = h.events(spark, h.event(1, city="Rome"), h.event(2, city="UNKNOWN"),
                      h.event(1, kind="view", when="2025-10-02 10:00:00", premium=None))
    daily = daily_metrics(events)
    sections = reports.verification_report(h.users(spark, (1, "Rome", "ios")), events, daily, facts)
    assert list(sections) == [
        "users", "events_enriched", "enrichment_coverage", "aggregates_by_event_type",
        "purchase_channels", "fact_product_lines"]
    got = {k: [tuple(r) for r in v.collect()] for k, v in sections.items()}
    assert got["users"] == [(1,)]
    assert got["events_enriched"][0][:2] == (3, 2)
    assert got["enrichment_coverage"] == [(1, 3)]
    assert got["aggregates_by_event_type"] == [("purchase", 2, 2, 100.0), ("view", 1, 1, 0.0)]
    assert got["purchase_channels"] == [("web", 2, 200.0)]
    assert got["fact_product_lines"] == [("third", 2, 200000.0, 3.0)]


def test_users_add_up_per_group_but_merge_from_sketches(spark):
    events = h.events(spark, h.event(1), h.event(1, when="2025-10-02 10:00:00", premium=200.0),
                      h.event(2, when="2025-10-02 10:00:00", premium=300.0))
    quirk = reports.by_event_type(daily_metrics(events)).first()
    merged = reports.by_event_type_merged(daily_states(events)).first()
    assert (quirk.approx_users, quirk.avg_premium) == (3, 175.0 // 1)
    assert (merged.approx_users, merged.avg_premium) == (2, 200.0)


def test_first_rows(spark):
    df = spark.range(10)
    assert [r.id for r in reports.first_rows(df, 3, ["id"]).collect()] == [0, 1, 2]
    assert reports.first_rows(df, 0, ["id"]).count() == 10
