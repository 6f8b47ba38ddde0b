import random

import helpers as h
import pytest
from pyspark.sql import functions as F

from eventmart.operators import aggregates as a
from eventmart.operators import orders as o
from eventmart.operators import purchases as p
from eventmart.schemas import EVENTS_AGG_DAILY


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(3)
    return h.events(spark, *[
        h.event(rng.randint(1, 50), f"s{i}", rng.choice(["purchase", "view"]),
                f"2025-10-0{rng.randint(1, 3)} 10:00:00", rng.choice([None, 10.0, 30.0]),
                rng.choice(["Rome", "Bari"]), offset=i, channel=rng.choice(["web", "app"]))
        for i in range(600)])


def test_null_premium_counts_as_zero(spark):
    df = h.events(spark, h.event(1, premium=None), h.event(2, premium=30.0), h.event(2, premium=None))
    for out in (a.daily_metrics(df), a.finalize_states(a.daily_states(df))):
        row = out.first()
        assert (row.events_count, row.unique_users, row.premium_sum, row.premium_avg) == (
            3, 2, 30.0, 10.0)


def test_states_have_the_declared_columns(data):
    assert a.daily_states(data).columns == EVENTS_AGG_DAILY.columns


def test_states_of_batches_merge_to_the_whole(data, rows):
    parts = [data.filter(F.pmod("kafka_offset", F.lit(3)) == i) for i in range(3)]
    states = a.daily_states(parts[0])
    for part in parts[1:]:
        states = states.unionByName(a.daily_states(part))
    whole = rows(a.daily_metrics(data))
    assert rows(a.finalize_states(states)) == whole
    assert rows(a.finalize_states(a.merge_states(states))) == whole


def test_sketches_of_many_users_stay_close(spark):
    df = spark.range(200_000).selectExpr(
        "timestamp'2025-10-01' AS event_time", "'web' AS channel", "'Rome' AS city",
        "'ios' AS device_type", "'view' AS event_type", "id % 50000 AS user_id",
        "1.0D AS premium_amount")
    got = a.finalize_states(a.daily_states(df)).first().unique_users
    assert abs(got - 50000) / 50000 < 0.05


def test_purchases_by_day_and_channel_are_ordered(data):
    out = [tuple(r) for r in a.purchases_by_day_and_channel(a.daily_metrics(data)).collect()]
    assert out == sorted(out, key=lambda r: (r[0], -r[2], r[1]))
    assert sum(r[2] for r in out) == data.filter("event_type = 'purchase'").count()


def test_revenue(spark, rows):
    facts = p.denormalize(
        h.events(spark, h.event(1, "s1"), h.event(2, "s2", when="2025-10-02 10:00:00", offset=1)),
        o.product_orders_all(h.tables(spark, h.third(1, 1, "s1"), h.third(2, 2, "s2"))),
        h.financials(spark, h.payment(1, 0.1), h.payment(2, 0.2)))
    by_day = a.revenue_by_line_and_day(facts)
    assert sorted((str(r.day), r.revenue, r.orders) for r in by_day.collect()) == [
        ("2025-10-01 00:00:00", 0.1, 1), ("2025-10-02 00:00:00", 0.2, 1)]
    assert rows(a.revenue_by_line_since(facts, "2025-10-01 00:00:00")) == [("third", 0.3)]
    assert rows(a.revenue_by_line_since(facts, "2025-10-02 00:00:00")) == [("third", 0.2)]


def test_lag_quantiles_of_merged_states(spark):
    draw = random.Random(4)
    lags = [int(draw.lognormvariate(3, 2)) for _ in range(3000)]
    events = spark.createDataFrame([(h.at("2025-10-01 10:00:00"), "view", x, i % 5) for i, x in enumerate(lags)] + [
        (h.at("2025-10-01 10:00:00"), "view", None, 0)], "event_time timestamp, event_type string, ingest_lag_sec long, batch int")
    states = None
    for batch in range(5):
        part = a.lag_states(events.where(f"batch = {batch}"))
        states = part if states is None else states.unionByName(part)
    row, = a.lag_quantiles(states).collect()
    assert (row.event_type, row.n, row.max_lag) == ("view", 3000, max(lags))
    for name, share in a.LAG_SHARES.items():
        below, upto = sum(x < row[name] for x in lags), sum(x <= row[name] for x in lags)
        assert below / 3000 - 0.02 <= share <= upto / 3000 + 0.02
    assert a.lag_quantiles(states.limit(0)).collect() == []
