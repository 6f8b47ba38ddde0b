"""Small frames in the shape of the package's tables."""

from datetime import date, datetime

from eventmart.schemas import EVENTS_ENRICHED, FINANCIAL_ORDER, PRODUCT_TABLES, USERS

T0 = datetime(2025, 10, 1, 10, 0, 0)


def at(text):
    return datetime.strptime(text, "%Y-%m-%d %H:%M:%S")


def event(user=1, session="s1", kind="purchase", when="2025-10-01 10:00:00", premium=100.0,
          city="Rome", partition=0, offset=0, lag=1, channel="web"):
    time = at(when)
    return (time, user, session, kind, channel, premium, city, "ios", date(2024, 1, 1),
            "user_events", partition, offset, time, datetime.fromtimestamp(
                time.timestamp() + lag), lag)


def events(spark, *rows):
    return spark.createDataFrame(list(rows), EVENTS_ENRICHED.schema)


def users(spark, *rows):
    return spark.createDataFrame(
        [(u, date(2024, 1, 1), city, device, datetime(2024, 1, 1)) for u, city, device in rows],
        USERS.schema)


def third(order_id, user=1, session="s1", premium=100.0, when="2025-10-01 10:00:00",
          vehicle="car", years=3):
    return (order_id, user, session, premium, at(when), vehicle, "base", years)


def tables(spark, *third_rows, body=(), medical=(), fire=()):
    parts = {"third": third_rows, "body": body, "medical": medical, "fire": fire}
    return {line: spark.createDataFrame(list(r), PRODUCT_TABLES[line].schema)
            for line, r in parts.items()}


def payment(order_id, net=90.0, when="2025-10-01 10:00:00", method="wallet", installments=3):
    return (order_id, method, installments, 10.0, 0.0, net, "paid", at(when))


def financials(spark, *rows):
    return spark.createDataFrame(list(rows), FINANCIAL_ORDER.schema)
