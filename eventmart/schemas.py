"""Declared table schemas with their keys, sort orders and versions.

Nothing is inferred: every reader names its schema, and the writers take sort and
partition columns from the table's entry here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

TEXT, LONG, INT, DOUBLE = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
DATE, TIME, BYTES = T.DateType(), T.TimestampType(), T.BinaryType()


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


@dataclass(frozen=True)
class Table:
    name: str
    schema: T.StructType
    key: tuple[str, ...] = ()
    version: str | None = None
    sort: tuple[str, ...] = ()
    month_of: str | None = None
    bloom: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


# Files as they arrive: header row, times as text.
EVENTS_FILE = _schema(event_time=TEXT, user_id=LONG, session_id=TEXT, event_type=TEXT, channel=TEXT,
                      premium_amount=DOUBLE)
EVENTS_FILE_TEXT = _schema(event_time=TEXT, user_id=TEXT, session_id=TEXT, event_type=TEXT, channel=TEXT,
                           premium_amount=TEXT)
USERS_FILE = _schema(user_id=LONG, signup_date=TEXT, city=TEXT, device_type=TEXT)

# A stream record around the message text.
ENVELOPE = _schema(key=TEXT, value=TEXT, topic=TEXT, partition=INT, offset=LONG, timestamp=TIME)

EVENT_FIELDS = tuple(EVENTS_FILE.fieldNames())

USERS = Table(
    "users",
    _schema(user_id=LONG, signup_date=DATE, city=TEXT, device_type=TEXT, updated_at=TIME),
    key=("user_id",), version="updated_at")

USER_EVENTS = Table(
    "user_events",
    _schema(event_time=TIME, user_id=LONG, session_id=TEXT, event_type=TEXT, channel=TEXT,
            premium_amount=DOUBLE),
    sort=("user_id", "event_time"))

EVENTS_ENRICHED = Table(
    "events_enriched",
    _schema(event_time=TIME, user_id=LONG, session_id=TEXT, event_type=TEXT, channel=TEXT,
            premium_amount=DOUBLE, city=TEXT, device_type=TEXT, signup_date=DATE,
            kafka_topic=TEXT, kafka_partition=LONG, kafka_offset=LONG, kafka_timestamp=TIME,
            _ingested_at=TIME, ingest_lag_sec=LONG),
    key=("user_id", "session_id", "event_time", "event_type"),
    sort=("event_type", "event_time", "user_id"), month_of="event_time", bloom=("session_id",))

DAILY_KEYS = ("event_date", "channel", "city", "device_type", "event_type")

EVENTS_AGG_DAILY = Table(
    "events_agg_daily",
    _schema(event_date=DATE, channel=TEXT, city=TEXT, device_type=TEXT, event_type=TEXT,
            events_count=LONG, unique_users=BYTES, premium_sum=DOUBLE,
            premium_avg=_schema(total=DOUBLE, n=LONG)),
    key=DAILY_KEYS,
    sort=("event_date", "event_type", "channel", "city", "device_type"), month_of="event_date")

# Sketches of ingest lags, one per batch, day and type.
LAG_STATES = Table(
    "lag_states",
    _schema(event_date=DATE, event_type=TEXT, n=LONG, max_lag=LONG, lags=BYTES),
    key=("event_date", "event_type"), sort=("event_date", "event_type"), month_of="event_date")

_ORDER = {"order_id": LONG, "user_id": LONG, "session_id": TEXT, "premium": DOUBLE,
          "created_at": TIME}
_ORDER_KEY = ("user_id", "session_id", "order_id")

THIRD_ORDER = Table(
    "third_order",
    _schema(**_ORDER, vehicle_type=TEXT, coverage_tier=TEXT, no_claim_years=INT),
    key=_ORDER_KEY, version="created_at", sort=_ORDER_KEY, month_of="created_at")
BODY_ORDER = Table(
    "body_order",
    _schema(**_ORDER, vehicle_value=DOUBLE, vehicle_brand=TEXT,
            franchise_pct=T.DecimalType(4, 2)),
    key=_ORDER_KEY, version="created_at", sort=_ORDER_KEY, month_of="created_at")
MEDICAL_ORDER = Table(
    "medical_order",
    _schema(**_ORDER, plan_tier=TEXT, insured_count=INT, has_dental=INT),
    key=_ORDER_KEY, version="created_at", sort=_ORDER_KEY, month_of="created_at")
FIRE_ORDER = Table(
    "fire_order",
    _schema(**_ORDER, property_type=TEXT, building_area=LONG, coverage_amount=DOUBLE),
    key=_ORDER_KEY, version="created_at", sort=_ORDER_KEY, month_of="created_at")
FINANCIAL_ORDER = Table(
    "financial_order",
    _schema(order_id=LONG, payment_method=TEXT, installments=INT, discount_amount=DOUBLE,
            tax_amount=DOUBLE, net_amount=DOUBLE, payment_status=TEXT, paid_at=TIME),
    key=("order_id",), version="paid_at", sort=("order_id",), month_of="paid_at")

PRODUCT_TABLES = {
    "third": THIRD_ORDER, "body": BODY_ORDER, "medical": MEDICAL_ORDER, "fire": FIRE_ORDER,
}

FACT_PURCHASES = Table(
    "fact_purchases",
    _schema(event_time=TIME, user_id=LONG, session_id=TEXT, channel=TEXT, event_premium=DOUBLE,
            city=TEXT, device_type=TEXT, signup_date=DATE, order_id=LONG, product_line=TEXT,
            order_premium=DOUBLE, order_created_at=TIME, attributes=T.MapType(TEXT, TEXT),
            payment_method=TEXT, installments=INT, discount_amount=DOUBLE, tax_amount=DOUBLE,
            net_amount=DOUBLE, payment_status=TEXT, paid_at=TIME),
    sort=("city", "product_line", "event_time", "user_id"), month_of="event_time",
    bloom=("user_id", "order_id"))

EVENTS_ENRICHED_BACKFILL = Table(
    "events_enriched_backfill",
    _schema(event_time=TIME, user_id=LONG, session_id=TEXT, event_type=TEXT, channel=TEXT,
            premium_amount=DOUBLE, city=TEXT, device_type=TEXT, signup_date=TEXT,
            _backfilled_at=TIME),
    key=("user_id", "session_id", "event_time", "event_type"), version="_backfilled_at",
    sort=("user_id", "session_id", "event_time", "event_type"), month_of="event_time")

DEAD_LETTERS = Table(
    "dead_letters",
    _schema(value=TEXT, topic=TEXT, partition=INT, offset=LONG, timestamp=TIME, error=TEXT))

# What each micro-batch read from a topic.
CONSUMED = Table(
    "consumed",
    _schema(topic=TEXT, partition=INT, num_messages_read=LONG, last_offset=LONG))

# Orders that have no fact yet, as the last reconcile run left them, and the newest batches it saw:
# per table the newest time of writing, with the labels written at that time.
OPEN_ORDERS = Table(
    "open_orders", _schema(**_ORDER, product_line=TEXT, attributes=T.MapType(TEXT, TEXT)),
    key=(*_ORDER_KEY, "product_line"), version="created_at", sort=("order_id",))
SEEN_BATCHES = Table("seen_batches", _schema(table=TEXT, label=TEXT, written=LONG))

# Changes of the revenue per line and day, one batch per refresh or erasure, and the batches of
# facts that are counted in it.
REVENUE_CHANGES = Table(
    "revenue_changes",
    _schema(product_line=TEXT, day=DATE, revenue=T.DecimalType(38, 2), orders=LONG),
    key=("product_line", "day"), sort=("product_line", "day"))
COUNTED_BATCHES = Table("counted_batches", _schema(label=TEXT))

# What the engine tells of each micro-batch and source; offsets as the engine writes them.
PROGRESS = Table(
    "progress",
    _schema(query=TEXT, batch_id=LONG, source=INT, told_at=TEXT, described=TEXT, input_rows=LONG,
            end_offset=TEXT, latest_offset=TEXT))

# Emptied by a reset; the users dimension stays.
DATA_TABLES = (
    EVENTS_ENRICHED, EVENTS_AGG_DAILY, FACT_PURCHASES, *PRODUCT_TABLES.values(),
    FINANCIAL_ORDER, EVENTS_ENRICHED_BACKFILL, USER_EVENTS, OPEN_ORDERS, SEEN_BATCHES,
    REVENUE_CHANGES, COUNTED_BATCHES, LAG_STATES,
)
