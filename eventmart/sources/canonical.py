"""The driver's test tables in the shape of this package's tables.

``events``, ``customer`` and ``nation`` hold no orders, no stream positions and no bad data,
so those are derived column by column: every row of the source takes part, and each kind of
irregular row follows from the row's own attributes. ``k`` is the number inside ``props``.

========================  =====================================================
unknown users             customers with a negative balance are no users
purchases without premium purchases with a value below 1
late orders               purchases with k below 4 have no product order yet
orders without payment    orders with k of 90 and more
shared sessions           visits: the events of a user in a week share one
lost messages             events with k = 0 did not land
copies                    events with k = 50 landed twice
========================  =====================================================
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.operators.enrich import enrich
from eventmart.operators.orders import (
    financial_rows, order_keys, orders_from_purchases, product_orders_all, split_by_line)
from eventmart.operators.purchases import denormalize, purchases
from eventmart.schemas import PRODUCT_TABLES
from eventmart.session import run_dir

PARTITIONS = 4

# Fixed values.
CHANNELS = ("web", "app", "call_center", "agent", "partner")
DEVICES = ("ios", "android", "web")
VEHICLE_TYPES = ("car", "motorcycle", "heavy")
COVERAGE_TIERS = ("base", "1.5x", "2x", "3x")
VEHICLE_BRANDS = ("Saipa", "IranKhodro", "Toyota", "Hyundai", "Kia", "Renault")
PLAN_TIERS = ("bronze", "silver", "gold", "platinum")
PROPERTY_TYPES = ("residential", "commercial")
PAYMENT_METHODS = ("gateway", "wallet", "installment")
PAYMENT_STATUS = ("paid", "paid", "paid", "pending", "failed")
INSTALLMENTS = (1, 1, 1, 3, 6, 12)

_SCHEMAS = {
    "events": T.StructType([
        T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())]),
    "customer": T.StructType([
        T.StructField("c_custkey", T.LongType()), T.StructField("c_nationkey", T.IntegerType()),
        T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType())]),
    "nation": T.StructType([
        T.StructField("n_nationkey", T.IntegerType()), T.StructField("n_name", T.StringType())]),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


#: Events in a file of a dealt stream. One task reads a file this small, so a big micro-batch is many files.
FILE_EVENTS = 65_536


def event_stream(spark: SparkSession, sf_dir: str, batches: int = 1, file_events: int = FILE_EVENTS) -> DataFrame:
    """The events as a stream; for several micro-batches they are dealt to files first, by event, so that
    days and users are spread over all of them. A micro-batch takes its share of the files."""
    reader = spark.readStream.schema(_SCHEMAS["events"])
    if batches == 1:
        return reader.parquet(f"{sf_dir}/events*.parquet")
    folder = run_dir(spark, "event-stream")
    found = table(spark, sf_dir, "events")
    each = max(1, math.ceil(found.count() / batches / file_events))
    found.repartition(batches * each, "event_id").write.parquet(folder)
    written = len(spark.read.schema(found.schema).parquet(folder).inputFiles())
    return reader.option("maxFilesPerTrigger", max(1, math.ceil(written / batches))).parquet(folder)


def pick(values: tuple, index: str) -> str:
    """SQL for the value at ``index`` modulo the number of values."""
    items = ", ".join(repr(v) for v in values)
    return f"array({items})[cast(({index}) % {len(values)} as int)]"


VISIT = "concat('v-', user_id, '-', date_format(date_trunc('week', event_time), 'yyyyMMdd'))"


def events_from(raw: DataFrame) -> DataFrame:
    """Raw event rows, batch or stream, as events with their stream position."""
    parsed = raw.selectExpr(
        "event_id", "cast(get_json_object(props, '$.k') as int) as k",
        "date_trunc('second', cast(ts as timestamp)) as event_time", "user_id", "event_type",
        "value")
    return parsed.selectExpr(
        "event_id", "k", "event_time", "user_id", "concat('s-', event_id) as session_id",
        "event_type", f"{pick(CHANNELS, 'k')} as channel",
        "if(event_type = 'purchase' and value < 1, null, round(value * 100000))"
        " as premium_amount",
        "'user_events' as kafka_topic", f"event_id % {PARTITIONS} as kafka_partition",
        f"event_id div {PARTITIONS} as kafka_offset", "event_time as kafka_timestamp")


def events(spark: SparkSession, sf_dir: str, visits: bool = False) -> DataFrame:
    """All events, each in a session of its own, or, as ``visits``, in one session per user and week."""
    found = events_from(table(spark, sf_dir, "events"))
    return found.withColumn("session_id", F.expr(VISIT)) if visits else found


def ingest_time() -> Column:
    """Up to six seconds after the event."""
    return F.expr("timestamp_seconds(unix_timestamp(event_time) + event_id % 7)")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers in the shape of users, with balance and segment."""
    joined = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
    return joined.selectExpr(
        "c_custkey as user_id",
        "date_add(date '2023-01-01', cast(c_custkey % 365 as int)) as signup_date",
        "n_name as city", f"{pick(DEVICES, 'c_custkey')} as device_type",
        "timestamp '2024-01-01 00:00:00' as updated_at", "c_acctbal", "c_mktsegment")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers(spark, sf_dir).filter("c_acctbal >= 0").drop("c_acctbal", "c_mktsegment")


def enriched(spark: SparkSession, sf_dir: str, visits: bool = False) -> DataFrame:
    return enrich(events(spark, sf_dir, visits), users(spark, sf_dir), ingest_time())


def landed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with messages lost and others doubled."""
    found = events(spark, sf_dir).filter("k <> 0")
    return found.select(
        "*", F.expr("explode(sequence(1, if(k = 50, 2, 1))) as _copy")).drop("_copy")


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(landed_events(spark, sf_dir), users(spark, sf_dir), ingest_time())


def _number(field: str) -> str:
    """SQL for a number below 2^32 that is fixed by the order and the field's name."""
    return f"cast(conv(substr(md5(concat(order_id, ':{field}')), 25, 8), 16, 10) as bigint)"


_ATTRIBUTES = {
    "third": {"vehicle_type": pick(VEHICLE_TYPES, _number("vehicle_type")),
              "coverage_tier": pick(COVERAGE_TIERS, _number("coverage_tier")),
              "no_claim_years": f"{_number('no_claim_years')} % 11"},
    "body": {"vehicle_value": f"premium * (800 + {_number('vehicle_value')} % 1201) / 100",
             "vehicle_brand": pick(VEHICLE_BRANDS, _number("vehicle_brand")),
             "franchise_pct": f"cast({_number('franchise_pct')} % 1001 as decimal(6,2)) / 100"},
    "medical": {"plan_tier": pick(PLAN_TIERS, _number("plan_tier")),
                "insured_count": f"1 + {_number('insured_count')} % 6",
                "has_dental": f"{_number('has_dental')} % 2"},
    "fire": {"property_type": pick(PROPERTY_TYPES, _number("property_type")),
             "building_area": f"40 + {_number('building_area')} % 461",
             "coverage_amount": f"premium * (2000 + {_number('coverage_amount')} % 4001) / 100"},
}

DISCOUNT_RATE = f"cast({_number('discount_rate')} % 1501 as decimal(10,4)) / 10000"


ORDER_ID = "event_id + 1"


def all_orders(spark: SparkSession, sf_dir: str, where: str = "true", visits: bool = False) -> DataFrame:
    """Orders of the purchases with their line; the id comes from the event's id."""
    return orders_from_purchases(events(spark, sf_dir, visits).filter(where), F.expr(ORDER_ID))


def product_tables(spark: SparkSession, sf_dir: str, late: bool = True,
                   where: str = "true", visits: bool = False) -> dict[str, DataFrame]:
    """The four product tables; without the late orders unless ``late``."""
    return _line_tables(all_orders(spark, sf_dir, where if late else f"k >= 4 and {where}", visits))


def _line_tables(orders: DataFrame) -> dict[str, DataFrame]:
    """The product tables of orders, with each line's own attributes."""
    tables = {}
    for line, rows in split_by_line(orders).items():
        known = {f.name: f.dataType.simpleString() for f in PRODUCT_TABLES[line].schema.fields}
        tables[line] = rows.selectExpr(*[
            f"cast({_ATTRIBUTES[line].get(name, name)} as {kind}) as {name}"
            for name, kind in known.items()])
    return tables


def versioned_product_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The product tables with a day-old version of half the premium beside each row."""
    tables = {}
    for line, rows in product_tables(spark, sf_dir).items():
        old = rows.withColumns({"premium": F.expr("premium / 2"),
                                "created_at": F.expr("created_at - interval 1 day")})
        tables[line] = rows.unionByName(old)
    return tables


def financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payment rows of the orders that have one."""
    return financial_rows(
        all_orders(spark, sf_dir, "k < 90"), F.expr(DISCOUNT_RATE),
        payment_method=F.expr(pick(PAYMENT_METHODS, _number("payment_method"))),
        installments=F.expr(pick(INSTALLMENTS, _number("installments"))),
        payment_status=F.expr(pick(PAYMENT_STATUS, _number("payment_status"))))


def facts(spark: SparkSession, sf_dir: str, late: bool = True) -> DataFrame:
    tables = product_tables(spark, sf_dir, late)
    return denormalize(enriched(spark, sf_dir), product_orders_all(tables),
                       financials(spark, sf_dir), count_on=order_keys(tables))


#: First days of the second and third part of the month.
PARTS = ("2024-01-11", "2024-01-21")
RUNS = (1, 2, 3)


def part_of(time: str) -> str:
    """SQL for the part of the month that a time lies in: 1, 2 or 3."""
    return f"if({time} < '{PARTS[0]}', 1, if({time} < '{PARTS[1]}', 2, 3))"


def arrival(part: str) -> str:
    """SQL for the run in which an order arrives, by its purchase's part and k: a run late for k of 0
    and 1, in the third run for 2 and 3, a run early for 4 and 5, else with its purchase. The fourth
    run is after the stream."""
    return f"case when k < 2 then {part} + 1 when k < 4 then 3 when k < 6 then greatest({part} - 1, 1) else {part} end"


def _stored_by(df: DataFrame, name: str, column: str) -> DataFrame:
    """Rows written once, in a folder per value of a column."""
    folder = run_dir(df.sparkSession, name)
    df.write.partitionBy(column).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


class Arrivals:
    """What arrives run by run. Events and purchases are derived once, in a pass each, and stored by run;
    each run's frames read their own rows alone, however often they are used."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        part = part_of("event_time")
        self._enriched = _stored_by(enriched(spark, sf_dir).withColumn("run", F.expr(part)), "arrived-events", "run")
        self._purchases = _stored_by(purchases(events(spark, sf_dir)).withColumn(
            "run", F.expr(arrival(part))), "arrived-purchases", "run")

    def enriched(self, run: int) -> DataFrame:
        """The enriched events of one run's part of the month."""
        return self._enriched.where(F.col("run") == run).drop("run")

    def product_tables(self, run: int) -> dict[str, DataFrame]:
        """The product tables' rows that arrive in one run."""
        return _line_tables(orders_from_purchases(self._purchases.where(F.col("run") == run), F.expr(ORDER_ID)))


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change log of users: moves, removals and additions, by market segment and balance."""
    people = customers(spark, sf_dir)
    moved = people.filter("c_mktsegment = 'BUILDING' and c_acctbal >= 0").withColumns({
        "city": F.expr("concat('NEW-', city)"),
        "updated_at": F.expr("timestamp '2024-02-01 00:00:00'"), "_deleted": F.lit(False)})
    removed = people.filter("c_mktsegment = 'MACHINERY' and c_acctbal >= 0").withColumn(
        "_deleted", F.lit(True))
    added = people.filter("c_acctbal < 0").withColumns({
        "updated_at": F.expr("timestamp '2024-03-01 00:00:00'"), "_deleted": F.lit(False)})
    return (moved.unionByName(removed).unionByName(added)
            .withColumn("_position", F.col("user_id")).drop("c_acctbal", "c_mktsegment"))


def messages(events_df: DataFrame) -> DataFrame:
    """Events as stream records, with some records damaged according to ``k``.

    k = 0 cuts the text short, 1 quotes the user id, 2 adds a field, 3 puts letters into the
    user id, 4 leaves the event type out, 5 has no value at all.
    """
    text = """concat(
        '{"event_time":"', date_format(event_time, 'yyyy-MM-dd HH:mm:ss'), '","user_id":',
        case k when 3 then concat('"u', user_id, '"') when 1 then concat('"', user_id, '"')
               else cast(user_id as string) end,
        ',"session_id":"', session_id, '"',
        if(k = 4, '', concat(',"event_type":"', event_type, '"')),
        ',"channel":"', channel, '","premium_amount":',
        coalesce(cast(cast(premium_amount as bigint) as string), 'null'),
        if(k = 2, ',"campaign":"spring"', ''), '}')"""
    return events_df.selectExpr(
        "cast(user_id as string) as key",
        f"if(k = 5, null, if(k = 0, left({text}, 40), {text})) as value",
        "kafka_topic as topic", "cast(kafka_partition as int) as partition",
        "kafka_offset as offset", "kafka_timestamp as timestamp")
