"""Every query by name, over the driver's tables in canonical shape.

Times leave as text, maps as sorted ``key=value`` lists, so that results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.functions.messages import event_fields
from eventmart.functions.times import moment, time_text
from eventmart.operators import (
    aggregates, enrich, governance, monitoring, orders, purchases, quality, reports, versioning)
from eventmart.plans import backfill, jobs, ledger, rollup
from eventmart.schemas import (
    DEAD_LETTERS,
    BODY_ORDER, EVENTS_AGG_DAILY, EVENTS_ENRICHED, EVENTS_FILE, EVENTS_FILE_TEXT, FACT_PURCHASES, FINANCIAL_ORDER,
    LAG_STATES, USER_EVENTS, USERS, USERS_FILE)
from eventmart.session import run_dir
from eventmart.sources import canonical as data
from eventmart.sources import buckets, files, kafka, tables
from eventmart.streaming import changes, joined, live, progress, records, users

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2024-01-31 00:00:00"
WINDOW = ("2024-01-08", "2024-01-14")
SINCE = "2024-01-15 00:00:00"
RETENTION_AS_OF = "2025-07-12 00:00:00"
REGION = "NATION_7"
LAG_THRESHOLD = 10
# Longer than a part of the month, so that orders one run late are in time.
STREAM_DELAY = "12 days"


def plain(df: DataFrame) -> DataFrame:
    """Times as text and maps as text."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "timestamp":
            out.append(time_text(f.name).alias(f.name))
        elif f.dataType.typeName() == "map":
            pairs = F.transform(F.map_entries(f.name),
                                lambda e: F.concat(e["key"], F.lit("="), e["value"]))
            out.append(F.array_join(F.array_sort(pairs), ",").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def _text_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the text rows of a file, a missing premium as blanks."""
    return plain(data.events(spark, sf_dir)).select(*[
        F.coalesce(F.col(n).cast("bigint").cast("string"), F.lit("   ")).alias(n)
        if n == "premium_amount" else F.col(n).cast("string").alias(n)
        for n in EVENTS_FILE_TEXT.fieldNames()])


# Sources and enrichment


def typed_events(spark, sf_dir):
    return plain(enrich.load_events(_text_rows(spark, sf_dir)))


def enriched_events(spark, sf_dir):
    return plain(data.enriched(spark, sf_dir))


def loaded_users(spark, sf_dir):
    rows = data.users(spark, sf_dir).select(*[
        F.col(n).cast("string").alias(n) for n in USERS_FILE.fieldNames()])
    return plain(enrich.load_users(rows, "2024-01-01 00:00:00"))


def published_messages(spark, sf_dir):
    """Messages as published, read back field by field."""
    sent = kafka.keyed_messages(plain(data.events(spark, sf_dir).select(
        *EVENTS_FILE.fieldNames())))
    fields = sent.select("key", event_fields("value").alias("f"))
    return fields.select("key", *[
        (F.col(f"f.{n}").cast("double") if n == "premium_amount" else F.col(f"f.{n}")).alias(n)
        for n in EVENTS_FILE.fieldNames()])


def first_published_messages(spark, sf_dir):
    """The first hundred messages in order of time."""
    return kafka.keyed_messages(plain(data.events(spark, sf_dir).select(*EVENTS_FILE.fieldNames())), 100).select(
        "key", F.get_json_object("value", "$.event_time").alias("event_time"),
        F.get_json_object("value", "$.session_id").alias("session_id"))


def csv_round_trip(spark, sf_dir):
    """Events staged as CSV, loaded into the raw table and read from there."""
    root = run_dir(spark, "csv")
    files.stage_csv(_text_rows(spark, sf_dir), f"{root}/events")
    loaded = enrich.load_events(files.read_event_text(spark, f"{root}/events"))
    tables.write_batch(loaded, root, USER_EVENTS, "load")
    return plain(tables.read_table(spark, root, USER_EVENTS))


def users_from_csv(spark, sf_dir):
    """Users staged as CSV, read with their declared schema and loaded."""
    path = run_dir(spark, "users-csv")
    files.stage_csv(data.users(spark, sf_dir).select(*[
        F.col(n).cast("string").alias(n) for n in USERS_FILE.fieldNames()]), path)
    return plain(enrich.load_users(files.read_users(spark, path), "2024-01-01 00:00:00"))


def appended_csv(spark, sf_dir):
    """Typed events as two CSV folders, by the number of their user, added to a table one after the
    other; the second is added twice under one label."""
    root = run_dir(spark, "append")
    house = jobs.Warehouse(spark, root)
    rows = data.events(spark, sf_dir).select(*EVENTS_FILE.fieldNames())
    for rest in (0, 1, 1):
        files.stage_csv(rows.where(F.col("user_id") % 2 == rest), f"{root}/csv-{rest}")
        jobs.load_csv(house, f"{root}/csv-{rest}", USER_EVENTS, f"part-{rest}")
    return plain(tables.read_table(spark, root, USER_EVENTS))


def sessions_by_bloom_filter(spark, sf_dir):
    """All stored events of the sessions that were the last of their type in their partition, looked up
    by value in a column with Bloom filters off the sort order."""
    root = run_dir(spark, "bloom")
    tables.write_batch(data.enriched(spark, sf_dir), root, EVENTS_ENRICHED, "all")
    stored = tables.read_table(spark, root, EVENTS_ENRICHED)
    last = stored.groupBy("event_type", "kafka_partition").agg(
        F.max_by("session_id", F.struct("event_time", "session_id")).alias("session_id"))
    return plain(purchases.point_filter(last, ["session_id"])(stored))


def expected_source_rows(spark, sf_dir):
    path = run_dir(spark, "source")
    files.stage_csv(_text_rows(spark, sf_dir), path)
    n = files.expected_rows(spark, path)
    return reports.row_count(files.read_event_text(spark, path), "rows").withColumn(
        "expected", F.lit(n).cast("bigint"))


def stored_events_in_range(spark, sf_dir):
    """Enriched events written by month and sorted, then read for a range of times."""
    root = run_dir(spark, "stored")
    tables.write_batch(data.enriched(spark, sf_dir), root, EVENTS_ENRICHED, "all")
    return plain(tables.read_table(spark, root, EVENTS_ENRICHED, WINDOW[0], WINDOW[1]))


# Orders and purchases


def order_split_counts(spark, sf_dir):
    return orders.line_counts(data.all_orders(spark, sf_dir))


def order_pricing(spark, sf_dir):
    return plain(data.financials(spark, sf_dir))


def product_orders_all(spark, sf_dir):
    return plain(orders.product_orders_all(data.product_tables(spark, sf_dir)))


def orders_latest_version(spark, sf_dir):
    return plain(versioning.latest_version(
        data.versioned_product_tables(spark, sf_dir)["body"], BODY_ORDER.key,
        BODY_ORDER.version))


def fact_purchases(spark, sf_dir):
    return plain(data.facts(spark, sf_dir))


def fact_purchases_all_matches(spark, sf_dir):
    """The plain join, over events with copies: each copy meets the session's order."""
    product = data.product_tables(spark, sf_dir)
    return plain(purchases.denormalize(
        data.landed(spark, sf_dir), orders.product_orders_all(product),
        data.financials(spark, sf_dir), orders.order_keys(product), one_per_order=False))


def _visit_facts(spark: SparkSession, sf_dir: str, one_per_order: bool) -> DataFrame:
    product = data.product_tables(spark, sf_dir, visits=True)
    return plain(purchases.denormalize(
        data.enriched(spark, sf_dir, visits=True), orders.product_orders_all(product),
        data.financials(spark, sf_dir), orders.order_keys(product), one_per_order))


def visit_facts(spark, sf_dir):
    """Facts where sessions hold several purchases and several orders: each order once, at the session's
    earliest purchase."""
    return _visit_facts(spark, sf_dir, one_per_order=True)


def visit_matches(spark, sf_dir):
    """The plain join over the same sessions: every purchase with every order."""
    return _visit_facts(spark, sf_dir, one_per_order=False)


def reconcile_missing(spark, sf_dir):
    """Fact rows added once the late orders are there."""
    product = data.product_tables(spark, sf_dir)
    return plain(purchases.reconcile(
        data.enriched(spark, sf_dir), orders.product_orders_all(product),
        data.financials(spark, sf_dir), data.facts(spark, sf_dir, late=False),
        orders.order_keys(product)))


def late_order_cycle(spark, sf_dir):
    """Stored facts through two reconcile runs after orders come late: rows per stage."""
    house = jobs.Warehouse(spark, run_dir(spark, "late"))
    tables.write_batch(data.enriched(spark, sf_dir), house.root, EVENTS_ENRICHED, "all")
    jobs.seed(house, data.product_tables(spark, sf_dir, late=False),
              data.financials(spark, sf_dir))
    jobs.denormalize_stored(house)
    before = house.facts().count()
    jobs.seed_products(house, data.product_tables(spark, sf_dir), "late")
    added = [jobs.reconcile(house), jobs.reconcile(house)]
    total = house.facts().agg(F.count(F.lit(1)).alias("facts_after"),
                              F.count_distinct("order_id").alias("orders_after"))
    return total.select(
        F.lit(before).cast("bigint").alias("facts_before"),
        F.lit(added[0]).cast("bigint").alias("first_added"),
        F.lit(added[1]).cast("bigint").alias("second_added"), "facts_after", "orders_after")


def _part(run: int) -> str:
    return f"{data.part_of('event_time')} = {run}"


def _arrive(house: jobs.Warehouse, arrivals: data.Arrivals, run: int) -> None:
    """What arrives in one run: the events of a part of the month, and orders early, in time and late."""
    if run in data.RUNS:
        tables.write_batch(arrivals.enriched(run), house.root, EVENTS_ENRICHED, f"part-{run}")
    jobs.seed_products(house, arrivals.product_tables(run), f"part-{run}")


def facts_by_ledger(spark, sf_dir):
    """Four runs of the ledger's reconcile while events and orders arrive out of order: the facts, and
    the run that added each."""
    house = jobs.Warehouse(spark, run_dir(spark, "ledger"))
    arrivals = data.Arrivals(spark, sf_dir)
    tables.write_batch(data.financials(spark, sf_dir), house.root, FINANCIAL_ORDER, "all")
    run_of: dict[str, int] = {}
    for run in (*data.RUNS, 4):
        _arrive(house, arrivals, run)
        ledger.reconcile_new(house)
        for label in tables.stored_batches(spark, house.root, FACT_PURCHASES):
            run_of.setdefault(label, run)
    added = spark.createDataFrame(list(run_of.items()), f"{tables.BATCH} string, run long")
    stored = tables.read_stored(spark, house.root, FACT_PURCHASES).join(F.broadcast(added), tables.BATCH)
    return plain(stored.select(*FACT_PURCHASES.columns, "run"))


def _joined_streams(spark: SparkSession, sf_dir: str,
                    arrivals: data.Arrivals) -> tuple[jobs.Warehouse, list[tuple[int, int, int]]]:
    """Purchases and orders as two streams, in three runs of one query; dropped and held rows by run."""
    house = jobs.Warehouse(spark, run_dir(spark, "joined"))
    landing, checkpoint = run_dir(spark, "landing"), run_dir(spark, "checkpoint")
    tables.write_batch(data.financials(spark, sf_dir), house.root, FINANCIAL_ORDER, "all")
    join = joined.OrderJoin(house.root, house.financials, delay=STREAM_DELAY)
    counts = []
    for run in data.RUNS:
        came = arrivals.enriched(run)
        product = orders.product_orders_all(arrivals.product_tables(run), collapse=False)
        joined.append(came, f"{landing}/events")
        joined.append(product, f"{landing}/orders")
        query = join.start(joined.folder_stream(spark, came, f"{landing}/events"),
                           joined.folder_stream(spark, product, f"{landing}/orders"), checkpoint)
        live.wait(query, 1800)
        counts.append((run, *joined.state_counts(query.recentProgress)))
    return house, counts


def stream_joined_facts(spark, sf_dir):
    """Facts of purchases and orders that met in the stream's state, and, once the tables are stored, of
    the orders that came past the watermark or after the stream, with the way that each took."""
    arrivals = data.Arrivals(spark, sf_dir)
    house, _ = _joined_streams(spark, sf_dir, arrivals)
    for run in (*data.RUNS, 4):
        _arrive(house, arrivals, run)
    ledger.reconcile_new(house)
    stored = tables.read_stored(spark, house.root, FACT_PURCHASES)
    way = F.when(F.col(tables.BATCH).startswith("fill-"), "reconcile").otherwise("stream")
    return plain(stored.select(*FACT_PURCHASES.columns, way.alias("way")))


def stream_join_state(spark, sf_dir):
    """By run of the two streams: rows that came past the watermark, and rows left in the state."""
    _, counts = _joined_streams(spark, sf_dir, data.Arrivals(spark, sf_dir))
    return spark.createDataFrame(counts, "run long, dropped long, held long")


def stored_revenue_rollup(spark, sf_dir):
    """The stored rollup after early facts, copies of some at the day before, late orders by reconcile, and
    the erasure of users, refreshed in between."""
    house = jobs.Warehouse(spark, run_dir(spark, "rollup"))
    tables.write_batch(data.enriched(spark, sf_dir), house.root, EVENTS_ENRICHED, "all")
    jobs.seed(house, data.product_tables(spark, sf_dir, late=False), data.financials(spark, sf_dir))
    jobs.denormalize_stored(house)
    rollup.refresh(house)
    copies = purchases.denormalize(
        data.enriched(spark, sf_dir), orders.product_orders_all(data.product_tables(spark, sf_dir, where="k = 50")),
        data.financials(spark, sf_dir)).withColumn("event_time", F.expr("event_time - INTERVAL 1 DAY"))
    tables.write_batch(copies, house.root, FACT_PURCHASES, "copies")
    rollup.refresh(house)
    jobs.seed_products(house, data.product_tables(spark, sf_dir), "late")
    ledger.reconcile_new(house)
    rollup.erase(house, _subjects(spark, sf_dir), "furniture")
    return rollup.revenue(house)


def users_after_changes(spark, sf_dir):
    return plain(versioning.apply_changes(
        data.users(spark, sf_dir), data.changes(spark, sf_dir), ["user_id"], "updated_at"))


# Aggregates and reports


def agg_daily(spark, sf_dir):
    return aggregates.daily_metrics(data.enriched(spark, sf_dir))


def agg_daily_sketch(spark, sf_dir):
    states = aggregates.daily_states(data.enriched(spark, sf_dir))
    return aggregates.finalize_states(states)


def agg_daily_purchases_by_channel(spark, sf_dir):
    return aggregates.purchases_by_day_and_channel(agg_daily(spark, sf_dir))


def report_table_counts(spark, sf_dir):
    """The plain counts of the report, one row per table."""
    counted = {"users": data.users, "events_enriched": data.enriched, "fact_purchases": data.facts}
    return reduce(DataFrame.unionByName, [
        reports.row_count(read(spark, sf_dir), "rows").select(F.lit(name).alias("name"), "rows")
        for name, read in counted.items()])


def report_enriched_profile(spark, sf_dir):
    return plain(reports.enriched_profile(data.enriched(spark, sf_dir), exact=True))


def report_coverage(spark, sf_dir):
    return reports.enrichment_coverage(data.enriched(spark, sf_dir))


def report_by_event_type(spark, sf_dir):
    return reports.by_event_type(agg_daily(spark, sf_dir))


def report_channels(spark, sf_dir):
    return reports.purchase_channels(agg_daily(spark, sf_dir))


def report_product_lines(spark, sf_dir):
    return reports.product_lines(data.facts(spark, sf_dir))


def revenue_by_line_day(spark, sf_dir):
    return plain(aggregates.revenue_by_line_and_day(data.facts(spark, sf_dir)))


def revenue_by_line_since(spark, sf_dir):
    return aggregates.revenue_by_line_since(data.facts(spark, sf_dir), SINCE)


def first_events(spark, sf_dir):
    return plain(reports.first_rows(data.enriched(spark, sf_dir), 5,
                                    ["event_time", "user_id", "session_id"]))


# Backfill


def backfill_window(spark, sf_dir):
    """One window of days from the landed events, where some were lost and some came twice."""
    return plain(backfill.enrich_window(data.landed_events(spark, sf_dir),
                                        data.users(spark, sf_dir), *WINDOW))


def backfill_counts(spark, sf_dir):
    """What a dry run of the same window reports."""
    found = data.landed_events(spark, sf_dir)
    return backfill.window_counts(found, backfill.enrich_window(
        found, data.users(spark, sf_dir), *WINDOW))


def backfill_reloaded(spark, sf_dir):
    """The backfill table after two overlapping loads."""
    root = run_dir(spark, "backfill")
    found, people = data.landed_events(spark, sf_dir), data.users(spark, sf_dir)
    for end, at in (("2024-01-10", "2024-02-01 00:00:00"), (WINDOW[1], "2024-02-02 00:00:00")):
        backfill.load_window(backfill.enrich_window(found, people, WINDOW[0], end), root,
                             f"until-{end}", at)
    return plain(backfill.read_backfill(spark, root))


# Governance


def purchases_masked(spark, sf_dir):
    return plain(governance.masked_purchases(data.facts(spark, sf_dir)))


def purchases_region(spark, sf_dir):
    return plain(governance.restrict(data.facts(spark, sf_dir), city=REGION))


def audience_tables(spark, sf_dir):
    """What each audience sees of a region: tables, their columns and rows."""
    known = {"events_agg_daily_v": agg_daily(spark, sf_dir),
             "fact_purchases": data.facts(spark, sf_dir),
             "events_enriched": data.enriched(spark, sf_dir),
             "financial_order": data.financials(spark, sf_dir)}
    parts = []
    for audience in governance.AUDIENCES:
        for name, df in governance.tables_for(audience, known, city=REGION).items():
            parts.append(reports.row_count(df, "rows").select(
                F.lit(audience).alias("audience"), F.lit(name).alias("name"),
                F.lit(len(df.columns)).cast("bigint").alias("n_columns"), "rows"))
    return reduce(DataFrame.unionByName, parts)


def retained_events(spark, sf_dir):
    return plain(governance.retained(data.enriched(spark, sf_dir), RETENTION_AS_OF))


def stored_events_after_retention(spark, sf_dir):
    """Retention applied to the stored table."""
    root = run_dir(spark, "retention")
    tables.write_batch(data.enriched(spark, sf_dir), root, EVENTS_ENRICHED, "all")
    tables.drop_expired(spark, root, EVENTS_ENRICHED, RETENTION_AS_OF)
    return plain(tables.read_table(spark, root, EVENTS_ENRICHED))


def _subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users who ask to be erased: those of one market segment."""
    return data.customers(spark, sf_dir).filter("c_mktsegment = 'FURNITURE'").select("user_id")


def events_after_erasure(spark, sf_dir):
    return plain(governance.erased(data.enriched(spark, sf_dir), _subjects(spark, sf_dir)))


def stored_events_after_erasure(spark, sf_dir):
    """Erasure applied to the stored table."""
    root = run_dir(spark, "erasure")
    tables.write_batch(data.enriched(spark, sf_dir), root, EVENTS_ENRICHED, "all")
    tables.erase_subjects(spark, root, EVENTS_ENRICHED, _subjects(spark, sf_dir))
    return plain(tables.read_table(spark, root, EVENTS_ENRICHED))


# Quality and monitoring


def _checks(spark: SparkSession, sf_dir: str):
    events = data.landed(spark, sf_dir)
    expected = data.table(spark, sf_dir, "events").count()
    return quality.checks(events, data.facts(spark, sf_dir),
                          monitoring.partition_progress(events), expected, AS_OF)


def dq_report(spark, sf_dir):
    """The ten checks on landed events, whose lost and doubled messages they have to find."""
    return quality.report(_checks(spark, sf_dir))


def dq_gate(spark, sf_dir):
    """The gate over the same report."""
    return quality.gate(dq_report(spark, sf_dir))


def duplicate_count(spark, sf_dir):
    """Doubled messages among the landed events."""
    return quality.duplicate_count(data.landed(spark, sf_dir))


def offset_ranges(spark, sf_dir):
    """Expected and landed offsets; lost messages show as their difference."""
    return monitoring.offset_ranges(data.landed(spark, sf_dir))


def ingest_lag(spark, sf_dir):
    profile = quality.event_profile(data.enriched(spark, sf_dir))
    return quality.lag_percentiles(profile)


def consumer_progress(spark, sf_dir):
    """Messages that landed, by partition."""
    return monitoring.partition_progress(data.landed_events(spark, sf_dir))


def offset_gaps(spark, sf_dir):
    """The offsets of lost messages."""
    return monitoring.missing_offsets(data.landed_events(spark, sf_dir))


def partition_lag(spark, sf_dir):
    """A consumer that stopped on 2024-01-29, which the check has to find, against all events."""
    source = data.events(spark, sf_dir)
    latest = source.groupBy("kafka_partition").agg(F.max("kafka_offset").alias("latest_offset"))
    behind = source.filter(F.col("event_time") < moment("2024-01-29 00:00:00"))
    return monitoring.partition_lag(latest, monitoring.partition_progress(behind), LAG_THRESHOLD)


def hourly_anomaly(spark, sf_dir):
    return plain(monitoring.volume_anomalies(data.events(spark, sf_dir)))


def daily_gap_counts(spark, sf_dir):
    """Events sent against events landed, by day."""
    return monitoring.daily_gaps(monitoring.daily_counts(data.events(spark, sf_dir)),
                                 monitoring.daily_counts(data.landed_events(spark, sf_dir)))


def purchases_without_fact(spark, sf_dir):
    """Purchases whose order was late when facts were made."""
    missing = purchases.purchases_without_fact(data.enriched(spark, sf_dir),
                                               data.facts(spark, sf_dir, late=False))
    return plain(missing)


def field_drift(spark, sf_dir):
    return monitoring.field_drift(data.messages(data.events(spark, sf_dir)))


# Streams


def dead_letters(spark, sf_dir):
    parsed = records.parse_records(data.messages(data.events(spark, sf_dir)))
    return plain(records.dead_letters(parsed))


def parsed_events(spark, sf_dir):
    parsed = records.parse_records(data.messages(data.events(spark, sf_dir)))
    return plain(records.good_events(parsed))


def _record_stream(spark: SparkSession, sf_dir: str, batches: int = 1) -> DataFrame:
    return data.messages(data.events_from(data.event_stream(spark, sf_dir, batches)))


def _live(spark: SparkSession, sf_dir: str, with_facts: bool = False,
          batches: int = 1, in_buckets: bool = False, lag_sketches: bool = False) -> jobs.Warehouse:
    """A warehouse filled by the live pipeline from the event stream."""
    house = jobs.Warehouse(spark, run_dir(spark, "live"))
    pipeline = live.LivePipeline(house.root, live.Refreshed(lambda: data.users(spark, sf_dir)),
                                 ingested_at=lambda: AS_OF, lag_sketches=lag_sketches)
    if with_facts:
        jobs.seed(house, data.product_tables(spark, sf_dir, late=False), data.financials(spark, sf_dir))
        pipeline.products, pipeline.financials = house.product_tables, house.financials
    if in_buckets:
        pipeline.order_buckets = buckets.OrderBuckets(house.root)
        pipeline.order_buckets.add(orders.product_orders_all(house.product_tables(), collapse=False))
    query = pipeline.start(_record_stream(spark, sf_dir, batches), run_dir(spark, "checkpoint"))
    live.wait(query, 1800)
    return house


def stream_enriched(spark, sf_dir):
    return plain(_live(spark, sf_dir).events())


def stream_agg_daily(spark, sf_dir):
    """Daily metrics merged from the states of three micro-batches."""
    return _live(spark, sf_dir, batches=3).daily()


def stream_agg_daily_compacted(spark, sf_dir):
    """The same, after the three batches' files were folded in place, states merged."""
    house = _live(spark, sf_dir, batches=3)
    jobs.compact(house, EVENTS_AGG_DAILY, [202401], merge=aggregates.merge_states)
    return house.daily()


def stream_facts(spark, sf_dir):
    """Facts of purchases that come in three micro-batches, of stored orders."""
    return plain(_live(spark, sf_dir, with_facts=True, batches=3).facts())


def stream_lag_quantiles(spark, sf_dir):
    """Lags of three micro-batches by type, from their sketches: whether each quantile's true rank is within
    two hundredths of the asked one."""
    house = _live(spark, sf_dir, batches=3, lag_sketches=True)
    found = aggregates.lag_quantiles(tables.read_table(spark, house.root, LAG_STATES))
    names = aggregates.LAG_SHARES
    ranks = house.events().join(F.broadcast(found), "event_type").groupBy(
        "event_type", "n", "max_lag").agg(F.count(F.lit(1)).alias("events"), *[
            F.avg((F.col("ingest_lag_sec") <= F.col(name)).cast("int")).alias(name) for name in names])
    return ranks.select("event_type", "n", "max_lag", "events", *[
        (F.abs(F.col(name) - share) <= 0.02).alias(name) for name, share in names.items()])


def _redelivered(spark: SparkSession, sf_dir: str, run: int) -> DataFrame:
    """Messages of one run: those of its part of the month; those with k of 50 twice; again, with later
    times, those with 51 from the part before and those with 52 from the part before that."""
    sent = data.events(spark, sf_dir)

    def again(k: int, parts: int) -> DataFrame:
        return sent.where(f"k = {k} and {data.part_of('event_time')} = {run - parts}").withColumn(
            "kafka_timestamp", F.expr(f"kafka_timestamp + INTERVAL {10 * parts} DAY"))

    return data.messages(reduce(DataFrame.unionByName, [
        sent.where(_part(run)), again(50, 0), again(51, 1), again(52, 2)]))


def stream_without_copies(spark, sf_dir):
    """Events of a stream whose messages come again: in the same batch, in the next, and after the time
    for which it is known that they came, when they are taken in once more."""
    house = jobs.Warehouse(spark, run_dir(spark, "copies"))
    pipeline = live.LivePipeline(house.root, live.Refreshed(lambda: data.users(spark, sf_dir)),
                                 ingested_at=lambda: AS_OF, redelivery="5 days")
    landing, checkpoint = run_dir(spark, "landing"), run_dir(spark, "checkpoint")
    for run in data.RUNS:
        came = _redelivered(spark, sf_dir, run)
        joined.append(came, landing)
        live.wait(pipeline.start(joined.folder_stream(spark, came, landing), checkpoint), 1800)
    return plain(house.events())


def stream_facts_in_buckets(spark, sf_dir):
    """The same facts, with the orders in hash buckets by session."""
    return plain(_live(spark, sf_dir, with_facts=True, batches=3, in_buckets=True).facts())


def _raw_sink(spark: SparkSession, sf_dir: str) -> str:
    root = run_dir(spark, "raw")
    live.wait(live.start_raw_sink(_record_stream(spark, sf_dir), root,
                                  run_dir(spark, "checkpoint")), 1800)
    return root


def stream_raw_sink(spark, sf_dir):
    return plain(tables.read_table(spark, _raw_sink(spark, sf_dir), USER_EVENTS))


def raw_sink_dead_letters(spark, sf_dir):
    return plain(tables.read_table(spark, _raw_sink(spark, sf_dir), DEAD_LETTERS))


def consumer_totals(spark, sf_dir):
    """What the raw sink has read, by partition, good or not."""
    return live.consumer_totals(spark, _raw_sink(spark, sf_dir)).select(
        "topic", F.col("partition").cast("bigint").alias("partition"), "num_messages_read",
        "last_offset")


def stream_progress(spark, sf_dir):
    """Rows by micro-batch as the engine tells them, against what the batches counted themselves."""
    root = run_dir(spark, "progress")
    log = progress.ProgressLog().attach(spark)
    try:
        log.wait(live.start_raw_sink(_record_stream(spark, sf_dir, 3), root, run_dir(spark, "checkpoint")), 1800)
    finally:
        spark.streams.removeListener(log)
    log.store(spark, root)
    told = progress.batch_progress(spark, root).where("input_rows > 0").agg(
        F.count(F.lit(1)).alias("batches"), F.sum("input_rows").alias("input_rows"))
    counted = live.consumer_totals(spark, root).agg(F.sum("num_messages_read").alias("counted_rows"))
    return told.join(F.broadcast(counted))


def stream_two_runs(spark, sf_dir):
    """Two streams with checkpoints of their own into one warehouse: partitions with an even number,
    then the others. Neither may touch what the other wrote."""
    house = jobs.Warehouse(spark, run_dir(spark, "two-runs"))
    for rest in (0, 1):
        pipeline = live.LivePipeline(house.root, live.Refreshed(lambda: data.users(spark, sf_dir)),
                                     ingested_at=lambda: AS_OF)
        part = _record_stream(spark, sf_dir).where(F.col("partition") % 2 == rest)
        live.wait(pipeline.start(part, run_dir(spark, "checkpoint")), 1800)
    return plain(house.events())


def change_log_dead_letters(spark, sf_dir):
    """Errors of the users change stream. Messages of user numbers that end in 3 have a broken
    number, of those that end in 7 a broken time."""
    sent = data.changes(spark, sf_dir).select(
        F.lit("k").alias("key"), F.to_json(F.struct(
            F.when(F.col("user_id") % 10 == 3, F.concat(F.lit("u"), "user_id")).otherwise(
                F.col("user_id").cast("string")).alias("user_id"),
            F.date_format("signup_date", "yyyy-MM-dd").alias("signup_date"), "city", "device_type",
            F.when(F.col("user_id") % 10 == 7, "soon").otherwise(
                F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss")).alias("updated_at"),
            F.col("_deleted").cast("string").alias("__deleted"))).alias("value"),
        F.lit("users").alias("topic"), F.lit(0).alias("partition"),
        F.col("user_id").alias("offset"), F.lit(None).cast("timestamp").alias("timestamp"))
    return records.change_dead_letters(sent).select("offset", "error")


def stream_after_user_refresh(spark, sf_dir):
    """Events of one stream in two runs, between which users move, come and go; the lookup is read again."""
    house = jobs.Warehouse(spark, run_dir(spark, "refresh"))
    people = [data.users(spark, sf_dir), versioning.apply_changes(
        data.users(spark, sf_dir), data.changes(spark, sf_dir), ["user_id"], "updated_at")]
    pipeline = live.LivePipeline(house.root, live.Refreshed(lambda: people[0], seconds=0),
                                 ingested_at=lambda: AS_OF)
    landing, checkpoint = run_dir(spark, "landing"), run_dir(spark, "checkpoint")
    for run in (1, 2):
        came = data.messages(data.events(spark, sf_dir).where(
            _part(1) if run == 1 else f"{data.part_of('event_time')} > 1"))
        joined.append(came, landing)
        live.wait(pipeline.start(joined.folder_stream(spark, came, landing), checkpoint), 1800)
        people.reverse()
    return plain(house.events())


# Chained jobs


def _seeded(spark: SparkSession, sf_dir: str, name: str, late: bool = True) -> jobs.Warehouse:
    """A warehouse with users and order tables."""
    house = jobs.Warehouse(spark, run_dir(spark, name))
    tables.write_batch(data.users(spark, sf_dir), house.root, USERS, "base")
    jobs.seed(house, data.product_tables(spark, sf_dir, late), data.financials(spark, sf_dir))
    return house


def _gate_rows(spark: SparkSession, result: quality.GateResult) -> DataFrame:
    return spark.createDataFrame(result.rows, "check_name string, status string, metric string")


def full_run_report(spark, sf_dir):
    """The product lines of the report after a full run: reset, seed, ingest, reconcile, verify."""
    house = _seeded(spark, sf_dir, "full")
    tables.write_batch(data.enriched(spark, sf_dir), house.root, EVENTS_ENRICHED, "before-the-reset")
    report = jobs.full_run(house, data.product_tables(spark, sf_dir), data.financials(spark, sf_dir),
                           _record_stream(spark, sf_dir), run_dir(spark, "checkpoint"), 1800, AS_OF)
    return report["fact_product_lines"]


def ingest_cycle_gate(spark, sf_dir):
    """The gate after an ingest cycle whose stream brings all events, though some orders only come with the
    next cycle."""
    house = _seeded(spark, sf_dir, "cycle", late=False)
    expected = data.table(spark, sf_dir, "events").count()
    return _gate_rows(spark, jobs.ingest_cycle(
        house, _record_stream(spark, sf_dir), run_dir(spark, "checkpoint"), expected, 1800, AS_OF))


def monitoring_gate(spark, sf_dir):
    """The gate of the monitoring job over stored events, once late orders have come and been reconciled."""
    house = _seeded(spark, sf_dir, "monitoring", late=False)
    tables.write_batch(data.landed(spark, sf_dir), house.root, EVENTS_ENRICHED, "all")
    expected = data.table(spark, sf_dir, "events").count()
    jobs.monitoring(house, expected, AS_OF)
    jobs.seed_products(house, data.product_tables(spark, sf_dir, where="k < 4"), "late")
    return _gate_rows(spark, jobs.monitoring(house, expected, AS_OF))


def truncated_tables(spark, sf_dir):
    """Rows by table after all data tables were emptied; the users stay, and a table takes rows again."""
    house = _seeded(spark, sf_dir, "truncate")
    tables.write_batch(data.enriched(spark, sf_dir), house.root, EVENTS_ENRICHED, "all")
    jobs.denormalize_stored(house)
    jobs.reset(house)
    tables.write_batch(data.financials(spark, sf_dir), house.root, FINANCIAL_ORDER, "again")
    counted = {"users": house.users(), "events_enriched": house.events(), "fact_purchases": house.facts(),
               "product_orders": house.orders(), "financial_order": house.financials()}
    return reduce(DataFrame.unionByName, [
        reports.row_count(df, "rows").select(F.lit(name).alias("name"), "rows") for name, df in counted.items()])


def users_from_change_stream(spark, sf_dir):
    """Users by the raw change stream: moves in a first run, folded into the buckets that changed; then
    additions, and removals with the tombstone that follows each."""
    store = users.UserStore(spark, run_dir(spark, "users"), buckets=16)
    store.load(data.users(spark, sf_dir))
    log = data.changes(spark, sf_dir)
    sent = log.select(
        F.col("user_id").cast("string").alias("key"), F.to_json(F.struct(
            "user_id", F.date_format("signup_date", "yyyy-MM-dd").alias("signup_date"), "city", "device_type",
            F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss").alias("updated_at"),
            F.col("_deleted").cast("string").alias("__deleted"))).alias("value"),
        F.lit("users").alias("topic"), F.lit(0).alias("partition"), (F.col("_position") * 2).alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"), "_deleted", "city")
    moved = F.col("city").startswith("NEW-")
    tombstones = sent.where("_deleted").withColumns({
        "value": F.lit(None).cast("string"), "offset": F.col("offset") + 1})
    landing, checkpoint = run_dir(spark, "landing"), run_dir(spark, "checkpoint")
    for came in (sent.where(moved), sent.where(~moved).unionByName(tombstones)):
        came = came.drop("_deleted", "city")
        joined.append(came, landing)
        live.wait(store.start(joined.folder_stream(spark, came, landing), checkpoint), 1800)
        store.fold()
        store.sweep()
    return plain(store.current())


def stored_user_changes(spark, sf_dir):
    """Users read through a stored change log."""
    root = run_dir(spark, "changes")
    tables.write_batch(data.users(spark, sf_dir), root, changes.USERS, "base")
    tables.write_batch(data.changes(spark, sf_dir), root, changes.USER_CHANGES, "0")
    return plain(changes.current_users(spark, root))


_GROUPS: Sequence[Query] = (
    typed_events, enriched_events, loaded_users, published_messages, first_published_messages,
    csv_round_trip,
    expected_source_rows, users_from_csv, appended_csv, sessions_by_bloom_filter,
    stored_events_in_range,
    order_split_counts, order_pricing, product_orders_all, orders_latest_version,
    fact_purchases, fact_purchases_all_matches, visit_facts, visit_matches, reconcile_missing, late_order_cycle,
    facts_by_ledger, stored_revenue_rollup,
    users_after_changes,
    agg_daily, agg_daily_sketch, agg_daily_purchases_by_channel, report_table_counts,
    report_enriched_profile, report_coverage, report_by_event_type, report_channels,
    report_product_lines, revenue_by_line_day, revenue_by_line_since, first_events,
    backfill_window, backfill_counts, backfill_reloaded,
    purchases_masked, purchases_region, audience_tables, retained_events,
    stored_events_after_retention, events_after_erasure, stored_events_after_erasure,
    dq_report, dq_gate, duplicate_count, offset_ranges, ingest_lag, consumer_progress,
    offset_gaps, partition_lag, hourly_anomaly, daily_gap_counts, purchases_without_fact,
    field_drift,
    dead_letters, parsed_events, stream_enriched, stream_agg_daily, stream_agg_daily_compacted,
    stream_facts,
    stream_facts_in_buckets, stream_raw_sink, raw_sink_dead_letters, consumer_totals, stream_two_runs,
    stored_user_changes, change_log_dead_letters, stream_joined_facts, stream_join_state,
    stream_lag_quantiles, stream_without_copies, stream_after_user_refresh, users_from_change_stream,
    stream_progress, full_run_report, ingest_cycle_gate, monitoring_gate, truncated_tables,
)

QUERIES: dict[str, Query] = {query.__name__: query for query in _GROUPS}
