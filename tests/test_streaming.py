"""Streams over files stand in for topics: the envelope's columns are the same."""

import json
from datetime import datetime
from pathlib import Path

import helpers as h
import pytest

from eventmart.operators.aggregates import daily_metrics, finalize_states
from eventmart.operators.enrich import enrich
from eventmart.operators.versioning import one_row_per_order
from eventmart.plans import jobs
from eventmart.schemas import (
    DEAD_LETTERS, ENVELOPE, EVENTS_AGG_DAILY, EVENTS_ENRICHED, FACT_PURCHASES, USER_EVENTS, USERS)
from eventmart.sources.tables import read_table, write_batch
from eventmart.streaming import changes, live
from eventmart.streaming.records import dead_letters, good_events, parse_records

NOW = "2025-10-01 12:00:00"


def message(user=1, session="s1", kind="purchase", when="2025-10-01 10:00:00", premium=100.0,
            **extra):
    return json.dumps({"event_time": when, "user_id": user, "session_id": session,
                       "event_type": kind, "channel": "web", "premium_amount": premium, **extra})


def records(spark, *values, start=0):
    return spark.createDataFrame(
        [("k", v, "user_events", 0, start + i, datetime(2025, 10, 1, 10)) for i, v in
         enumerate(values)], ENVELOPE)


def test_good_and_bad_records_part(spark):
    parsed = parse_records(records(
        spark, message(), '{"event_time": "2025-', message(user="7"), message(new_field=1),
        None, message(user="seven"), message(premium="much"), message(when="today"), "",
        '{"user_id": 3}', message(premium=None)))
    good = {r.kafka_offset: r for r in good_events(parsed).collect()}
    bad = {r.offset: r.error for r in dead_letters(parsed).collect()}
    assert set(good) == {0, 2, 3, 10}
    assert good[2].user_id == 7 and good[10].premium_amount is None
    assert set(bad) == {1, 4, 5, 6, 7, 8, 9}
    assert bad[1] == "malformed message" and bad[4] == "no value"
    assert bad[5] == "user_id: seven" and bad[6] == "premium_amount: much"
    assert bad[7] == "event_time: today"
    assert bad[9] == "event_time: missing; event_type: missing"
    row = dead_letters(parsed).filter("offset = 5").first()
    assert (row.topic, row.partition, json.loads(row.value)["user_id"]) == (
        "user_events", 0, "seven")


class Source:
    """A folder of record files, read as a stream."""

    def __init__(self, spark, path):
        self.spark, self.path = spark, str(path / "in")
        self.checkpoint = str(path / "checkpoint")

    def add(self, frame):
        frame.coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        return (self.spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", 1)
                .parquet(self.path))


@pytest.fixture
def source(spark, tmp_path):
    return Source(spark, tmp_path)


@pytest.fixture
def pipeline(spark, tmp_path):
    people = h.users(spark, (1, "Rome", "ios"), (2, "Bari", "web"))
    return live.LivePipeline(
        str(tmp_path / "house"), live.Refreshed(lambda: people),
        lambda: h.tables(spark, h.third(1, 1, "s1"), h.third(2, 2, "s2")),
        lambda: h.financials(spark, h.payment(1)), lambda: NOW)


def run(pipeline, source):
    live.wait(pipeline.start(source.stream(), source.checkpoint), 300)


def contents(spark, pipeline):
    return {t.name: sorted(map(str, read_table(spark, pipeline.root, t).drop("unique_users")
                               .collect()))
            for t in (DEAD_LETTERS, EVENTS_ENRICHED, EVENTS_AGG_DAILY, FACT_PURCHASES)}


def test_stream_equals_batch_and_repeats_change_nothing(spark, rows, source, pipeline):
    first = records(spark, message(), message(2, "s2"), "broken")
    second = records(spark, message(3, "s3", "view", premium=None), message(1, "s1", "view"),
                     start=3)
    source.add(first)
    source.add(second)
    run(pipeline, source)
    house = pipeline.root
    batch = enrich(good_events(parse_records(first.unionByName(second))),
                   pipeline.users.load(), NOW)
    stored = read_table(spark, house, EVENTS_ENRICHED)
    assert rows(stored) == rows(batch)
    states = read_table(spark, house, EVENTS_AGG_DAILY)
    assert rows(finalize_states(states)) == rows(daily_metrics(batch))
    facts = read_table(spark, house, FACT_PURCHASES)
    assert rows(one_row_per_order(facts), "order_id", "net_amount") == [(1, 90.0), (2, 0.0)]
    assert read_table(spark, house, DEAD_LETTERS).count() == 1

    before = contents(spark, pipeline)
    run(pipeline, source)
    assert contents(spark, pipeline) == before
    # The first batch again, as after a failure before its commit.
    label = next(p.name for p in Path(house, "events_enriched").glob("batch=*-0")).split("=")[1]
    batches = [f for f in (first, second)
               if f.count() == stored_rows_of_batch(spark, house, label)]
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", label.removesuffix("-0"))
    try:
        pipeline.process(batches[0], 0)
    finally:
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)
    assert contents(spark, pipeline) == before


def stored_rows_of_batch(spark, house, label):
    found = spark.read.parquet(f"{house}/events_enriched/batch={label}").count()
    return found + spark.read.schema(DEAD_LETTERS.schema).parquet(
        f"{house}/dead_letters/batch={label}").count()


def test_lookups_are_read_again_after_their_time(spark):
    clock, loads = [0.0], []

    def load():
        loads.append(1)
        return h.users(spark, (1, f"city{len(loads)}", "ios"))
    users = live.Refreshed(load, 300, lambda: clock[0])
    assert users.get()[0].first().city == "city1"
    clock[0] = 299
    assert users.get()[0].first().city == "city1"
    clock[0] = 300
    assert users.get()[0].first().city == "city2"
    assert users.get()[1] is True


def test_another_checkpoint_adds_and_a_repeat_replaces(spark, rows, source, pipeline, tmp_path):
    source.add(records(spark, message(), message(2, "s2"), "broken"))
    run(pipeline, source)
    other = Source(spark, tmp_path / "other")
    other.add(records(spark, message(3, "s3"), message(4, "s4"), "broken too", start=3))
    for _ in range(2):
        run(pipeline, other)
    stored = read_table(spark, pipeline.root, EVENTS_ENRICHED)
    assert rows(stored, "user_id") == [(1,), (2,), (3,), (4,)]
    assert read_table(spark, pipeline.root, DEAD_LETTERS).count() == 2
    total = live.consumer_totals(spark, pipeline.root).first()
    assert (total.num_messages_read, total.last_offset) == (6, 5)


def test_batch_without_events(spark, pipeline):
    pipeline.process(records(spark, "broken"), 0)
    assert read_table(spark, pipeline.root, EVENTS_ENRICHED).count() == 0
    assert read_table(spark, pipeline.root, FACT_PURCHASES).count() == 0


def test_wait_stops_and_raises_when_time_is_up(spark, source, pipeline):
    source.add(records(spark, message()))
    query = pipeline.start(source.stream(), source.checkpoint, every="1 second", name="slow")
    with pytest.raises(TimeoutError):
        live.wait(query, 1)
    assert not query.isActive


def test_raw_sink_adds_each_record_once_and_keeps_bad_ones(spark, rows, source, tmp_path):
    out = str(tmp_path / "raw")
    source.add(records(spark, message(), "broken", message(2)))
    for _ in range(2):
        live.wait(live.start_raw_sink(source.stream(), out, source.checkpoint), 120)
    assert rows(read_table(spark, out, USER_EVENTS), "user_id") == [(1,), (2,)]
    assert rows(read_table(spark, out, DEAD_LETTERS), "value", "error") == [
        ("broken", "malformed message")]


def test_consumer_totals_count_every_batch(spark, source, tmp_path):
    out = str(tmp_path / "raw")
    for i in range(4):
        source.add(records(spark, message(), start=i))
    live.wait(live.start_raw_sink(source.stream(), out, source.checkpoint), 120)
    got = live.consumer_totals(spark, out).collect()
    assert [(r.topic, r.partition, r.num_messages_read, r.last_offset) for r in got] == [
        ("user_events", 0, 4, 3)]


def test_unreadable_changes_become_dead_letters(spark, source, tmp_path):
    house = str(tmp_path / "house")
    source.add(records(spark, change(1, "Milan", "2025-01-01T00:00:00Z"), "{broken", None,
                       change("x9", "Milan", "2025-01-01T00:00:00Z"), change(2, "Bari", "soon")))
    live.wait(changes.start_change_log(source.stream(), house, source.checkpoint), 120)
    assert read_table(spark, house, changes.USER_CHANGES).count() == 1
    bad = {r.offset: r.error for r in read_table(spark, house, DEAD_LETTERS).collect()}
    assert bad == {1: "malformed message", 3: "user_id: x9", 4: "updated_at: soon"}


def change(user, city, when, deleted="false"):
    return json.dumps({"user_id": user, "signup_date": 19723, "city": city, "device_type": "ios",
                       "updated_at": when, "__deleted": deleted})


def test_user_changes_from_a_stream(spark, rows, source, tmp_path):
    house = str(tmp_path / "house")
    write_batch(h.users(spark, (1, "Rome", "ios"), (2, "Rome", "ios")), house, USERS, "base")
    source.add(records(spark, change(1, "Milan", "2025-01-01T00:00:00Z"),
                       change(2, "Rome", "2024-01-01T00:00:00Z", "true"), None,
                       change(3, "Turin", "2025-01-01T00:00:00Z")))
    for _ in range(2):
        live.wait(changes.start_change_log(source.stream(), house, source.checkpoint), 120)
    assert rows(changes.current_users(spark, house), "user_id", "city") == [
        (1, "Milan"), (3, "Turin")]
    assert str(changes.current_users(spark, house).first().signup_date) == "2024-01-01"
    assert jobs.Warehouse(spark, house, change_log=True).users().count() == 2
    changes.fold(spark, house, str(tmp_path / "new"))
    assert rows(read_table(spark, str(tmp_path / "new"), USERS), "user_id") == [(1,), (3,)]


def test_redelivered_messages_come_in_once(spark, source, pipeline, rows):
    """Copies in one batch, in another, and after the event is forgotten; bad records all stay."""
    def sent(value, offset, when):
        return ("k", value, "user_events", 0, offset, datetime(2025, 10, *when))

    def run(*records):
        source.add(spark.createDataFrame(list(records), ENVELOPE))
        live.wait(pipeline.start(spark.readStream.schema(ENVELOPE).parquet(source.path), source.checkpoint), 120)
        return rows(read_table(spark, pipeline.root, EVENTS_ENRICHED), "kafka_offset")

    pipeline.products = None
    pipeline.redelivery = "2 hours"
    one, two = message(1, "s1"), message(2, "s2")
    assert run(sent(one, 0, (1, 10)), sent(one, 0, (1, 10)), sent("bad", 1, (1, 10)), sent("bad", 2, (1, 10))) == [(0,)]
    assert run(sent(one, 3, (1, 11)), sent(two, 4, (1, 12))) == [(0,), (4,)]
    # The watermark stands at 10 of the second now: the first event is forgotten.
    run(sent(message(3, "s3"), 5, (2, 12)))
    assert run(sent(one, 6, (2, 13))) == [(0,), (4,), (5,), (6,)]
    assert rows(read_table(spark, pipeline.root, DEAD_LETTERS), "offset") == [(1,), (2,)]


def test_user_store_folds_single_buckets(spark, rows, tmp_path):
    from eventmart.streaming.users import FOLDED, UserStore

    def changed(*found):
        return spark.createDataFrame([
            (u, None, city, "ios", h.at(when), position, gone) for u, city, when, position, gone in found],
            changes.USER_CHANGES.schema)

    store = UserStore(spark, str(tmp_path), buckets=4)
    assert store.current().collect() == []
    store.load(h.users(spark, *[(u, "Rome", "ios") for u in range(1, 21)]))
    store.add(changed((1, "Bari", "2025-01-01 00:00:00", 1, False), (2, "Rome", "2024-01-01 00:00:00", 2, True),
                      (30, "Pisa", "2025-01-01 00:00:00", 3, False)), "a")
    wanted = sorted([(1, "Bari"), (30, "Pisa"), *[(u, "Rome") for u in range(3, 21)]], key=lambda r: [str(v) for v in r])
    assert rows(store.current(), "user_id", "city") == wanted
    kept = {f: f.stat().st_mtime_ns for f in Path(tmp_path, "users_base").rglob("*.parquet")}
    chosen = store.fold()
    assert 0 < len(chosen) < 4 and rows(store.current(), "user_id", "city") == wanted
    # A change older than what is folded changes nothing; a newer one does.
    store.add(changed((1, "Lodi", "2024-06-01 00:00:00", 4, False)), "b")
    assert rows(store.current(), "user_id", "city") == wanted
    assert store.sweep() > 0 and rows(store.current(), "user_id", "city") == wanted
    assert all(f.stat().st_mtime_ns == t for f, t in kept.items() if f.exists()) and any(f.exists() for f in kept)
    assert store.fold(least_share=0.9) == [] and store.sweep() == 0
    store.add(changed((2, "Nola", "2025-06-01 00:00:00", 5, False)), "c")
    assert (2, "Nola") in rows(store.current(), "user_id", "city")
    # A fold that is cut off after its list is written counts for nothing, and is done again.
    write_batch(spark.createDataFrame([(0, "c"), (1, "c"), (2, "c"), (3, "c")], FOLDED.schema), store.root, FOLDED, "fold-00000002")
    assert (2, "Nola") in rows(store.current(), "user_id", "city")
    before = rows(store.current(), "user_id", "city")
    store.fold()
    assert rows(store.current(), "user_id", "city") == before == rows(
        UserStore(spark, store.root, 4, max_bytes=0).current(), "user_id", "city")


def test_progress_rows_give_totals_and_lag(spark, rows, source, tmp_path):
    from eventmart.schemas import PROGRESS
    from eventmart.streaming import progress

    house, log = str(tmp_path / "house"), progress.ProgressLog().attach(spark)
    try:
        source.add(records(spark, message(1), message(2)))
        source.add(records(spark, message(3), "bad", message(4)))
        log.wait(live.start_raw_sink(source.stream(), house, source.checkpoint), 120)
    finally:
        spark.streams.removeListener(log)
    assert log.store(spark, house) >= 2 and log.store(spark, house) == 0
    assert sorted(n for n, in rows(progress.batch_progress(spark, house), "input_rows") if n) == [2, 3]
    assert live.consumer_totals(spark, house).first().num_messages_read == 5
    # Topics, as their source tells them: a batch told twice, a partition that lags, a source without offsets.
    told = spark.createDataFrame([
        ("q", 0, 0, "1", "t", 5, '{"events":{"0":5,"1":2}}', '{"events":{"0":9,"1":2}}'),
        ("q", 1, 0, "2", "t", 2, '{"events":{"0":7,"1":2}}', '{"events":{"0":9,"1":4}}'),
        ("q", 1, 0, "3", "t", 2, '{"events":{"0":7,"1":3}}', '{"events":{"0":9,"1":4}}'),
        ("f", 0, 0, "1", "file", 3, '{"logOffset":0}', None)], PROGRESS.schema)
    assert rows(progress.topic_lag(told), "query", "topic", "partition", "end_offset", "latest_offset", "lag") == [
        ("q", "events", 0, 7, 9, 2), ("q", "events", 1, 3, 4, 1)]
