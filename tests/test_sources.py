import glob
from datetime import datetime
from pathlib import Path

import helpers as h
import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from eventmart.operators.aggregates import daily_states, finalize_states, merge_states
from eventmart.schemas import (
    BODY_ORDER, EVENTS_AGG_DAILY, EVENTS_ENRICHED, THIRD_ORDER, USER_EVENTS)
from eventmart.session import run_dir, shared_dir
from eventmart.sources import files, jdbc, kafka, tables


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "house")


MONTHS = [h.event(1, "s1", when="2025-09-30 23:59:59", offset=0),
          h.event(2, "s2", when="2025-10-01 00:00:00", offset=1),
          h.event(3, "s3", when="2025-10-31 12:00:00", offset=2),
          h.event(2, "s4", when="2025-11-05 12:00:00", offset=3)]


def test_csv_events_and_users(spark, tmp_path):
    (tmp_path / "e.csv").write_text(
        "event_time,user_id,session_id,event_type,channel,premium_amount\n"
        "2025-10-01 10:00:00,1,s1,purchase,web,100.5\n2025-10-01 10:00:00,2,s2,view,app,\n")
    (tmp_path / "u.csv").write_text("user_id,signup_date,city,device_type\n1,2024-01-01,Rome,ios\n")
    got = [(r.user_id, r.premium_amount)
           for r in files.read_events(spark, str(tmp_path / "e.csv")).collect()]
    assert got == [(1, 100.5), (2, None)]
    assert files.read_users(spark, str(tmp_path / "u.csv")).first().city == "Rome"
    assert files.expected_rows(spark, str(tmp_path / "e.csv")) == 2
    with pytest.raises(AnalysisException):
        files.expected_rows(spark, str(tmp_path / "none.csv"))
    assert files.expected_rows(spark, str(tmp_path / "none.csv"), default=7) == 7


def test_staged_csv_has_a_header_and_one_file_if_asked(spark, tmp_path):
    out = str(tmp_path / "out")
    files.stage_csv(spark.range(10).repartition(3), out, single_file=True)
    parts = glob.glob(f"{out}/part-*.csv")
    assert len(parts) == 1
    assert open(parts[0]).readline() == "id\n"


def test_database_reader_splits_the_users(spark):
    options = jdbc.users_options("jdbc:mysql://db/shop", "u", "p", 1, 1001, 8)
    assert (options["partitionColumn"], options["lowerBound"], options["upperBound"],
            options["numPartitions"], options["dbtable"]) == ("user_id", "1", "1001", "8", "users")


def test_stream_reader_options():
    options = kafka.stream_options("b:9092", "user_events", min_partitions=64)
    assert options["subscribe"] == "user_events"
    assert options["maxOffsetsPerTrigger"] == "1048576"
    assert options["minPartitions"] == "64"


def test_messages_are_keyed_and_capped_in_time_order(spark, rows):
    events = h.events(spark, h.event(1, when="2025-10-02 10:00:00"), h.event(2), h.event(3))
    assert rows(kafka.keyed_messages(events), "key") == [("1",), ("2",), ("3",)]
    assert rows(kafka.keyed_messages(events, 2), "key") == [("2",), ("3",)]


def test_scratch_folder_is_one_per_run(spark):
    assert run_dir(spark, "a") != run_dir(spark, "a")
    assert run_dir(spark, "a").startswith(shared_dir(spark))


def test_batch_replaces_itself_and_others_stay(spark, rows, root):
    data = h.events(spark, *MONTHS)
    tables.write_batch(data, root, EVENTS_ENRICHED, "1")
    tables.write_batch(data.filter("user_id = 3"), root, EVENTS_ENRICHED, "2")
    assert tables.read_table(spark, root, EVENTS_ENRICHED).count() == 5
    tables.write_batch(data.filter("user_id = 1"), root, EVENTS_ENRICHED, "1")
    assert rows(tables.read_table(spark, root, EVENTS_ENRICHED), "user_id") == [(1,), (3,)]


def test_unwritten_table_is_empty(spark, root):
    out = tables.read_table(spark, root, EVENTS_ENRICHED, "2025-01-01")
    assert out.columns == EVENTS_ENRICHED.columns and out.count() == 0


def test_time_bounds_prune_months(spark, rows, root):
    tables.write_batch(h.events(spark, *MONTHS), root, EVENTS_ENRICHED, "1")
    out = tables.read_table(spark, root, EVENTS_ENRICHED, "2025-10-01", "2025-11-01")
    assert rows(out, "user_id") == [(2,), (3,)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    pruned = plan[plan.index("PartitionFilters"):]
    assert "yyyymm" in pruned and ">= 202510" in pruned and "<= 202511" in pruned
    assert "PushedFilters: [IsNotNull(event_time)" in plan


def test_rows_are_sorted_in_files(spark, root):
    data = h.events(spark, *[h.event(i % 7, f"s{i}", "view" if i % 2 else "purchase", offset=i)
                             for i in range(50)])
    tables.write_batch(data, root, EVENTS_ENRICHED, "1")
    assert_sorted(glob.glob(f"{root}/events_enriched/batch=1/yyyymm=202510/*.parquet"))


def assert_sorted(paths):
    for path in paths:
        found = pq.read_table(path, partitioning=None).to_pydict()
        keys = list(zip(found["event_type"], found["event_time"], found["user_id"]))
        assert keys == sorted(keys)


def test_a_big_month_spreads_over_many_files(spark, root):
    data = spark.range(40_000).selectExpr(
        "timestamp'2025-10-01' + make_interval(0,0,0,0,0,0,id) AS event_time", "id % 9 AS user_id",
        "uuid() AS session_id", "if(id % 2 = 0, 'view', 'purchase') AS event_type",
        "'web' AS channel", "1.0D AS premium_amount", "'Rome' AS city", "'ios' AS device_type",
        "date'2024-01-01' AS signup_date", "'t' AS kafka_topic", "0L AS kafka_partition",
        "id AS kafka_offset", "timestamp'2025-10-01' AS kafka_timestamp",
        "timestamp'2025-10-01' AS _ingested_at", "0L AS ingest_lag_sec").repartition(8)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        tables.write_batch(data, root, EVENTS_ENRICHED, "1")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
    paths = glob.glob(f"{root}/events_enriched/batch=1/yyyymm=202510/*.parquet")
    assert len(paths) > 3
    assert_sorted(paths)
    assert tables.read_table(spark, root, EVENTS_ENRICHED).count() == 40_000


def test_bloom_filters_are_asked_for():
    options = tables.bloom_options(EVENTS_ENRICHED.bloom)
    assert options["parquet.bloom.filter.enabled#session_id"] == "true"
    assert options["parquet.bloom.filter.fpp#session_id"] == "0.01"


def test_latest_version_read(spark, rows, root):
    for label, premium, when in (("1", 1.0, "2025-10-01 10:00:00"), ("2", 2.0, "2025-11-01 10:00:00")):
        frame = spark.createDataFrame([h.third(1, premium=premium, when=when)], THIRD_ORDER.schema)
        tables.write_batch(frame, root, THIRD_ORDER, label)
    assert rows(tables.read_latest(spark, root, THIRD_ORDER), "premium") == [(2.0,)]


def test_truncate_keeps_the_table_readable(spark, root):
    tables.write_batch(h.events(spark, *MONTHS), root, EVENTS_ENRICHED, "1")
    tables.truncate(spark, root, [EVENTS_ENRICHED, BODY_ORDER])
    assert tables.read_table(spark, root, EVENTS_ENRICHED).count() == 0
    assert tables.read_table(spark, root, BODY_ORDER).count() == 0
    tables.write_batch(h.events(spark, *MONTHS), root, EVENTS_ENRICHED, "2")
    assert tables.read_table(spark, root, EVENTS_ENRICHED).count() == 4


def test_retention_empties_old_months_and_cuts_one(spark, rows, root):
    tables.write_batch(h.events(spark, *MONTHS), root, EVENTS_ENRICHED, "1")
    tables.drop_expired(spark, root, EVENTS_ENRICHED, "2027-04-15 00:00:00")
    assert rows(tables.read_table(spark, root, EVENTS_ENRICHED), "user_id") == [(2,), (3,)]


def test_erasure_rewrites_only_months_with_the_user(spark, rows, root):
    tables.write_batch(h.events(spark, *MONTHS), root, EVENTS_ENRICHED, "1")
    kept = glob.glob(f"{root}/events_enriched/batch=1/yyyymm=202509/*.parquet")
    tables.erase_subjects(spark, root, EVENTS_ENRICHED,
                          spark.createDataFrame([(2,)], "user_id BIGINT"))
    assert rows(tables.read_table(spark, root, EVENTS_ENRICHED), "user_id") == [(1,), (3,)]
    assert glob.glob(f"{root}/events_enriched/batch=1/yyyymm=202509/*.parquet") == kept


def test_erasure_leaves_files_without_the_user_alone(spark, rows, root):
    """Of two files of one month and batch, only the one with the user is replaced."""
    data = h.events(spark, *[h.event(i, f"s{i}", offset=i) for i in range(1, 9)])
    folder = f"{root}/events_enriched/batch=1"
    data.withColumn("yyyymm", F.lit(202510)).repartitionByRange(2, "user_id").write.partitionBy("yyyymm").parquet(folder)
    before = {f: Path(f).stat().st_mtime_ns for f in glob.glob(f"{folder}/yyyymm=202510/*.parquet")}
    subjects = spark.createDataFrame([(2,), (77,)], "user_id BIGINT")
    hit, = tables.files_with(spark, root, EVENTS_ENRICHED, subjects)
    tables.erase_subjects(spark, root, EVENTS_ENRICHED, subjects)
    after = {f: Path(f).stat().st_mtime_ns for f in glob.glob(f"{folder}/yyyymm=202510/*.parquet")}
    same = set(before) & set(after)
    assert len(before) == 2 and len(same) == 1 and all(before[f] == after[f] for f in same)
    assert not hit.endswith(Path(next(iter(same))).name)
    assert rows(tables.read_table(spark, root, EVENTS_ENRICHED), "user_id") == [(i,) for i in (1, 3, 4, 5, 6, 7, 8)]
    tables.erase_subjects(spark, root, EVENTS_ENRICHED, subjects)
    assert set(after) == set(glob.glob(f"{folder}/yyyymm=202510/*.parquet"))


@pytest.mark.parametrize("moved", [False, True])
def test_replacing_files_may_stop_and_go_on(spark, rows, root, monkeypatch, moved):
    """Cut off before the swap, or with the old files gone and the new ones not all moved."""
    tables.write_batch(h.events(spark, *MONTHS), root, EVENTS_ENRICHED, "1")
    replace = tables._replace_files

    def failing(session, top, table, staged):
        if moved:
            for row in session.read.text(f"{staged}/_replaced").collect():
                Path(row.value.removeprefix("file:")).unlink()
        raise OSError("stopped")

    monkeypatch.setattr(tables, "_replace_files", failing)
    subjects = spark.createDataFrame([(1,), (2,)], "user_id BIGINT")
    with pytest.raises(OSError, match="stopped"):
        tables.erase_subjects(spark, root, EVENTS_ENRICHED, subjects)
    monkeypatch.setattr(tables, "_replace_files", replace)
    assert tables.finish_rewrites(spark, root, EVENTS_ENRICHED) == 1
    assert rows(tables.read_table(spark, root, EVENTS_ENRICHED), "user_id") == [(3,)]


def test_collapse_versions_in_place(spark, rows, root):
    frame = spark.createDataFrame(
        [h.third(1, premium=1.0), h.third(1, premium=2.0, when="2025-10-02 10:00:00")],
        THIRD_ORDER.schema)
    tables.write_batch(frame, root, THIRD_ORDER, "1")
    tables.collapse_versions(spark, root, THIRD_ORDER, [202510])
    assert rows(tables.read_table(spark, root, THIRD_ORDER), "premium") == [(2.0,)]


def test_compaction_merges_states(spark, rows, root, tmp_path):
    data = h.events(spark, *MONTHS)
    for label in ("1", "2"):
        tables.write_batch(daily_states(data), root, EVENTS_AGG_DAILY, label)
    new = str(tmp_path / "new")
    tables.compact(spark, root, EVENTS_AGG_DAILY, new, merge_states)
    before, after = (tables.read_table(spark, r, EVENTS_AGG_DAILY) for r in (root, new))
    assert (before.count(), after.count()) == (8, 4)
    assert rows(finalize_states(before)) == rows(finalize_states(after))


def test_compaction_in_place(spark, rows, root):
    data = h.events(spark, *MONTHS)
    for label in ("1", "2", "3", "young"):
        tables.write_batch(daily_states(data), root, EVENTS_AGG_DAILY, label)
    wanted = rows(finalize_states(tables.read_table(spark, root, EVENTS_AGG_DAILY)))
    months = [202509, 202510]
    young = set(glob.glob(f"{root}/events_agg_daily/batch=young/*/*.parquet"))
    other = set(glob.glob(f"{root}/events_agg_daily/batch=1/yyyymm=202511/*.parquet"))
    found = tables.compact_months(spark, root, EVENTS_AGG_DAILY, months, ["young"], merge_states)
    files = set(glob.glob(f"{root}/events_agg_daily/*/*/*.parquet"))
    assert found == 6 and young | other <= files
    assert sum("batch=merged-" in f for f in files) == 2
    assert rows(finalize_states(tables.read_table(spark, root, EVENTS_AGG_DAILY))) == wanted
    assert not glob.glob(f"{root}/events_agg_daily/batch=[123]/yyyymm=202510")
    assert tables.compact_months(spark, root, EVENTS_AGG_DAILY, months, ["young"], merge_states) == 0
    assert rows(finalize_states(tables.read_table(spark, root, EVENTS_AGG_DAILY))) == wanted


def test_raw_table_without_months(spark, rows, root):
    raw = h.events(spark, *MONTHS).select(*USER_EVENTS.columns)
    tables.write_batch(raw, root, USER_EVENTS, "1")
    out = tables.read_table(spark, root, USER_EVENTS)
    assert rows(out) == rows(raw) and out.first().event_time > datetime(2025, 1, 1)


@pytest.mark.parametrize("calls", range(1, 9))
def test_rewrite_that_stops_anywhere_is_finished(spark, rows, root, monkeypatch, calls):
    """Whatever step fails, finishing leaves all rows of the user erased, or none of them."""
    tables.write_batch(h.events(spark, *MONTHS), root, EVENTS_ENRICHED, "1")
    tables.write_batch(h.events(spark, *MONTHS), root, EVENTS_ENRICHED, "2")
    ids = spark.createDataFrame([(2,)], "user_id BIGINT")
    delete, left = tables._delete, [calls]

    def failing(session, folders):
        for folder in folders:
            left[0] -= 1
            if not left[0]:
                raise OSError("stopped")
            delete(session, [folder])

    monkeypatch.setattr(tables, "_delete", failing)
    try:
        tables.erase_subjects(spark, root, EVENTS_ENRICHED, ids)
    except OSError:
        pass
    monkeypatch.setattr(tables, "_delete", delete)
    tables.finish_rewrites(spark, root, EVENTS_ENRICHED)
    assert rows(tables.read_table(spark, root, EVENTS_ENRICHED), "user_id") == [(1,), (1,), (3,), (3,)]
    assert not glob.glob(f"{root}/_rewrites/*/*")


def test_rewrite_that_was_not_staged_changes_nothing(spark, rows, root):
    tables.write_batch(h.events(spark, *MONTHS), root, EVENTS_ENRICHED, "1")
    before = rows(tables.read_table(spark, root, EVENTS_ENRICHED))
    spark.range(1).write.parquet(f"{root}/_rewrites/events_enriched/x-months-202510")
    Path(f"{root}/_rewrites/events_enriched/x-months-202510/_SUCCESS").unlink()
    assert tables.finish_rewrites(spark, root, EVENTS_ENRICHED) == 0
    assert rows(tables.read_table(spark, root, EVENTS_ENRICHED)) == before


def test_point_lookups_skip_row_groups_by_bloom_filters(spark, tmp_path):
    """Sessions by value, off the sort order: statistics cannot tell, Bloom filters can."""
    from eventmart.operators.purchases import point_filter

    rows = spark.range(40_000).selectExpr(
        "timestamp '2025-10-01 00:00:00' AS event_time", "id AS user_id",
        "concat('s-', pmod(xxhash64(id), 40000)) AS session_id").coalesce(1).sortWithinPartitions("user_id")
    wanted = spark.createDataFrame([("s-17",), ("s-4242",), (None,)], "session_id string")
    read = {}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name, options in (("plain", {}), ("bloom", tables.bloom_options(["session_id"]))):
            path = str(tmp_path / name)
            # Row groups are checked for their size every hundred rows here, and so hold about a thousand.
            rows.write.options(**options, **{
                "parquet.block.size": "8192", "parquet.page.size.row.check.min": "100",
                "parquet.page.size.row.check.max": "100", "parquet.enable.dictionary": "false",
                "parquet.block.size.row.check.min": "100"}).parquet(path)
            found = point_filter(wanted, ["session_id"])(spark.read.parquet(path))
            found.write.format("noop").mode("overwrite").save()
            execution = found._jdf.queryExecution()
            got = found.collect()
            leaves = execution.executedPlan().collectLeaves()
            scans = [leaves.apply(i) for i in range(leaves.size()) if "Parquet" in leaves.apply(i).toString()]
            assert all("In(session_id" in s.toString() or "session_id" in s.toString() for s in scans)
            read[name] = (sorted(r.user_id for r in got), scans[0].metrics().apply("numOutputRows").value())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert read["plain"][0] == read["bloom"][0]
    assert 0 <= read["bloom"][1] < read["plain"][1] == 40_000


def test_point_filter_without_keys_scans_nothing(spark, tmp_path):
    from eventmart.operators.purchases import point_filter

    none = spark.createDataFrame([], "user_id long")
    found = point_filter(none, ["user_id"])(spark.range(5).withColumnRenamed("id", "user_id"))
    assert found.collect() == [] and "LocalTableScan" in found._jdf.queryExecution().executedPlan().toString()
    many = spark.range(30).withColumnRenamed("id", "user_id")
    assert point_filter(many.limit(20), ["user_id"], most=10)(many).count() == 20
