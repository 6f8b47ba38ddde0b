"""The test tables as streams and runs: how they are dealt to micro-batches and how often they are read."""

from datetime import datetime, timedelta

import pytest

from eventmart.plans import catalog
from eventmart.session import run_dir
from eventmart.sources import canonical
from eventmart.streaming import live


@pytest.fixture
def sf_dir(spark, tmp_path):
    start = datetime(2024, 1, 1)
    kinds = ("purchase", "view")
    rows = [(i, start + timedelta(hours=7 * i), i % 5, kinds[i % 2], float(i), f'{{"k": {i % 9}}}')
            for i in range(90)]
    spark.createDataFrame(rows, canonical._SCHEMAS["events"]).write.parquet(f"{tmp_path}/events.parquet")
    spark.createDataFrame([(i, 0, 1.0, "BUILDING") for i in range(4)], canonical._SCHEMAS["customer"]).write.parquet(
        f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(0, "Rome")], canonical._SCHEMAS["nation"]).write.parquet(f"{tmp_path}/nation.parquet")
    return str(tmp_path)


def test_a_micro_batch_of_many_events_is_several_files(spark, sf_dir):
    stream = canonical.event_stream(spark, sf_dir, batches=3, file_events=10).select("event_id", "_metadata.file_path")
    seen = []
    query = stream.writeStream.foreachBatch(lambda df, i: seen.append(df.collect())).option(
        "checkpointLocation", run_dir(spark, "checkpoint")).trigger(availableNow=True).start()
    live.wait(query, 300)
    assert len(seen) == 3
    assert all(len({r.file_path for r in batch}) > 1 for batch in seen)
    assert sorted(r.event_id for batch in seen for r in batch) == list(range(90))


def test_few_events_stay_one_file_a_batch(spark, sf_dir):
    stream = canonical.event_stream(spark, sf_dir, batches=3).select("event_id")
    seen = []
    query = stream.writeStream.foreachBatch(lambda df, i: seen.append(df.count())).option(
        "checkpointLocation", run_dir(spark, "checkpoint")).trigger(availableNow=True).start()
    live.wait(query, 300)
    assert len(seen) == 3 and sum(seen) == 90


def test_arrivals_equal_the_filtered_tables(spark, rows, sf_dir):
    arrivals = canonical.Arrivals(spark, sf_dir)
    part = canonical.part_of("event_time")
    for run in (*canonical.RUNS, 4):
        assert rows(arrivals.enriched(run)) == rows(canonical.enriched(spark, sf_dir).where(f"{part} = {run}"))
        derived = canonical.product_tables(spark, sf_dir, where=f"{canonical.arrival(part)} = {run}")
        for line, table in arrivals.product_tables(run).items():
            assert rows(table) == rows(derived[line])


def test_runs_read_the_events_a_bounded_number_of_times(spark, sf_dir, monkeypatch):
    read = []
    table = canonical.table
    monkeypatch.setattr(canonical, "table", lambda spark, d, name: read.append(name) or table(spark, d, name))
    catalog.stream_joined_facts(spark, sf_dir)
    # The events, the purchases and the payments.
    assert read.count("events") == 3
