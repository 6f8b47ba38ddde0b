"""Backfill of a window of days: filter, enrich, de-duplicate, stage or load.

    python -m eventmart.plans.backfill --start 2025-10-01 --end 2025-10-07 \\
        --events events.csv --users users.csv --out staged
"""

from __future__ import annotations

import argparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.functions.times import moment, parse_time
from eventmart.functions.values import UNKNOWN
from eventmart.operators.enrich import with_users
from eventmart.operators.reports import first_rows
from eventmart.operators.skew import BROADCAST_BYTES
from eventmart.operators.versioning import drop_duplicates, latest_version
from eventmart.schemas import EVENT_FIELDS, EVENTS_ENRICHED_BACKFILL
from eventmart.session import build_session
from eventmart.sources.files import read_events, read_users, stage_csv
from eventmart.sources.tables import read_stored, write_batch

NATURAL_KEY = ("user_id", "session_id", "event_time", "event_type")
COLUMNS = ("event_time", "user_id", "session_id", "event_type", "channel", "premium_amount",
           "city", "device_type", "signup_date")


def in_window(events: DataFrame, start: str, end: str) -> DataFrame:
    """Events from the first to the last day, both included.

    On a stored timestamp this is a range the scan can use; times in text are parsed first.
    """
    time = F.col("event_time")
    if dict(events.dtypes)["event_time"] == "string":
        time = parse_time(time)
    return events.filter((time >= F.lit(start).cast("timestamp"))
                         & (time < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp")))


def enrich_window(events: DataFrame, users: DataFrame, start: str, end: str,
                  max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Enriched, distinct events of a window. Unknown users keep a null signup date.

    Duplicates go before the lookup: the user is part of the key, so the rows are the same
    and fewer of them meet the users.
    """
    rows = in_window(events.select(*EVENT_FIELDS), start, end)
    window = drop_duplicates(rows, NATURAL_KEY)
    joined = with_users(window, users, ("session_id", "event_time", "event_type"), max_bytes)
    return (joined.withColumns({
        "city": F.coalesce("city", F.lit(UNKNOWN)),
        "device_type": F.coalesce("device_type", F.lit(UNKNOWN))})
        .select(*COLUMNS))


def as_target(window: DataFrame, loaded_at: str | Column | None = None) -> DataFrame:
    """Window rows in the shape of the backfill table."""
    return window.select(*[
        moment(loaded_at).alias(f.name) if f.name == "_backfilled_at"
        else F.col(f.name).cast(f.dataType).alias(f.name)
        for f in EVENTS_ENRICHED_BACKFILL.schema.fields])


def load_window(window: DataFrame, root: str, label: str,
                loaded_at: str | Column | None = None) -> None:
    """Add a window to the backfill table as a new version of its rows."""
    write_batch(as_target(window, loaded_at), root, EVENTS_ENRICHED_BACKFILL, label)


def read_backfill(spark: SparkSession, root: str) -> DataFrame:
    """Backfilled events, each at its latest version, however often its window was loaded."""
    table = EVENTS_ENRICHED_BACKFILL
    return latest_version(read_stored(spark, root, table).select(*table.columns), table.key,
                          table.version)


def window_counts(events: DataFrame, window: DataFrame) -> DataFrame:
    """Source rows, rows of the window and rows of unknown users, as one row."""
    zero = F.lit(0).cast("bigint")
    source = events.agg(F.count(F.lit(1)).alias("source_rows"), zero.alias("window_rows"),
                        zero.alias("unmatched"))
    found = window.agg(zero.alias("source_rows"), F.count(F.lit(1)).alias("window_rows"),
                       F.count_if(F.col("city") == UNKNOWN).alias("unmatched"))
    both = source.unionByName(found)
    return both.agg(*[F.sum(c).alias(c) for c in both.columns])


def dry_run(events: DataFrame, users: DataFrame, start: str, end: str) -> dict:
    """Counts and a sample of a window, computed twice; raises if the counts differ."""
    window = enrich_window(events, users, start, end)
    counts = window_counts(events, window).first().asDict()
    counts["sample"] = first_rows(window, 5, ["event_time", "user_id", "session_id"]).collect()
    again = enrich_window(events, users, start, end).count()
    if again != counts["window_rows"]:
        raise AssertionError(f"rerun gave {again} rows, not {counts['window_rows']}")
    return counts


def main(argv: list[str] | None = None) -> None:
    args = argparse.ArgumentParser(description=__doc__)
    for name in ("start", "end", "events", "users", "out"):
        args.add_argument(f"--{name}", required=True)
    args.add_argument("--single-file", action="store_true")
    chosen = args.parse_args(argv)
    spark = build_session("backfill")
    window = enrich_window(read_events(spark, chosen.events), read_users(spark, chosen.users),
                           chosen.start, chosen.end)
    stage_csv(window, chosen.out, chosen.single_file)


if __name__ == "__main__":
    main()
