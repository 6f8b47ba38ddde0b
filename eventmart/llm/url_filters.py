"""Address lists that change over time, joined to captures as of their fetch.

A list is a history: an entry (domain or address prefix, to block or to allow) was added or removed
on a day. Changes become validity intervals. A capture asks with every suffix of its host and every
prefix of its path, and an entry counts if its interval holds the day of the fetch. Of all that
hold, the longest pattern decides; block wins a tie.

Captures are reduced to distinct pairs of pattern and day before they meet the intervals, so a
host with a third of all captures asks once a day, and months keep a pattern's long history apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import pick, staged

SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*://"
HOST = SCHEME + "(?:[^/?#@]*@)?([^/:?#]+)"
PATH = SCHEME + "[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    """The host in lower case without a final dot; empty if there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, HOST, 1)), r"\.$", "")


def segments_of(url: Column) -> Column:
    return F.array_remove(F.split(F.regexp_extract(url, PATH, 1), "/"), "")


def intervals(changes: DataFrame) -> DataFrame:
    """From changes (list, action, kind, pattern, change, dated) to list, action, kind, pattern, since
    and until (exclusive; null: open).

    ``action`` is block or allow, ``kind`` domain or prefix, ``change`` add or remove. Of several
    changes on a day remove wins. Changes with a null in any column but the list are left out, as
    are removals of what was not there. Days are grouped first, so a pattern's history has one
    row a day at most, however often it was reported.
    """
    days = pick(changes, list="list", action="action", kind="kind", pattern="pattern",
                change="change", dated="dated").select(
        F.coalesce("list", F.lit("")).alias("list"), "action", "kind",
        F.lower("pattern").alias("pattern"), "change", F.to_date("dated").alias("since")
    ).dropna().groupBy("list", "action", "kind", "pattern", "since").agg(
        F.max("change").alias("change"))
    return days.withColumn("until", F.expr(
        "lead(since) OVER (PARTITION BY list, action, kind, pattern ORDER BY since)")).where(
        "change = 'add'").drop("change")


def keys_of(host: str, segments: str, labels: int, depth: int) -> Column:
    """The patterns (kind, pattern) that may name an address: its host's suffixes of up to ``labels``
    labels and its prefixes of up to ``depth`` segments."""
    parts = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(max(labels, 1)))), lambda n: F.struct(
        F.lit("domain").alias("kind"),
        F.array_join(F.slice(parts, F.size(parts) - n + 1, n), ".").alias("pattern")))
    prefixes = F.transform(F.sequence(F.lit(0), F.least(F.size(segments), F.lit(depth))), lambda n: F.struct(
        F.lit("prefix").alias("kind"),
        F.concat(F.col(host), F.lit("/"), F.array_join(F.slice(segments, F.lit(1), n), "/")).alias(
            "pattern")))
    return F.when(F.col(host) != "", F.concat(domains, prefixes))


def evaluate(captures: DataFrame, changes: DataFrame) -> DataFrame:
    """One row per capture (page_id, url, fetched): its host, day, verdict and the entries that hold.

    ``verdict`` is block, allow or, if nothing holds, none; ``pattern`` the one that decided,
    ``n_entries`` how many hold and ``lists`` their lists, sorted. Prefixes match at segment bounds
    and in lower case. A null or relative url has no host and an empty one no entry; a null fetch
    day meets no entry. Repeated captures each get a row. Other columns are not read.
    """
    valid = staged(intervals(changes), "intervals")
    # Two numbers: deeper patterns than the lists have cannot match.
    deepest = valid.agg(
        F.max(F.when(F.col("kind") == "domain", F.size(F.split("pattern", r"\.")))).alias("labels"),
        F.max(F.when(F.col("kind") == "prefix", F.size(F.split("pattern", "/")) - 1)).alias("depth"),
        F.max(F.greatest("since", F.coalesce("until", "since"))).alias("last")).first()
    rows = staged(pick(captures, page_id="page_id", url="url", fetched="fetched").select(
        F.monotonically_increasing_id().alias("row"), "page_id",
        F.coalesce(host_of(F.col("url")), F.lit("")).alias("host"),
        F.transform(segments_of(F.col("url")), F.lower).alias("segments"),
        F.to_date("fetched").alias("day")), "captures")
    asked = rows.select("row", "day", F.explode(keys_of(
        "host", "segments", deepest.labels or 1, deepest.depth or 0)).alias("key")).select(
        "row", "day", "key.kind", "key.pattern")
    latest = rows.agg(F.max("day")).first()[0]
    if deepest.last is None or latest is None:
        held = asked.limit(0).select("kind", "pattern", "day").withColumns(
            {"list": F.lit(""), "action": F.lit("")})
    else:
        months = valid.withColumn("month", F.explode(F.sequence(
            F.trunc("since", "month"),
            F.greatest(F.trunc("since", "month"), F.trunc(F.coalesce(
                F.date_sub("until", 1), F.lit(max(latest, deepest.last))), "month")),
            F.expr("INTERVAL 1 MONTH"))))
        held = asked.select("kind", "pattern", "day", F.trunc("day", "month").alias("month")
                            ).distinct().join(months, ["kind", "pattern", "month"]).where(
            "day >= since AND (until IS NULL OR day < until)")
    verdicts = held.groupBy("kind", "pattern", "day").agg(
        F.max("action").alias("action"), F.count("*").alias("n"),
        F.collect_set("list").alias("lists"))
    found = asked.join(verdicts, ["kind", "pattern", "day"]).groupBy("row").agg(
        F.max(F.struct(F.length("pattern").alias("length"), "action", "pattern")).alias("top"),
        F.sum("n").alias("n_entries"),
        F.array_join(F.sort_array(F.array_distinct(F.flatten(F.collect_set("lists")))), ",").alias("lists"))
    return rows.join(found, "row", "left").select(
        "page_id", "host", "day", F.coalesce("top.action", F.lit("none")).alias("verdict"),
        "top.pattern", F.coalesce("n_entries", F.lit(0)).alias("n_entries"),
        F.coalesce("lists", F.lit("")).alias("lists"))
