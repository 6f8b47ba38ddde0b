"""Dates, times and differences of times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def parse_time(text: Column | str) -> Column:
    """Timestamp of a text; null where the text is none."""
    return F.try_to_timestamp(column(text))


def parse_date(text: Column | str) -> Column:
    """Date of a ``yyyy-MM-dd`` text; null where the text is none."""
    return F.to_date(F.try_to_timestamp(column(text), F.lit("yyyy-MM-dd")))


def month_number(when: Column | str) -> Column:
    """Year and month as one number, 202510 for October 2025."""
    when = column(when)
    return (F.year(when) * 100 + F.month(when)).cast("int")


def day_start(when: Column | str) -> Column:
    return F.date_trunc("day", column(when))


def seconds_between(first: Column | str, second: Column | str) -> Column:
    """Whole seconds from ``first`` to ``second``."""
    return F.unix_timestamp(column(second)) - F.unix_timestamp(column(first))


def moment(value: str | Column | None) -> Column:
    """A point in time: a text, a column, or the time of the running query."""
    if value is None:
        return F.current_timestamp()
    return F.lit(value).cast("timestamp") if isinstance(value, str) else value


def time_text(when: Column | str) -> Column:
    return F.date_format(column(when), "yyyy-MM-dd HH:mm:ss")
