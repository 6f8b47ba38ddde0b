"""Stable assignment of a purchase to a product line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventmart.functions.times import column
from eventmart.functions.values import PRODUCT_LINES


def stable_line(user_id: Column | str, session_id: Column | str) -> Column:
    """Product line picked by the MD5 of ``user:session`` modulo the four lines.

    Four divides sixteen, so the last hex digit alone decides the remainder.
    """
    digest = F.md5(F.concat_ws(":", column(user_id).cast("string"), column(session_id)))
    digit = F.conv(F.substring(digest, 32, 1), 16, 10).cast("int")
    lines = F.array(*[F.lit(line) for line in PRODUCT_LINES])
    return F.element_at(lines, F.pmod(digit, F.lit(len(PRODUCT_LINES))) + 1)
