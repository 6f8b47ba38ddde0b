"""Event messages: JSON text and its fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.functions.times import column
from eventmart.schemas import EVENT_FIELDS

CORRUPT = "_corrupt"

# Every field is read as text, so that a quoted number is accepted like a bare one and
# a value of the wrong type can be reported with its field's name.
MESSAGE_TEXT = T.StructType(
    [T.StructField(name, T.StringType()) for name in (*EVENT_FIELDS, CORRUPT)])


def event_json() -> Column:
    """The event columns as a JSON object; missing values are written as null."""
    return F.to_json(F.struct(*EVENT_FIELDS), {"ignoreNullFields": "false"})


def event_fields(value: Column | str) -> Column:
    """Message text as a struct of texts; unknown fields are skipped."""
    return F.from_json(column(value), MESSAGE_TEXT,
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
