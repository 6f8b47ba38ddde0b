"""CSV files with a header and a declared schema."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from eventmart.schemas import EVENTS_FILE, EVENTS_FILE_TEXT, USERS_FILE


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, EVENTS_FILE)


def read_event_text(spark: SparkSession, path: str) -> DataFrame:
    """Events with every column as text, for :func:`eventmart.operators.enrich.type_events`."""
    return read_csv(spark, path, EVENTS_FILE_TEXT)


def read_users(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, USERS_FILE)


def stage_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Write a headered CSV folder. One file means one task, so it is off by default."""
    out = df.coalesce(1) if single_file else df
    out.write.option("header", True).mode("overwrite").csv(path)


def expected_rows(spark: SparkSession, path: str, default: int | None = None) -> int:
    """Rows of a headered CSV file. Without the file it raises, unless a default is given."""
    try:
        return spark.read.option("header", True).csv(path).count()
    except AnalysisException as error:
        if default is None or "PATH_NOT_FOUND" not in str(error):
            raise
        return default
