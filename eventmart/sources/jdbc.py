"""The users table of a transactional database, pulled whole over parallel connections.

The JDBC driver's jar must be on the classpath; none comes with PySpark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def users_options(url: str, user: str, password: str, lower: int, upper: int,
                  partitions: int, table: str = "users",
                  fetch_rows: int = 10000) -> dict[str, str]:
    """Reader options for ranges of ``user_id``; rows outside the bounds are read as well."""
    return {
        "url": url, "dbtable": table, "user": user, "password": password,
        "partitionColumn": "user_id", "lowerBound": str(lower), "upperBound": str(upper),
        "numPartitions": str(partitions), "fetchsize": str(fetch_rows),
    }


def id_bounds(spark: SparkSession, url: str, user: str, password: str,
              table: str = "users") -> tuple[int, int]:
    query = f"SELECT min(user_id) AS lo, max(user_id) AS hi FROM {table}"
    row = spark.read.format("jdbc").options(
        url=url, query=query, user=user, password=password).load().first()
    return (row["lo"] or 0, row["hi"] or 0)


def read_users(spark: SparkSession, url: str, user: str, password: str,
               partitions: int = 16, table: str = "users") -> DataFrame:
    lower, upper = id_bounds(spark, url, user, password, table)
    options = users_options(url, user, password, lower, upper + 1, partitions, table)
    return spark.read.format("jdbc").options(**options).load()
