"""What the operators share: picking columns, reading batches, staging, splitting rows for learning."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.session import run_dir


def numbered(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """The frame with its columns named by their places, c0 and on, and the names they had: names may
    clash, places do not. ``toDF`` puts the names back."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]), df.columns


def pick(df: DataFrame, **wanted: str) -> DataFrame:
    """Only the wanted columns, as ``new_name=name_in_df``.

    Columns are found by exact name and position, so further columns may have any names: a
    result column's, another case of a wanted name, or the same name twice (the first counts).
    """
    plain, names = numbered(df)
    return plain.select(*[F.col(f"c{names.index(old)}").alias(new) for new, old in wanted.items()])


#: Rows that a Python worker gets at a time; texts are long, and Spark's 10,000 of them are not small.
BATCH_ROWS = 1000


def in_small_batches(df: DataFrame) -> DataFrame:
    """The frame, with its session set to hand few rows at a time to Python workers."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df


def documents(df: DataFrame) -> DataFrame:
    """The id, as a long, and the text."""
    return pick(in_small_batches(df), doc_id="doc_id", text="text").withColumn("doc_id", F.col("doc_id").cast("long"))


def chunks(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in slices of few rows, so that working arrays stay small. At the end, memory that
    Arrow keeps for later goes back, as the worker may serve other stages next."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
    pa.default_memory_pool().release_unused()


def columns(batch: pa.RecordBatch, *names: str) -> list[list]:
    return [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]


def staged(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The frame written to the shared folder and read again: lineage ends there, and the
    rows outlive any executor. Names that clash, which files cannot hold, stay outside of them."""
    if len({column.lower() for column in df.columns}) < len(df.columns):
        plain, names = numbered(df)
        return staged(plain, name, **options).toDF(*names)
    folder = run_dir(df.sparkSession, name)
    df.write.options(**options).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def remainder(doc_id: str, parts: int) -> Column:
    """crc32 of the id's text, modulo ``parts``; null ids count as empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % parts


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
         "string": pa.string(), "binary": pa.binary()}


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of a flat ``name type, ...`` list."""
    return pa.schema([(n, ARROW[t]) for n, t in (x.split() for x in ddl.split(","))])


def record_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    found = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(found, schema, strict=True)], schema=schema)
