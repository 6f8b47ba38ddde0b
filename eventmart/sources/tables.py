"""Stored tables: Parquet folders ``<root>/<table>/batch=<label>[/yyyymm=<month>]``.

A label is one write. Writing it again replaces it, so a repeated stream batch or job changes
nothing. Months let readers prune; rows are sorted inside the files, so row groups can be
skipped by their statistics.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.functions.times import month_number
from eventmart.operators.filters import point_filter
from eventmart.operators.governance import erased, retained
from eventmart.operators.versioning import latest_version
from eventmart.schemas import Table

BATCH, MONTH = "batch", "yyyymm"
BLOOM_FPP = "0.01"


def table_path(root: str, table: Table) -> str:
    return f"{root}/{table.name}"


def partition_columns(table: Table) -> list[str]:
    return [BATCH, MONTH] if table.month_of else [BATCH]


def bloom_options(columns: Iterable[str], fpp: str = BLOOM_FPP) -> dict[str, str]:
    """Parquet writer options for Bloom filters, for point lookups off the sort order.

    Adaptive filters take the smallest size that holds a row group's values.
    """
    options = {"parquet.bloom.filter.adaptive.enabled": "true"}
    for name in columns:
        options[f"parquet.bloom.filter.enabled#{name}"] = "true"
        options[f"parquet.bloom.filter.fpp#{name}"] = fpp
    return options


def clustered(df: DataFrame, table: Table) -> DataFrame:
    """Rows by month in evenly sized partitions, sorted inside each.

    ``rebalance`` lets Spark split a big month over many tasks and merge small ones, where a
    plain repartition by month would give each month to a single task.
    """
    if table.month_of:
        return (df.withColumn(MONTH, month_number(table.month_of)).hint("rebalance", MONTH)
                .sortWithinPartitions(MONTH, *table.sort))
    balanced = df.hint("rebalance")
    return balanced.sortWithinPartitions(*table.sort) if table.sort else balanced


def batch_label(spark: SparkSession, batch_id: int) -> str:
    """The label of a micro-batch: the id of its stream, which the checkpoint keeps, and its number.

    Numbers restart with every new checkpoint; the id keeps two streams' batches apart. Outside a
    stream it is the number alone.
    """
    stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{stream}-{batch_id}" if stream else str(batch_id)


def write_batch(df: DataFrame, root: str, table: Table, label: str) -> None:
    """Write or replace one batch of a table."""
    writer = clustered(df.select(*table.columns), table).write.mode("overwrite")
    writer = writer.option("partitionOverwriteMode", "static").options(**bloom_options(table.bloom))
    if table.month_of:
        writer = writer.partitionBy(MONTH)
    writer.parquet(f"{table_path(root, table)}/{BATCH}={label}")


def _stored_schema(table: Table) -> T.StructType:
    kinds = {BATCH: T.StringType(), MONTH: T.IntegerType()}
    extra = [T.StructField(name, kinds[name]) for name in partition_columns(table)]
    return T.StructType([*table.schema.fields, *extra])


def read_stored(spark: SparkSession, root: str, table: Table) -> DataFrame:
    """A table with its partition columns; empty if nothing was written yet."""
    schema = _stored_schema(table)
    try:
        return spark.read.schema(schema).parquet(table_path(root, table))
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return spark.createDataFrame([], schema)
        raise


def read_batch(spark: SparkSession, root: str, table: Table, label: str) -> DataFrame:
    """One batch of a table, without listing the folders of the others."""
    return spark.read.schema(_stored_schema(table)).option(
        "basePath", table_path(root, table)).parquet(
        f"{table_path(root, table)}/{BATCH}={label}").select(*table.columns)


def stored_batches(spark: SparkSession, root: str, table: Table) -> dict[str, int]:
    """Labels of the batches that are written whole, and when, in milliseconds of the file system's clock."""
    top = table_path(root, table)
    files, path = _files(spark, top)
    return {f.getPath().getParent().getName().removeprefix(f"{BATCH}="): f.getModificationTime()
            for f in files.globStatus(path(f"{top}/{BATCH}=*/_SUCCESS")) or []}


def read_batches(spark: SparkSession, root: str, table: Table, labels: Iterable[str]) -> DataFrame:
    """Some batches of a table; the folders of the others are not listed."""
    top = table_path(root, table)
    folders = [f"{top}/{BATCH}={label}" for label in sorted(labels)]
    if not folders:
        return spark.createDataFrame([], table.schema)
    return spark.read.schema(_stored_schema(table)).option("basePath", top).parquet(
        *folders).select(*table.columns)


def stored_folders(spark: SparkSession, top: str, inner: str) -> list[str]:
    """Folders ``batch=<label>/<inner>=<value>`` below ``top``."""
    files, path = _files(spark, top)
    return [f"{f.getPath().getParent().getName()}/{f.getPath().getName()}"
            for f in files.globStatus(path(f"{top}/{BATCH}=*/{inner}=*")) or []]


def drop_folders(spark: SparkSession, folders: Iterable[str]) -> None:
    _delete(spark, folders)


def drop_batches(spark: SparkSession, root: str, table: Table, labels: Iterable[str]) -> None:
    """Delete some batches of a table."""
    _delete(spark, [f"{table_path(root, table)}/{BATCH}={label}" for label in labels])


def between(df: DataFrame, table: Table, start: str | None, end: str | None) -> DataFrame:
    """Rows with start <= time < end. The same bounds on the month prune whole folders."""
    for bound, newer in ((start, True), (end, False)):
        if bound is None:
            continue
        when = F.lit(bound).cast("timestamp")
        time, month = F.col(table.month_of), F.col(MONTH)
        df = df.filter(time >= when if newer else time < when)
        df = df.filter(month >= month_number(when) if newer else month <= month_number(when))
    return df


def read_table(spark: SparkSession, root: str, table: Table, start: str | None = None,
               end: str | None = None) -> DataFrame:
    stored = read_stored(spark, root, table)
    return between(stored, table, start, end).select(*table.columns)


def read_latest(spark: SparkSession, root: str, table: Table) -> DataFrame:
    """The latest version per key of a versioned table."""
    return latest_version(read_table(spark, root, table), table.key, table.version)


def truncate(spark: SparkSession, root: str, tables: Iterable[Table]) -> None:
    """Empty tables: a static overwrite with no rows drops all their folders at once."""
    for table in tables:
        (spark.createDataFrame([], _stored_schema(table)).write.mode("overwrite")
         .option("partitionOverwriteMode", "static").partitionBy(*partition_columns(table))
         .parquet(table_path(root, table)))


STAGING, SWAPPING, REPLACED = "_rewrites", "_swapping", "_replaced"


def _files(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and its path class."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    return hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop.Path


def _folders(spark: SparkSession, top: str, table: Table, months: Sequence[int] | None = None) -> set[str]:
    """Partition folders below ``top``, of some months or of all: names, without reading any file."""
    files, path = _files(spark, top)
    found = files.globStatus(path(f"{top}/{BATCH}=*/{MONTH}=*")) or []
    names = {f"{f.getPath().getParent().getName()}/{f.getPath().getName()}" for f in found}
    return {n for n in names if months is None or int(n.rpartition("=")[2]) in months}


def _delete(spark: SparkSession, folders: Iterable[str]) -> None:
    for folder in folders:
        files, path = _files(spark, folder)
        files.delete(path(folder), True)


def _replace_files(spark: SparkSession, root: str, table: Table, staged: str) -> None:
    """Delete the files that a staged rewrite replaces and move its own to their folders. New names differ
    from old ones, so either half may be repeated."""
    files, path = _files(spark, staged)
    for row in spark.read.text(f"{staged}/{REPLACED}").collect():
        files.delete(path(row.value), False)
    for f in files.globStatus(path(f"{staged}/{BATCH}=*/{MONTH}=*/*.parquet")) or []:
        month = f.getPath().getParent()
        home = f"{table_path(root, table)}/{month.getParent().getName()}/{month.getName()}"
        files.mkdirs(path(home))
        if not files.rename(f.getPath(), path(f"{home}/{f.getPath().getName()}")):
            raise OSError(f"cannot move {f.getPath()} to {home}")
    spark.catalog.refreshByPath(table_path(root, table))


def rewrite_files(spark: SparkSession, root: str, table: Table, names: Sequence[str],
                  change: Callable[[DataFrame], DataFrame]) -> None:
    """Replace the rows of some files by ``change`` of them; all other files stay as they are.

    The new files are staged with the list of those that they replace. One that is cut off is completed
    or dropped by ``finish_rewrites``.
    """
    finish_rewrites(spark, root, table)
    if not names:
        return
    staged = f"{root}/{STAGING}/{table.name}/{uuid.uuid4().hex}-files"
    before = spark.read.schema(_stored_schema(table)).option(
        "basePath", table_path(root, table)).parquet(*names)
    spark.createDataFrame([(name,) for name in names], "value string").coalesce(1).write.text(f"{staged}/{REPLACED}")
    (change(before).hint("rebalance", *partition_columns(table))
     .sortWithinPartitions(*partition_columns(table), *table.sort)
     .write.mode("append").options(**bloom_options(table.bloom)).partitionBy(*partition_columns(table)).parquet(staged))
    _replace_files(spark, root, table, staged)
    _delete(spark, [staged])


def finish_rewrites(spark: SparkSession, root: str, table: Table) -> int:
    """Complete the rewrites of a table that were cut off; returns how many.

    One whose staged rows are whole is carried through; one that was still being staged has
    changed nothing and is dropped.
    """
    top = f"{root}/{STAGING}/{table.name}"
    files, path = _files(spark, top)
    finished = 0
    for status in (files.globStatus(path(f"{top}/*")) or []):
        staged = f"{top}/{status.getPath().getName()}"
        if files.exists(path(f"{staged}/_SUCCESS")):
            if files.exists(path(f"{staged}/{REPLACED}")):
                _replace_files(spark, root, table, staged)
            else:
                _swap(spark, root, table, staged)
            finished += 1
        _delete(spark, [staged])
    return finished


def _swap(spark: SparkSession, root: str, table: Table, staged: str) -> None:
    """Move staged folders to their places and delete those that have no rows left. The mark says that
    the deletions are done, as moved folders are not staged any more."""
    target = table_path(root, table)
    files, path = _files(spark, staged)
    months = [int(m) for m in staged.rpartition("months-")[2].split("-")]
    if not files.exists(path(f"{staged}/{SWAPPING}")):
        gone = _folders(spark, target, table, months) - _folders(spark, staged, table)
        _delete(spark, [f"{target}/{name}" for name in gone])
        files.create(path(f"{staged}/{SWAPPING}")).close()
    for name in sorted(_folders(spark, staged, table)):
        _delete(spark, [f"{target}/{name}"])
        files.mkdirs(path(f"{target}/{name}").getParent())
        if not files.rename(path(f"{staged}/{name}"), path(f"{target}/{name}")):
            raise OSError(f"cannot move {staged}/{name} to {target}")
    spark.catalog.refreshByPath(target)


def rewrite_months(spark: SparkSession, root: str, table: Table, months: Sequence[int],
                   change: Callable[[DataFrame], DataFrame]) -> None:
    """Replace the rows of some months by ``change`` of them; other months are not read.

    The result is staged below the root first. Its folders then take the old ones' places, folders
    without rows are deleted, and the staging goes. A rewrite that is cut off anywhere is
    completed by ``finish_rewrites`` or the next rewrite of the table.
    """
    finish_rewrites(spark, root, table)
    if not months:
        return
    before = read_stored(spark, root, table).filter(F.col(MONTH).isin(*months))
    name = f"{uuid.uuid4().hex}-months-{'-'.join(str(m) for m in sorted(months))}"
    staged = f"{root}/{STAGING}/{table.name}/{name}"
    (change(before).hint("rebalance", *partition_columns(table))
     .sortWithinPartitions(*partition_columns(table), *table.sort)
     .write.options(**bloom_options(table.bloom)).partitionBy(*partition_columns(table)).parquet(staged))
    _swap(spark, root, table, staged)
    _delete(spark, [staged])


def drop_expired(spark: SparkSession, root: str, table: Table, as_of: str,
                 months: int = 18) -> None:
    """Apply the retention period: folders of older months are deleted, the month it cuts is
    rewritten."""
    edge = spark.range(1).select(month_number(
        F.add_months(F.lit(as_of).cast("timestamp"), -months))).first()[0]
    target = table_path(root, table)
    _delete(spark, [f"{target}/{name}" for name in _folders(spark, target, table)
                    if int(name.rpartition("=")[2]) < edge])
    spark.catalog.refreshByPath(target)
    rewrite_months(spark, root, table, [edge],
                   lambda df: retained(df, as_of, months, table.month_of))


def files_with(spark: SparkSession, root: str, table: Table, subjects: DataFrame) -> list[str]:
    """The files that hold a row of some users. Only the user column is read, and of the files with
    Bloom filters or statistics against few users, only those that may hold one."""
    stored = read_stored(spark, root, table).select("user_id", "_metadata.file_path")
    hit = point_filter(subjects, ["user_id"])(stored).select("file_path").distinct()
    return sorted(row[0] for row in hit.collect())


def erase_subjects(spark: SparkSession, root: str, table: Table, subjects: DataFrame) -> None:
    """Remove all rows of some users; only files with such rows are rewritten."""
    finish_rewrites(spark, root, table)
    rewrite_files(spark, root, table, files_with(spark, root, table, subjects),
                  lambda df: erased(df, subjects))


def collapse_versions(spark: SparkSession, root: str, table: Table,
                      months: Sequence[int]) -> None:
    """Keep only the latest version of each key in some months of a versioned table."""
    rewrite_months(spark, root, table, months,
                   lambda df: latest_version(df, table.key, table.version))


def compact_months(spark: SparkSession, root: str, table: Table, months: Sequence[int],
                   keep: Iterable[str] = (), merge: Callable[[DataFrame], DataFrame] = lambda df: df) -> int:
    """Fold the files of many batches into one batch, in place and month by month, merging their rows;
    returns how many files it replaced.

    A folded batch can no longer be written again under its label or told from the others, so ``keep``
    those that may still be: of a running stream, or not yet seen by jobs that go by labels. The new
    batch is no batch to such jobs. Folders without files go.
    """
    finish_rewrites(spark, root, table)
    target, keep = table_path(root, table), set(keep)
    files, path = _files(spark, target)
    label, replaced = f"merged-{uuid.uuid4().hex}", 0
    for month in months:
        homes = [name for name in _folders(spark, target, table, [month])
                 if name.partition("/")[0].partition("=")[2] not in keep]
        names = [f.getPath().toString() for name in sorted(homes)
                 for f in files.globStatus(path(f"{target}/{name}/*.parquet")) or []]
        if len(names) > 1:
            rewrite_files(spark, root, table, names, lambda df, month=month: merge(df.select(*table.columns)).withColumns({
                MONTH: F.lit(month), BATCH: F.lit(label)}))
            replaced += len(names)
        _delete(spark, [f"{target}/{name}" for name in homes
                        if not files.globStatus(path(f"{target}/{name}/*.parquet"))])
    held = {name.partition("/")[0] for name in _folders(spark, target, table)}
    _delete(spark, [f"{target}/{BATCH}={x}" for x in stored_batches(spark, root, table)
                    if x not in keep and f"{BATCH}={x}" not in held])
    spark.catalog.refreshByPath(target)
    return replaced


def compact(spark: SparkSession, root: str, table: Table, new_root: str,
            merge: Callable[[DataFrame], DataFrame] = lambda df: df) -> None:
    """Copy a table of many batches into a fresh root as one batch, merging its rows."""
    write_batch(merge(read_table(spark, root, table)), new_root, table, "compact")
