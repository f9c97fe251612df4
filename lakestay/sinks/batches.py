"""Batch tables: one folder per batch date, replaced by every rerun."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from lakestay import fixed_values as fv
from lakestay.session import delete_folder
from lakestay.sources.readers import day_path


def write_day(df: DataFrame, table: str, date: str, sort_by: Sequence[str] = ()) -> str:
    """Write one batch; a rerun replaces exactly that day, also with no rows."""
    out = day_path(table, date)
    body = df.drop(fv.BATCH_DATE)
    if sort_by:
        body = body.sortWithinPartitions(*sort_by)
    body.write.mode("overwrite").parquet(out)
    return out


def write_days(df: DataFrame, table: str, sort_by: Sequence[str] = ()) -> None:
    """Write several batches at once; only days present in the frame are replaced.

    The rebalance brings the rows of a day together for large files and cuts a
    day larger than a partition into several.
    """
    body = df.hint("rebalance", fv.BATCH_DATE)
    if sort_by:
        body = body.sortWithinPartitions(fv.BATCH_DATE, *sort_by)
    (
        body.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(fv.BATCH_DATE)
        .parquet(table)
    )


def write_rejected(df: DataFrame, table: str, date: str) -> str:
    """Malformed records as JSON; written even when there are none, to clear a rerun."""
    out = day_path(table, date)
    df.write.mode("overwrite").json(out)
    return out


def write_quarantine(df: DataFrame, table: str, date: str) -> str:
    return write_day(df, table, date)


def refresh(df: DataFrame, table: str, sort_by: Sequence[str] = ()) -> None:
    """Replace a whole table by renaming a finished new one into its place.

    The new table is written beside the old one, under a name that scans pass
    over, so a failed job leaves the old table as it was, and the frame may
    read the table it replaces.
    """
    spark = df.sparkSession
    Path = spark._jvm.org.apache.hadoop.fs.Path
    folder, name = table.rstrip("/").rsplit("/", 1)
    mark = uuid.uuid4().hex
    fresh, old = f"{folder}/_{name}-{mark}", f"{folder}/_{name}-{mark}-old"
    body = df.sortWithinPartitions(*sort_by) if sort_by else df
    try:
        body.write.parquet(fresh)
        store = Path(table).getFileSystem(spark._jsc.hadoopConfiguration())
        if store.exists(Path(table)) and not store.rename(Path(table), Path(old)):
            raise OSError(f"cannot set {table} aside")
        if not store.rename(Path(fresh), Path(table)):
            store.rename(Path(old), Path(table))
            raise OSError(f"cannot put the new {table} in place")
    finally:
        delete_folder(spark, fresh)
    delete_folder(spark, old)
    spark.catalog.refreshByPath(table)
