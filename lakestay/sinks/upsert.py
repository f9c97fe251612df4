"""Incremental tables: delete and insert by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestay import fixed_values as fv
from lakestay.sinks.batches import write_days
from lakestay.session import delete_folder, work_folders
from lakestay.sources.readers import day_path, path_exists, read_table


def align_schema(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union by name; columns only one side has are NULL on the other."""
    return old.unionByName(new, allowMissingColumns=True)


def merged(target: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """The target with its rows of the new keys replaced by the new rows."""
    keys = new.select(*key)
    return align_schema(target.join(keys, list(key), "left_anti"), new)


def incremental_slice(df: DataFrame, date: str, exists: bool = True) -> DataFrame:
    """The rows of one batch when the target exists, all rows when it does not."""
    return df.filter(F.col(fv.BATCH_DATE) == F.lit(date).cast("date")) if exists else df


def _days(df: DataFrame) -> set:
    return {r[0] for r in df.select(fv.BATCH_DATE).distinct().collect()}


def upsert(new: DataFrame, table: str, key: Sequence[str], sort_by: Sequence[str] = ()) -> list[str]:
    """Delete and insert by key into a table partitioned by batch date.

    Only the days holding a replaced key, and the days of the new rows, are
    rewritten. Their new content is first written to the work folder, so the
    table is never read and overwritten by one job and a failed run can be
    repeated; the work folders are deleted either way. The frame runs once.
    Returns the rewritten days; the driver sees days only, no rows.
    """
    spark = new.sparkSession
    if not path_exists(spark, table):
        write_days(new, table, sort_by)
        return sorted(str(d) for d in _days(read_table(spark, table)))

    with work_folders(spark, "upsert-batch", "upsert-days") as (batch, staged):
        new.write.parquet(batch)
        new = spark.read.parquet(batch)
        target = read_table(spark, table)

        hit = target.select(*key, fv.BATCH_DATE).join(new.select(*key), list(key), "left_semi")
        days = sorted(_days(hit) | _days(new))
        if not days:
            return []

        touched = target.filter(F.col(fv.BATCH_DATE).isin(days))
        write_days(merged(touched, new, key), staged)

        content = read_table(spark, staged)
        write_days(content, table, sort_by)
        for day in set(days) - _days(content):
            # All rows of this day moved to other days.
            delete_folder(spark, day_path(table, day))
    return [str(d) for d in days]
