"""Tables by month, clustered by a sort key."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MONTH = "_month"


def write_by_month(
    df: DataFrame, table: str, date_col: str, cluster_by: Sequence[str], mode: str = "overwrite"
) -> None:
    """Write a table with a folder for each month of a date column.

    Rows are dealt out by ranges of month and sort key, so the files of a month hold ranges
    of the key that meet at most at one key, and a month with many rows has many files. With
    overwrite the months of the frame are replaced, others stay; a frame that holds part of a
    month replaces all of it.
    """
    body = df.withColumn(MONTH, F.date_format(date_col, "yyyy-MM"))
    body = body.repartitionByRange(MONTH, *cluster_by).sortWithinPartitions(MONTH, *cluster_by)
    (
        body.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(MONTH)
        .parquet(table)
    )


def read_by_month(
    spark: SparkSession, table: str, date_col: str, since: str | None = None, until: str | None = None
) -> DataFrame:
    """The rows, of the days from since to until; other months are not read.

    Files whose range of the sort key a filter rules out are skipped by their statistics.
    """
    df = spark.read.option("partitionColumnTypeInference.enabled", False).parquet(table)
    df = df.withColumn(MONTH, F.col(MONTH).cast("string"))
    for bound, over in ((since, True), (until, False)):
        if bound is None:
            continue
        month, day = F.lit(dt.date.fromisoformat(bound).strftime("%Y-%m")), F.lit(bound).cast("date")
        if over:
            df = df.filter((F.col(MONTH) >= month) & (F.col(date_col) >= day))
        else:
            df = df.filter((F.col(MONTH) <= month) & (F.col(date_col) <= day))
    return df.drop(MONTH)
