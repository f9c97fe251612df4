"""A total order with global positions, without a task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestay.session import work_folder


def with_position(df: DataFrame, order: Sequence[Column], out: str = "position") -> DataFrame:
    """The rows in order with their position, counted from 1.

    order should leave no ties; rows that tie have positions of their own, in any order.
    Rows are dealt out by ranges of the order and each range is written as one file, sorted.
    A row's position is its place in the file and the rows of all files before it, a count
    for each file. The file's number is its range's, so positions come from what is
    written, not from the tasks that read it.
    """
    spark = df.sparkSession
    folder = work_folder(spark, "ordered")
    # One range goes to one file.
    ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranges.write.option("maxRecordsPerFile", 0).parquet(folder)
    rows = spark.read.schema(df.schema).parquet(folder)
    number = F.regexp_extract("_metadata.file_path", "part-([0-9]+)", 1).cast("int")
    placed = rows.select("*", number.alias("_range"), F.col("_metadata.row_index").alias("_place"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    # One row for each file.
    counts = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    found = placed.join(counts, "_range").withColumn(out, F.col("_before") + F.col("_place") + 1)
    return found.select(*df.columns, out)
