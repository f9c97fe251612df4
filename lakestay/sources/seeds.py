"""Small fixed tables, typed files and the calendar."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestay import fixed_values as fv
from lakestay.functions.keys import date_id
from lakestay.functions.labels import season


def literal_table(spark: SparkSession, names: Sequence[str], rows: Sequence[tuple]) -> DataFrame:
    """Literal rows as a local relation, whose exact size the optimizer knows."""
    columns = list(zip(*rows))
    return spark.createDataFrame(pa.table({n: list(c) for n, c in zip(names, columns)}))


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A small CSV with declared types; a value of another type is an error."""
    return spark.read.schema(schema).options(header=True, mode="FAILFAST", enforceSchema=False).csv(path)


FX_SCHEMA = "currency string, units_per_usd decimal(18,6), valid_from date"


def fx_rates(spark: SparkSession) -> DataFrame:
    raw = literal_table(spark, ("currency", "units_per_usd", "valid_from"), fv.FX_RATES)
    return raw.select(
        "currency",
        F.col("units_per_usd").cast("decimal(18,6)").alias("units_per_usd"),
        F.col("valid_from").cast("date").alias("valid_from"),
    )


def dim_channels(spark: SparkSession) -> DataFrame:
    raw = literal_table(spark, ("channel_id", "channel_name", "channel_type"), fv.CHANNELS)
    return raw.withColumn("channel_id", F.col("channel_id").cast("int"))


def dim_geography(spark: SparkSession) -> DataFrame:
    names = ("geo_id", "city", "country", "country_code", "region", "timezone")
    return literal_table(spark, names, fv.GEOGRAPHY).withColumn("geo_id", F.col("geo_id").cast("int"))


def date_spine(
    spark: SparkSession, start: str = fv.CALENDAR_START, days: int = fv.CALENDAR_DAYS
) -> DataFrame:
    offset = F.col("id").cast("int")
    return spark.range(days).select(F.date_add(F.lit(start).cast("date"), offset).alias("full_date"))


def spine_between(bounds: DataFrame, first: Column, last: Column) -> DataFrame:
    """The days between two dates of a one-row frame."""
    return bounds.select(F.explode(F.sequence(first, last)).alias("full_date"))


def calendar(days: DataFrame) -> DataFrame:
    """Calendar attributes of a frame of days (full_date)."""
    day = F.col("full_date")
    weekday = F.weekday(day) + 1
    return days.select(
        date_id(day).alias("date_id"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week_of_year"),
        weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        (weekday >= 6).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
        season(day).alias("season"),
    )


def dim_dates(
    spark: SparkSession, start: str = fv.CALENDAR_START, days: int = fv.CALENDAR_DAYS
) -> DataFrame:
    return calendar(date_spine(spark, start, days))
