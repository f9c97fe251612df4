"""The room nights kept up by differences.

fact_hotel_inventory keeps, beside its columns, what a night's row was made of: rooms, rooms
with a rate and the exact sum of rates. booked_stays says what each booking was counted as.
A batch counts the old stays of its bookings out and the new ones in, so only the nights
these touch are read and written; a changed hotel has its nights from that day on made anew.

Both tables change together: the new rows are written to one folder, whose rename decides
the change. Rows are new values, not differences, so applying a decided change again after a
failure gives the same tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestay import fixed_values as fv
from lakestay.plans import facts, staging
from lakestay.session import delete_folder, work_folders
from lakestay.sinks.versioned import VersionedTable
from lakestay.sources.readers import path_exists

SORT = ("hotel_sk", "date_id", "room_type")
NIGHT_KEY = ("_hotel_id", "room_type", "stay_date")


def build(stg_bookings: DataFrame, dim_hotels: DataFrame, fx: DataFrame, fact: str, kept: str) -> None:
    """Both tables from all bookings; the fact comes last and says that both are there."""
    spark = stg_bookings.sparkSession
    delete_folder(spark, fact)
    delete_folder(spark, kept)
    stays = counted_stays(stg_bookings, fx)
    known = VersionedTable.create(stays, kept, ["booking_id"]).read()
    nights = facts.room_nights(known.filter("counted"))
    VersionedTable.create(facts.inventory_rows(nights, dim_hotels), fact, NIGHT_KEY, SORT, "stay_date")


def counted_stays(stg_bookings: DataFrame, fx: DataFrame) -> DataFrame:
    """What each booking counts as; one that is not confirmed counts as nothing."""
    counted = facts.stays(stg_bookings, fx).withColumn("counted", F.lit(True))
    names = [c for c in counted.columns if c not in ("booking_id", fv.BATCH_DATE)]
    every = stg_bookings.select(F.col("booking_id").alias("_id"), F.col(fv.BATCH_DATE).alias("_day"))
    found = every.join(counted, F.col("_id") == F.col("booking_id"), "left")
    return found.select(
        F.col("_id").alias("booking_id"), *[c for c in names if c != "counted"],
        F.coalesce("counted", F.lit(False)).alias("counted"), F.col("_day").alias(fv.BATCH_DATE),
    )


def changed_bookings(bookings: DataFrame, kept: DataFrame, date: str) -> DataFrame:
    """The newest rows of the bookings one batch may change.

    Those are the bookings of the batch, for which earlier batches don't matter, and the
    ones counted from this batch that it no longer has; only these are looked for in all
    batches. A booking no batch has any more has no row here.
    """
    day = F.lit(date).cast("date")
    own = staging.staging_view("bookings", bookings.filter(F.col(fv.BATCH_DATE) == day)).select("booking_id")
    newest = staging.staging_view("bookings", bookings.filter(F.col(fv.BATCH_DATE) >= day))
    newest = newest.join(own, "booking_id", "left_semi")
    lost = lost_bookings(bookings, kept, date)
    if not lost.limit(1).count():
        return newest
    raw = bookings.join(lost.select(F.col("booking_id").alias("_id")), F.upper(F.trim("booking_id")) == F.col("_id"), "left_semi")
    return newest.unionByName(staging.staging_view("bookings", raw))


def lost_bookings(bookings: DataFrame, kept: DataFrame, date: str) -> DataFrame:
    """Bookings counted from a batch that no longer has them."""
    day = F.lit(date).cast("date")
    own = staging.staging_view("bookings", bookings.filter(F.col(fv.BATCH_DATE) == day)).select("booking_id")
    return kept.filter(F.col(fv.BATCH_DATE) == day).select("booking_id").join(own, "booking_id", "left_anti")


def differences(old: DataFrame, new: DataFrame) -> DataFrame:
    """Per night what the new stays count more than the old ones; equal stays cancel out first."""
    same = ["booking_id", *facts.STAY]
    signed = old.filter("counted").select(*same, F.lit(-1).alias("sign")).unionByName(
        new.filter("counted").select(*same, F.lit(1).alias("sign"))
    )
    moved = signed.groupBy(*same).agg(F.sum("sign").alias("sign")).filter("sign <> 0")
    return facts.room_nights(moved, "sign")


def update(
    bookings: DataFrame, dim_hotels: DataFrame, fx: DataFrame, fact: str, kept: str, pending: str,
    date: str, changed_hotels: Iterable[tuple[DataFrame, str]] = (),
) -> None:
    """Bring both tables up to date with one batch of staged bookings and some changed hotels.

    changed_hotels are frames of hotel ids with the day from which their versions changed.
    A decided change that an earlier run did not finish is applied first. Read are the ids
    and stays of booked_stays and, of the nights, the touched days.
    """
    spark = bookings.sparkSession
    finish(spark, fact, kept, pending)
    stays, nights = VersionedTable.open(spark, kept), VersionedTable.open(spark, fact)
    with work_folders(spark, "inventory-bookings", "inventory-nights") as (folder, touched):
        lost = lost_bookings(bookings, stays.read(), date).select("booking_id")
        newest = counted_stays(changed_bookings(bookings, stays.read(), date), fx)
        # A booking that is in no batch any more counts as nothing.
        blank = lost.join(newest.select("booking_id"), "booking_id", "left_anti")
        typed = [F.lit(None).cast(newest.schema[c].dataType).alias(c) for c in facts.STAY]
        blank = blank.select(
            "booking_id", *typed, F.lit(False).alias("counted"), F.lit(date).cast("date").alias(fv.BATCH_DATE)
        )
        newest.unionByName(blank.select(*newest.columns)).write.parquet(folder)
        new = spark.read.parquet(folder)
        old = stays.read().join(new.select("booking_id"), "booking_id", "left_semi")
        moved = differences(old, new).withColumnRenamed("hotel_id", "_hotel_id").withColumn("moved", F.lit(True))
        zero = moved.limit(0)
        for hotels, since in changed_hotels:
            same = nights.read().filter(F.col("stay_date") >= F.lit(since).cast("date")).select(*NIGHT_KEY)
            same = same.join(hotels.select(F.col("hotel_id").alias("_hotel_id")), "_hotel_id", "left_semi")
            zero = zero.unionByName(same.select(
                *NIGHT_KEY, F.lit(0).cast("long").alias("booked_rooms"), F.lit(0).cast("long").alias("_rated"),
                F.lit(0).cast("decimal(36,12)").alias("_rate_sum"), F.lit(False).alias("moved"),
            ))
        moved.unionByName(zero.select(*moved.columns)).write.parquet(touched)
        change = spark.read.parquet(touched)
        sums = ("booked_rooms", "_rated", "_rate_sum")
        before = touched_nights(nights.read(), change).select(*NIGHT_KEY, *[F.col(c).cast(change.schema[c].dataType).alias(c) for c in sums])
        after = before.unionByName(change.select(*NIGHT_KEY, *sums)).groupBy(*NIGHT_KEY).agg(
            F.sum("booked_rooms").alias("booked_rooms"), F.sum("_rated").alias("_rated"),
            F.sum("_rate_sum").cast("decimal(36,12)").alias("_rate_sum"),
        )
        rows = facts.inventory_rows(after.withColumnRenamed("_hotel_id", "hotel_id"), dim_hotels)
        decide(spark, pending, new, rows)
    finish(spark, fact, kept, pending)


def touched_nights(nights: DataFrame, change: DataFrame) -> DataFrame:
    """The nights a change touches; only the folders of their days are read."""
    days = [r[0] for r in change.select("stay_date").distinct().collect()]
    found = nights.filter(F.col("stay_date").isin(days))
    return found.join(change.select(*NIGHT_KEY), list(NIGHT_KEY), "left_semi")


def decide(spark: SparkSession, pending: str, stays: DataFrame, nights: DataFrame) -> None:
    """Write the new rows of both tables and decide the change by one rename."""
    staged = f"{pending}-{uuid.uuid4().hex}"
    try:
        stays.write.parquet(f"{staged}/stays")
        nights.write.parquet(f"{staged}/nights")
        Path = spark._jvm.org.apache.hadoop.fs.Path
        if not Path(staged).getFileSystem(spark._jsc.hadoopConfiguration()).rename(Path(staged), Path(pending)):
            raise OSError(f"another change stands at {pending}")
    finally:
        delete_folder(spark, staged)


def finish(spark: SparkSession, fact: str, kept: str, pending: str) -> None:
    """Apply a decided change, if there is one, and forget it."""
    if not path_exists(spark, pending):
        return
    nights = spark.read.parquet(f"{pending}/nights")
    table = VersionedTable.open(spark, fact)
    booked, empty = nights.filter("booked_rooms <> 0"), nights.filter("booked_rooms = 0")
    if booked.limit(1).count():
        table.upsert(booked.select(*[f.name for f in table.schema.fields]), sort_by=SORT)
    if empty.limit(1).count():
        table.delete(empty, sort_by=SORT)
    stays = VersionedTable.open(spark, kept)
    stays.upsert(spark.read.parquet(f"{pending}/stays").select(*[f.name for f in stays.schema.fields]))
    delete_folder(spark, pending)
