"""Facts: bookings, payments, web sessions, room nights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestay import fixed_values as fv
from lakestay.functions import aggregates as agg
from lakestay.functions.keys import date_id, to_usd
from lakestay.functions.labels import device_channel, is_status
from lakestay.operators.frames import explode_nights
from lakestay.operators.joins import (
    fx_asof,
    lookup,
    nearest_match,
    orphan_flag,
    scd2_lookup,
)


def _unknown():
    return F.lit(0).cast("long")


def fact_bookings(
    stg: DataFrame, dim_hotels: DataFrame, dim_customers: DataFrame, channels: DataFrame, fx: DataFrame
) -> DataFrame:
    """One row per booking: members as of the batch date, currency as of the booking day."""
    booked = stg.withColumn("_booked", F.to_date("created_at"))
    found = scd2_lookup(
        booked, dim_hotels, ("hotel_id", "hotel_id"), fv.BATCH_DATE,
        {"hotel_sk": "hotel_sk"}, {"hotel_sk": _unknown()},
    )
    # An anonymous booking has an empty user, which is no key to join on.
    found = scd2_lookup(
        found.withColumn("_user", F.nullif("user_id", F.lit(""))),
        dim_customers, ("_user", "user_id"), fv.BATCH_DATE,
        {"customer_sk": "customer_sk"}, {"customer_sk": _unknown()},
    )
    found = lookup(
        found, channels, {"booking_channel": "channel_name"},
        {"channel_id": "channel_id"}, {"channel_id": F.lit(fv.CHANNEL_ID_OTHER)},
    )
    found = fx_asof(found, fx, "currency", "_booked")
    return found.select(
        "booking_id", "hotel_id", "user_id", "hotel_sk", "customer_sk",
        date_id("checkin_date").alias("checkin_date_id"),
        date_id("checkout_date").alias("checkout_date_id"),
        date_id("_booked").alias("booked_date_id"),
        "channel_id", "nights", "total_amount", "fx_units_per_usd",
        to_usd(F.col("total_amount"), F.col("fx_units_per_usd")).alias("amount_usd"),
        "currency", "booking_status", "room_type",
        is_status("booking_status", "CANCELLED").alias("is_cancelled"),
        is_status("booking_status", "NO_SHOW").alias("is_no_show"),
        fv.BATCH_DATE,
    )


def fact_payments(stg: DataFrame, bookings: DataFrame, fx: DataFrame) -> DataFrame:
    """One row per payment: members of its booking, currency as of the batch date."""
    found = orphan_flag(
        stg, bookings, ("booking_id", "booking_id"),
        {"hotel_sk": "hotel_sk", "customer_sk": "customer_sk"},
        {"hotel_sk": _unknown(), "customer_sk": _unknown()},
    )
    found = fx_asof(found, fx, "currency", fv.BATCH_DATE)
    rate = F.col("fx_units_per_usd")
    return found.select(
        "payment_id", "booking_id", "hotel_sk", "customer_sk",
        date_id("processed_at").alias("payment_date_id"),
        "amount", "fx_units_per_usd", to_usd(F.col("amount"), rate).alias("amount_usd"),
        "currency", "payment_status", "payment_method",
        "refund_amount", to_usd(F.col("refund_amount"), rate).alias("refund_amount_usd"),
        is_status("payment_status", "REFUNDED").alias("is_refunded"),
        "is_orphan", fv.BATCH_DATE,
    )


def touched_sessions(events: DataFrame, date: str) -> DataFrame:
    """All events of the sessions that have an event in one batch.

    A session over two batches is rebuilt from both, not from the later one.
    """
    touched = events.filter(F.col(fv.BATCH_DATE) == F.lit(date).cast("date"))
    return events.join(touched.select("session_id").distinct(), "session_id", "left_semi")


def session_metrics(events: DataFrame) -> DataFrame:
    """Counts, duration, conversion and first known user and device per session."""
    kind, ts = F.col("event_type"), F.col("event_timestamp")
    order = (ts, F.col("event_id"))
    hotel_click = (kind == "click") & F.col("hotel_id").isNotNull()
    return events.groupBy("session_id").agg(
        agg.first_non_null(F.col("user_id"), *order).alias("user_id"),
        F.to_date(F.min(ts)).alias("session_date"),
        F.count(F.lit(1)).cast("int").alias("total_events"),
        agg.count_if(kind == "page_view").cast("int").alias("page_views"),
        agg.count_if(kind == "search").cast("int").alias("search_count"),
        agg.count_distinct_if(F.col("hotel_id"), hotel_click).cast("int").alias("hotels_viewed"),
        agg.duration_sec(ts).cast("int").alias("session_duration_sec"),
        agg.any_true(kind == "booking_complete").alias("converted"),
        agg.first_non_null(F.col("device_type"), *order).alias("device_type"),
        F.max(fv.BATCH_DATE).alias(fv.BATCH_DATE),
    )


def fact_web_sessions(events: DataFrame, bookings: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """One row per session with its customer and the booking it led to."""
    completed = events.filter(F.col("event_type") == "booking_complete")
    attributed = nearest_match(
        completed, bookings, ["user_id", "hotel_id", fv.BATCH_DATE],
        "event_timestamp", "created_at", "booking_id", ["session_id"], "booking_id",
    )
    sessions = session_metrics(events).join(attributed, "session_id", "left")
    found = scd2_lookup(
        sessions, dim_customers, ("user_id", "user_id"), fv.BATCH_DATE,
        {"customer_sk": "customer_sk"}, {"customer_sk": _unknown()},
    )
    return found.select(
        "session_id", "customer_sk", date_id("session_date").alias("session_date_id"),
        device_channel(F.col("device_type")).alias("channel_id"),
        "total_events", "page_views", "search_count", "hotels_viewed", "session_duration_sec",
        "converted", "booking_id", "device_type", fv.BATCH_DATE,
    )


STAY = ("hotel_id", "room_type", "checkin_date", "nights", "_rate")
NIGHT = ("hotel_id", "room_type", "stay_date")


def stays(stg_bookings: DataFrame, fx: DataFrame) -> DataFrame:
    """The confirmed bookings with their nights and full-precision night rate."""
    confirmed = stg_bookings.filter(is_status("booking_status", "CONFIRMED"))
    nights = F.greatest("nights", F.lit(1))
    rate = to_usd(F.col("total_amount"), F.col("fx_units_per_usd")) / nights
    kept = ["hotel_id", "room_type", "checkin_date", nights.alias("nights"), rate.cast("decimal(26,12)").alias("_rate")]
    return fx_asof(confirmed, fx, "currency", fv.BATCH_DATE).select("booking_id", *kept, fv.BATCH_DATE)


def room_nights(stays: DataFrame, sign: str = "1") -> DataFrame:
    """Booked rooms, rooms with a rate and the exact sum of rates per hotel, room type and
    night; sign is an expression that counts a stay in or out."""
    nights = explode_nights(stays, "checkin_date", F.col("nights"), "stay_date")
    one = F.expr(sign).cast("long")
    return nights.groupBy(*NIGHT).agg(
        F.sum(one).alias("booked_rooms"),
        F.sum(F.when(F.col("_rate").isNotNull(), one).otherwise(0)).alias("_rated"),
        F.coalesce(F.sum(F.when(one < 0, -F.col("_rate")).otherwise(F.col("_rate"))), F.lit(0))
        .cast("decimal(36,12)").alias("_rate_sum"),
    )


def fact_hotel_inventory(stg_bookings: DataFrame, dim_hotels: DataFrame, fx: DataFrame) -> DataFrame:
    """Occupancy, average daily rate and revenue per available room of each night."""
    return inventory_rows(room_nights(stays(stg_bookings, fx)), dim_hotels).select(*INVENTORY)


INVENTORY = (
    "hotel_sk", "date_id", "room_type", "total_rooms", "booked_rooms", "available_rooms", "occupancy_rate",
    "adr_usd", "revpar_usd", "stay_date",
)
# What is kept beside a night's row so that bookings can be counted in and out.
KEPT = ("_hotel_id", "_rated", "_rate_sum")


def inventory_rows(nights: DataFrame, dim_hotels: DataFrame) -> DataFrame:
    """A row of the inventory for each night, with the columns kept to change it.

    Capacity is that of the hotel version on the night itself. Rates keep 12
    digits to the end, operands being narrowed so that products and quotients
    keep them too; the inner rounding at 10 digits brings thirds and sevenths
    back onto the cent they stand for.
    """
    nights = nights.withColumn("_adr", F.col("_rate_sum") / F.nullif("_rated", F.lit(0).cast("long")))
    found = scd2_lookup(
        nights, dim_hotels, ("hotel_id", "hotel_id"), "stay_date",
        {"hotel_sk": "hotel_sk", "total_rooms": "total_rooms"},
        {"hotel_sk": _unknown(), "total_rooms": F.lit(0)},
    )
    booked, rooms = F.col("booked_rooms"), F.col("total_rooms")
    capacity = F.greatest(rooms, F.lit(1))
    cents = lambda x: F.round(F.round(x, 10), 2).cast("decimal(18,2)")
    return found.select(
        "hotel_sk", date_id("stay_date").alias("date_id"), "room_type", "total_rooms",
        booked.cast("int").alias("booked_rooms"),
        F.greatest(rooms - booked, F.lit(0)).cast("int").alias("available_rooms"),
        F.round(F.lit(100.0) * booked / capacity, 2).alias("occupancy_rate"),
        cents(F.col("_adr")).alias("adr_usd"),
        cents(
            F.col("_adr").cast("decimal(24,12)") * booked.cast("decimal(10,0)") / capacity.cast("decimal(10,0)")
        ).alias("revpar_usd"),
        "stay_date", F.col("hotel_id").alias("_hotel_id"), "_rated", "_rate_sum",
    )
