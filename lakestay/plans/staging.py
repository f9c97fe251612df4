"""Staging views: latest versions, non-empty keys, normalised text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestay import fixed_values as fv
from lakestay.functions import labels, parsing
from lakestay.operators.frames import filter_nonempty
from lakestay.operators.versions import latest_version
from lakestay.sinks.upsert import incremental_slice

# Normalisation per view: column -> expression over the staging column.
_UPPER = lambda c: F.upper(F.trim(c))
_LOWER = lambda c: F.lower(F.trim(c))
_UPPER_OR_NULL = lambda c: parsing.null_if_empty(F.upper(F.trim(c)))

NORMALISED = {
    "bookings": {
        "booking_id": _UPPER, "hotel_id": _UPPER, "user_id": _UPPER, "room_type": F.trim,
        "currency": _UPPER, "booking_status": labels.map_status,
        "booking_channel": labels.map_channel, "payment_method": _UPPER,
    },
    "hotels": {
        "hotel_id": _UPPER, "hotel_name": F.trim, "hotel_tier": _LOWER, "city": F.trim,
        "country": _UPPER, "region": F.trim, "facilities": parsing.to_tag_array,
    },
    "payments": {
        "payment_id": F.trim, "booking_id": F.trim, "currency": _UPPER,
        "payment_method": F.trim, "payment_status": _UPPER, "gateway_code": F.trim,
        "refund_amount": lambda c: F.coalesce(F.col(c), F.lit(0).cast("decimal(15,2)")),
    },
    "customers": {
        "user_id": _UPPER, "country": _UPPER, "user_segment": _LOWER, "loyalty_tier": F.trim,
    },
    "clickstream": {
        "event_id": F.trim, "session_id": F.trim, "user_id": _UPPER_OR_NULL,
        "event_type": _LOWER, "page_url": F.trim, "hotel_id": _UPPER_OR_NULL,
        "search_query": lambda c: parsing.null_if_empty(F.trim(c)), "device_type": _LOWER,
        "os": F.trim,
    },
}


def staging_view(name: str, staging: DataFrame) -> DataFrame:
    """The newest row per key of a staging table, normalised, with its batch date.

    Hotels and customers keep one row per key and day: the history behind the
    dimensions.
    """
    key, version = fv.STAGING_VERSIONS[name]
    newest = latest_version(filter_nonempty(staging, key[0]), key, version)
    change = NORMALISED[name]
    return newest.select(
        *[
            (change[c](c) if c in change else F.col(c)).alias(c)
            for c in (*fv.STAGING_COLUMNS[name], fv.BATCH_DATE)
        ]
    )


def staging_keys(name: str, staging: DataFrame) -> DataFrame:
    """(key, batch date) of a staging view's rows, without their versions and other columns."""
    key = fv.STAGING_VERSIONS[name][0][0]
    kept = filter_nonempty(staging, key).select(NORMALISED[name][key](key).alias(key), fv.BATCH_DATE)
    return kept.distinct()


def staging_batch(name: str, staging: DataFrame, date: str, exists: bool = True) -> DataFrame:
    """The rows of one batch that no later batch replaces; all rows while the target is missing.

    Older batches cannot change the answer for one batch, so their folders are
    not read.
    """
    if exists:
        staging = staging.filter(F.col(fv.BATCH_DATE) >= F.lit(date).cast("date"))
    return incremental_slice(staging_view(name, staging), date, exists)


def staging_sessions(staging: DataFrame, date: str) -> DataFrame:
    """The newest events of all sessions that may have an event in one batch.

    Sessions are those of the batch as it landed, and with each of their events
    come all its versions. Both are found by semi joins on two columns before
    versions are ranked, so the rest of the history is neither shuffled nor
    sorted.
    """
    ids = staging.select(F.trim("session_id").alias("_session"), "event_id", fv.BATCH_DATE)
    sessions = ids.filter(F.col(fv.BATCH_DATE) == F.lit(date).cast("date")).select("_session").distinct()
    events = ids.join(sessions, "_session", "left_semi").select("event_id").distinct()
    return staging_view("clickstream", staging.join(events, "event_id", "left_semi"))


def stg_bookings(staging: DataFrame) -> DataFrame:
    return staging_view("bookings", staging)


def stg_hotels(staging: DataFrame) -> DataFrame:
    return staging_view("hotels", staging)


def stg_payments(staging: DataFrame) -> DataFrame:
    return staging_view("payments", staging)


def stg_customers(staging: DataFrame) -> DataFrame:
    return staging_view("customers", staging)


def stg_clickstream(staging: DataFrame) -> DataFrame:
    return staging_view("clickstream", staging)
