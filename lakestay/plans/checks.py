"""The checks a day's tables have to pass."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from lakestay.operators.quality import (
    Check,
    check_relationship,
    check_scd2,
    check_unique,
    count_not_accepted,
    count_nulls,
    count_unmet,
)

# What is checked on which table.
NOT_NULL = {
    "staging_bookings": ("booking_id", "hotel_id"),
    "staging_hotels": ("hotel_id", "hotel_name"),
    "staging_payments": ("payment_id", "booking_id"),
    "staging_customers": ("user_id",),
    "staging_clickstream": ("event_id",),
    "dim_dates": ("date_id",),
    "dim_hotels": ("hotel_sk", "hotel_id", "valid_from", "valid_to"),
    "dim_customers": ("customer_sk", "user_id"),
    "dim_channels": ("channel_id",),
    "fact_bookings": ("booking_id", "hotel_sk", "customer_sk", "channel_id", "nights"),
    "fact_payments": ("payment_id", "booking_id"),
    "fact_web_sessions": ("session_id", "total_events"),
    "fact_hotel_inventory": ("hotel_sk", "date_id"),
}
UNIQUE = {
    "dim_dates": (("date_id",),),
    "dim_hotels": (("hotel_sk",), ("hotel_id", "valid_from")),
    "dim_customers": (("customer_sk",), ("user_id", "valid_from")),
    "dim_channels": (("channel_id",), ("channel_name",)),
    "fact_bookings": (("booking_id",),),
    "fact_payments": (("payment_id",),),
    "fact_web_sessions": (("session_id",),),
    "fact_hotel_inventory": (("hotel_sk", "date_id", "room_type"),),
}
# (child, column, parent, parent column, severity)
REFERENCES = (
    ("fact_bookings", "hotel_sk", "dim_hotels", "hotel_sk", "error"),
    ("fact_bookings", "customer_sk", "dim_customers", "customer_sk", "error"),
    ("fact_bookings", "channel_id", "dim_channels", "channel_id", "error"),
    ("fact_payments", "booking_id", "fact_bookings", "booking_id", "warn"),
    ("fact_payments", "hotel_sk", "dim_hotels", "hotel_sk", "error"),
    ("fact_payments", "customer_sk", "dim_customers", "customer_sk", "error"),
    ("fact_web_sessions", "customer_sk", "dim_customers", "customer_sk", "error"),
    ("fact_web_sessions", "booking_id", "fact_bookings", "booking_id", "error"),
    ("fact_hotel_inventory", "hotel_sk", "dim_hotels", "hotel_sk", "error"),
)
ACCEPTED = (
    ("dim_channels", "channel_name", ("Web", "Mobile App", "Partner API", "Other")),
    (
        "fact_bookings", "booking_status",
        ("CONFIRMED", "CANCELLED", "PENDING", "NO_SHOW", "UNKNOWN"),
    ),
)
EXPECTED = (
    ("fact_bookings", "hotel_sk <> 0"),
    ("fact_bookings", "customer_sk <> 0"),
    ("fact_bookings", "amount_usd IS NOT NULL"),
    ("fact_payments", "NOT is_orphan"),
    ("fact_payments", "amount_usd IS NOT NULL"),
)
HISTORIES = (("dim_hotels", "hotel_id"), ("dim_customers", "user_id"))


def warehouse_checks(tables: Mapping[str, DataFrame]) -> list[Check]:
    """All checks on the tables at hand."""
    checks = []

    def add(name, severity, needed, violations=None, count=None):
        if all(t in tables for t in needed):
            frame = violations() if violations else tables[needed[0]]
            checks.append(Check(name, frame, severity, count))

    for table, cols in NOT_NULL.items():
        for col in cols:
            add(f"not_null {table}.{col}", "error", [table], count=count_nulls(col))
    for table, keys in UNIQUE.items():
        for key in keys:
            add(
                f"unique {table}({', '.join(key)})", "error", [table],
                lambda t=table, k=key: check_unique(tables[t], k),
            )
    for child, col, parent, parent_col, severity in REFERENCES:
        add(
            f"reference {child}.{col} to {parent}", severity, [child, parent],
            lambda c=child, k=col, p=parent, q=parent_col: check_relationship(
                tables[c], k, tables[p], q
            ),
        )
    for table, col, values in ACCEPTED:
        add(f"accepted {table}.{col}", "error", [table], count=count_not_accepted(col, values))
    for table, expression in EXPECTED:
        add(f"expected {table}: {expression}", "warn", [table], count=count_unmet(expression))
    for table, key in HISTORIES:
        add(
            f"history {table}", "error", [table],
            lambda t=table, k=key: check_scd2(tables[t], k),
        )
    return checks
