"""Reports: daily revenue, hotel performance, conversion funnel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestay import fixed_values as fv
from lakestay.functions import aggregates as agg
from lakestay.functions.labels import is_status
from lakestay.operators.frames import current_members, filter_as_of
from lakestay.operators.order import with_position
from lakestay.operators.joins import key_map, preagg_join, star_join


def _count():
    return F.count(F.lit(1))


def _usd(total):
    return total.cast("decimal(18,2)")


def rpt_daily_revenue(fact: DataFrame, dim_hotels: DataFrame, channels: DataFrame) -> DataFrame:
    """Bookings and confirmed revenue per day, country, region, tier and channel."""
    place = ("country", "region", "hotel_tier")
    labelled = star_join(
        fact,
        [
            (
                dim_hotels, {"hotel_sk": "hotel_sk"},
                {c: c for c in place}, {c: F.lit("Unknown") for c in place},
            ),
            (
                channels, {"channel_id": "channel_id"},
                {"channel_name": "channel_name"}, {"channel_name": F.lit(fv.CHANNEL_OTHER)},
            ),
        ],
    )
    cancelled = F.col("is_cancelled")
    confirmed = is_status("booking_status", "CONFIRMED")
    return labelled.groupBy(
        F.col(fv.BATCH_DATE).alias("report_date"), *place, "channel_name"
    ).agg(
        _count().alias("total_bookings"),
        agg.count_if(cancelled).alias("cancelled_bookings"),
        agg.count_if(confirmed).alias("confirmed_bookings"),
        _usd(agg.sum_if(F.col("amount_usd"), confirmed)).alias("confirmed_revenue_usd"),
        agg.count_if(F.col("amount_usd").isNull()).alias("bookings_missing_fx"),
        F.avg("nights").alias("avg_nights"),
        agg.pct(agg.count_if(cancelled), _count()).alias("cancellation_rate_pct"),
    )


def rpt_hotel_performance(
    dim_hotels: DataFrame, bookings: DataFrame, payments: DataFrame, date: str
) -> DataFrame:
    """Totals to date of every current hotel over all its versions.

    Both facts are brought to one row per hotel before they are joined, so
    payments do not multiply bookings.
    """
    booked = key_map(filter_as_of(bookings, date).drop("hotel_id"), dim_hotels, "hotel_sk", "hotel_id")
    cancelled, confirmed = F.col("is_cancelled"), is_status("booking_status", "CONFIRMED")
    booking_totals = booked.groupBy("hotel_id").agg(
        F.count_distinct("booking_id").alias("total_bookings"),
        agg.count_if(cancelled).alias("cancelled_bookings"),
        _usd(agg.sum_if(F.col("amount_usd"), confirmed)).alias("total_revenue_usd"),
        F.avg("nights").alias("avg_stay_nights"),
        agg.pct(agg.count_if(cancelled), F.count_distinct("booking_id")).alias(
            "cancellation_rate_pct"
        ),
    )
    paid = key_map(filter_as_of(payments, date), dim_hotels, "hotel_sk", "hotel_id")
    success = is_status("payment_status", "SUCCESS")
    payment_totals = paid.groupBy("hotel_id").agg(
        _usd(agg.sum_if(F.col("amount_usd"), success)).alias("total_payments_usd"),
        _usd(agg.sum_if(F.col("refund_amount_usd"), F.col("is_refunded"))).alias(
            "total_refunds_usd"
        ),
    )
    hotels = current_members(dim_hotels, "hotel_sk").select(
        "hotel_id", "hotel_name", "city", "country", "hotel_tier", "star_rating"
    )
    none, no_usd = F.lit(0), F.lit(0).cast("decimal(18,2)")
    return preagg_join(
        hotels,
        [(booking_totals, "hotel_id"), (payment_totals, "hotel_id")],
        {
            "total_bookings": none, "cancelled_bookings": none, "total_revenue_usd": no_usd,
            "total_payments_usd": no_usd, "total_refunds_usd": no_usd,
        },
    ).withColumn("report_date", F.lit(date).cast("date"))


def rpt_conversion_funnel(sessions: DataFrame) -> DataFrame:
    """Sessions reaching each step per day and device, with step rates, by day and falling
    sessions; position tells the order, the device decides ties."""
    viewed, searched = F.col("page_views") > 0, F.col("search_count") > 0
    hotel_seen, converted = F.col("hotels_viewed") > 0, F.col("converted")
    steps = {
        "sessions_with_views": viewed,
        "sessions_with_search": searched,
        "sessions_with_hotel_view": hotel_seen,
        "converted_sessions": converted,
        "attributed_sessions": F.col("booking_id").isNotNull(),
    }
    rates = {
        "search_rate_pct": (agg.count_if(searched), _count()),
        "view_after_search_pct": (agg.count_if(hotel_seen), agg.count_if(searched)),
        "conversion_rate_pct": (agg.count_if(converted), _count()),
    }
    means = {
        "avg_session_duration_sec": "session_duration_sec",
        "avg_page_views": "page_views",
        "avg_events_per_session": "total_events",
    }
    report = (
        sessions.groupBy(F.col(fv.BATCH_DATE).alias("report_date"), "device_type")
        .agg(
            _count().alias("total_sessions"),
            *[agg.count_if(cond).alias(name) for name, cond in steps.items()],
            *[agg.pct(part, whole).alias(name) for name, (part, whole) in rates.items()],
            *[F.avg(col).alias(name) for name, col in means.items()],
        )
    )
    order = [F.asc("report_date"), F.desc("total_sessions"), F.asc_nulls_first("device_type")]
    return with_position(report, order)
