"""Dimensions, facts and reports over the supplied tables."""

from pyspark.sql import functions as F

from lakestay import fixed_values as fv
from lakestay.functions import keys
from lakestay.operators.frames import add_unknown_member, explode_nights
from lakestay.operators.history import splice, touched_keys
from lakestay.operators.scd2 import scd2
from lakestay.plans import dimensions, facts, inventory, reports
from lakestay.registry.core import flat, query
from lakestay.sources import seeds
from lakestay.functions.parsing import to_tag_array


def hotel_dimension(t):
    snapshots = t("hotel_snapshots").withColumn("facilities", to_tag_array("facilities_text"))
    return dimensions.dim_hotels(snapshots.drop("facilities_text"))


def customer_dimension(t):
    return dimensions.dim_customers(t("customer_snapshots"))


def hotels(t):
    return t.once("dim-hotels", hotel_dimension)


def customers(t):
    return t.once("dim-customers", customer_dimension)


def booking_facts(t, hotels=hotel_dimension, customers=customer_dimension):
    return facts.fact_bookings(
        t("bookings"), hotels(t), customers(t), seeds.dim_channels(t.spark), t("rates")
    )


def payment_facts(t):
    return facts.fact_payments(t("payments"), booking_facts(t), t("rates"))


def session_facts(t):
    return facts.fact_web_sessions(t("clicks"), t("bookings"), customer_dimension(t))


_NAMED = "md5({key} || '|' || CAST(valid_from AS VARCHAR))"
SK = f"(CAST(('0x' || substr({_NAMED}, 1, 15)) AS BIGINT) * 8 + CAST(('0x' || substr({_NAMED}, 16, 1)) AS BIGINT) // 2)"
USD = """CASE WHEN {rate} <> 0 THEN CAST(CAST(
    (CAST({amount} * 100 AS HUGEINT) * 2000000 + CAST({rate} * 1000000 AS HUGEINT))
    // (2 * CAST({rate} * 1000000 AS HUGEINT)) AS DECIMAL(20,0)) / 100 AS DECIMAL(18,2)) END"""


def versions_sql(name, snapshots, key, sk, tracked, columns, unknown, extra=""):
    """The SQL of a dimension as CTEs: change points by comparing with the row before."""
    changed = " OR ".join(f"{c} IS DISTINCT FROM lag({c}) OVER w" for c in tracked)
    return f"""
    {name}_steps AS (SELECT *, row_number() OVER w AS step, ({changed}) AS changed FROM {snapshots}
        WINDOW w AS (PARTITION BY {key} ORDER BY _batch_date)),
    {name}_starts AS (SELECT *, _batch_date AS valid_from,
            lead(_batch_date) OVER (PARTITION BY {key} ORDER BY _batch_date) AS next_from
        FROM {name}_steps WHERE step = 1 OR changed),
    {name} AS (SELECT {SK.format(key=key)} AS {sk}, {columns}, valid_from,
            COALESCE(CAST(next_from - 1 AS DATE), DATE '9999-12-31') AS valid_to, next_from IS NULL AS is_current
        FROM {name}_starts
        UNION ALL SELECT 0, {unknown}, DATE '1970-01-01', DATE '9999-12-31', true)"""


DIM_HOTELS = versions_sql(
    "dim_hotels", "hotel_snapshots", "hotel_id", "hotel_sk",
    ("hotel_name", "hotel_tier", "star_rating", "city", "country", "region", "latitude", "longitude",
     "total_rooms", "facilities_text", "is_active"),
    """hotel_id, hotel_name, hotel_tier, star_rating, city, country, region, latitude, longitude, total_rooms,
       CASE WHEN facilities_text = '' THEN '' ELSE 'pool,wifi' END AS facilities,
       CASE WHEN facilities_text = '' THEN 0 ELSE 2 END AS facility_count, is_active""",
    "'UNKNOWN', 'Unknown hotel', 'unknown', 0, 'Unknown', 'UNKNOWN', 'Unknown', 0, 0, 0, '', 0, false",
)
DIM_CUSTOMERS = versions_sql(
    "dim_customers", "customer_snapshots", "user_id", "customer_sk",
    ("email_hash", "country", "user_segment", "loyalty_tier", "first_booking_date", "is_active"),
    "user_id, email_hash, country, user_segment, loyalty_tier, first_booking_date, is_active",
    "'UNKNOWN', '', 'UNKNOWN', 'unknown', 'Unknown', DATE '1970-01-01', false",
)
CHANNEL_NAMES = "['Web', 'Mobile App', 'Partner API', 'Other']"
DAY_NUMBER = "CAST(year({day}) * 10000 + month({day}) * 100 + day({day}) AS INTEGER)"


def _day_number(day):
    return DAY_NUMBER.format(day=day)


# Spark looks versions up as of a day; here every version has a closed interval and each
# fact finds the one interval that holds its day.
RATE_SPANS = """
    rate_spans AS (SELECT currency, units_per_usd, valid_from,
        COALESCE(lead(valid_from) OVER (PARTITION BY currency ORDER BY valid_from) - 1, DATE '9999-12-31') AS valid_to FROM rates)"""
FACT_BOOKINGS = f"""{RATE_SPANS},
    hotel_of AS (SELECT booking_id, hotel_sk FROM dim_hotels v JOIN bookings x
        ON x.hotel_id = v.hotel_id AND x._batch_date BETWEEN v.valid_from AND v.valid_to),
    guest_of AS (SELECT booking_id, customer_sk FROM dim_customers v JOIN bookings x
        ON x.user_id = v.user_id AND x._batch_date BETWEEN v.valid_from AND v.valid_to),
    rate_of AS (SELECT booking_id, units_per_usd FROM rate_spans v JOIN bookings x
        ON x.currency = v.currency AND CAST(x.created_at AS DATE) BETWEEN v.valid_from AND v.valid_to),
    fact_bookings AS (
        SELECT booking_id, hotel_id, user_id, ifnull(hotel_sk, 0) AS hotel_sk, ifnull(customer_sk, 0) AS customer_sk,
            {_day_number('checkin_date')} AS checkin_date_id, {_day_number('checkout_date')} AS checkout_date_id,
            {_day_number('created_at')} AS booked_date_id,
            CAST(ifnull(nullif(list_position({CHANNEL_NAMES}, booking_channel), 0), 4) AS INTEGER) AS channel_id,
            nights, total_amount, units_per_usd AS fx_units_per_usd,
            {USD.format(amount='total_amount', rate='units_per_usd')} AS amount_usd, currency, booking_status, room_type,
            booking_status IN ('CANCELLED') AS is_cancelled, booking_status IN ('NO_SHOW') AS is_no_show, _batch_date
        FROM bookings LEFT JOIN hotel_of USING (booking_id) LEFT JOIN guest_of USING (booking_id)
            LEFT JOIN rate_of USING (booking_id))"""
# A payment may be there more than once, so each finds its booking and its rate by itself.
FACT_PAYMENTS = f"""
    owners AS (SELECT booking_id, hotel_sk, customer_sk, false AS is_orphan FROM fact_bookings),
    fact_payments AS (
        SELECT payment_id, booking_id, ifnull(hotel_sk, 0) AS hotel_sk, ifnull(customer_sk, 0) AS customer_sk,
            {_day_number('processed_at')} AS payment_date_id,
            amount, units_per_usd AS fx_units_per_usd, {USD.format(amount='amount', rate='units_per_usd')} AS amount_usd,
            x.currency, payment_status, payment_method, refund_amount,
            {USD.format(amount='refund_amount', rate='units_per_usd')} AS refund_amount_usd,
            payment_status IN ('REFUNDED') AS is_refunded, ifnull(is_orphan, true) AS is_orphan, _batch_date
        FROM payments x LEFT JOIN owners USING (booking_id)
            LEFT JOIN rate_spans v ON x.currency = v.currency AND _batch_date BETWEEN v.valid_from AND v.valid_to)"""
ALL_BOOKINGS = f"WITH {DIM_HOTELS}, {DIM_CUSTOMERS}, {FACT_BOOKINGS}"
BOOKING_INPUTS = ("hotel_snapshots", "customer_snapshots", "bookings", "rates")


@query("scd2_dimension", f"""WITH snapshots AS (SELECT user_id, event_type, day AS _batch_date FROM user_days),
    {versions_sql("d", "snapshots", "user_id", "sk", ("event_type",), "user_id, event_type", "0, ''")}
    SELECT * FROM d WHERE sk <> 0""".replace(
        "md5(user_id", "md5(CAST(user_id AS VARCHAR)"), ("user_days",))
def scd2_dimension(t):
    return scd2(t("user_days"), "user_id", ["event_type"], "sk", "day")


@query("scd2_splice", f"""WITH snapshots AS (SELECT user_id, event_type, day AS _batch_date FROM user_days),
    {versions_sql("d", "snapshots", "user_id", "sk", ("event_type",), "user_id, event_type", "0, ''")}
    SELECT * FROM d WHERE sk <> 0""".replace(
        "md5(user_id", "md5(CAST(user_id AS VARCHAR)"), ("user_days",))
def scd2_splice(t):
    """The same versions: two days are left out at first and merged in, the earlier one last."""
    days, tracked = t("user_days"), ["event_type"]
    parts = {d: days.filter(F.col("day") == F.lit(d).cast("date")) for d in ("2024-01-20", "2024-01-12")}
    known = days.filter(~F.col("day").isin([F.lit(d).cast("date") for d in parts]))
    versions = t.stored(scd2(known, "user_id", tracked, "sk", "day"), "versions")
    for day, snapshot in parts.items():
        touched = t.stored(touched_keys(versions, snapshot, day, "user_id", tracked), "touched")
        later = known.filter(F.col("day") > day).select("user_id", "day")
        new = splice(versions, touched, later, day, "user_id", tracked, "sk", "day")
        rest = versions.join(touched.select("user_id"), "user_id", "left_anti").select(*versions.columns)
        versions, known = t.stored(rest.unionByName(new), "versions"), known.unionByName(snapshot)
    return versions


@query("dim_hotels", f"WITH {DIM_HOTELS} SELECT * FROM dim_hotels", ("hotel_snapshots",))
def dim_hotels(t):
    return flat(hotel_dimension(t))


@query("dim_customers", f"WITH {DIM_CUSTOMERS} SELECT * FROM dim_customers", ("customer_snapshots",))
def dim_customers(t):
    return customer_dimension(t)


@query("add_unknown_member", """
    SELECT c_custkey, c_name, c_nationkey FROM customer UNION ALL SELECT -1, 'Unknown', 0""")
def unknown_member(t):
    dim = t("customer").select("c_custkey", "c_name", "c_nationkey")
    return add_unknown_member(dim, {"c_custkey": -1, "c_name": "Unknown", "c_nationkey": 0})


@query("explode_nights", """
    SELECT event_id, CAST(start_day + CAST(n AS INTEGER) AS DATE) AS stay_date
    FROM (SELECT event_id, CAST(ts AS DATE) AS start_day, unnest(range(greatest(event_id % 4, 1))) AS n FROM events)""")
def explode_nights_query(t):
    stays = t("events").select("event_id", F.to_date("ts").alias("start_day"))
    nights = explode_nights(stays, "start_day", F.col("event_id") % 4, "stay_date")
    return nights.select("event_id", "stay_date")


DATE_SQL = """
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, d AS full_date, CAST(year(d) AS INTEGER) AS year,
        CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
        CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name,
        isodow(d) >= 6 AS is_weekend, false AS is_holiday,
        CASE WHEN month(d) IN (6, 7, 8, 12) THEN 'high_season' WHEN month(d) IN (1, 2, 9) THEN 'shoulder' ELSE 'low_season' END AS season,
        COUNT(o_orderkey) AS n_orders
    FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
          FROM (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders))
    LEFT JOIN orders ON CAST(o_orderdate AS DATE) = d GROUP BY ALL"""


def _order_days(t):
    bounds = t("orders").agg(F.to_date(F.min("o_orderdate")).alias("lo"), F.to_date(F.max("o_orderdate")).alias("hi"))
    return seeds.spine_between(bounds, F.col("lo"), F.col("hi"))


def _orders_per_day(t):
    per_day = t("orders").groupBy(F.to_date("o_orderdate").alias("full_date"))
    return per_day.agg(F.count("*").alias("n_orders"))


@query("dim_dates", DATE_SQL)
def dim_dates(t):
    """The calendar of all days from the first to the last order, with their orders."""
    return seeds.calendar(_order_days(t)).join(_orders_per_day(t), "full_date", "left").fillna(0, ["n_orders"])


@query("date_spine", """
    SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS full_date
    FROM (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders)""")
def date_spine(t):
    return _order_days(t)


@query("fact_bookings", f"{ALL_BOOKINGS} SELECT * FROM fact_bookings", BOOKING_INPUTS)
def fact_bookings(t):
    return booking_facts(t)


@query("fact_payments", f"{ALL_BOOKINGS}, {FACT_PAYMENTS} SELECT * FROM fact_payments", (*BOOKING_INPUTS, "payments"))
def fact_payments(t):
    return payment_facts(t)


# Every event is numbered in its session; what comes first is read off at its number.
SESSIONS = f"""
    numbered AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY event_timestamp, event_id) AS place FROM clicks),
    firsts AS (SELECT session_id, min(place) FILTER (user_id IS NOT NULL) AS user_place,
            min(place) FILTER (device_type IS NOT NULL) AS device_place, min(event_timestamp) AS opened, max(event_timestamp) AS closed,
            max(_batch_date) AS last_batch, len(list(place)) AS n, sum(CAST(event_type = 'page_view' AS INTEGER)) AS views,
            sum(CAST(event_type = 'search' AS INTEGER)) AS searches, bool_or(event_type = 'booking_complete') AS converted,
            len(list_distinct(list(hotel_id) FILTER (event_type = 'click' AND hotel_id IS NOT NULL))) AS hotels
        FROM numbered GROUP BY session_id),
    gaps AS (SELECT session_id, booking_id, row_number() OVER (PARTITION BY session_id
            ORDER BY abs(date_diff('second', created_at, event_timestamp)), booking_id) AS nearness
        FROM bookings JOIN clicks USING (user_id, hotel_id, _batch_date) WHERE event_type = 'booking_complete'),
    sessions AS (SELECT f.session_id, ifnull(customer_sk, 0) AS customer_sk, {_day_number('opened')} AS session_date_id,
            CASE d.device_type WHEN 'desktop' THEN 1 WHEN 'mobile' THEN 2 WHEN 'tablet' THEN 2 ELSE 4 END AS channel_id,
            CAST(n AS INTEGER) AS total_events, CAST(ifnull(views, 0) AS INTEGER) AS page_views,
            CAST(ifnull(searches, 0) AS INTEGER) AS search_count, CAST(ifnull(hotels, 0) AS INTEGER) AS hotels_viewed,
            CAST(date_diff('second', opened, closed) AS INTEGER) AS session_duration_sec, ifnull(converted, false) AS converted,
            g.booking_id, d.device_type, last_batch AS _batch_date
        FROM firsts f
        LEFT JOIN numbered u ON u.session_id = f.session_id AND u.place = f.user_place
        LEFT JOIN numbered d ON d.session_id = f.session_id AND d.place = f.device_place
        LEFT JOIN gaps g ON g.session_id = f.session_id AND nearness = 1
        LEFT JOIN dim_customers v ON v.user_id = u.user_id AND last_batch BETWEEN v.valid_from AND v.valid_to)"""
SESSION_INPUTS = ("customer_snapshots", "clicks", "bookings")


@query("fact_web_sessions", f"WITH {DIM_CUSTOMERS}, {SESSIONS} SELECT * FROM sessions", SESSION_INPUTS)
def fact_web_sessions(t):
    return session_facts(t)


# Night rates are multiples of 1/420 cent (nights are 1 to 7), so the oracle sums whole numbers.
INVENTORY = f"""{RATE_SPANS},
    stays AS (SELECT hotel_id, room_type, checkin_date AS first_night, greatest(nights, 1) AS n_nights,
            CAST(100 * {USD.format(amount='total_amount', rate='units_per_usd')} AS HUGEINT) * 420 AS price420
        FROM bookings x LEFT JOIN rate_spans v ON x.currency = v.currency AND x._batch_date BETWEEN v.valid_from AND v.valid_to
        WHERE booking_status = 'CONFIRMED'),
    ordinals AS (SELECT CAST(unnest(range(max(n_nights))) AS INTEGER) AS k FROM stays),
    sold AS (SELECT hotel_id, room_type, first_night + k AS night, CAST(sum(1) AS BIGINT) AS rooms,
            CAST(sum(CAST(price420 IS NOT NULL AS INTEGER)) AS HUGEINT) AS priced, CAST(sum(price420 // n_nights) AS HUGEINT) AS income
        FROM stays JOIN ordinals ON k < n_nights GROUP BY 1, 2, 3),
    offered AS (SELECT sold.*, ifnull(v.hotel_sk, 0) AS hotel_sk, ifnull(v.total_rooms, 0) AS total_rooms
        FROM sold LEFT JOIN dim_hotels v ON v.hotel_id = sold.hotel_id AND night BETWEEN v.valid_from AND v.valid_to),
    fractions AS (SELECT *, 420 * priced AS under, 420 * priced * greatest(total_rooms, 1) AS under_room FROM offered)
    SELECT hotel_sk, {_day_number('night')} AS date_id, room_type, total_rooms, CAST(rooms AS INTEGER) AS booked_rooms,
        CAST(CASE WHEN rooms < total_rooms THEN total_rooms - rooms ELSE 0 END AS INTEGER) AS available_rooms,
        round(CAST(100 AS DOUBLE) * rooms / greatest(total_rooms, 1), 2) AS occupancy_rate,
        CAST(CAST((2 * income + under) // nullif(2 * under, 0) AS DECIMAL(20,0)) / 100 AS DECIMAL(18,2)) AS adr_usd,
        CAST(CAST((2 * income * rooms + under_room) // nullif(2 * under_room, 0) AS DECIMAL(20,0)) / 100 AS DECIMAL(18,2)) AS revpar_usd,
        night AS stay_date
    FROM fractions"""


@query("fact_inventory", f"WITH {DIM_HOTELS}, {INVENTORY}", ("hotel_snapshots", "bookings", "rates"))
def fact_inventory(t):
    return facts.fact_hotel_inventory(t("bookings"), hotel_dimension(t), t("rates"))


@query("inventory_differences", f"WITH {DIM_HOTELS}, {INVENTORY}", ("hotel_snapshots", "bookings", "rates"))
def inventory_differences(t):
    """The same nights: a third of the bookings count as something else at first, and their
    old stays are counted out and the new ones in."""
    now, moved = t("bookings"), F.substring("booking_id", 4, 20).cast("long") % 3 == 0
    before = now.withColumns({
        "booking_status": F.when(moved, F.when(F.col("booking_status") == "CONFIRMED", "PENDING").otherwise("CONFIRMED"))
        .otherwise(F.col("booking_status")),
        "hotel_id": F.when(moved, F.lit("HTL-7")).otherwise(F.col("hotel_id")),
    })
    old, new = (inventory.counted_stays(x, t("rates")) for x in (before, now))
    nights = facts.room_nights(old.filter("counted"))
    change = inventory.differences(old, new)
    after = nights.unionByName(change).groupBy(*facts.NIGHT).agg(*[
        F.sum(c).cast(nights.schema[c].dataType).alias(c) for c in ("booked_rooms", "_rated", "_rate_sum")
    ])
    return facts.inventory_rows(after.filter("booked_rooms <> 0"), hotel_dimension(t)).select(*facts.INVENTORY)


@query("rpt_daily_revenue", """
    SELECT CAST(o_orderdate AS DATE) AS report_date, n_name AS country, r_name AS region, c_mktsegment AS hotel_tier,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'Web' WHEN '2-HIGH' THEN 'Mobile App' WHEN '3-MEDIUM' THEN 'Partner API' ELSE 'Other' END AS channel_name,
        count(*) AS total_bookings, count(*) FILTER (o_orderstatus = 'O') AS cancelled_bookings,
        count(*) FILTER (o_orderstatus = 'F') AS confirmed_bookings,
        CAST(sum(CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) END) FILTER (o_orderstatus = 'F') AS DECIMAL(18,2)) AS confirmed_revenue_usd,
        count(*) FILTER (o_orderkey % 13 = 0) AS bookings_missing_fx, avg(o_orderkey % 7 + 1) AS avg_nights,
        round(CAST(100 AS DOUBLE) * count(*) FILTER (o_orderstatus = 'O') / count(*), 2) AS cancellation_rate_pct
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY 1, 2, 3, 4, 5""")
def rpt_daily_revenue(t):
    """Orders as bookings, customers with their nation and region as places."""
    places = (
        t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").alias("hotel_sk"), F.col("n_name").alias("country"),
            F.col("r_name").alias("region"), F.col("c_mktsegment").alias("hotel_tier"),
        )
    )
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    urgency = F.substring("o_orderpriority", 1, 1).cast("int")
    bookings = t("orders").select(
        F.to_date("o_orderdate").alias(fv.BATCH_DATE), F.col("o_custkey").alias("hotel_sk"),
        F.least(urgency, F.lit(fv.CHANNEL_ID_OTHER)).alias("channel_id"),
        (key % 7 + 1).alias("nights"),
        F.when(status == "F", "CONFIRMED").when(status == "O", "CANCELLED").otherwise("PENDING").alias("booking_status"),
        (status == "O").alias("is_cancelled"),
        F.when(key % 13 != 0, F.col("o_totalprice").cast("decimal(18,2)")).alias("amount_usd"),
    )
    return reports.rpt_daily_revenue(bookings, places, seeds.dim_channels(t.spark))


@query("rpt_revenue_by_booking", f"""{ALL_BOOKINGS}
    SELECT f._batch_date AS report_date, COALESCE(h.country, 'Unknown') AS country, COALESCE(h.region, 'Unknown') AS region,
        COALESCE(h.hotel_tier, 'Unknown') AS hotel_tier, {CHANNEL_NAMES}[f.channel_id] AS channel_name,
        count(*) AS total_bookings, count(*) FILTER (is_cancelled) AS cancelled_bookings,
        count(*) FILTER (booking_status = 'CONFIRMED') AS confirmed_bookings,
        CAST(sum(amount_usd) FILTER (booking_status = 'CONFIRMED') AS DECIMAL(18,2)) AS confirmed_revenue_usd,
        count(*) FILTER (amount_usd IS NULL) AS bookings_missing_fx, avg(nights) AS avg_nights,
        round(CAST(100 AS DOUBLE) * count(*) FILTER (is_cancelled) / count(*), 2) AS cancellation_rate_pct
    FROM fact_bookings f LEFT JOIN dim_hotels h ON f.hotel_sk = h.hotel_sk
    GROUP BY ALL""", BOOKING_INPUTS)
def rpt_revenue_by_booking(t):
    """The same report over the booking facts and the hotel history."""
    return reports.rpt_daily_revenue(booking_facts(t), hotel_dimension(t), seeds.dim_channels(t.spark))


# Bookings and payments are one list of movements, summed over all versions of a hotel.
@query("rpt_performance", f"""{ALL_BOOKINGS}, {FACT_PAYMENTS},
    movements AS (
        SELECT hotel_sk, _batch_date, 1 AS booked, CAST(is_cancelled AS INTEGER) AS lost, nights,
            CASE booking_status WHEN 'CONFIRMED' THEN amount_usd END AS earned, NULL AS paid, NULL AS refunded FROM fact_bookings
        UNION ALL
        SELECT hotel_sk, _batch_date, 0, NULL, NULL, NULL, CASE payment_status WHEN 'SUCCESS' THEN amount_usd END,
            CASE WHEN is_refunded THEN refund_amount_usd END FROM fact_payments),
    sums AS (SELECT hotel_id, CAST(sum(booked) AS BIGINT) AS booked, CAST(sum(lost) AS BIGINT) AS lost, avg(nights) AS mean_nights,
            sum(earned) AS earned, sum(paid) AS paid, sum(refunded) AS refunded
        FROM movements JOIN dim_hotels USING (hotel_sk) WHERE _batch_date <= DATE '2024-01-25' GROUP BY hotel_id)
    SELECT hotel_id, hotel_name, city, country, hotel_tier, star_rating, ifnull(booked, 0) AS total_bookings,
        ifnull(lost, 0) AS cancelled_bookings, CAST(ifnull(earned, 0) AS DECIMAL(18,2)) AS total_revenue_usd,
        mean_nights AS avg_stay_nights, round(CAST(100 AS DOUBLE) * lost / nullif(booked, 0), 2) AS cancellation_rate_pct,
        CAST(ifnull(paid, 0) AS DECIMAL(18,2)) AS total_payments_usd, CAST(ifnull(refunded, 0) AS DECIMAL(18,2)) AS total_refunds_usd,
        DATE '2024-01-25' AS report_date
    FROM dim_hotels LEFT JOIN sums USING (hotel_id) WHERE is_current AND hotel_id <> 'UNKNOWN'""", (*BOOKING_INPUTS, "payments"))
def rpt_performance(t):
    bookings = t.once("fact-bookings", lambda t: booking_facts(t, hotels, customers))
    payments = facts.fact_payments(t("payments"), bookings, t("rates"))
    return reports.rpt_hotel_performance(hotels(t), bookings, payments, "2024-01-25")


@query("rpt_funnel", f"""WITH {DIM_CUSTOMERS}, {SESSIONS}
    SELECT _batch_date AS report_date, device_type, count(*) AS total_sessions, count(*) FILTER (page_views > 0) AS sessions_with_views,
        count(*) FILTER (search_count > 0) AS sessions_with_search, count(*) FILTER (hotels_viewed > 0) AS sessions_with_hotel_view,
        count(*) FILTER (converted) AS converted_sessions, count(booking_id) AS attributed_sessions,
        round(CAST(100 AS DOUBLE) * count(*) FILTER (search_count > 0) / count(*), 2) AS search_rate_pct,
        round(CAST(100 AS DOUBLE) * count(*) FILTER (hotels_viewed > 0) / NULLIF(count(*) FILTER (search_count > 0), 0), 2) AS view_after_search_pct,
        round(CAST(100 AS DOUBLE) * count(*) FILTER (converted) / count(*), 2) AS conversion_rate_pct,
        avg(session_duration_sec) AS avg_session_duration_sec, avg(page_views) AS avg_page_views, avg(total_events) AS avg_events_per_session,
        row_number() OVER (ORDER BY _batch_date, count(*) DESC, device_type NULLS FIRST) AS position
    FROM sessions GROUP BY 1, 2""", SESSION_INPUTS)
def rpt_funnel(t):
    return reports.rpt_conversion_funnel(session_facts(t))
