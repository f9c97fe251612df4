"""Silver entities, staging views and bronze over the supplied tables."""

from pyspark.sql import functions as F

from lakestay import fixed_values as fv
from lakestay.operators.frames import union_frames
from lakestay.plans import staging
from lakestay.plans.bronze import bronze_ingest
from lakestay.plans.silver import entity, silver_frames
from lakestay.registry.core import flat, query
from lakestay.session import work_folder
from lakestay.sinks.batches import write_quarantine
from lakestay.sources.readers import SOURCES, day_path, layer_path, read_day, read_layer, read_rejected

# ---- the same typing in the other engine's SQL ---------------------------------


def _text(c):
    return f"NULLIF(trim({c}), '')"


def _money(c):
    return f"TRY_CAST(NULLIF(regexp_replace({c}, '[^0-9.]', '', 'g'), '') AS DECIMAL(15,2))"


def _bool(c):
    return (f"COALESCE(CASE WHEN lower(trim({c})) IN ('true', '1', 'yes', 'y') THEN true "
            f"WHEN lower(trim({c})) IN ('false', '0', 'no', 'n') THEN false END, false)")


def _date(c):
    return f"CAST(try_strptime({_text(c)}, '%Y-%m-%d') AS DATE)"


def _time(c):
    return f"CAST(try_strptime({_text(c)}, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP)"


def _int(c):
    return f"TRY_CAST({_text(c)} AS INTEGER)"


def _status(c):
    return (f"CASE WHEN upper(trim({c})) IN ('CONFIRMED', 'CONFIRM', '1') THEN 'CONFIRMED' "
            f"WHEN upper(trim({c})) IN ('CANCELLED', 'CANCELED', 'CANCEL') THEN 'CANCELLED' "
            f"WHEN upper(trim({c})) IN ('PENDING', 'NO_SHOW') THEN upper(trim({c})) ELSE 'UNKNOWN' END")


def _channel(c):
    return (f"CASE WHEN lower(trim({c})) IN ('app_ios', 'app_android', 'mobile app') THEN 'Mobile App' "
            f"WHEN lower(trim({c})) IN ('web', 'website') THEN 'Web' "
            f"WHEN lower(trim({c})) LIKE 'partner%' THEN 'Partner API' ELSE 'Other' END")


def _title(c):
    words = f"string_split({_text(c)}, ' ')"
    return f"array_to_string([upper(w[1]) || lower(w[2:]) FOR w IN {words}], ' ')"


TYPED = {
    "bookings": f"""SELECT upper({_text('booking_id')}) AS booking_id, upper({_text('hotel_id')}) AS hotel_id,
        upper({_text('user_id')}) AS user_id, {_text('room_type')} AS room_type, {_date('checkin_date')} AS checkin_date,
        {_date('checkout_date')} AS checkout_date, {_money('total_amount')} AS total_amount, upper({_text('currency')}) AS currency,
        {_status('booking_status')} AS booking_status, {_channel('source_channel')} AS booking_channel,
        upper({_text('payment_method')}) AS payment_method, {_time('created_at')} AS created_at,
        CAST({_date('checkout_date')} - {_date('checkin_date')} AS INTEGER) AS nights, _source_file, _batch_date FROM bronze_bookings""",
    "hotels": f"""SELECT upper({_text('hotel_id')}) AS hotel_id, {_text('hotel_name')} AS hotel_name, lower({_text('hotel_tier')}) AS hotel_tier,
        {_int('star_rating')} AS star_rating, {_text('city')} AS city, upper({_text('country')}) AS country, {_text('region')} AS region,
        TRY_CAST({_text('latitude')} AS DOUBLE) AS latitude, TRY_CAST({_text('longitude')} AS DOUBLE) AS longitude,
        {_int('total_rooms')} AS total_rooms, COALESCE(lower(regexp_replace(facilities, '[\\[\\]''" ]', '', 'g')), '') AS facilities,
        {_date('partner_since')} AS partner_since, {_bool('is_active')} AS is_active, _ingested_at, _source_file, _batch_date FROM bronze_hotels""",
    "payments": f"""SELECT upper({_text('payment_id')}) AS payment_id, upper({_text('booking_id')}) AS booking_id, {_money('amount')} AS amount,
        upper({_text('currency')}) AS currency, upper({_text('payment_method')}) AS payment_method, upper({_text('payment_status')}) AS payment_status,
        COALESCE({_text('gateway_code')}, '') AS gateway_code, {_time('processed_at')} AS processed_at,
        COALESCE({_money('refund_amount')}, 0) AS refund_amount, {_time('refund_at')} AS refund_at, _source_file, _batch_date FROM bronze_payments""",
    "customers": f"""SELECT upper({_text('user_id')}) AS user_id, COALESCE(sha256(lower({_text('email')})), '') AS email_hash,
        COALESCE(sha256(regexp_replace({_text('phone')}, '[^0-9+]', '', 'g')), '') AS phone_hash, upper({_text('country')}) AS country,
        lower({_text('user_segment')}) AS user_segment, {_title('loyalty_tier')} AS loyalty_tier,
        COALESCE({_int('loyalty_points')}, 0) AS loyalty_points, {_date('first_booking_date')} AS first_booking_date,
        COALESCE({_int('total_bookings')}, 0) AS total_bookings, {_bool('is_active')} AS is_active, {_date('registered_at')} AS registered_at,
        _ingested_at, _source_file, _batch_date FROM bronze_customers""",
    "clickstream": f"""SELECT {_text('event_id')} AS event_id, {_text('session_id')} AS session_id, upper({_text('user_id')}) AS user_id,
        lower({_text('event_type')}) AS event_type, COALESCE({_text('page_url')}, '') AS page_url, upper({_text('hotel_id')}) AS hotel_id,
        {_text('search_query')} AS search_query, lower({_text('device_type')}) AS device_type, COALESCE({_text('os')}, '') AS os,
        {_time('event_timestamp')} AS event_timestamp, _source_file, _batch_date FROM bronze_clickstream""",
}
REASONS = {
    "bookings": """CASE WHEN booking_id IS NULL THEN 'MISSING_BOOKING_ID' END, CASE WHEN hotel_id IS NULL THEN 'MISSING_HOTEL_ID' END,
        CASE WHEN checkin_date IS NULL OR checkout_date IS NULL THEN 'INVALID_DATE' END,
        CASE WHEN COALESCE(nights, 0) <= 0 THEN 'NON_POSITIVE_NIGHTS' END, CASE WHEN total_amount IS NULL THEN 'INVALID_AMOUNT' END,
        CASE WHEN currency IS NULL THEN 'MISSING_CURRENCY' END""",
    "hotels": """CASE WHEN hotel_id IS NULL THEN 'MISSING_HOTEL_ID' END, CASE WHEN hotel_name IS NULL THEN 'MISSING_HOTEL_NAME' END,
        CASE WHEN NOT COALESCE(star_rating BETWEEN 1 AND 5, false) THEN 'INVALID_STAR_RATING' END,
        CASE WHEN COALESCE(total_rooms, 0) <= 0 THEN 'INVALID_TOTAL_ROOMS' END""",
    "payments": """CASE WHEN payment_id IS NULL THEN 'MISSING_PAYMENT_ID' END, CASE WHEN booking_id IS NULL THEN 'MISSING_BOOKING_ID' END,
        CASE WHEN amount IS NULL THEN 'INVALID_AMOUNT' END, CASE WHEN processed_at IS NULL THEN 'INVALID_PROCESSED_AT' END""",
    "customers": """CASE WHEN user_id IS NULL THEN 'MISSING_USER_ID' END, CASE WHEN email_hash = '' THEN 'MISSING_EMAIL' END""",
    "clickstream": """CASE WHEN event_id IS NULL THEN 'MISSING_EVENT_ID' END, CASE WHEN session_id IS NULL THEN 'MISSING_SESSION_ID' END,
        CASE WHEN event_timestamp IS NULL THEN 'INVALID_TIMESTAMP' END, CASE WHEN event_type IS NULL THEN 'MISSING_EVENT_TYPE' END""",
}


def judged_sql(name, prefix=""):
    return f"{prefix}judged AS (SELECT *, concat_ws(';', {REASONS[name]}) AS _dq_reason FROM ({TYPED[name]}))"


def ranked_sql(name, prefix=""):
    key, recency = fv.ENTITY_KEYS[name]
    return f"""{judged_sql(name, prefix)}, {prefix}ranked AS (SELECT *,
        row_number() OVER (PARTITION BY {key} ORDER BY {recency} DESC NULLS LAST, _source_file) AS rn
        FROM {prefix}judged WHERE _dq_reason = '')"""


def _times_as_text(columns, times=("created_at", "processed_at", "refund_at", "event_timestamp")):
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c}" if c in times else c for c in columns)


def bronze(t, name):
    """The bronze table of an entity, with the place of each row."""
    table = t.stored(t(f"bronze_{name}"), f"bronze-{name}")
    return table.select("*", F.concat_ws("#", "_metadata.file_path", "_metadata.row_index").alias("_row_id"))


def _register_silver(name):
    columns = [*fv.STAGING_COLUMNS[name], fv.BATCH_DATE]

    @query(
        f"silver_{name}",
        f"WITH {ranked_sql(name)} SELECT {_times_as_text(columns)} FROM ranked WHERE rn = 1",
        (f"bronze_{name}",),
    )
    def silver(t):
        return flat(silver_frames(name, bronze(t, name))[0].select(*columns))


for _name in SOURCES:
    _register_silver(_name)


@query("quarantine_summary", "WITH " + ", ".join(ranked_sql(n, f"{n}_") for n in SOURCES) + " UNION ALL ".join(
    f""" SELECT '{n}' AS entity, _dq_reason, count(*) AS n_rows FROM {n}_judged WHERE _dq_reason <> '' GROUP BY ALL
    UNION ALL SELECT '{n}', 'DUPLICATE_KEY', count(*) FROM {n}_ranked WHERE rn > 1 HAVING count(*) > 0 """ for n in SOURCES),
    tuple(f"bronze_{n}" for n in SOURCES))
def quarantine_summary(t):
    """Quarantined rows of every entity per reason."""
    parts = []
    for name in SOURCES:
        rest = silver_frames(name, bronze(t, name))[1]
        parts.append(
            rest.groupBy(F.lit(name).alias("entity"), fv.DQ_REASON).agg(F.count("*").alias("n_rows"))
        )
    return union_frames(parts)


@query("quarantine_sink", f"""WITH {ranked_sql('payments')}
    SELECT payment_id, booking_id, amount, _dq_reason, DATE '2026-10-01' AS _batch_date FROM judged WHERE _dq_reason <> ''
    UNION ALL SELECT payment_id, booking_id, amount, 'DUPLICATE_KEY', DATE '2026-10-01' FROM ranked WHERE rn > 1""", ("bronze_payments",))
def quarantine_sink(t):
    """The payments kept out of silver, written to quarantine twice and read back."""
    table = work_folder(t.spark, "quarantine")
    rest = silver_frames("payments", bronze(t, "payments"))[1]
    rest = rest.select("payment_id", "booking_id", "amount", fv.DQ_REASON)
    for _ in range(2):
        write_quarantine(rest, table, "2026-10-01")
    return read_day(t.spark, table, "2026-10-01")


# ---- staging views -------------------------------------------------------------

VIEWS = {
    "bookings": f"""upper(trim(booking_id)) AS booking_id, upper(trim(hotel_id)) AS hotel_id, upper(trim(user_id)) AS user_id,
        trim(room_type) AS room_type, checkin_date, checkout_date, total_amount, upper(trim(currency)) AS currency,
        {_status('booking_status')} AS booking_status, {_channel('booking_channel')} AS booking_channel,
        upper(trim(payment_method)) AS payment_method, nights, CAST(created_at AS VARCHAR) AS created_at, _batch_date""",
    "hotels": """upper(trim(hotel_id)) AS hotel_id, trim(hotel_name) AS hotel_name, lower(trim(hotel_tier)) AS hotel_tier, star_rating,
        trim(city) AS city, upper(trim(country)) AS country, trim(region) AS region, latitude, longitude, total_rooms,
        array_to_string(list_sort([x FOR x IN string_split(lower(facilities), ',') IF x <> '']), ',') AS facilities,
        partner_since, is_active, _batch_date""",
    "payments": """trim(payment_id) AS payment_id, trim(booking_id) AS booking_id, amount, upper(trim(currency)) AS currency,
        trim(payment_method) AS payment_method, upper(trim(payment_status)) AS payment_status, trim(gateway_code) AS gateway_code,
        CAST(processed_at AS VARCHAR) AS processed_at, COALESCE(refund_amount, 0) AS refund_amount, CAST(refund_at AS VARCHAR) AS refund_at, _batch_date""",
    "customers": """upper(trim(user_id)) AS user_id, email_hash, phone_hash, upper(trim(country)) AS country,
        lower(trim(user_segment)) AS user_segment, trim(loyalty_tier) AS loyalty_tier, loyalty_points, first_booking_date,
        total_bookings, is_active, registered_at, _batch_date""",
    "clickstream": """trim(event_id) AS event_id, trim(session_id) AS session_id, NULLIF(upper(trim(user_id)), '') AS user_id,
        lower(trim(event_type)) AS event_type, trim(page_url) AS page_url, NULLIF(upper(trim(hotel_id)), '') AS hotel_id,
        NULLIF(trim(search_query), '') AS search_query, lower(trim(device_type)) AS device_type, trim(os) AS os,
        CAST(event_timestamp AS VARCHAR) AS event_timestamp, _batch_date""",
}


def _register_staging(name):
    key, version = fv.STAGING_VERSIONS[name]
    ties = [c for c in (*fv.STAGING_COLUMNS[name], *fv.STAGING_META) if c not in (*key, version)]
    order = ", ".join([f"{version} DESC NULLS LAST", *[f"{c} NULLS FIRST" for c in ties]])

    @query(
        f"stg_{name}",
        f"""SELECT {VIEWS[name]} FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(key)} ORDER BY {order}) AS rn
            FROM staging_{name} WHERE {key[0]} <> '') WHERE rn = 1""",
        (f"staging_{name}",),
    )
    def view(t):
        return flat(staging.staging_view(name, t(f"staging_{name}")))


for _name in SOURCES:
    _register_staging(_name)


@query("stg_batch", """
    SELECT booking_id, hotel_id, total_amount FROM (SELECT upper(trim(booking_id)) AS booking_id, upper(trim(hotel_id)) AS hotel_id, total_amount, _batch_date,
        row_number() OVER (PARTITION BY booking_id ORDER BY _batch_date DESC, hotel_id, user_id, total_amount) AS rn
        FROM staging_bookings WHERE booking_id <> '') WHERE rn = 1 AND _batch_date = DATE '1998-06-15'""", ("staging_bookings",))
def stg_batch(t):
    """One batch without the bookings a later batch replaces."""
    batch = staging.staging_batch("bookings", t("staging_bookings"), "1998-06-15")
    return batch.select("booking_id", "hotel_id", "total_amount")


# ---- bronze --------------------------------------------------------------------


def _landed(c):
    """A field as its file gives it: CSV as it stands, but for the empty text, XML without the white space around."""
    return f"CASE WHEN _source_file = 'part0' THEN NULLIF({c}, '') ELSE trim({c}) END AS {c}"


BROKEN = ("<booking><booking_id>", "</booking_id><hotel_id></booking>")


@query("bronze_ingest", f"""
    SELECT {', '.join(_landed(c) for c in fv.RAW_COLUMNS["bookings"])}, CAST(NULL AS VARCHAR) AS record,
        CASE WHEN _source_file = 'part0' THEN 'csv' ELSE 'xml' END AS _source_format, DATE '2026-10-01' AS _batch_date, 'run' AS _run_id
    FROM bronze_bookings
    UNION ALL SELECT {', '.join('NULL' for _ in fv.RAW_COLUMNS["bookings"])}, '{BROKEN[0]}' || trim(booking_id) || '{BROKEN[1]}',
        'xml', DATE '2026-10-01', NULL FROM bronze_bookings WHERE _source_file <> 'part0' AND hotel_id LIKE 'htl-7%'""", ("bronze_bookings",))
def bronze_ingest_query(t):
    """Bookings landed as CSV and XML files, some records malformed, ingested into bronze and
    rejected rows, and both read back as they are."""
    root = work_folder(t.spark, "bronze")
    raw = t("bronze_bookings").select(*fv.RAW_COLUMNS["bookings"], "_source_file")
    folder = day_path(layer_path(root, "raw", "bookings"), "2026-10-01")
    part0, rest = raw.filter("_source_file = 'part0'"), raw.filter("_source_file <> 'part0'")
    (
        part0.drop("_source_file").write
        .options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(f"{folder}/landed.csv")
    )
    (
        rest.drop("_source_file").write.format("xml")
        .options(rowTag="booking", rootTag="bookings").save(f"{folder}/landed.xml")
    )
    broken = rest.filter("hotel_id LIKE 'htl-7%'")
    broken.select(F.concat(F.lit(BROKEN[0]), F.trim("booking_id"), F.lit(BROKEN[1]))).write.text(f"{folder}/broken.xml")
    bronze_ingest(t.spark, SOURCES["bookings"], root, "2026-10-01", "run")
    bronze = read_layer(t.spark, root, "bronze", "bookings", "2026-10-01")
    kinds = f"{fv.CORRUPT} string, _source_format string"
    rejected = read_rejected(t.spark, day_path(layer_path(root, "rejected", "bookings"), "2026-10-01"), kinds)
    nothing = F.lit(None).cast("string")
    return bronze.select(
        *fv.RAW_COLUMNS["bookings"], nothing.alias("record"), "_source_format", fv.BATCH_DATE, "_run_id"
    ).unionByName(rejected.select(
        *[nothing.alias(c) for c in fv.RAW_COLUMNS["bookings"]], F.col(fv.CORRUPT).alias("record"), "_source_format",
        F.lit("2026-10-01").cast("date").alias(fv.BATCH_DATE), nothing.alias("_run_id"),
    ))
