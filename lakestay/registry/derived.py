"""Inputs in the shape of the bookings business, derived from the supplied tables.

The texts are in the part of SQL that Spark and DuckDB share, so one text
serves both engines; {name} is a supplied table or another derived frame.
Every row of the supplied table is used.
"""

_AMOUNT = "CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS STRING)"
_LINE_AMOUNT = "CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS STRING)"
_INGESTED = "TIMESTAMP '2026-10-01 02:00:00' AS _ingested_at"

DERIVED = {
    # ---- raw text with faults -------------------------------------------------
    "bronze_bookings": f"""
        SELECT
          CASE WHEN o_orderkey % 97 = 0 THEN '  '
               ELSE ' bk-' || CAST(o_orderkey - CASE WHEN o_orderkey % 11 = 5 THEN 1 ELSE 0 END AS STRING) || ' '
          END AS booking_id,
          CASE WHEN o_orderkey % 101 = 0 THEN NULL
               ELSE 'htl-' || CAST(o_custkey % 120 AS STRING) END AS hotel_id,
          CASE WHEN o_orderkey % 53 = 0 THEN '' ELSE 'usr-' || CAST(o_custkey AS STRING) || ' ' END AS user_id,
          CASE o_orderkey % 4 WHEN 0 THEN ' Standard' WHEN 1 THEN 'Deluxe ' WHEN 2 THEN 'Suite' ELSE '' END AS room_type,
          CASE WHEN o_orderkey % 89 = 0 THEN 'soon'
               ELSE CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 10 AS INT) AS STRING) END AS checkin_date,
          CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 10 + o_custkey % 8 AS INT) AS STRING) AS checkout_date,
          CASE WHEN o_orderkey % 71 = 0 THEN 'FREE'
               WHEN o_orderkey % 4 = 0 THEN '$' || {_AMOUNT}
               WHEN o_orderkey % 4 = 1 THEN ' ' || {_AMOUNT} || ' VND '
               WHEN o_orderkey % 4 = 2 THEN substr({_AMOUNT}, 1, 1) || ',' || substr({_AMOUNT}, 2)
               ELSE {_AMOUNT} END AS total_amount,
          CASE WHEN o_orderkey % 83 = 0 THEN ' '
               ELSE CASE o_custkey % 6 WHEN 0 THEN 'usd' WHEN 1 THEN 'VND ' WHEN 2 THEN 'thb'
                                       WHEN 3 THEN 'SGD' WHEN 4 THEN 'IDR' ELSE 'EUR' END END AS currency,
          CASE o_orderstatus
               WHEN 'F' THEN CASE o_orderkey % 3 WHEN 0 THEN 'confirm' WHEN 1 THEN 'CONFIRMED ' ELSE '1' END
               WHEN 'O' THEN 'Pending'
               ELSE CASE o_orderkey % 5 WHEN 0 THEN 'cancel' WHEN 1 THEN 'canceled' WHEN 2 THEN 'CANCELLED'
                                        WHEN 3 THEN 'no_show' ELSE 'lost' END END AS booking_status,
          CASE o_orderpriority WHEN '1-URGENT' THEN 'app_ios' WHEN '2-HIGH' THEN 'APP_ANDROID'
               WHEN '3-MEDIUM' THEN ' website' WHEN '4-NOT SPECIFIED' THEN 'Partner_x'
               ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'web' ELSE 'fax' END END AS source_channel,
          'card' AS payment_method,
          CAST(CAST(o_orderdate AS DATE) AS STRING) || ' ' || lpad(CAST(o_orderkey % 24 AS STRING), 2, '0') || ':15:00' AS created_at,
          'part' || CAST(o_orderkey % 3 AS STRING) AS _source_file,
          {_INGESTED},
          CAST(o_orderdate AS DATE) AS _batch_date
        FROM {{orders}}""",
    "bronze_hotels": f"""
        SELECT
          CASE WHEN s_suppkey % 31 = 3 THEN ''
               ELSE 'htl-' || CAST(s_suppkey - CASE WHEN s_suppkey % 13 = 7 THEN 1 ELSE 0 END AS STRING) END AS hotel_id,
          CASE WHEN s_suppkey % 37 = 2 THEN ' ' ELSE ' ' || s_name END AS hotel_name,
          CASE s_suppkey % 3 WHEN 0 THEN 'Luxury' WHEN 1 THEN ' BUDGET' ELSE 'boutique' END AS hotel_tier,
          CASE WHEN s_suppkey % 29 = 1 THEN 'five' ELSE CAST(s_suppkey % 8 AS STRING) END AS star_rating,
          n_name AS city, lower(n_name) AS country, r_name AS region,
          CAST(CAST(s_acctbal AS DECIMAL(15,2)) AS STRING) AS latitude,
          ' 100.5 ' AS longitude,
          CAST(s_suppkey * 3 - 5 AS STRING) AS total_rooms,
          CASE s_suppkey % 4 WHEN 0 THEN '[''Pool'', ''spa'']' WHEN 1 THEN '["wifi", "Bar"]' WHEN 2 THEN '[]' ELSE NULL END AS facilities,
          CASE WHEN s_suppkey % 5 = 0 THEN '2020-13-01' ELSE '2020-01-15' END AS partner_since,
          CASE s_suppkey % 5 WHEN 0 THEN 'TRUE' WHEN 1 THEN ' yes' WHEN 2 THEN '0' WHEN 3 THEN 'maybe' ELSE '1' END AS is_active,
          'h' || CAST(s_suppkey AS STRING) AS _source_file,
          {_INGESTED},
          DATE '2026-10-01' AS _batch_date
        FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey JOIN {{region}} ON n_regionkey = r_regionkey""",
    "bronze_payments": f"""
        SELECT
          CASE WHEN l_partkey % 61 = 0 THEN NULL
               ELSE 'pay-' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) END AS payment_id,
          CASE WHEN l_partkey % 67 = 0 THEN ' ' ELSE ' bk-' || CAST(l_orderkey AS STRING) END AS booking_id,
          CASE WHEN l_partkey % 71 = 0 THEN 'N/A' WHEN l_suppkey % 2 = 0 THEN '$' || {_LINE_AMOUNT}
               ELSE {_LINE_AMOUNT} || ' THB' END AS amount,
          CASE l_suppkey % 3 WHEN 0 THEN 'usd' WHEN 1 THEN ' thb' ELSE '' END AS currency,
          'ewallet' AS payment_method,
          CASE l_returnflag WHEN 'R' THEN 'refunded' WHEN 'A' THEN 'success' ELSE 'failed' END AS payment_status,
          CASE WHEN l_linestatus = 'O' THEN '' ELSE ' G1' END AS gateway_code,
          CASE WHEN l_partkey % 73 = 0 THEN 'later' ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) || ' 10:00:00' END AS processed_at,
          CASE WHEN l_returnflag = 'R' THEN {_LINE_AMOUNT} ELSE '' END AS refund_amount,
          CASE WHEN l_returnflag = 'R' THEN CAST(CAST(l_shipdate AS DATE) + 2 AS STRING) || ' 11:30:00' ELSE NULL END AS refund_at,
          'f-' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) || '-' || {_LINE_AMOUNT}
             || '-' || l_returnflag || l_linestatus AS _source_file,
          {_INGESTED},
          CAST(l_shipdate AS DATE) AS _batch_date
        FROM {{lineitem}}""",
    "bronze_customers": f"""
        SELECT
          CASE WHEN c_custkey % 43 = 0 THEN '' ELSE ' usr-' || CAST(c_custkey - CASE WHEN c_custkey % 17 = 9 THEN 1 ELSE 0 END AS STRING) END AS user_id,
          c_name AS full_name,
          CASE WHEN c_custkey % 19 = 0 THEN ' ' ELSE ' ' || c_name || '@Example.ORG' END AS email,
          CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE '+84-' || CAST(c_custkey AS STRING) || ' (0)' END AS phone,
          CASE c_nationkey % 3 WHEN 0 THEN 'vn' WHEN 1 THEN 'TH ' ELSE '' END AS country,
          c_mktsegment AS user_segment,
          CASE c_custkey % 3 WHEN 0 THEN 'GOLD tier' WHEN 1 THEN 'silver' ELSE NULL END AS loyalty_tier,
          CASE WHEN c_custkey % 23 = 0 THEN 'many' ELSE CAST(c_custkey * 10 AS STRING) END AS loyalty_points,
          '2024-02-15' AS first_booking_date,
          CASE WHEN c_custkey % 2 = 0 THEN '' ELSE CAST(c_custkey % 9 AS STRING) END AS total_bookings,
          CASE c_custkey % 4 WHEN 0 THEN 'Y' WHEN 1 THEN 'no' WHEN 2 THEN '1' ELSE '' END AS is_active,
          CASE WHEN c_custkey % 29 = 0 THEN '15/06/2025' ELSE '2025-06-15' END AS registered_at,
          'c' || CAST(c_custkey AS STRING) AS _source_file,
          {_INGESTED},
          DATE '2026-10-01' AS _batch_date
        FROM {{customer}}""",
    "bronze_clickstream": f"""
        SELECT
          CASE WHEN event_id % 91 = 0 THEN ' ' ELSE 'evt-' || CAST(event_id - CASE WHEN event_id % 13 = 6 THEN 1 ELSE 0 END AS STRING) || ' ' END AS event_id,
          CASE WHEN event_id % 93 = 1 THEN NULL ELSE CAST(user_id AS STRING) || '-' || CAST(CAST(ts AS DATE) AS STRING) END AS session_id,
          CASE WHEN user_id % 10 = 0 THEN '' ELSE 'usr-' || CAST(user_id AS STRING) END AS user_id,
          CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN ' Click' WHEN 'purchase' THEN 'BOOKING_COMPLETE'
               WHEN 'signup' THEN 'search' ELSE CASE WHEN event_id % 4 = 0 THEN '' ELSE 'error' END END AS event_type,
          CASE WHEN event_id % 2 = 0 THEN '/h/' || CAST(event_id % 120 AS STRING) ELSE NULL END AS page_url,
          CASE WHEN event_type IN ('click', 'purchase') THEN 'htl-' || CAST(event_id % 120 AS STRING) ELSE ' ' END AS hotel_id,
          CASE WHEN event_type = 'signup' THEN ' sea view ' ELSE '' END AS search_query,
          CASE user_id % 4 WHEN 0 THEN 'Mobile' WHEN 1 THEN 'tablet' WHEN 2 THEN 'desktop ' ELSE 'phone' END AS device_type,
          CASE WHEN event_id % 3 = 0 THEN ' iOS' ELSE '' END AS os,
          CASE WHEN event_id % 77 = 0 THEN 'now' ELSE CAST(date_trunc('second', ts) AS STRING) END AS event_timestamp,
          'e' || CAST(event_id AS STRING) AS _source_file,
          {_INGESTED},
          CAST(ts AS DATE) AS _batch_date
        FROM {{events}}""",
    # ---- staging tables: several versions per key ------------------------------
    "staging_bookings": f"""
        SELECT
          CASE WHEN o_orderkey % 97 = 0 THEN '' ELSE 'BK-' || CAST(o_orderkey - o_orderkey % 2 AS STRING) END AS booking_id,
          ' htl-' || CAST(o_custkey % 120 AS STRING) AS hotel_id,
          'usr-' || CAST(o_custkey AS STRING) AS user_id, ' Suite ' AS room_type,
          CAST(o_orderdate AS DATE) + 3 AS checkin_date, CAST(o_orderdate AS DATE) + 5 AS checkout_date,
          CAST(o_totalprice AS DECIMAL(15,2)) AS total_amount, 'usd ' AS currency,
          CASE o_orderstatus WHEN 'F' THEN 'confirm' WHEN 'O' THEN 'CANCELED' ELSE 'no_show' END AS booking_status,
          CASE o_orderpriority WHEN '1-URGENT' THEN 'Mobile App' WHEN '2-HIGH' THEN 'web'
               WHEN '3-MEDIUM' THEN 'Partner API' ELSE 'Other' END AS booking_channel,
          ' card' AS payment_method, 2 AS nights,
          CAST(o_orderdate AS TIMESTAMP) AS created_at,
          {_INGESTED}, 'part' || CAST(o_orderkey AS STRING) AS _source_file,
          CAST(o_orderdate AS DATE) AS _batch_date
        FROM {{orders}}""",
    "staging_hotels": f"""
        SELECT
          CASE WHEN l_suppkey % 31 = 3 THEN '' ELSE 'htl-' || CAST(l_suppkey AS STRING) END AS hotel_id,
          ' Hotel ' || CAST(l_suppkey AS STRING) AS hotel_name, 'LUXURY ' AS hotel_tier,
          CAST(l_linenumber % 5 + 1 AS INT) AS star_rating,
          ' Hue' AS city, 'vn ' AS country, 'Central ' AS region,
          CAST(l_quantity AS DOUBLE) AS latitude, CAST(100.5 AS DOUBLE) AS longitude,
          CAST(l_partkey % 200 AS INT) AS total_rooms,
          CASE l_partkey % 3 WHEN 0 THEN 'wifi,Bar,,pool' WHEN 1 THEN '' ELSE 'spa' END AS facilities,
          DATE '2020-01-15' AS partner_since, l_partkey % 2 = 0 AS is_active,
          TIMESTAMP '2026-10-01 02:00:00' + CAST(l_orderkey % 1000 AS INT) * INTERVAL '1' MINUTE AS _ingested_at,
          'f-' || CAST(l_orderkey AS STRING) || '-' || {_LINE_AMOUNT} AS _source_file,
          DATE '2026-10-01' + CAST(l_linenumber % 4 AS INT) AS _batch_date
        FROM {{lineitem}}""",
    "staging_payments": f"""
        SELECT
          CASE WHEN l_partkey % 61 = 0 THEN '' ELSE 'PAY-' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) END AS payment_id,
          'BK-' || CAST(l_orderkey AS STRING) AS booking_id,
          CAST(l_extendedprice AS DECIMAL(15,2)) AS amount, 'thb' AS currency, ' CARD' AS payment_method,
          CASE l_returnflag WHEN 'R' THEN 'refunded' ELSE 'success ' END AS payment_status,
          ' G' || CAST(l_suppkey AS STRING) AS gateway_code,
          CAST(l_shipdate AS TIMESTAMP) AS processed_at,
          CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(15,2)) ELSE NULL END AS refund_amount,
          CASE WHEN l_returnflag = 'R' THEN CAST(l_shipdate AS TIMESTAMP) ELSE NULL END AS refund_at,
          {_INGESTED},
          'f-' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) || '-' || {_LINE_AMOUNT} || '-' || l_returnflag AS _source_file,
          CAST(l_shipdate AS DATE) AS _batch_date
        FROM {{lineitem}}""",
    "staging_customers": """
        SELECT
          CASE WHEN o_custkey % 43 = 0 THEN '' ELSE 'usr-' || CAST(o_custkey AS STRING) || ' ' END AS user_id,
          'e' || CAST(o_custkey AS STRING) AS email_hash, '' AS phone_hash, 'vn' AS country,
          o_orderpriority AS user_segment, ' Gold' AS loyalty_tier,
          CAST(o_orderkey AS INT) AS loyalty_points, DATE '2024-02-15' AS first_booking_date,
          CAST(o_orderkey % 9 AS INT) AS total_bookings, o_orderstatus = 'F' AS is_active,
          DATE '2023-01-01' AS registered_at,
          TIMESTAMP '2026-10-01 02:00:00' + CAST(o_orderkey % 1000 AS INT) * INTERVAL '1' MINUTE AS _ingested_at,
          'o' || CAST(o_orderkey AS STRING) AS _source_file,
          DATE '2026-10-01' + CAST(o_orderkey % 5 AS INT) AS _batch_date
        FROM {orders}""",
    "staging_clickstream": f"""
        SELECT
          CASE WHEN event_id % 91 = 0 THEN '' ELSE ' evt-' || CAST(event_id - event_id % 3 AS STRING) END AS event_id,
          ' ' || CAST(user_id AS STRING) || '-' || CAST(CAST(ts AS DATE) AS STRING) AS session_id,
          CASE WHEN user_id % 10 = 0 THEN ' ' ELSE 'usr-' || CAST(user_id AS STRING) END AS user_id,
          upper(event_type) AS event_type, ' /h' AS page_url,
          CASE WHEN event_type = 'click' THEN 'htl-1' ELSE '' END AS hotel_id,
          CASE WHEN event_type = 'signup' THEN ' sea ' ELSE ' ' END AS search_query,
          ' Mobile' AS device_type, 'iOS ' AS os,
          CAST(date_trunc('second', ts) AS TIMESTAMP) AS event_timestamp,
          {_INGESTED}, 'e' || CAST(event_id AS STRING) AS _source_file,
          CAST(ts AS DATE) AS _batch_date
        FROM {{events}}""",
    # ---- clean inputs of dimensions and facts ----------------------------------
    "bookings": """
        SELECT
          'BK-' || CAST(o_orderkey AS STRING) AS booking_id,
          CASE WHEN o_orderkey % 23 = 0 THEN 'HTL-NONE'
               ELSE 'HTL-' || CAST((o_custkey % 170) % 50 + o_orderkey % 2 AS STRING) END AS hotel_id,
          'USR-' || CAST(o_custkey % 170 AS STRING) AS user_id,
          CASE o_orderkey % 3 WHEN 0 THEN 'Standard' WHEN 1 THEN 'Deluxe' ELSE 'Suite' END AS room_type,
          DATE '2024-01-01' + CAST(o_orderkey % 40 + o_custkey % 5 AS INT) AS checkin_date,
          DATE '2024-01-01' + CAST(o_orderkey % 40 + o_custkey % 5 + o_orderkey % 7 + 1 AS INT) AS checkout_date,
          CAST(o_totalprice AS DECIMAL(15,2)) AS total_amount,
          CASE o_custkey % 6 WHEN 0 THEN 'USD' WHEN 1 THEN 'VND' WHEN 2 THEN 'THB' WHEN 3 THEN 'SGD'
               WHEN 4 THEN 'IDR' ELSE 'EUR' END AS currency,
          CASE o_orderstatus WHEN 'F' THEN 'CONFIRMED'
               WHEN 'O' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'CANCELLED' ELSE 'NO_SHOW' END
               ELSE 'PENDING' END AS booking_status,
          CASE o_orderpriority WHEN '1-URGENT' THEN 'Mobile App' WHEN '2-HIGH' THEN 'Web'
               WHEN '3-MEDIUM' THEN 'Partner API' ELSE 'Fax' END AS booking_channel,
          'CARD' AS payment_method,
          CAST(o_orderkey % 7 + 1 AS INT) AS nights,
          CAST(DATE '2024-01-01' + CAST(o_orderkey % 40 - o_custkey % 9 AS INT) AS TIMESTAMP)
            + CAST(o_orderkey % 86400 AS INT) * INTERVAL '1' SECOND AS created_at,
          DATE '2024-01-01' + CAST(o_orderkey % 40 AS INT) AS _batch_date
        FROM {orders}""",
    "payments": """
        SELECT
          'PAY-' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) AS payment_id,
          'BK-' || CAST(l_orderkey * 2 - l_orderkey AS STRING) || CASE WHEN l_linenumber = 7 THEN 'X' ELSE '' END AS booking_id,
          CAST(l_extendedprice AS DECIMAL(15,2)) AS amount,
          CASE l_suppkey % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'VND' WHEN 2 THEN 'THB' ELSE 'EUR' END AS currency,
          'CARD' AS payment_method,
          CASE l_returnflag WHEN 'R' THEN 'REFUNDED' WHEN 'A' THEN 'SUCCESS' ELSE 'FAILED' END AS payment_status,
          CAST(l_shipdate AS TIMESTAMP) AS processed_at,
          CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(15,2)) ELSE CAST(0 AS DECIMAL(15,2)) END AS refund_amount,
          DATE '2024-01-01' + CAST(l_partkey % 40 AS INT) AS _batch_date
        FROM {lineitem}""",
    "rates": """
        SELECT * FROM (VALUES
          ('USD', CAST(1 AS DECIMAL(18,6)), DATE '2020-01-01'),
          ('VND', CAST(24500 AS DECIMAL(18,6)), DATE '2020-01-01'),
          ('VND', CAST(25500 AS DECIMAL(18,6)), DATE '2024-01-15'),
          ('THB', CAST(35 AS DECIMAL(18,6)), DATE '2020-01-01'),
          ('THB', CAST(36.25 AS DECIMAL(18,6)), DATE '2024-01-10'),
          ('THB', CAST(0 AS DECIMAL(18,6)), DATE '2024-02-05'),
          ('SGD', CAST(1.35 AS DECIMAL(18,6)), DATE '2024-01-05'),
          ('IDR', CAST(15500 AS DECIMAL(18,6)), DATE '2020-01-01')
        ) AS r(currency, units_per_usd, valid_from)""",
    "hotel_snapshots": """
        SELECT
          'HTL-' || CAST(user_id AS STRING) AS hotel_id,
          'Hotel ' || CAST(user_id AS STRING) AS hotel_name,
          max_by(event_type, event_id) AS hotel_tier,
          CAST(user_id % 5 + 1 AS INT) AS star_rating,
          'City ' || CAST(user_id % 15 AS STRING) AS city,
          CASE user_id % 3 WHEN 0 THEN 'VN' WHEN 1 THEN 'TH' ELSE 'SG' END AS country,
          CASE user_id % 2 WHEN 0 THEN 'North' ELSE 'South' END AS region,
          CAST(user_id AS DOUBLE) AS latitude, CAST(100.5 AS DOUBLE) AS longitude,
          CAST(5 + max(event_id) % 2 AS INT) AS total_rooms,
          CASE WHEN user_id % 2 = 0 THEN 'wifi,pool' ELSE '' END AS facilities_text,
          user_id % 7 <> 0 AS is_active,
          CAST(ts AS DATE) AS _batch_date
        FROM {events} GROUP BY user_id, CAST(ts AS DATE)""",
    "customer_snapshots": """
        SELECT
          'USR-' || CAST(user_id AS STRING) AS user_id,
          'e' || CAST(user_id AS STRING) AS email_hash, '' AS phone_hash,
          CASE user_id % 3 WHEN 0 THEN 'VN' WHEN 1 THEN 'TH' ELSE 'SG' END AS country,
          CASE WHEN max_by(event_type, event_id) = 'purchase' THEN 'premium' ELSE 'standard' END AS user_segment,
          CASE WHEN max(event_id) % 4 = 0 THEN NULL ELSE 'Gold' END AS loyalty_tier,
          CAST(count(*) AS INT) AS loyalty_points, DATE '2023-05-01' AS first_booking_date,
          CAST(1 AS INT) AS total_bookings, true AS is_active, DATE '2022-01-01' AS registered_at,
          CAST(ts AS DATE) AS _batch_date
        FROM {events} GROUP BY user_id, CAST(ts AS DATE)""",
    "clicks": """
        SELECT
          'EVT-' || CAST(event_id AS STRING) AS event_id,
          CAST(user_id AS STRING) || '-' || CAST(CAST(ts AS DATE) AS STRING) AS session_id,
          CASE WHEN user_id % 10 = 0 OR event_id % 5 = 0 THEN NULL ELSE 'USR-' || CAST(user_id AS STRING) END AS user_id,
          CASE event_type WHEN 'view' THEN 'page_view' WHEN 'purchase' THEN 'booking_complete'
               WHEN 'signup' THEN 'search' ELSE event_type END AS event_type,
          CASE WHEN event_type IN ('click', 'purchase') THEN 'HTL-' || CAST(user_id % 50 + (event_id % 3) % 2 AS STRING) ELSE NULL END AS hotel_id,
          CASE user_id % 4 WHEN 0 THEN 'mobile' WHEN 1 THEN 'tablet' WHEN 2 THEN 'desktop' ELSE 'phone' END AS device_type,
          CAST(date_trunc('second', ts) AS TIMESTAMP) AS event_timestamp,
          CAST(ts AS DATE) AS _batch_date
        FROM {events}""",
    # Last event of each user and day.
    "user_days": """
        SELECT user_id, CAST(ts AS DATE) AS day, max_by(event_type, event_id) AS event_type
        FROM {events} GROUP BY user_id, CAST(ts AS DATE)""",
}
