"""Column expressions and filters over the supplied tables."""

from pyspark.sql import functions as F

from lakestay import fixed_values as fv
from lakestay.functions import keys, labels, parsing
from lakestay.operators.frames import (
    current_members,
    fill_defaults,
    filter_as_of,
    filter_nonempty,
    stringify,
)
from lakestay.registry.core import flat, query
from lakestay.registry.warehouse import hotel_dimension

STATUS_SQL = """CASE WHEN upper(trim({c})) IN ('CONFIRMED', 'CONFIRM', '1') THEN 'CONFIRMED'
     WHEN upper(trim({c})) IN ('CANCELLED', 'CANCELED', 'CANCEL') THEN 'CANCELLED'
     WHEN upper(trim({c})) IN ('PENDING', 'NO_SHOW') THEN upper(trim({c})) ELSE 'UNKNOWN' END"""
CHANNEL_SQL = """CASE WHEN lower(trim({c})) IN ('app_ios', 'app_android', 'mobile app') THEN 'Mobile App'
     WHEN lower(trim({c})) IN ('web', 'website') THEN 'Web'
     WHEN lower(trim({c})) LIKE 'partner%' THEN 'Partner API' ELSE 'Other' END"""


@query("clean_str", """
    SELECT p_partkey, NULLIF(trim(raw), '') AS cleaned
    FROM (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN '  ' WHEN 1 THEN ' ' || p_name || '  ' ELSE p_name END AS raw FROM part)""")
def clean_str(t):
    key, name = F.col("p_partkey"), F.col("p_name")
    raw = F.when(key % 3 == 0, "  ").when(key % 3 == 1, F.concat(F.lit(" "), name, F.lit("  "))).otherwise(name)
    return t("part").select("p_partkey", parsing.clean_str(raw).alias("cleaned"))


@query("parse_money", """
    SELECT total_amount AS raw, COUNT(*) AS n,
           MIN(TRY_CAST(NULLIF(regexp_replace(total_amount, '[^0-9.]', '', 'g'), '') AS DECIMAL(15,2))) AS amount
    FROM bronze_bookings GROUP BY total_amount""", ("bronze_bookings",))
def parse_money(t):
    return (
        t("bronze_bookings").groupBy(F.col("total_amount").alias("raw"))
        .agg(F.count("*").alias("n"), F.min(parsing.to_money("total_amount")).alias("amount"))
    )


@query("parse_bool", """
    SELECT o_orderkey,
           CASE WHEN word IN ('true', '1', 'yes', 'y') THEN true WHEN word IN ('false', '0', 'no', 'n') THEN false END AS flag
    FROM (SELECT o_orderkey, lower(trim(CASE o_orderstatus WHEN 'F' THEN ' Yes' WHEN 'O' THEN 'FALSE' ELSE
            CASE o_orderkey % 4 WHEN 0 THEN '1' WHEN 1 THEN 'N ' WHEN 2 THEN 'perhaps' ELSE '' END END)) AS word FROM orders)""")
def parse_bool(t):
    rest = F.col("o_orderkey") % 4
    other = F.when(rest == 0, "1").when(rest == 1, "N ").when(rest == 2, "perhaps").otherwise("")
    status = F.col("o_orderstatus")
    raw = F.when(status == "F", " Yes").when(status == "O", "FALSE").otherwise(other)
    return t("orders").select("o_orderkey", parsing.to_bool(raw).alias("flag"))


@query("parse_date", """
    SELECT booking_id, created_at AS at, CAST(try_strptime(NULLIF(trim(checkin_date), ''), '%Y-%m-%d') AS DATE) AS checkin
    FROM bronze_bookings""", ("bronze_bookings",))
def parse_date(t):
    return t("bronze_bookings").select(
        "booking_id", F.col("created_at").alias("at"), parsing.parse_date("checkin_date").alias("checkin")
    )


@query("parse_timestamp", """
    SELECT _source_file AS src, CAST(try_strptime(NULLIF(trim(event_timestamp), ''), '%Y-%m-%d %H:%M:%S') AS VARCHAR) AS at
    FROM bronze_clickstream""", ("bronze_clickstream",))
def parse_timestamp(t):
    return flat(t("bronze_clickstream").select(
        F.col("_source_file").alias("src"), parsing.parse_ts("event_timestamp").alias("at")
    ))


@query("parse_number", """
    SELECT p_partkey, TRY_CAST(NULLIF(trim(size_text), '') AS INTEGER) AS size_int,
           TRY_CAST(NULLIF(trim(price_text), '') AS DOUBLE) AS price
    FROM (SELECT p_partkey,
            CASE WHEN p_partkey % 7 = 0 THEN 'big' WHEN p_partkey % 7 = 1 THEN ' ' ELSE ' ' || p_size || ' ' END AS size_text,
            CASE WHEN p_partkey % 5 = 0 THEN '12,5' ELSE CAST(CAST(p_retailprice AS DECIMAL(15,2)) AS VARCHAR) END AS price_text
          FROM part)""")
def parse_number(t):
    key = F.col("p_partkey")
    size = F.when(key % 7 == 0, "big").when(key % 7 == 1, " ").otherwise(
        F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(" "))
    )
    price = F.when(key % 5 == 0, "12,5").otherwise(F.col("p_retailprice").cast("decimal(15,2)").cast("string"))
    return t("part").select(
        "p_partkey", parsing.parse_int(size).alias("size_int"), parsing.parse_double(price).alias("price")
    )


@query("normalize_case", """
    SELECT c_custkey, upper(trim(c_mktsegment)) AS up, lower(trim(c_mktsegment)) AS low,
           upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS title
    FROM customer""")
def normalize_case(t):
    segment = parsing.clean_str("c_mktsegment")
    return t("customer").select(
        "c_custkey", F.upper(segment).alias("up"), F.lower(segment).alias("low"),
        F.initcap(segment).alias("title"),
    )


@query("map_status", f"""
    SELECT booking_status AS raw, {STATUS_SQL.format(c='booking_status')} AS status, COUNT(*) AS n
    FROM bronze_bookings GROUP BY 1, 2""", ("bronze_bookings",))
def map_status(t):
    return t("bronze_bookings").groupBy(
        F.col("booking_status").alias("raw"), labels.map_status("booking_status").alias("status")
    ).agg(F.count("*").alias("n"))


@query("map_channel", f"""
    SELECT source_channel AS raw, {CHANNEL_SQL.format(c='source_channel')} AS channel, COUNT(*) AS n
    FROM bronze_bookings GROUP BY 1, 2""", ("bronze_bookings",))
def map_channel(t):
    return t("bronze_bookings").groupBy(
        F.col("source_channel").alias("raw"), labels.map_channel("source_channel").alias("channel")
    ).agg(F.count("*").alias("n"))


@query("clean_list_literal", """
    SELECT p_partkey, COALESCE(lower(regexp_replace(raw, '[\\[\\]''" ]', '', 'g')), '') AS tags
    FROM (SELECT p_partkey, CASE WHEN p_partkey % 6 = 0 THEN NULL WHEN p_partkey % 2 = 0
            THEN '[''' || p_type || ''', ''' || p_brand || ''']' ELSE '["' || p_name || '"]' END AS raw FROM part)""")
def clean_list_literal(t):
    raw = F.expr("""CASE WHEN p_partkey % 6 = 0 THEN NULL WHEN p_partkey % 2 = 0
        THEN concat("['", p_type, "', '", p_brand, "']") ELSE concat('["', p_name, '"]') END""")
    return t("part").select("p_partkey", parsing.clean_list_literal(raw).alias("tags"))


@query("tag_array", """
    SELECT p_partkey, array_to_string(tags, ',') AS tags, CAST(len(tags) AS INTEGER) AS n_tags
    FROM (SELECT p_partkey, list_sort([x FOR x IN string_split(lower(replace(p_name, ' ', ',,') || ',' || p_type), ',') IF x <> '']) AS tags FROM part)""")
def tag_array(t):
    text = F.concat(F.replace("p_name", F.lit(" "), F.lit(",,")), F.lit(","), F.col("p_type"))
    tags = t("part").select("p_partkey", parsing.to_tag_array(text).alias("tags"))
    return flat(tags.withColumn("n_tags", F.size("tags")))


@query("mask_pii", """
    SELECT _source_file AS src, COALESCE(sha256(lower(NULLIF(trim(email), ''))), '') AS email_hash,
           COALESCE(sha256(regexp_replace(NULLIF(trim(phone), ''), '[^0-9+]', '', 'g')), '') AS phone_hash
    FROM bronze_customers""", ("bronze_customers",))
def mask_pii(t):
    return t("bronze_customers").select(
        F.col("_source_file").alias("src"), keys.mask_email("email").alias("email_hash"),
        keys.mask_phone("phone").alias("phone_hash"),
    )


@query("stay_nights", """
    SELECT CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) AS nights, COUNT(*) AS n
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""")
def stay_nights(t):
    both = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    nights = parsing.stay_nights(F.to_date("o_orderdate"), F.to_date("l_shipdate")).cast("long")
    return both.groupBy(nights.alias("nights")).agg(F.count("*").alias("n"))


@query("fill_defaults", """
    SELECT event_id, COALESCE(CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type END, 'none') AS event_type,
           COALESCE(CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END, 0) AS value,
           COALESCE(CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_id % 2 = 0 END, false) AS even
    FROM events""")
def fill_defaults_query(t):
    key = F.col("event_id")
    holes = t("events").select(
        "event_id",
        F.when(key % 3 != 0, F.col("event_type")).alias("event_type"),
        F.when(key % 5 != 0, F.col("value")).alias("value"),
        F.when(key % 7 != 0, key % 2 == 0).alias("even"),
    )
    return fill_defaults(holes, {"event_type": "none", "value": 0.0, "even": False})


@query("null_if_empty", """
    SELECT event_id, NULLIF(CASE WHEN event_id % 4 = 0 THEN '' ELSE props END, '') AS props FROM events""")
def null_if_empty(t):
    props = F.when(F.col("event_id") % 4 == 0, "").otherwise(F.col("props"))
    return t("events").select("event_id", parsing.null_if_empty(props).alias("props"))


@query("date_id", """
    SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_id, COUNT(*) AS n FROM orders GROUP BY 1""")
def date_id(t):
    return t("orders").groupBy(keys.date_id("o_orderdate").alias("date_id")).agg(F.count("*").alias("n"))


# The oracle divides in whole millionths, so that it is exact too.
USD_SQL = """CASE WHEN {rate} <> 0 THEN CAST(CAST(
    (CAST({amount} * 100 AS HUGEINT) * 2000000 + CAST({rate} * 1000000 AS HUGEINT))
    // (2 * CAST({rate} * 1000000 AS HUGEINT)) AS DECIMAL(20,0)) / 100 AS DECIMAL(18,2)) END"""


@query("to_usd", f"""
    SELECT booking_id, {USD_SQL.format(amount='total_amount', rate='rate')} AS amount_usd
    FROM (SELECT booking_id, total_amount, CASE CAST(substr(booking_id, 4) AS BIGINT) % 4 WHEN 0 THEN CAST(24500 AS DECIMAL(18,6))
            WHEN 1 THEN CAST(1.35 AS DECIMAL(18,6)) WHEN 2 THEN CAST(0 AS DECIMAL(18,6)) END AS rate FROM bookings)""", ("bookings",))
def to_usd(t):
    rest = F.substring("booking_id", 4, 20).cast("long") % 4
    rate = F.when(rest == 0, F.lit("24500")).when(rest == 1, F.lit("1.35")).when(rest == 2, F.lit("0"))
    return t("bookings").select(
        "booking_id", keys.to_usd(F.col("total_amount"), rate.cast("decimal(18,6)")).alias("amount_usd")
    )


@query("status_flags", """
    SELECT booking_id, booking_status = 'CANCELLED' AS is_cancelled, booking_status = 'NO_SHOW' AS is_no_show
    FROM bookings""", ("bookings",))
def status_flags(t):
    return t("bookings").select(
        "booking_id", labels.is_status("booking_status", "CANCELLED").alias("is_cancelled"),
        labels.is_status("booking_status", "NO_SHOW").alias("is_no_show"),
    )


@query("case_map", """
    SELECT event_id, CASE device_type WHEN 'mobile' THEN 2 WHEN 'tablet' THEN 2 WHEN 'desktop' THEN 1 ELSE 4 END AS channel_id
    FROM clicks""", ("clicks",))
def case_map(t):
    return t("clicks").select("event_id", labels.device_channel(F.col("device_type")).alias("channel_id"))


KEY_SQL = (
    "(CAST(('0x' || substr(md5({text}), 1, 15)) AS BIGINT) * 8"
    " + CAST(('0x' || substr(md5({text}), 16, 1)) AS BIGINT) // 2)"
)


@query("surrogate_key", f"""
    SELECT c_custkey, {KEY_SQL.format(text="c_name || '|' || CAST(c_nationkey AS VARCHAR)")} AS sk FROM customer""")
def surrogate_key(t):
    return t("customer").select("c_custkey", keys.surrogate_key("c_name", "c_nationkey").alias("sk"))


@query("stringify", """
    SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name,
           '{"region":' || n_regionkey || ',"name":"' || n_name || '"}' AS nested, n_regionkey
    FROM nation JOIN customer ON c_nationkey = n_nationkey""")
def stringify_query(t):
    nested = F.struct(F.col("n_regionkey").alias("region"), F.col("n_name").alias("name")).alias("nested")
    rows = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return stringify(rows.select("n_nationkey", "n_name", nested, "n_regionkey"), keep=("n_regionkey",))


@query("filter_nonempty_key", """
    SELECT event_id, session_id FROM staging_clickstream WHERE event_id IS NOT NULL AND event_id <> ''""",
    ("staging_clickstream",))
def filter_nonempty_key(t):
    return filter_nonempty(t("staging_clickstream"), "event_id").select("event_id", "session_id")


@query("filter_status", """
    SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'""")
def filter_status(t):
    return t("orders").filter(labels.is_status("o_orderstatus", "F")).select("o_orderkey", "o_custkey")


@query("filter_as_of", """
    SELECT booking_id, _batch_date FROM bookings WHERE _batch_date <= DATE '2024-01-20'""", ("bookings",))
def filter_as_of_query(t):
    return filter_as_of(t("bookings"), "2024-01-20").select("booking_id", fv.BATCH_DATE)


@query("dim_current", """
    WITH newest AS (SELECT hotel_id, max(_batch_date) AS last_seen FROM hotel_snapshots GROUP BY hotel_id)
    SELECT s.hotel_id, s.hotel_tier, s.total_rooms FROM hotel_snapshots s JOIN newest n ON n.hotel_id = s.hotel_id AND n.last_seen = s._batch_date""",
    ("hotel_snapshots",))
def dim_current(t):
    return current_members(hotel_dimension(t), "hotel_sk").select("hotel_id", "hotel_tier", "total_rooms")


@query("predicates", """
    SELECT p_partkey FROM part
    WHERE p_type IN ('ECONOMY', 'SMALL') AND p_size BETWEEN 5 AND 30 AND p_name LIKE 'small%'
      OR NOT (p_retailprice > 950) AND p_brand IS NOT NULL""")
def predicates(t):
    wanted = (
        F.col("p_type").isin("ECONOMY", "SMALL")
        & F.col("p_size").between(5, 30)
        & F.col("p_name").startswith("small")
    )
    cheap = ~(F.col("p_retailprice") > 950) & F.col("p_brand").isNotNull()
    return t("part").filter(wanted | cheap).select("p_partkey")


@query("scalar_string", """
    SELECT p_partkey, upper(p_name) AS up, lower(p_type) AS low, trim('  ' || p_brand || ' ') AS trimmed,
           concat_ws('|', p_brand, CASE WHEN p_partkey % 2 = 0 THEN NULL ELSE p_type END, p_name) AS joined,
           regexp_replace(p_name, '[aeiou]', '', 'g') AS consonants, starts_with(p_brand, 'Brand#1') AS brand1,
           string_split(p_name, ' ')[1] AS first_word, sha256(p_name) AS digest,
           COALESCE(NULLIF(p_type, 'ECONOMY'), 'none') AS kind
    FROM part""")
def scalar_string(t):
    odd_type = F.when(F.col("p_partkey") % 2 != 0, F.col("p_type"))
    return t("part").select(
        "p_partkey", F.upper("p_name").alias("up"), F.lower("p_type").alias("low"),
        F.trim(F.concat(F.lit("  "), "p_brand", F.lit(" "))).alias("trimmed"),
        F.concat_ws("|", "p_brand", odd_type, "p_name").alias("joined"),
        F.regexp_replace("p_name", "[aeiou]", "").alias("consonants"),
        F.startswith("p_brand", F.lit("Brand#1")).alias("brand1"),
        F.split("p_name", " ")[0].alias("first_word"), F.sha2("p_name", 256).alias("digest"),
        F.coalesce(F.nullif("p_type", F.lit("ECONOMY")), F.lit("none")).alias("kind"),
    )


@query("scalar_math", """
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(round(CAST(l_extendedprice AS DECIMAL(15,2)), 1) AS DECIMAL(15,1)) AS rounded,
           abs(l_linenumber - 4) AS distance, greatest(l_linenumber, 3) AS at_least,
           CAST(l_extendedprice AS DECIMAL(15,2)) * l_linenumber + 1 AS scaled,
           date_diff('day', CAST(l_shipdate AS DATE), DATE '2002-01-01') AS days_left,
           CAST(l_shipdate AS DATE) + l_linenumber AS later,
           CAST(l_quantity AS INTEGER) AS whole
    FROM lineitem""")
def scalar_math(t):
    price, line = F.col("l_extendedprice").cast("decimal(15,2)"), F.col("l_linenumber")
    shipped = F.to_date("l_shipdate")
    return t("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.round(price, 1).cast("decimal(15,1)").alias("rounded"),
        F.abs(line - 4).alias("distance"), F.greatest(line, F.lit(3)).alias("at_least"),
        (price * line + 1).alias("scaled"),
        F.datediff(F.lit("2002-01-01").cast("date"), shipped).cast("long").alias("days_left"),
        F.date_add(shipped, line).alias("later"), F.col("l_quantity").cast("int").alias("whole"),
    )
