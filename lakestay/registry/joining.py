"""Joins over the supplied tables."""

from pyspark.sql import functions as F

from lakestay.operators import joins
from lakestay.operators.scd2 import scd2
from lakestay.registry.core import flat, query
from lakestay.registry.warehouse import hotel_dimension
from lakestay.sources import seeds


def _purchases(t):
    return t("events").filter("event_type = 'purchase'").select("event_id", "user_id", "ts", "value")


def _signups(t):
    """One signup per user and moment, the smallest id."""
    ids = t("events").filter("event_type = 'signup'").groupBy("user_id", "ts")
    return ids.agg(F.min("event_id").alias("signup_id"))


ASOF_SQL = """
    SELECT p.event_id, p.user_id, CAST(s.ts AS VARCHAR) AS signup_ts, s.signup_id
    FROM (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase') p
    ASOF LEFT JOIN (SELECT user_id, ts, min(event_id) AS signup_id FROM events WHERE event_type = 'signup' GROUP BY ALL) s
      ON p.user_id = s.user_id AND p.ts >= s.ts"""


def _asof(t, join, **options):
    # CAST of times to text differs in trailing zeros between engines; compare whole micros.
    signups = _signups(t).withColumn("signup_ts", F.unix_micros(F.col("ts").cast("timestamp")))
    found = join(
        _purchases(t), signups, ["user_id"], "ts", "ts",
        {"signup_ts": "signup_us", "signup_id": "signup_id"}, **options,
    )
    return found.select("event_id", "user_id", "signup_us", "signup_id")


ASOF_SQL = ASOF_SQL.replace("CAST(s.ts AS VARCHAR) AS signup_ts", "epoch_us(s.ts) AS signup_us")


@query("asof_join", ASOF_SQL)
def asof_join(t):
    return _asof(t, joins.asof_join)


@query("asof_join_union", ASOF_SQL)
def asof_join_union(t):
    return _asof(t, joins.asof_join_sliced)


@query("scd2_lookup", """
    WITH steps AS (SELECT user_id, event_type, day, event_type IS DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id ORDER BY day) AS changed FROM user_days),
    dim AS (SELECT user_id, event_type AS version_type, day AS valid_from FROM steps WHERE changed)
    SELECT e.event_id, d.version_type, COALESCE(CAST(('0x' || substr(md5(CAST(d.user_id AS VARCHAR) || '|' || CAST(d.valid_from AS VARCHAR)), 1, 15)) AS BIGINT) * 8 + CAST(('0x' || substr(md5(CAST(d.user_id AS VARCHAR) || '|' || CAST(d.valid_from AS VARCHAR)), 16, 1)) AS BIGINT) // 2, 0) AS sk
    FROM (SELECT event_id, user_id + (event_id % 9) // 8 AS user_id, CAST(ts AS DATE) - CAST(event_id % 5 AS INTEGER) AS d0 FROM events) e
    ASOF LEFT JOIN dim d ON e.user_id = d.user_id AND e.d0 >= d.valid_from""", ("user_days",))
def scd2_lookup(t):
    dim = scd2(t("user_days"), "user_id", ["event_type"], "sk", "day")
    key = F.col("event_id")
    fact = t("events").select(
        "event_id", (F.col("user_id") + F.floor((key % 9) / 8)).alias("user_id"),
        F.date_sub(F.to_date("ts"), (key % 5).cast("int")).alias("d0"),
    )
    found = joins.scd2_lookup(
        fact, dim, ("user_id", "user_id"), "d0",
        {"event_type": "version_type", "sk": "sk"}, {"sk": F.lit(0).cast("long")},
    )
    return found.select("event_id", "version_type", "sk")


@query("fx_asof", """
    SELECT b.booking_id, b.currency, r.units_per_usd AS fx_units_per_usd
    FROM bookings b ASOF LEFT JOIN rates r ON b.currency = r.currency AND b._batch_date >= r.valid_from""", ("bookings", "rates"))
def fx_asof(t):
    found = joins.fx_asof(t("bookings"), t("rates"), "currency", "_batch_date")
    return found.select("booking_id", "currency", "fx_units_per_usd")


@query("left_join_default", """
    SELECT booking_id, COALESCE(channel_id, 4) AS channel_id
    FROM bookings LEFT JOIN (VALUES (1, 'Web'), (2, 'Mobile App'), (3, 'Partner API'), (4, 'Other')) AS c(channel_id, channel_name)
      ON booking_channel = channel_name""", ("bookings",))
def left_join_default(t):
    found = joins.lookup(
        t("bookings"), seeds.dim_channels(t.spark), {"booking_channel": "channel_name"},
        {"channel_id": "channel_id"}, {"channel_id": F.lit(4)},
    )
    return found.select("booking_id", "channel_id")


@query("orphan_flag", """
    SELECT l_orderkey, l_linenumber, l_partkey, COALESCE(o_custkey, -1) AS o_custkey, o_orderkey IS NULL AS is_orphan
    FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') ON l_orderkey = o_orderkey""")
def orphan_flag(t):
    parents = t("orders").filter("o_orderstatus <> 'P'").select("o_orderkey", "o_custkey")
    lines = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return joins.orphan_flag(
        lines, parents, ("l_orderkey", "o_orderkey"), {"o_custkey": "o_custkey"},
        {"o_custkey": F.lit(-1).cast("long")},
    )


@query("nearest_match", """
    SELECT p.event_id, arg_min(c.event_id, {'d': abs(date_diff('second', date_trunc('second', p.ts), date_trunc('second', c.ts))), 'i': c.event_id}) AS click_id
    FROM (SELECT *, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'purchase') p
    JOIN (SELECT *, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'click') c ON p.user_id = c.user_id AND p.day = c.day
    GROUP BY p.event_id""")
def nearest_match(t):
    events = t("events").withColumn("day", F.to_date("ts"))
    clicks = events.filter("event_type = 'click'").withColumnRenamed("event_id", "click_id")
    return joins.nearest_match(
        events.filter("event_type = 'purchase'"), clicks, ["user_id", "day"], "ts", "ts",
        "click_id", ["event_id"], "click_id",
    )


@query("key_map_join", """
    SELECT b.hotel_id AS booked, h.hotel_id AS mapped, count(*) AS n
    FROM (SELECT booking_id, hotel_id, CAST(substr(booking_id, 4) AS BIGINT) % 3 AS part FROM bookings) b
    JOIN (SELECT DISTINCT hotel_id FROM hotel_snapshots) h ON b.hotel_id = h.hotel_id GROUP BY ALL""", ("bookings", "hotel_snapshots"))
def key_map_join(t):
    """Bookings get the key of a hotel version and are mapped back to the hotel."""
    dim = hotel_dimension(t)
    current = dim.filter("is_current").select("hotel_id", "hotel_sk")
    facts = joins.lookup(
        t("bookings").select("booking_id", F.col("hotel_id").alias("booked")), current,
        {"booked": "hotel_id"}, {"hotel_sk": "hotel_sk"}, {"hotel_sk": F.lit(0).cast("long")},
    )
    mapped = joins.key_map(facts, dim, "hotel_sk", "hotel_id")
    return mapped.groupBy("booked", F.col("hotel_id").alias("mapped")).agg(F.count("*").alias("n"))


@query("preagg_join", """
    SELECT c_custkey, COALESCE(n_orders, 0) AS n_orders, COALESCE(spent, 0) AS spent, COALESCE(n_lines, 0) AS n_lines
    FROM customer
    LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS DECIMAL(25,2)) AS spent FROM orders GROUP BY 1) o ON o.o_custkey = c_custkey
    LEFT JOIN (SELECT o_custkey, count(*) AS n_lines FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1) l ON l.o_custkey = c_custkey""")
def preagg_join(t):
    orders = t("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("n_orders"), F.sum(F.col("o_totalprice").cast("decimal(15,2)")).alias("spent")
    )
    per_order = t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    lines = t("orders").join(per_order, "o_orderkey").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sum("n").alias("n_lines")
    )
    return joins.preagg_join(
        t("customer").select("c_custkey"), [(orders, "c_custkey"), (lines, "c_custkey")],
        {"n_orders": F.lit(0), "spent": F.lit(0).cast("decimal(25,2)"), "n_lines": F.lit(0)},
    )


@query("star_join", """
    SELECT o_orderkey, c_name, n_name, COALESCE(r_name, 'nowhere') AS r_name
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN (SELECT * FROM region WHERE r_name <> 'ASIA') ON n_regionkey = r_regionkey""")
def star_join(t):
    regions = t("region").filter("r_name <> 'ASIA'")
    found = joins.star_join(t("orders").select("o_orderkey", "o_custkey"), [
        (t("customer"), {"o_custkey": "c_custkey"}, {"c_name": "c_name", "c_nationkey": "c_nationkey"}, {}),
        (t("nation"), {"c_nationkey": "n_nationkey"}, {"n_name": "n_name", "n_regionkey": "n_regionkey"}, {}),
        (regions, {"n_regionkey": "r_regionkey"}, {"r_name": "r_name"}, {"r_name": F.lit("nowhere")}),
    ])
    return flat(found.select("o_orderkey", "c_name", "n_name", "r_name"))
