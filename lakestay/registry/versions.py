"""Versions, duplicates and windows over the supplied tables."""

from pyspark.sql import functions as F

from lakestay.operators import versions as v
from lakestay.operators.frames import union_frames
from lakestay.registry.core import query

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_TIES = [
    "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
]
RANKED = f"""SELECT *, CAST(l_shipdate AS DATE) AS shipped,
    row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST, {', '.join(LINE_TIES)}) AS rn FROM lineitem"""
LINE_OUT = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, shipped"


def _out(df):
    return df.withColumn("shipped", F.to_date("l_shipdate")).select(*LINE_OUT.split(", "))


def _lines(t):
    """Line items with the place of each row, which differs even between copies."""
    return t("lineitem").select("*", F.concat_ws("#", "_metadata.file_path", "_metadata.row_index").alias("_row_id"))


@query("latest_version", f"SELECT {LINE_OUT} FROM ({RANKED}) WHERE rn = 1")
def latest_version(t):
    return _out(v.latest_version(t("lineitem"), LINE_KEY, "l_shipdate", LINE_TIES))


@query("dedup_keep_latest", f"SELECT {LINE_OUT} FROM ({RANKED}) WHERE rn = 1")
def dedup_keep_latest(t):
    return _out(v.dedup(_lines(t), LINE_KEY, "l_shipdate", LINE_TIES, ["_row_id"])[0])


@query("dedup_losers", f"SELECT {LINE_OUT} FROM ({RANKED}) WHERE rn > 1")
def dedup_losers(t):
    return _out(v.dedup(_lines(t), LINE_KEY, "l_shipdate", LINE_TIES, ["_row_id"])[1])


@query("change_points", """
    SELECT user_id, day, event_type FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY day) AS prev FROM user_days)
    WHERE event_type IS DISTINCT FROM prev""", ("user_days",))
def change_points(t):
    return v.change_points(t("user_days"), ["user_id"], "day", ["event_type"])


@query("next_value", """
    SELECT user_id, day, COALESCE(lead(day) OVER (PARTITION BY user_id ORDER BY day), DATE '9999-12-31') AS next_day FROM user_days""", ("user_days",))
def next_value(t):
    return v.with_next(t("user_days"), ["user_id"], "day", "next_day", v.open_end()).drop("event_type")


@query("union_by_name", """
    SELECT 'c' AS kind, c_custkey AS id, c_nationkey AS nationkey, c_mktsegment AS segment FROM customer
    UNION ALL SELECT 's', s_suppkey, s_nationkey, NULL FROM supplier""")
def union_by_name(t):
    customers = t("customer").select(
        F.lit("c").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nationkey"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = t("supplier").select(
        F.col("s_nationkey").alias("nationkey"), F.lit("s").alias("kind"), F.col("s_suppkey").alias("id")
    )
    return union_frames([customers, suppliers], allow_missing=True)
