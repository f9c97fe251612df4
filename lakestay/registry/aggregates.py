"""Aggregations over the supplied tables."""

from pyspark.sql import functions as F

from lakestay.functions import aggregates as agg
from lakestay.operators.frames import run_metrics
from lakestay.registry.core import query
from lakestay.session import work_folder


@query("agg_count", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL")
def agg_count(t):
    return t("orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


@query("agg_count_if", """
    SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS n_final, count(*) FILTER (o_totalprice > 250000) AS n_large FROM orders GROUP BY 1""")
def agg_count_if(t):
    return t("orders").groupBy("o_custkey").agg(
        agg.count_if(F.col("o_orderstatus") == "F").alias("n_final"),
        agg.count_if(F.col("o_totalprice") > 250000).alias("n_large"),
    )


@query("agg_sum_if", """
    SELECT l_suppkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) FILTER (l_returnflag = 'R' AND l_quantity > 45) AS DECIMAL(25,2)) AS returned FROM lineitem GROUP BY 1""")
def agg_sum_if(t):
    large_return = (F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45)
    return t("lineitem").groupBy("l_suppkey").agg(
        agg.sum_if(F.col("l_extendedprice").cast("decimal(15,2)"), large_return).alias("returned")
    )


@query("agg_avg_if", """
    SELECT l_suppkey, avg(l_quantity) FILTER (l_linestatus = 'O') AS avg_open FROM lineitem GROUP BY 1""")
def agg_avg_if(t):
    return t("lineitem").groupBy("l_suppkey").agg(
        agg.avg_if(F.col("l_quantity"), F.col("l_linestatus") == "O").alias("avg_open")
    )


@query("agg_count_distinct_if", """
    SELECT l_suppkey, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_partkey) FILTER (l_returnflag = 'R') AS returned_parts FROM lineitem GROUP BY 1""")
def agg_count_distinct_if(t):
    return t("lineitem").groupBy("l_suppkey").agg(
        F.count_distinct("l_partkey").alias("parts"),
        agg.count_distinct_if(F.col("l_partkey"), F.col("l_returnflag") == "R").alias("returned_parts"),
    )


@query("agg_basic", """
    SELECT l_returnflag, l_linestatus, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, avg(l_quantity) AS avg_qty,
           CAST(sum(l_quantity) AS BIGINT) AS sum_qty, min(CAST(l_shipdate AS DATE)) AS first_ship FROM lineitem GROUP BY 1, 2""")
def agg_basic(t):
    return t("lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.min("l_extendedprice").alias("lo"), F.max("l_extendedprice").alias("hi"),
        F.avg("l_quantity").alias("avg_qty"), F.sum("l_quantity").cast("long").alias("sum_qty"),
        F.min(F.to_date("l_shipdate")).alias("first_ship"),
    )


@query("agg_first_non_null", """
    SELECT session_id, arg_min(user_id, {'t': event_timestamp, 'i': event_id}) FILTER (user_id IS NOT NULL) AS user_id FROM clicks GROUP BY 1""", ("clicks",))
def agg_first_non_null(t):
    user = agg.first_non_null(F.col("user_id"), F.col("event_timestamp"), F.col("event_id"))
    return t("clicks").groupBy("session_id").agg(user.alias("user_id"))


@query("agg_arg_min", """
    SELECT user_id, event_type, arg_min(event_id, {'v': value, 'i': event_id}) AS cheapest FROM events GROUP BY 1, 2""")
def agg_arg_min(t):
    cheapest = agg.arg_min(F.col("event_id"), F.col("value"), F.col("event_id"))
    return t("events").groupBy("user_id", "event_type").agg(cheapest.alias("cheapest"))


@query("session_duration", """
    SELECT user_id || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id,
           date_diff('second', date_trunc('second', min(ts)), date_trunc('second', max(ts))) AS seconds FROM events GROUP BY 1""")
def session_duration(t):
    session = F.concat_ws("-", F.col("user_id").cast("string"), F.to_date("ts").cast("string"))
    return t("events").groupBy(session.alias("session_id")).agg(agg.duration_sec(F.col("ts")).alias("seconds"))


@query("agg_bool_or", """
    SELECT user_id, CAST(ts AS DATE) AS day, bool_or(event_type = 'purchase') AS bought FROM events GROUP BY 1, 2""")
def agg_bool_or(t):
    return t("events").groupBy("user_id", F.to_date("ts").alias("day")).agg(
        agg.any_true(F.col("event_type") == "purchase").alias("bought")
    )


@query("ratio_pct", """
    SELECT o_custkey, round(CAST(100 AS DOUBLE) * count(*) FILTER (o_orderstatus = 'F') / NULLIF(count(*) FILTER (o_orderstatus <> 'P'), 0), 2) AS pct FROM orders GROUP BY 1""")
def ratio_pct(t):
    status = F.col("o_orderstatus")
    return t("orders").groupBy("o_custkey").agg(
        agg.pct(agg.count_if(status == "F"), agg.count_if(status != "P")).alias("pct")
    )


@query("agg_having", """
    SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) FILTER (l_returnflag = 'R') <> 1 AND count(*) > 3""")
def agg_having(t):
    grouped = t("lineitem").groupBy("l_orderkey").agg(
        F.count("*").alias("n"), agg.count_if(F.col("l_returnflag") == "R").alias("r")
    )
    return grouped.filter("r <> 1 AND n > 3").drop("r")


@query("run_metrics", """
    SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1
    UNION ALL SELECT 'observed', count(*) FROM orders WHERE o_orderstatus = 'F'""")
def run_metrics_query(t):
    """Rows per priority read back from a written table, and the number seen while writing it."""
    final, seen = run_metrics(
        t("orders").filter("o_orderstatus = 'F'"), "orders", [F.count(F.lit(1)).alias("n")]
    )
    table = work_folder(t.spark, "run-metrics")
    final.write.parquet(table)
    written = t.spark.read.parquet(table)
    observed = t.spark.range(1).select(F.lit("observed").alias("o_orderpriority"), F.lit(seen.get["n"]).alias("n"))
    return written.groupBy("o_orderpriority").agg(F.count("*").alias("n")).unionByName(observed)
