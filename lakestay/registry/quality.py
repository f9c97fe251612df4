"""Data-quality rules and checks over the supplied tables."""

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from lakestay import fixed_values as fv
from lakestay.operators import quality as q
from lakestay.operators.scd2 import scd2
from lakestay.plans import checks, facts
from lakestay.plans.silver import entity
from lakestay.registry.core import query
from lakestay.registry.entities import judged_sql
from lakestay.registry.versions import LINE_KEY, LINE_TIES, RANKED, _lines
from lakestay.registry.warehouse import (
    ALL_BOOKINGS,
    BOOKING_INPUTS,
    CHANNEL_NAMES,
    DATE_SQL,
    FACT_PAYMENTS,
    INVENTORY,
    SESSIONS,
    booking_facts,
    customers,
    dim_dates,
    hotels,
)
from lakestay.sources import seeds

LINE_RULES = (
    ("SMALL_QUANTITY", "l_quantity < 4"),
    ("NO_DISCOUNT", "l_discount = 0"),
    ("EARLY", "CAST(l_shipdate AS DATE) < DATE '1995-06-01'"),
)
LINE_REASON = "concat_ws(';', " + ", ".join(f"CASE WHEN {bad} THEN '{code}' END" for code, bad in LINE_RULES) + ")"
ORDER_RULES = (
    ("CHEAP", "o_totalprice < 50000"),
    ("PENDING", "o_orderstatus = 'P'"),
    ("OLD", "CAST(o_orderdate AS DATE) < DATE '1996-01-01'"),
)
ORDER_REASON = "concat_ws(';', " + ", ".join(f"CASE WHEN {bad} THEN '{code}' END" for code, bad in ORDER_RULES) + ")"


@query("dq_reasons", f"""
    WITH {judged_sql('bookings')} SELECT CAST(created_at AS VARCHAR) AS created_at, total_amount, _dq_reason FROM judged""", ("bronze_bookings",))
def dq_reasons(t):
    e = entity("bookings")
    judged = q.with_reason(e.typed(t("bronze_bookings")), e.rules)
    return judged.select(F.col("created_at").cast("string").alias("created_at"), "total_amount", fv.DQ_REASON)


def _split(t):
    return q.split_dq(_lines(t), LINE_RULES, LINE_KEY, "l_shipdate", LINE_TIES, ["_row_id"])


LINE_RANKED = RANKED.replace("FROM lineitem", f"FROM lineitem WHERE {LINE_REASON} = ''")


@query("dq_valid", f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM ({LINE_RANKED}) WHERE rn = 1")
def dq_valid(t):
    return _split(t)[0].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@query("dq_quarantine", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {LINE_REASON} AS _dq_reason FROM lineitem WHERE {LINE_REASON} <> ''
    UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'DUPLICATE_KEY' FROM ({LINE_RANKED}) WHERE rn > 1""")
def dq_quarantine(t):
    return _split(t)[1].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", fv.DQ_REASON)


@query("dq_summary", f"""
    SELECT {ORDER_REASON} AS _dq_reason, count(*) AS n_rows FROM orders WHERE {ORDER_REASON} <> '' GROUP BY 1""")
def dq_summary(t):
    return q.dq_summary(q.with_reason(t("orders"), ORDER_RULES))


@query("dq_breaker", f"""
    WITH {judged_sql('bookings')}
    SELECT 'bookings' AS entity, count(*) AS total, count(*) FILTER (_dq_reason <> '') AS invalid,
        count(*) FILTER (_dq_reason <> '') > 0.2 * count(*) AS tripped FROM judged""", ("bronze_bookings",))
def dq_breaker(t):
    """Whether the share of invalid bookings would stop the day."""
    e = entity("bookings")
    judged = q.with_reason(e.typed(t("bronze_bookings")), e.rules)
    n, bad = F.count(F.lit(1)), F.count_if(F.col(fv.DQ_REASON) != "")
    return judged.agg(
        F.lit("bookings").alias("entity"), n.alias("total"), bad.alias("invalid"),
        (bad / n > fv.MAX_REJECT_RATIO).alias("tripped"),
    )


@query("check_not_null", """
    SELECT event_id, event_type FROM clicks WHERE user_id IS NULL""", ("clicks",))
def check_not_null(t):
    return q.check_not_null(t("clicks"), "user_id").select("event_id", "event_type")


@query("check_unique", """
    SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def check_unique(t):
    return q.check_unique(t("lineitem"), LINE_KEY)


@query("check_relationship", """
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0)""")
def check_relationship(t):
    parents = t("orders").filter("o_orderkey % 2 = 0")
    lines = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return q.check_relationship(lines, "l_orderkey", parents, "o_orderkey")


@query("check_accepted", """
    SELECT o_orderpriority, count(*) AS n_rows FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY 1""")
def check_accepted(t):
    return q.check_accepted(t("orders"), "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"])


@query("check_expression", """
    SELECT booking_id FROM bookings LEFT JOIN (SELECT DISTINCT currency AS known FROM rates) ON currency = known
    WHERE NOT COALESCE(total_amount > 100000 AND known <> 'IDR', false)""", ("bookings", "rates"))
def check_expression(t):
    known = t("rates").select(F.col("currency").alias("known")).distinct()
    rows = t("bookings").join(known, F.col("currency") == F.col("known"), "left")
    return q.check_expression(rows, "total_amount > 100000 AND known <> 'IDR'").select("booking_id")


@query("check_scd2", """
    WITH steps AS (SELECT user_id, day, event_type IS DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id ORDER BY day) AS changed FROM user_days),
    starts AS (SELECT user_id, day AS valid_from, lead(day) OVER (PARTITION BY user_id ORDER BY day) AS next_from FROM steps WHERE changed),
    broken AS (SELECT user_id, valid_from,
            COALESCE(next_from - 1, DATE '9999-12-31') - CASE WHEN user_id % 10 = 3 AND next_from IS NOT NULL THEN 1 ELSE 0 END AS valid_to,
            next_from IS NULL AND user_id % 10 <> 5 AS is_current FROM starts),
    ordered AS (SELECT *, lead(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from) AS next_valid FROM broken)
    SELECT user_id, 'current_versions != 1' AS issue FROM broken GROUP BY 1 HAVING count(*) FILTER (is_current) <> 1
    UNION ALL SELECT user_id, 'gap_or_overlap' FROM ordered WHERE valid_from > valid_to OR (next_valid IS NOT NULL AND next_valid <> valid_to + 1)""",
    ("user_days",))
def check_scd2(t):
    """A history with missing current versions and gaps of a day."""
    good = scd2(t("user_days"), "user_id", ["event_type"], "sk", "day")
    user = F.col("user_id") % 10
    gap = (user == 3) & ~F.col("is_current")
    broken = good.withColumn(
        "valid_to", F.date_sub("valid_to", F.when(gap, 1).otherwise(0))
    ).withColumn("is_current", F.col("is_current") & (user != 5))
    return q.check_scd2(broken, "user_id")


REPORTED = (
    *(f"staging_{name}" for name in fv.STAGING_COLUMNS), "dim_dates", "dim_hotels", "dim_customers", "dim_channels",
    "fact_bookings", "fact_payments", "fact_web_sessions", "fact_hotel_inventory",
)


def _report_sql():
    """One SELECT per check on the reported tables, from the same lists."""
    lines = []

    def add(name, severity, *needed, count):
        if all(t in REPORTED for t in needed):
            lines.append(f"SELECT '{name}' AS check_name, '{severity}' AS severity, ({count}) AS violations")

    for table, cols in checks.NOT_NULL.items():
        for c in cols:
            add(f"not_null {table}.{c}", "error", table, count=f"SELECT count(*) FROM {table} WHERE {c} IS NULL")
    for table, keys in checks.UNIQUE.items():
        for key in keys:
            given = f"WHERE {key[0]} IS NOT NULL" if len(key) == 1 else ""
            repeated = f"SELECT 1 FROM {table} {given} GROUP BY {', '.join(key)} HAVING count(*) > 1"
            add(f"unique {table}({', '.join(key)})", "error", table, count=f"SELECT count(*) FROM ({repeated})")
    for child, c, parent, p, severity in checks.REFERENCES:
        missing = f"SELECT count(*) FROM {child} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {p} FROM {parent} WHERE {p} IS NOT NULL)"
        add(f"reference {child}.{c} to {parent}", severity, child, parent, count=missing)
    for table, c, values in checks.ACCEPTED:
        known = ", ".join(f"'{v}'" for v in values)
        add(f"accepted {table}.{c}", "error", table, count=f"SELECT count(DISTINCT {c}) FROM {table} WHERE {c} NOT IN ({known})")
    for table, rule in checks.EXPECTED:
        add(f"expected {table}: {rule}", "warn", table, count=f"SELECT count(*) FROM {table} WHERE ({rule}) IS NOT TRUE")
    for table, key in checks.HISTORIES:
        add(f"history {table}", "error", table, count=f"""
            SELECT (SELECT count(*) FROM (SELECT 1 FROM {table} GROUP BY {key} HAVING sum(CAST(is_current AS INTEGER)) <> 1))
                + (SELECT count(*) FROM (SELECT valid_from > valid_to OR lead(valid_from) OVER (PARTITION BY {key} ORDER BY valid_from)
                    - valid_to <> 1 AS bad FROM {table}) WHERE bad)""")
    return f"""{ALL_BOOKINGS}, {FACT_PAYMENTS}, {SESSIONS},
    fact_web_sessions AS (FROM sessions), inventory AS (WITH {INVENTORY}), fact_hotel_inventory AS (FROM inventory),
    dim_dates AS ({DATE_SQL}), dim_channels AS (SELECT unnest(range(1, 5)) AS channel_id, unnest({CHANNEL_NAMES}) AS channel_name),
    counted AS ({' UNION ALL '.join(lines)})
    SELECT *, CASE WHEN violations = 0 THEN 'pass' ELSE severity END AS status FROM counted"""


@query(
    "check_report", _report_sql(),
    (*BOOKING_INPUTS, "payments", "clicks", *(f"staging_{name}" for name in fv.STAGING_COLUMNS)),
)
def check_report(t):
    """Every check on the staging tables, dimensions and facts, warnings and errors alike."""
    bookings = t.once("fact-bookings", lambda t: booking_facts(t, hotels, customers))
    payments, clicks, stg_bookings, rates = t("payments"), t("clicks"), t("bookings"), t("rates")
    known_hotels, known_customers = hotels(t), customers(t)
    # These need nothing of each other, so one's last tasks run beside the next one's.
    builds = {
        "fact_payments": lambda: facts.fact_payments(payments, bookings, rates),
        "fact_web_sessions": lambda: facts.fact_web_sessions(clicks, stg_bookings, known_customers),
        "fact_hotel_inventory": lambda: facts.fact_hotel_inventory(stg_bookings, known_hotels, rates),
    }
    with ThreadPoolExecutor(len(builds)) as pool:
        built = dict(zip(builds, pool.map(lambda name: t.stored(builds[name](), name.replace("_", "-")), builds)))
    tables = {
        **{f"staging_{name}": t(f"staging_{name}") for name in fv.STAGING_COLUMNS},
        "dim_dates": dim_dates(t),
        "dim_hotels": known_hotels,
        "dim_customers": known_customers,
        "dim_channels": seeds.dim_channels(t.spark),
        "fact_bookings": bookings,
        **built,
    }
    assert tuple(tables) == REPORTED
    return q.check_report(checks.warehouse_checks(tables))
