"""Reading and writing files, with data from the supplied tables."""

from pyspark.sql import functions as F

from lakestay import fixed_values as fv
from lakestay.operators.frames import split_corrupt
from lakestay.operators.joins import asof_join, lookup
from lakestay.operators.order import with_position
from lakestay.plans.silver import silver_frames
from lakestay.registry.core import flat, query
from lakestay.registry.entities import ranked_sql
from lakestay.session import work_folder
from lakestay.sinks import audit, batches, layout, versioned
from lakestay.sinks.staging import publish_staging, reconcile_batches
from lakestay.sinks.upsert import align_schema, incremental_slice, upsert
from lakestay.sources import readers, seeds

ORDER_TEXT = "CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderpriority, CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS o_totalprice"


def _orders_as_text(t):
    return t("orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"), F.col("o_custkey").cast("string").alias("o_custkey"),
        "o_orderpriority", F.col("o_totalprice").cast("decimal(15,2)").cast("string").alias("o_totalprice"),
    )


@query("scan_csv_raw", f"SELECT {ORDER_TEXT}, CAST(NULL AS VARCHAR) AS _corrupt_record FROM orders")
def scan_csv_raw(t):
    path = work_folder(t.spark, "csv")
    _orders_as_text(t).write.option("header", True).csv(path)
    return readers.read_csv_raw(t.spark, path)


@query("scan_xml_raw", """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment FROM customer""")
def scan_xml_raw(t):
    path = work_folder(t.spark, "xml")
    customers = t("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    customers.write.format("xml").options(rowTag="customer", rootTag="customers").save(path)
    return readers.read_xml_raw(t.spark, path, "customer").select(*customers.columns)


@query("scan_multi_format", f"""
    SELECT {ORDER_TEXT}, CASE WHEN o_orderkey % 2 = 1 THEN 'x' END AS extra, CASE WHEN o_orderkey % 2 = 0 THEN 'csv' ELSE 'xml' END AS _source_format FROM orders""")
def scan_multi_format(t):
    """Even orders as CSV, odd ones as XML with a further column."""
    folder = work_folder(t.spark, "landing")
    rows, even = _orders_as_text(t), F.col("o_orderkey").cast("long") % 2 == 0
    rows.filter(even).write.option("header", True).csv(f"{folder}/even.csv")
    odd = rows.filter(~even).withColumn("extra", F.lit("x"))
    odd.write.format("xml").options(rowTag="order", rootTag="orders").save(f"{folder}/odd.xml")
    spec = readers.SourceSpec("orders", (("csv", None, True), ("xml", "order", True)), tuple(rows.columns))
    found = readers.read_source(t.spark, spec, folder)
    return found.select(*rows.columns, "extra", "_source_format")


def _by_day(t, cols=("event_id", "event_type", "value")):
    return t("events").select(*cols, F.to_date("ts").alias(fv.BATCH_DATE))


@query("scan_parquet", """
    SELECT event_id, event_type, value, CAST(ts AS DATE) AS _batch_date FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10'""")
def scan_parquet(t):
    """One day of a table with a folder per day."""
    table = work_folder(t.spark, "events")
    batches.write_days(_by_day(t), table)
    return readers.read_day(t.spark, table, "2024-01-10")


RATES_SQL = "(VALUES " + ", ".join(f"('{c}', CAST({r} AS DECIMAL(18,6)), DATE '{d}')" for c, r, d in fv.FX_RATES) + ") AS r(currency, units_per_usd, valid_from)"


@query("seed_fx_rates", f"""
    SELECT o.currency, r.units_per_usd, r.valid_from, count(*) AS n_orders
    FROM (SELECT CASE o_custkey % 6 WHEN 0 THEN 'USD' WHEN 1 THEN 'VND' WHEN 2 THEN 'THB' WHEN 3 THEN 'SGD' WHEN 4 THEN 'IDR' ELSE 'EUR' END AS currency,
            CAST(o_orderdate AS DATE) + 9900 AS day FROM orders) o
    ASOF LEFT JOIN {RATES_SQL} ON o.currency = r.currency AND o.day >= r.valid_from GROUP BY ALL""")
def seed_fx_rates(t):
    """Rates read from a typed seed file, with the orders each rate applies to."""
    path = work_folder(t.spark, "rates")
    seeds.fx_rates(t.spark).coalesce(1).write.option("header", True).csv(path)
    rates = seeds.read_seed(t.spark, path, seeds.FX_SCHEMA)
    codes = F.array(*[F.lit(c) for c in ("USD", "VND", "THB", "SGD", "IDR", "EUR")])
    orders = t("orders").select(
        F.get(codes, F.col("o_custkey") % 6).alias("currency"),
        F.date_add(F.to_date("o_orderdate"), 9900).alias("day"),
    )
    dated = rates.withColumn("since", F.col("valid_from"))
    found = asof_join(
        orders, dated, ["currency"], "day", "valid_from",
        {"units_per_usd": "units_per_usd", "since": "valid_from"},
    )
    return found.groupBy("currency", "units_per_usd", "valid_from").agg(F.count("*").alias("n_orders"))


@query("dim_channels", """
    SELECT c.*, count(booking_id) AS n_bookings
    FROM (VALUES (1, 'Web', 'direct'), (2, 'Mobile App', 'direct'), (3, 'Partner API', 'partner'), (4, 'Other', 'other')) AS c(channel_id, channel_name, channel_type)
    LEFT JOIN bookings ON booking_channel = channel_name GROUP BY ALL""", ("bookings",))
def dim_channels(t):
    """The channels with their bookings."""
    booked = t("bookings").groupBy("booking_channel").agg(F.count("*").alias("n"))
    return lookup(
        seeds.dim_channels(t.spark), booked, {"channel_name": "booking_channel"},
        {"n": "n_bookings"}, {"n_bookings": F.lit(0)},
    )


GEO_SQL = "(VALUES " + ", ".join(str(g) for g in fv.GEOGRAPHY) + ") AS g(geo_id, city, country, country_code, region, timezone)"


@query("dim_geography", f"""
    SELECT g.*, n AS n_customers FROM {GEO_SQL} LEFT JOIN (SELECT c_custkey % 15 + 1 AS id, count(*) AS n FROM customer GROUP BY 1) ON id = geo_id""")
def dim_geography(t):
    """The cities with their customers."""
    living = t("customer").groupBy((F.col("c_custkey") % 15 + 1).alias("id")).agg(F.count("*").alias("n"))
    return lookup(seeds.dim_geography(t.spark), living, {"geo_id": "id"}, {"n": "n_customers"})


@query("provenance", """
    SELECT o_orderkey, 'orders.parquet' AS file, DATE '2026-10-01' AS _batch_date, 'run-1' AS _run_id, true AS ingested FROM orders""")
def provenance(t):
    scan = t("orders").select("o_orderkey", F.col("_metadata.file_path").alias("_source_file"))
    rows = readers.with_provenance(scan, "2026-10-01", "run-1")
    return rows.select(
        "o_orderkey", F.element_at(F.split("_source_file", "/"), -1).alias("file"), fv.BATCH_DATE,
        "_run_id", (F.col("_ingested_at") <= F.current_timestamp()).alias("ingested"),
    )


@query("batch_overwrite", """
    SELECT event_id, event_type, CASE WHEN CAST(ts AS DATE) = DATE '2024-01-10' THEN value * 2 ELSE value END AS value, CAST(ts AS DATE) AS _batch_date
    FROM events WHERE CAST(ts AS DATE) <> DATE '2024-01-11' AND (CAST(ts AS DATE) <> DATE '2024-01-10' OR event_type <> 'error')""")
def batch_overwrite(t):
    """All days written, one day rerun with other rows and one rerun without any."""
    table = work_folder(t.spark, "events")
    rows = _by_day(t)
    batches.write_days(rows, table)
    day = lambda d: rows.filter(F.col(fv.BATCH_DATE) == F.lit(d).cast("date"))
    rerun = day("2024-01-10").filter("event_type <> 'error'").withColumn("value", F.col("value") * 2)
    batches.write_day(rerun, table, "2024-01-10")
    batches.write_day(day("2024-01-11").filter("event_type = 'none'"), table, "2024-01-11")
    return readers.read_table(t.spark, table)


@query("incremental_upsert", """
    WITH base AS (SELECT booking_id, booking_status, _batch_date, CAST(substr(booking_id, 4) AS BIGINT) AS k FROM bookings)
    SELECT booking_id, CASE WHEN k % 10 = 0 OR _batch_date = DATE '2024-01-02' THEN 'CHANGED' ELSE booking_status END AS booking_status,
        CASE WHEN k % 10 = 0 OR _batch_date = DATE '2024-01-02' THEN DATE '2024-02-10' ELSE _batch_date END AS _batch_date,
        CASE WHEN k % 10 = 0 OR _batch_date = DATE '2024-01-02' THEN 'new' END AS note FROM base""", ("bookings",))
def incremental_upsert(t):
    """A batch replacing every tenth booking and a whole day, with a new column."""
    table = work_folder(t.spark, "bookings")
    base = t("bookings").select("booking_id", "booking_status", fv.BATCH_DATE)
    batches.write_days(base, table)
    key = F.substring("booking_id", 4, 20).cast("long")
    changed = base.filter((key % 10 == 0) | (F.col(fv.BATCH_DATE) == "2024-01-02"))
    new = changed.select(
        "booking_id", F.lit("CHANGED").alias("booking_status"), F.lit("new").alias("note"),
        F.lit("2024-02-10").cast("date").alias(fv.BATCH_DATE),
    )
    upsert(new, table, ["booking_id"])
    merged = t.spark.read.option("mergeSchema", True).parquet(table)
    return merged.select("booking_id", "booking_status", F.col(fv.BATCH_DATE).cast("date").alias(fv.BATCH_DATE), "note")


CHANGES_SQL = """
    WITH base AS (SELECT booking_id, booking_status, _batch_date, CAST(substr(booking_id, 4) AS BIGINT) AS k FROM bookings),
    states AS (SELECT *, CASE WHEN k % 15 = 0 THEN 2 WHEN k % 10 = 0 OR _batch_date = DATE '2024-01-02' THEN 1 ELSE 0 END AS change FROM base WHERE k % 7 <> 3)
    SELECT booking_id, list_extract([booking_status, 'CHANGED', 'AGAIN'], change + 1) AS booking_status,
        CASE change WHEN 1 THEN DATE '2024-02-10' ELSE _batch_date END AS _batch_date,
        list_extract([NULL, 'new', 'again'], change + 1) AS note FROM states"""


def _changed_bookings(t):
    """A batch replacing every tenth booking and a whole day, with a new column, another
    putting some back into their days, and the deletion of some keys."""
    table = work_folder(t.spark, "bookings")
    base = t("bookings").select("booking_id", "booking_status", fv.BATCH_DATE)
    key = F.substring("booking_id", 4, 20).cast("long")
    bookings = versioned.VersionedTable.create(base, table, ["booking_id"])
    moved = base.filter((key % 10 == 0) | (F.col(fv.BATCH_DATE) == "2024-01-02"))
    bookings.upsert(moved.select(
        "booking_id", F.lit("CHANGED").alias("booking_status"), F.lit("new").alias("note"),
        F.lit("2024-02-10").cast("date").alias(fv.BATCH_DATE),
    ))
    again = base.filter(key % 15 == 0)
    bookings.upsert(again.withColumns({"booking_status": F.lit("AGAIN"), "note": F.lit("again")}))
    bookings.delete(base.filter(key % 7 == 3))
    return bookings


@query("merge_on_read", CHANGES_SQL, ("bookings",))
def merge_on_read(t):
    """The current rows of a table and its changes, read together."""
    return _changed_bookings(t).read()


@query("merge_compacted", CHANGES_SQL, ("bookings",))
def merge_compacted(t):
    """The same rows once the changes are compacted into their days."""
    bookings = _changed_bookings(t)
    bookings.compact()
    return bookings.read()


@query("refresh_table", """
    SELECT c_custkey, c_name, c_acctbal + 2 AS c_acctbal FROM customer WHERE c_custkey % 3 <> 0""")
def refresh_table(t):
    """A table replaced twice by what is made of its own rows."""
    table = work_folder(t.spark, "customers")
    batches.refresh(t("customer").select("c_custkey", "c_name", "c_acctbal"), table, ["c_custkey"])
    for changed in ("c_custkey % 3 <> 0", "true"):
        rows = readers.read_table(t.spark, table).filter(changed)
        batches.refresh(rows.withColumn("c_acctbal", F.col("c_acctbal") + 1), table, ["c_custkey"])
    return readers.read_table(t.spark, table)


@query("month_layout", """
    SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
    WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-02-20' AND DATE '1996-05-03' AND o_custkey < 500""")
def month_layout(t):
    """Orders in month folders clustered by customer; some days and customers read back."""
    table = work_folder(t.spark, "orders")
    orders = t("orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("o_orderdate"))
    layout.write_by_month(orders, table, "o_orderdate", ["o_custkey", "o_orderkey"])
    found = layout.read_by_month(t.spark, table, "o_orderdate", "1996-02-20", "1996-05-03")
    return found.filter("o_custkey < 500")


@query("order_positions", """
    SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS position FROM orders""")
def order_positions(t):
    """The place of every order by falling price."""
    orders = t("orders").select("o_orderkey", "o_totalprice")
    return with_position(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")])


@query("incremental_slice", """
    SELECT event_id, CAST(ts AS DATE) AS _batch_date FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-12'""")
def incremental_slice_query(t):
    return incremental_slice(_by_day(t, ("event_id",)), "2024-01-12")


@query("append_new_columns", """
    SELECT c_custkey, c_name, CASE WHEN c_custkey % 2 = 1 THEN c_mktsegment END AS c_mktsegment FROM customer""")
def append_new_columns(t):
    old = t("customer").filter("c_custkey % 2 = 0").select("c_custkey", "c_name")
    new = t("customer").filter("c_custkey % 2 = 1").select("c_mktsegment", "c_name", "c_custkey")
    return align_schema(old, new)


@query("rejected_sink", """
    SELECT CASE WHEN o_orderkey % 50 = 7 THEN o_orderkey || ',' || o_custkey ELSE o_orderkey || ',' || o_custkey || ',' || o_orderpriority || ',x,y' END AS _corrupt_record,
        'csv' AS _source_format, DATE '2026-10-01' AS _batch_date
    FROM orders WHERE o_orderkey % 50 = 7 OR o_orderkey % 50 = 9""")
def rejected_sink(t):
    """Orders landed as lines, some too short and some too long, and the rejected ones read back."""
    root = work_folder(t.spark, "rejected")
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"))
    part = F.col("o_orderkey") % 50
    full = F.concat_ws(",", line, "o_orderpriority")
    text = F.when(part == 7, line).when(part == 9, F.concat(full, F.lit(",x,y"))).otherwise(full)
    header = "o_orderkey,o_custkey,o_orderpriority"
    (
        t("orders").select(text.alias(header)).write
        .options(header=True, sep="\u0001", quote="").csv(f"{root}/landed.csv")
    )
    spec = readers.SourceSpec("orders", (("csv", None, False),), tuple(header.split(",")))
    raw = readers.with_provenance(readers.read_source(t.spark, spec, root), "2026-10-01", "run")
    _, bad = split_corrupt(raw)
    bad = bad.select(fv.CORRUPT, "_source_format", fv.BATCH_DATE)
    out = batches.write_rejected(bad, f"{root}/rejected", "2026-10-01")
    return readers.read_rejected(t.spark, out, bad.schema)


PUBLISHED = ", ".join(
    f"COALESCE({c}, '') AS {c}" if c in fv.STAGING_DEFAULTS["customers"] else c for c in fv.STAGING_COLUMNS["customers"]
)


@query("staging_publish", f"WITH {ranked_sql('customers')} SELECT {PUBLISHED}, _source_file, _batch_date FROM ranked WHERE rn = 1", ("bronze_customers",))
def staging_publish(t):
    table = work_folder(t.spark, "staging")
    valid, _ = silver_frames("customers", t("bronze_customers"))
    contract = (*fv.STAGING_COLUMNS["customers"], *fv.STAGING_META)
    publish_staging(valid, contract, fv.STAGING_DEFAULTS["customers"], table, "2026-10-01", ["user_id"])
    return flat(readers.read_day(t.spark, table, "2026-10-01")).drop("_ingested_at")


def _written_bookings(t):
    table = work_folder(t.spark, "bookings")
    rows = t("bookings").select("booking_id", "total_amount", fv.BATCH_DATE)
    batches.write_days(rows, table)
    return rows, readers.read_table(t.spark, table)


@query("reconcile_counts", """
    SELECT _batch_date, count(*) AS expected, count(*) AS actual, true AS ok FROM bookings GROUP BY 1""", ("bookings",))
def reconcile_counts(t):
    return reconcile_batches(*_written_bookings(t))


@query("run_audit", """
    SELECT 'run-1' AS run_id, _batch_date AS execution_date, 'staging' AS step_name, 'SUCCESS' AS status, count(*) AS rows_processed,
        '' AS error_message, '{"expected":' || count(*) || ',"actual":' || count(*) || '}' AS details, true AS _created_at FROM bookings GROUP BY _batch_date""", ("bookings",))
def run_audit(t):
    """An audit row per batch, from its reconciliation."""
    counts = reconcile_batches(*_written_bookings(t))
    now = F.current_timestamp()
    rows = counts.select(*audit.audit_columns(
        F.lit("run-1"), F.col(fv.BATCH_DATE), F.lit("staging"), F.col("ok"), F.col("actual"), now, now,
        F.when(~F.col("ok"), "rows missing"), F.struct("expected", "actual"),
    ))
    table = work_folder(t.spark, "audit")
    rows.write.mode("append").parquet(table)
    found = t.spark.read.parquet(table).withColumn("_created_at", F.col("_created_at") >= F.col("finished_at"))
    return found.drop("started_at", "finished_at")


EVENT_LINE = "event_id || ',' || event_type || ',' || user_id"
INVENTORY_SQL = f"""
    WITH counted AS (SELECT count(DISTINCT CAST(ts AS DATE)) + 1 AS n, sum(length({EVENT_LINE}) + 1) AS b FROM events)
    SELECT layer, CAST(CASE layer WHEN 'raw' THEN n WHEN 'other' THEN 1 ELSE 0 END AS BIGINT) AS n_files,
        CAST(CASE layer WHEN 'raw' THEN b ELSE 0 END AS BIGINT) AS n_bytes
    FROM counted, (SELECT unnest({[*fv.LAYERS, 'other']}) AS layer)"""


@query("lake_inventory", INVENTORY_SQL)
def lake_inventory(t):
    """A lake with a text file of events for every day and an empty file beside the layers.

    Every day is one file and Spark marks the finished write with a further one, so
    neither files nor bytes depend on the cluster.
    """
    root = work_folder(t.spark, "lake")
    line = F.concat_ws(",", F.col("event_id").cast("string"), "event_type", F.col("user_id").cast("string"))
    lines = t("events").select(line.alias("value"), F.to_date("ts").alias(fv.BATCH_DATE))
    days = lines.repartition(fv.BATCH_DATE).write.partitionBy(fv.BATCH_DATE)
    days.text(readers.layer_path(root, "raw", "events"))
    Path = t.spark._jvm.org.apache.hadoop.fs.Path
    store = Path(root).getFileSystem(t.spark._jsc.hadoopConfiguration())
    store.create(Path(f"{root}/notes/empty.txt")).close()
    return audit.lake_inventory(t.spark, root)
