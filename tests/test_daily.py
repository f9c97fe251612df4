"""A day from landing files to reports, a second day, a rerun and a backfill."""

import datetime as dt
import os
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from lakestay import fixed_values as fv
from lakestay.operators.quality import BreakerTripped
from lakestay.plans import daily, facts, silver, staging
from lakestay.plans.bronze import bronze_ingest
from lakestay.session import delete_folder, work_folder
from lakestay.sinks.audit import lake_inventory
from lakestay.sinks.batches import refresh
from lakestay.sinks.upsert import upsert
from lakestay.sources.readers import SOURCES, read_table
from tests import landing as land


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    land.land_day1(root)
    return root, daily.run_day(spark, root, land.DAY1, "run1", max_ratio=0.5)


@pytest.fixture(scope="module")
def lake2(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake2"))
    land.land_day1(root)
    land.land_day2(root)
    daily.run_day(spark, root, land.DAY1, "run1", max_ratio=0.5)
    daily.run_day(spark, root, land.DAY2, "run2")
    return root


def table(spark, root, name):
    return read_table(spark, daily.analytics_table(root, name))


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_silver_counts_and_reasons(lake):
    _, done = lake
    assert done["bronze"]["bookings"] == {"bronze_rows": 11, "rejected_rows": 0}
    assert done["silver"]["bookings"] == {
        "bronze_rows": 11, "silver_rows": 6, "duplicates": 1, "dq_invalid": 4,
        "dq_reasons": {"MISSING_HOTEL_ID": 1, "INVALID_AMOUNT": 1, "MISSING_CURRENCY": 1, "NON_POSITIVE_NIGHTS": 1},
    }
    assert done["silver"]["hotels"]["dq_reasons"] == {
        "MISSING_HOTEL_NAME": 1, "INVALID_STAR_RATING": 1, "INVALID_TOTAL_ROOMS": 1,
    }
    assert done["silver"]["payments"]["dq_reasons"] == {"MISSING_BOOKING_ID": 1, "INVALID_PROCESSED_AT": 1}
    assert [done["silver"][n]["silver_rows"] for n in ("hotels", "customers", "payments", "clickstream")] == [3, 4, 5, 7]


def test_quarantine(spark, lake):
    root, _ = lake
    kept = read_table(spark, f"{root}/quarantine/bookings")
    assert rows(kept, "booking_id", "_dq_reason") == [
        ("R10", "INVALID_AMOUNT"), ("R3", "DUPLICATE_KEY"), ("R4", "MISSING_HOTEL_ID"),
        ("R6", "MISSING_CURRENCY"), ("R8", "NON_POSITIVE_NIGHTS"),
    ]
    assert rows(read_table(spark, f"{root}/quarantine/clickstream"), "event_id", "_dq_reason") == [
        ("E8", "MISSING_SESSION_ID"),
    ]
    assert {c for c in read_table(spark, f"{root}/silver/customers").columns} & {"full_name", "email", "phone"} == set()


def test_breaker(spark, lake):
    root, _ = lake
    before = read_table(spark, f"{root}/silver/bookings").inputFiles()
    with pytest.raises(BreakerTripped):
        silver.cleanse(spark, root, "bookings", land.DAY1)
    assert read_table(spark, f"{root}/silver/bookings").inputFiles() == before
    with pytest.raises(BreakerTripped):
        silver.cleanse(spark, root, "hotels", land.DAY1)
    # Exactly at the limit passes.
    assert silver.cleanse(spark, root, "customers", land.DAY1)["dq_invalid"] == 1


def test_fact_bookings(spark, lake):
    root, _ = lake
    fact = table(spark, root, "fact_bookings")
    assert rows(fact, "booking_id", "amount_usd", "channel_id", "booking_status") == [
        ("R1", D("200.00"), 1, "CONFIRMED"), ("R2", D("300.00"), 3, "CANCELLED"), ("R3", D("50.00"), 2, "CONFIRMED"),
        ("R5", D("64.52"), 2, "NO_SHOW"), ("R7", D("320.00"), 2, "CONFIRMED"), ("R9", D("40.00"), 1, "CONFIRMED"),
    ]
    assert fact.filter("hotel_sk = 0").count() == 0
    # Nobody is known to have made R5.
    assert rows(fact.filter("customer_sk = 0"), "booking_id") == [("R5",)]


def test_fact_payments(spark, lake):
    root, _ = lake
    fact = table(spark, root, "fact_payments")
    assert rows(fact, "payment_id", "amount_usd", "refund_amount_usd", "is_refunded", "is_orphan") == [
        ("P1", D("200.00"), D("0.00"), False, False),
        ("P2", D("300.00"), D("150.00"), True, False),
        ("P3", D("50.00"), D("0.00"), False, False),
        ("P4", D("10.00"), D("0.00"), False, True),
        ("P7", D("40.00"), D("4.00"), False, False),
    ]


def test_sessions(spark, lake):
    root, _ = lake
    fact = table(spark, root, "fact_web_sessions")
    day = dt.date(2026, 6, 30)
    assert rows(
        fact, "session_id", "device_type", "channel_id", "total_events", "page_views", "search_count",
        "hotels_viewed", "session_duration_sec", "converted", "booking_id", "_batch_date",
    ) == [
        ("S1", "desktop", 1, 4, 1, 1, 1, 870, True, "R1", day),
        ("S2", "tablet", 2, 2, 1, 0, 1, 45, False, None, day),
        ("S3", "kiosk", 4, 1, 1, 0, 0, 0, False, None, day),
    ]
    assert fact.filter("customer_sk = 0").count() == 0


def test_inventory(spark, lake):
    root, _ = lake
    fact = table(spark, root, "fact_hotel_inventory")
    assert rows(
        fact, "stay_date", "room_type", "total_rooms", "booked_rooms", "available_rooms",
        "occupancy_rate", "adr_usd", "revpar_usd",
    ) == [
        # Before the first version of the hotel.
        (dt.date(2026, 6, 20), "Twin", 0, 1, 0, 100.0, D("20.00"), D("20.00")),
        (dt.date(2026, 6, 21), "Twin", 0, 1, 0, 100.0, D("20.00"), D("20.00")),
        (dt.date(2026, 7, 4), "Loft", 120, 1, 119, 0.83, D("100.00"), D("0.83")),
        # 100 and 106 2/3 on one night.
        (dt.date(2026, 7, 5), "Loft", 120, 2, 118, 1.67, D("103.33"), D("1.72")),
        (dt.date(2026, 7, 6), "Loft", 120, 1, 119, 0.83, D("106.67"), D("0.89")),
        (dt.date(2026, 7, 7), "Loft", 120, 1, 119, 0.83, D("106.67"), D("0.89")),
        (dt.date(2026, 7, 10), "Dorm", 25, 1, 24, 4.0, D("50.00"), D("2.00")),
    ]
    assert {r[0] for r in rows(fact.filter("total_rooms = 0"), "hotel_sk")} == {0}


def test_reports(spark, lake):
    root, _ = lake
    assert rows(
        table(spark, root, "rpt_daily_revenue"), "country", "hotel_tier", "channel_name", "total_bookings",
        "cancelled_bookings", "confirmed_revenue_usd", "avg_nights", "cancellation_rate_pct",
    ) == [
        ("ID", "economy", "Mobile App", 2, 0, D("50.00"), 2.0, 0.0),
        ("SG", "upscale", "Mobile App", 1, 0, D("320.00"), 3.0, 0.0),
        ("SG", "upscale", "Web", 1, 0, D("200.00"), 2.0, 0.0),
        ("VN", "midscale", "Partner API", 1, 1, None, 3.0, 100.0),
        ("VN", "midscale", "Web", 1, 0, D("40.00"), 2.0, 0.0),
    ]
    # A refund counts where the payment is refunded, so not that of P7.
    assert rows(
        table(spark, root, "rpt_hotel_performance"), "hotel_id", "total_bookings", "cancelled_bookings",
        "total_revenue_usd", "avg_stay_nights", "cancellation_rate_pct", "total_payments_usd", "total_refunds_usd",
    ) == [
        ("H10", 2, 1, D("40.00"), 2.5, 50.0, D("40.00"), D("150.00")),
        ("H20", 2, 0, D("50.00"), 2.0, 0.0, D("50.00"), D("0.00")),
        ("H30", 2, 0, D("520.00"), 2.5, 0.0, D("200.00"), D("0.00")),
    ]


def test_audit_and_inventory(spark, lake):
    root, _ = lake
    audit = table(spark, root, "run_audit")
    assert audit.filter("status = 'SUCCESS'").count() == 7
    assert audit.filter("step_name = 'bronze'").first()["rows_processed"] == 37
    assert audit.filter("_created_at >= finished_at").count() == 7
    want = {}
    for folder, _, files in os.walk(root):
        for name in files:
            if not name.endswith(".crc"):  # the local store's own check files
                path = os.path.join(folder, name)
                layer = os.path.relpath(path, root).split(os.sep)[0]
                layer = layer if layer in fv.LAYERS else "other"
                want.setdefault(layer, []).append((path, os.path.getsize(path)))

    def listed(**by):
        return {r["layer"]: (r["n_files"], r["n_bytes"]) for r in lake_inventory(spark, root, **by).collect()}

    def counted(pick, layers):
        picked = {n: [s for p, s in want.get(n, []) if pick in p] for n in layers}
        return {n: (len(s), sum(s)) for n, s in picked.items()}

    everything = (*fv.LAYERS, "other")
    assert listed() == counted("", everything) and listed()["raw"][0] == 6
    assert any(size == 0 for found in want.values() for _, size in found)
    assert listed(date=land.DAY1) == counted(f"_batch_date={land.DAY1}/", everything)
    assert listed(date=land.DAY1)["bronze"][0] > 0
    assert listed(date="2020-01-01") == {n: (0, 0) for n in everything}
    assert listed(layer="raw") == counted("", ("raw",))
    open(f"{root}/stray", "w").close()
    assert listed()["other"][0] == len(want["other"]) + 1
    os.remove(f"{root}/stray")


def test_second_day(spark, lake2):
    hotels = table(spark, lake2, "dim_hotels").filter("hotel_sk <> 0")
    always = dt.date(9999, 12, 31)
    assert rows(hotels, "hotel_id", "total_rooms", "valid_from", "valid_to", "is_current") == [
        ("H10", 40, dt.date(2026, 6, 30), dt.date(2026, 6, 30), False),
        ("H10", 44, dt.date(2026, 7, 1), always, True),
        ("H20", 25, dt.date(2026, 6, 30), always, True),
        ("H30", 120, dt.date(2026, 6, 30), always, True),
        ("H70", 60, dt.date(2026, 7, 1), always, True),
    ]
    customers = table(spark, lake2, "dim_customers").filter("customer_sk <> 0")
    assert rows(customers.filter("not is_current"), "user_id", "loyalty_tier") == [("C2", "Red")]
    assert rows(customers.filter("is_current"), "user_id") == [("C1",), ("C2",), ("C3",), ("C4",), ("C5",)]

    fact = table(spark, lake2, "fact_bookings")
    day2 = dt.date(2026, 7, 1)
    assert rows(fact.filter(F.col("_batch_date") == day2), "booking_id", "is_cancelled", "channel_id") == [
        ("R11", False, 1), ("R12", False, 4), ("R7", True, 2),
    ]
    assert fact.count() == fact.select("booking_id").distinct().count() == 8
    # No rate for euros; the rates of the booking day for R7.
    amounts = dict(rows(fact.filter("booking_id in ('R7', 'R11', 'R12')"), "booking_id", "amount_usd"))
    assert amounts == {"R7": D("320.00"), "R11": D("100.00"), "R12": None}

    sessions = {r["session_id"]: r for r in table(spark, lake2, "fact_web_sessions").collect()}
    assert sorted(sessions) == ["S1", "S2", "S3", "S4"]
    later = sessions["S3"]
    assert (later["total_events"], later["converted"], later["booking_id"], later["_batch_date"]) == (2, True, "R11", day2)
    anonymous = sessions["S4"]
    assert (anonymous["customer_sk"], anonymous["hotels_viewed"], anonymous["channel_id"]) == (0, 1, 4)

    payments = table(spark, lake2, "fact_payments")
    # The second day has 16,000 IDR and 25,500 VND to the dollar.
    assert rows(payments.filter(F.col("_batch_date") == day2), "payment_id", "amount_usd", "refund_amount_usd", "is_orphan") == [
        ("P3", D("48.44"), D("48.44"), False), ("P8", D("100.00"), D("0.00"), False), ("P9", D("1.00"), D("0.00"), True),
    ]

    inventory = table(spark, lake2, "fact_hotel_inventory").filter("hotel_sk <> 0")
    assert rows(inventory, "stay_date", "booked_rooms", "available_rooms", "occupancy_rate", "adr_usd", "revpar_usd") == [
        (dt.date(2026, 7, 4), 1, 119, 0.83, D("100.00"), D("0.83")),
        (dt.date(2026, 7, 5), 1, 119, 0.83, D("100.00"), D("0.83")),
        (dt.date(2026, 7, 10), 1, 24, 4.0, D("50.00"), D("2.00")),
        # R11 and R12, the latter without a rate.
        (dt.date(2026, 7, 20), 2, 58, 3.33, D("50.00"), D("1.67")),
        (dt.date(2026, 7, 21), 1, 59, 1.67, D("50.00"), D("0.83")),
    ]
    performance = {r["hotel_id"]: r for r in table(spark, lake2, "rpt_hotel_performance").collect()}
    assert [(h, performance[h]["total_bookings"], performance[h]["total_refunds_usd"]) for h in sorted(performance)] == [
        ("H10", 2, D("150.00")), ("H20", 2, D("48.44")), ("H30", 2, D("0.00")), ("H70", 2, D("0.00")),
    ]


def test_rerun_and_backfill(spark, lake2):
    names = (
        "dim_hotels", "dim_customers", "fact_bookings", "fact_payments", "fact_web_sessions",
        "fact_hotel_inventory", "rpt_daily_revenue",
    )
    state = lambda: {
        n: sorted(map(str, table(spark, lake2, n).collect())) for n in names
    }
    before = state()
    daily.run_day(spark, lake2, land.DAY2, "rerun")
    assert state() == before
    daily.run_day(spark, lake2, land.DAY1, "backfill", max_ratio=0.5)
    assert state() == before


def test_a_lost_fact_is_loaded_whole(spark, lake2):
    names = ("fact_bookings", "fact_payments", "fact_web_sessions")
    state = lambda: {n: sorted(map(str, table(spark, lake2, n).collect())) for n in names}
    before = state()
    for name in names:
        delete_folder(spark, daily.analytics_table(lake2, name))
    days = daily.build_facts(spark, lake2, land.DAY2)
    assert state() == before
    assert days == {n: [land.DAY1, land.DAY2] for n in names}


def test_refresh_keeps_the_old_table_when_it_fails(spark, tmp_path):
    target = f"{tmp_path}/t"
    refresh(spark.range(3), target)
    with pytest.raises(Exception, match="no such luck"):
        refresh(spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("no such luck"))).alias("id")), target)
    assert read_table(spark, target).count() == 3 and os.listdir(tmp_path) == ["t"]
    refresh(read_table(spark, target).filter("id > 0"), target)
    assert read_table(spark, target).count() == 2 and os.listdir(tmp_path) == ["t"]


def test_upsert_leaves_no_work_folder(spark, tmp_path):
    base = work_folder(spark, "x").rsplit("/", 1)[0].removeprefix("file:")
    left = lambda: {f for f in os.listdir(base) if f.startswith("upsert-")} if os.path.isdir(base) else set()
    before, target = left(), f"{tmp_path}/t"
    day = lambda n, d: spark.sql(f"SELECT id, DATE '{d}' AS _batch_date FROM range({n})")
    assert upsert(day(4, "2026-01-01"), target, ["id"]) == ["2026-01-01"]
    assert upsert(day(2, "2026-01-02"), target, ["id"]) == ["2026-01-01", "2026-01-02"]
    assert upsert(day(4, "2026-01-03"), target, ["id"]) == ["2026-01-01", "2026-01-02", "2026-01-03"]
    assert rows(read_table(spark, target), "id", "_batch_date") == [(i, dt.date(2026, 1, 3)) for i in range(4)]
    bad = day(1, "2026-01-04").withColumn("id", F.raise_error(F.lit("bad row")).cast("bigint"))
    with pytest.raises(Exception, match="bad row"):
        upsert(bad, target, ["id"])
    assert left() == before


def test_sessions_are_pruned_before_versions_are_ranked(spark):
    """An event that moved to another session counts there, and only touched sessions come."""
    fields = (*fv.STAGING_COLUMNS["clickstream"], *fv.STAGING_META)

    def event(e, s, day):
        given = {"event_id": e, "session_id": s, "event_timestamp": dt.datetime(2026, 1, 1), "_batch_date": dt.date(2026, 1, day)}
        return tuple(given.get(f) for f in fields)

    types = {"event_timestamp": "timestamp", "_batch_date": "date", "_ingested_at": "timestamp"}
    schema = ", ".join(f"{f} {types.get(f, 'string')}" for f in fields)
    raw = spark.createDataFrame([
        event("a", "s1", 1), event("b", "s1", 2), event("c", "s2", 1), event("d", "s3", 2),
        event("d", "s2", 3), event("e", " s1 ", 3),
    ], schema)
    for day in ("2026-01-01", "2026-01-02", "2026-01-03"):
        whole = facts.touched_sessions(staging.stg_clickstream(raw), day)
        pruned = facts.touched_sessions(staging.staging_sessions(raw, day), day)
        assert rows(pruned, "event_id", "session_id") == rows(whole, "event_id", "session_id")
    assert {r[0] for r in rows(staging.staging_sessions(raw, "2026-01-02"), "event_id")} == {"a", "b", "d", "e"}


def test_failures_are_isolated(spark, tmp_path):
    root = str(tmp_path)
    land.land_day1(root)
    land.put(root, "payments", land.DAY1, "payments.csv", "payment_id,amount\nP1,1\n")
    with pytest.raises(daily.StepFailed, match="missing columns"):
        daily.run_day(spark, root, land.DAY1, "bad", max_ratio=0.5)
    assert read_table(spark, f"{root}/bronze/clickstream").count() == 8
    audit = table(spark, root, "run_audit").collect()
    assert [(r["step_name"], r["status"]) for r in audit] == [("bronze", "FAILED")]


def test_malformed_records(spark, tmp_path):
    root = str(tmp_path)
    lines = land.PAYMENTS_CSV.splitlines()
    land.put(root, "payments", land.DAY1, "p.csv", "\n".join([*lines, "P10,R1", lines[1] + ",x", '"open,quote']) + "\n")
    assert bronze_ingest(spark, SOURCES["payments"], root, land.DAY1, "r") == {"bronze_rows": 7, "rejected_rows": 3}
    # A rerun with repaired files clears the rejected rows.
    land.put(root, "payments", land.DAY1, "p.csv", land.PAYMENTS_CSV)
    assert bronze_ingest(spark, SOURCES["payments"], root, land.DAY1, "r") == {"bronze_rows": 7, "rejected_rows": 0}

    text = land.xml("hotels", "hotel", land.HOTEL_FIELDS, land.HOTELS[:3]).replace("Merapi View", "R & <")
    land.put(root, "hotels", land.DAY1, "h.xml", text)
    assert bronze_ingest(spark, SOURCES["hotels"], root, land.DAY1, "r") == {"bronze_rows": 2, "rejected_rows": 1}
    nested = land.xml("hotels", "hotel", (*land.HOTEL_FIELDS, "extra"), [(*land.HOTELS[0], "<a>1</a><b>x</b>")])
    land.put(root, "hotels", land.DAY1, "h.xml", nested)
    assert bronze_ingest(spark, SOURCES["hotels"], root, land.DAY1, "r")["bronze_rows"] == 1
    kept = read_table(spark, f"{root}/bronze/hotels").select("extra", "_source_format", "_run_id").first()
    assert tuple(kept) == ('{"a":"1","b":"x"}', "xml", "r")


def test_missing_input(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        bronze_ingest(spark, SOURCES["hotels"], str(tmp_path), land.DAY1, "r")
    with pytest.raises(FileNotFoundError):
        bronze_ingest(spark, SOURCES["bookings"], str(tmp_path), land.DAY1, "r")
    with pytest.raises(FileNotFoundError):
        silver.cleanse(spark, str(tmp_path), "bookings", land.DAY1)
