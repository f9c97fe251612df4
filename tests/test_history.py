"""Dimensions and room nights kept up day by day: equal to building them from everything."""

import datetime as dt
import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from lakestay import fixed_values as fv
from lakestay.operators.history import splice, touched_keys
from lakestay.operators.scd2 import scd2
from lakestay.plans import facts, inventory, staging
from lakestay.sinks import versioned as ve
from lakestay.sources.readers import read_table

DAY = lambda n: dt.date(2026, 1, 1) + dt.timedelta(days=n)


def rows(df):
    return sorted(map(str, df.collect()))


def snapshot_frame(spark, data):
    return spark.createDataFrame(data, "id string, a string, n int, _batch_date date")


@pytest.mark.parametrize("seed", range(3))
def test_snapshots_in_any_order(spark, tmp_path, seed):
    """Days come in any order, some again with other rows or without some keys."""
    r = random.Random(seed)
    days = [d for d in range(7)] + [r.randrange(7) for _ in range(3)]
    r.shuffle(days)
    known, versions = {}, None
    for step, d in enumerate(days):
        own = [(f"k{k}", r.choice([None, "x", "y"]), r.randrange(2), DAY(d)) for k in range(8) if r.random() < 0.7]
        known[d] = own
        snapshot = snapshot_frame(spark, own)
        if versions is None:
            now = scd2(snapshot, "id", ["a", "n"], "sk")
        else:
            touched_keys(versions, snapshot, str(DAY(d)), "id", ["a", "n"]).write.parquet(f"{tmp_path}/t{step}")
            touched = spark.read.parquet(f"{tmp_path}/t{step}")
            after = [x for o, y in known.items() if o > d for x in y]
            later = snapshot_frame(spark, after).select("id", "_batch_date") if after else None
            new = splice(versions, touched, later, str(DAY(d)), "id", ["a", "n"], "sk")
            now = versions.join(touched.select("id"), "id", "left_anti").select(*versions.columns).unionByName(new)
        now.coalesce(1).write.parquet(f"{tmp_path}/v{step}")
        versions = spark.read.parquet(f"{tmp_path}/v{step}")
        whole = scd2(snapshot_frame(spark, [x for y in known.values() for x in y]), "id", ["a", "n"], "sk")
        assert rows(versions) == rows(whole), (seed, days, step)


def test_only_changed_keys_are_touched(spark):
    day = lambda d, n: [(f"k{k}", "x", k if k != 3 or d == 0 else n, DAY(d)) for k in range(50)]
    versions = scd2(snapshot_frame(spark, day(0, 0) + day(2, 0)), "id", ["a", "n"], "sk")
    touched = touched_keys(versions, snapshot_frame(spark, day(4, 9)), str(DAY(4)), "id", ["a", "n"])
    assert [x["id"] for x in touched.collect()] == ["k3"]
    again = touched_keys(versions, snapshot_frame(spark, day(2, 0)), str(DAY(2)), "id", ["a", "n"])
    assert again.count() == 0


# ---- room nights ----------------------------------------------------------------------


def booking_frame(spark, data):
    fields = {
        "booking_id": "string", "hotel_id": "string", "room_type": "string", "checkin_date": "date", "nights": "int",
        "total_amount": "decimal(15,2)", "currency": "string", "booking_status": "string", "_batch_date": "date",
    }
    df = spark.createDataFrame(data, ", ".join(f"{n} {t}" for n, t in fields.items()))
    types = {"checkout_date": "date", "created_at": "timestamp", "_ingested_at": "timestamp"}
    others = [c for c in (*fv.STAGING_COLUMNS["bookings"], *fv.STAGING_META) if c not in fields]
    return df.select("*", *[F.lit(None).cast(types.get(c, "string")).alias(c) for c in others])


def hotel_frame(spark, rooms):
    data = [(100 * int(h[1:]) + n, h, n, since, until) for h, n, since, until in rooms]
    return spark.createDataFrame(data, "hotel_sk long, hotel_id string, total_rooms int, valid_from date, valid_to date")


RATES = [("USD", D("1"), DAY(-99)), ("EUR", D("0.7"), DAY(-99)), ("EUR", D("0.9"), DAY(3))]


def batch(r, d):
    """Bookings of a day, new ones and later versions of old ones."""
    out = {}
    for _ in range(14):
        key = f"B{r.randrange(30)}"
        out[key] = (
            key, r.choice(["H1", "H2", "H9"]), r.choice(["Twin", ""]), DAY(r.randrange(6)), r.choice([0, 1, 2, 3, 7]),
            D(r.randrange(1000, 99999)) / 100, r.choice(["USD", "EUR", "XXX"]), r.choice(["CONFIRMED", "CONFIRMED", "CANCELLED", "PENDING"]), DAY(d),
        )
    return list(out.values())


def test_inventory_by_differences(spark, tmp_path):
    """Days in any order and repeated, a change of hotels, and a failure between the two tables."""
    r = random.Random(5)
    fact, kept, pending = (f"{tmp_path}/{n}" for n in ("fact", "kept", "_pending"))
    fx = spark.createDataFrame(RATES, "currency string, units_per_usd decimal(18,6), valid_from date")
    hotels = hotel_frame(spark, [("H1", 5, DAY(-9), DAY(99)), ("H2", 0, DAY(2), DAY(99))])
    known = {2: batch(r, 2), 4: batch(r, 4)}
    raw = lambda: booking_frame(spark, [x for y in known.values() for x in y])
    inventory.build(staging.stg_bookings(raw()), hotels, fx, fact, kept)

    def check(note):
        whole = facts.fact_hotel_inventory(staging.stg_bookings(raw()), hotels, fx)
        got = read_table(spark, fact).select(*facts.INVENTORY)
        assert rows(got) == rows(whole), note

    check("first")
    for step, d in enumerate((5, 2, 3, 5)):
        known[d] = batch(r, d) if step != 1 else known[2][:4]  # a rerun without most of its bookings
        changed = []
        if step == 2:  # the hotel grows from day 3 on
            hotels = hotel_frame(spark, [("H1", 5, DAY(-9), DAY(2)), ("H1", 8, DAY(3), DAY(99)), ("H2", 0, DAY(2), DAY(99))])
            changed = [(spark.createDataFrame([("H1",)], "hotel_id string"), str(DAY(3)))]
        inventory.update(raw(), hotels, fx, fact, kept, pending, str(DAY(d)), changed)
        check(step)

    # A run ends after the change is decided and the nights are in: the next one goes on.
    known[6] = batch(r, 6)
    real = ve.VersionedTable.upsert

    def upsert(self, new, *a, **kw):
        if self.path == kept:
            raise OSError("store is down")
        return real(self, new, *a, **kw)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(ve.VersionedTable, "upsert", upsert)
        with pytest.raises(OSError, match="store is down"):
            inventory.update(raw(), hotels, fx, fact, kept, pending, str(DAY(6)))
    inventory.update(raw(), hotels, fx, fact, kept, pending, str(DAY(6)))
    check("after a failure")
    # A repeated day changes nothing and writes no night.
    before = ve.VersionedTable.open(spark, fact)._versions()
    inventory.update(raw(), hotels, fx, fact, kept, pending, str(DAY(6)))
    check("again")
    assert ve.VersionedTable.open(spark, fact)._versions() == before


def test_only_touched_nights_are_read(spark, tmp_path):
    fact, kept = f"{tmp_path}/fact", f"{tmp_path}/kept"
    fx = spark.createDataFrame(RATES, "currency string, units_per_usd decimal(18,6), valid_from date")
    hotels = hotel_frame(spark, [("H1", 5, DAY(-9), DAY(999))])
    data = [(f"B{i}", "H1", "Twin", DAY(i), 1, D("70"), "USD", "CONFIRMED", DAY(0)) for i in range(40)]
    inventory.build(staging.stg_bookings(booking_frame(spark, data)), hotels, fx, fact, kept)
    nights = ve.VersionedTable.open(spark, fact).read()
    change = spark.createDataFrame([("H1", "Twin", DAY(7)), ("H1", "Twin", DAY(30))], "_hotel_id string, room_type string, stay_date date")
    touched = inventory.touched_nights(nights, change)
    assert sorted(x["stay_date"] for x in touched.collect()) == [DAY(7), DAY(30)]
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [stay_date" in plan or "PartitionFilters: [isnotnull(stay_date" in plan
