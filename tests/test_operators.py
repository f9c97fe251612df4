"""Operators on small frames: hot keys, brute force, edge cases, plans."""

import datetime as dt
import random
import re
from collections import Counter
from decimal import Decimal as D

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakestay import fixed_values as fv
from lakestay.functions import aggregates as agg
from lakestay.functions import keys, labels, parsing
from lakestay.operators import frames, joins, quality, skew, versions
from lakestay.operators.scd2 import scd2
from lakestay.plans import checks, staging
from lakestay.plans.daily import run_all
from lakestay.sinks import batches
from lakestay.sinks import staging as sink
from lakestay.sinks.upsert import merged, upsert
from lakestay.sources import readers, seeds

SLOW = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def plan(df):
    """The physical plan; after a run the one that ran, without the first draft."""
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def one(spark, expr, **values):
    names = list(values)
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} string" for n in names))
    return df.select(expr).first()[0]


# ---- parsing -------------------------------------------------------------------


@pytest.mark.parametrize("text, want", [
    (" 1,234,567 IDR ", D("1234567.00")), ("S$8,800.50", D("8800.50")), ("61.20", D("61.20")),
    ("-12.50", D("12.50")), ("1.234,56", D("1.23")), ("FREE", None), ("1.2.3", None), (".", None), ("", None),
    (None, None), ("99999999999999999", None), ("0.005", D("0.01")),
])
def test_money(spark, text, want):
    assert one(spark, parsing.to_money("x"), x=text) == want


@pytest.mark.parametrize("text, want", [
    ("TRUE", True), (" y ", True), ("1", True), ("Yes", True), ("no", False), ("0", False), ("N", False),
    ("maybe", None), ("", None), (None, None),
])
def test_bool(spark, text, want):
    assert one(spark, parsing.to_bool("x"), x=text) is want


def test_dates(spark):
    assert one(spark, parsing.parse_date("x"), x=" 2024-02-29 ") == dt.date(2024, 2, 29)
    for bad in ("2023-02-29", "29/02/2024", "2024-02-29 10:00:00", "", None):
        assert one(spark, parsing.parse_date("x"), x=bad) is None
    assert one(spark, parsing.parse_ts("x"), x="2024-02-29 10:00:01") == dt.datetime(2024, 2, 29, 10, 0, 1)
    assert one(spark, parsing.parse_ts("x"), x="2024-02-29") is None


def test_numbers_and_lists(spark):
    assert one(spark, parsing.parse_int("x"), x=" 7 ") == 7
    assert one(spark, parsing.parse_int("x"), x="seven") is None
    assert one(spark, parsing.parse_int("x"), x="99999999999") is None
    assert one(spark, parsing.parse_double("x"), x="1e3") == 1000.0
    assert one(spark, parsing.clean_list_literal("x"), x="['Bar', \"sea view\"]") == "bar,seaview"
    assert one(spark, parsing.clean_list_literal("x"), x=None) == ""
    assert one(spark, parsing.to_tag_array("x"), x="wifi,,Bar,") == ["bar", "wifi"]


@pytest.mark.parametrize("spelling, want", [
    *fv.STATUS_SPELLINGS.items(), (" Canceled", "CANCELLED"), ("odd", "UNKNOWN"), (None, "UNKNOWN"),
])
def test_status(spark, spelling, want):
    assert one(spark, labels.map_status("x"), x=spelling) == want


@pytest.mark.parametrize("spelling, want", [
    *fv.CHANNEL_SPELLINGS.items(), ("Partner_ota", "Partner API"), ("Partner API", "Partner API"),
    ("Mobile App", "Mobile App"), ("fax", "Other"), (None, "Other"),
])
def test_channel(spark, spelling, want):
    assert one(spark, labels.map_channel("x"), x=spelling) == want


def test_masks_and_keys(spark):
    import hashlib

    digest = hashlib.sha256(b"ann@example.org").hexdigest()
    assert one(spark, keys.mask_email("x"), x=" Ann@Example.ORG ") == digest
    assert one(spark, keys.mask_email("x"), x=" ") == ""
    assert one(spark, keys.mask_phone("x"), x="+84 (901)-2") == hashlib.sha256(b"+849012").hexdigest()
    assert one(spark, keys.mask_phone("x"), x=None) == ""
    key = one(spark, keys.surrogate_key("a", "b"), a="HTL-1", b="2026-10-01")
    assert key == int(hashlib.md5(b"HTL-1|2026-10-01").hexdigest()[:16], 16) >> 1
    assert one(spark, keys.date_id("x"), x="2026-10-01") == 20261001


def test_usd(spark):
    def usd(amount, rate):
        return one(spark, keys.to_usd(F.col("a").cast("decimal(15,2)"), F.col("r").cast("decimal(18,6)")), a=amount, r=rate)

    assert usd("1000000.00", "15500") == D("64.52")
    assert usd("0.01", "2") == D("0.01")  # half up
    assert usd("1.00", "0") is None and usd("1.00", None) is None and usd(None, "1") is None


# ---- duplicates and hot keys -----------------------------------------------------


def events(spark, n=600, hot=0.5, seed=3):
    rng = random.Random(seed)
    rows = [
        ("hot" if rng.random() < hot else f"k{rng.randrange(40)}", rng.randrange(8), rng.randrange(3), i)
        for i in range(n)
    ]
    rows += [("copy", 1, 1, -1)] * 50 + [(None, 1, 2, -2), (None, 1, 2, -3)]
    return spark.createDataFrame(rows, "k string, v int, x int, id int").repartition(5)


@pytest.mark.parametrize("hot_rows", [10, 1_000_000])
def test_dedup_of_hot_keys(spark, hot_rows):
    df = events(spark).select("*", F.monotonically_increasing_id().alias("_row_id")).cache()
    kept, losers = versions.dedup(df, ["k"], "v", ["x", "id"], ["_row_id"], hot_rows)
    rows = df.drop("_row_id").collect()
    best = {}
    for r in rows:
        best[r.k] = min(best.get(r.k, r), r, key=lambda q: (-q.v, q.x, q.id))
    plain = lambda d: Counter(map(tuple, d.drop("_row_id").collect()))
    assert plain(kept) == Counter(map(tuple, best.values()))
    assert plain(losers) == Counter(map(tuple, rows)) - Counter(map(tuple, best.values()))
    df.unpersist()


def test_hot_split(spark):
    cold, hot = skew.split_hot(events(spark), ["k"], 10)
    assert {r.k for r in hot.select("k").distinct().collect()} >= {"hot", "copy"}
    counts = Counter(r.k for r in events(spark).collect())
    assert {r.k for r in cold.select("k").distinct().collect()} == {k for k, n in counts.items() if n <= 10}
    # A frame with no more rows than a hot key has none.
    assert skew.split_hot(spark.range(10), ["id"], 10)[1] is None
    assert skew.split_hot(spark.range(11), ["id"], 10)[1] is not None


def test_list_of_hot_keys_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(skew, "MOST_HOT", 4)
    rows = spark.range(1000).select(F.when(F.col("id") < 500, 0).otherwise(F.col("id") % 50).alias("k"))
    cold, hot = skew.split_hot(rows, ["k"], 5)
    # Fifty keys have more than five rows; four at most can have more than a quarter.
    assert {r.k for r in hot.distinct().collect()} == {0} and cold.count() + hot.count() == 1000


def test_without_hot_keys(spark):
    # Without hot keys nothing is ranked in parts.
    marked = versions.mark_duplicates(events(spark), ["k"], [F.col("v"), F.col("id")], ["id"])
    marked.collect()
    assert "_part" not in plan(marked)


@pytest.mark.parametrize("hot_rows", [10, 1_000_000])
def test_quality_split(spark, hot_rows):
    rules = (("ZERO", "v = 0"), ("NO_KEY", "k IS NULL"), ("X2", "x = 2"))
    df = events(spark)
    valid, rest = quality.split_dq(df, rules, ["k"], "v", ["x", "id"], ["id"], hot_rows)
    want = {}
    bad = Counter()
    for r in df.collect():
        codes = [c for c, hit in (("ZERO", r.v == 0), ("NO_KEY", r.k is None), ("X2", r.x == 2)) if hit]
        if codes:
            bad[";".join(codes)] += 1
        else:
            want.setdefault(r.k, []).append(r)
            bad["DUPLICATE_KEY"] += len(want[r.k]) > 1
    best = sorted(min(rows, key=lambda r: (-r.v, r.x, r.id)) for rows in want.values())
    assert sorted(map(tuple, valid.collect())) == sorted(map(tuple, best))
    assert {r[0]: r[1] for r in rest.groupBy(fv.DQ_REASON).count().collect()} == dict(bad)
    assert rest.schema[fv.DQ_REASON].dataType.simpleString() == "string"


def test_latest_version_is_cut_before_the_shuffle(spark):
    text = plan(versions.latest_version(events(spark), ["k"], "v"))
    assert text.index("Partial") > text.index("Exchange hashpartitioning(k")
    assert "WindowGroupLimit" in text


def test_breaker():
    assert quality.check_breaker(1, 5) == 0.2
    assert quality.check_breaker(0, 0) == 0.0
    with pytest.raises(quality.BreakerTripped):
        quality.check_breaker(2, 5)
    assert quality.check_breaker(2, 5, fv.MAX_REJECT_RATIO_RELAXED) == 0.4


def test_contract():
    assert quality.check_contract(["a", "b", "c"], ["b", "a"]) == ["c"]
    with pytest.raises(quality.ContractError, match="z"):
        quality.check_contract(["a"], ["a", "z"])


def test_null_condition_passes(spark):
    df = spark.createDataFrame([(None,), (1,), (-1,)], "n int")
    assert [r[0] for r in df.select(quality.dq_reason([("NEG", "n < 0")])).collect()] == ["", "", "NEG"]


# ---- joins in time -----------------------------------------------------------------

T0 = dt.datetime(2024, 1, 1)
moments = st.integers(0, 4 * 3600).map(lambda s: T0 + dt.timedelta(seconds=s * 7 % 20000))
maybe_key = st.sampled_from(["a", "b", None])


@SLOW
@given(
    left=st.lists(st.tuples(maybe_key, st.one_of(st.none(), moments)), max_size=30),
    right=st.lists(st.tuples(maybe_key, moments), max_size=20, unique=True),
)
def test_asof_forms_agree_with_brute_force(spark, left, right):
    ls = [(k, t, i) for i, (k, t) in enumerate(left)]
    rs = [(k, t, i) for i, (k, t) in enumerate(right)]
    l_df = spark.createDataFrame(ls, "k string, t timestamp, id int")
    r_df = spark.createDataFrame(rs, "k string, t timestamp, rid int")
    want = []
    for k, t, i in ls:
        hits = [(rt, rid) for rk, rt, rid in rs if k is not None and t is not None and rk == k and rt <= t]
        want.append((i, max(hits)[1] if hits else None))
    def in_slices(*args):
        return joins.asof_join_sliced(*args, slice_seconds=1800, hot_rows=3)

    for join in (joins.asof_join_interval, joins.asof_join_sliced, in_slices, joins.asof_join):
        found = join(l_df, r_df, ["k"], "t", "t", {"rid": "hit"})
        assert found.columns == ["k", "t", "id", "hit"]
        assert sorted((r.id, r.hit) for r in found.collect()) == want


@SLOW
@given(
    rows=st.lists(st.tuples(maybe_key, moments, st.sampled_from("xyz")), max_size=25),
    cands=st.lists(st.tuples(maybe_key, moments), max_size=25),
)
def test_nearest_match(spark, rows, cands):
    r_df = spark.createDataFrame(rows, "k string, t timestamp, g string")
    cs = [(k, t, i) for i, (k, t) in enumerate(cands)]
    c_df = spark.createDataFrame(cs, "k string, ct timestamp, id int")
    want = {}
    for k, t, g in rows:
        for ck, ct, i in cs:
            if k is not None and k == ck:
                here = (abs((t - ct).total_seconds()), i)
                want[g] = min(want.get(g, here), here)
    for hot_rows in (3, 1_000_000):
        found = joins.nearest_match(r_df, c_df, ["k"], "t", "ct", "id", ["g"], "best", 1800, hot_rows)
        assert {r.g: r.best for r in found.collect()} == {g: i for g, (_, i) in want.items()}


def test_neighbours_are_made_once(spark):
    """Counting rows, counting keys and ordering them read a table, not the frames again."""
    left = spark.range(20).selectExpr("id % 3 AS k", "timestamp_seconds(id * 7) AS ts", "id AS g")
    right = spark.range(20).selectExpr("id % 3 AS k", "timestamp_seconds(id * 5) AS at", "id AS c")
    found = joins.nearest_match(left, right, ["k"], "ts", "at", "c", ["g"], "c", hot_rows=4)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Range" not in plan and found.count() == 20


def test_asof_choice(spark):
    left = spark.createDataFrame([("a", dt.date(2024, 1, 2))], "k string, d date")
    right = seeds.literal_table(spark, ("k", "since", "v"), [("a", dt.date(2024, 1, 1), 1)])
    small = joins.asof_join(left, right, ["k"], "d", "since", {"v": "v"})
    assert "BroadcastHashJoin" in plan(small)
    unknown_size = spark.createDataFrame([("a", dt.date(2024, 1, 1), 1)], "k string, since date, v int")
    large = joins.asof_join(left, unknown_size, ["k"], "d", "since", {"v": "v"})
    assert [r.v for r in large.collect()] == [1]
    # The two sides are never joined; nothing is hot, so only the ordinary form runs.
    assert "Join" not in plan(large) and "_slice" not in plan(large)
    assert small.first().v == 1


def test_null_keys_are_spread_and_match_nothing(spark):
    dim = seeds.literal_table(
        spark, ("id", "sk", "valid_from", "valid_to"),
        [("u1", 7, dt.date(2024, 1, 1), dt.date(9999, 12, 31)), ("", 8, dt.date(2024, 1, 1), dt.date(9999, 12, 31))],
    )
    rows = [(i, "u1" if i % 4 == 0 else None, dt.date(2024, 1, 1 + i % 3)) for i in range(40)]
    fact = spark.createDataFrame(rows, "n int, user string, day date")
    found = joins.scd2_lookup(fact, dim, ("user", "id"), "day", {"sk": "sk"}, {"sk": F.lit(0).cast("long")})
    assert sorted((r.n, r.sk) for r in found.collect()) == [(i, 7 if i % 4 == 0 else 0) for i in range(40)]
    key = skew.spread_nulls(F.col("user"), F.col("n"))
    assert fact.select(key.alias("k")).distinct().count() == 31


def test_lookups(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "id int, code string")
    dim = spark.createDataFrame([("a", "A")], "code string, label string")
    found = joins.lookup(fact, dim, {"code": "code"}, {"label": "label"}, {"label": F.lit("?")})
    assert sorted((r.id, r.label) for r in found.collect()) == [(1, "A"), (2, "?"), (3, "?")]
    flagged = joins.orphan_flag(fact, dim, ("code", "code"), {"label": "label"}, {"label": F.lit("")})
    assert {r.id: r.is_orphan for r in flagged.collect()} == {1: False, 2: True, 3: True}
    assert [r.id for r in joins.missing_refs(fact, "code", dim, "code").collect()] == [2]


# ---- history ------------------------------------------------------------------------


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def test_scd2_with_nulls(spark):
    rows = [
        ("h", day(0), "a", None), ("h", day(1), None, "a"), ("h", day(2), None, "a"), ("h", day(5), "a", None),
        ("g", day(3), None, None), ("g", day(4), None, None),
    ]
    df = spark.createDataFrame(rows, "id string, _batch_date date, x string, y string")
    dim = scd2(df, "id", ["x", "y"], "sk")
    assert sorted((r.id, r.valid_from, r.valid_to, r.is_current) for r in dim.collect()) == [
        ("g", day(3), dt.date(9999, 12, 31), True),
        ("h", day(0), day(0), False), ("h", day(1), day(4), False), ("h", day(5), dt.date(9999, 12, 31), True),
    ]
    assert plan(dim).count("Exchange") == 1
    assert quality.check_scd2(dim, "id").count() == 0
    assert dim.select("sk").distinct().count() == 4


def test_check_scd2_finds_faults(spark):
    end = dt.date(9999, 12, 31)
    rows = [
        ("gap", day(0), day(1), False), ("gap", day(3), end, True),
        ("over", day(0), day(4), False), ("over", day(3), end, True),
        ("two", day(0), day(2), True), ("two", day(3), end, True),
        ("none", day(0), end, False), ("back", day(5), day(4), True), ("good", day(0), end, True),
    ]
    df = spark.createDataFrame(rows, "k string, valid_from date, valid_to date, is_current boolean")
    assert sorted(map(tuple, quality.check_scd2(df, "k").collect())) == [
        ("back", "gap_or_overlap"), ("gap", "gap_or_overlap"), ("none", "current_versions != 1"),
        ("over", "gap_or_overlap"), ("two", "current_versions != 1"),
    ]


def test_staging_batch_prunes_and_skips_replaced_rows(spark, tmp_path):
    contract = fv.STAGING_COLUMNS["payments"]
    rows = [("P1", day(0)), ("P2", day(0)), ("P1", day(1)), ("P3", day(1)), ("P3", day(2))]
    df = spark.createDataFrame(rows, "payment_id string, _batch_date date")
    for c in (*contract, *fv.STAGING_META):
        if c not in df.columns:
            kind = "decimal(15,2)" if "amount" in c else "timestamp" if c.endswith("_at") else "string"
            df = df.withColumn(c, F.lit(None).cast(kind))
    table = str(tmp_path / "payments")
    batches.write_days(df, table)
    ids = lambda d: sorted(r.payment_id for r in staging.staging_batch("payments", readers.read_table(spark, table), str(d)).collect())
    assert (ids(day(0)), ids(day(1)), ids(day(2))) == (["P2"], ["P1"], ["P3"])
    text = plan(staging.staging_batch("payments", readers.read_table(spark, table), str(day(1))))
    assert re.search(r"PartitionFilters: \[[^\]]*_batch_date", text)


# ---- checks -------------------------------------------------------------------------


def test_checks(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", None), (2, None, -1), (None, "a", 5), (None, "a", 5)], "id int, s string, n int")
    assert quality.check_not_null(df, "s").count() == 1
    assert [tuple(r) for r in quality.check_unique(df, ["id"]).collect()] == [(1, 2)]
    assert [tuple(r) for r in quality.check_accepted(df, "s", ["a"]).collect()] == [("b", 1)]
    assert quality.check_expression(df, "n > 0").count() == 2  # false and NULL
    report = quality.check_report([
        quality.Check("fine", quality.check_not_null(df.filter("id = 1"), "id")),
        quality.Check("warned", quality.check_not_null(df, "n"), "warn"),
        quality.Check("failed", quality.check_not_null(df, "s")),
    ])
    assert {r.check_name: (r.violations, r.status) for r in report.collect()} == {
        "fine": (0, "pass"), "warned": (1, "warn"), "failed": (1, "error"),
    }


def test_counting_checks_share_one_pass(spark, tmp_path):
    rows = [(1, "a"), (2, None), (None, "c"), (-4, "c")]
    path = str(tmp_path / "t")
    spark.createDataFrame(rows, "n int, s string").write.parquet(path)
    df = spark.read.parquet(path)
    report = quality.check_report([
        quality.Check("null", df, count=quality.count_nulls("s")),
        quality.Check("list", df, count=quality.count_not_accepted("s", ["a"])),
        quality.Check("rule", df, "warn", quality.count_unmet("n > 0")),
        quality.Check("rows", quality.check_not_null(df, "n")),
    ])
    assert {r.check_name: r.violations for r in report.collect()} == {"null": 1, "list": 1, "rule": 2, "rows": 1}
    assert report._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 2


def test_unknown_capacity_breaks_inventory_uniqueness(spark):
    """Two unknown hotels on one night and room type share key 0; the check says so."""
    rows = [(0, 20240101, "Suite"), (0, 20240101, "Suite"), (5, 20240101, "Suite")]
    inventory = spark.createDataFrame(rows, "hotel_sk long, date_id int, room_type string")
    report = quality.check_report(checks.warehouse_checks({"fact_hotel_inventory": inventory}))
    found = {r.check_name: r.violations for r in report.collect()}
    assert found["unique fact_hotel_inventory(hotel_sk, date_id, room_type)"] == 1


def test_run_all_isolates_failures():
    def job(name):
        if name == "b":
            raise ValueError("x" * 500)
        return name.upper()

    results, failed = run_all("abc", job)
    assert failed == ["b"] and results["a"] == "A" and results["c"] == "C"
    assert len(results["b"]["error"]) == 500


# ---- sinks ---------------------------------------------------------------------------


def test_upsert(spark, tmp_path):
    table = str(tmp_path / "t")
    make = lambda rows: spark.createDataFrame(rows, "id int, v string, _batch_date date")
    read = lambda: sorted((r.id, r.v, r._batch_date) for r in readers.read_table(spark, table).collect())
    upsert(make([(1, "a", day(0)), (2, "b", day(0)), (3, "c", day(1)), (4, "d", day(2))]), table, ["id"])
    untouched = [f for f in readers.read_table(spark, table).inputFiles() if str(day(2)) in f]
    touched = upsert(make([(3, "C", day(3)), (1, "A", day(3)), (9, "n", day(3))]), table, ["id"])
    assert touched == [str(day(0)), str(day(1)), str(day(3))]
    want = [(1, "A", day(3)), (2, "b", day(0)), (3, "C", day(3)), (4, "d", day(2)), (9, "n", day(3))]
    assert read() == want
    assert [f for f in readers.read_table(spark, table).inputFiles() if str(day(2)) in f] == untouched
    upsert(make([(3, "C", day(3)), (1, "A", day(3)), (9, "n", day(3))]), table, ["id"])
    assert read() == want
    assert upsert(make([]), table, ["id"]) == [] and read() == want


def test_new_columns_are_appended(spark):
    old = spark.createDataFrame([(1, "a")], "id int, v string")
    new = spark.createDataFrame([(2, "b", True)], "id int, v string, flag boolean")
    assert sorted(map(tuple, merged(old, new, ["id"]).collect())) == [(1, "a", None), (2, "b", True)]


def test_days_are_replaced_one_by_one(spark, tmp_path):
    table = str(tmp_path / "t")
    df = spark.createDataFrame([(i, day(i % 3)) for i in range(30)], "id int, _batch_date date")
    batches.write_days(df, table, ["id"])
    batches.write_day(df.filter("id = 1"), table, str(day(1)))
    batches.write_day(df.filter("id < 0"), table, str(day(2)))
    got = readers.read_table(spark, table).groupBy("_batch_date").count().collect()
    assert {r[0]: r[1] for r in got} == {day(0): 10, day(1): 1}
    assert readers.read_day(spark, table, str(day(2))).count() == 0
    with pytest.raises(FileNotFoundError):
        readers.read_day(spark, table, str(day(7)))


def test_publish(spark, tmp_path):
    table = str(tmp_path / "s")
    df = spark.createDataFrame([(1, None, "x"), (2, "b", "y")], "id int, s string, more string")
    assert sink.publish_staging(df, ["s", "id"], {"s": ""}, table, "2024-01-01") == 2
    assert sink.publish_staging(df, ["s", "id"], {"s": ""}, table, "2024-01-01") == 2
    got = readers.read_day(spark, table, "2024-01-01")
    assert got.columns == ["s", "id", "_batch_date"] and sorted(r.s for r in got.collect()) == ["", "b"]
    with pytest.raises(sink.ReconciliationError):
        sink.reconcile(spark, table, "2024-01-01", 3)
    with pytest.raises(quality.ContractError):
        sink.publish_staging(df, ["zz"], {}, table, "2024-01-01")


def test_row_ids_differ_between_copies(spark, tmp_path):
    table = str(tmp_path / "t")
    batches.write_day(spark.createDataFrame([("same",)] * 20, "v string"), table, "2024-01-01")
    ids = readers.read_day(spark, table, "2024-01-01", row_id=True).select("_row_id")
    assert ids.distinct().count() == 20


# ---- sources and frames -----------------------------------------------------------------


def test_csv_with_other_header_lands_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    (tmp_path / "b.csv").write_text("b,a\n1,2\n")
    found = readers.read_csv_raw(spark, f"{tmp_path}/*.csv").select("a", "b").collect()
    assert sorted(map(tuple, found)) == [("1", "2"), ("2", "1")]


def test_all_records_malformed(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<rs>\n<r><a>1 & <</a></r>\n<r><a>& 2</a></r>\n</rs>")
    spec = readers.SourceSpec("r", (("xml", "r", False),), ("a",))
    ok, bad = frames.split_corrupt(readers.read_source(spark, spec, str(tmp_path)))
    assert (ok.count(), bad.select("a", fv.CORRUPT).count()) == (0, 2)


def test_seed_types(spark, tmp_path):
    (tmp_path / "fx.csv").write_text("currency,units_per_usd,valid_from\nUSD,1.5,2020-01-01\n")
    row = seeds.read_seed(spark, str(tmp_path / "fx.csv"), seeds.FX_SCHEMA).first()
    assert tuple(row) == ("USD", D("1.500000"), dt.date(2020, 1, 1))
    (tmp_path / "bad.csv").write_text("currency,units_per_usd,valid_from\nUSD,one,2020-01-01\n")
    with pytest.raises(Exception):
        seeds.read_seed(spark, str(tmp_path / "bad.csv"), seeds.FX_SCHEMA).collect()


def test_fixed_tables(spark):
    assert seeds.fx_rates(spark).count() == 9
    assert seeds.dim_channels(spark).count() == 4 and seeds.dim_geography(spark).count() == 15
    dates = seeds.dim_dates(spark)
    assert dates.count() == 1096
    bounds = dates.agg(F.min("date_id"), F.max("date_id"), F.count_if("is_holiday")).first()
    assert tuple(bounds) == (20240101, 20261231, 0)
    row = dates.filter("date_id = 20241230").first()
    assert (row.week_of_year, row.day_of_week, row.day_name, row.month_name, row.season) == (1, 1, "Monday", "December", "high_season")


def test_unknown_layer():
    with pytest.raises(ValueError):
        readers.layer_path("/x", "gold", "bookings")


def test_nights(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 2, 28), 3), (2, dt.date(2024, 1, 1), 0)], "id int, d date, n int")
    got = frames.explode_nights(df, "d", F.col("n"), "night").select("id", "night").collect()
    assert sorted(map(tuple, got)) == [
        (1, dt.date(2024, 2, 28)), (1, dt.date(2024, 2, 29)), (1, dt.date(2024, 3, 1)), (2, dt.date(2024, 1, 1)),
    ]


def test_sum_of_nothing_is_null(spark):
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    row = df.agg(
        agg.sum_if(F.col("n"), F.col("s") == "z"), agg.any_true(F.col("s") == "z"),
        agg.pct(F.count("n"), F.count_if(F.col("s") == "z")),
        agg.first_non_null(F.lit(None).cast("string"), F.col("n")),
    ).first()
    assert tuple(row) == (None, False, None, None)


def asof_rows(spark, left, right):
    left = spark.createDataFrame(left, "k string, t int")
    right = spark.createDataFrame(right, "k string, ts int, v int")
    return [tuple(r) for r in joins.asof_join(left, right, ["k"], "t", "ts", {"v": "out"}).collect()]


def test_asof_with_broadcast_off_and_duplicates(spark):
    left = [("a", 5), ("a", 1), ("b", 9), (None, 3)]
    right = [("a", 2, 1), ("a", 2, 7), ("a", 4, 3), ("a", 4, 2)]
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    try:
        got = []
        for limit in (before, "-1", "10MB"):
            spark.conf.set(key, limit)
            got += [asof_rows(spark, left, right), asof_rows(spark, left, right[::-1])]
    finally:
        spark.conf.set(key, before)
    want = sorted([("a", 5, 3), ("a", 1, None), ("b", 9, None), (None, 3, None)], key=str)
    assert all(sorted(g, key=str) == want for g in got)


def test_unique_counts_combinations_with_null(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 3)], "a int, b int")
    assert [r.n_rows for r in quality.check_unique(df, ["a", "b"]).collect()] == [2]
    assert quality.check_unique(df, ["b"]).count() == 0


def test_audit_keeps_long_texts(spark, tmp_path):
    from lakestay.sinks.audit import append_audit

    started = dt.datetime(2026, 1, 1)
    append_audit(spark, str(tmp_path / "a"), "r", "2026-01-01", "s", started, error="x" * 20_000)
    assert len(spark.read.parquet(str(tmp_path / "a")).first().error_message) == 20_000
