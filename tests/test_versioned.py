"""Tables changed by key: equal to deleting and inserting, before, during and after compaction."""

import os
import random

import pytest
from pyspark.sql import functions as F

from lakestay.sinks import versioned as ve
from lakestay.sources.readers import read_table

SCHEMA = "id long, part string, v long, _batch_date string"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema).withColumn("_batch_date", F.col("_batch_date").cast("date"))


def content(df, cols=("id", "part", "v", "_batch_date")):
    return sorted((tuple(map(str, r)) for r in df.select(*cols).collect()))


def files(path):
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if not f.endswith(".crc")}


def some_rows(r, n, keys):
    return [(r.randrange(keys), r.choice("ab"), r.randrange(100), f"2026-01-{r.randrange(1, 8):02d}") for _ in range(n)]


def applied(state, new, gone=()):
    """Delete and insert by (id, part) on plain rows; NULL keys match nothing."""
    keys = {(x[0], x[1]) for x in new} | set(gone)
    return [x for x in state if x[0] is None or x[1] is None or (x[0], x[1]) not in keys] + list(new)


def texts(rows):
    return sorted(tuple(map(str, x)) for x in rows)


def test_random_changes(spark, tmp_path):
    r = random.Random(4)
    state = list({x[:2]: x for x in some_rows(r, 40, 30)}.values()) + [(None, "a", 1, "2026-01-01")]
    table = ve.VersionedTable.create(frame(spark, state), f"{tmp_path}/t", ["id", "part"])
    for step in range(7):
        if step % 3 == 2:
            gone = [(r.randrange(30), r.choice("ab")) for _ in range(8)]
            table.delete(spark.createDataFrame(gone, "id long, part string"))
            state = applied(state, [], gone)
        else:
            # Several rows of one key in one change all count.
            new = some_rows(r, 12, 30) + [(None, "b", step, "2026-01-03"), (step, None, step, "2026-01-04")]
            table.upsert(frame(spark, new))
            state = applied(state, new)
        assert content(ve.VersionedTable.open(spark, f"{tmp_path}/t").read()) == texts(state)
        day = read_table(spark, f"{tmp_path}/t").filter("_batch_date = DATE '2026-01-03'")
        assert content(day) == texts(x for x in state if x[3] == "2026-01-03")
        if step in (3, 6):
            table.compact()
            assert content(table.read()) == texts(state) and not table._versions()
    assert table.compact() == []


def test_a_change_writes_its_own_size(spark, tmp_path):
    """One key in each of 300 days: no file of the days is written or read."""
    path = f"{tmp_path}/t"
    rows = spark.range(300 * 40).selectExpr(
        "id", "sha2(cast(id as string), 512) as text", "date_add(DATE '2025-01-01', cast(id % 300 as int)) as _batch_date"
    )
    table = ve.VersionedTable.create(rows, path, ["id"])
    before = files(path)
    table.upsert(rows.filter("id < 300").withColumn("text", F.lit("x")).coalesce(1))
    after = files(path)
    added = {f: s for f, s in after.items() if f not in before}
    assert {f: s for f, s in after.items() if f in before} == before
    assert all("/_changes/version=000001/" in f for f in added)
    assert sum(added.values()) < 20_000 < sum(before.values()) / 50
    assert table.read().filter("text = 'x'").count() == 300 and table.read().count() == 12_000
    plan = table.read().filter("_batch_date = DATE '2025-01-05'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_batch_date" in plan


def test_a_failed_compaction_changes_nothing(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    rows = [(i, "a", i, f"2026-01-{1 + i % 5:02d}") for i in range(25)]
    table = ve.VersionedTable.create(frame(spark, rows), path, ["id"])
    new = [(i, "b", -i, f"2026-01-{1 + (i + 1) % 5:02d}") for i in range(0, 25, 4)]
    table.upsert(frame(spark, new))
    table.delete(spark.createDataFrame([(i,) for i in range(1, 25, 5)], "id long"))  # all of day 2
    want = texts([x for x in rows if x[0] % 4 and x[0] % 5 != 1] + [x for x in new if x[0] % 5 != 1])
    assert content(table.read()) == want
    real, calls = ve.VersionedTable._publish, []
    for fail_at in range(1, 5):
        def publish(self, day, filled):
            calls.append(day)
            if len(calls) == fail_at:
                raise OSError("store is down")
            real(self, day, filled)

        calls.clear()
        monkeypatch.setattr(ve.VersionedTable, "_publish", publish)
        with pytest.raises(OSError, match="store is down"):
            table.compact()
        assert content(ve.VersionedTable.open(spark, path).read()) == want
        assert not [f for f in os.listdir(path) if f.startswith("_staged")]
    monkeypatch.setattr(ve.VersionedTable, "_publish", real)
    # Also when only some of the changes could be deleted.
    drop = ve._Store.drop

    def drop_first(self, name):
        if name.endswith("version=000002"):
            raise OSError("store is down")
        drop(self, name)

    monkeypatch.setattr(ve._Store, "drop", drop_first)
    with pytest.raises(OSError, match="store is down"):
        table.compact()
    assert content(table.read()) == want and len(table._versions()) == 1
    monkeypatch.setattr(ve._Store, "drop", drop)
    table.compact()
    assert content(table.read()) == want and not table._versions()
    assert not [f for f in table._day_folders() if "2026-01-02" in f] or [x for x in want if x[3] == "2026-01-02"]


def test_changes_during_a_compaction_stay(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    table = ve.VersionedTable.create(frame(spark, [(i, "a", 0, "2026-01-01") for i in range(6)]), path, ["id"])
    table.upsert(frame(spark, [(1, "b", 1, "2026-01-02")]))
    real = ve.VersionedTable._publish

    def publish(self, day, filled):
        if day.endswith("02"):
            ve.VersionedTable.open(spark, path).upsert(frame(spark, [(1, "c", 2, "2026-01-01"), (5, "c", 2, "2026-01-03")]))
        real(self, day, filled)

    monkeypatch.setattr(ve.VersionedTable, "_publish", publish)
    table.compact()
    assert content(table.read()) == texts([(i, "a", 0, "2026-01-01") for i in (0, 2, 3, 4)] + [(1, "c", 2, "2026-01-01"), (5, "c", 2, "2026-01-03")])
    assert len(table._versions()) == 1


def test_columns_come_and_go(spark, tmp_path):
    path = f"{tmp_path}/t"
    table = ve.VersionedTable.create(frame(spark, [(1, "a", 1, "2026-01-01"), (2, "a", 1, "2026-01-01")]), path, ["id"])
    table.upsert(frame(spark, [(2, 7, "2026-01-01")], "id long, extra long, _batch_date string"))
    table = ve.VersionedTable.open(spark, path)
    cols = ("id", "part", "v", "extra")
    want = [("1", "a", "1", "None"), ("2", "None", "None", "7")]
    assert content(table.read(), cols) == want
    table.compact()
    assert content(ve.VersionedTable.open(spark, path).read(), cols) == want
    with pytest.raises(TypeError, match="extra"):
        table.upsert(frame(spark, [(2, "x", "2026-01-01")], "id long, extra string, _batch_date string"))
    assert content(table.read(), cols) == want


def test_many_changes_compact_themselves(spark, tmp_path):
    path = f"{tmp_path}/t"
    table = ve.VersionedTable.create(frame(spark, [(1, "a", 1, "2026-01-01")]), path, ["id"])
    for i in range(4):
        table.upsert(frame(spark, [(1, "a", i, "2026-01-02")]), most_changes=2)
    assert len(table._versions()) == 1 and content(table.read()) == texts([(1, "a", 3, "2026-01-02")])
    # The day it left is empty, and no more than two folders of a day are kept.
    assert {f.split("/")[0] for f in table._day_folders()} == {"_batch_date=2026-01-02"}
    bad = frame(spark, [(1, "a", 1, "2026-01-01")]).withColumn("v", F.raise_error(F.lit("bad row")).cast("bigint"))
    with pytest.raises(Exception, match="bad row"):
        table.upsert(bad)
    assert not [f for f in os.listdir(path) if f.startswith("_staged")]
    assert content(table.read()) == texts([(1, "a", 3, "2026-01-02")])
    with pytest.raises(FileExistsError):
        ve.VersionedTable.create(frame(spark, []), path, ["id"])


def test_an_empty_table(spark, tmp_path):
    table = ve.VersionedTable.create(frame(spark, []), f"{tmp_path}/t", ["id"])
    assert table.read().count() == 0 and table.compact() == []
    table.upsert(frame(spark, [(1, "a", 1, "2026-01-01")]))
    assert table.read().count() == 1
    table.delete(frame(spark, [(1, "a", 1, "2026-01-01")]))
    assert table.compact() == [] and table.read().count() == 0
    with pytest.raises(FileNotFoundError):
        ve.VersionedTable.open(spark, f"{tmp_path}/none")
