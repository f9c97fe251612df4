"""Order, layout and joins that leave no task alone with all rows."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from lakestay.operators import joins
from lakestay.operators.order import with_position
from lakestay.sinks.layout import read_by_month, write_by_month


def test_positions_of_a_total_order(spark):
    r = random.Random(1)
    rows = [(r.randrange(50), r.choice([None, "a", "b"]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "a int, b string, c int").repartition(7)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = with_position(df, [F.desc("a"), F.asc_nulls_first("b"), F.asc("c")])
        files = got.inputFiles()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(files) > 2
    want = sorted(rows, key=lambda x: (-x[0], x[1] is not None, x[1] or "", x[2]))
    assert [tuple(x)[:3] for x in sorted(got.collect(), key=lambda x: x["position"])] == want
    assert sorted(x["position"] for x in got.collect()) == list(range(1, 3001))
    assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString().split("Window")[0]
    assert with_position(df.limit(0), [F.asc("c")]).count() == 0
    ties = with_position(spark.range(10).selectExpr("1 as x"), [F.asc("x")])
    assert sorted(x["position"] for x in ties.collect()) == list(range(1, 11))


def test_month_folders_and_disjoint_files(spark, tmp_path):
    table = f"{tmp_path}/t"
    rows = spark.range(40_000).selectExpr(
        "id", "cast(hash(id) % 10000 as int) as k", "date_add(DATE '2026-01-15', cast(id % 60 as int)) as day"
    )
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        write_by_month(rows, table, "day", ["k", "id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    months = sorted(d for d in os.listdir(table) if d.startswith("_month="))
    assert months == ["_month=2026-01", "_month=2026-02", "_month=2026-03"]
    for month in months:
        files = spark.read.parquet(f"{table}/{month}").groupBy(F.col("_metadata.file_path")).agg(F.min("k"), F.max("k"))
        ranges = sorted(tuple(x)[1:] for x in files.collect())
        assert len(ranges) >= 2
        assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    # A filter on the key reads few files: of the others the statistics rule out all row groups.
    low = read_by_month(spark, table, "day").filter("k = 17")
    opened = low.select(F.col("_metadata.file_path").alias("f")).distinct().count()
    assert 0 < opened <= len(months) < len(read_by_month(spark, table, "day").inputFiles()) / 2
    assert "PushedFilters: [IsNotNull(k), EqualTo(k,17)]" in low._jdf.queryExecution().executedPlan().toString()
    some = read_by_month(spark, table, "day", "2026-02-10", "2026-02-12")
    assert "PartitionFilters: [isnotnull(_month" in some._jdf.queryExecution().executedPlan().toString()
    assert some.count() == rows.filter("day between DATE '2026-02-10' and DATE '2026-02-12'").count() > 0
    # Another frame replaces its months only.
    write_by_month(rows.filter("day < DATE '2026-02-01'").limit(5), table, "day", ["k"])
    left = read_by_month(spark, table, "day")
    assert left.count() == 5 + rows.filter("day >= DATE '2026-02-01'").count()


def test_one_key_at_one_moment_is_spread(spark):
    """500 left rows of one moment with parts of 20: all right, and in many partitions."""
    r = random.Random(3)
    at = lambda s: dt.datetime(2026, 1, 1) + dt.timedelta(seconds=s)
    left = [(i, "k", at(1000)) for i in range(500)]
    left += [(500 + i, r.choice(["k", "q", None]), r.choice([None, at(r.randrange(2000))])) for i in range(300)]
    for rights in ([at(100), at(1000)], [at(100), at(990)], [at(2500)], [at(x) for x in r.sample(range(2000), 60)]):
        right = [("k", x, j) for j, x in enumerate(rights)] + [("q", at(5), 99), (None, at(1), 98)]
        ldf = spark.createDataFrame(left, "id int, key string, ts timestamp").repartition(3)
        rdf = spark.createDataFrame(right, "key string, rts timestamp, v int")
        got = joins.asof_join_sliced(ldf, rdf, ["key"], "ts", "rts", {"v": "v"}, slice_seconds=60, hot_rows=20)
        want = {}
        for i, key, ts in left:
            known = [(x, v) for k, x, v in right if key is not None and ts is not None and k == key and x <= ts]
            want[i] = max(known)[1] if known else None
        assert {x["id"]: x["v"] for x in got.collect()} == want and got.count() == len(left)
    rows = ldf.select(
        "key", F.col("ts").alias("_ts"), F.lit(1).alias("_side"), F.struct("id").alias("_row"),
        F.lit(None).cast("struct<ts:timestamp,v:int>").alias("_value"),
    ).filter("id < 500")
    coalesce = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = joins._next_to_in_slices(rows, ["key"], False, 60, 20)
        placed = spread.select("_row", "_before", F.spark_partition_id().alias("p")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    sizes = [sum(x["p"] == p for x in placed) for p in {x["p"] for x in placed}]
    assert sum(sizes) == 500 and len(sizes) == 4 and max(sizes) < 250
