"""Joins: as-of, interval, lookup, nearest in time, pre-aggregated, missing references."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestay.operators.skew import HOT_ROWS, split_hot, spread_nulls
from lakestay.session import fits_broadcast, work_folder

# Width of the time slices into which a hot key is cut.
SLICE_SECONDS = 60


def _seconds(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_ts: str,
    right_ts: str,
    cols: Mapping[str, str],
) -> DataFrame:
    """Left as-of join: per left row the right row of the same key with the greatest
    right_ts <= left_ts, or NULLs.

    Of right rows with one key and moment the greatest counts, compared by the
    columns of cols in their order, so that both forms give the same rows. cols
    maps right columns to output names. A right side within the broadcast
    threshold becomes an interval join without a shuffle of the left side; a
    larger one takes the sliced form.
    """
    small = fits_broadcast(right)
    one = right.groupBy(*on, right_ts).agg(F.max(F.struct(*cols)).alias("_one")).select(
        *on, right_ts, *[F.col("_one")[c].alias(c) for c in cols]
    )
    if small:
        return asof_join_interval(left, one, on, left_ts, right_ts, cols, small=True)
    return asof_join_sliced(left, one, on, left_ts, right_ts, cols)


def asof_join_interval(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_ts: str,
    right_ts: str,
    cols: Mapping[str, str],
    small: bool = False,
) -> DataFrame:
    """The as-of join as an equi-join with a half-open interval.

    For a small right side, or few right rows per key: the work per left row
    grows with the number of right rows of its key. small says that the right
    side was found to fit a broadcast.
    """
    following = Window.partitionBy(*on).orderBy(right_ts)
    versions = right.withColumn("_to", F.lead(right_ts).over(following)).select(
        *[F.col(k).alias(f"_on_{k}") for k in on],
        F.col(right_ts).alias("_from"),
        "_to",
        *[F.col(c).alias(f"_out_{name}") for c, name in cols.items()],
    )
    if small:
        versions = F.broadcast(versions)
    cond = [F.col(k) == F.col(f"_on_{k}") for k in on]
    cond.append(F.col(left_ts) >= F.col("_from"))
    cond.append(F.col("_to").isNull() | (F.col(left_ts) < F.col("_to")))
    return left.join(versions, cond, "left").select(
        *[F.col(c) for c in left.columns],
        *[F.col(f"_out_{name}").alias(name) for name in cols.values()],
    )


def _next_to(rows: DataFrame, group: Sequence[str], forward: bool) -> DataFrame:
    """Left rows with _before (and _after), the right values next to them in a group.

    What follows is found by going back through the reverse order, as a frame
    up to the end would be computed anew for every row. A right row stands
    before the left rows of its own moment in both directions.
    """
    so_far = (Window.unboundedPreceding, Window.currentRow)
    per_group = Window.partitionBy(*group)
    up_to = per_group.orderBy("_ts", "_side").rowsBetween(*so_far)
    found = rows.withColumn("_before", F.last("_value", ignorenulls=True).over(up_to))
    if forward:
        onward = per_group.orderBy(F.desc("_ts"), "_side").rowsBetween(*so_far)
        found = found.withColumn("_after", F.last("_value", ignorenulls=True).over(onward))
    sides = ["_before", "_after"] if forward else ["_before"]
    return found.filter("_side = 1").select("_row", *sides)


def _next_to_in_slices(
    rows: DataFrame, on: Sequence[str], forward: bool, slice_seconds: int, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """The same for hot keys, each cut into time slices shared by many tasks.

    What a slice needs from the others is one carried right value per
    direction; those come from an aggregate with one row per key and slice.
    The left rows of a slice with more than hot_rows, down to a single moment,
    are spread over parts, and each part gets the right rows of the slice and
    what is carried into it; left rows that are equal in every column stay in
    one part.
    """
    unmatchable = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in [*on, "_ts"]])
    in_time = F.floor(_seconds(F.col("_ts")) / F.lit(slice_seconds))
    # A left row that cannot match may go to any slice.
    rows = rows.withColumn("_slice", F.when(unmatchable, F.xxhash64("_row")).otherwise(in_time))

    right_ts = F.when(F.col("_side") == 0, F.col("_ts"))
    slices = rows.groupBy(*on, "_slice").agg(
        F.max_by("_value", right_ts).alias("_last"),
        F.min_by("_value", right_ts).alias("_first"),
        F.max("_side").alias("_has_left"),
        F.sum("_side").alias("_n_left"),
    )
    others = (Window.unboundedPreceding, -1)
    per_key = Window.partitionBy(*on)
    earlier = per_key.orderBy("_slice").rowsBetween(*others)
    carried = [F.last("_last", ignorenulls=True).over(earlier)]
    if forward:
        later = per_key.orderBy(F.desc("_slice")).rowsBetween(*others)
        carried.append(F.last("_first", ignorenulls=True).over(later))
    brought = (
        slices.withColumn("_carried", F.array(*carried))
        .filter("_has_left = 1")
        .select(*on, "_slice", F.explode("_carried").alias("_value"))
        .filter(F.col("_value").isNotNull())
        .select(
            *on,
            F.col("_value.ts").alias("_ts"),
            F.lit(0).alias("_side"),
            F.lit(None).cast(rows.schema["_row"].dataType).alias("_row"),
            "_value",
            "_slice",
        )
    )
    crowded = slices.filter(F.col("_n_left") > hot_rows).select(
        *on, "_slice", F.ceil(F.col("_n_left") / F.lit(hot_rows)).cast("int").alias("_parts")
    )
    spread = rows.unionByName(brought).join(crowded, [*on, "_slice"], "left")
    parts = F.coalesce("_parts", F.lit(1))
    own = F.array(F.pmod(F.xxhash64("_row"), parts).cast("int"))
    every = F.sequence(F.lit(0), parts - 1)
    spread = spread.withColumn("_part", F.explode(F.when(F.col("_side") == 1, own).otherwise(every)))
    return _next_to(spread.drop("_parts"), [*on, "_slice", "_part"], forward)


def _neighbours(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_ts: str,
    right_ts: str,
    payload: Sequence[str],
    forward: bool,
    slice_seconds: int,
    hot_rows: int,
) -> DataFrame:
    """Every left row (_row) with the right values before (and after) it.

    Both sides are put in one order per key, so no pairs are built and each row
    is shuffled once. Hot keys are cut into time slices.
    """
    value = F.struct(F.col(right_ts).alias("ts"), *[F.col(c) for c in payload])
    row = F.struct(*[F.col(c) for c in left.columns])
    value_type = right.select(value.alias("v")).schema["v"].dataType
    row_type = left.select(row.alias("r")).schema["r"].dataType
    rows = left.select(
        *on,
        F.col(left_ts).cast(right.schema[right_ts].dataType).alias("_ts"),
        F.lit(1).alias("_side"),
        row.alias("_row"),
        F.lit(None).cast(value_type).alias("_value"),
    )
    values = right.dropna(subset=[*on, right_ts]).select(
        *on,
        F.col(right_ts).alias("_ts"),
        F.lit(0).alias("_side"),
        F.lit(None).cast(row_type).alias("_row"),
        value.alias("_value"),
    )
    # Rows are counted, keys are counted and then both parts are worked on: made once.
    both, folder = rows.unionByName(values), work_folder(left.sparkSession, "neighbours")
    both.write.parquet(folder)
    both = left.sparkSession.read.schema(both.schema).parquet(folder)
    cold, hot = split_hot(both, on, hot_rows)
    found = _next_to(cold, on, forward)
    if hot is None:
        return found
    return found.unionByName(_next_to_in_slices(hot, on, forward, slice_seconds, hot_rows))


def asof_join_sliced(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_ts: str,
    right_ts: str,
    cols: Mapping[str, str],
    slice_seconds: int = SLICE_SECONDS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The as-of join for a large right side and for hot keys."""
    found = _neighbours(
        left, right, on, left_ts, right_ts, list(cols), False, slice_seconds, hot_rows
    )
    # A NULL timestamp sorts before every right row, a NULL key meets none.
    return found.select(
        "_row.*", *[F.col(f"_before.{c}").alias(name) for c, name in cols.items()]
    )


def nearest_match(
    rows: DataFrame,
    candidates: DataFrame,
    on: Sequence[str],
    ts: str,
    cand_ts: str,
    cand_id: str,
    group: Sequence[str],
    out: str,
    slice_seconds: int = SLICE_SECONDS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Per group of rows the candidate of the same key nearest in time, to the second;
    the smallest id wins a tie. Groups without a candidate are left out.

    Only the neighbours before and after a row can be nearest, so each row is
    compared with two candidates, not with all of its key.
    """
    seconds = candidates.select(
        *on, F.date_trunc("second", cand_ts).alias("_cand_ts"), cand_id
    ).filter(F.col(cand_id).isNotNull())
    seconds = seconds.groupBy(*on, "_cand_ts").agg(F.min(cand_id).alias("_cand_id"))
    wanted = rows.dropna(subset=[*on, ts]).select(
        *on, F.date_trunc("second", ts).alias("_row_ts"), *[c for c in group if c not in on]
    )
    found = _neighbours(
        wanted, seconds, on, "_row_ts", "_cand_ts", ["_cand_id"], True, slice_seconds, hot_rows
    )
    distance = lambda side: F.abs(
        _seconds(F.col("_row._row_ts")) - _seconds(F.col(f"{side}.ts"))
    )
    choice = lambda side: F.when(
        F.col(side).isNotNull(),
        F.struct(distance(side).alias("d"), F.col(f"{side}._cand_id").alias("id")),
    )
    return (
        found.select(
            *[F.col(f"_row.{c}").alias(c) for c in group],
            F.least(choice("_before"), choice("_after")).alias("_best"),
        )
        .filter(F.col("_best").isNotNull())
        .groupBy(*group)
        .agg(F.min("_best").alias("_best"))
        .select(*group, F.col("_best.id").alias(out))
    )


def scd2_lookup(
    fact: DataFrame,
    dim: DataFrame,
    key: tuple[str, str],
    date_col: str,
    cols: Mapping[str, str],
    defaults: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add columns of the dimension version valid on a fact's day.

    key names the (fact, dimension) key columns. Versions of a key do not
    overlap and are few (at most one per day), so this is an equi-join with a
    range on top: broadcast when the dimension is small, otherwise split by
    AQE where fact keys are hot. NULL fact keys are spread out.
    """
    defaults = defaults or {}
    fact_key, dim_key = key
    versions = dim.select(
        F.col(dim_key).alias("_dim_key"),
        F.col("valid_from").alias("_valid_from"),
        F.col("valid_to").alias("_valid_to"),
        *[F.col(c).alias(f"_out_{name}") for c, name in cols.items()],
    )
    own = F.col(fact_key)
    if dict(fact.dtypes)[fact_key] == "string":
        own = spread_nulls(own, F.struct(*[F.col(c) for c in fact.columns]))
    match = [
        own == F.col("_dim_key"),
        F.col(date_col) >= F.col("_valid_from"),
        F.col(date_col) <= F.col("_valid_to"),
    ]
    filled = [
        F.coalesce(F.col(f"_out_{name}"), defaults[name]).alias(name)
        if name in defaults
        else F.col(f"_out_{name}").alias(name)
        for name in cols.values()
    ]
    return fact.join(versions, match, "left").select(*[F.col(c) for c in fact.columns], *filled)


def fx_asof(fact: DataFrame, rates: DataFrame, currency: str, date_col: str, out: str = "fx_units_per_usd") -> DataFrame:
    """Add the currency rate in force on a day; NULL for an unknown currency."""
    return asof_join(
        fact,
        rates.withColumnRenamed("currency", currency),
        [currency],
        date_col,
        "valid_from",
        {"units_per_usd": out},
    )


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    cols: Mapping[str, str],
    defaults: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Left equi-join to a dimension unique on its key, with defaults for misses."""
    defaults = defaults or {}
    side = dim.select(
        *[F.col(d).alias(f"_on_{d}") for d in on.values()],
        *[F.col(c).alias(f"_out_{name}") for c, name in cols.items()],
    )
    match = [F.col(f) == F.col(f"_on_{d}") for f, d in on.items()]
    filled = [
        F.coalesce(F.col(f"_out_{name}"), defaults[name]).alias(name)
        if name in defaults
        else F.col(f"_out_{name}").alias(name)
        for name in cols.values()
    ]
    return fact.join(side, match, "left").select(*[F.col(c) for c in fact.columns], *filled)


def star_join(
    fact: DataFrame,
    dims: Sequence[tuple[DataFrame, Mapping[str, str], Mapping[str, str], Mapping[str, Column]]],
) -> DataFrame:
    """Several lookups in a row: (dimension, on, columns, defaults) each."""
    return reduce(lambda df, d: lookup(df, *d), dims, fact)


def orphan_flag(
    child: DataFrame,
    parent: DataFrame,
    on: tuple[str, str],
    cols: Mapping[str, str],
    defaults: Mapping[str, Column],
) -> DataFrame:
    """Lookup in a parent unique on its key, plus is_orphan for rows without one."""
    child_key, parent_key = on
    seen = parent.select("*", F.lit(True).alias("_seen"))
    found = lookup(
        child, seen, {child_key: parent_key}, {**cols, "_seen": "_seen"}, defaults
    )
    return found.withColumn("is_orphan", F.col("_seen").isNull()).drop("_seen")


def key_map(fact: DataFrame, dim: DataFrame, sk: str, nk: str) -> DataFrame:
    """Facts with the natural key of their dimension member; unknown members are left out."""
    names = dim.filter(F.col(sk) != 0).select(sk, nk)
    return fact.join(names, sk)


def preagg_join(
    base: DataFrame,
    parts: Sequence[tuple[DataFrame, str]],
    defaults: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Left joins to frames already aggregated to one row per key, so nothing fans out."""
    joined = reduce(lambda df, p: df.join(p[0], p[1], "left"), parts, base)
    for name, value in (defaults or {}).items():
        joined = joined.withColumn(name, F.coalesce(F.col(name), value))
    return joined


def missing_refs(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child rows whose non-NULL reference is not in the parent."""
    known = parent.select(F.col(parent_col).alias("_known"))
    return child.filter(F.col(col).isNotNull()).join(known, F.col(col) == F.col("_known"), "left_anti")
