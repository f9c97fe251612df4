"""One day's snapshot merged into existing versions of a dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestay import fixed_values as fv
from lakestay.operators.scd2 import scd2


def touched_keys(
    versions: DataFrame, snapshot: DataFrame, date: str, key: str, tracked: Sequence[str]
) -> DataFrame:
    """(key, _new) of the keys whose versions one day's snapshot changes, _new NULL where
    the day has no row of the key any more.

    A row that says what the version of its day says changes nothing. A key without a row
    matters only if a version starts on the day.
    """
    day = F.lit(date).cast("date")
    at = versions.filter((F.col("valid_from") <= day) & (F.col("valid_to") >= day)).select(
        F.col(key).alias("_key"), F.struct(*tracked).alias("_old"), (F.col("valid_from") == day).alias("_starts")
    )
    now = snapshot.select(key, F.struct(*tracked).alias("_new"))
    found = now.join(at, F.col(key) == F.col("_key"), "full")
    moved = F.when(F.col("_new").isNull(), F.col("_starts")).otherwise(~F.col("_new").eqNullSafe(F.col("_old")))
    return found.filter(moved).select(F.coalesce(F.col(key), F.col("_key")).alias(key), "_new")


def splice(
    versions: DataFrame,
    touched: DataFrame,
    later: DataFrame | None,
    date: str,
    key: str,
    tracked: Sequence[str],
    sk: str,
    date_col: str = fv.BATCH_DATE,
) -> DataFrame:
    """All versions of the touched keys with the day's snapshot in place.

    Equal to building the versions from all snapshots, in whatever order the days come and
    however often one is repeated. Every version starts with a snapshot, so the starts of
    the old versions are all that is needed of the past and of the future, but for one
    thing: where the day falls into a version, the first snapshot after it, if still of that
    version, begins it anew. later holds (key, date_col) of the snapshots after the day, None
    when it is the last one; only those of the touched keys are used.
    """
    day = F.lit(date).cast("date")
    mine = versions.join(touched.select(key), key, "left_semi")
    points = mine.filter(F.col("valid_from") != day).select(
        key, F.col("valid_from").alias(date_col), *tracked
    ).unionByName(
        touched.filter(F.col("_new").isNotNull()).select(key, day.alias(date_col), *[F.col("_new")[c].alias(c) for c in tracked])
    )
    if later is not None:
        following = later.join(touched.select(key), key, "left_semi").filter(F.col(date_col) > day)
        following = following.groupBy(F.col(key).alias("_key")).agg(F.min(date_col).alias("_next"))
        again = mine.join(following, F.col(key) == F.col("_key")).filter(
            (F.col("valid_from") <= day) & (F.col("valid_to") >= F.col("_next"))
        )
        points = points.unionByName(again.select(key, F.col("_next").alias(date_col), *tracked))
    return scd2(points, key, tracked, sk, date_col)
