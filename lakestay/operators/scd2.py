"""Slowly changing dimensions with closed validity ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestay import fixed_values as fv
from lakestay.functions.keys import surrogate_key
from lakestay.operators.versions import change_points, open_end, with_next


def scd2(
    snapshots: DataFrame,
    key: str,
    tracked: Sequence[str],
    sk: str,
    date_col: str = fv.BATCH_DATE,
) -> DataFrame:
    """Versions from daily snapshots, one row per key and day expected.

    A version starts on the day its tracked columns first differ from the
    snapshot before and ends the day before the next version. A key that
    vanishes from the snapshots stays current. All windows share one shuffle
    by key; a group is no larger than the number of snapshot days.
    """
    starts = change_points(snapshots, [key], date_col, tracked)
    starts = starts.withColumnRenamed(date_col, "valid_from")
    ranged = with_next(starts, [key], "valid_from", "_next_from")
    return ranged.select(
        surrogate_key(key, "valid_from").alias(sk),
        key,
        *tracked,
        "valid_from",
        F.coalesce(F.date_sub("_next_from", 1), open_end()).alias("valid_to"),
        F.col("_next_from").isNull().alias("is_current"),
    )
