"""Keeping hot keys out of single tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key with more rows than this is worked on in salted parts.
HOT_ROWS = 1_000_000
# No more keys than this count as hot: of a very large frame only those with a larger share.
MOST_HOT = 100_000


def split_hot(
    df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS
) -> tuple[DataFrame, DataFrame | None]:
    """Split a frame into rows of ordinary keys and rows of hot keys.

    A frame with no more rows than a hot key stays whole, with None as the second
    part: no key of it can be hot. Rows are counted, so that neither compression
    nor estimates decide.

    The counts of keys are combined map-side and read only the key columns. A hot
    key has more than hot_rows rows and more than rows / MOST_HOT, so that the
    broadcast list never holds more than MOST_HOT keys. Without hot keys the
    second frame is dropped at run time, before it is computed.
    """
    rows = df.count()
    if rows <= hot_rows:
        return df, None
    least = max(hot_rows, rows // MOST_HOT)
    names = [f"_hot_{i}" for i in range(len(keys))]
    hot = (
        df.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)])
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > least)
        .select(*names)
    )
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)]
    hot = F.broadcast(hot)
    return df.join(hot, same, "left_anti"), df.join(hot, same, "left_semi")


def salt(df: DataFrame, spread: Sequence[str]) -> Column:
    """A part number from columns that differ between the rows of one key."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return F.pmod(F.xxhash64(*[F.col(c) for c in spread]), F.lit(parts)).cast("int")


def spread_nulls(key: Column, *by: Column) -> Column:
    """A text join key whose NULLs go to many partitions and still match nothing.

    The marker starts with a control character, which no cleaned key does.
    """
    return F.coalesce(key, F.concat(F.lit("\u0001"), F.xxhash64(*by).cast("string")))
