"""Latest versions, duplicates, change points and successors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from lakestay import fixed_values as fv
from lakestay.operators.skew import HOT_ROWS, salt, split_hot


def newest_first(version: str, tie: Sequence[str]) -> list[Column]:
    return [F.col(version).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in tie]]


def _other_columns(df: DataFrame, used: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in used]


def latest_version(
    df: DataFrame, key: Sequence[str], version: str, tie: Sequence[str] | None = None
) -> DataFrame:
    """The newest row of each key; tie defaults to all other columns."""
    tie = _other_columns(df, [*key, version]) if tie is None else tie
    return first_per_key(df, key, newest_first(version, tie))


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in a total order.

    Spark cuts every key to one row per task before the shuffle (a partial
    window group limit), so the rows of a hot key never meet in one task.
    """
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def mark_duplicates(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[Column],
    spread: Sequence[str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add _is_dup: false for the first row of each key, true for all others.

    Ordinary keys take one shuffle. The rows of hot keys are ranked in salted
    parts first; only the winners of the parts are ranked per key. spread
    names columns that differ between the rows of one key, best a row id,
    which differs even between exact copies.
    """
    cold, hot = split_hot(df, key, hot_rows)

    by_key = Window.partitionBy(*key).orderBy(*order)
    cold = cold.withColumn("_is_dup", F.row_number().over(by_key) > 1)
    if hot is None:
        return cold

    by_part = Window.partitionBy(*key, "_part").orderBy(*order)
    # Losers of a part stay spread over their part; winners meet in part -1.
    final = Window.partitionBy(*key, "_final").orderBy(*order)
    hot = (
        hot.withColumn("_part", salt(df, spread))
        .withColumn("_first", F.row_number().over(by_part))
        .withColumn("_final", F.when(F.col("_first") > 1, F.col("_part")).otherwise(-1))
        .withColumn("_is_dup", (F.col("_first") > 1) | (F.row_number().over(final) > 1))
        .drop("_part", "_first", "_final")
    )
    return cold.unionByName(hot)


def dedup(
    df: DataFrame,
    key: Sequence[str],
    version: str,
    tie: Sequence[str] | None = None,
    spread: Sequence[str] | None = None,
    hot_rows: int = HOT_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """(kept, losers): the newest row per key and every other row."""
    tie = _other_columns(df, [*key, version]) if tie is None else list(tie)
    order = newest_first(version, tie)
    marked = mark_duplicates(df, key, order, spread or [version, *tie], hot_rows)
    return first_per_key(df, key, order), marked.filter("_is_dup").drop("_is_dup")


def change_points(df: DataFrame, key: Sequence[str], order: str, tracked: Sequence[str]) -> DataFrame:
    """First row per key and every row whose tracked columns differ from the row before.

    Meant for one row per key and day, which bounds a group by the number of
    days however many events the key had. NULL equals NULL.
    """
    steps = Window.partitionBy(*key).orderBy(order)
    now = F.struct(*[F.col(c) for c in tracked])
    changed = ~now.eqNullSafe(F.lag(now).over(steps))
    return df.withColumn("_changed", changed).filter("_changed").drop("_changed")


def with_next(
    df: DataFrame,
    key: Sequence[str],
    col: str,
    out: str,
    default: Column | None = None,
) -> DataFrame:
    """Add the next value of col within the key, default after the last.

    As for change_points, one row per key and day is expected.
    """
    following = F.lead(col).over(Window.partitionBy(*key).orderBy(col))
    return df.withColumn(out, following if default is None else F.coalesce(following, default))


def open_end(kind: str | DataType = "date") -> Column:
    return F.lit(fv.MAX_DATE).cast(kind)
