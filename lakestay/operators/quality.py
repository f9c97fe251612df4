"""Data-quality rules, splits, circuit breaker and checks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestay import fixed_values as fv
from lakestay.operators.frames import union_frames
from lakestay.operators.joins import missing_refs
from lakestay.operators.skew import HOT_ROWS
from lakestay.operators.versions import (
    first_per_key,
    mark_duplicates,
    newest_first,
    with_next,
)

Rule = tuple[str, str]


class ContractError(ValueError):
    """A source does not deliver a column it has to."""


class BreakerTripped(RuntimeError):
    """Too large a share of rows fails the rules."""


def check_contract(columns: Sequence[str], required: Sequence[str]) -> list[str]:
    """Fail on a missing column; return the columns nobody asked for."""
    missing = [c for c in required if c not in columns]
    if missing:
        raise ContractError(f"missing columns: {', '.join(missing)}")
    return [c for c in columns if c not in required]


def dq_reason(rules: Sequence[Rule]) -> Column:
    """Codes of the rules a row fails, joined by ';', empty when it passes all.

    A condition that is NULL counts as passed.
    """
    return F.concat_ws(";", *[F.when(F.expr(bad), F.lit(code)) for code, bad in rules])


def with_reason(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.withColumn(fv.DQ_REASON, dq_reason(rules))


def _passed_first(version: str, tie: Sequence[str]) -> list[Column]:
    """Rows passing all rules come first, so that they are ranked among themselves."""
    return [(F.col(fv.DQ_REASON) != "").asc(), *newest_first(version, tie)]


def split_dq(
    df: DataFrame,
    rules: Sequence[Rule],
    key: Sequence[str],
    version: str,
    tie: Sequence[str],
    spread: Sequence[str] | None = None,
    hot_rows: int = HOT_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine): rows passing all rules, newest per key, and all the rest
    with the reason.

    The filter on the reason stands behind the ranking: in front of it, Spark
    would parse every row twice, once to judge it and once to pass it on.
    """
    judged = with_reason(df, rules)
    newest = first_per_key(judged, key, _passed_first(version, tie))
    valid = newest.filter(F.col(fv.DQ_REASON) == "").drop(fv.DQ_REASON)
    marked = mark_dq(df, rules, key, version, tie, spread, hot_rows)
    return valid, marked.filter(F.col(fv.DQ_REASON) != "")


def mark_dq(
    df: DataFrame,
    rules: Sequence[Rule],
    key: Sequence[str],
    version: str,
    tie: Sequence[str],
    spread: Sequence[str] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """All rows with their reason, duplicates included, '' for the rows to keep.

    The same split as split_dq in one frame, for jobs that write both halves.
    """
    order = _passed_first(version, tie)
    marked = mark_duplicates(with_reason(df, rules), key, order, spread or [version, *tie], hot_rows)
    reason = F.col(fv.DQ_REASON)
    duplicate = (reason == "") & F.col("_is_dup")
    return marked.withColumn(
        fv.DQ_REASON, F.when(duplicate, F.lit(fv.DUPLICATE_KEY)).otherwise(reason)
    ).drop("_is_dup")


def dq_summary(judged: DataFrame) -> DataFrame:
    """Rows per joined reason, failing rows only."""
    return (
        judged.filter(F.col(fv.DQ_REASON) != "")
        .groupBy(fv.DQ_REASON)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def check_breaker(invalid: int, total: int, max_ratio: float = fv.MAX_REJECT_RATIO) -> float:
    """The share of invalid rows; fails when it is above the limit."""
    ratio = invalid / total if total else 0.0
    if ratio > max_ratio:
        raise BreakerTripped(f"{invalid} of {total} rows invalid, limit {max_ratio:.0%}")
    return ratio


# Each check returns its violations; no rows means it passed.


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def check_unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Values or combinations that occur more than once. A NULL alone does not count; in a
    combination it is a value like others."""
    counted = df.dropna(subset=list(cols)) if len(cols) == 1 else df
    return (
        counted.groupBy(*cols)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter("n_rows > 1")
    )


def check_relationship(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    return missing_refs(child, col, parent, parent_col)


def check_accepted(df: DataFrame, col: str, values: Sequence[object]) -> DataFrame:
    """Distinct values outside the list with their row counts; NULL is accepted."""
    return (
        df.filter(~F.col(col).isin(*values))
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def check_expression(df: DataFrame, expression: str) -> DataFrame:
    """Rows where the expression is false or NULL."""
    return df.filter(~F.coalesce(F.expr(expression), F.lit(False)))


def check_scd2(dim: DataFrame, key: str) -> DataFrame:
    """Keys without exactly one current version, and versions that overlap, leave a gap
    or end before they start: (key, issue)."""
    current = (
        dim.groupBy(key)
        .agg(F.count_if(F.col("is_current")).alias("_n"))
        .filter("_n <> 1")
        .select(key, F.lit("current_versions != 1").alias("issue"))
    )
    bad = (F.col("valid_from") > F.col("valid_to")) | (
        F.col("_next_from") != F.date_add("valid_to", 1)
    )
    ranges = (
        with_next(dim, [key], "valid_from", "_next_from")
        .filter(bad)
        .select(key, F.lit("gap_or_overlap").alias("issue"))
    )
    return current.unionByName(ranges)


@dataclass(frozen=True)
class Check:
    """A named check: a frame of violations, or of all rows with an aggregate that counts
    violations; severity is "error" or "warn"."""

    name: str
    frame: DataFrame
    severity: str = "error"
    count: Column | None = None


def count_nulls(col: str) -> Column:
    return F.count_if(F.col(col).isNull())


def count_not_accepted(col: str, values: Sequence[object]) -> Column:
    """Distinct values outside the list; NULL is accepted."""
    return F.count_distinct(F.when(~F.col(col).isin(*values), F.col(col)))


def count_unmet(expression: str) -> Column:
    """Rows where the expression is false or NULL."""
    return F.count_if(~F.coalesce(F.expr(expression), F.lit(False)))


def check_report(checks: Sequence[Check]) -> DataFrame:
    """One row per check: name, severity, violations and status.

    All checks that are aggregates over one frame share one pass over it.
    """
    passes: dict[int, list[Check]] = {}
    for i, check in enumerate(checks):
        passes.setdefault(i if check.count is None else -id(check.frame), []).append(check)
    rows = []
    for group in passes.values():
        counts = [F.count(F.lit(1)) if c.count is None else c.count for c in group]
        counted = group[0].frame.agg(*[c.alias(f"_{i}") for i, c in enumerate(counts)])
        lines = [
            F.struct(
                F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"),
                F.col(f"_{i}").alias("violations"),
            )
            for i, c in enumerate(group)
        ]
        rows.append(counted.select(F.inline(F.array(*lines))))
    status = F.when(F.col("violations") == 0, "pass").otherwise(F.col("severity"))
    return union_frames(rows).withColumn("status", status)
