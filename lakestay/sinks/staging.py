"""Publishing silver batches to staging tables and counting them back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestay import fixed_values as fv
from lakestay.operators.frames import fill_defaults, run_metrics
from lakestay.operators.quality import check_contract
from lakestay.sinks.batches import write_day
from lakestay.sources.readers import read_day


class ReconciliationError(RuntimeError):
    """The table holds another number of rows than was written."""


def staging_rows(silver: DataFrame, contract: Sequence[str], defaults: Mapping[str, object]) -> DataFrame:
    """The agreed columns in the agreed order, with defaults filled in."""
    check_contract(silver.columns, contract)
    return fill_defaults(silver, defaults).select(*contract)


def reconcile(spark: SparkSession, table: str, date: str, expected: int) -> int:
    """Count a batch back; fail when rows are missing or too many."""
    actual = read_day(spark, table, date).count()
    if actual != expected:
        raise ReconciliationError(f"{table} {date}: {expected} rows written, {actual} found")
    return actual


def publish_staging(
    silver: DataFrame,
    contract: Sequence[str],
    defaults: Mapping[str, object],
    table: str,
    date: str,
    sort_by: Sequence[str] = (),
) -> int:
    """Replace one batch of a staging table and reconcile it; returns its rows."""
    rows = staging_rows(silver, contract, defaults)
    rows, seen = run_metrics(rows, f"publish {date}", [F.count(F.lit(1)).alias("n_rows")])
    write_day(rows, table, date, sort_by)
    return reconcile(silver.sparkSession, table, date, seen.get["n_rows"])


def reconcile_batches(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows per batch on both sides: (batch, expected, actual, ok)."""
    count = F.count(F.lit(1))
    left = expected.groupBy(fv.BATCH_DATE).agg(count.alias("expected"))
    right = actual.groupBy(fv.BATCH_DATE).agg(count.alias("actual"))
    zero = F.lit(0)
    return left.join(right, fv.BATCH_DATE, "full").select(
        fv.BATCH_DATE,
        F.coalesce("expected", zero).alias("expected"),
        F.coalesce("actual", zero).alias("actual"),
        (F.coalesce("expected", zero) == F.coalesce("actual", zero)).alias("ok"),
    )
