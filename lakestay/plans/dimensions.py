"""Dimensions with history."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestay import fixed_values as fv
from lakestay.operators.frames import add_unknown_member
from lakestay.operators.history import splice, touched_keys
from lakestay.operators.scd2 import scd2


def dim_hotels(stg_hotels: DataFrame) -> DataFrame:
    """Hotel versions with their facility count, plus the unknown hotel."""
    versions = scd2(stg_hotels, "hotel_id", fv.HOTEL_TRACKED, "hotel_sk")
    counted = versions.withColumn("facility_count", F.size("facilities"))
    return add_unknown_member(counted.select(*fv.UNKNOWN_HOTEL), fv.UNKNOWN_HOTEL)


def dim_customers(stg_customers: DataFrame) -> DataFrame:
    """Customer versions without personal data, plus the unknown customer."""
    versions = scd2(stg_customers, "user_id", fv.CUSTOMER_TRACKED, "customer_sk")
    return add_unknown_member(versions.select(*fv.UNKNOWN_CUSTOMER), fv.UNKNOWN_CUSTOMER)


@dataclass(frozen=True)
class History:
    """A dimension with history: its staging table, key, tracked columns and unknown member."""

    name: str
    source: str
    key: str
    sk: str
    tracked: tuple[str, ...]
    unknown: dict
    build: Callable[[DataFrame], DataFrame]

    def finished(self, versions: DataFrame) -> DataFrame:
        """Versions with the columns and the order of the dimension."""
        if "facility_count" in self.unknown:
            versions = versions.withColumn("facility_count", F.size("facilities"))
        return versions.select(*self.unknown)


HISTORIES = (
    History("dim_hotels", "hotels", "hotel_id", "hotel_sk", fv.HOTEL_TRACKED, fv.UNKNOWN_HOTEL, dim_hotels),
    History("dim_customers", "customers", "user_id", "customer_sk", fv.CUSTOMER_TRACKED, fv.UNKNOWN_CUSTOMER, dim_customers),
)


def merge_snapshot(
    history: History, dimension: DataFrame, snapshot: DataFrame, later: DataFrame | None, date: str, folder: str
) -> tuple[DataFrame, DataFrame]:
    """(touched keys, their rows) of a dimension after one day's snapshot.

    snapshot is the staging view of that day; later as for splice. The touched keys are
    written to folder, as they are used more than once.
    """
    versions = dimension.filter(F.col(history.sk) != 0)
    touched_keys(versions, snapshot, date, history.key, history.tracked).write.parquet(folder)
    touched = dimension.sparkSession.read.parquet(folder)
    rows = history.finished(splice(versions, touched, later, date, history.key, history.tracked, history.sk))
    # The unknown member shares its key with whoever really has it.
    member = dimension.filter(F.col(history.sk) == 0).join(touched.select(history.key), history.key, "left_semi")
    return touched.select(history.key), rows.unionByName(member.select(*rows.columns))
