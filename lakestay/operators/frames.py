"""Whole-frame helpers: filters, unions, defaults, generators, run metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from lakestay import fixed_values as fv


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(well-formed, corrupt) rows of a raw scan.

    Spark refuses a scan of raw files for the corrupt column alone, hence the
    always true length test, which keeps one data column in the scan.
    """
    data = next(c for c in df.columns if not c.startswith("_"))
    scanned = F.length(F.col(data).cast("string"))
    keep = scanned.isNull() | (scanned >= 0)
    corrupt = F.col(fv.CORRUPT).isNotNull()
    return df.filter(~corrupt & keep).drop(fv.CORRUPT), df.filter(corrupt & keep)


def filter_nonempty(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key) != "")


def filter_as_of(df: DataFrame, date: str, col: str = fv.BATCH_DATE) -> DataFrame:
    return df.filter(F.col(col) <= F.lit(date).cast("date"))


def current_members(dim: DataFrame, sk: str) -> DataFrame:
    return dim.filter(F.col("is_current") & (F.col(sk) != 0))


def stringify(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Every column as text, nested ones as JSON."""
    def text(field):
        if field.name in keep:
            return F.col(field.name)
        if isinstance(field.dataType, (StructType, ArrayType, MapType)):
            return F.to_json(field.name).alias(field.name)
        return F.col(field.name).cast("string").alias(field.name)

    return df.select(*[text(f) for f in df.schema.fields])


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Defaults for NULLs; an empty mapping leaves the frame as it is."""
    return df.fillna(dict(defaults)) if defaults else df


def union_frames(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def add_unknown_member(dim: DataFrame, member: Mapping[str, object]) -> DataFrame:
    """The dimension plus one literal row, cast to the dimension's types."""
    one = dim.sparkSession.range(0, 1, 1, 1).select(
        *[
            F.array().cast(f.dataType).alias(f.name)
            if member[f.name] == []
            else F.lit(member[f.name]).cast(f.dataType).alias(f.name)
            for f in dim.schema.fields
        ]
    )
    return dim.unionByName(one)


def explode_nights(df: DataFrame, start: str, nights: Column, out: str) -> DataFrame:
    """One row per night, at least one per input row."""
    last = F.date_add(F.col(start), F.greatest(nights, F.lit(1)).cast("int") - 1)
    return df.withColumn(out, F.explode(F.sequence(F.col(start), last)))


def run_metrics(df: DataFrame, name: str, exprs: Sequence[Column]) -> tuple[DataFrame, Observation]:
    """Metrics gathered while the frame is written, without another pass.

    Put it right before the write: there each row is counted exactly once even
    when executors are lost, while a metric before a shuffle may count the rows
    of a repeated task twice.
    """
    seen = Observation(name)
    return df.observe(seen, *exprs), seen
