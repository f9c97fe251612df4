"""Landing files to bronze: all text, contract checked, malformed rows set aside."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.storagelevel import StorageLevel

from lakestay import fixed_values as fv
from lakestay.operators.frames import split_corrupt, stringify
from lakestay.operators.quality import check_contract
from lakestay.sinks.batches import write_day, write_rejected
from lakestay.sources.readers import (
    SourceSpec,
    day_path,
    layer_path,
    read_rejected,
    read_source,
    with_provenance,
)

log = logging.getLogger(__name__)

SCAN_COLUMNS = (fv.CORRUPT, "_source_format", "_source_file")
REJECTED_COLUMNS = (fv.CORRUPT, "_source_file", "_source_format", "_ingested_at", fv.BATCH_DATE)


def bronze_rows(
    spark: SparkSession, spec: SourceSpec, folder: str, date: str, run_id: str
) -> DataFrame:
    """All records of one source and day as text, malformed ones marked. New columns
    are kept."""
    raw = read_source(spark, spec, folder)
    drift = check_contract([c for c in raw.columns if c not in SCAN_COLUMNS], spec.required)
    if drift:
        log.warning("%s: columns outside the contract kept: %s", spec.name, drift)
    return with_provenance(stringify(raw, keep=SCAN_COLUMNS), date, run_id)


def bronze_ingest(
    spark: SparkSession, spec: SourceSpec, root: str, date: str, run_id: str
) -> dict[str, int]:
    """Write bronze and rejected rows of one source and day; a rerun replaces both.

    The files are parsed once for both halves, which also gives both the same
    ingest time. Blocks lost with an executor are parsed again.
    """
    folder = day_path(layer_path(root, "raw", spec.name), date)
    rows = bronze_rows(spark, spec, folder, date, run_id).persist(StorageLevel.DISK_ONLY)
    try:
        ok, bad = split_corrupt(rows)
        bad = bad.select(*REJECTED_COLUMNS)
        bronze = write_day(ok, layer_path(root, "bronze", spec.name), date)
        rejected = write_rejected(bad, layer_path(root, "rejected", spec.name), date)
    finally:
        rows.unpersist()
    return {
        "bronze_rows": spark.read.parquet(bronze).count(),
        "rejected_rows": read_rejected(spark, rejected, bad.schema).count(),
    }
