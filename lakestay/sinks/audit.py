"""Audit rows of the daily steps and an inventory of the lake."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestay import fixed_values as fv

# Folders whose files are counted at the same time.
LISTED_AT_ONCE = 16

AUDIT_SCHEMA = (
    "run_id string, execution_date date, step_name string, status string, "
    "rows_processed long, started_at timestamp, finished_at timestamp, "
    "error_message string, details string, _created_at timestamp"
)


def audit_columns(
    run_id: Column,
    execution_date: Column,
    step: Column,
    ok: Column,
    rows: Column,
    started_at: Column,
    finished_at: Column,
    error: Column,
    details: Column,
) -> list[Column]:
    """The columns of an audit row; details is a struct or map, kept as JSON."""
    return [
        run_id.alias("run_id"),
        execution_date.cast("date").alias("execution_date"),
        step.alias("step_name"),
        F.when(ok, "SUCCESS").otherwise("FAILED").alias("status"),
        F.coalesce(rows, F.lit(0)).cast("long").alias("rows_processed"),
        started_at.cast("timestamp").alias("started_at"),
        finished_at.cast("timestamp").alias("finished_at"),
        F.coalesce(error, F.lit("")).alias("error_message"),
        F.to_json(details).alias("details"),
        F.current_timestamp().alias("_created_at"),
    ]


def append_audit(
    spark: SparkSession,
    table: str,
    run_id: str,
    date: str,
    step: str,
    started_at: dt.datetime,
    rows: int = 0,
    error: str = "",
    details: Mapping[str, object] | None = None,
) -> None:
    """Append one row for a finished step; a step with an error counts as failed."""
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    row = (
        run_id,
        dt.date.fromisoformat(date),
        step,
        "FAILED" if error else "SUCCESS",
        int(rows),
        started_at,
        now,
        error,
        json.dumps(details or {}, default=str),
        now,
    )
    spark.createDataFrame([row], AUDIT_SCHEMA).coalesce(1).write.mode("append").parquet(table)


def lake_inventory(
    spark: SparkSession, root: str, date: str | None = None, layer: str | None = None
) -> DataFrame:
    """(layer, n_files, n_bytes) of every layer and of other, 0 where there is nothing.

    All files count, also those without bytes and marker files, as the file system knows
    them; none is opened. Its own recursive counts are asked for, a call for each dataset,
    or for each folder of the date, many at once, so the driver sees sums only. With a
    layer only that layer is counted, with a date only files below a folder of that day.
    """
    base = root.rstrip("/")
    Path = spark._jvm.org.apache.hadoop.fs.Path
    store = Path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    day = f"{fv.BATCH_DATE}={date}"
    globs = [f"{day}*", f"*/{day}*", f"*/*/{day}*"] if date else ["*", "*/*"]
    top = f"{base}/{layer}" if layer else base
    depth = len(str(store.makeQualified(Path(base))).split("/"))

    def status(glob):
        return [(str(s.getPath()), s.isDirectory(), s.getLen()) for s in store.globStatus(Path(f"{top}/{glob}")) or []]

    found = [s for glob in globs for s in status(glob)]
    if not date:  # what stands two levels down is counted there, or stands for itself above
        parents = {path.rsplit("/", 1)[0] for path, _, _ in found}
        found = [s for s in found if s[0] not in parents]

    def count(entry):
        path, folder, size = entry
        first = path.split("/")[depth]
        name = first if first in fv.LAYERS else "other"
        if not folder:
            return name, 1, size
        held = store.getContentSummary(Path(path))
        return name, held.getFileCount(), held.getLength()

    with ThreadPoolExecutor(LISTED_AT_ONCE) as pool:
        counts = list(pool.map(count, found))
    names = [layer if layer in fv.LAYERS else "other"] if layer else [*fv.LAYERS, "other"]
    rows = [
        (name, sum(n for own, n, _ in counts if own == name), sum(b for own, _, b in counts if own == name))
        for name in names
    ]
    return spark.createDataFrame(rows, "layer string, n_files long, n_bytes long")
