"""Arrow batches inside tasks: sizes, slices, columns."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from lakestay.session import configure

ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
# Rows handed to Python at once; documents are long, so a batch is kept short.
BATCH_ROWS = 100
# Bytes of text worked on at once inside a task.
SLICE_BYTES = 1 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Settings the operators rely on: those of the library and short Arrow batches."""
    configure(spark)
    rows = int(spark.conf.get(ARROW_ROWS))
    if rows <= 0 or rows > BATCH_ROWS:
        spark.conf.set(ARROW_ROWS, str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and where each row begins; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    first = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[first[0] : first[-1]], first - first[0]


def slices(batches: Iterable[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """The same rows in the same order, joined and cut to slices of about SLICE_BYTES of text.

    A row is never cut: a slice holds little text, or one row.
    """
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(batch)
        size += batch.column(text).get_total_buffer_size()
        if size >= SLICE_BYTES:
            yield from _cut(held, text)
            held, size = [], 0
    if held:
        yield from _cut(held, text)


def _cut(held: list[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    batch = held[0] if len(held) == 1 else pa.concat_batches(held)
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(size.astype(np.int64))
    at = 0
    while at < batch.num_rows:
        done = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, done + 2 * SLICE_BYTES, side="right")))
        yield batch.slice(at, end - at)
        at = end


def keep_rows(
    docs: DataFrame, text: str, decide: Callable[[pa.RecordBatch], np.ndarray]
) -> DataFrame:
    """The rows decide says True for, with all their columns; no shuffle."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            yield part.filter(pa.array(decide(part), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
