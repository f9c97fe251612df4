"""Token ids of a corpus in files of compressed blocks, in the order of document ids.

The files are Parquet files, so that any store Spark writes to can hold them and a lost
task leaves no half file. A row is a frame: whole consecutive documents with about as many
ids as a block, longer if one document is longer. Its `frame` column is

    magic, documents, blocks, bytes of the index, crc32 of the index,
    index (deflated): for each document whether it has an id, its id, its number of ids,
    blocks of ids (see range_coder), each with its own model and checksum.

The other columns order the frames: part, and the ids of the part before the frame.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakestay.llm.batches import prepare, slices
from lakestay.llm.range_coder import BLOCK_IDS, decode_block, encode_block
from lakestay.llm.tokens import BYTE_VOCABULARY, encoder

END_ID = 2
MAGIC = b"LSTF"
_HEAD = struct.Struct("<4sQIII")
_FRAMES = "part int, ids_before bigint, n_docs bigint, n_ids bigint, frame binary"
_FRAME_SCHEMA = pa.schema([
    ("part", pa.int32()), ("ids_before", pa.int64()), ("n_docs", pa.int64()),
    ("n_ids", pa.int64()), ("frame", pa.binary()),
])
_DOCS = "doc_id bigint, start bigint, n_tokens bigint, ids binary"
_DOC_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()),
])


def encode_frame(docs: list[int | None], lengths: np.ndarray, ids: np.ndarray, vocabulary: int) -> bytes:
    known = np.array([d is not None for d in docs], np.uint8)
    numbers = np.array([d or 0 for d in docs], "<i8")
    index = zlib.compress(known.tobytes() + numbers.tobytes() + lengths.astype("<i8").tobytes())
    blocks = [encode_block(ids[a : a + BLOCK_IDS], vocabulary) for a in range(0, len(ids), BLOCK_IDS)]
    head = _HEAD.pack(MAGIC, len(docs), len(blocks), len(index), zlib.crc32(index))
    return b"".join([head, index, *blocks])


def decode_frame(frame: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Documents, their lengths and all their ids; raises ValueError on any damage."""
    magic, docs, blocks, size, crc = _HEAD.unpack_from(frame)
    index = frame[_HEAD.size : _HEAD.size + size]
    if magic != MAGIC or zlib.crc32(index) != crc:
        raise ValueError("not a frame of token ids, or a damaged one")
    index = zlib.decompress(index)
    known = np.frombuffer(index, np.uint8, docs)
    numbers = np.frombuffer(index, "<i8", docs, docs).tolist()
    lengths = np.frombuffer(index, "<i8", docs, 9 * docs)
    at, parts = _HEAD.size + size, []
    for _ in range(blocks):
        ids, at = decode_block(frame, at)
        parts.append(ids)
    ids = np.concatenate(parts) if parts else np.empty(0, np.uint32)
    return [d if k else None for d, k in zip(numbers, known)], lengths, ids


def write_token_files(
    docs: DataFrame,
    path: str,
    vocabulary: str = BYTE_VOCABULARY,
    end_id: int = END_ID,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> None:
    """Encode every text, append end_id, and write the files in ascending order of ids.

    Rows are dealt to tasks by ranges of the id; texts move once, ids never. Null ids come
    first; a null text is empty and has the end id alone. Rows of one id keep an order by
    their other short columns, then their text, and may be dealt to several tasks by those
    columns. An empty table writes no frames.
    """
    spark = prepare(docs.sparkSession)
    others = [c for c in docs.columns if c not in (id_column, text_column)]
    tie = F.xxhash64(*[docs[c].cast("string") for c in others]) if others else F.lit(0).cast("bigint")
    own = docs.select(
        docs[id_column].cast("bigint").alias("doc_id"), tie.alias("tie"), docs[text_column].alias("text")
    )
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_docs = own.repartitionByRange(tasks, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    end = np.array([end_id], np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(vocabulary)
        size = max(tokens.size, end_id + 1)
        part, before = TaskContext.get().partitionId(), 0
        numbers: list[int | None] = []
        held: list[np.ndarray] = []
        held_lengths: list[int] = []
        count = 0

        def flush():
            frame = encode_frame(numbers, np.array(held_lengths), np.concatenate(held), size)
            columns = [[part], [before], [len(numbers)], [count], [frame]]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, _FRAME_SCHEMA.types)], schema=_FRAME_SCHEMA
            )

        for batch in slices(batches, "text"):
            ids, first = tokens.encode(batch.column("text"))
            for doc, a, b in zip(batch.column("doc_id").to_pylist(), first.tolist(), first[1:].tolist()):
                if count and count + b - a + 1 > BLOCK_IDS:
                    yield flush()
                    before += count
                    numbers, held, held_lengths, count = [], [], [], 0
                numbers.append(doc)
                held += [ids[a:b], end]
                held_lengths.append(b - a + 1)
                count += b - a + 1
        if numbers:
            yield flush()

    sorted_docs.select("doc_id", "text").mapInArrow(run, _FRAMES).write.mode("overwrite").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens and its ids.

    ids are bytes, little-endian unsigned 32-bit. Frames are decoded one by one in any order;
    where a part begins follows from the number of ids of the parts before it, one row each.
    """
    frames = prepare(spark).read.schema(_FRAMES).parquet(path)
    parts = frames.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    # At most one row for each task that wrote the files.
    placed = frames.join(F.broadcast(parts), "part").select(
        (F.col("part_start") + F.col("ids_before")).alias("start"), "frame"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, frame in zip(batch.column("start").to_pylist(), batch.column("frame")):
                docs, lengths, ids = decode_frame(frame.as_py())
                ends = np.cumsum(lengths)
                raw = ids.astype("<u4").tobytes()
                pieces = [raw[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), lengths.tolist())]
                columns = [docs, start + ends - lengths, lengths, pieces]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, _DOC_SCHEMA.types)], schema=_DOC_SCHEMA
                )

    return placed.mapInArrow(run, _DOCS)
