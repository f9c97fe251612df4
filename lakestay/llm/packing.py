"""Packing of documents into sequences of bounded length with balanced attention cost."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from lakestay.llm.batches import prepare, slices
from lakestay.llm.tokens import WORD_VOCABULARY, encoder

SEQUENCE_TOKENS = 4096
END_ID = 2
# Tokens packed together: a group is about this long, or as long as its last slice of text.
GROUP_TOKENS = 1 << 20

_PIECES = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, cost double"
)
_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
    ("cost", pa.float64()),
])


def attention_cost(length, linear: float, quadratic: float):
    """Estimated cost of a piece: linear layers, and attention within the piece."""
    return linear * length + quadratic * length * length


def assign(
    lengths: list[int], capacity: int, cost: Callable[[int], float]
) -> list[tuple[int, int, int, int, int]]:
    """Places for all tokens of documents: (document, start, length, sequence, offset).

    Documents longer than a sequence give whole sequences first. The sequences are made to
    fit the tokens: as many of full capacity as there are whole ones in the sum, and one for
    each power of two in the rest, so that none has padding. Longest first, a document goes
    to the sequence of lowest cost that has room for it (ties: the first). If none has room,
    a part of it fills the roomiest one and the rest waits for its turn by length.
    """
    return _assigned(lengths, capacity, cost, True)[0]


def _assigned(
    lengths: list[int], capacity: int, cost: Callable[[int], float], last: bool
) -> tuple[list[tuple[int, int, int, int, int]], list[tuple[int, int]]]:
    """Places, and what has none: (document, start), to its end. Unless last, there are full
    sequences only, and less than one of them is left."""
    places = []
    waiting = []
    sequence = 0
    for doc, n in enumerate(lengths):
        whole = n // capacity
        for k in range(whole):
            places.append((doc, k * capacity, capacity, sequence, 0))
            sequence += 1
        if n % capacity:
            waiting.append((-(n % capacity), doc, whole * capacity))
    total = -sum(w[0] for w in waiting)
    rest = total % capacity
    sizes = [capacity] * (total // capacity)
    if last:
        sizes += [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    if not sizes:
        return places, [(doc, start) for _, doc, start in waiting]
    room = np.array(sizes, np.int64)
    used = np.zeros(len(sizes), np.int64)
    spent = np.zeros(len(sizes))
    heapq.heapify(waiting)
    while waiting:
        left, doc, start = heapq.heappop(waiting)
        n = -left
        fits = np.where(room >= n, spent, np.inf)
        to = int(np.argmin(fits))
        if room[to] < n:
            to = int(np.argmax(room))
            if room[to] == 0:
                waiting.append((left, doc, start))
                return places, [(doc, start) for _, doc, start in sorted(waiting)]
            heapq.heappush(waiting, (int(room[to]) - n, doc, start + int(room[to])))
            n = int(room[to])
        places.append((doc, start, n, sequence + to, int(used[to])))
        room[to] -= n
        used[to] += n
        spent[to] += cost(n)
    return places, []


def pack(
    docs: DataFrame,
    vocabulary: str = WORD_VOCABULARY,
    capacity: int = SEQUENCE_TOKENS,
    end_id: int = END_ID,
    linear: float = 1.0,
    quadratic: float = 1.0 / SEQUENCE_TOKENS,
    id_column: str = "doc_id",
    text_column: str = "text",
    group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """Every document's token ids in sequences of at most capacity tokens, as pieces.

    Each task packs its rows in groups as it reads them, so nothing is shuffled, memory is
    bounded by a group (or by one document), and a repeated task gives the same pieces. A
    group fills whole sequences; what is left of it, less than one, goes on into the next, so
    that only the last group of a task ends in shorter ones. A
    null or empty text has the end id alone; rows with the same id are packed each on its own,
    a null id is kept. An empty table gives no pieces; other columns are not read.

    A piece has the bytes of its ids (little-endian unsigned 32-bit), where it starts in its
    document, its sequence and its place there, and its own estimated cost.
    """
    prepare(docs.sparkSession)
    end = np.array([end_id], np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(vocabulary)
        task = TaskContext.get()
        next_sequence = task.partitionId() << 32
        # Document, its ids, and from where on they have no place yet.
        group: list[tuple[int | None, np.ndarray, int]] = []
        held = 0

        def flush(last: bool):
            nonlocal next_sequence, group
            lengths = [len(x) - start for _, x, start in group]
            places, left = _assigned(lengths, capacity, lambda n: attention_cost(n, linear, quadratic), last)
            rows = []
            for d, start, n, s, offset in places:
                doc, ids, before = group[d]
                start += before
                rows.append((
                    doc, start, n, ids[start : start + n].astype("<u4").tobytes(), len(ids), next_sequence + s,
                    offset, attention_cost(n, linear, quadratic),
                ))
            group = [(group[d][0], group[d][1], group[d][2] + start) for d, start in left]
            if not rows:
                return
            next_sequence += max(p[3] for p in places) + 1
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), _SCHEMA.types)]
            yield pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)

        for part in slices(batches, text_column):
            ids, first = tokens.encode(part.column(text_column))
            for doc, a, b in zip(part.column(id_column).to_pylist(), first.tolist(), first[1:].tolist()):
                group.append((doc, np.concatenate([ids[a:b], end]), 0))
                held += b - a + 1
            if held >= group_tokens:
                yield from flush(False)
                held = sum(len(x) - start for _, x, start in group)
        if group:
            yield from flush(True)

    own = docs.select(docs[id_column].cast("bigint").alias(id_column), docs[text_column].alias(text_column))
    return own.mapInArrow(run, _PIECES)
