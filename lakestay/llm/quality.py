"""Document quality learned from preferences between pairs (Bradley-Terry).

A document has a strength, linear in features of its whole text; the chance that one
document is preferred to another is the logistic function of the difference of strengths.
Weights minimise the logistic loss over pairs of a document labelled good and one labelled
bad. The threshold is the quantile of strengths at the share of bad documents, and the
score maps it to THRESHOLD.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestay.llm.batches import keep_rows, prepare, slices
from lakestay.llm.words import Words, shingles, words
from lakestay.operators.order import with_position
from lakestay.session import work_folders

THRESHOLD = 0.3
# At least; more where more documents are labelled.
PAIRS = 50_000
PAIRS_A_ROW = 1 << 11
_POINT = float(1 << 30)

# Kinds of bytes that are counted, each divided by the number of words.
_KINDS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "line": b"\n",
    "stop": b".,;:",
    "quote": b"\"'()-",
    "bang": b"!?",
    "bar": b"|",
    "symbol": b"#$%&*+/<=>@[\\]^_`{}~",
    "control": bytes([*range(9), *range(11, 32), 127]),
    "wide": bytes(range(0xC0, 0x100)),
}
_KIND_OF = np.zeros(256, np.uint8)
for _i, _own in enumerate(_KINDS.values()):
    _KIND_OF[list(_own)] = _i + 1
FEATURES = (
    *_KINDS, "log_words", "word_bytes", "distinct", "top_word", "same_again", "repeated_runs",
    "capital_words", "stopped_words", "symbol_words", "empty",
)


def _repetition(found: Words) -> np.ndarray:
    """Per row: share of distinct words, of the commonest word, and of 5-word runs seen before."""
    out = np.zeros((len(found.first) - 1, 3))
    runs, begin = shingles(found, 5)
    for r, (a, b) in enumerate(zip(found.first.tolist(), found.first[1:].tolist())):
        if a == b:
            continue
        own = np.sort(found.hashes[a:b])
        at = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1], [True]]))
        run = np.sort(runs[begin[r] : begin[r + 1]])
        again = np.count_nonzero(run[1:] == run[:-1]) / len(run)
        out[r] = (len(at) - 1) / (b - a), np.diff(at).max() / (b - a), again
    return out


def features(texts: pa.Array) -> np.ndarray:
    """A row of FEATURES for each text; a null or empty text has 1 for empty and 0 else."""
    found = words(texts)
    rows = len(found.offsets) - 1
    kind = _KIND_OF[found.data]
    row = np.repeat(np.arange(rows), np.diff(found.offsets))
    width = len(_KINDS) + 1
    counts = np.bincount(row * width + kind, minlength=rows * width).reshape(rows, width)[:, 1:]
    n = np.diff(found.first)
    per_word = 1.0 / np.maximum(n, 1)
    of = np.repeat(np.arange(rows), n)

    def share(flags):
        return np.bincount(of[flags], minlength=rows) * per_word

    capital = np.concatenate([[0], np.cumsum(kind == 1)])
    small = np.concatenate([[0], np.cumsum((found.data >= 97) & (found.data <= 122))])
    shouted = (capital[found.ends] - capital[found.starts] > 1) & (small[found.ends] == small[found.starts])
    last = kind[found.ends - 1]
    again = np.zeros(len(of), bool)
    again[1:] = (found.hashes[1:] == found.hashes[:-1]) & (of[1:] == of[:-1])
    size = np.bincount(of, weights=found.ends - found.starts, minlength=rows) * per_word
    order = list(_KINDS)
    return np.column_stack([
        np.minimum(counts * per_word[:, None], 5.0), np.log1p(n), np.minimum(size, 50.0),
        _repetition(found), share(again)[:, None],
        share(shouted), share(last == order.index("stop") + 1), share(last == order.index("symbol") + 1),
        n == 0,
    ])[:, _ORDER]


# _repetition gives its three columns before same_again.
_ORDER = [*range(len(_KINDS) + 2), *(len(_KINDS) + 2 + k for k in (0, 1, 3, 2)), *range(len(_KINDS) + 6, len(FEATURES))]


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; a strength at the threshold scores THRESHOLD. Without pairs: 0.5."""
        if not len(self.weights):
            return np.full(len(x), 0.5)
        over = strengths(x, self) - self.threshold + np.log(THRESHOLD / (1 - THRESHOLD))
        return 1.0 / (1.0 + np.exp(-np.clip(over, -500, 500)))


UNLEARNED = Model(np.empty(0), np.empty(0), np.empty(0), 0.0)


def _standard(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((x - mean) / scale, -8, 8)


def strengths(x: np.ndarray, model: Model) -> np.ndarray:
    """A row's strength does not depend on the rows beside it, to the last bit."""
    z = np.ascontiguousarray(_standard(x, model.mean, model.scale))
    return (z * model.weights).sum(1)


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))


def _moments(rows: DataFrame) -> tuple[int, int, np.ndarray, np.ndarray]:
    """Rows labelled bad and good, and mean and deviation of each feature.

    Sums are of decimals, so they don't depend on how the rows are dealt to tasks.
    """
    own = [F.col("x")[i] for i in range(len(FEATURES))]

    def sums(columns, *more):
        return rows.agg(*more, *[F.sum(c.cast("decimal(28,16)")) for c in columns]).first()

    bad, good, *total = sums(own, F.count_if(F.col("label") == 0), F.count_if(F.col("label") == 1))
    if not bad or not good:
        return bad, good, np.empty(0), np.empty(0)
    mean = np.array([float(t) for t in total]) / (bad + good)
    far = [c - F.lit(m) for c, m in zip(own, mean.tolist())]
    spread = np.array([float(t) for t in sums([d * d for d in far])]) / (bad + good)
    return bad, good, mean, np.maximum(np.sqrt(spread), 1e-9)


def _pairs(rows: DataFrame, bad: int, good: int, pairs: int, mean: np.ndarray, scale: np.ndarray) -> DataFrame:
    """Differences of standardised features, good less bad, of numbered pairs: a row for
    each PAIRS_A_ROW pairs.

    Either kind stands in the order of the hashes of its ids and is gone through as often as
    the pairs need. Every document is in a pair, and none in two more than another of its
    kind; each turn of the bad ones begins one further, so that pairs don't come again.
    """
    placed = with_position(rows, [F.col("label"), F.xxhash64("doc_id"), F.col("doc_id"), F.xxhash64("x")])
    place = F.col("position") - 1
    worse = placed.filter("label = 0").select(place.alias("b"), F.col("x").alias("worse"))
    better = placed.filter("label = 1").select((place - bad).alias("g"), F.col("x").alias("better"))
    numbers = rows.sparkSession.range(pairs).select(
        F.col("id").alias("pair"), F.expr(f"id div {PAIRS_A_ROW}").alias("part"),
        (F.col("id") % good).alias("g"), F.expr(f"(id + id div {bad}) % {bad}").alias("b"),
    )
    schema = pa.schema([("part", pa.int64()), ("d", pa.list_(pa.float64()))])

    def run(found: pa.Table) -> pa.Table:
        found = found.sort_by("pair")
        d = _standard(_matrix(found.column("better")), mean, scale) - _standard(_matrix(found.column("worse")), mean, scale)
        return pa.table([found.column("part")[:1], pa.array([d.ravel()], schema.field("d").type)], schema=schema)

    found = numbers.join(better, "g").join(worse, "b").select("part", "pair", "better", "worse")
    return found.groupBy("part").applyInArrow(run, "part bigint, d array<double>")


def _slopes(pairs: DataFrame, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums over all pairs of the loss's first and second derivatives.

    The sums of a row of pairs are rounded to a fixed point, so their sum is exact in any order.
    """
    schema = pa.schema([("sums", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(w) + len(w) ** 2, np.int64)
        for batch in batches:
            for row in batch.column("d"):
                d = row.values.to_numpy(zero_copy_only=False).reshape(-1, len(w))
                p = 1.0 / (1.0 + np.exp(np.clip((d * w).sum(1), -500, 500)))
                curve = (d * (p * (1 - p))[:, None]).T @ d
                total += np.rint(np.concatenate([-d.T @ p, curve.ravel()]) * _POINT).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([total], schema.field("sums").type)], schema=schema)

    found = pairs.select("d").mapInArrow(run, "sums array<bigint>").collect()
    total = np.array([float(sum(column)) for column in zip(*[r.sums for r in found])]) / _POINT
    return total[: len(w)], total[len(w) :].reshape(len(w), len(w))


def fit(rows: DataFrame, pairs: int = PAIRS, penalty: float = 1e-4) -> Model:
    """A model from stored rows of doc_id, label and features x, by Newton's method on the
    pairwise logistic loss.

    There are at least as many pairs as documents of the commoner kind, so that all have a
    part in the model; its threshold is a quantile of the strengths of all. Tasks hold and
    the driver gets sums alone. Without documents of both kinds there is nothing to prefer:
    UNLEARNED, which scores all alike.
    """
    bad, good, mean, scale = _moments(rows)
    if not bad or not good:
        return UNLEARNED
    pairs = max(pairs, bad, good)
    w = np.zeros(len(FEATURES))
    with work_folders(rows.sparkSession, "pairs") as (folder,):
        _pairs(rows, bad, good, pairs, mean, scale).write.parquet(folder)
        differences = rows.sparkSession.read.parquet(folder)
        for _ in range(25):
            gradient, curve = _slopes(differences, w)
            step = np.linalg.solve(curve / pairs + penalty * np.eye(len(w)), gradient / pairs + penalty * w)
            w = w - step
            if np.abs(step).max() < 1e-6:
                break
    model = Model(mean, scale, w, 0.0)
    schema = pa.schema([("doc_id", pa.int64()), ("strength", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = strengths(_matrix(batch.column("x")), model)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(own)], schema=schema)

    own = rows.select("doc_id", "x").mapInArrow(run, "doc_id bigint, strength double")
    placed = with_position(own, [F.col("strength"), F.xxhash64("doc_id")])
    around = placed.filter(F.col("position").isin(bad, bad + 1)).select("strength").collect()
    return model._replace(threshold=sum(r.strength for r in around) / 2)


def held_out(id_column: Column) -> Column:
    """True for ids whose labels are never learned; a null id is not held out."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
) -> Model:
    """Fit on all documents with a label 1 (good) or 0, ids held out left aside.

    Features are taken where the texts lie and only they are moved to their labels. Null ids
    and labels are not learned from.
    """
    spark = prepare(docs.sparkSession)
    usable = labels.select(
        labels[id_column].cast("bigint").alias("doc_id"), labels[label_column].cast("int").alias("label")
    ).filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    own = docs.select(docs[id_column].cast("bigint").alias("doc_id"), docs[text_column].alias("text"))
    own = own.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    schema = pa.schema([("doc_id", pa.int64()), ("x", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            x = pa.array(list(features(part.column("text"))), schema.field("x").type)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), x], schema=schema)

    found = own.mapInArrow(run, "doc_id bigint, x array<double>")
    with work_folders(spark, "learned") as (folder,):
        found.join(usable.hint("merge"), "doc_id").write.parquet(folder)
        return fit(spark.read.parquet(folder))


def score(
    docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, held_out and score of every row, from its whole text alone; no shuffle.

    Null texts score as empty ones. Other columns are neither read nor kept.
    """
    prepare(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            scores = model.score(features(part.column("text")))
            columns = [part.column("doc_id"), part.column("held_out"), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    doc_id = docs[id_column].cast("bigint")
    own = docs.select(doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"), docs[text_column].alias("text"))
    return own.mapInArrow(run, "doc_id bigint, held_out boolean, score double")


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_column: str = "text") -> DataFrame:
    """The rows that score at least threshold, with all their columns."""
    return keep_rows(docs, text_column, lambda part: model.score(features(part.column(text_column))) >= threshold)
