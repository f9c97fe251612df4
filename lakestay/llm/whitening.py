"""Whitening of vectors by shifted CholeskyQR.

The centred rows A are orthogonalised by rounds over all rows: a round sums the Gram matrix
of Q = A R^-1 over all tasks, takes its Cholesky factor and multiplies it into R. The first
Gram matrix gets a shift on its diagonal, so that the factor exists however close to
dependent the dimensions are, and so does a later one that has no factor; each round brings
Q nearer to orthonormal columns. Then A = Q R, and the singular values and right singular
vectors of the small R are those of A: the components, with eigenvalues s^2 / n.

The driver sees matrices of dimension x dimension, one per round, never rows. Sums of all
tasks are added up by a tree of tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestay.llm.batches import prepare

COMPONENTS = 32
SCALE, BASE = 64, 1_000_000
# Beyond this an entry times SCALE is no exact whole number, and its row takes no part.
LARGEST = 2.0**52
# Sums one task adds up.
FAN_IN = 64
MOST_ROUNDS = 8
# How far from orthonormal columns may be: a dimension, and where rounds no longer help.
CLOSE, NEAR = 1e-13, 1e-7
# Bytes of vectors worked on at once in a task.
WIDE_BYTES = 1 << 21
# Rows whose rounding errors add up before sums are added pairwise, for the shift.
RUN_ROWS = 1 << 20
# A component whose deviation is less than this part of the first one's is rounding only.
LEAST_PART = 2.0**-36
_LOW = 26


class Fit(NamedTuple):
    n: int
    sums: list[int]  # per dimension, exact
    vectors: np.ndarray  # dimension x component, unit columns
    eigenvalues: np.ndarray  # falling
    trace: float
    rounds: int


def _wide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about WIDE_BYTES; short ones cost more than they hold."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= WIDE_BYTES:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def _rows(batch: pa.RecordBatch, vector: str, dimension: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Which rows take part, and their whole numbers floor(SCALE * c), as int64."""
    column = batch.column(vector)
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().cast(pa.float64())
    values = pc.fill_null(flat, np.nan).to_numpy(zero_copy_only=False) * SCALE
    row = np.repeat(np.arange(len(size)), size)
    good = size > 0 if dimension is None else size == dimension
    good[row[~(np.abs(values) < LARGEST)]] = False  # also of what is not a number
    kept = np.floor(values[good[row]]).astype(np.int64)
    return good, kept.reshape(-1, dimension) if dimension is not None else kept


def dimension_of(df: DataFrame, vector: str) -> int | None:
    """The length most vectors that take part have, the larger of equals; None without any."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for batch in _wide(batches):
            good, _ = _rows(batch, vector)
            size = pc.fill_null(pc.list_value_length(batch.column(vector)), 0).to_numpy(zero_copy_only=False)
            for length, count in zip(*np.unique(size[good], return_counts=True)):
                seen[int(length)] = seen.get(int(length), 0) + int(count)
        yield pa.RecordBatch.from_pydict(
            {"length": pa.array(list(seen), pa.int64()), "n": pa.array(list(seen.values()), pa.int64())}
        )

    found = df.select(vector).mapInArrow(run, "length long, n long").groupBy("length").agg(F.sum("n").alias("n"))
    best = found.orderBy(F.desc("n"), F.desc("length")).first()
    return None if best is None else best["length"]


def _summed(df: DataFrame, vector: str, part: Callable[[pa.RecordBatch], np.ndarray], kind: str) -> np.ndarray | None:
    """The sum over all batches of an array each gives; None without batches.

    A task sums its batches, further tasks the sums of FAN_IN tasks each, until one is left.
    """
    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in _wide(batches):
            own = part(batch)
            total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_pydict({"sum": pa.array([total.astype(kind).tobytes()], pa.binary())})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for raw in batch.column("sum"):
                own = np.frombuffer(raw.as_py(), kind)
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_pydict({"sum": pa.array([total.tobytes()], pa.binary())})

    tasks = df.rdd.getNumPartitions()
    sums = df.select(vector).mapInArrow(collect, "sum binary")
    while tasks > 1:
        tasks = -(-tasks // FAN_IN)
        sums = sums.repartition(tasks).mapInArrow(merge, "sum binary")
    rows = sums.collect()  # one
    return sum(np.frombuffer(r["sum"], kind) for r in rows) if rows else None


def _centred(whole: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """Whole numbers less their means: the whole part of the mean goes exactly."""
    below = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return (whole - below).astype(float) - rest


def _deviations(whole: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Exact sums of squares of n * x - S for each row."""
    if not len(whole):
        return []
    reach = max(int(np.abs(whole).max()) * n + abs(s) for s in sums)
    if reach * reach * len(sums) < 1 << 63:
        apart = whole * n - np.array(sums, np.int64)
        return (apart * apart).sum(1).tolist()
    apart = whole.astype(object) * n - np.array(sums, object)
    return (apart * apart).sum(1).tolist()


def fit(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Fit | None:
    """Means, components and eigenvalues of all vectors; None where no vector takes part.

    Vectors that are null, empty, of another length than most, or hold null, non-finite or
    huge (LARGEST) entries take no part. Components without deviation beyond rounding, as
    of constant or repeated dimensions, are left out, so there may be fewer than asked for,
    none for equal rows.
    """
    prepare(df.sparkSession)
    d = dimension_of(df, vector)
    if d is None:
        return None

    def totals(batch):
        _, whole = _rows(batch, vector, d)
        low = whole & ((1 << _LOW) - 1)
        return np.concatenate([[len(whole)], (whole >> _LOW).sum(0), low.sum(0)])

    got = [int(x) for x in _summed(df, vector, totals, "<i8")]
    n, sums = got[0], [(h << _LOW) + l for h, l in zip(got[1 : d + 1], got[d + 1 :])]

    def gram(factor):
        def part(batch):
            rows = _centred(_rows(batch, vector, d)[1], n, sums)
            if factor is not None:
                rows = np.linalg.solve(factor.T, rows.T).T
            return (rows.T @ rows).ravel()

        return _summed(df, vector, part, "<f8").reshape(d, d)

    r, rounds, trace, apart = None, 0, 0.0, np.inf
    while rounds < MOST_ROUNDS:
        g = gram(r)
        g = (g + g.T) / 2
        if r is None:
            trace = float(np.trace(g)) / n
            if trace == 0:
                return Fit(n, sums, np.zeros((d, 0)), np.zeros(0), 0.0, 1)
        else:
            last, apart = apart, _from_orthonormal(r, g)
            # Dependent dimensions leave rounding errors that no further round mends.
            if apart <= CLOSE * d or apart <= NEAR and apart > last / 2:
                break
        rounds += 1
        shift = 11 * (min(n, RUN_ROWS) * d + d * (d + 1)) * np.finfo(float).eps * float(np.trace(g))
        try:
            if r is None:
                raise np.linalg.LinAlgError
            step = np.linalg.cholesky(g).T
        except np.linalg.LinAlgError:
            step = np.linalg.cholesky(g + shift * np.eye(d)).T
        r = step if r is None else step @ r
    _, s, vt = np.linalg.svd(r)
    real = min(components, int((s > s[0] * LEAST_PART).sum()))
    return Fit(n, sums, vt[:real].T.copy(), s[:real] ** 2 / n, trace, rounds)


def _from_orthonormal(r: np.ndarray, g: np.ndarray) -> float:
    """How far the columns of Q are from orthonormal, along the components that are kept."""
    u, s, _ = np.linalg.svd(r)
    u = u[:, s > s[0] * LEAST_PART]
    return float(np.abs(u.T @ g @ u - np.eye(u.shape[1])).max())


def identity_error(df: DataFrame, model: Fit, vector: str = "embedding") -> float:
    """The largest entry of the whitened rows' covariance less the identity, over all rows."""
    d, k = len(model.sums), len(model.eigenvalues)
    if k == 0:
        return 0.0
    project = model.vectors / np.sqrt(model.eigenvalues)

    def part(batch):
        white = _centred(_rows(batch, vector, d)[1], model.n, model.sums) @ project
        return np.concatenate([white.sum(0), (white.T @ white).ravel()])

    total = _summed(df, vector, part, "<f8") / model.n
    mean, square = total[:k], total[k:].reshape(k, k)
    return float(np.abs(square - np.outer(mean, mean) - np.eye(k)).max())


def whiten(
    df: DataFrame, model: Fit | None, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(key, deviation, whitened) for each row that takes part, whitened with an entry per component.

    deviation is the exact sum over dimensions of (n * x - S)^2, x being the whole number
    floor(64 * c) + 1000000 of an entry c and S the sum of a dimension: the squared distance
    from the mean times n^2. Rows are taken as they are, repeated keys and null keys too.
    """
    prepare(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, deviation decimal(38,0), whitened array<double>"
    rows = df.select(key, vector)
    if model is None:
        return rows.select(key).limit(0).selectExpr(
            f"`{key}`", "cast(null as decimal(38,0)) as deviation", "cast(null as array<double>) as whitened"
        )
    d = len(model.sums)
    project = model.vectors / np.sqrt(model.eigenvalues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _wide(batches):
            good, whole = _rows(batch, vector, d)
            white = _centred(whole, model.n, model.sums) @ project
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(white) + 1) * white.shape[1], pa.int32()), pa.array(white.ravel())
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(key).filter(pa.array(good)),
                    pa.array(map(_decimal, _deviations(whole, model.n, model.sums)), pa.decimal128(38, 0)),
                    lists,
                ],
                [key, "deviation", "whitened"],
            )

    return rows.mapInArrow(run, schema)


def _decimal(number: int):
    from decimal import Decimal

    return Decimal(number)


def whitened_components(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row for each vector that takes part and each component, numbered from 1 by falling
    eigenvalue: (key, component, n, deviation, whitened, explained, identity_error)."""
    rows = df.select(key, vector)
    model = fit(rows, vector, components)
    error = 0.0 if model is None else identity_error(rows, model, vector)
    n = 0 if model is None else model.n
    shares = [] if model is None or not model.trace else (model.eigenvalues / model.trace).tolist()
    explained = F.array(*map(F.lit, shares)) if shares else F.array().cast("array<double>")
    return whiten(rows, model, key, vector).select(
        key, "deviation", F.posexplode("whitened").alias("_place", "whitened")
    ).select(
        key, (F.col("_place") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"),
        "deviation", "whitened", F.get(explained, F.col("_place")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
