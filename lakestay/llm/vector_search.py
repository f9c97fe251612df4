"""Exact search for the highest inner products by a pivot-distance index.

Vectors are lifted onto a sphere (one more component makes all of them equally long), so
that the highest inner products are the nearest neighbours. Each vector is keyed by its
nearest pivot and its distance to it; the keys of a pivot are cut into rings, and the pairs of
pivot and ring are annuli. By the triangle inequality no vector of an annulus is nearer to a
query than the query's distance to the pivot is to the ring. The same holds for every other
pivot and the range of distances the annulus has to it; the greatest of these bounds counts.
A query first searches the annuli of lowest bounds, until they hold enough vectors; its tenth
best score then rules out the annuli whose bounds cannot reach it, and the rest are searched.

Rows are stored in blocks of one annulus and queries in blocks of neighbours. Annuli of few
blocks make up a band together, those of many are cut into parts. Query blocks first say which
parts of bands they want, then row blocks are copied to the groups of queries that want them.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestay.llm.batches import prepare
from lakestay.llm.components import stored

TOP = 10
QUERY_EVERY = 100
SCALE = 1024.0
# Pivots are chosen on this many vectors, those with the smallest hashes of their ids.
SAMPLE_ROWS = 4_096
# Least and most pivots, and rings of a pivot; both grow with the rows. The directory of the
# annuli holds two doubles for each annulus and pivot, 32 MB at most.
PIVOTS = 16, 128
RINGS = 4, 128
_RING_ROWS = 256
ROW_BLOCK = 2_048
QUERY_BLOCK = 256
# Row blocks, and query blocks, that meet in one key of the join, about.
_MEET = 64
# Vectors the first annuli of a query hold, at least.
_FIRST_ROWS = 1_024
_EXACT = float(1 << 53)


def whole_components(column: Column, scale: float = SCALE) -> Column:
    """floor(scale * x) of every component as doubles; null for a vector that takes no part:
    null, without components, or with a null or non-finite one (scaled ones included)."""
    scaled = F.transform(column, lambda x: x.cast("double") * scale)
    sound = F.forall(scaled, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # A double from 2^53 on is whole already, and might not fit the long that floor gives.
    floors = F.transform(
        scaled, lambda x: F.when(F.abs(x) < _EXACT, F.floor(x).cast("double")).otherwise(x)
    )
    return F.when((F.size(column) > 0) & F.coalesce(sound, F.lit(False)), floors)


class Pivots(NamedTuple):
    """The lifted pivots, and the squared length all lifted vectors have."""

    points: np.ndarray
    square: float

    # Squares may pass what doubles hold; bounds take nothing from distances that are not finite.
    @np.errstate(over="ignore", invalid="ignore")
    def lift(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.square - (vectors * vectors).sum(1), 0))
        return np.column_stack([vectors, rest])

    @np.errstate(over="ignore", invalid="ignore")
    def distances(self, points: np.ndarray) -> np.ndarray:
        squares = (points * points).sum(1)[:, None] + (self.points * self.points).sum(1)
        return np.sqrt(np.maximum(squares - 2 * points @ self.points.T, 0))

    @property
    def slack(self) -> float:
        """More than rounding can change a distance by."""
        return 1e-6 * np.sqrt(self.square) + 1e-9


def index_shape(rows: int) -> tuple[int, int]:
    """Pivots, and rings of each, for a number of rows."""
    pivots = min(max(2 * int(np.ceil(rows ** (1 / 3))), PIVOTS[0]), PIVOTS[1])
    return pivots, min(max(-(-rows // (pivots * _RING_ROWS)), RINGS[0]), RINGS[1])


@np.errstate(over="ignore", invalid="ignore")
def choose_pivots(sample: np.ndarray, square: float, count: int) -> Pivots:
    """Points of the sample far from each other: each next one is the farthest from all before."""
    own = Pivots(np.empty((0, 0)), square)
    points = own.lift(sample)
    picked = [0]
    gap = ((points - points[0]) ** 2).sum(1)
    while len(picked) < min(count, len(points)) and gap.max() > 0:
        picked.append(int(gap.argmax()))
        gap = np.minimum(gap, ((points - points[picked[-1]]) ** 2).sum(1))
    return Pivots(points[picked], square)


class Directory(NamedTuple):
    """The annuli in order: number, least and greatest distance to every pivot, rows and row blocks."""

    pivots: Pivots
    number: np.ndarray
    near: np.ndarray
    far: np.ndarray
    rows: np.ndarray
    blocks: np.ndarray

    @np.errstate(over="ignore", invalid="ignore")
    def reach(self, queries: np.ndarray) -> np.ndarray:
        """A bound on the scores of each query (row) with vectors of each annulus (column)."""
        d = self.pivots.distances(np.column_stack([queries, np.zeros(len(queries))]))
        gap = np.zeros((len(queries), len(self.number)))
        for k in range(d.shape[1]):
            own = np.maximum(d[:, k, None] - self.far[:, k], self.near[:, k] - d[:, k, None]) - self.pivots.slack
            np.maximum(gap, np.where(np.isfinite(own), own, 0), out=gap)
        squares = (queries * queries).sum(1)[:, None] + self.pivots.square
        # The half sum of squares less the squared distance is the inner product.
        reach = (squares - gap * gap) / 2 + 1e-9 * squares + 0.5
        # Of vectors too long for doubles nothing can be ruled out.
        return np.where(np.isnan(reach), np.inf, reach)

    def bands(self) -> tuple[np.ndarray, np.ndarray]:
        """The band of each annulus, and the parts of each band: annuli in order until they have enough blocks."""
        band, parts, held = np.zeros(len(self.number), np.int64), [], 0
        for i, b in enumerate(self.blocks.tolist()):
            if not parts or held + b > _MEET:
                parts.append(max(1, -(-b // _MEET)))
                held = 0
            held += b
            band[i] = len(parts) - 1
        return band, np.array(parts, np.int64)

    def first(self, reach: np.ndarray, rows: int = _FIRST_ROWS) -> np.ndarray:
        """Which annuli each query searches first: the best, until they hold enough rows."""
        order = np.argsort(-reach, axis=1, kind="stable")
        held = np.cumsum(self.rows[order], axis=1)
        taken = np.zeros(reach.shape, bool)
        before = held - self.rows[order]
        np.put_along_axis(taken, order, before < rows, axis=1)
        return taken


def best_scores(
    queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, top: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the query, score, row id) of the highest scores, ties to smaller ids.

    rows are in ascending order of their ids. Scores are exact: in doubles while these hold
    the sums, in whole numbers of any size beyond; those beyond 64 bits count as the bound.
    """
    widest = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * max(queries.shape[1], 1)
    if widest < _EXACT / ROW_BLOCK:
        scores = queries @ rows.T
    else:
        exact = np.array([[int(x) for x in q] for q in queries], object) @ np.array(
            [[int(x) for x in r] for r in rows], object
        ).T
        scores = np.clip(exact, -(1 << 63) + 1, (1 << 63) - 1)
    own = query_ids[:, None] == row_ids[None, :]
    n = len(row_ids)
    if scores.dtype == object:
        place, score, ids = [], [], []
        for i in range(len(scores)):
            order = sorted((k for k in range(n) if not own[i, k]), key=lambda k: (-scores[i, k], row_ids[k]))[:top]
            place += [i] * len(order)
            score += [int(scores[i, k]) for k in order]
            ids += [int(row_ids[k]) for k in order]
        return np.array(place, np.int64), np.array(score, np.int64), np.array(ids, np.int64)
    # Score and place in one number, so that equal scores are in order of ids.
    keys = scores * ROW_BLOCK - np.arange(n)
    keys[own] = -np.inf
    kept = min(top, n)
    at = np.argpartition(-keys, kept - 1, axis=1)[:, :kept] if kept < n else np.tile(np.arange(n), (len(keys), 1))
    place = np.repeat(np.arange(len(keys)), at.shape[1])
    at = at.ravel()
    sound = ~own[place, at]
    place, at = place[sound], at[sound]
    return place, scores[place, at].astype(np.int64), row_ids[at]


def _packed(vectors: np.ndarray) -> bytes:
    """A matrix of whole numbers in the fewest bytes that hold them."""
    widest = np.abs(vectors).max(initial=0)
    kind = "<i2" if widest < 1 << 15 else "<i4" if widest < 1 << 31 else "<f8"
    return kind[1:].encode() + vectors.astype(kind).tobytes()


def _unpacked(data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, "<" + data[:2].decode(), offset=2).astype(float).reshape(-1, width)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors of a batch; missing last components are zero."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width))
    out[np.arange(width) < lengths[:, None]] = flat
    return out


_BLOCK_KINDS = (
    "annulus bigint, part bigint, near array<double>, far array<double>, n bigint, ids binary, vectors binary"
)


def _keyed(vectors: DataFrame, pivots: Pivots, width: int) -> DataFrame:
    """vec_id, its nearest pivot (ties: the first), the distance, and the vector."""
    schema = pa.schema([
        ("vec_id", pa.int64()), ("pivot", pa.int32()), ("distance", pa.float64()), ("vector", pa.list_(pa.float64())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                d = pivots.distances(pivots.lift(_matrix(batch.column("vector"), width)))
                nearest = d.argmin(1)
                columns = [
                    batch.column("vec_id"), pa.array(nearest, pa.int32()), pa.array(d.min(1)),
                    batch.column("vector").cast(schema.field("vector").type),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return vectors.mapInArrow(run, "vec_id bigint, pivot int, distance double, vector array<double>")


def _blocks(
    keyed: DataFrame, pivots: Pivots, cuts: dict[int, list[float]], rings: int, width: int, size: int
) -> DataFrame:
    """Rows of one annulus (without cuts: of one pivot) in blocks, in order of distance.

    Rows are dealt by ranges of pivot, distance and id, so that equal vectors, however many,
    are spread over tasks.
    """
    schema = pa.schema([
        ("annulus", pa.int64()), ("part", pa.int64()), ("near", pa.list_(pa.float64())),
        ("far", pa.list_(pa.float64())), ("n", pa.int64()), ("ids", pa.binary()), ("vectors", pa.binary()),
    ])
    tasks = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = keyed.repartitionByRange(tasks, "pivot", "distance", "vec_id").sortWithinPartitions(
        "pivot", "distance", "vec_id"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []

        def flush():
            nonlocal number
            ids = np.concatenate([h[1] for h in held])
            order = np.argsort(ids, kind="stable")
            vectors = np.concatenate([h[2] for h in held])[order]
            d = pivots.distances(pivots.lift(vectors))
            row = [held[0][0], number, d.min(0), d.max(0), len(ids), ids[order].tobytes(), _packed(vectors)]
            number += 1
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, schema.types)], schema=schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            pivot = batch.column("pivot").to_numpy()
            d = batch.column("distance").to_numpy()
            ids = batch.column("vec_id").to_numpy()
            vectors = _matrix(batch.column("vector"), width)
            annulus = pivot.astype(np.int64) * rings
            for p in np.unique(pivot).tolist():
                annulus[pivot == p] += np.searchsorted(cuts.get(p, []), d[pivot == p], side="left")
            border = np.flatnonzero(annulus[1:] != annulus[:-1]) + 1
            for a, b in zip([0, *border.tolist()], [*border.tolist(), len(d)]):
                if held and held[0][0] != annulus[a]:
                    yield flush()
                    held = []
                while a < b:
                    room = size - sum(len(h[1]) for h in held)
                    end = min(b, a + room)
                    held.append((int(annulus[a]), ids[a:end], vectors[a:end]))
                    a = end
                    if sum(len(h[1]) for h in held) >= size:
                        yield flush()
                        held = []
        if held:
            yield flush()

    return dealt.mapInArrow(run, _BLOCK_KINDS)


_CELL_KINDS = (
    "band bigint, slot bigint, group bigint, block bigint, least binary, annuli array<bigint>, masks array<binary>"
)


def _cells(queries: DataFrame, directory: Directory, groups: int, width: int, again: bool) -> DataFrame:
    """What each query block wants of each part of a band: annuli, and which of its queries want them.

    These are the first annuli of a query, or (again) of the others those that can still hold
    a score as high as the last one known of the query.
    """
    band, parts = directory.bands()
    starts = np.flatnonzero(np.diff(band, prepend=-1)).tolist()
    schema = pa.schema([
        ("band", pa.int64()), ("slot", pa.int64()), ("group", pa.int64()), ("block", pa.int64()),
        ("least", pa.binary()), ("annuli", pa.list_(pa.int64())), ("masks", pa.list_(pa.binary())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids = np.frombuffer(r["ids"], np.int64)
                reach = directory.reach(_unpacked(r["vectors"], width))
                taken = directory.first(reach)
                least = np.full(len(ids), -np.inf)
                if again:
                    known = {x["query_id"]: x["least"] for x in r["known"] or []}
                    least = np.array([known.get(i, -np.inf) for i in ids.tolist()])
                    taken = ~taken & (reach >= least[:, None])
                group = int(r["part"] * 0x9E3779B97F4A7C15 >> 20) % groups
                rows = []
                for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(band)])):
                    some = a + np.flatnonzero(taken[:, a:b].any(0))
                    if len(some):
                        masks = [np.packbits(taken[:, x]).tobytes() for x in some]
                        own = (group, r["part"], least.tobytes(), directory.number[some].tolist(), masks)
                        rows += [(k, slot, *own) for slot in range(int(parts[k]))]
                columns = zip(*rows) if rows else [[]] * len(schema)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(columns, schema.types)], schema=schema
                )

    return queries.mapInArrow(run, _CELL_KINDS)


def _search(queries: DataFrame, blocks: DataFrame, directory: Directory, groups: int, width: int, top: int,
            again: bool) -> DataFrame:
    """(query_id, score, vec_id): the best of what each task has searched."""
    cells = stored(_cells(queries, directory, groups, width, again), "vector-cells")
    band, parts = directory.bands()
    # One row for each annulus, so PIVOTS times RINGS at most.
    places = queries.sparkSession.createDataFrame(
        list(zip(directory.number.tolist(), band.tolist(), parts[band].tolist())),
        "annulus bigint, band bigint, parts bigint",
    )
    placed = blocks.join(F.broadcast(places), "annulus").select(
        "annulus", "band", F.pmod(F.xxhash64("part"), F.col("parts")).alias("slot"), "ids", "vectors"
    )
    placed = placed.join(cells.select("band", "slot", "group").distinct(), ["band", "slot"])
    asked = cells.join(
        queries.select(F.col("part").alias("block"), F.col("ids").alias("query_ids"), F.col("vectors").alias("queries")),
        "block",
    )
    schema = pa.schema([("query_id", pa.int64()), ("score", pa.int64()), ("vec_id", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[np.ndarray]] = {}

        def out():
            for ids, place, score, row in best.values():
                yield pa.RecordBatch.from_arrays([pa.array(ids[place]), pa.array(score), pa.array(row)], schema=schema)

        for batch in batches:
            for k in range(batch.num_rows):
                block = batch.column("block")[k].as_py()
                ids = np.frombuffer(batch.column("query_ids")[k].as_py(), np.int64)
                wants = np.frombuffer(batch.column("mask")[k].as_py(), np.uint8)
                wants = np.flatnonzero(np.unpackbits(wants, count=len(ids)))
                vectors = _unpacked(batch.column("queries")[k].as_py(), width)[wants]
                rows = _unpacked(batch.column("vectors")[k].as_py(), width)
                row_ids = np.frombuffer(batch.column("ids")[k].as_py(), np.int64)
                least = np.frombuffer(batch.column("least")[k].as_py(), float)
                place, score, row = best_scores(vectors, ids[wants], rows, row_ids, top)
                place = wants[place]
                able = score >= least[place]
                place, score, row = place[able], score[able], row[able]
                if block in best:
                    _, p, s, v = best[block]
                    place, score, row = np.concatenate([p, place]), np.concatenate([s, score]), np.concatenate([v, row])
                order = np.lexsort((row, -score, place))
                place, score, row = place[order], score[order], row[order]
                count = np.bincount(place, minlength=len(ids))
                rank = np.arange(len(place)) - np.repeat(np.concatenate([[0], np.cumsum(count)[:-1]]), count)
                best[block] = [ids, place[rank < top], score[rank < top], row[rank < top]]
            if len(best) > 500:
                yield from out()
                best = {}
        yield from out()

    at = F.array_position("annuli", F.col("annulus"))
    return asked.join(placed, ["band", "slot", "group"]).filter(at > 0).select(
        "block", "query_ids", "queries", "least", F.element_at("masks", at.cast("int")).alias("mask"), "ids", "vectors"
    ).mapInArrow(search, "query_id bigint, score bigint, vec_id bigint")


def _ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def top_products(
    vectors: DataFrame,
    top: int = TOP,
    query_every: int = QUERY_EVERY,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: float = SCALE,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the highest integer inner products, exact.

    Queries are the vectors whose id is divisible by query_every; candidates are all rows with
    another id. Components count as floor(scale * x). Vectors that are null, empty or hold a
    null or non-finite component take no part, nor do rows without an id; a shorter vector
    counts as ending in zeros. Rows that repeat an id are candidates each, and one query, the
    least of their vectors. Ties go to smaller ids. An empty table gives no rows.
    """
    spark = prepare(vectors.sparkSession)
    own = vectors.select(
        vectors[id_column].cast("bigint").alias("vec_id"), whole_components(vectors[vector_column], scale).alias("vector")
    ).filter("vec_id is not null and vector is not null")
    squares = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    size = own.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width"), F.max(squares).alias("s")).first()
    if size.n == 0:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    keyed, blocks, directory = build_index(own, size.n, size.width, size.s)
    asked = keyed.filter(F.col("vec_id") % query_every == 0).groupBy("vec_id").agg(
        F.min(F.struct("vector", "pivot", "distance")).alias("x")
    ).select("vec_id", "x.pivot", "x.distance", "x.vector")
    queries = stored(_blocks(asked, directory.pivots, {}, 1, size.width, QUERY_BLOCK), "query-blocks").select(
        "part", "ids", "vectors"
    )
    groups = max(1, -(-queries.count() // _MEET))
    first = stored(_search(queries, blocks, directory, groups, size.width, top, again=False), "first-scores")
    least = _ranked(first, top).filter(F.col("rank") == top).select("query_id", F.col("score").alias("least"))
    members = queries.mapInArrow(_members, "part bigint, query_id bigint")
    known = members.join(least, "query_id").groupBy("part").agg(
        F.collect_list(F.struct("query_id", F.col("least").cast("double").alias("least"))).alias("known")
    )
    rest = _search(queries.join(known, "part", "left"), blocks, directory, groups, size.width, top, again=True)
    return _ranked(first.unionByName(rest), top).select("query_id", "rank", "vec_id", "score")


def build_index(own: DataFrame, n: int, width: int, square: float) -> tuple[DataFrame, DataFrame, Directory]:
    """Keyed vectors, their row blocks and the directory of the annuli, from n rows of vec_id and vector."""
    count, rings = index_shape(n)
    sample = own.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).collect()
    points = np.zeros((len(sample), width))
    for i, r in enumerate(sample):
        points[i, : len(r.vector)] = r.vector
    pivots = choose_pivots(points, square, count)
    keyed = _keyed(own, pivots, width)
    shares = [i / rings for i in range(1, rings)]
    rows = keyed.groupBy("pivot").agg(F.percentile_approx("distance", shares, 1_000).alias("cuts")).collect()
    cuts = {r.pivot: sorted(set(r.cuts)) for r in rows}
    blocks = stored(_blocks(keyed, pivots, cuts, rings, width, ROW_BLOCK), "vector-blocks")
    every = range(len(pivots.points))
    annuli = blocks.groupBy("annulus").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("b"),
        F.array(*[F.min(F.col("near")[i]) for i in every]).alias("near"),
        F.array(*[F.max(F.col("far")[i]) for i in every]).alias("far"),
    ).orderBy("annulus").collect()
    return keyed, blocks, Directory(
        pivots, np.array([a.annulus for a in annuli]), np.array([a.near for a in annuli], float),
        np.array([a.far for a in annuli], float), np.array([a.n for a in annuli]), np.array([a.b for a in annuli]),
    )


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The queries of each block."""
    for batch in batches:
        for part, ids in zip(batch.column("part").to_pylist(), batch.column("ids")):
            own = np.frombuffer(ids.as_py(), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), part)), pa.array(own)], ["part", "query_id"])
