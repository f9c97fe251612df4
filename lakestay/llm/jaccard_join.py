"""Exact self join of documents by Jaccard similarity of their word shingles.

The universe of shingles is partitioned: in each band of set sizes, hashing deals shingles
to segments. If two sets are similar, their symmetric difference is at most some H, so all
but H of the segments that are not empty in one set hold equal subsets in the other
(pigeonhole). Segments are ordered by cost, that is by how often the rarest shingle of the
subset occurs in the corpus, and a set is indexed under the subsets of its H + 1 cheapest
segments: the cheapest segment two similar sets have in common is among those of both, and
what many documents share is left to the costly end.

Allocation follows cost. A set made of common shingles for the most part (at least half of
it) would have to be indexed under costly subsets. For such sets the partition is taken to
its finest, a segment for each shingle: there the other set's surplus breaks no segment, so
fewer have to be indexed, few enough that none is costly unless the set is truly similar to
others that hold it. Sets of five shingles and fewer have one segment, the whole set, indexed
together with its one-deletion neighbourhood, which finds the single difference their size
allows.

Each key carries the size of its set and its place in the order; two sets need comparing only
if, for their two sizes, both places are within the bound, and the smaller one's is an index
entry (the larger one may be too costly to be indexed itself, but still looks things up).

Sets that meet under a key are candidates. They are not paired all with all: first each with
the one whose place is lowest, the most typical one, and the best such pair of each set is
verified; only sets that are then in different components are paired. Verification compares bit signatures, which bound the
difference from below, then the sets themselves.

Equal sets are one class throughout. Sets are of 64-bit hashes of shingles, classes are
told apart by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakestay.llm.batches import prepare, slices
from lakestay.llm.components import components, stored
from lakestay.llm.words import mix, shingles, words

SHINGLE_WORDS = 5
# Least similarity in percent: 100 * intersection >= LEAST_PERCENT * union.
LEAST_PERCENT = 75
# Ids whose texts are fetched by a broadcast of the ids; more are fetched by a shuffle.
BROADCAST_IDS = 2_000_000

_U = np.uint64
_TINY = 5  # sets up to this size allow one difference and have one segment
_SKETCH_BITS = 18
_SKETCH_SLICES = 256
_SECOND = _U(0xD6E8FEB86659FD93)


def shared_least(total: np.ndarray, percent: int) -> np.ndarray:
    """Least intersection of two similar sets whose sizes sum to total."""
    return -(-percent * total // (100 + percent))


def difference_most(sizes: np.ndarray, percent: int, partner: str) -> np.ndarray:
    """Largest symmetric difference between a set and a similar one of at least
    (partner "larger") or at most (partner "smaller") its size."""
    n = np.asarray(sizes, np.int64)
    if partner == "larger":
        first, last = 2 * n, n + n * 100 // percent
    else:
        first, last = n - (-percent * n // 100), 2 * n
    # t - 2 * shared_least(t) rises by steps; its peak is within the last few sums.
    most = np.zeros_like(n)
    for k in range(2 * (100 + percent) // 25 + 1):
        t = np.maximum(last - k, first)
        most = np.maximum(most, t - 2 * shared_least(t, percent))
    return most


class Sets(NamedTuple):
    """Distinct shingle hashes of rows, ascending within a row."""

    tokens: np.ndarray
    begin: np.ndarray

    def of(self, row: int) -> np.ndarray:
        return self.tokens[self.begin[row] : self.begin[row + 1]]


def shingle_sets(texts: pa.Array, size: int = SHINGLE_WORDS) -> Sets:
    found, begin = shingles(words(texts), size)
    parts = []
    for a, b in zip(begin.tolist(), begin[1:].tolist()):
        own = np.sort(found[a:b])
        parts.append(own[np.concatenate([[True], own[1:] != own[:-1]])] if b > a else own)
    tokens = np.concatenate(parts) if parts else np.empty(0, _U)
    return Sets(tokens, np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64))


def classes(sets: Sets) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of each set."""
    n = np.diff(sets.begin).astype(_U)

    def summed(values):
        total = np.concatenate([[_U(0)], np.cumsum(values)])
        return mix(total[sets.begin[1:]] - total[sets.begin[:-1]] + n)

    return summed(mix(sets.tokens)).view(np.int64), summed(mix(sets.tokens ^ _SECOND)).view(np.int64)


def signature(tokens: np.ndarray) -> bytes:
    """A bit for the parity of the tokens that fall on it, at least two bits for each token.

    The bits in which two signatures differ are at most as many as the tokens in which the
    sets differ. A longer signature folds to a shorter one.
    """
    bits = max(64, 1 << (2 * max(len(tokens), 1) - 1).bit_length())
    counts = np.bincount((tokens >> _U(20)).astype(np.int64) & (bits - 1), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def differing_bits(one: bytes, two: bytes) -> int:
    a, b = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
    short = min(len(a), len(b))
    a, b = (np.bitwise_xor.reduce(x.reshape(-1, short), axis=0) for x in (a, b))
    return int(np.bitwise_count(a ^ b).sum())


def similar(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    """Exact test on ascending distinct tokens."""
    both = np.intersect1d(one, two, assume_unique=True).size
    return 100 * both >= percent * (len(one) + len(two) - both)


class Bands(NamedTuple):
    """Bands of set sizes and the number of segments of each; 0: every token its own."""

    percent: int

    def of(self, sizes: np.ndarray) -> np.ndarray:
        """0 for tiny sets, then a band for each factor of four."""
        n = np.maximum(np.asarray(sizes, np.int64), 1)
        band = np.floor(np.log2(np.maximum(n, _TINY + 1) / (_TINY + 1)) / 2 + 1e-9).astype(np.int64) + 1
        return np.where(n <= _TINY, 0, band)

    def ends(self, band: int) -> tuple[int, int]:
        if band == 0:
            return 1, _TINY
        low = (_TINY + 1) * 4 ** (band - 1)
        return low, 4 * low - 1

    def segments(self, band: int) -> int:
        """The fewest segments, one for each shingle of the largest set at least, of which more
        than H are certain to be filled for any size in the band: the expected number of filled
        ones exceeds H by eight standard deviations."""
        low, high = self.ends(band)
        n = np.unique(np.linspace(low, high, 64).astype(np.int64))
        need = difference_most(n, self.percent, "larger") + 1
        m = float(high)
        while m <= 16 * high:
            load = n / m
            empty = np.exp(-load)
            spread = np.sqrt(m * empty * np.maximum(1 - (1 + load) * empty, 0))
            if (m * (1 - empty) - 8 * spread >= need).all():
                return int(m)
            m *= 1.1
        return 0


# Layout of a place: whether an entry only looks up, whether its partition is the finest, the
# rank of its segment by cost, the size of its set.
_LOOKUP, _FINEST, _RANK, _SIZE = 1 << 61, 1 << 60, 30, (1 << 30) - 1


class Index:
    """Keys and places under which sets are indexed and looked up."""

    def __init__(self, costs: np.ndarray, percent: int = LEAST_PERCENT):
        self.costs = costs
        self.percent = percent
        self.bands = Bands(percent)
        self.segments: dict[int, int] = {}

    def keys(self, sets: Sets) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, key, place) of all sets; an empty set has none."""
        n = np.diff(sets.begin)
        cost = self.costs[sets.tokens >> _U(64 - _SKETCH_BITS)]
        below = np.concatenate([[0], np.cumsum(cost == 0)])
        rare = below[sets.begin[1:]] - below[sets.begin[:-1]]
        band = self.bands.of(n)
        smallest_partner = -(-self.percent * n // 100)
        found = [_neighbourhoods(sets, np.flatnonzero((n > 0) & (smallest_partner <= _TINY)), self.percent)]
        large = n > _TINY
        costly = 2 * rare <= n
        # Of a set similar to a costly one of at most its size, what is rare is in the rare half
        # of that or beyond it.
        rows = np.flatnonzero(large & (100 * rare <= (150 - self.percent) * n))
        found.append(self._subsets(sets, cost, rows, costly[rows], None, ~costly[rows]))
        # A similar set of at least its size has what is rare in a set that is not costly, but
        # for what it may lack.
        lacks = (100 - self.percent) / (100 + self.percent)
        plain = large & (rare >= n * (self.percent / 100) * (0.5 - lacks) * 0.99)
        for shift in (0, 1):
            meets = plain if shift == 0 else plain & (self.bands.of(smallest_partner) < band)
            for b in np.unique(band[meets]).tolist():
                if b - shift > 0:
                    rows = np.flatnonzero(meets & (band == b))
                    lookup = costly[rows] if shift == 0 else np.ones(len(rows), bool)
                    found.append(self._subsets(sets, cost, rows, ~lookup, b - shift, lookup))
        return tuple(np.concatenate([f[k] for f in found]) for k in range(3))

    def _subsets(self, sets: Sets, cost, rows, indexed, band: int | None, lookup):
        """Subsets of the cheapest segments of each row; band None: the finest partition."""
        if not len(rows):
            return np.empty(0, np.int64), np.empty(0, _U), np.empty(0, np.int64)
        sizes = np.diff(sets.begin)[rows]
        at = np.repeat(sets.begin[rows] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
        tokens, cost = sets.tokens[at], cost[at].astype(_U)
        row = np.repeat(np.arange(len(rows), dtype=np.uint64), sizes)
        if band is not None and band not in self.segments:
            self.segments[band] = self.bands.segments(band)
        m = 0 if band is None else self.segments[band]
        salt = mix(np.array([0 if band is None else band + 1], _U))[0]
        if m == 0:
            subset = mix(tokens + salt)
        else:
            segment = mix(tokens ^ salt) % _U(m)
            place = (row << _U(40)) | segment
            order = np.argsort(place)
            place = place[order]
            starts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
            subset = np.add.reduceat(mix(tokens[order] ^ _SECOND), starts)
            subset = mix(subset + mix((place[starts] & _U((1 << 40) - 1)) + salt))
            cost = np.minimum.reduceat(cost[order], starts)
            row = row[order][starts]
        # By row, cost, then hash; the same order in every set.
        order = np.argsort((row << _U(40)) | (cost << _U(34)) | (subset >> _U(30)))
        row, subset = row[order].astype(np.int64), subset[order]
        count = np.bincount(row, minlength=len(rows))
        rank = np.arange(len(row)) - np.repeat(np.concatenate([[0], np.cumsum(count)[:-1]]), count)
        if band is None:
            # As the smaller of two sets it lacks at most what equal sizes allow; as the larger
            # one, what the smallest partner allows.
            as_index = np.where(indexed, sizes - shared_least(2 * sizes, self.percent), -1)
            least = -(-self.percent * sizes // 100)
            as_lookup = sizes - shared_least(sizes + least, self.percent)
        else:
            as_index = np.where(indexed, difference_most(sizes, self.percent, "larger"), -1)
            as_lookup = difference_most(sizes, self.percent, "smaller")
        kept = rank <= np.maximum(as_index, as_lookup)[row]
        row, rank, subset = row[kept], rank[kept], subset[kept]
        place = (rank << _RANK) | sizes[row] | np.where(rank > as_index[row], _LOOKUP, 0)
        if band is None:
            place |= _FINEST
        return rows[row], subset, place


def _neighbourhoods(sets: Sets, rows: np.ndarray, percent: int):
    """The whole set and, where a similar set may lack one token, the set without each."""
    out_rows, out_keys, out_places = [], [], []
    for r in rows.tolist():
        values = mix(sets.of(r) ^ _SECOND)
        whole, n = values.sum(dtype=_U), len(values)
        keys = [whole + _U(n)]
        if 100 * (n - 1) >= percent * n:
            keys += list(whole - values + _U(n - 1))
        out_rows += [r] * len(keys)
        out_keys += keys
        out_places += [_FINEST | n | (0 if n <= _TINY else _LOOKUP)] * len(keys)
    return np.array(out_rows, np.int64), mix(np.array(out_keys, _U)), np.array(out_places, np.int64)


def _may_match(size, rank, other_size, other_rank, finest, percent):
    """Whether an index entry and an entry of a set of at least its size need comparing."""
    least = shared_least(size + other_size, percent)
    most, other_most = size - least, other_size - least
    most, other_most = np.where(finest, most, most + other_most), np.where(finest, other_most, most + other_most)
    return (100 * size >= percent * other_size) & (rank <= most) & (other_rank <= other_most)


def _census(docs: DataFrame) -> DataFrame:
    """For each row its id, number of shingles, class and signature; then, for each task, the
    counts of all its shingles in a sketch of fixed size, cut in slices."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()),
        ("bits", pa.binary()), ("slice", pa.int32()), ("counts", pa.binary()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << _SKETCH_BITS, np.int64)
        for part in slices(batches, "text"):
            sets = shingle_sets(part.column("text"))
            sketch += np.bincount((sets.tokens >> _U(64 - _SKETCH_BITS)).astype(np.int64), minlength=len(sketch))
            h1, h2 = classes(sets)
            bits = [signature(sets.of(r)) for r in range(part.num_rows)]
            nulls = pa.nulls(part.num_rows)
            columns = [
                part.column("doc_id"), pa.array(np.diff(sets.begin)), pa.array(h1), pa.array(h2),
                pa.array(bits, pa.binary()), nulls.cast(pa.int32()), nulls.cast(pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
        if sketch.any():
            nulls = pa.nulls(_SKETCH_SLICES)
            columns = [nulls.cast(t) for t in schema.types[:5]]
            columns.append(pa.array(np.arange(_SKETCH_SLICES, dtype=np.int32)))
            columns.append(pa.array([c.tobytes() for c in np.split(sketch, _SKETCH_SLICES)], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    kinds = "doc_id bigint, n bigint, h1 bigint, h2 bigint, bits binary, slice int, counts binary"
    return docs.mapInArrow(run, kinds)


def _costs(census: DataFrame) -> np.ndarray:
    """A cost for each cell of the sketch of the whole corpus: 0 up to what chance explains,
    then the logarithm of the rest. The sketch has a fixed size; slices are summed in tasks."""
    schema = pa.schema([("slice", pa.int32()), ("counts", pa.binary())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, counts in zip(batch.column("slice").to_pylist(), batch.column("counts")):
                own = np.frombuffer(counts.as_py(), np.int64)
                total[k] = total[k] + own if k in total else own
        rows = [list(total), [c.tobytes() for c in total.values()]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, schema.types)], schema=schema)

    sketches = census.filter("slice is not null").select("slice", "counts")
    rows = sketches.repartition("slice").mapInArrow(add, "slice int, counts binary").collect()
    counts = np.zeros((_SKETCH_SLICES, (1 << _SKETCH_BITS) // _SKETCH_SLICES))
    for r in rows:
        counts[r.slice] = np.frombuffer(r.counts, np.int64)
    usual = np.median(counts)
    over = counts.ravel() - usual - 6 * np.sqrt(max(usual, 1))
    return np.where(over > 0, np.log2(np.maximum(over, 1)) + 1, 0).astype(np.uint8)


def _shared(docs: DataFrame, index: Index) -> DataFrame:
    """(key, hub, c, place, star): entries that meet under a key with an index entry.

    hub is the class of the index entry of lowest place; star tells whether it and c need
    comparing. The hub has a row of its own.
    """
    keyed = pa.schema([("key", pa.int64()), ("place", pa.int64()), ("c", pa.int64())])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for part in slices(batches, "text"):
            sets = shingle_sets(part.column("text"))
            h1, _ = classes(sets)
            row, key, place = index.keys(sets)
            new = np.zeros(part.num_rows, bool)
            for r, h in enumerate(h1.tolist()):  # a class is indexed once by a task
                if h not in seen:
                    seen.add(h)
                    new[r] = True
            kept = new[row]
            columns = [key[kept].view(np.int64), place[kept], h1[row[kept]]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=keyed)

    met = pa.schema([
        ("key", pa.int64()), ("hub", pa.int64()), ("c", pa.int64()), ("place", pa.int64()), ("star", pa.bool_()),
    ])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = None  # key, hub, place of the hub, last class and place, whether the hub is out
        for batch in batches:
            key, place, c = (batch.column(k).to_numpy() for k in ("key", "place", "c"))
            if not len(key):
                continue
            if carried is None or carried[0] != key[0]:
                carried = (key[0], c[0], place[0], None, None, False)
            fresh = np.concatenate([[False], key[1:] != key[:-1]])
            run = np.cumsum(fresh)
            starts = np.flatnonzero(fresh)
            hub = np.concatenate([[carried[1]], c[starts]])[run]
            hub_place = np.concatenate([[carried[2]], place[starts]])[run]
            # Copies of a class come from several tasks and follow each other.
            again = np.zeros(len(key), bool)
            again[0] = c[0] == carried[3] and place[0] == carried[4]
            again[1:] = ~fresh[1:] & (c[1:] == c[:-1]) & (place[1:] == place[:-1])
            other = np.flatnonzero(~again & (c != hub) & (hub_place < _LOOKUP))
            size, rank = hub_place & _SIZE, (hub_place & (_FINEST - 1)) >> _RANK
            own_size, own_rank = place & _SIZE, (place & (_FINEST - 1)) >> _RANK
            finest = (place & _FINEST) > 0
            larger = own_size >= size
            star = np.where(
                larger, _may_match(size, rank, own_size, own_rank, finest, index.percent),
                (place < _LOOKUP) & _may_match(own_size, own_rank, size, rank, finest, index.percent),
            )
            first = np.unique(run[other], return_index=True)
            lead = other[first[1][(first[0] > 0) | (not carried[5])]]
            out = [
                np.concatenate([key[other], key[lead]]), np.concatenate([hub[other], hub[lead]]),
                np.concatenate([c[other], hub[lead]]), np.concatenate([place[other], hub_place[lead]]),
                np.concatenate([star[other], np.zeros(len(lead), bool)]),
            ]
            hub_out = bool((run[other] == run[-1]).any()) or (carried[5] and run[-1] == 0)
            carried = (key[-1], hub[-1], hub_place[-1], c[-1], place[-1], hub_out)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], schema=met)

    keys = docs.mapInArrow(emit, "key bigint, place bigint, c bigint")
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keys.repartition(tasks, "key").sortWithinPartitions("key", "place", "c").mapInArrow(
        meet, "key bigint, hub bigint, c bigint, place bigint, star boolean"
    )


def _unconnected(shared: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """(a, b) of classes that need comparing and are in different components.

    Only keys that hold several components are looked at, and in them only entries whose
    place allows a partner as small as the smallest index entry there. Entries of two
    components are then paired by the sizes and places they have.
    """
    place = F.col("place")
    size = place.bitwiseAND(F.lit(_SIZE))
    rank = F.shiftright(place.bitwiseAND(F.lit(_FINEST - 1)), _RANK)
    finest = place.bitwiseAND(F.lit(_FINEST)) > 0
    entries = shared.select(
        "key", "c", size.alias("n"), rank.alias("rank"), finest.alias("finest"), (place < F.lit(_LOOKUP)).alias("index")
    ).join(roots, "c")
    keys = entries.groupBy("key").agg(
        F.min("root").alias("x"), F.max("root").alias("y"),
        F.min(F.when(F.col("index"), F.col("n"))).alias("least_n"),
    ).filter("x <> y").select("key", "least_n")

    def least(total):
        return F.floor((percent * total + 99 + percent) / (100 + percent))

    def most(own, total):
        return F.when(F.col("finest"), own - least(total)).otherwise(total - 2 * least(total))

    # In the finest partition the bound on the rank falls as the partner grows, from the
    # smallest one possible; elsewhere it rises by steps, and a partner of the same size is
    # the largest, as the index side of a pair is never the larger one.
    smallest = F.greatest("least_n", F.ceil(percent * F.col("n") / 100))
    largest = F.when(F.col("finest"), most(F.col("n"), F.col("n") + smallest)).otherwise(
        F.floor(2 * F.col("n") * (100 - percent) / (100 + percent))
    )
    able = F.col("index") | (F.col("rank") <= largest)
    entries = stored(entries.join(keys, "key").filter(able), "entries")
    left = entries.filter("index").select("key", "finest", *[F.col(x).alias(f"{x}_a") for x in ("c", "n", "rank", "root")])
    right = entries.select("key", *[F.col(x).alias(f"{x}_b") for x in ("c", "n", "rank", "root")])
    total = F.col("n_a") + F.col("n_b")
    pairs = left.join(right, "key").filter(
        (F.col("root_a") != F.col("root_b")) & (F.col("n_b") >= F.col("n_a"))
        & (F.col("n_a") * 100 >= F.col("n_b") * percent)
        & (F.col("rank_a") <= most(F.col("n_a"), total)) & (F.col("rank_b") <= most(F.col("n_b"), total))
    )
    return pairs.select(F.least("c_a", "c_b").alias("a"), F.greatest("c_a", "c_b").alias("b")).distinct()


_SIDE = ("rep", "n", "h1", "h2", "bits")


def _sides(pairs: DataFrame, kinds: DataFrame) -> DataFrame:
    """Pairs (a, b) of first hashes with what is known of the classes on both sides."""
    for side in ("a", "b"):
        own = kinds.select(*[F.col(x).alias(f"{x}_{side}") for x in _SIDE])
        pairs = pairs.join(own, pairs[side] == own[f"h1_{side}"])
    return pairs


def _plausible(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes and signatures allow them to be similar, with the differing bits."""
    columns = ["rep_a", "h1_a", "h2_a", "rep_b", "h1_b", "h2_b"]
    schema = pa.schema([(c, pa.int64()) for c in (*columns, "differing")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("bits_a").to_pylist(), batch.column("bits_b").to_pylist()
            total = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            differ = np.array([differing_bits(x, y) for x, y in zip(a, b)], np.int64)
            keep = pa.array(differ <= total - 2 * shared_least(total, percent))
            out = [batch.column(c).cast(pa.int64()) for c in columns]
            yield pa.RecordBatch.from_arrays([*out, pa.array(differ)], schema=schema).filter(keep)

    near = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    return pairs.filter(near & (F.col("rep_a") != F.col("rep_b"))).select(
        *columns, "n_a", "n_b", "bits_a", "bits_b"
    ).mapInArrow(run, ", ".join(f"{c} bigint" for c in schema.names))


def _verified(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sets are similar, as (a, b) of document ids; texts are fetched by id."""
    pairs = stored(pairs, "pairs")
    ids = pairs.select(F.explode(F.array("rep_a", "rep_b")).alias("doc_id")).distinct()
    if pairs.count() <= BROADCAST_IDS // 2:
        ids = F.broadcast(ids)
    texts = stored(docs.join(ids, "doc_id", "left_semi").select("doc_id", "text").distinct(), "texts")
    for side in ("a", "b"):
        own = texts.select(F.col("doc_id").alias(f"rep_{side}"), F.col("text").alias(f"text_{side}"))
        pairs = pairs.join(own, f"rep_{side}")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text_a"):
            keep = np.ones(part.num_rows, bool)
            both = []
            for side in ("a", "b"):
                sets = shingle_sets(part.column(f"text_{side}"))
                # An id may stand for several texts; only the class that was meant counts.
                for h, name in zip(classes(sets), ("h1", "h2")):
                    keep &= h == part.column(f"{name}_{side}").to_numpy()
                both.append(sets)
            for r in np.flatnonzero(keep).tolist():
                keep[r] = similar(both[0].of(r), both[1].of(r), percent)
            columns = [part.column("rep_a"), part.column("rep_b")]
            yield pa.RecordBatch.from_arrays(columns, schema=schema).filter(pa.array(keep))

    return pairs.mapInArrow(run, "a bigint, b bigint")


def similar_documents(
    docs: DataFrame, percent: int = LEAST_PERCENT, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    component_id is the smallest id reachable by links between similar sets, the id itself
    included. A null, empty or blank text has no shingles and no links. Rows of one id are
    one document with several texts: each row has its own n_shingles, and the links of all.
    A row without an id is linked with nothing and has no component. Other columns are not
    read. The result is exact; links between equal texts are kept as membership of a class,
    never as pairs.
    """
    spark = prepare(docs.sparkSession)
    own = docs.select(docs[id_column].cast("bigint").alias("doc_id"), docs[text_column].alias("text"))
    census = stored(_census(own), "census")
    rows = census.filter("slice is null").select("doc_id", "n", "h1", "h2", "bits")
    index = Index(_costs(census), percent)
    filled = rows.filter("n > 0 and doc_id is not null")
    kinds = stored(
        filled.groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("rep"), F.min("bits").alias("bits")), "classes"
    )
    named = own.filter("doc_id is not null")
    shared = stored(_shared(named, index), "shared")

    # The best pair of each class with the hub of a key.
    stars = shared.filter("star").select(F.col("hub").alias("a"), F.col("c").alias("b")).distinct()
    plausible = _plausible(_sides(stars, kinds), percent)
    best = plausible.groupBy("h1_b", "h2_b", "rep_b").agg(
        F.min(F.struct("differing", "rep_a", "h1_a", "h2_a")).alias("x")
    ).select("rep_b", "h1_b", "h2_b", "x.rep_a", "x.h1_a", "x.h2_a")
    links = stored(_verified(best, named, percent), "links")
    roots = stored(components(links), "roots")

    # Classes that share a key and are not connected yet.
    root_of = kinds.select("rep", F.col("h1").alias("c")).join(roots, F.col("rep") == F.col("node"), "left").select(
        "c", F.coalesce("root", "rep").alias("root")
    )
    rest = _unconnected(shared, root_of, percent)
    more = _verified(_plausible(_sides(rest, kinds), percent).drop("differing"), named, percent)

    # Copies hang on the first of their class.
    same = filled.join(kinds.select("n", "h1", "h2", "rep"), ["n", "h1", "h2"]).filter("doc_id <> rep").select(
        F.col("doc_id").alias("a"), F.col("rep").alias("b")
    )
    every = stored(links.unionByName(more).unionByName(same), "links")
    final = components(every)
    return rows.join(final, F.col("doc_id") == F.col("node"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "doc_id").alias("component_id")
    )


def keep_one(
    docs: DataFrame, percent: int = LEAST_PERCENT, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row of each component of similar documents, with all its columns.

    The row with the smallest id stays; of several rows with that id, the first by a hash of
    all columns. Rows without an id stay, as they are linked with nothing. Rows that stay
    are not moved: ids to leave out are sent to them, or joined with them if too many.
    """
    found = stored(similar_documents(docs, percent, id_column, text_column), "similar")
    ids = found.filter("doc_id is not null").groupBy("doc_id", "component_id").count()
    # Names the documents don't have.
    own, root, place = (_free(name, docs.columns) for name in ("_id", "_root", "_first"))
    out = ids.filter("doc_id <> component_id or count > 1").select(
        F.col("doc_id").alias(own), (F.col("doc_id") == F.col("component_id")).alias(root)
    )
    if out.count() <= BROADCAST_IDS:
        out = F.broadcast(out)
    key = F.col(id_column).cast("bigint")
    kept = docs.join(out, key == F.col(own), "left_anti")
    again = docs.join(out.filter(F.col(root)), key == F.col(own), "left_semi")
    first = Window.partitionBy(key).orderBy(F.xxhash64(*[F.col(c).cast("string") for c in docs.columns]), text_column)
    again = again.withColumn(place, F.row_number().over(first)).filter(F.col(place) == 1).drop(place)
    return kept.unionByName(again)


def _free(name: str, taken: list[str]) -> str:
    while name.lower() in [c.lower() for c in taken]:
        name = f"_{name}"
    return name
