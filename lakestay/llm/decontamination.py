"""Benchmark items that stand in documents, exactly or with few edits.

Items and documents are normalised alike: lower case, single spaces between words. Edits
break an item into runs of unedited characters. Every run of some length (a seed) of an item
is indexed and looked up at every character of the documents; an occurrence is found if one
run between its edits is as long as the seed. How long the longest run is when edits fall
anywhere with equal chance has a closed form, so each item gets the longest seed that finds
the wanted share of its copies with as many edits as are allowed. Edits side by side, as
in replaced words, leave longer runs. Up to one edit for each seed length and one
character, the longest run cannot be shorter, wherever edits fall.

A hit is a region of a document. Regions in which too few four-character runs are the
item's are passed over; an occurrence cannot be among them (q-gram lemma). Many of the rest
are compared at once by a lower bound of the edit distance, and what it leaves is verified by
exact edit distance between the whole item and the best matching passage.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from math import comb
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestay.llm.batches import keep_rows, prepare, slices

# Edits allowed for each character of an item, words in lower case, single spaces between.
EDIT_RATE = 0.2
# Seeds are so short that this share of occurrences with that many edits is found.
TARGET_RECALL = 0.95
# Longer seeds would hardly be rarer in documents.
LONGEST_SEED = 16
# Shorter items say too little for edits: they are found where all their words stand unedited.
LEAST_WORDS = 8
# Items looked for in one pass; their index goes to every task.
BLOCK_ITEMS = 5_000

# Longer items are treated as this long when seeds are chosen; their recall is higher.
_LONGEST_MODEL = 1000
# Characters looked up at once.
_STEP = 1 << 14
# Characters of regions counted at once.
_COUNTED = 1 << 20
# Runs that are counted in regions, and bits of their hashes.
_GRAM = 4
_GRAM_BITS = 14
# Regions compared at once; the last few are left to the exact comparison.
_BATCH, _FEW = 2048, 32
_WORD = re.compile(r"\S+")
_U = np.uint64
_BASE, _SPREAD = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93)


def run_chance(length: int, edits: int, run: int) -> float:
    """Chance that edits at distinct random places leave a run of that many characters."""
    left = length - edits
    without = sum(
        (-1) ** j * comb(edits + 1, j) * comb(length - j * run, edits) for j in range(min(edits + 1, left // run) + 1)
    )
    return 1 - without / comb(length, edits)


@lru_cache(maxsize=None)
def seed_length(length: int, edit_rate: float, recall: float) -> int:
    """The longest seed that finds the wanted share of copies with all edits allowed.

    Raises ValueError where not even single characters do.
    """
    length = min(length, _LONGEST_MODEL)
    edits = int(edit_rate * length)
    for run in range(min(LONGEST_SEED, length), 0, -1):
        if run_chance(length, edits, run) >= recall:
            return run
    raise ValueError(f"items of {length} characters with {edits} edits cannot be found at a rate of {recall}")


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


class _Seeds:
    """Seeds of one length of all items that have it."""

    def __init__(self, texts: dict[int, str], length: int):
        keys, owners, offsets = [], [], []
        for i, text in texts.items():
            for size, own in _grams(_codes(text), {length}):
                own = own[: len(text) - size + 1]
                keys.append(own)
                owners.append(np.full(len(own), i))
                offsets.append(np.arange(len(own)))
        key, owner, offset = (np.concatenate(x) for x in (keys, owners, offsets))
        order = np.lexsort((offset, owner, key))
        key, owner, offset = key[order], owner[order], offset[order]
        new = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])))
        # A seed that an item repeats is kept once, with its first and last place.
        self.keys, self.owners, self.low = key[new], owner[new], offset[new]
        self.high = offset[np.append(new[1:], len(key)) - 1]
        self.begin = np.flatnonzero(np.append(True, self.keys[1:] != self.keys[:-1]))
        self.keys, self.count = self.keys[self.begin], np.diff(np.append(self.begin, len(self.keys)))
        self.shift = _U(64 - max(16, (16 * len(self.keys)).bit_length()))
        self.there = np.zeros(1 << int(_U(64) - self.shift), bool)
        self.there[self.keys >> self.shift] = True

    def hits(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, number of the seed) for equal keys."""
        some = np.flatnonzero(self.there[keys >> self.shift])
        which = np.minimum(np.searchsorted(self.keys, keys[some]), len(self.keys) - 1)
        equal = self.keys[which] == keys[some]
        some, which = some[equal], which[equal]
        count = self.count[which]
        shift = self.begin[which] - (np.cumsum(count) - count)
        return np.repeat(some, count), np.arange(count.sum()) + np.repeat(shift, count)


def _grams(codes: np.ndarray, lengths: set[int]) -> Iterator[tuple[int, np.ndarray]]:
    """Hashes of the runs of each length that begin at each character; zeros follow the last."""
    n, longest = len(codes), max(lengths)
    padded = np.zeros(n + longest, _U)
    padded[:n] = codes
    key = np.zeros(n, _U)
    for j in range(longest):
        key *= _BASE
        key += padded[j : j + n]
        if j + 1 in lengths:
            yield j + 1, key * _SPREAD


def _buckets(codes: np.ndarray) -> np.ndarray:
    """A small number for the run of _GRAM characters that begins at each place."""
    (_, key), = _grams(codes, {_GRAM})
    return (key >> _U(64 - _GRAM_BITS)).astype(np.uint16)


def _normal(text: str) -> str:
    return " ".join(text.lower().split())


def distances(pattern: str, text: str, anchored: bool) -> list[int]:
    """Edit distance of the pattern to the best part of text that ends at each place.

    Anchored parts begin where the text does. Bit-parallel (Myers), exact; entry j is for
    parts that end after j characters.
    """
    m = len(pattern)
    places: dict[str, int] = {}
    for i, c in enumerate(pattern):
        places[c] = places.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    out = [m]
    for c in text:
        same = places.get(c, 0)
        vertical = same | down
        across = (((same & up) + up) ^ up) | same
        more, less = down | ~(across | up), up & across
        if more & top:
            score += 1
        if less & top:
            score -= 1
        more, less = more << 1 | anchored, less << 1
        up, down = (less | ~(vertical | more)) & full, more & vertical & full
        out.append(score)
    return out


def best_part(pattern: str, text: str, most: int) -> tuple[int, int, int] | None:
    """(distance, start, end) of the part of text nearest to the pattern, if within most edits.

    Ties: the first end, then the shortest part.
    """
    at = text.find(pattern)
    if at >= 0:
        return 0, at, at + len(pattern)
    ends = distances(pattern, text, anchored=False)
    distance = min(ends)
    if distance > most:
        return None
    end = ends.index(distance)
    backward = distances(pattern[::-1], text[:end][::-1], anchored=True)
    return distance, end - backward.index(distance), end


def least_distances(patterns: list[str], own: np.ndarray, low: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """For each part of low, a bound below the edit distance of its pattern to any passage in it.

    The method of distances in blocks of 64 characters, for many parts side by side; own is the
    pattern of each part. Length is in descending order; the last few parts left are not
    followed to their end, their bound is 0. Low has the lower seven bits of characters, so
    different ones may count as the same.
    """
    sizes = np.array([len(p) for p in patterns])
    blocks = -(-int(sizes.max()) // 64)
    one, all_bits = _U(1), ~_U(0)
    equal, rising = np.zeros((blocks, len(patterns), 128), _U), np.zeros((blocks, len(patterns)), _U)
    for i, pattern in enumerate(patterns):
        # Patterns end with the last block. What stands before them equals any character.
        before = 64 * blocks - len(pattern)
        at = before + np.arange(len(pattern))
        np.bitwise_or.at(equal[:, i], (at >> 6, _codes(pattern) & 127), one << (at & 63).astype(_U))
        full, part = before >> 6, _U(before & 63)
        equal[:full, i] = all_bits
        equal[full, i] |= (one << part) - one
        rising[full, i], rising[full + 1 :, i] = all_bits << part, all_bits
    equal = equal.reshape(blocks, -1)
    up, down = rising[:, own], np.zeros((blocks, len(own)), _U)
    score = sizes[own]
    least = score.copy()
    for j, n in enumerate(np.searchsorted(-length, -np.arange(length[0]), side="left").tolist()):
        if n < _FEW:
            least[:n] = 0
            break
        slot = (own[:n] << 7) + low[start[:n] + j]
        more = less = np.zeros(n, _U)
        for k in range(blocks):
            same, rise, fall = equal[k][slot], up[k, :n], down[k, :n]
            vertical = same | fall
            same |= less
            across = (((same & rise) + rise) ^ rise) | same
            higher, lower = fall | ~(across | rise), rise & across
            more, less, more_in, less_in = higher >> _U(63), lower >> _U(63), more, less
            higher, lower = higher << one | more_in, lower << one | less_in
            up[k, :n], down[k, :n] = lower | ~(vertical | higher), higher & vertical
        score[:n] += more.view(np.int64) - less.view(np.int64)
        np.minimum(least[:n], score[:n], out=least[:n])
    return least


class Leak(NamedTuple):
    row: int
    item_id: int | None
    start: int
    end: int
    distance: int
    similarity: float


class _Regions(NamedTuple):
    """Parts of the joined rows that may hold items."""

    row: np.ndarray
    item: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def merged(self) -> _Regions:
        """In order of row, item and place, those that overlap made one."""
        if len(self.row) == 0:
            return self
        order = np.lexsort((self.start, self.item, self.row))
        row, item, start, end = (x[order] for x in self)
        other = np.append(True, (row[1:] != row[:-1]) | (item[1:] != item[:-1]))
        # Ends of a group are put behind those of all groups before it.
        lift = np.cumsum(other) * (int(end.max()) + 1)
        reach = np.maximum.accumulate(end + lift) - lift
        new = np.flatnonzero(other | np.append(True, start[1:] > reach[:-1]))
        return _Regions(row[new], item[new], start[new], reach[np.append(new[1:], len(row)) - 1])


class Searcher:
    """Finds items in batches of texts."""

    def __init__(self, items: list[tuple[int | None, str | None]], edit_rate: float = EDIT_RATE,
                 recall: float = TARGET_RECALL):
        known = [(i, t) for i, t in ((i, _normal(t or "")) for i, t in items) if t]
        short = [t.count(" ") + 1 < LEAST_WORDS for _, t in known]
        # The spaces around a short item keep its first and last word whole.
        self.ids, self.texts = [i for i, _ in known], [f" {t} " if s else t for (_, t), s in zip(known, short)]
        self.sizes = np.array([len(t) for t in self.texts], np.int64)
        rates = [0 if s else edit_rate for s in short]
        self.most = np.array([int(r * n) for r, n in zip(rates, self.sizes)], np.int64)
        self.needed = self.sizes - _GRAM + 1 - _GRAM * self.most
        by_length: dict[int, dict[int, str]] = {}
        for i, text in enumerate(self.texts):
            by_length.setdefault(seed_length(len(text), rates[i], recall), {})[i] = text
        self.seeds = {n: _Seeds(of, n) for n, of in sorted(by_length.items())}
        self.grams = np.zeros((len(self.texts), 1 << _GRAM_BITS), bool)
        for i, text in enumerate(self.texts):
            self.grams[i, _buckets(_codes(text))[: len(text) - _GRAM + 1]] = True

    def find(self, texts: pa.Array) -> list[Leak]:
        """The best match of each item in each row that holds it; ties: the first."""
        if not self.seeds:
            return []
        raw = texts.to_pylist()
        rows = [f" {_normal(t)} " if t else "" for t in raw]
        joined = "\n".join(rows)
        codes = _codes(joined)
        first = np.cumsum([0, *(len(t) + 1 for t in rows)])
        regions = self._compared(codes, self._narrowed(codes, self._regions(codes, first)))
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for row, item, start, end in zip(*(x.tolist() for x in regions)):
            match = best_part(self.texts[item], joined[start:end], int(self.most[item]))
            if match and ((row, item) not in best or match[0] < best[row, item][0]):
                place, around = start - int(first[row]) - 1, int(self.texts[item][0] == " ")
                best[row, item] = match[0], match[1] + place + around, match[2] + place - around
        return [self._leak(raw[row], row, item, *best[row, item]) for row, item in sorted(best)]

    def _regions(self, codes: np.ndarray, first: np.ndarray) -> _Regions:
        """Where an occurrence around a seed can lie."""
        found = [_Regions(*np.zeros((4, 0), np.int64))]
        longest = max(self.seeds)
        for at in range(0, len(codes), _STEP):
            here = []
            for length, keys in _grams(codes[at : at + _STEP + longest], set(self.seeds)):
                seeds = self.seeds[length]
                place, seed = seeds.hits(keys[:_STEP])
                place += at
                item = seeds.owners[seed]
                row = np.searchsorted(first, place, side="right") - 1
                start = place - seeds.high[seed] - self.most[item]
                end = place - seeds.low[seed] + self.sizes[item] + self.most[item]
                start = np.maximum(start, first[row])
                end = np.minimum(end, first[row + 1] - 1)
                here.append(_Regions(row, item, start, end))
            found.append(_Regions(*map(np.concatenate, zip(*here))).merged())
        return _Regions(*map(np.concatenate, zip(*found))).merged()

    def _narrowed(self, codes: np.ndarray, regions: _Regions) -> _Regions:
        """The part of each region where enough runs of _GRAM characters are the item's.

        An occurrence with e edits lies in as many characters as the item has and e more,
        and has all such runs of the item but _GRAM for each edit.
        """
        grams = _buckets(codes)
        free = self.needed[regions.item] <= 0
        parts = [_Regions(*(x[free] for x in regions))]
        regions = _Regions(*(x[~free] for x in regions))
        bounds = np.cumsum(np.maximum(regions.end - regions.start - _GRAM + 1, 0))
        at = 0
        while at < len(bounds):
            done = bounds[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(bounds, done + _COUNTED, side="right")))
            parts.append(self._counted(grams, _Regions(*(x[at:to] for x in regions))))
            at = to
        return _Regions(*map(np.concatenate, zip(*parts)))

    def _counted(self, grams: np.ndarray, of: _Regions) -> _Regions:
        length = np.maximum(of.end - of.start - _GRAM + 1, 0)
        begin = np.concatenate([[0], np.cumsum(length)])
        owner = np.repeat(np.arange(len(length)), length)
        item = of.item[owner]
        place = np.arange(begin[-1]) + (of.start - begin[:-1])[owner]
        total = np.concatenate([[0], np.cumsum(self.grams[item, grams[place]])])
        window = (self.sizes + self.most - _GRAM + 1)[item]
        upto = np.minimum(np.arange(begin[-1]) + window, begin[1:][owner])
        enough = np.flatnonzero(total[upto] - total[:-1] >= self.needed[item])
        which, one = np.unique(owner[enough], return_index=True)
        last = np.append(one[1:], len(enough)) - 1
        end = place[enough[last]] + (self.sizes + self.most)[of.item[which]]
        return _Regions(of.row[which], of.item[which], place[enough[one]], np.minimum(end, of.end[which]))

    def _compared(self, codes: np.ndarray, of: _Regions) -> _Regions:
        """Without regions whose bound is above the edits allowed."""
        low = (codes & 127).astype(np.uint8)
        length = of.end - of.start
        order = np.argsort(-length, kind="stable")
        keep = np.ones(len(order), bool)
        for at in range(0, len(order), _BATCH):
            batch = order[at : at + _BATCH]
            items, own = np.unique(of.item[batch], return_inverse=True)
            least = least_distances([self.texts[i] for i in items], own, low, of.start[batch], length[batch])
            keep[batch] = least <= self.most[of.item[batch]]
        return _Regions(*(x[keep] for x in of))

    def _leak(self, text: str, row: int, item: int, distance: int, start: int, end: int) -> Leak:
        """A match in a normalised row, as whole words of the row itself."""
        spans = [m.span() for m in _WORD.finditer(text)]
        begins = np.cumsum([0, *(len(text[a:b].lower()) + 1 for a, b in spans)])
        head = int(np.searchsorted(begins, start, side="right")) - 1
        tail = int(np.searchsorted(begins, max(end - 1, start), side="right")) - 1
        return Leak(row, self.ids[item], spans[head][0], spans[tail][1], distance, 1 - distance / len(self.texts[item]))


def _blocks(benchmark: DataFrame, id_column: str, text_column: str) -> Iterator[list[tuple]]:
    """The items in blocks of about BLOCK_ITEMS, each small enough for every task."""
    items = benchmark.select(
        benchmark[id_column].cast("bigint").alias("item_id"), benchmark[text_column].alias("text")
    ).filter(F.col("text").isNotNull())
    blocks = max(1, -(-items.count() // BLOCK_ITEMS))
    for k in range(blocks):
        mine = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k
        rows = items.filter(mine).distinct().collect()
        yield sorted(((r.item_id, r.text) for r in rows), key=lambda x: (x[0] is not None, x))


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    edit_rate: float = EDIT_RATE,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
) -> DataFrame:
    """Rows (doc_id, item_id, start, end, distance, similarity): items within documents.

    One row for each document row and item with a match of at most edit_rate edits for each
    character, the best one; start and end are code points of the text, end exclusive. Null
    and empty texts hold nothing, null ids are kept, equal rows each give their own matches.
    Items with fewer than LEAST_WORDS words are found as whole words without edits only, items
    without text not at all; two items with one id are two items. No shuffle: each document is searched whole where it is read.
    """
    prepare(docs.sparkSession)
    schema = pa.schema([
        ("doc_id", pa.int64()), ("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()),
        ("distance", pa.int64()), ("similarity", pa.float64()),
    ])
    kinds = "doc_id bigint, item_id bigint, start bigint, end bigint, distance bigint, similarity double"
    own = docs.select(docs[id_column].cast("bigint").alias("doc_id"), docs[text_column].alias("text"))

    def search(searcher: Searcher):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in slices(batches, "text"):
                leaks = searcher.find(part.column("text"))
                ids = part.column("doc_id").to_pylist()
                rows = [(ids[x.row], *x[1:]) for x in leaks]
                columns = list(zip(*rows)) if rows else [[]] * len(schema)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema
                )

        return own.mapInArrow(run, kinds)

    found = None
    for block in _blocks(benchmark, item_column, "text"):
        part = search(Searcher(block, edit_rate))
        found = part if found is None else found.unionByName(part)
    return found


def drop_leaked(
    docs: DataFrame, benchmark: DataFrame, edit_rate: float = EDIT_RATE, text_column: str = "text",
    item_column: str = "item_id",
) -> DataFrame:
    """The rows of documents that hold no item (see find_leaks), with all their columns."""

    def clean(searcher: Searcher):
        def decide(part: pa.RecordBatch) -> np.ndarray:
            keep = np.ones(part.num_rows, bool)
            keep[[x.row for x in searcher.find(part.column(text_column))]] = False
            return keep

        return decide

    for block in _blocks(benchmark, item_column, "text"):
        docs = keep_rows(docs, text_column, clean(Searcher(block, edit_rate)))
    return docs
