"""Phrases that occur together more often than their parts would by chance, by language.

Frequent phrases are found length by length. A phrase can only be frequent if the phrases
without its last and without its first word are. The pass for one length notes which runs a
word longer it sees between such phrases, as far as a task knows them then, and how often;
what was noted often enough, and has a frequent beginning and end, is a candidate, so there
are no more candidates than the texts can fill. Candidates are put into double-array tries of bounded size,
which are broadcast; every task walks them from all positions of its texts at once and adds
up what it arrives at, and the sums of all tasks are added up.

A word is told apart by a 64-bit hash of language and word. Words of one hash are found out
while words are counted, and then all is counted anew with another hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakestay.llm.batches import as_bytes, prepare, slices
from lakestay.llm.components import stored
from lakestay.llm.double_array import DoubleArray, Places
from lakestay.llm.words import LOWER, mix, words
from lakestay.session import work_folders

LEAST_COUNT = 100
LONGEST = 5
BEST = 2000
# A candidate goes if a longer one has this percentage of its occurrences.
COVERED_PERCENT = 100
UNKNOWN = "und"

# Pairs of one trie, of longer candidates as many as have no more words; more take further
# tries, each with a pass over the texts.
TRIE_ROWS = 1 << 21
# Frequent words that are broadcast to look candidates over in the tasks that see them first;
# where there are more, joins alone do that.
MOST_WORDS = 1 << 22
# Distinct rows a task keeps before it passes them on.
KEPT_ROWS = 1 << 21
_BATCH = 1 << 16
# Bits of the filter of all candidates of a length, and those it has for each at least.
FILTER_BITS = 1 << 30
_FILTER_SHARE = 8

# What ends a piece of text.
BREAKS = b".,;:!?\n\x0b\x0c\r"

_BREAK = np.zeros(256, bool)
_BREAK[list(BREAKS)] = True
_FOLD = LOWER.copy()
_FOLD[list(BREAKS)] = 10
_KEY = 8  # bytes


def _tokens(batch: pa.RecordBatch, seed: int):
    """Words of a slice, their keys, the words from each to the end of its piece, and their rows."""
    found = words(batch.column("text"), _FOLD)
    langs = pc.fill_null(batch.column("lang"), UNKNOWN).dictionary_encode()
    marks = np.array(
        [int.from_bytes(hashlib.blake2b(x.encode("utf-8", "surrogatepass"), digest_size=8, salt=seed.to_bytes(8, "big")).digest(), "big")
         for x in langs.dictionary.to_pylist()], np.uint64,
    )
    row_mark = marks[langs.indices.to_numpy(zero_copy_only=False)] if len(marks) else np.empty(0, np.uint64)
    count = np.diff(found.first)
    keys = mix(found.hashes + np.repeat(row_mark, count))
    broken = np.concatenate([[0], np.cumsum(_BREAK[found.data])])
    n = len(keys)
    last = np.ones(n, bool)
    last[:-1] = broken[found.starts[1:]] > broken[found.ends[:-1]]
    last[found.first[1:][count > 0] - 1] = True
    stop = np.flatnonzero(last)
    room = np.repeat(stop, np.diff(np.append(-1, stop))) - np.arange(n) + 1
    return found, langs, keys, room


def _word_counts(docs: DataFrame, seed: int) -> DataFrame:
    """(key, lang, word, n), summed per task; a row without a word has all words of a language."""
    schema = "key binary, lang string, word string, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for part in slices(batches, "text"):
            found, langs, keys, _ = _tokens(part, seed)
            names = langs.dictionary
            row = np.repeat(np.arange(part.num_rows), np.diff(found.first))
            lang = langs.indices.to_numpy(zero_copy_only=False)
            distinct, first, place, count = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
            other = _others(found, lang[row], first[place])
            if len(other):  # a second word of a key, to be found out below
                distinct, first = np.append(distinct, keys[other]), np.append(first, other)
                count = np.append(count, np.zeros(len(other), np.int64))
            total = np.bincount(lang[row], minlength=len(names)) if len(row) else np.zeros(len(names), np.int64)
            held.append(pa.table({
                "key": pa.chunked_array([_binary(distinct[:, None]), pa.nulls(len(names), pa.binary())]),
                "lang": pa.chunked_array([langs.dictionary.take(pa.array(lang[row[first]])), langs.dictionary]),
                "word": pa.chunked_array([_texts(found, first), pa.nulls(len(names), pa.string())]),
                "n": pa.array(np.concatenate([count, total]).astype(np.int64)),
            }))
            size += held[-1].num_rows
            if size > KEPT_ROWS:
                held = [_grouped(held)]
                size = held[0].num_rows
                if size > KEPT_ROWS // 2:
                    yield from held[0].to_batches()
                    held, size = [], 0
        if held:
            yield from _grouped(held).to_batches()

    return docs.mapInArrow(run, schema)


def _texts(found, places: np.ndarray) -> pa.Array:
    """The words at some places, folded."""
    size = found.ends[places] - found.starts[places]
    offsets = np.append(0, np.cumsum(size))
    data = _FOLD[found.data[np.repeat(found.starts[places] - offsets[:-1], size) + np.arange(offsets[-1])]]
    return pa.Array.from_buffers(pa.string(), len(places), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])


def _others(found, lang: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Places of words that differ from the one said to be the same, in language or in bytes."""
    data, size = _FOLD[found.data], found.ends - found.starts
    differ = (lang != lang[same]) | (size != size[same])
    like = np.flatnonzero(~differ & (same != np.arange(len(same))))
    begin = np.cumsum(size[like]) - size[like]
    inside = np.arange(int(size[like].sum())) - np.repeat(begin, size[like])
    unlike = data[np.repeat(found.starts[like], size[like]) + inside] != data[np.repeat(found.starts[same[like]], size[like]) + inside]
    if unlike.any():
        differ[like[np.searchsorted(begin, np.flatnonzero(unlike), side="right") - 1]] = True
    return np.flatnonzero(differ)


def _grouped(held: list[pa.Table]) -> pa.Table:
    summed = pa.concat_tables(held).group_by(["key", "lang", "word"], use_threads=False).aggregate([("n", "sum")])
    return summed.select(["key", "lang", "word", "n_sum"]).rename_columns(["key", "lang", "word", "n"])


def _binary(keys: np.ndarray) -> pa.Array:
    """Rows of word keys as bytes, a column of 8 bytes a word."""
    width = _KEY * keys.shape[1]
    data = np.ascontiguousarray(keys, ">u8").tobytes()
    offsets = np.arange(0, (len(keys) + 1) * width, max(width, 1), np.int32)
    return pa.Array.from_buffers(pa.binary(), len(keys), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _keys(column: pa.ChunkedArray, length: int) -> np.ndarray:
    """Rows of word keys from their bytes."""
    rows = [as_bytes(chunk)[0].view(">u8").astype(np.uint64) for chunk in column.chunks]
    return np.concatenate([np.empty(0, np.uint64), *rows]).reshape(-1, length)


class _Seen:
    """Runs a word longer that a task has seen, as pairs of a prefix and a word, and how often."""

    def __init__(self):
        self._clear()

    def _clear(self) -> None:
        self.codes, self.counts, self.size = [], [], 0

    def add(self, codes: np.ndarray) -> None:
        own, count = np.unique(codes, return_counts=True)
        self.codes.append(own)
        self.counts.append(count)
        self.size += len(own)
        if self.size > 2 * KEPT_ROWS:
            codes, counts = self._summed()
            self.codes, self.counts, self.size = [codes], [counts], len(codes)

    def _summed(self) -> tuple[np.ndarray, np.ndarray]:
        codes, place = np.unique(np.concatenate(self.codes), return_inverse=True)
        counts = np.bincount(place, weights=np.concatenate(self.counts), minlength=len(codes))
        return codes, counts.astype(np.int64)

    def full(self) -> bool:
        return self.size > KEPT_ROWS and len(self.codes) == 1

    def take(self, phrases: Callable[[np.ndarray], np.ndarray]) -> Iterator[pa.RecordBatch]:
        """What was seen since the last time; phrases makes rows of word keys of codes."""
        if not self.codes:
            return
        codes, counts = self._summed()
        self._clear()
        for a in range(0, len(codes), _BATCH):
            at = slice(a, a + _BATCH)
            yield pa.RecordBatch.from_arrays([_binary(phrases(codes[at])), pa.array(counts[at])], ["phrase", "n"])


class _Filter:
    """All candidates of a length in little room; it takes a few other phrases for candidates too."""

    def __init__(self, count: int):
        self.last = np.uint64(min(FILTER_BITS, max(64, 1 << (_FILTER_SHARE * count - 1).bit_length())) - 1)
        self.bits = np.zeros((int(self.last) + 1) >> 3, np.uint8)

    def _places(self, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        mixed = np.zeros(len(rows), np.uint64)
        for k in range(rows.shape[1]):
            mixed = mix(mixed + rows[:, k])
        for place in (mixed & self.last, (mixed >> np.uint64(32)) & self.last):
            yield (place >> np.uint64(3)).astype(np.int64), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8)

    def add(self, rows: np.ndarray) -> None:
        for at, bit in self._places(rows):
            np.bitwise_or.at(self.bits, at, bit)

    def has(self, rows: np.ndarray) -> np.ndarray:
        (a, x), (b, y) = self._places(rows)
        return (self.bits[a] & x != 0) & (self.bits[b] & y != 0)


def _numbered(keys: np.ndarray, frequent: Places | None) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of words, -1 for infrequent ones, and the keys they number.

    Without a list of the frequent words all words of the slice count as frequent."""
    if frequent is None:
        table, number = np.unique(keys, return_inverse=True)
        return number.astype(np.int64), table
    return frequent(keys), frequent.keys


def _pairs(docs: DataFrame, seed: int, frequent) -> DataFrame:
    """Pairs of frequent words as _Seen passes them on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if frequent is None else frequent.value
        seen = _Seen()
        table = None if known is None else known.keys

        def phrases(codes):
            return np.column_stack([table[codes >> 32], table[codes & 0xFFFFFFFF]])

        for part in slices(batches, "text"):
            _, _, keys, room = _tokens(part, seed)
            number, table = _numbered(keys, known)
            at = np.flatnonzero((room[:-1] > 1) & (number[:-1] >= 0) & (number[1:] >= 0)) if len(keys) else np.empty(0, np.int64)
            seen.add(number[at] << 32 | number[at + 1])
            if known is None or seen.full():
                yield from seen.take(phrases)
        yield from seen.take(phrases)

    return docs.mapInArrow(run, "phrase binary, n long")


def _counted(docs: DataFrame, seed: int, trie, frequent, longest: int, others) -> DataFrame:
    """(phrase, n) summed per task for the phrases of a trie, and the phrases a word longer as
    _Seen passes them on. others: a filter of all candidates of its length, if the trie has
    not all of them."""
    whole = others is None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array, among = trie.value, None if whole else others.value
        known = None if frequent is None else frequent.value
        depth, total = array.depth, np.zeros(len(array.rows), np.int64)
        seen, table = _Seen(), array.words if whole or known is None else known.keys

        def phrases(codes):
            return np.column_stack([array.rows[codes >> 32], table[codes & 0xFFFFFFFF]])

        for part in slices(batches, "text"):
            _, _, keys, room = _tokens(part, seed)
            number = array.number(keys)
            at, row = array.walk(number, room)
            np.add.at(total, row, 1)
            if depth == longest:
                continue
            more = room[at] > depth
            if whole:  # the phrase from the next word on has to be a candidate too
                begins = np.zeros(len(keys) + 1, bool)
                begins[at] = True
                more &= begins[at + 1]
                last = number - 1
            else:
                last, table = _numbered(keys, known)
                more[more] &= last[at[more] + depth] >= 0
                more[more] &= among.has(keys[at[more][:, None] + np.arange(1, depth + 1)])
            seen.add(row[more] << 32 | last[at[more] + depth])
            if (known is None and not whole) or seen.full():
                yield from seen.take(phrases)
        yield from seen.take(phrases)
        found = np.flatnonzero(total)
        for a in range(0, len(found), _BATCH):
            rows = found[a : a + _BATCH]
            yield pa.RecordBatch.from_arrays([_binary(array.rows[rows]), pa.array(total[rows])], ["phrase", "n"])

    return docs.mapInArrow(run, "phrase binary, n long")


def _part(first: int, words: int):
    """Some words of a phrase."""
    return F.substring("phrase", _KEY * first + 1, _KEY * words)


def _kept(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _vocabulary(docs: DataFrame, folder: str, least: int) -> tuple[DataFrame, int]:
    """Frequent words and, with a null key, all words of each language; and the hash's seed."""
    for seed in range(8):
        named = F.struct("lang", "word")
        # Rows of totals have no key; they group by language.
        found = (
            _word_counts(docs, seed)
            .groupBy("key", F.when(F.col("key").isNull(), F.col("lang")).alias("of"))
            .agg(F.min(named).alias("first"), F.max(named).alias("other"), F.sum("n").alias("n"))
            .filter((F.col("n") >= least) | F.col("key").isNull())
            .select("key", "first.lang", "first.word", "n", (F.col("first") != F.col("other")).alias("mixed"))
        )
        found = _kept(found, f"{folder}/words-{seed}")
        if not found.filter("key is not null and mixed").limit(1).count():
            return found.drop("mixed"), seed
    raise RuntimeError("no hash tells all words apart")


def frequent_phrases(
    docs: DataFrame, folder: str, least: int = LEAST_COUNT, longest: int = LONGEST,
    trie_rows: int = TRIE_ROWS, most_words: int = MOST_WORDS,
) -> tuple[DataFrame, DataFrame]:
    """(phrase, a) of all phrases of up to longest words with a count of at least least, and
    the frequent words (key, lang, word, n) with each language's total under a null key.

    docs has text and lang. A phrase is the 8-byte keys of its words; tables are written
    below folder.
    """
    spark = docs.sparkSession
    vocabulary, seed = _vocabulary(docs, folder, least)
    frequent_words = vocabulary.filter("key is not null")
    frequent = None
    if frequent_words.count() <= most_words:
        keys = _keys(frequent_words.select("key").toArrow().column("key"), 1)[:, 0]
        frequent = spark.sparkContext.broadcast(Places(np.sort(keys)))
    known = [frequent_words.select(F.col("key").alias("phrase"), F.col("n").alias("a"))]
    seen = _pairs(docs, seed, frequent)
    for length in range(2, longest + 1):
        shorter = known[-1].select(F.col("phrase").alias("part"))
        new = seen.filter(F.length("phrase") == _KEY * length).groupBy("phrase").agg(F.sum("n").alias("n"))
        new = new.filter(F.col("n") >= least).select("phrase")
        for first in (0, 1):
            new = new.join(shorter, _part(first, length - 1) == F.col("part"), "left_semi")
        new = _kept(new, f"{folder}/candidates-{length}")
        total = new.count()
        tries = -(-total * length // (2 * trie_rows))
        if not tries:
            break
        parts = [new if tries == 1 else new.filter(F.pmod(F.xxhash64("phrase"), F.lit(tries)) == i) for i in range(tries)]
        others = None
        if tries > 1 and length < longest:
            among = _Filter(total)
            for own in parts:
                among.add(_keys(own.toArrow().column("phrase"), length))
            others = spark.sparkContext.broadcast(among)
        counts = []
        for i, own in enumerate(parts):
            rows = _keys(own.toArrow().column("phrase"), length)
            if not len(rows):
                continue
            trie = spark.sparkContext.broadcast(DoubleArray(rows))
            passed = _counted(docs, seed, trie, frequent, longest, others)
            counts.append(_kept(passed, f"{folder}/counts-{length}-{i}"))
            trie.unpersist()
        if others is not None:
            others.unpersist()
        seen = counts[0]
        for other in counts[1:]:
            seen = seen.unionByName(other)
        found = seen.filter(F.length("phrase") == _KEY * length).groupBy("phrase").agg(F.sum("n").alias("a")).filter(F.col("a") >= least)
        known.append(_kept(found, f"{folder}/phrases-{length}"))
    if frequent is not None:
        frequent.unpersist()
    all_phrases = known[0]
    for more in known[1:]:
        all_phrases = all_phrases.unionByName(more)
    return all_phrases, vocabulary


def scored(phrases: DataFrame, vocabulary: DataFrame, covered_percent: int = COVERED_PERCENT) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of all candidates no longer one stands for.

    Whether a longer phrase stands for one is decided among those a word longer: a phrase
    between two others has a count between theirs. Products are decimals of 38 digits.
    """
    length = (F.length("phrase") / _KEY).cast("int")
    longer = phrases.filter(length > 2).select(
        F.explode(F.array(_part(0, length - 1), _part(1, length - 1))).alias("phrase"), F.col("a").alias("longer")
    )
    longer = longer.groupBy("phrase").agg(F.max("longer").alias("longer"))
    kept = phrases.filter(length > 1).join(longer, "phrase", "left")
    whole = F.lit(100).cast("decimal(3,0)")
    kept = kept.filter(
        F.col("longer").isNull() | (whole * F.col("longer") < F.lit(covered_percent).cast("decimal(3,0)") * F.col("a"))
    )
    words = vocabulary.filter("key is not null")
    totals = vocabulary.filter("key is null").select("lang", F.col("n").cast("decimal(19,0)").alias("n"))
    kept = kept.drop("longer").join(words.select(F.col("key").alias("_first"), "lang"), _part(0, 1) == F.col("_first"))
    kept = kept.join(F.broadcast(totals) if _few(totals) else totals, "lang").drop("_first")
    cuts = kept.withColumn("cut", F.explode(F.sequence(F.lit(1), length - 1)))
    cuts = cuts.withColumns({"head": _part(0, F.col("cut")), "rest": _part(F.col("cut"), length - F.col("cut"))})
    exact = F.col("a").cast("decimal(19,0)")
    cuts = cuts.join(phrases.select(F.col("phrase").alias("head"), exact.alias("l")), "head")
    cuts = cuts.join(phrases.select(F.col("phrase").alias("rest"), exact.alias("r")), "rest")
    score = F.expr("(cast(1000 as decimal(4,0)) * cast(a as decimal(17,0)) * cast(n as decimal(17,0))) div (l * r)")
    best = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("best")
    return cuts.groupBy("lang", "phrase", "a", "n").agg(best).select(
        "lang", "phrase", "a", F.col("best.l").cast("long").alias("l"), F.col("best.r").cast("long").alias("r"),
        F.col("n").cast("long").alias("n"), "best.score",
    )


def _few(totals: DataFrame) -> bool:
    """Whether there are few enough languages to send their totals to all tasks."""
    return totals.limit(10_001).count() <= 10_000


def named(phrases: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """The phrases as text, their words joined by spaces."""
    words = vocabulary.filter("key is not null").select("key", "word")
    length = (F.length("phrase") / _KEY).cast("int")
    place = phrases.select("phrase", F.explode(F.sequence(F.lit(0), length - 1)).alias("place"))
    text = (
        place.withColumn("key", _part(F.col("place"), F.lit(1))).join(words, "key")
        .groupBy("phrase").agg(F.sort_array(F.collect_list(F.struct("place", "word"))).alias("words"))
        .select(F.col("phrase").alias("key"), F.array_join(F.col("words.word"), " ").alias("text"))
    )
    return phrases.join(text, F.col("phrase") == F.col("key")).drop("phrase", "key").withColumnRenamed("text", "phrase")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST_COUNT, longest: int = LONGEST,
    best: int = BEST, covered_percent: int = COVERED_PERCENT, trie_rows: int = TRIE_ROWS, most_words: int = MOST_WORDS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of 2 to longest words.

    A null text is empty, a null language counts as und. Languages without a frequent phrase
    have no rows, an empty table gives none. Other columns don't matter.
    """
    spark: SparkSession = prepare(docs.sparkSession)
    docs = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    with work_folders(spark, "collocations") as (folder,):
        phrases, vocabulary = frequent_phrases(docs, folder, least, longest, trie_rows, most_words)
        # Ties with the last place stay until the text decides.
        by_score = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
        found = scored(phrases, vocabulary, covered_percent).withColumn("_rank", F.rank().over(by_score))
        found = _kept(found.filter(F.col("_rank") <= best).drop("_rank"), f"{folder}/scored")
        by_text = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
        ranked = named(found, vocabulary).withColumn("rank", F.row_number().over(by_text).cast("long"))
        return stored(
            ranked.filter(F.col("rank") <= best).select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "phrases"
        )
