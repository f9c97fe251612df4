"""Token ids of whole texts by a SentencePiece BPE model, and texts from ids.

The library merges the pair of best score of a whole text, leftmost among equals, one at a
time. Where no piece goes on from another character into a space mark, merges of one word
never touch another word, so all words are merged at once: flat arrays hold the symbols of
all words, each round finds the least pair rank of every word and its leftmost place, merges
there in all words together and drops the words in which no pair is left. Where no piece of
better rank begins or ends with the merged one, no pair a merge makes can come before other
pairs of the same rank, and all of them in a word are merged in one round.

Words repeat, so each is merged once per worker; words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from lakestay.llm.batches import as_bytes, prepare, slices
from lakestay.llm.tokens import KEPT_PIECES, _Store, vocabulary_path
from lakestay.llm.words import _BASE as BASE
from lakestay.llm.words import _LETTER, _powers, mix

PIECES = "piece_bpe_32k.model"
MARK = "▁"
_NONE = np.iinfo(np.int32).max
_SPACE = 32
_BASE = np.uint64(BASE)
# Bytes hashed at once: powers are kept for as many.
_SPAN = 1 << 18


class Model:
    """The tables of a BPE model file with byte fallback and no normalisation.

    ValueError for a model of another kind, with pieces of the user's own, or with pieces
    that hold a space mark after another character.
    """

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        spec = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            spec.ParseFromString(file.read())
        kinds = spec.SentencePiece
        normal = spec.normalizer_spec
        pieces = {p.piece: i for i, p in enumerate(spec.pieces) if p.type == kinds.NORMAL}
        plain = not normal.precompiled_charsmap and normal.escape_whitespaces and not normal.remove_extra_whitespaces
        if (
            spec.trainer_spec.model_type != spec.trainer_spec.BPE
            or not (plain and normal.add_dummy_prefix and spec.trainer_spec.byte_fallback)
            or spec.trainer_spec.treat_whitespace_as_suffix
            or spec.denormalizer_spec.precompiled_charsmap
            or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in spec.pieces)
            or any(MARK in p.lstrip(MARK) for p in pieces)
        ):
            raise ValueError(f"{path}: only BPE with byte fallback, a dummy prefix and no normalisation")
        self.size = len(spec.pieces)
        self.bos, self.eos = spec.trainer_spec.bos_id, spec.trainer_spec.eos_id
        self.byte_ids = np.zeros(256, np.int32)
        self.is_byte = np.zeros(self.size, bool)
        for i, p in enumerate(spec.pieces):
            if p.type == kinds.BYTE:
                self.byte_ids[int(p.piece[3:5], 16)] = i
                self.is_byte[i] = True
        self._pairs(pieces, np.array([p.score for p in spec.pieces], np.float32))
        self._texts(spec, kinds)

    def _pairs(self, pieces: dict[str, int], scores: np.ndarray) -> None:
        """Merged piece and rank by pair of symbols. Symbols are piece ids and, beyond them,
        characters that only stand inside pieces."""
        letters = dict.fromkeys(c for p in pieces for c in p)
        extra = {c: self.size + k for k, c in enumerate(c for c in letters if c not in pieces)}
        symbol = pieces | extra
        self.letter_codes = np.array(sorted(ord(c) for c in letters), np.int64)
        self.letter_symbols = np.array([symbol[chr(c)] for c in self.letter_codes], np.int64)
        self.symbols = self.size + len(extra)
        _, rank = np.unique(-scores, return_inverse=True)
        shared = np.bincount(rank[list(pieces.values())], minlength=self.size) > 1
        self.alone = np.zeros(self.size, bool)  # by rank: all its pairs may merge at once
        self.alone[rank[list(pieces.values())]] = True
        self.alone[: len(shared)][shared[: self.size]] = False
        keys, merged = [], []
        for piece, i in pieces.items():
            for cut in range(1, len(piece)):
                left, right = symbol.get(piece[:cut]), symbol.get(piece[cut:])
                if left is not None and right is not None:
                    keys.append(left * self.symbols + right)
                    merged.append(i)
                for part in (left, right):
                    if part is not None and part < self.size and rank[part] >= rank[i]:
                        self.alone[rank[part]] = False
        order = np.argsort(np.array(keys, np.int64))
        self.pair_keys = np.append(np.array(keys, np.int64)[order], np.iinfo(np.int64).max)
        self.pair_merged = np.append(np.array(merged, np.int64)[order], 0)
        self.pair_rank = np.append(rank[self.pair_merged[:-1]], _NONE).astype(np.int32)
        self._parts(pieces, symbol)
        # ASCII bytes in no piece but their own: a cut on both sides changes no merge.
        self.lone = np.zeros(256, bool)
        self.lone[:128] = True
        self.lone[[ord(c) for p in pieces if len(p) > 1 for c in p if ord(c) < 128] + [_SPACE]] = False

    def _parts(self, pieces: dict[str, int], symbol: dict[str, int]) -> None:
        """Hashes of all parts of pieces, and those of symbols to put together."""
        longest = max(map(len, pieces))
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(longest, _BASE)]))

        def hashes(texts: list[str], parts: bool) -> list[np.ndarray]:
            size = np.array([len(t) for t in texts])
            codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
            codes, begin = mix(codes.astype(np.uint64) + np.uint64(1)), np.cumsum(size) - size
            room = np.repeat(begin + size, size) - np.arange(len(codes))  # characters from here on
            rolled, out = np.zeros(len(codes), np.uint64), []
            for k in range(longest):
                on = np.flatnonzero(room > k)
                rolled[on] = rolled[on] * _BASE + codes[on + k]
                out.append(rolled[on] if parts else rolled[begin[size == k + 1]])
            return out

        self.parts = np.unique(np.concatenate(hashes(list(pieces), True)))
        texts = sorted(symbol, key=len)
        where = np.array([symbol[t] for t in texts])
        self.symbol_hash = np.zeros(self.symbols, np.uint64)
        self.symbol_hash[where] = np.concatenate(hashes(texts, False))
        self.symbol_shift = np.ones(self.symbols, np.uint64)
        self.symbol_shift[where] = powers[[len(t) for t in texts]]

    def _texts(self, spec, kinds) -> None:
        """The bytes each id stands for, in one pool."""
        texts = []
        for p in spec.pieces:
            if p.type == kinds.BYTE:
                texts.append(bytes([int(p.piece[3:5], 16)]))
            elif p.type == kinds.NORMAL:
                texts.append(p.piece.replace(MARK, " ").encode())
            else:
                texts.append(spec.trainer_spec.unk_surface.encode() if p.type == kinds.UNKNOWN else b"")
        self.text_first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        self.text_pool = np.frombuffer(b"".join(texts), np.uint8)
        self.control = np.array([p.type == kinds.CONTROL for p in spec.pieces])
        self.spaced = np.array([p.type == kinds.NORMAL and p.piece.startswith(MARK) for p in spec.pieces])


    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Places in the pair table, its last place for pairs that don't merge."""
        key = left * self.symbols + right
        key[(left < 0) | (right < 0)] = -1
        at = np.searchsorted(self.pair_keys, key)
        at[self.pair_keys[at] != key] = len(self.pair_keys) - 1
        return at

    def first_symbols(self, codes: np.ndarray) -> np.ndarray:
        """The symbol of each character; -1 - c for a character c that no piece holds."""
        at = np.minimum(np.searchsorted(self.letter_codes, codes), len(self.letter_codes) - 1)
        return np.where(self.letter_codes[at] == codes, self.letter_symbols[at], -1 - codes)

    def merge(self, codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, word by word, and where each word's begin.

        codes holds the characters of all words, word i from first[i] on; no word is empty.
        """
        symbols, place = self.first_symbols(codes), np.arange(len(codes))
        last = np.zeros(len(codes), bool)  # whether a segment ends with this symbol
        last[np.append(first[1:], len(codes)) - 1] = True
        pair = self._paired(symbols, last, place)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            starts = np.flatnonzero(np.append(True, last[:-1]))
            rank = self.pair_rank[pair]
            least = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(symbols)))
            going = np.repeat(least < _NONE, sizes)
            if not going.all():
                done.append((place[~going], symbols[~going]))
                symbols, place, last, pair, rank = (x[going] for x in (symbols, place, last, pair, rank))
                sizes, least = sizes[least < _NONE], least[least < _NONE]
                if not len(symbols):
                    break
            hits = np.flatnonzero(rank == np.repeat(least, sizes))
            segment = np.cumsum(last)[hits] - last[hits]
            lead = np.append(True, segment[1:] != segment[:-1])
            # Of pairs in a row, each sharing a symbol with the next, every other one merges.
            run = np.append(True, hits[1:] != hits[:-1] + 1) | lead
            run_start = np.maximum.accumulate(np.where(run, np.arange(len(hits)), 0))
            even = (np.arange(len(hits)) - run_start) % 2 == 0
            hits = hits[lead | (even & self.alone[rank[hits]])]
            symbols[hits] = self.pair_merged[pair[hits]]
            last[hits] = last[hits + 1]
            keep = np.ones(len(symbols), bool)
            keep[hits + 1] = False
            moved = np.cumsum(keep) - 1
            symbols, place, last, pair = symbols[keep], place[keep], last[keep], pair[keep]
            changed = moved[hits]
            changed = np.unique(np.concatenate([changed, changed[changed > 0] - 1]))
            pair[changed] = self._paired(symbols, last, changed)
        place = np.concatenate([w for w, _ in done]) if done else np.empty(0, np.int64)
        symbols = np.concatenate([s for _, s in done]) if done else np.empty(0, np.int64)
        order = np.argsort(place)
        word = np.searchsorted(first, place[order], side="right") - 1
        return self._ids(symbols[order], word, len(first))

    def _paired(self, symbols: np.ndarray, last: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Places in the pair table of the symbols at some positions and their next ones.

        A segment ends between two symbols that no piece holds side by side: whatever is
        merged later takes symbols whole, so nothing will ever be merged across. This keeps
        segments of long words short.
        """
        inner = at[~last[at]]
        left, right = symbols[inner], symbols[inner + 1]
        found = self.lookup(left, right)
        check = np.flatnonzero(self.pair_rank[found] == _NONE)
        key = self.symbol_hash[left[check]] * self.symbol_shift[right[check]] + self.symbol_hash[right[check]]
        there = np.searchsorted(self.parts, key)
        apart = (left[check] < 0) | (right[check] < 0) | (self.parts[np.minimum(there, len(self.parts) - 1)] != key)
        last[inner[check[apart]]] = True
        out = np.full(len(at), len(self.pair_keys) - 1)
        out[~last[at]] = found[~last[inner]]
        return out

    def _ids(self, symbols: np.ndarray, word: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece as the ids of their bytes."""
        odd = np.flatnonzero((symbols < 0) | (symbols >= self.size))
        count = np.bincount(word, minlength=words)
        if not len(odd):
            return symbols.astype(np.uint32), np.append(0, np.cumsum(count))
        inside = dict(zip(self.letter_symbols.tolist(), self.letter_codes.tolist()))
        own = [chr(-1 - s if s < 0 else inside[s]).encode("utf-8", "surrogatepass") for s in symbols[odd].tolist()]
        size = np.ones(len(symbols), np.int64)
        size[odd] = [len(x) for x in own]
        out = np.repeat(symbols, size)
        begin = np.cumsum(size) - size
        places = np.concatenate([np.arange(b, b + len(x)) for b, x in zip(begin[odd].tolist(), own)])
        out[places] = self.byte_ids[np.frombuffer(b"".join(own), np.uint8)]
        count = np.bincount(word, weights=size, minlength=words).astype(np.int64)
        return out.astype(np.uint32), np.append(0, np.cumsum(count))


class Pieces:
    """Encodes and decodes batches of texts; keeps the ids of words it has seen."""

    def __init__(self, path: str):
        self.model = Model(path)
        self.store = _Store()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, without begin and end, and where each text's begin."""
        data, offsets = _prefixed(texts)
        lone = self.model.lone[data]
        cut = lone.copy()
        cut[1:] |= lone[:-1]
        space = data == _SPACE
        cut[1:] |= space[1:] & ~space[:-1]
        cut[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        pieces = self._words(data, starts, ends)
        ids, begin = self.store.gather(pieces)
        return ids, begin[np.searchsorted(starts, offsets)]

    def _words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The place of each word in the store; new words are merged first."""
        keys = _hashes(data, starts, ends)
        keys[keys == 0] = 1
        pieces = self.store.find(keys)
        missing = np.flatnonzero(pieces < 0)
        if not len(missing):
            return pieces
        if self.store.count + len(missing) > KEPT_PIECES:
            self.store.clear()
            missing = np.arange(len(keys))
        new, one = np.unique(keys[missing], return_index=True)
        one = missing[one]
        text = data.tobytes()
        own = [text[a:b].decode("utf-8", "replace").replace(" ", MARK) for a, b in zip(starts[one].tolist(), ends[one].tolist())]
        first = np.cumsum([0, *map(len, own)])[:-1]
        codes = np.frombuffer("".join(own).encode("utf-32-le"), np.uint32).astype(np.int64)
        ids, begin = self.model.merge(codes, first)
        self.store.put(new, self.store.add(ids, np.diff(begin)))
        return self.store.find(keys)

    def decode(self, ids: np.ndarray, first: np.ndarray) -> list[str]:
        """The texts of rows of ids; row i is ids[first[i]:first[i + 1]]."""
        model = self.model
        size = model.text_first[ids + 1] - model.text_first[ids]
        # The space of the dummy prefix goes: that of the first id that is not a control id.
        row = np.repeat(np.arange(len(first) - 1), np.diff(first))
        real = np.flatnonzero(~model.control[ids])
        lead = real[np.append(True, row[real[1:]] != row[real[:-1]])] if len(real) else real
        skip = np.zeros(len(ids), np.int64)
        skip[lead[model.spaced[ids[lead]]]] = 1
        begin = np.concatenate([[0], np.cumsum(size - skip)])
        shift = np.repeat(model.text_first[ids] + skip - begin[:-1], size - skip)
        text = model.text_pool[np.arange(begin[-1]) + shift].tobytes()
        out = []
        for r, (a, b) in enumerate(zip(begin[first[:-1]].tolist(), begin[first[1:]].tolist())):
            try:
                out.append(text[a:b].decode())
            except UnicodeDecodeError:
                at = slice(first[r], first[r + 1])
                out.append(self._mended(ids[at], begin[first[r] : first[r + 1] + 1], text))
        return out

    def _mended(self, ids: np.ndarray, begin: np.ndarray, text: bytes) -> str:
        """A row whose byte ids are not UTF-8: every byte that begins no character becomes U+FFFD."""
        out, run = [], b""
        for i, a, b in zip(ids.tolist(), begin[:-1].tolist(), begin[1:].tolist()):
            if self.model.is_byte[i]:
                run += text[a:b]
                continue
            out += [_characters(run), text[a:b].decode()]
            run = b""
        return "".join([*out, _characters(run)])


def _characters(run: bytes) -> str:
    out, at = [], 0
    while at < len(run):
        for size in (1, 2, 3, 4):
            try:
                out.append(run[at : at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


def _prefixed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the texts, a space before each that is not empty, space marks as spaces."""
    data, offsets = as_bytes(texts)
    raw, mark = data.tobytes(), MARK.encode()
    if mark in raw:
        rows = [raw[a:b].replace(mark, b" ") for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in rows])]).astype(np.int64)
        data = np.frombuffer(b"".join(rows), np.uint8)
    filled = np.diff(offsets) > 0
    moved = offsets + np.concatenate([[0], np.cumsum(filled)])
    out = np.full(len(data) + int(filled.sum()), _SPACE, np.uint8)
    shift = np.repeat(np.cumsum(filled), np.diff(offsets))
    out[np.arange(len(data)) + shift] = data
    return out, moved


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words that cover the data without gaps."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        end = max(at + 1, int(np.searchsorted(ends, starts[at] + _SPAN, side="right")))
        a, b = int(starts[at]), int(ends[end - 1])
        up, down = _powers(b - a)
        summed = np.zeros(b - a + 1, np.uint64)
        np.cumsum(_LETTER[data[a:b]] * up, out=summed[1:])
        out[at:end] = mix((summed[ends[at:end] - a] - summed[starts[at:end] - a]) * down[starts[at:end] - a])
        at = end
    return out


_models: dict[str, Pieces] = {}


def pieces_of(name: str) -> Pieces:
    """The encoder of a model, made once per worker."""
    if name not in _models:
        _models[name] = Pieces(vocabulary_path(name))
    return _models[name]


def encode(docs: DataFrame, text: str = "text", out: str = "ids", model: str = PIECES, ends: bool = True) -> DataFrame:
    """The documents with their ids, little-endian unsigned 32-bit numbers, in place of their text.

    With ends, the model's begin and end ids stand around them. A null or empty text has no
    ids of its own. All other columns stay; a column named out is replaced. Each text is
    encoded whole and no row moves to another task.
    """
    prepare(docs.sparkSession)
    kept = [f for f in docs.schema.fields if f.name not in (text, out)]
    schema = StructType([*kept, StructField(out, BinaryType())])
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces_of(model)
        head = np.array([own.model.bos] if ends else [], "<u4").tobytes()
        tail = np.array([own.model.eos] if ends else [], "<u4").tobytes()
        for part in slices(batches, text):
            ids, first = own.encode(part.column(text))
            raw, first = ids.astype("<u4").tobytes(), (4 * first).tolist()
            coded = [head + raw[a:b] + tail for a, b in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays(
                [*[part.column(n) for n in names], pa.array(coded, pa.binary())], [*names, out]
            )

    return docs.select(*names, text).mapInArrow(run, schema)


def decode(coded: DataFrame, ids: str = "ids", out: str = "text", model: str = PIECES) -> DataFrame:
    """The rows with the text of their ids as a further column; null ids give an empty text.

    Control ids stand for nothing, byte ids that are not UTF-8 for U+FFFD each. An id the
    model does not have is an error. A column named out is replaced.
    """
    prepare(coded.sparkSession)
    kept = [f for f in coded.schema.fields if f.name != out]
    schema = StructType([*kept, StructField(out, StringType())])
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces_of(model)
        for part in slices(batches, ids):
            data, offsets = as_bytes(part.column(ids))
            numbers = np.frombuffer(data.tobytes(), "<u4").astype(np.int64)
            if len(numbers) and numbers.max() >= own.model.size:
                raise ValueError(f"no id {numbers.max()} in {model}")
            texts = own.decode(numbers, offsets // 4)
            yield pa.RecordBatch.from_arrays(
                [*[part.column(n) for n in names], pa.array(texts, pa.string())], [*names, out]
            )

    return coded.select(*names).mapInArrow(run, schema)
