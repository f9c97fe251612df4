"""Token ids of whole texts by the tokenizers library.

Splitting a text is far cheaper than merging its pieces, and pieces repeat. So texts are
cut where the tokenizer itself always cuts, the library encodes each piece new to a
worker, many in one call, and ids are gathered from what it gave. The ids are those of
the whole text encoded at once. Pieces are told apart by 64-bit hashes. A text the cutting
rules don't cover, one that holds an added token such as <|endoftext|>, or a vocabulary of
another kind, is given to the library as it is.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lakestay.llm.batches import as_bytes
from lakestay.llm.words import LOWER, SAME, looked_up, mix, words

BYTE_VOCABULARY = "byte_bpe_50k.json"
WORD_VOCABULARY = "word_bpe_49k.json"

# Pieces a worker keeps; beyond it the store begins anew.
KEPT_PIECES = 1 << 20
_MARK = b"\x01"
_SEGMENT = 1 << 16
# Bytes of new pieces given to the library at once, and of one text of them: the library
# keeps many times a text's bytes while it encodes it, which should stay in the cache.
_LEARNED = 1 << 18
_LEARNED_TEXT = 1 << 12
_SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")
# First bytes of white space beyond ASCII, and how it goes on in UTF-8.
_WIDE_FIRST = np.zeros(256, bool)
_WIDE_FIRST[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_WIDE_SPACE = re.compile(
    b"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80"
)


def vocabulary_path(name: str) -> str:
    """Where a public vocabulary lies on this machine; a path is taken as it is."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class _Store:
    """Ids of pieces by 64-bit key: an open-addressed table over one pool of ids."""

    def __init__(self):
        self.slots = 2 * KEPT_PIECES
        self.keys = np.zeros(self.slots, np.uint64)
        self.values = np.zeros(self.slots, np.int32)
        self.clear()

    def clear(self) -> None:
        self.keys[:] = 0
        self.pool = np.empty(1 << 16, np.uint32)
        self.first = np.zeros(1 << 16, np.int64)
        self.count = 1  # piece 0 is empty
        self.first[:2] = 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each piece, or -1."""
        slot = (keys & np.uint64(self.slots - 1)).view(np.int64)
        there = self.keys.take(slot)
        found = self.values.take(slot)
        left = np.flatnonzero(there != keys)  # mostly few: the table is half full at most
        found[left] = -1
        left = left[there[left] != 0]
        slot = (slot[left] + 1) & (self.slots - 1)
        while len(left):
            there = self.keys.take(slot)
            hit = there == keys[left]
            found[left[hit]] = self.values[slot[hit]]
            on = ~hit & (there != 0)
            left, slot = left[on], (slot[on] + 1) & (self.slots - 1)
        return found

    def add(self, ids: np.ndarray, lengths: np.ndarray) -> int:
        """Append pieces to the pool; the number of the first."""
        begin, used = self.count, int(self.first[self.count])
        while used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
        while begin + len(lengths) + 1 > len(self.first):
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
        self.pool[used : used + len(ids)] = ids
        self.first[begin + 1 : begin + len(lengths) + 1] = used + np.cumsum(lengths)
        self.count += len(lengths)
        return begin

    def put(self, keys: np.ndarray, begin: int) -> None:
        """Distinct new keys for the pieces from begin on."""
        number = np.arange(begin, begin + len(keys), dtype=np.int32)
        slot = (keys & np.uint64(self.slots - 1)).astype(np.int64)
        while len(keys):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = keys[free]
            won = self.keys[slot] == keys
            self.values[slot[won]] = number[won]
            keys, number, slot = keys[~won], number[~won], (slot[~won] + 1) & (self.slots - 1)

    def gather(self, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces in order, and where each piece's begin."""
        first = self.first.take(pieces)
        lengths = self.first.take(pieces + 1) - first
        begin = np.zeros(len(pieces) + 1, np.int64)
        np.cumsum(lengths, out=begin[1:])
        first -= begin[:-1]
        place = np.repeat(first, lengths)
        place += np.arange(len(place))
        return self.pool.take(place), begin


class Encoder:
    """Encodes texts with one vocabulary file, as the library does without adding tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.kind = _kind(_spec(self.tokenizer.pre_tokenizer), _spec(self.tokenizer.normalizer), added)
        self.added = [t.content.encode() for t in added]
        self.store = _Store() if self.kind != "whole" else None
        self.gaps: dict[bytes, int] = {}
        if self.kind == "byte":
            self.begins = np.zeros(self.size, bool)
            pieces = map(self.tokenizer.id_to_token, range(self.size))
            self.begins[[i for i, p in enumerate(pieces) if p is not None and p.startswith("Ġ")]] = True
            self.line_id = self.ids(["\n"])[0][0]
        elif self.kind == "word":
            self.mark_id = self.ids([_MARK.decode()])[0][0]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """Texts as the library encodes them."""
        return [
            np.array(x.ids, np.uint32)
            for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ]

    def _whole(self, text: str) -> np.ndarray:
        """One text in segments, cut at single spaces, where every kind here cuts."""
        if self.kind == "whole" or len(text) <= 2 * _SEGMENT:
            return self.ids([text])[0]
        cuts = [0]
        while (found := _SAFE_CUT.search(text, cuts[-1] + _SEGMENT)) is not None:
            cuts.append(found.start())
        return np.concatenate([self.ids([text[a:b]])[0] for a, b in zip(cuts, [*cuts[1:], None])])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts and where each text's begin; null counts as empty."""
        if self.kind == "whole":
            return _joined([self._whole(t) if t else np.empty(0, np.uint32) for t in texts.to_pylist()])
        added = _holding(*as_bytes(texts), self.added)
        plain = texts
        if len(added):
            without = np.zeros(len(texts), bool)
            without[added] = True
            plain = pc.if_else(pa.array(without), pa.scalar("", texts.type), texts)
        found = words(plain, SAME, parts=True) if self.kind == "byte" else words(plain, LOWER)
        rows = len(found.offsets) - 1
        if self.kind == "word":
            pieces, at = self._pieces(found, found.hashes, None), found.first
        else:
            pieces, at = self._with_gaps(found)
        ids, begin = self.store.gather(pieces)
        first = begin[at]
        odd = [*added, *(_wide_rows(found.data, found.offsets) if self.kind == "byte" else [])]
        if len(odd) == 0:
            return ids, first
        own = dict(zip(odd, (self._whole(texts[int(r)].as_py()) for r in odd)))
        return _joined([own.get(r, ids[first[r] : first[r + 1]]) for r in range(rows)])

    def _with_gaps(self, found) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of parts of words and of the white space around them, and where each row's begin.

        A space directly before a word belongs to the word; what stands before it is a
        piece, and so is a last character other than a space. The tokenizer never merges a
        letter or digit with a sign behind it, so words are cut there into parts: a word
        is given to the library once, whatever signs follow it.
        """
        data, starts, first, offsets = found.data, found.starts, found.first, found.offsets
        before = np.empty(len(starts), np.int64)
        before[1:] = found.ends[:-1]
        filled = np.flatnonzero(np.diff(first))
        before[first[filled]] = offsets[filled]
        size = starts - before
        spaced = (size > 0) & (data[starts - 1] == 32)
        text = data.tobytes()
        pieces = self._pieces(found, mix(found.hashes + spaced.astype(np.uint64)), spaced, text)
        led = np.flatnonzero((size > 1) | ((size == 1) & ~spaced))
        lead = [self._gap(text[a:b], last=False) for a, b in zip(before[led].tolist(), starts[led].tolist())]
        last_end = offsets[:-1].copy()
        last_end[filled] = found.ends[first[filled + 1] - 1]
        tailed = np.flatnonzero(last_end < offsets[1:])
        tail = [
            self._gap(text[a:b], last=True)
            for a, b in zip(last_end[tailed].tolist(), offsets[tailed + 1].tolist())
        ]
        # A tail goes before the first word of the next row, and before what leads that.
        where = np.concatenate([first[tailed + 1], led])
        order = np.argsort(where, kind="stable")
        out = np.insert(pieces, where[order], np.array([*tail, *lead], np.int32)[order])
        more = np.searchsorted(led, first) + np.searchsorted(tailed, np.arange(len(first)))
        return out, first + more

    def _gap(self, gap: bytes, last: bool) -> int:
        """The piece of white space before a word or at the end of a text."""
        key = gap + b"." if last else gap
        if key not in self.gaps:
            text = gap.decode()
            parts = [text] if last else [text[:-1], text[-1] if text[-1] != " " else ""]
            ids = np.concatenate(self.ids([p for p in parts if p]))
            self.gaps[key] = self.store.add(ids, np.array([len(ids)]))
        return self.gaps[key]

    def _pieces(self, found, keys, spaced, text: bytes | None = None) -> np.ndarray:
        """The piece of each word; new ones are encoded first."""
        keys = np.where(keys == 0, np.uint64(1), keys)
        pieces = self.store.find(keys)
        missing = np.flatnonzero(pieces < 0)
        if len(missing) == 0:
            return pieces
        text = found.data.tobytes() if text is None else text
        if self.store.count + len(missing) > KEPT_PIECES or len(self.gaps) > KEPT_PIECES // 64:
            # Pieces of this slice stay: the frequent ones are hardly ever encoded again.
            known = np.flatnonzero(pieces >= 0)
            same, at = np.unique(keys[known], return_index=True)
            ids, begin = self.store.gather(pieces[known[at]])
            self.store.clear()
            self.gaps.clear()
            self.store.put(same, self.store.add(ids, np.diff(begin)))
            pieces = self.store.find(keys)
        new, one = np.unique(keys[missing], return_index=True)
        one = missing[one]
        if spaced is None:
            own = [text[a:b] for a, b in zip(found.starts[one].tolist(), found.ends[one].tolist())]
            self._learn(new, own, b" " + _MARK + b" ", b"", self._after_mark)
        else:
            for flag, lead, cut in ((True, b" ", self._at_begin), (False, b"\n", self._after_line)):
                of = one[spaced[one] == flag]
                own = [text[a:b] for a, b in zip(found.starts[of].tolist(), found.ends[of].tolist())]
                self._learn(keys[of], own, b"", lead, cut)
        pieces[missing] = self.store.find(keys[missing])
        return pieces

    def _at_begin(self, ids):
        at = np.flatnonzero(self.begins[ids])
        return at, np.append(at[1:], len(ids))

    def _after_line(self, ids):
        at = np.flatnonzero(ids == self.line_id)
        return at + 1, np.append(at[1:], len(ids))

    def _after_mark(self, ids):
        at = np.flatnonzero(ids == self.mark_id)
        return np.append(0, at[:-1] + 1), at

    def _learn(self, keys, pieces: list[bytes], after: bytes, lead: bytes, cut) -> None:
        """Encode pieces, joined where the ids show the joints, and keep them."""
        for a, b in _runs(pieces, _LEARNED):
            self._learn_some(keys[a:b], pieces[a:b], after, lead, cut)

    def _learn_some(self, keys, pieces: list[bytes], after: bytes, lead: bytes, cut) -> None:
        joined = [lead + p + after for p in pieces]
        ids = None
        if self.kind == "byte" or sum(p.count(_MARK) for p in joined) == len(pieces):
            texts = [b"".join(joined[a:b]).decode() for a, b in _runs(joined, _LEARNED_TEXT)]
            ids = np.concatenate(self.ids(texts))
            starts, ends = cut(ids)
        if ids is None or len(starts) != len(pieces):
            alone = lead if lead == b" " else b""
            own = self.ids([(alone + p).decode() for p in pieces])
            ids, lengths = np.concatenate(own), np.array([len(x) for x in own])
        else:
            lengths = ends - starts
            keep = np.ones(len(ids) + 1, bool)
            if cut != self._at_begin:
                keep[:-1] = ids != (self.mark_id if self.kind == "word" else self.line_id)
            ids = ids[keep[:-1]]
        self.store.put(keys, self.store.add(ids, lengths))


def _runs(pieces: list[bytes], size: int) -> list[tuple[int, int]]:
    """Runs of pieces of about so many bytes: where each begins and ends."""
    if not pieces:
        return []
    total = np.cumsum([len(p) for p in pieces], dtype=np.int64)
    cuts = np.searchsorted(total, np.arange(size, total[-1], size)).tolist()
    return [(a, b) for a, b in zip([0, *cuts], [*cuts, len(pieces)]) if a < b]


def _joined(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    first = np.concatenate([[0], np.cumsum([len(x) for x in rows], dtype=np.int64)])
    return (np.concatenate(rows) if rows else np.empty(0, np.uint32)), first


def _holding(data: np.ndarray, offsets: np.ndarray, contents: list[bytes]) -> np.ndarray:
    """Rows in which one of the contents begins."""
    text, at = data.tobytes(), []
    for content in contents:
        place = text.find(content)
        while place >= 0:
            at.append(place)
            place = text.find(content, place + 1)
    return np.unique(np.searchsorted(offsets, np.array(at, np.int64), side="right") - 1)


def _wide_rows(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows holding white space beyond ASCII."""
    text = data.tobytes()
    if not looked_up(text, _WIDE_FIRST).any():
        return np.empty(0, np.int64)
    at = [m.start() for m in _WIDE_SPACE.finditer(text)]
    return np.unique(np.searchsorted(offsets, at, side="right") - 1)


def _spec(part) -> dict | None:
    """What a tokenizer's file says of one of its parts."""
    return None if part is None else json.loads(part.__getstate__())


def _kind(before: dict | None, normal: dict | None, added: Iterable) -> str:
    """byte: spaces begin pieces and nothing is normalised; word: white space only separates."""
    before = before or {}
    for token in added:  # others than those found by their bytes alone
        wider = token.lstrip or token.rstrip or token.single_word
        if wider or (normal and token.normalized) or re.search(r"\s", token.content):
            return "whole"
    if before.get("type") == "ByteLevel" and normal is None:
        if before.get("use_regex", True) and not before.get("add_prefix_space"):
            return "byte"
    if before.get("type") == "Sequence" and normal is not None:
        split = before["pretokenizers"][0]
        kinds = [n["type"] for n in normal.get("normalizers", [normal])]
        if split.get("behavior") == "Removed" and split.get("invert") and "Lowercase" in kinds:
            return "word"
    return "whole"


_encoders: dict[str, Encoder] = {}


def encoder(name: str) -> Encoder:
    """The encoder of a vocabulary, made once per worker."""
    if name not in _encoders:
        _encoders[name] = Encoder(vocabulary_path(name))
    return _encoders[name]
