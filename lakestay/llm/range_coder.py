"""Adaptive range coding of token ids in blocks that can be read one by one.

A block is cut into lanes, runs of consecutive ids with a range coder each; all lanes take
one step at a time, so a step is a few array operations. The lanes share one model, which
starts empty in every block and learns from all lanes after each step:

* order 2 and order 1 each name the id last seen after the two ids, or the id, before,
  with a confidence that grows when they are right;
* order 0 counts all ids that neither named.

The three predictions are mixed into one interval: a part for the order-2 id, a part for
the order-1 id and the rest spread by the order-0 counts. The sizes of the parts follow
how often each was right at the same confidences. The mixed interval drives the coder.

Block: magic, ids, lanes, vocabulary size, 16-bit words, sum of the ids; crc32 of all that and
the words; then the words: four of each lane, then one for each time a lane needs another, in
the order in which a reader needs them.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"LSTC"
BLOCK_IDS = 1 << 22
_HEAD = struct.Struct("<4sIIIIQ")
_CHECK = struct.Struct("<I")
_U = np.uint64
_LANES = 1 << 12
_LANE_IDS = 256  # at least, if the block has more than one lane
_SPLIT_BITS = 16  # precision of the parts of the mixed interval
_TOP, _BOTTOM, _WORD = _U(1 << 48), _U(1 << 32), _U(16)
_PAIRS = 1 << 20
_CONFIDENCE = 8
_REFRESH = 4  # steps between two sizings of the parts
_TURNED = 16  # steps whose ids are put side by side at once


class _Model:
    """What one block has taught so far."""

    def __init__(self, vocabulary: int):
        self.size = vocabulary
        self.bits = max(20, int(vocabulary).bit_length() + 3)
        # An id named and, in the low bits, the confidence in it: of pairs, then of ids.
        self.narrow = np.int32 if vocabulary < 1 << 28 else np.int64
        self.named = np.zeros(_PAIRS + vocabulary, self.narrow)
        self.outcomes = np.tile(np.array([2, 1, 2], np.int64), (2 * _CONFIDENCE**2, 1))
        self.counts = np.zeros(vocabulary, np.int64)
        self.waiting: list[np.ndarray] = []
        self.steps = self.pending = self.seen = 0
        self._spread()

    def _spread(self) -> None:
        """Order-0 intervals from the counts; every id keeps a part."""
        total = int(self.counts.sum())
        if total:
            freq = self.counts * ((1 << self.bits) - self.size)
            freq //= total
            freq += 1
        else:
            freq = np.full(self.size, max(1, (1 << self.bits) // self.size))
        # Where each id's interval begins, and where the last one ends.
        self.cum = np.zeros(self.size + 1, _U)
        np.cumsum(freq, out=self.cum[1:].view(np.int64))
        self.freq, self.inverse = freq, None

    def find(self, slot: np.ndarray) -> np.ndarray:
        """The id whose order-0 interval holds a slot."""
        if self.inverse is None:
            narrow = np.uint16 if self.size <= 1 << 16 else self.narrow
            self.inverse = np.repeat(np.arange(self.size, dtype=narrow), self.freq)
        return self.inverse.take(np.minimum(slot, _U(len(self.inverse) - 1)).view(np.int64))

    def predict(self, one: np.ndarray, two: np.ndarray):
        """For ids before: the places of the pair and of the id before, what is known there,
        the ids named by orders 2 and 1, the confidences, three times the context."""
        if self.steps % _REFRESH == 0:
            n = self.outcomes
            sizes = 1 + n * ((1 << _SPLIT_BITS) - 3) // n.sum(1, keepdims=True)
            sizes[:, 2] = (1 << _SPLIT_BITS) - sizes[:, 0] - sizes[:, 1]
            self.starts = (np.cumsum(sizes, axis=1) - sizes).astype(_U).ravel()
            self.sizes = sizes.astype(_U).ravel()
        self.steps += 1
        place = np.empty((2, len(one)), np.int64)
        pair = place[0]
        np.multiply(two, 0x9E3779B1, out=pair)
        pair += one * 0x85EBCA77
        pair >>= 7
        pair &= _PAIRS - 1
        np.add(one, _PAIRS, out=place[1])
        known = self.named.take(place)
        named, sure = known >> 3, known & 7
        context = sure[0] << 3
        context += sure[1]
        context <<= 1
        context += named[0] == named[1]
        return place, known, named, sure, context.astype(np.int64) * 3

    def learn(self, place, known, sure, event, ids, right, rest) -> None:
        """What came after the ids before; right: whether the orders named it."""
        self.outcomes += np.bincount(event, minlength=self.outcomes.size).reshape(-1, 3)
        sure += right.view(np.int8) * np.int8(_CONFIDENCE)
        known += _CHANGE.take(sure)
        anew = ids.astype(known.dtype) << 3
        anew = known ^ anew
        anew &= -(sure <= 1).astype(known.dtype)
        known ^= anew
        self.named[place] = known
        self.waiting.append(rest)
        self.pending += len(rest)
        if self.pending >= min(1 << 16, max(2048, self.seen // 2)):
            self.counts += 32 * np.bincount(np.concatenate(self.waiting), minlength=self.size)
            self.seen += self.pending
            self.waiting, self.pending = [], 0
            self._spread()


# Of the confidence in an id that did not come, which is halved (up to 1 another id is named,
# with 0), then of one that came.
_CHANGE = np.concatenate([
    -((np.arange(_CONFIDENCE) + 1) // 2), np.minimum(1, _CONFIDENCE - 1 - np.arange(_CONFIDENCE))
]).astype(np.int32)


class _Lanes:
    """The interval of each lane."""

    def __init__(self, lanes: int):
        self.low, self.range = np.zeros(lanes, _U), np.full(lanes, ~_U(0))

    def unit(self, on: int) -> np.ndarray:
        """The length of one part of the first lanes' intervals."""
        return self.range[:on] >> _U(_SPLIT_BITS)

    def split(self, unit: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        """The first lanes go on to some of the parts of their intervals."""
        on = len(unit)
        self.low[:on] += start * unit
        np.multiply(unit, size, out=self.range[:on])

    def units(self, at: np.ndarray, bits: int) -> np.ndarray:
        """The length of one part of 2**bits of some lanes, which may have been split before."""
        span = self.range.take(at)
        if span.min() < _BOTTOM:
            self.settle(at[span < _BOTTOM])
            span = self.range.take(at)
        span >>= _U(bits)
        return span

    def part(self, at: np.ndarray, unit: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        """Some lanes go on to some of the parts of their intervals."""
        self.low[at] = self.low.take(at) + start * unit
        self.range[at] = unit * size

    def settle(self, at: np.ndarray) -> None:
        """Lanes shift while their first word is settled or their range too short to go on.

        Only a lane whose range is below _TOP can be either.
        """
        while len(at):
            low, span = self.low.take(at), self.range.take(at)
            ends = low + span
            ends ^= low
            open_ = (ends >= _TOP).nonzero()[0]
            if len(open_):
                cut = open_[span.take(open_) < _BOTTOM]
                span[cut] = (~low[cut] + _U(1)) & (_BOTTOM - _U(1))
                ends[cut] = 0
                on = (ends < _TOP).nonzero()[0]
                at, low, span = at.take(on), low.take(on), span.take(on)
            self.shift(at, low >> _U(48))
            low <<= _WORD
            span <<= _WORD
            self.low[at], self.range[at] = low, span
            at = at.take((span < _TOP).nonzero()[0])

    def settle_all(self, on: int) -> None:
        self.settle((self.range[:on] < _TOP).nonzero()[0])

    def shift(self, lanes: np.ndarray, words: np.ndarray) -> None:
        raise NotImplementedError


class _Writer(_Lanes):
    def __init__(self, lanes: int):
        super().__init__(lanes)
        self.lanes: list[np.ndarray] = []
        self.words: list[np.ndarray] = []

    def shift(self, lanes, words) -> None:
        self.lanes.append(lanes.astype(np.uint16))
        self.words.append(words.astype(np.uint16))

    def close(self) -> np.ndarray:
        """All words in reading order: a lane's word is needed four shifts before it was written."""
        count = len(self.low)
        every = np.arange(count)
        last = (self.low + (_BOTTOM - _U(1))) >> _U(32)
        none = np.empty(0, np.uint16)
        shifts, words = np.concatenate([none, *self.lanes]), np.concatenate([none, *self.words])
        order = np.argsort(shifts, kind="stable")
        made = np.bincount(shifts, minlength=count)
        # By lane, each with four more words at its end; the place of each shift's word.
        begin = np.cumsum(made + 4) - made - 4
        place = np.repeat(4 * every, made)
        place += np.arange(len(place))
        by_lane = np.zeros(len(words) + 4 * count, np.uint16)
        by_lane[place] = words.take(order)
        by_lane[begin + made], by_lane[begin + made + 1] = last >> _WORD, last & _U(0xFFFF)
        # The same order of lanes as they are read: four words each, then shift by shift.
        out = np.empty_like(by_lane)
        out[: 4 * count].reshape(4, count)[:] = by_lane.take(begin + np.arange(4)[:, None])
        place += 4
        out[4 * count :][order] = by_lane.take(place)
        return out


class _Reader(_Lanes):
    def __init__(self, lanes: int, words: np.ndarray):
        super().__init__(lanes)
        self.words, self.at = words.astype(_U), 4 * lanes
        self.code = np.zeros(lanes, _U)
        for first in self.words[: 4 * lanes].reshape(4, lanes):
            self.code = (self.code << _WORD) | first

    def shift(self, lanes, words) -> None:
        code = self.code.take(lanes)
        code <<= _WORD
        code |= self.words[self.at : self.at + len(lanes)]
        self.code[lanes] = code
        self.at += len(lanes)


def _shape(n: int) -> tuple[int, int]:
    """Lanes and steps of a block of n ids."""
    lanes = max(1, min(_LANES, n // _LANE_IDS))
    return lanes, -(-n // lanes)


def _active(n: int, steps: int, t: int) -> int:
    """Lanes that have an id at step t: the first ones."""
    return max(0, -(-(n - t) // steps))


def _sum(ids: np.ndarray) -> int:
    return int(ids.sum(dtype=np.uint64))


def _block(ids: np.ndarray, lanes: int, vocabulary: int, words: bytes) -> bytes:
    head = _HEAD.pack(MAGIC, len(ids), lanes, vocabulary, len(words) // 2, _sum(ids))
    return b"".join([head, _CHECK.pack(zlib.crc32(words, zlib.crc32(head))), words])


def encode_block(ids: np.ndarray, vocabulary: int) -> bytes:
    """One block of at most BLOCK_IDS ids, each below vocabulary."""
    n = len(ids)
    if n == 0:
        return _block(ids, 0, vocabulary, b"")
    lanes, steps = _shape(n)
    model, out = _Model(vocabulary), _Writer(lanes)
    by_lane = np.zeros((lanes, steps), np.uint32)
    by_lane.reshape(-1)[:n] = ids
    one, two = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
    for t in range(steps):
        if t % _TURNED == 0:
            by_step = np.ascontiguousarray(by_lane[:, t : t + _TURNED].copy().T)
        on = _active(n, steps, t)
        x, a, b = by_step[t % _TURNED, :on].astype(np.int64), one[:on], two[:on]
        place, known, named, sure, event = model.predict(a, b)
        right = named == x.astype(named.dtype)
        lost = ~(right[0] | right[1])
        event += lost
        event += ~right[0]
        out.split(out.unit(on), model.starts.take(event), model.sizes.take(event))
        at = lost.nonzero()[0]
        rest = x.take(at)
        if len(at):
            start = model.cum.take(rest)
            out.part(at, out.units(at, model.bits), start, model.cum.take(rest + 1) - start)
        out.settle_all(on)
        model.learn(place, known, sure, event, x, right, rest)
        one, two = x, a
    return _block(ids, lanes, vocabulary, out.close().astype("<u2").tobytes())


def decode_block(data: bytes, at: int = 0) -> tuple[np.ndarray, int]:
    """The ids of the block that begins at a byte, and the byte after it."""
    magic, n, lanes, vocabulary, count, total = _HEAD.unpack_from(data, at)
    (crc,) = _CHECK.unpack_from(data, at + _HEAD.size)
    begin = at + _HEAD.size + _CHECK.size
    end = begin + 2 * count
    if magic != MAGIC or (n and lanes != _shape(n)[0]):
        raise ValueError("not a block of token ids, or a damaged one")
    if zlib.crc32(data[begin:end], zlib.crc32(data[at : at + _HEAD.size])) != crc:
        raise ValueError("checksum of a block of token ids does not match")
    words = np.frombuffer(data, "<u2", count, begin)
    ids = np.empty(0, np.uint32)
    if n:
        steps = _shape(n)[1]
        by_step, by_lane = np.zeros((_TURNED, lanes), np.uint32), np.empty((lanes, steps), np.uint32)
        reader, model = _Reader(lanes, words), _Model(vocabulary)
        one, two = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        for t in range(steps):
            on = _active(n, steps, t)
            a, b = one[:on], two[:on]
            place, known, named, sure, event = model.predict(a, b)
            unit, code = reader.unit(on), reader.code[:on] - reader.low[:on]
            later = code >= model.starts.take(event + 1) * unit
            last = code >= model.starts.take(event + 2) * unit
            event += later
            event += last
            reader.split(unit, model.starts.take(event), model.sizes.take(event))
            x = named[0] ^ ((named[0] ^ named[1]) & -later.astype(named.dtype))
            x = x.astype(np.int64)
            at = last.nonzero()[0]
            rest = np.empty(0, np.int64)
            if len(at):
                unit = reader.units(at, model.bits)
                slot = (reader.code.take(at) - reader.low.take(at)) // unit
                rest = model.find(slot).astype(np.int64)
                start = model.cum.take(rest)
                reader.part(at, unit, start, model.cum.take(rest + 1) - start)
                x[at] = rest
            reader.settle_all(on)
            model.learn(place, known, sure, event, x, named == x.astype(named.dtype), rest)
            by_step[t % _TURNED, :on] = x
            one, two = x, a
            if (t + 1) % _TURNED == 0 or t + 1 == steps:
                turned = t % _TURNED + 1
                by_lane[:, t + 1 - turned : t + 1] = by_step[:turned].T
        ids = by_lane.reshape(-1)[:n]
    if _sum(ids) != total:
        raise ValueError("ids of a block are not those that were written")
    return ids, end
