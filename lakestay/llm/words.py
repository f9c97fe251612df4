"""Words of whole texts as 64-bit hashes, computed on the UTF-8 bytes of a batch.

A word is a run of characters other than space and \\t to \\r; A-Z count as a-z. Both
concern single bytes of UTF-8 only, so no text is decoded.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

from lakestay.llm.batches import as_bytes

_STEP = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_WORD = np.uint64

SAME = np.arange(256, dtype=np.uint8)
LOWER = SAME.copy()
LOWER[ord("A") : ord("Z") + 1] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
_SIGN = np.zeros(256, bool)
_SIGN[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
# Second bytes of the letters from U+00C0 to U+00FF; U+00D7 and U+00F7 are signs.
_LATIN_FIRST, _LATIN = 0xC3, np.zeros(256, bool)
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False


class Words(NamedTuple):
    hashes: np.ndarray  # of every word of the batch, in order
    first: np.ndarray  # words of row i are first[i] to first[i + 1]
    starts: np.ndarray  # byte offsets in data
    ends: np.ndarray
    data: np.ndarray
    offsets: np.ndarray  # of the rows in data


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on all bits."""
    x = x.astype(_WORD, copy=True)
    x ^= x >> _WORD(30)
    x *= _WORD(0xBF58476D1CE4E5B9)
    x ^= x >> _WORD(27)
    x *= _WORD(0x94D049BB133111EB)
    x ^= x >> _WORD(31)
    return x


_LETTER = mix(np.arange(1, 257, dtype=_WORD) * _WORD(_BASE))


class _Powers:
    """Powers of an odd number and of its inverse, modulo 2 to the 64."""

    def __init__(self):
        self.up = self.down = np.empty(0, _WORD)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, _STEP + 4096)
            self.up, self.down = (
                np.cumprod(np.concatenate([[_WORD(1)], np.full(size - 1, _WORD(base))]))
                for base in (_BASE, pow(_BASE, -1, 1 << 64))
            )
        return self.up[:n], self.down


_powers = _Powers()


def _signs_after_letters(data: np.ndarray, raw: bytes, before: np.ndarray) -> np.ndarray:
    """Places of ASCII signs behind a letter or digit of their word, as far as those are Latin."""
    at = np.flatnonzero(looked_up(raw, _SIGN))
    at = at[before.take(at)]
    last = data.take(at - 1)
    return at[_ALNUM.take(last) | (_LATIN.take(last) & (data.take(at - 2) == _LATIN_FIRST))]


def looked_up(raw: bytes, flags: np.ndarray) -> np.ndarray:
    """The flag of each byte."""
    return np.frombuffer(raw.translate(flags.tobytes()), bool)


def _piece(
    data: np.ndarray, cuts: np.ndarray, fold: np.ndarray, parts: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words of some bytes, or of their parts; rows begin at cuts."""
    raw = data.tobytes()
    inside = looked_up(raw, ~SPACE[fold])
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    before[cuts] = False
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    after[cuts[cuts > 0] - 1] = False
    begins, closes = inside & ~before, inside & ~after
    if parts:
        signs = _signs_after_letters(data, raw, before)
        begins[signs] = True
        closes[signs - 1] = True
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(closes) + 1
    up, down = _powers(len(data))
    summed = np.empty(len(data) + 1, _WORD)
    summed[0] = 0
    letters = _LETTER[fold].take(data)
    letters *= up
    np.cumsum(letters, out=summed[1:])
    hashes = summed.take(ends)
    hashes -= summed.take(starts)
    hashes *= down.take(starts)
    return mix(hashes), starts, ends


def words(texts: pa.Array, fold: np.ndarray = LOWER, parts: bool = False) -> Words:
    """The words of a batch; fold maps bytes before they are hashed.

    With parts, words are also cut before every ASCII sign that follows a letter or digit of
    ASCII or Latin-1: "don't," gives don, 't and a comma.
    """
    data, offsets = as_bytes(texts)
    found: list[tuple[np.ndarray, ...]] = []
    at = 0
    while at < len(data):
        end = min(at + _STEP, len(data))
        if end < len(data):  # go on to where no word can cross
            row = int(offsets[np.searchsorted(offsets, end)])
            while end < row and not SPACE[data[end]]:
                end += 1
        cuts = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, end)] - at
        hashes, starts, ends = _piece(data[at:end], cuts, fold, parts)
        found.append((hashes, starts + at, ends + at))
        at = end
    if not found:
        found.append((np.empty(0, _WORD), np.empty(0, np.int64), np.empty(0, np.int64)))
    hashes, starts, ends = (np.concatenate(x) for x in zip(*found))
    return Words(hashes, np.searchsorted(starts, offsets), starts, ends, data, offsets)


def shingles(found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of size words, row by row, and where each row's runs begin.

    A row with fewer words has one run, all of them; a row without words has none.
    """
    hashes, first = found.hashes, found.first
    count = np.diff(first)
    runs = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    begin = np.concatenate([[0], np.cumsum(runs)])
    rolled = np.zeros(max(len(hashes) - size + 1, 0), _WORD)
    for k in range(size):
        rolled = mix(rolled + hashes[k : k + len(rolled)] * _WORD(2 * k + 1))
    out = np.empty(int(begin[-1]), _WORD)
    whole = np.flatnonzero(count >= size)
    # Position in rolled of each run: its row's first word plus its place in the row.
    shift = np.repeat(first[whole] - begin[whole], runs[whole])
    where = np.concatenate([np.arange(begin[r], begin[r] + runs[r]) for r in whole]) if len(whole) else np.empty(0, np.int64)
    out[where] = rolled[where + shift]
    for r in np.flatnonzero((count > 0) & (count < size)):
        h = np.array([count[r]], _WORD)
        for word in hashes[first[r] : first[r + 1]]:
            h = mix(h * _WORD(_BASE) + word)
        out[begin[r]] = h[0]
    return out, begin
