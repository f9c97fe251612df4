"""Tries of word sequences as double arrays that numpy walks from all positions at once.

A state is a slot. Its children are dealt to 2^k parts by the last k bits of their word, so
that a part has few; each part has a base of its own. The child of a state by word w is slot
base + w, with the base of w's part, if check of that slot is the part. Words are numbered
from 1 within the trie; the root is state 0 with one part, 0, of base 0.
"""

from __future__ import annotations

import numpy as np

# Children of a part on average at most. Parts are placed at random, all of a level together:
# one by one, states of thousands of children would be tried against ever more taken slots.
_FEW = 2
# Slots for each child.
_ROOM = 2
# Draws after which there is more room in any case.
_DRAWS = 200
# Bits of link that hold the number of bits its parts go by.
_BITS = 6


class Places:
    """The place of each key in a sorted list of distinct ones, looked up by its first bits.

    Keys are hashes, so few of the list share their first bits."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.shift = np.uint64(64 - max(1, (2 * len(keys)).bit_length()))
        self.first = np.searchsorted(keys >> self.shift, np.arange((1 << (64 - int(self.shift))) + 1, dtype=np.uint64)).astype(np.int32)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """-1 for keys that are not in the list."""
        place = np.full(len(keys), -1)
        head = (keys >> self.shift).astype(np.int64)
        at, end = self.first[head], self.first[head + 1]
        left = np.flatnonzero(at < end)
        at, end, keys = at[left], end[left], keys[left]
        while len(left):
            same = self.keys[at] == keys
            place[left[same]] = at[same]
            at += 1
            on = ~same & (at < end)
            left, at, end, keys = left[on], at[on], end[on], keys[on]
        return place


class DoubleArray:
    """A trie of sequences of one length, given as rows of word keys, distinct and not empty."""

    def __init__(self, rows: np.ndarray):
        self.depth = rows.shape[1]
        self.words, numbers = np.unique(rows, return_inverse=True)
        self.places = Places(self.words)
        numbers = numbers.reshape(rows.shape).astype(np.int64) + 1
        order = np.lexsort(numbers.T[::-1])
        self.rows, numbers = rows[order], numbers[order]
        width = len(self.words) + 1
        edges, state, group = [], np.zeros(len(numbers), np.int64), np.zeros(len(numbers), np.int64)
        for level in range(self.depth):  # rows of one state follow each other
            word = numbers[:, level]
            new = np.append(True, (group[1:] != group[:-1]) | (word[1:] != word[:-1]))
            edges.append(np.flatnonzero(new))
            group = np.cumsum(new) - 1
        self.check = np.full(width + _ROOM * sum(map(len, edges)), -1, np.int32)
        self.check[0] = 0
        # Of a state that has children, its first part and the bits they go by; of the last
        # states, the row each stands for.
        self.link = np.full(len(self.check), -1, np.int64)
        self.base = np.zeros(1, np.int32)
        self.random = np.random.default_rng(0)
        for level, edge in enumerate(edges):
            word = numbers[edge, level]
            slot = word if level == 0 else self._place(state[edge], word, width)
            if level == 0:
                self.check[slot], self.taken = 0, len(slot)
            state = slot[np.repeat(np.arange(len(edge)), np.diff(np.append(edge, len(numbers))))]
        self.link[state] = np.arange(len(numbers))
        # Any base may be asked for any word.
        used = int(self.base.max()) + width
        self.check, self.link = self.check[:used], self.link[:used]

    def _place(self, parent: np.ndarray, word: np.ndarray, width: int) -> np.ndarray:
        """The slots of the children of states, in order of the states; their parts get bases under which these were free."""
        first = np.flatnonzero(np.append(True, parent[1:] != parent[:-1]))
        count = np.diff(np.append(first, len(parent)))
        bits = np.ceil(np.log2(np.maximum(count / _FEW, 1))).astype(np.int64)
        begin = len(self.base) + np.cumsum(1 << bits) - (1 << bits)
        self.link[parent[first]] = begin << _BITS | bits
        part = np.repeat(begin, count) + (word & np.repeat((1 << bits) - 1, count))
        self.base = np.append(self.base, np.zeros(int((1 << bits).sum()), np.int32))
        slots = np.empty(len(parent), np.int64)
        left, rounds = np.argsort(part, kind="stable"), 0
        while len(left):
            own, number = part[left], word[left]
            which = np.cumsum(np.append(True, own[1:] != own[:-1])) - 1
            base = self.random.integers(1, len(self.check) - width, which[-1] + 1)[which]
            slot = base + number
            free = self.check[slot] == -1
            self.check[slot[free]] = own[free]
            won = free & (self.check[slot] == own)
            # Two children of one part never share a slot, but two draws may cross.
            lost = np.bincount(which, weights=~won) > 0
            placed = ~lost[which]
            self.check[slot[won & ~placed]] = -1
            self.base[own[placed]] = base[placed]
            slots[left[placed]] = slot[placed]
            self.taken += int(placed.sum())
            left, rounds = left[~placed], rounds + 1
            # The last large parts need many draws, not more room.
            if lost.mean() > 0.9 and (_ROOM * self.taken > len(self.check) or rounds % _DRAWS == 0):
                self._grow()
        return slots

    def _grow(self) -> None:
        more = max(len(self.check) // 2, 4096)
        self.check = np.append(self.check, np.full(more, -1, np.int32))
        self.link = np.append(self.link, np.full(more, -1, np.int64))

    def number(self, keys: np.ndarray) -> np.ndarray:
        """The number of each word key, 0 for words of no sequence."""
        return self.places(keys) + 1

    def walk(self, numbers: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The positions at which a sequence begins, and its row.

        numbers are those of all words of a text, room the words from each position to the
        end of its piece. All positions advance together, one level at a time.
        """
        at = np.flatnonzero((numbers > 0) & (room >= self.depth))
        state = numbers[at]
        on = self.check[state] == 0
        at, state = at[on], state[on]
        for level in range(1, self.depth):
            word = numbers[at + level]
            on = word > 0
            at, state, word = at[on], state[on], word[on]
            link = self.link[state]
            part = (link >> _BITS) + (word & ((1 << (link & ((1 << _BITS) - 1))) - 1))
            child = self.base[part] + word
            on = self.check[child] == part
            at, state = at[on], child[on]
        return at, self.link[state]
