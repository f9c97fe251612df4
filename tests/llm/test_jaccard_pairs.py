"""Which entries of the similarity join are compared, against brute force."""

import random

import pytest

from lakestay.llm import jaccard_join
from lakestay.llm.jaccard_join import _FINEST, _LOOKUP, _RANK, _unconnected


def compared(entries, percent):
    """Pairs of an index entry and another that is not smaller, where sizes and ranks allow them."""
    out = set()
    for key, a, n_a, rank_a, finest, index in entries:
        for other, b, n_b, rank_b, _, _ in entries:
            total = n_a + n_b
            least = -(-percent * total // (100 + percent))
            near = key == other and a != b and index and n_b >= n_a and 100 * n_a >= percent * n_b
            if near and all(r <= (n - least if finest else total - 2 * least) for n, r in ((n_a, rank_a), (n_b, rank_b))):
                out.add((min(a, b), max(a, b)))
    return out


@pytest.mark.parametrize("finest", [False, True])
def test_pairs_across_size_bands(spark, finest, monkeypatch):
    monkeypatch.setattr(jaccard_join, "stored", lambda frame, name: frame)
    draw = random.Random(3)
    # The partner of 95 allows rank 27, the smallest one in the key, of 75, only 25.
    entries = [(0, 1, 75, 0, finest, True), (0, 2, 95, 0, finest, True), (0, 3, 100, 27, finest, False)]
    for c in range(10, 200):
        n = draw.randrange(60, 130)
        entries.append((draw.randrange(1, 12), c, n, draw.randrange(n // 3), finest, draw.random() < 0.5))
    rows = [
        (key, c, n | rank << _RANK | (_FINEST if finest else 0) | (0 if index else _LOOKUP))
        for key, c, n, rank, finest, index in entries
    ]
    shared = spark.createDataFrame(rows, "key bigint, c bigint, place bigint")
    roots = spark.createDataFrame([(r[1], r[1]) for r in rows], "c bigint, root bigint")
    got = {tuple(r) for r in _unconnected(shared, roots, 75).collect()}
    assert got == compared(entries, 75) and got
    assert finest or (2, 3) in got
