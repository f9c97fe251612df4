"""Benchmark leaks near the limit of edits, and under marks and letters beyond ASCII."""

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from lakestay.llm import decontamination
from lakestay.llm.decontamination import Searcher

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def prose(draw, words):
    return " ".join("".join(draw.choices(LETTERS, k=draw.randrange(2, 10))) for _ in range(words))


def typos(draw, text, places):
    """One character replaced, lost or put in at each place."""
    out = list(text)
    for p in places:
        out[p] = draw.choice([draw.choice(LETTERS), "", out[p] + draw.choice(LETTERS)])
    return "".join(out)


def anywhere(draw, text):
    return typos(draw, text, draw.sample(range(len(text)), int(0.2 * len(text))))


def in_every_third_word(draw, text):
    return " ".join(typos(draw, w, [draw.randrange(len(w))]) if i % 3 == 0 else w for i, w in enumerate(text.split()))


def replaced_words(draw, text):
    """As many words replaced as surely stay within the limit."""
    own, left = text.split(), int(0.2 * len(text))
    for i in draw.sample(range(len(own)), len(own)):
        if len(own[i]) <= left:
            left -= len(own[i])
            own[i] = "".join(draw.choices(LETTERS, k=len(own[i])))
    return " ".join(own)


@pytest.mark.parametrize("edit", [anywhere, in_every_third_word, replaced_words])
@pytest.mark.parametrize("words", [9, 16, 30, 60])
def test_recall_near_the_limit(edit, words):
    draw = random.Random(words)
    items = [(i, prose(draw, words)) for i in range(50)]
    searcher = Searcher(items)
    copies = [(i, edit(draw, t)) for i, t in items for _ in range(4)]
    rows = [f"{prose(draw, 40)} {t} {prose(draw, draw.randrange(1, 40))}" for _, t in copies]
    found = {(x.row, x.item_id) for x in searcher.find(pa.array(rows))}
    assert {i for i, _ in found} <= set(range(len(rows)))
    assert sum((k, i) in found for k, (i, _) in enumerate(copies)) >= 0.93 * len(copies)


def test_chance_of_runs():
    for length, edits in ((9, 3), (10, 1), (8, 0), (7, 7)):
        for run in range(1, 6):
            cuts = list(combinations(range(length), edits))
            long = sum(max(b - a - 1 for a, b in zip((-1, *c), (*c, length))) >= run for c in cuts)
            assert decontamination.run_chance(length, edits, run) == pytest.approx(long / len(cuts))


@pytest.mark.parametrize("size", [20, 64, 65, 128, 150])
def test_bounds_of_many_regions(size, monkeypatch):
    monkeypatch.setattr(decontamination, "_FEW", 1)
    draw = random.Random(size)
    patterns = ["".join(draw.choices("ab€ ", k=n)) for n in (size, size - 1, 3)]
    parts = ["".join(draw.choices("ab€ ", k=draw.randrange(0, 200))) for _ in range(30)]
    parts += [typos(draw, patterns[k % 2], range(k)) for k in range(10)]
    parts.sort(key=len, reverse=True)
    own = np.array([k % 3 for k in range(len(parts))])
    length = np.array([len(x) for x in parts])
    low = (decontamination._codes("".join(parts)) & 127).astype(np.uint8)
    least = decontamination.least_distances(patterns, own, low, np.cumsum(length) - length, length)
    assert least.tolist() == [min(decontamination.distances(patterns[i], x, False)) for i, x in zip(own, parts)]


def test_an_item_that_no_seed_finds_is_reported():
    with pytest.raises(ValueError):
        Searcher([(1, prose(random.Random(1), 10))], edit_rate=1.0)


def test_regions_are_those_of_every_row():
    draw = random.Random(5)
    text = prose(draw, 20)
    rows = [None, text, "", f"{text} {text}", text[:-1], prose(draw, 3000) + " " + text, "x"]
    found = [(x.row, x.start, x.end, x.distance) for x in Searcher([(1, text)]).find(pa.array(rows))]
    n = len(text)
    assert found == [(1, 0, n, 0), (3, 0, n, 0), (4, 0, n - 1, 1), (5, len(rows[5]) - n, len(rows[5]), 0)]


@pytest.mark.parametrize("text", [
    "Équement Èment Àé Ñandú Ωμέγα ΣΑΣ Ärger Élan Ôde",
    "ΑΡΧΗ ΤΗΣ ΜΕΓΑΛΗΣ ΟΔΟΥ ΚΑΙ ΤΕΛΟΣ ΤΟΥ ΔΡΟΜΟΥ",
    "ВСЕ СЛОВА ЭТОГО ЗАГОЛОВКА НАПИСАНЫ ПРОПИСНЫМИ БУКВАМИ РУССКОГО АЛФАВИТА",
    "İstanbul one two three four five six seven",
])
def test_exact_copies_beyond_ascii(text):
    rows = [text, f"Ü {text} Z", text.replace(" ", "\u00a0"), text.replace(" ", "\u3000\u00a0 "), text.lower()]
    n = len(text)
    for item in (text, text.replace(" ", "\u00a0")):
        found = Searcher([(1, item)]).find(pa.array(rows))
        assert [(x.row, x.distance) for x in found] == [(k, 0) for k in range(len(rows))]
        assert [(x.start, x.end) for x in found[:3]] == [(0, n), (2, 2 + n), (0, n)]


def test_short_items_are_found_as_whole_words():
    items = [(1, "Who  wrote the\nOdyssey?"), (2, "a"), (3, " "), (4, None), (5, "the"), (6, "seven words are one too few here")]
    rows = ["So: who wrote THE odyssey? Homer", "who wrote the odyssey", "whowrote the odyssey?", None, "a", "b\u00a0A ", "aa",
            "or seven words are one too few here", "seven words are one too few her"]
    found = Searcher(items).find(pa.array(rows))
    assert [(x.row, x.item_id, rows[x.row][x.start : x.end]) for x in found] == [
        (0, 1, "who wrote THE odyssey?"), (0, 5, "THE"), (1, 5, "the"), (2, 5, "the"), (4, 2, "a"), (5, 2, "A"),
        (7, 6, "seven words are one too few here"),
    ]
    assert all(x.distance == 0 and x.similarity == 1 for x in found)
