"""Phrases against a plain count of all runs of words."""

import random
import re
import time
from collections import Counter

import numpy as np
import pytest

from lakestay.llm import collocations as co
from lakestay.llm.double_array import DoubleArray
from lakestay.llm.entries import QUERIES, SQL
from tests.llm.common import DOCS, FOLDER, odd_documents
from tests.oracle import compare, connect

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain(rows, least=100, longest=5, best=2000, covered_percent=100):
    n, f = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    f = {x: c for x, c in f.items() if c >= least}
    gone = set()
    for (lang, p), c in f.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                if 100 * c >= covered_percent * f[lang, p[i : i + k]]:
                    gone.add((lang, p[i : i + k]))
    out = {}
    for (lang, p), a in f.items():
        if len(p) > 1 and (lang, p) not in gone:
            score, cut = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:cut]], f[lang, p[cut:]]))
    return sorted(
        (lang, i + 1, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0])
        for lang, rows in out.items() for i, x in enumerate(sorted(rows)[:best])
    )


def found(docs, **kw):
    return sorted(tuple(r) for r in co.collocations(docs, **kw).collect())


@pytest.fixture(scope="module")
def supplied(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    return docs, [tuple(r) for r in docs.select("text", "lang").collect()]


@pytest.mark.parametrize("kw", [
    {"least": 8}, {"least": 8, "trie_rows": 200}, {"least": 8, "most_words": 5, "trie_rows": 300},
    {"least": 8, "most_words": 5}, {"least": 9, "best": 3, "covered_percent": 70, "longest": 4},
])
def test_supplied_documents(supplied, kw):
    docs, rows = supplied
    want = plain(rows, **{k: v for k, v in kw.items() if k not in ("trie_rows", "most_words")})
    assert found(docs, **kw) == want and len(want) > 10


def test_query(spark, supplied):
    docs, rows = supplied
    assert sorted(tuple(r) for r in QUERIES["op13_collocations"](spark, FOLDER).collect()) == plain(rows)
    con = connect(FOLDER)
    df = co.collocations(docs, least=8)
    sql = SQL["op13_collocations"].replace(">= 100\n", ">= 8\n")
    assert sql != SQL["op13_collocations"] and compare(con, df, sql) is None


def test_parts_of_a_table_and_hot_words(spark):
    """Two words make a third of all, over many partitions; repeated words overlap."""
    r = random.Random(2)
    rows = []
    for i in range(400):
        w = [r.choice(["the", "THE", "of", f"w{r.randrange(30)}", f"w{r.randrange(30)}", "a.b", "x\ty", "é;É"]) for _ in range(r.randrange(60))]
        rows.append((i, " ".join(w), r.choice(["en", None, "und", ""]), "s", 0))
    docs = spark.createDataFrame(rows, DOCS).repartition(23)
    for kw in ({"least": 5}, {"least": 6, "trie_rows": 40, "most_words": 3}):
        want = plain([(x[1], x[2]) for x in rows], kw["least"])
        assert found(docs, **kw) == want and len(want) > 50


def test_rows_of_all_kinds(spark):
    docs = odd_documents(spark)
    docs = docs.unionByName(docs).unionByName(docs).selectExpr("*", "'x' as phrase", "1 as n", "2 as key")
    rows = [(r["text"], r["lang"]) for r in docs.select("text", "lang").collect()]
    assert found(docs, least=3) == plain(rows, 3)
    assert found(docs.limit(0)) == []
    assert found(docs.withColumn("text", docs.text.substr(1, 0))) == []


def test_words_of_one_hash_are_counted_anew(spark, monkeypatch):
    """The first hash takes all words for one; the next is right."""
    real = co._tokens

    def tokens(batch, seed):
        found, langs, keys, room = real(batch, seed)
        return found, langs, keys if seed else np.zeros_like(keys), room

    monkeypatch.setattr(co, "_tokens", tokens)
    rows = [(i, "one two one two three", "en", "s", 0) for i in range(5)]
    docs = spark.createDataFrame(rows, DOCS)
    assert found(docs, least=3) == plain([(x[1], x[2]) for x in rows], 3)


def test_double_array():
    r = np.random.default_rng(3)
    for depth, words, rows in ((2, 50, 600), (3, 9, 500), (5, 400, 3000), (2, 3000, 2500), (2, 1, 1)):
        keys = np.unique(r.integers(0, 1 << 63, words)).astype(np.uint64)
        want = np.unique(keys[r.integers(0, len(keys), (rows, depth))], axis=0)
        trie = DoubleArray(want)
        text = np.concatenate([keys, want.ravel(), keys[r.integers(0, len(keys), 5000)], [np.uint64(5)]])
        room = r.integers(1, 9, len(text))
        room = np.minimum(room, np.arange(len(text), 0, -1))
        at, row = trie.walk(trie.number(text), room)
        known = {tuple(x): i for i, x in enumerate(trie.rows.tolist())}
        seen = {i: known[tuple(text[i : i + depth].tolist())] for i in range(len(text) - depth + 1)
                if room[i] >= depth and tuple(text[i : i + depth].tolist()) in known}
        assert dict(zip(at.tolist(), row.tolist())) == seen and len(seen) > 0


def test_tasks_that_pass_on_often(spark, supplied, monkeypatch):
    docs, rows = supplied
    want = plain(rows, 8)
    seen = co._Seen()
    monkeypatch.setattr(co, "KEPT_ROWS", 50)
    r, real, got = random.Random(7), Counter(), Counter()
    for _ in range(60):
        codes = np.array([r.randrange(90) for _ in range(r.randrange(40))], np.int64)
        real.update(codes.tolist())
        seen.add(codes)
        if seen.full() or r.random() < 0.1:
            for b in seen.take(lambda x: x.astype(np.uint64)[:, None]):
                got.update(dict(zip(b.column("phrase").to_pylist(), b.column("n").to_pylist())))
    for b in seen.take(lambda x: x.astype(np.uint64)[:, None]):
        got.update(dict(zip(b.column("phrase").to_pylist(), b.column("n").to_pylist())))
    assert {int.from_bytes(k, "big"): n for k, n in got.items()} == real
    assert found(docs, least=8) == want


def test_double_array_of_states_with_many_children():
    """Built in proportion to its rows: 300,000 pairs, the commonest words with thousands of others."""
    r = np.random.default_rng(5)
    keys = np.unique(r.integers(0, 1 << 64, 60_000, np.uint64))
    place = (len(keys) * r.random((400_000, 2)) ** 3).astype(np.int64)
    want = np.unique(keys[place], axis=0)[:300_000]
    began = time.process_time()
    trie = DoubleArray(want)
    assert time.process_time() - began < 20 and np.bincount(trie.number(want[:, 0])).max() > 3000
    assert len(trie.check) < 12 * len(want)
    text = want[r.permutation(len(want))[:50_000]].ravel()
    at, row = trie.walk(trie.number(text), np.arange(len(text), 0, -1))
    assert (trie.rows[row] == np.column_stack([text[at], text[at + 1]])).all()
    known = set(map(tuple, want.tolist()))
    assert at.tolist() == [i for i, x in enumerate(zip(text[:-1].tolist(), text[1:].tolist())) if x in known]


def test_runs_seen_by_several_tries(supplied, monkeypatch):
    """A trie that has a part of the candidates passes on hardly more runs a word longer than one that has all."""
    real, runs = co._kept, {}

    def kept(df, path):
        out = real(df, path)
        if "/counts-2-" in path:
            longer = out.filter("length(phrase) = 24").select("phrase")
            runs[rows] = longer if rows not in runs else runs[rows].union(longer)
            sizes[rows] = runs[rows].distinct().count()
        return out

    monkeypatch.setattr(co, "_kept", kept)
    sizes, got = {}, {}
    for rows in (1 << 21, 100):
        got[rows] = found(supplied[0], least=8, trie_rows=rows)
    assert got[100] == got[1 << 21] == plain(supplied[1], 8)
    assert 0 < sizes[1 << 21] <= sizes[100] < 1.2 * sizes[1 << 21]


def test_filter_and_places():
    r = np.random.default_rng(6)
    rows = r.integers(0, 1 << 64, (5000, 3), np.uint64)
    among = co._Filter(4000)
    for part in (rows[:1000], rows[1000:4000]):
        among.add(part)
    assert among.has(rows[:4000]).all() and among.has(rows[4000:]).mean() < 0.2
    for n in (0, 1, 2, 4000):
        keys = np.unique(rows[:n, 0])
        sought = np.append(rows[:, 0], np.array([0, 5, (1 << 64) - 1], np.uint64))
        want = [{k: i for i, k in enumerate(keys.tolist())}.get(k, -1) for k in sought.tolist()] if n < 5 else None
        place = co.Places(keys)(sought)
        assert want is None or place.tolist() == want
        assert (place[: len(rows)] >= 0).sum() == n and (keys[place[place >= 0]] == sought[place >= 0]).all()
