"""Similar documents, components, leaks, quality and the pipeline."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from lakestay.llm import decontamination, jaccard_join, quality
from lakestay.llm.components import components
from lakestay.llm.entries import QUERIES
from lakestay.llm.secret_scan import find_secrets, redact_text
from lakestay.llm.tokens import WORD_VOCABULARY, encoder
from tests.llm.common import FOLDER, documents, odd_documents


def shingle_set(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = [w for w in re.split("[\x20\x09-\x0d]+", low) if w]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def plain_components(rows):
    """component of each id, by comparing all rows."""
    parent = {d: d for d, _ in rows if d is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(d, shingle_set(t)) for d, t in rows if d is not None]
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                a_root, b_root = find(a), find(b)
                parent[max(a_root, b_root)] = min(a_root, b_root)
    return {d: find(d) for d in parent}


def check_similar(spark, rows):
    got = jaccard_join.similar_documents(documents(spark, rows)).collect()
    root = plain_components(rows)
    want = Counter((d, len(shingle_set(t)), root.get(d)) for d, t in rows)
    assert Counter(map(tuple, got)) == want


def edited(draw, words, rate):
    out = []
    for w in words:
        x = draw.random()
        out += [f"new{draw.randrange(10**6)}"] if x < rate / 3 else [] if x < 2 * rate / 3 else [w, "and"] if x < rate else [w]
    return out


def test_similar_documents(spark):
    draw = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = draw.choices(vocabulary, k=60)
    rows = []
    for size in (1, 2, 4, 5, 6, 7, 8, 9, 10, 11, 14, 20, 30, 60, 150, 600):
        for _ in range(4):
            base = draw.choices(vocabulary, k=size)
            rows.append(base)
            for rate in (0.0, 0.01, 0.02, 0.04, 0.08):
                rows.append(edited(draw, base, rate))
                rows.append(base[1:] if rate else base)
    rows += [draw.choices(vocabulary, k=draw.randrange(8, 40)) + passage for _ in range(60)]
    rows += [edited(draw, passage, draw.random() / 8) for _ in range(80)]
    draw.shuffle(rows)
    rows = [(i * 3 % 1009, " ".join(r)) for i, r in enumerate(rows)]
    rows += [(5000, None), (5001, ""), (5002, " \n"), (None, rows[0][1]), (None, None), (5003, "A b"), (5004, "a\tB")]
    rows += [(rows[3][0], rows[3][1]), (rows[4][0], "other text of the same id that is long enough")]
    check_similar(spark, rows)


def test_similar_documents_of_odd_rows(spark):
    odd = odd_documents(spark)
    check_similar(spark, [(r.doc_id, r.text) for r in odd.collect()])
    clash = odd.select("*", F.lit(1).alias("n"), F.lit("x").alias("c"), F.lit(0).alias("root"))
    assert jaccard_join.similar_documents(clash).count() == odd.count()
    assert jaccard_join.similar_documents(documents(spark, [])).count() == 0


def test_bounds_hold_for_all_sizes():
    for p in (75, 60, 90):
        for n in range(1, 300):
            larger = [n + m - 2 * -(-p * (n + m) // (100 + p)) for m in range(n, n * 100 // p + 1)]
            smaller = [n + m - 2 * -(-p * (n + m) // (100 + p)) for m in range(-(-p * n // 100), n + 1)]
            assert jaccard_join.difference_most(n, p, "larger") >= max(larger)
            assert jaccard_join.difference_most(n, p, "smaller") >= max(smaller)


def test_signatures_bound_the_difference():
    r = np.random.default_rng(2)
    for n, m, both in ((5, 6, 4), (100, 130, 90), (1000, 3, 0), (70, 4000, 60)):
        tokens = r.integers(0, 1 << 63, n + m, dtype=np.uint64)
        a, b = tokens[:n], np.concatenate([tokens[:both], tokens[n : n + m - both]])
        differing = jaccard_join.differing_bits(jaccard_join.signature(a), jaccard_join.signature(b))
        assert differing <= n + m - 2 * both


def test_one_of_each_group_stays(spark):
    draw = random.Random(4)
    base = [" ".join(draw.choices([f"v{i}" for i in range(300)], k=40)) for _ in range(12)]
    rows = [(10 * i + k, t) for i, t in enumerate(base) for k in range(3)] + [(7000, None), (None, base[0]), (0, base[0])]
    docs = documents(spark, rows)
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    root = plain_components(rows)
    want = Counter([d for d in root if root[d] == d] + [None])
    assert Counter(r.doc_id for r in kept.collect()) == want


def test_one_of_each_group_beside_clashing_names(spark):
    text = "one two three four five six seven eight nine ten"
    docs = documents(spark, [(4, text), (2, text), (2, text), (3, text + " eleven"), (9, "other words stand in here, all of them")])
    docs = docs.selectExpr("*", "doc_id as _id", "1 as _first", "true as _ROOT", "doc_id as component_id", "2 as node")
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 9]


def test_rounds_leave_one_table(spark):
    import os

    from lakestay.llm.components import components
    from lakestay.session import work_folder

    base = work_folder(spark, "x").rsplit("/", 1)[0].removeprefix("file:")
    held = lambda: {f for f in os.listdir(base) if f.startswith("edges-")} if os.path.isdir(base) else set()
    before = held()
    found = components(spark.createDataFrame([(i, i + 1) for i in range(50)], "a long, b long"))
    assert {r.root for r in found.collect()} == {0} and len(held() - before) == 1


def test_components(spark):
    draw = random.Random(8)
    edges = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1400)]
    edges += [(draw.randrange(5000, 6000), draw.randrange(5000, 6000)) for _ in range(600)] + [(9, 9), (None, 3)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


@settings(max_examples=150, deadline=None)
@given(st.text("ab c", min_size=1, max_size=7), st.text("ab c", max_size=12))
def test_best_part_is_exact(pattern, text):
    least = min(plain_distance(pattern, text[i:j]) for i in range(len(text) + 1) for j in range(i, len(text) + 1))
    distance, start, end = decontamination.best_part(pattern, text, 100)
    assert distance == least == plain_distance(pattern, text[start:end])


def test_leaks_are_found_at_the_wanted_rate(spark):
    draw = random.Random(1)
    vocabulary = [f"word{i}" for i in range(800)]
    items = [(i, " ".join(draw.choices(vocabulary, k=draw.randrange(10, 70)))) for i in range(60)]
    rows, where = [], {}
    for d in range(300):
        own = draw.choices(vocabulary, k=draw.randrange(30, 200))
        if d < 180:
            item = items[d % 60][1].split()
            put = item if d < 60 else edited(draw, item, 0.08)
            cut = draw.randrange(len(own))
            own[cut:cut] = [w.upper() if d % 2 else w for w in put]
            where[d] = d % 60
        rows.append((d, "\n ".join(own)))
    benchmark = spark.createDataFrame(items + [(99, None), (98, "too short"), (None, "")], "item_id bigint, text string")
    got = decontamination.find_leaks(documents(spark, rows), benchmark).collect()
    pairs = {(r.doc_id, r.item_id): r for r in got}
    assert len(pairs) == len(got) and {d for d, _ in pairs} <= set(where)
    assert all((d, i) in pairs and pairs[d, i].distance == 0 for d, i in where.items() if d < 60)
    searched = [(d, i) for d, i in where.items() if d >= 60]
    assert sum(p in pairs for p in searched) >= 0.9 * len(searched)
    texts = dict(rows)
    for (d, i), r in pairs.items():
        passage = " ".join(texts[d][r.start : r.end].lower().split())
        assert plain_distance(items[i][1], passage) <= r.distance + 12 and r.distance <= 0.2 * len(items[i][1])
        if r.distance == 0:
            assert passage == items[i][1]


def test_leaks_of_odd_rows(spark):
    item = "one two three four five six seven eight nine ten"
    rows = [(1, f"x {item} y {item}"), (1, f"x {item} y {item}"), (None, item), (2, None), (3, ""), (4, "é😀 " + item), (5, "clean")]
    docs = documents(spark, rows).withColumn("item_id", F.lit("clash"))
    benchmark = spark.createDataFrame([(7, item), (8, item)], "item_id bigint, text string")
    got = Counter((r.doc_id, r.item_id, r.start, r.end) for r in decontamination.find_leaks(docs, benchmark).collect())
    end = 2 + len(item)
    assert got == Counter({(1, 7, 2, end): 2, (1, 8, 2, end): 2, (None, 7, 0, len(item)): 1, (None, 8, 0, len(item)): 1,
                           (4, 7, 3, 3 + len(item)): 1, (4, 8, 3, 3 + len(item)): 1})
    assert sorted(r.doc_id for r in decontamination.drop_leaked(docs, benchmark).collect()) == [2, 3, 5]
    none = benchmark.limit(0)
    assert decontamination.find_leaks(docs, none).count() == 0
    assert decontamination.drop_leaked(docs, none).count() == len(rows)
    assert decontamination.find_leaks(docs.limit(0), benchmark).count() == 0


def test_blocks_of_items_give_the_same_leaks(spark, monkeypatch):
    docs, benchmark = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = Counter(map(tuple, decontamination.find_leaks(docs, benchmark).collect()))
    monkeypatch.setattr(decontamination, "BLOCK_ITEMS", 9)
    assert Counter(map(tuple, decontamination.find_leaks(docs, benchmark).collect())) == whole


def test_exact_leaks_of_the_tables(spark):
    docs, benchmark = (spark.read.parquet(f"{FOLDER}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    want = {(d.doc_id, b.item_id) for d in docs for b in benchmark if b.text in (d.text or "")}
    rows = QUERIES["op6_decontamination"](spark, FOLDER).collect()
    assert want <= {(r.doc_id, r.item_id) for r in rows} and want


def test_quality_on_rows_never_learned(spark):
    folder = FOLDER.replace("0.001", "0.01")
    rows = {r.doc_id: r for r in QUERIES["op10_quality"](spark, folder).collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    held = [(rows[x.doc_id], x.quality) for x in labels if rows[x.doc_id].held_out]
    assert np.mean([r.predicted == q for r, q in held]) > 0.95
    good, bad = [r.score for r, q in held if q], [r.score for r, q in held if not q]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.97


def test_held_out_labels_do_not_count(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    out = quality.held_out(F.col("doc_id"))
    turned = labels.withColumn("quality", F.when(out, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.train(docs, labels), quality.train(docs, turned)
    assert all(np.array_equal(x, y) for x, y in zip(a, b))


def test_quality_of_odd_rows(spark):
    docs = odd_documents(spark).withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(30)] + [(None, 1, 0), (5, None, 0), (6, 7, 0)], "doc_id bigint, quality int, toxic int")
    model = quality.train(docs, labels)
    rows = quality.score(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out is False for r in rows if r.doc_id is None)
    unlearned = quality.train(docs, labels.limit(0))
    assert {r.score for r in quality.score(docs, unlearned).collect()} == {0.5}
    assert quality.keep_good(docs, unlearned).count() == docs.count()
    assert quality.score(docs.limit(0), model).count() == 0


def test_every_label_is_learned(spark):
    """The good documents come after 20,000 bad ones in the order of the hashes of their ids."""
    ids = spark.range(27_000).select(F.col("id").alias("doc_id")).filter(~quality.held_out(F.col("doc_id")))
    order = [r.doc_id for r in ids.orderBy(F.xxhash64("doc_id")).collect()]
    assert len(order) > 20_500
    rows = [(d, "WIN $$$ NOW !!!" if i < 20_000 else "a calm line of words", int(i >= 20_000)) for i, d in enumerate(order)]
    both = spark.createDataFrame(rows, "doc_id bigint, text string, quality int")
    model = quality.train(both.select("doc_id", "text"), both.select("doc_id", "quality"))
    bad, good = model.score(quality.features(pa.array([rows[0][1], rows[-1][1]])))
    assert bad < quality.THRESHOLD < good
    at = quality.FEATURES.index("log_words")
    assert np.isclose(model.mean[at], (20_000 * np.log(5) + (len(rows) - 20_000) * np.log(6)) / len(rows), rtol=1e-12)


def test_quality_fit_against_a_plain_one(spark):
    """Pairs, loss and threshold as plain arrays give them."""
    random = np.random.default_rng(3)
    x = random.normal(size=(150, len(quality.FEATURES)))
    labels = [int(v > 0.3) for v in x[:, 0] + random.normal(size=150)]
    schema = "doc_id bigint, label int, x array<double>"
    rows = spark.createDataFrame([(i, l, r.tolist()) for i, (l, r) in enumerate(zip(labels, x))], schema)
    model = quality.fit(rows, pairs=400)
    order = [(r.doc_id, r.label) for r in rows.orderBy(F.xxhash64("doc_id")).collect()]
    good, bad = ([d for d, l in order if l == k] for k in (1, 0))
    z = np.clip((x - x.mean(0)) / x.std(0), -8, 8)
    k = np.arange(400)
    d = z[np.take(good, k % len(good))] - z[np.take(bad, (k + k // len(bad)) % len(bad))]
    p = 1 / (1 + np.exp(d @ model.weights))
    assert np.abs(1e-4 * model.weights - d.T @ p / 400).max() < 1e-6
    s = np.sort(z @ model.weights)
    assert np.isclose(model.threshold, (s[len(bad) - 1] + s[len(bad)]) / 2)


def test_features_of_texts():
    x = quality.features(pa.array([None, "", "Aa bb, CC! CC", "one " * 50]))
    at = {name: i for i, name in enumerate(quality.FEATURES)}
    assert x.shape == (4, len(quality.FEATURES)) and x[0].tolist() == x[1].tolist() and x[0, at["empty"]] == 1
    assert x[2, at["bang"]] == 0.25 and x[2, at["capital_words"]] == 0.5 and x[2, at["stopped_words"]] == 0.25
    assert x[3, at["same_again"]] == 49 / 50 and x[3, at["distinct"]] == 1 / 50 and x[3, at["top_word"]] == 1
    assert x[3, at["repeated_runs"]] == 45 / 46


def test_pipeline_against_a_plain_version(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels, benchmark = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("labels", "benchmark"))
    model = quality.train(docs, labels)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows = [x for x in rows if model.score(quality.features(pa.array([x[1]])))[0] >= 0.3]
    root = plain_components(rows)
    rows = [x for x in rows if root[x[0]] == x[0]]
    items = [r.text for r in benchmark.collect()]
    leaked = {r.doc_id for r in decontamination.find_leaks(docs, benchmark).collect()}
    assert all(d in leaked for d, t in rows if any(i in t for i in items))
    rows = [(d, redact_text(t, find_secrets(t), "[REDACTED]")) for d, t in rows if d not in leaked]
    want = {d: (np.append(encoder(WORD_VOCABULARY).ids([t])[0], 2)).astype("<u4").tobytes() for d, t in rows}
    pieces = defaultdict(list)
    for r in corpus_pipeline.run(spark, FOLDER).collect():
        pieces[r.doc_id].append((r.start, bytes(r.ids)))
    assert {d: b"".join(x for _, x in sorted(p)) for d, p in pieces.items()} == want


def test_stages_keep_the_columns(spark):
    docs = odd_documents(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).columns == docs.columns
        assert stage(spark, docs.limit(0), FOLDER).count() == 0
    assert [name.split()[0] for name, _ in corpus_pipeline.STAGES] == ["quality", "n-gram", "benchmark", "secret", "packing"]


@pytest.mark.parametrize("name", ["op7_personal_data", "op9_secret_scan", "op8_jaccard_join"])
def test_queries_give_a_row_for_each_document(spark, name):
    ids = sorted(r.doc_id for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id").collect())
    assert sorted(r.doc_id for r in QUERIES[name](spark, FOLDER).collect()) == ids
