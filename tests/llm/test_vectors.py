"""Exact search against brute force."""

import duckdb
import numpy as np
import pytest
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from lakestay.llm import vector_search
from lakestay.llm.entries import QUERIES, SQL
from tests.llm.common import FOLDER

SCHEMA = StructType([StructField("vec_id", LongType()), StructField("embedding", ArrayType(DoubleType()))])


def brute(rows, top, every):
    sound = [
        (i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v)
    ]
    width = max((len(v) for _, v in sound), default=0)
    sound = [(i, v + [0] * (width - len(v))) for i, v in sound]
    asked = {}
    for i, v in sound:
        if i % every == 0:
            asked[i] = min(asked.get(i, v), v)
    out = set()
    for q, v in asked.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in sound if i != q)
        out |= {(q, k + 1, i, -s, 0) for k, (s, i) in enumerate(scores[:top])}
    return out


def found(spark, rows, **options):
    df = vector_search.top_products(spark.createDataFrame(rows, SCHEMA), **options)
    got = [(r.query_id, r.rank, r.vec_id, r.score, 0) for r in df.collect()]
    assert len(got) == len(set(got)) or len({r[0] for r in rows}) < len(rows)
    return got


def test_random_vectors_with_hot_ones(spark, monkeypatch):
    monkeypatch.setattr(vector_search, "_FIRST_ROWS", 40)
    random = np.random.default_rng(3)
    centers = random.normal(size=(6, 8))
    rows = [(i, (centers[i % 6] + random.normal(size=8) * 0.05).tolist()) for i in range(900)]
    rows += [(i, centers[0].tolist()) for i in range(900, 1300)]
    assert set(found(spark, rows, query_every=50)) == brute(rows, 10, 50)


def test_bounds_rule_out_most_of_clustered_vectors(spark, monkeypatch):
    monkeypatch.setattr(vector_search, "_FIRST_ROWS", 60)
    random = np.random.default_rng(8)
    centers = random.normal(size=(40, 16))
    rows = [(i, (centers[i * 7 % 40] + random.normal(size=16) * 0.05).tolist()) for i in range(3000)]
    calls = []
    best = vector_search._cells

    def cells(queries, directory, groups, width, again):
        out = best(queries, directory, groups, width, again)
        size = dict(zip(directory.number.tolist(), directory.rows.tolist()))
        for r in out.select("annuli", "masks").distinct().collect():
            calls.extend(size[a] * sum(bin(b).count("1") for b in m) for a, m in zip(r.annuli, r.masks))
        return out

    monkeypatch.setattr(vector_search, "_cells", cells)
    assert set(found(spark, rows, query_every=100)) == brute(rows, 10, 100)
    # Pairs of a query and a row that both passes together look at.
    assert 0 < sum(calls) < 30 * 3000 / 2


def test_bounds_hold_for_every_vector(spark):
    random = np.random.default_rng(4)
    rows = [(i, np.floor(random.normal(size=6) * 1024).tolist()) for i in range(500)]
    own = spark.createDataFrame(rows, "vec_id bigint, vector array<double>")
    vectors = np.array([v for _, v in rows])
    _, blocks, directory = vector_search.build_index(own, 500, 6, float((vectors**2).sum(1).max()))
    reach = directory.reach(vectors[:50])
    place = {a: k for k, a in enumerate(directory.number.tolist())}
    seen = 0
    for b in blocks.collect():
        ids = np.frombuffer(b.ids, np.int64)
        seen += len(ids)
        assert (vectors[:50] @ vectors[ids].T <= reach[:, [place[b.annulus]]]).all()
    assert seen == 500 and (reach.max() - reach.min()) > 0


def test_bands_hold_annuli_of_few_blocks_and_cut_those_of_many():
    blocks = np.array([1, 2, 60, 1, 1, 200, 3])
    directory = vector_search.Directory(None, np.arange(7), None, None, blocks, blocks)
    band, parts = directory.bands()
    assert band.tolist() == [0, 0, 0, 0, 1, 2, 3] and parts.tolist() == [1, 1, 4, 1]


def test_rows_of_all_kinds(spark):
    rows = [
        (0, [1.0, 0.5]), (100, [0.25]), (200, None), (300, []), (400, [float("nan"), 1.0]), (500, [None, 1.0]),
        (600, [float("inf"), 0.0]), (None, [1.0, 1.0]), (1, [-0.0001, 3.0]), (2, [1.0, 0.5]), (3, [1.0, 0.5]),
        (700, [0.0, 0.0]), (4, [1e300, 1.0]),
    ]
    rows_without_huge = rows[:-1]
    assert set(found(spark, rows_without_huge)) == brute(rows_without_huge, 10, 100)
    assert {r[:3] for r in found(spark, rows)} == {r[:3] for r in brute(rows, 10, 100)}
    assert found(spark, []) == [] and found(spark, [(0, [1.0])]) == []


def test_repeated_ids(spark):
    rows = [(0, [1.0, 2.0]), (0, [0.5, 0.5]), (7, [1.0, 1.0]), (7, [1.0, 1.0]), (100, [3.0, -1.0])]
    got = found(spark, rows)
    assert sorted(r[2] for r in got if r[0] == 0) == [7, 7, 100]
    assert sorted(r[2] for r in got if r[0] == 100) == [0, 0, 7, 7]


@pytest.mark.parametrize("wide", [1.0, 1e9])
def test_scores_are_exact(wide):
    random = np.random.default_rng(1)
    rows, queries = np.floor(random.normal(size=(300, 5)) * wide * 1024), np.floor(random.normal(size=(4, 5)) * wide * 1024)
    place, score, ids = vector_search.best_scores(queries, np.array([3, 500, 501, 502]), rows, np.arange(300), 7)
    for q in range(4):
        bound = (1 << 63) - 1
        exact = [sum(int(a) * int(b) for a, b in zip(queries[q], r)) for r in rows]
        want = sorted((-max(-bound, min(bound, s)), i) for i, s in enumerate(exact) if (q, i) != (0, 3))[:7]
        assert sorted(zip((-score[place == q]).tolist(), ids[place == q].tolist())) == want


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{FOLDER}/embeddings.parquet')")
    rel = con.execute(SQL["op3_vector_search"])
    names = [d[0] for d in rel.description]
    want = {tuple(dict(zip(names, r))[c] for c in ("query_id", "rank", "vec_id", "score")) for r in rel.fetchall()}
    got = {tuple(r) for r in QUERIES["op3_vector_search"](spark, FOLDER).select("query_id", "rank", "vec_id", "score").collect()}
    assert got == want
