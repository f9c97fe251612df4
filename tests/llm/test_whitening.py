"""Whitening against numpy on all rows at once."""

import math

import numpy as np
import pytest

from lakestay.llm import whitening as wh
from lakestay.llm.entries import QUERIES
from tests.llm.common import FOLDER


def plain(vectors, most=32):
    """Deviations, whitened rows and shares by a decomposition of the centred rows."""
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(0)
    centred = (x * n - sums) / n
    _, size, axes = np.linalg.svd(centred, full_matrices=False)
    kept = min(most, int((size > size[0] * 1e-11).sum()))
    values, axes = size[:kept] ** 2 / n, axes[:kept].T
    return ((x * n - sums) ** 2).sum(1), centred @ axes / np.sqrt(values), values / (size**2 / n).sum()


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def matrix(df, ids, column):
    rows = {(r["vec_id"], r["component"]): r[column] for r in df}
    return np.array([[rows[i, c] for c in range(1, 1 + max(c for _, c in rows))] for i in ids])


def test_query(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    ids = [r["vec_id"] for r in table]
    deviation, white, share = plain([r["embedding"] for r in table])
    got = QUERIES["op12_whitening"](spark, FOLDER)
    assert dict(got.dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
        "explained": "double", "identity_error": "double",
    }
    got = got.collect()
    assert len(got) == 32 * len(ids) and {r["n"] for r in got} == {len(ids)}
    found = matrix(got, ids, "whitened")
    sign = np.sign((found * white).sum(0))
    assert np.abs(found * sign - white).max() < 1e-8
    assert np.allclose(matrix(got, ids, "explained")[0], share, rtol=1e-10)
    assert (matrix(got, ids, "deviation")[:, 0] == deviation).all()
    assert {r["identity_error"] for r in got}.pop() < 1e-12


def test_far_from_round_and_dependent_dimensions(spark):
    """Deviations from 1 to 2^20, a repeated dimension, a constant one and a sum of two."""
    r = np.random.default_rng(1)
    base = r.normal(size=(300, 6)) * 2.0 ** np.array([16, 12, 8, 4, 0, -3])
    vectors = np.column_stack([base, base[:, 1], np.full(300, 7.0), np.floor(64 * base[:, :2]).sum(1) / 64])
    vectors[:, :2] = np.floor(64 * vectors[:, :2]) / 64
    vectors[:, 6] = vectors[:, 1]
    rows = [(i, v, None) for i, v in enumerate(vectors.tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5)
    model = wh.fit(df)
    _, white, share = plain(vectors)
    assert len(model.eigenvalues) == len(share) == 6 and model.rounds < wh.MOST_ROUNDS
    assert np.allclose(model.eigenvalues / model.trace, share, rtol=1e-6)
    assert wh.identity_error(df, model) < 1e-6
    found = matrix(wh.whitened_components(df).collect(), range(300), "whitened")
    sign = np.sign((found * white).sum(0))
    assert np.abs(found * sign - white).max() < 1e-5


def test_rows_of_all_kinds(spark):
    good = [(i, [math.sin(i), math.cos(3 * i), i % 5 / 4], 0) for i in range(40)]
    bad = [
        (100, None, 0), (101, [], 0), (102, [None, 1.0, 2.0], 0), (103, [math.nan, 1.0, 2.0], 0),
        (104, [math.inf, 0.0, 0.0], 0), (105, [1.0, 2.0], 0), (106, [3e38, 0.0, 0.0], 0),
    ]
    extra = [(None, [0.5, 0.25, -1.0], None), (7, good[7][1], 1)]
    df = frame(spark, good + bad + extra)
    want = wh.whitened_components(frame(spark, good + extra)).collect()
    got = wh.whitened_components(df.withColumnRenamed("label", "whitened").selectExpr("*", "1 as component")).collect()
    key = lambda r: (r["vec_id"] is None, r["vec_id"], r["component"], r["whitened"])
    assert len(got) == 42 * 3
    for a, b in zip(sorted(got, key=key), sorted(want, key=key)):
        assert (a["vec_id"], a["component"], a["n"], a["deviation"]) == (b["vec_id"], b["component"], 42, b["deviation"])
        assert abs(abs(a["whitened"]) - abs(b["whitened"])) < 1e-9


@pytest.mark.parametrize("rows", [[], [(1, None, 0)], [(1, [0.5, 1.0], 0)], [(1, [0.5], 0), (2, [0.5], 0)]])
def test_nothing_to_whiten(spark, rows):
    assert wh.whitened_components(frame(spark, rows)).count() == 0


def test_deviations_beyond_64_bits(spark):
    rows = [(i, [float(2**40 * (i % 3)), 0.0], 0) for i in range(3)]
    got = wh.whitened_components(frame(spark, rows)).collect()
    x = [64 * 2**40 * (i % 3) + 1_000_000 for i in range(3)]
    assert {r["vec_id"]: int(r["deviation"]) for r in got} == {i: (3 * x[i] - sum(x)) ** 2 for i in range(3)}
