import math


import numpy as np
import pytest
from test_near_duplicates import roots

from placeweave.llm import embedding_dedup


@pytest.mark.parametrize("chunk", [500, 15])
def test_equals_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(embedding_dedup, "CHUNK_ROWS", chunk)
    rng = np.random.default_rng(chunk)
    rows = []
    centers = rng.standard_normal((12, 16))
    for k in range(300):
        c = centers[min(11, rng.geometric(0.3) - 1)]
        v = c + rng.choice([0.0, 0.05, 0.12, 2.0]) * rng.standard_normal(16)
        rows.append((5000 - k, (v * rng.choice([1, 3, 1e-30])).astype(np.float32).tolist()))
    rows += [(1, None), (2, []), (3, [0.0] * 16), (4, [math.nan] * 16), (5, [1.0, None, 2.0]), (6, [math.inf, 1.0]), (7, [2.0, 1.0]), (8, [4.0, 2.0]), (8, [4.0, 2.0]), (None, [1.0, 5.0]), (9, [-0.0, 1.0]), (10, [0.0, 2.0])]
    df = spark.createDataFrame([(*r, 3, "x") for r in rows], "vec_id long, embedding array<float>, label int, node string").repartition(3)
    got = sorted((tuple(r) for r in embedding_dedup.near_duplicates(df).collect()), key=str)
    n = len(rows)
    good = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    unit = [np.array(v) / max(map(abs, v)) if g else None for (_, v), g in zip(rows, good)]
    near = [[i != j and good[i] and good[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] / np.linalg.norm(unit[i]) / np.linalg.norm(unit[j]) >= 0.9 for j in range(n)] for i in range(n)]
    root = roots(range(n), [(i, j) for i in range(n) for j in range(i) if near[i][j]])
    name = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            name[root[i]] = min(k, name.get(root[i], k))
    expected = [(k, sum(near[i]), c := name.get(root[i]), k == c) for i, (k, _) in enumerate(rows)]
    assert got == sorted(expected, key=str)


def test_empty(spark):
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_recall_at_the_threshold():
    rng = np.random.default_rng(1)
    a = rng.standard_normal((2000, 64))
    b = rng.standard_normal((2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.9 * a + math.sqrt(1 - 0.81) * b / np.linalg.norm(b, axis=1, keepdims=True)
    assert embedding_dedup.layout(0) == embedding_dedup.layout(200_000) == (32, 12)
    for n in (200_000, 5_000_000, 60_000_000):  # more planes and tables, the same recall
        x, y = (embedding_dedup.hashes(v, *embedding_dedup.layout(n)) for v in (a, b))
        assert (x == y).any(axis=1).mean() > 0.99


def test_buckets_keep_their_size():
    for n in (10**6, 10**8, 10**10):
        tables, planes = embedding_dedup.layout(n)
        assert n / 2**planes <= embedding_dedup.BUCKET and tables < 500


def test_more_planes_find_the_same(spark):
    rng = np.random.default_rng(5)
    centers = rng.standard_normal((40, 16))
    rows = [(k, (centers[k % 40] + 0.1 * rng.standard_normal(16)).tolist()) for k in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    tables, planes = embedding_dedup.layout(60_000_000)
    assert planes > 12
    few, many = embedding_dedup.near_duplicates(df), embedding_dedup.near_duplicates(df, tables=tables, planes=planes)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))
