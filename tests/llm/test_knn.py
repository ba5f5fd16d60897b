from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import knn


def brute(rows, k=5):
    ok = [(i, [int(np.floor(256.0 * np.float64(np.float32(x)))) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for i, v in ok:
        if i % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, x, strict=False)), j) for j, x in ok if j != i)[:k]
            out |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(best)}
    return sorted(out)


def got(df, k=5):
    return sorted(map(tuple, knn.top_k(knn.integer_vectors(df), F.col("vec_id") % 50 == 0, k).collect()))


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(spark, monkeypatch, small):
    if small:  # many groups and blocks
        monkeypatch.setattr(knn, "GROUP_QUERIES", 3)
        monkeypatch.setattr(knn, "BLOCK_ROWS", 120)
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    assert got(df) == brute([(r.vec_id, r.embedding) for r in df.collect()])


def test_clusters_are_pruned_without_loss(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 8)) * 20
    rows = [(i, (centres[i % 6] + rng.normal(size=8) * 0.1).astype(np.float32).tolist()) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert got(df) == brute(rows)


def test_edges(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [float("nan"), 1.0]), (4, None), (None, [1.0, 1.0]), (50, [0.5]), (100, []),
            (7, [None, 1.0]), (8, [-3.0, 0.1]), (9, [1.0, 2.0]), (11, [float("inf")]), (150, [0.001, -0.001]), (151, [1e30, -1e30])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as v", "2 as key", "3 as cell")
    clean = [r for r in rows if r[0] != 151]
    assert got(df.filter("vec_id is null or vec_id <> 151")) == brute(clean)
    ends = [r for r in got(df) if r[2] == 151]
    assert all(abs(s) <= 1 << 63 for *_, s in ends)
    assert got(df.filter("false")) == [] and got(df.filter("vec_id = 1")) == [] and got(df.filter("vec_id = 0")) == []
    twice = spark.createDataFrame([(0, [1.0]), (0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert got(twice) == [(0, 1, 1, 256 * 512)]


@pytest.mark.parametrize("step", [0.0, 0.5])
def test_a_query_repeated_often_keeps_its_neighbours(spark, step):
    """Seven rows of one id, in one cell or (step > 0) in a cell each, are no candidates and promise no score."""
    rows = [(50, [20.0 + step * i, 0.0]) for i in range(7)] + [(51 + i, [1.0, float(i)]) for i in range(12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(set(got(df))) == brute(rows)
