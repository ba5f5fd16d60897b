from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import jaccard


def brute(rows, rule):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        k = rule.width
        sets.append(frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= rule.percent * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for n, (i, _) in enumerate(rows):
        if i is not None:
            least[root(n)] = min(least.get(root(n), i), i)
    out = []
    for n, ((i, _), members) in enumerate(zip(rows, sets, strict=True)):
        component = least.get(root(n)) if members else i
        out.append((-1 if i is None else i, len(members), -1 if component is None else component))
    return sorted(out)


def got(df, rule=jaccard.Rule()):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, -1 if r.component_id is None else r.component_id)
                  for r in jaccard.components(df, rule).collect())


EDGES = [(0, None), (1, ""), (2, " \t"), (3, "a b c"), (4, "A B C"), (5, "a b c d"), (6, "a b"), (None, "a b"), (None, "zz yy"), (7, "x"), (8, "x x"),
         (8, "x x"), (9, "é f g h i"), (10, "w " * 30_000), (11, "w " * 20_000)]


def near_copies(n, edits, seed):
    rnd = random.Random(seed)
    base = [rnd.choice("abcdefghijklmnop") + str(rnd.randint(0, 400)) for _ in range(120)]
    rows = []
    for i in range(n):
        w = base[:]
        for _ in range(rnd.randint(0, edits)):
            w[rnd.randrange(len(w))] = "q" + str(rnd.randint(0, 10**6))
        rows.append((100 + i, " ".join(w)))
    return rows


def test_edges(spark):
    df = spark.createDataFrame(EDGES, "doc_id long, text string").selectExpr("*", "1 as n", "2 as cls", "3 as digest")
    assert got(df.repartition(3)) == brute(EDGES, jaccard.Rule())
    assert got(df.filter("false")) == []


@pytest.mark.parametrize("blocks", [False, True])
def test_near_copies(spark, monkeypatch, blocks):
    if blocks:  # lists longer than a block, and joins without broadcasts
        monkeypatch.setattr(jaccard, "BLOCK", 20)
        monkeypatch.setattr(jaccard, "LEADERS", 2)
        monkeypatch.setattr(jaccard, "SMALL_ROWS", 0)
    rows = near_copies(90, 6, 5) + EDGES
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == brute(rows, jaccard.Rule())


def test_one_of_each(spark):
    rows = near_copies(30, 2, 7) + EDGES
    rule = jaccard.Rule(5, 80)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    left = sorted((-1 if r.doc_id is None else r.doc_id) for r in jaccard.one_of_each(df, rule).collect())
    want = brute(rows, rule)
    assert {i for i in left if i >= 0} == {c for _, _, c in want if c >= 0}
    assert left.count(8) == 1 and left.count(-1) == 2


def test_one_of_each_where_rows_share_an_id(spark):
    a, b, c = (" ".join(f"{w}{i}" for i in range(40)) for w in "abc")
    rows = [(5, a), (5, b), (5, b), (7, b + " more"), (3, c), (9, c + " more"), (9, "another text of some six words"), (9, ""), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("en"))
    left = sorted(((r.doc_id, r.text or "") for r in jaccard.one_of_each(df.repartition(3), jaccard.Rule(5, 80)).select("doc_id", "text").collect()))
    assert left == [(3, c), (5, a), (5, b), (9, ""), (9, ""), (9, "another text of some six words")]


def test_bitmaps_bound_the_difference():
    import numpy as np

    rng = np.random.default_rng(3)
    for n in (1, 5, 40, 300):
        a = np.unique(rng.integers(0, 2**62, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[: n * 9 // 10], rng.integers(0, 2**62, 3 * n // 2).astype(np.uint64)]))
        x, y = (np.frombuffer(jaccard.parity_bitmap(m), np.uint64) for m in (a, b))
        size = min(len(x), len(y))
        assert np.bitwise_count(jaccard.folded(x, size) ^ jaccard.folded(y, size)).sum() <= len(np.setxor1d(a, b))


def test_bitmaps_stay_small():
    import numpy as np

    assert [8 * len(jaccard.parity_bitmap(np.arange(n, dtype=np.uint64))) for n in (1, 65, 300, 1024)] == [64, 128, 512, 1024]
