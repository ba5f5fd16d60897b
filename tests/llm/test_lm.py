from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import lm

def HELD():
    return F.crc32(F.col("doc_id").cast("string")) % 7 == 2


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def tokens(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower()) + [b""]


def brute(rows):
    counts = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    total, distinct = sum(counts.values()), len(counts)
    return sorted((i if i is not None else -1, held(i), len(w), sum(x in counts for x in w), total,
                   round(sum(math.log10((counts[x] + 1) / (total + distinct + 1)) for x in w), 6))
                  for i, t in rows for w in [tokens(t)])


def got(df, settings=lm.Settings()):
    return sorted((r.doc_id if r.doc_id is not None else -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                  for r in lm.score(df, HELD(), settings).collect())


EDGES = [(0, None), (1, ""), (2, " \t\n"), (3, "A a B"), (3, "A a B"), (4, "É é x"), (None, "a b"), (5, "a " * 5000), (6, "\x1cq"), (9, "new words"),
         (16, "a b a b"), (23, "only held out")]


@pytest.mark.parametrize("small", [False, True])
def test_base_score_is_exact(spark, monkeypatch, small):
    if small:  # several rounds, a small dictionary, many flushes
        monkeypatch.setattr(lm, "SEGMENT_TOKENS", 1000)
        monkeypatch.setattr(lm, "ROUND_BYTES", 4000)
        monkeypatch.setattr(lm, "DICTIONARY", 2)
    df = spark.createDataFrame(EDGES, "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("row", F.lit(2))
    assert got(df.repartition(3)) == brute(EDGES)
    assert lm.score(df.filter("false"), HELD()).collect() == []


def test_rounds_give_the_scores_of_one_filter(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one = {r.doc_id: r.score for r in lm.score(docs, HELD(), lm.Settings(bits=40, probes=20)).collect()}
    monkeypatch.setattr(lm, "SEGMENT_TOKENS", 20_000)
    monkeypatch.setattr(lm, "ROUND_BYTES", 200_000)
    many = {r.doc_id: r.score for r in lm.score(docs, HELD(), lm.Settings(bits=40, probes=20)).collect()}
    assert one.keys() == many.keys()
    assert max(abs(one[i] / many[i] - 1) for i in one) < 1e-9


def test_better_than_unigrams_on_held_out_text(spark):
    rows = lm.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), HELD()).filter("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_levels_are_never_too_low():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 2**62, 20_000).astype(np.uint64))
    counts = (rng.pareto(1.0, len(keys)) + 1).astype(np.int64)
    levels = 1 + np.floor(np.log2(counts) + 1e-9).astype(int)
    size = np.uint64(-(-int(levels.sum()) * 10 // 8) * 8)
    bits = np.zeros(int(size), bool)
    for level in range(1, levels.max() + 1):
        for at in lm._places(keys[levels >= level], level, 5, size):
            bits[at] = True
    found = lm.Filter.of([(0, np.packbits(bits).tobytes())], 1, 5).levels(keys)
    assert (found >= levels).all()
    assert (found > levels).mean() < 0.03


def test_trigrams_see_their_order():
    block = lm.Block.of(["a b c", "c b a"], 3)
    third = block.grams()[2][block.tokens()]
    assert len(set(third.tolist())) == 8
    assert block.lengths.tolist() == [4, 4]


def test_a_worker_sorts_no_more_than_a_segment_and_gives_memory_back(spark, monkeypatch):
    """A segment holds about 2^20 tokens, however many there are; each task on texts or segments ends with a trim."""
    asked = []
    monkeypatch.setattr(lm, "filter_segments", lambda texts, segments, settings: asked.append(segments) or (_ for _ in ()).throw(StopIteration))
    wrapped = []
    monkeypatch.setattr(lm, "trimmed", lambda run: wrapped.append(run) or run, raising=False)
    monkeypatch.setattr(lm, "staged", lambda df, name: spark.createDataFrame([("a", 5 << 20)], "word string, c long"))
    with pytest.raises((StopIteration, RuntimeError)):
        lm.score(spark.createDataFrame([(0, "a")], "doc_id long, text string"), HELD())
    assert asked == [5] and len(wrapped) == 1
