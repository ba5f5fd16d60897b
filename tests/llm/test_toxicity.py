from __future__ import annotations

import itertools
import zlib

import numpy as np
from pyspark.sql import functions as F

from ledgerline.llm import toxicity


def test_marginals_match_enumeration():
    rng = np.random.default_rng(0)
    for _ in range(40):
        n = int(rng.integers(1, 7))
        e, t = rng.normal(size=n), rng.normal(size=(2, 2))
        total, single, pairs = 0.0, np.zeros(n), np.zeros((2, 2))
        for states in itertools.product((0, 1), repeat=n):
            w = np.exp(sum(e[i] * states[i] for i in range(n)) + sum(t[states[i - 1], states[i]] for i in range(1, n)))
            total += w
            single += w * np.array(states)
            for i in range(1, n):
                pairs[states[i - 1], states[i]] += w
        marginal, expected = toxicity.marginals(e, t, np.array([n]), pairs=True)
        assert np.allclose(marginal, single / total) and np.allclose(expected, pairs / total)


def test_sequences_are_independent():
    rng = np.random.default_rng(1)
    lengths = np.array([3, 0, 7, 1])
    e, t = rng.normal(size=11), rng.normal(size=(2, 2))
    whole, _ = toxicity.marginals(e, t, lengths)
    parts = [toxicity.marginals(x, t, np.array([len(x)]))[0] for x in np.split(e, [3, 3, 10]) if len(x)]
    assert np.allclose(whole, np.concatenate(parts))


def test_held_out_accuracy_and_spans(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.fit(docs, labels)
    rows = (toxicity.score(docs, model, carry=("text",)).filter(F.crc32(F.col("doc_id").cast("string")) % 3 == 1)
            .join(labels, "doc_id").collect())
    called = [r for r in rows if r.score >= 0.7]
    right = sum(r.toxic for r in called)
    assert right >= 0.95 * len(called)
    assert right >= 0.85 * sum(r.toxic for r in rows)
    words = {r.in_text[s.start:s.end].lower() for r in called for s in r.spans}
    assert "idiot" in words


def test_edges(spark):
    rows = [(i, f"you are an awful brute number {i}", 1) for i in range(30)] + [(100 + i, f"we saw a nice garden at {i} today", 0) for i in range(60)]
    model = toxicity.train([(t, y) for _, t, y in rows])
    texts = [(1, None), (2, ""), (3, "an awful brute"), (3, "an awful brute"), (None, "a nice garden"), (4, "garden " * 30_000), (5, "été awful!brute")]
    df = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "'s' as score", "1 as spans")
    got = toxicity.score(df, model, carry=("score",)).collect()
    assert len(got) == len(texts) and all(0 <= r.score <= 1 for r in got)
    by = {(r.doc_id): r for r in got}
    assert by[3].score > by[4].score and by[1].score == by[2].score and by[1].spans == []
    assert [(s.start, s.end) for s in by[5].spans][-1][1] == len("été awful!brute")
    assert toxicity.score(df.filter("false"), model).collect() == []
    nothing = toxicity.train([])
    assert 0 <= toxicity.score(df, nothing).first().score <= 1


def test_training_rows_leave_out_the_held_out(spark):
    docs = spark.createDataFrame([(i, "t") for i in range(100)] + [(None, "n"), (200, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)] + [(None, 1), (3, None), (200, 1)], "doc_id long, toxic int")
    got = {r.doc_id for r in toxicity.training_rows(docs, labels).collect()}
    assert got == {i for i in range(100) if zlib.crc32(str(i).encode()) % 3 != 1}


def test_toxic_segments_come_from_all_training_rows(monkeypatch):
    """Toxic texts grow shorter with their place, so a prefix has longer segments than all of them."""
    monkeypatch.setattr(toxicity, "MAX_SEGMENTS", 40)
    rows = [(" ".join(["hiss", *["calm"] * (100 if i < 100 else 10)]), 1) for i in range(400)] + [("calm " * 30, 0)] * 3
    rows += [(f"calm day {i} " * 10, 0) for i in range(400)]
    taken = []
    real = toxicity._features
    monkeypatch.setattr(toxicity, "_features", lambda flat, starts: taken.append(starts) or real(flat, starts))
    monkeypatch.setattr(toxicity, "find_evidence", lambda split: {b"hiss": 3})
    toxicity.train(rows)
    lengths = np.diff(taken[0])[:20]
    assert (lengths == 101).any() and (lengths == 11).sum() > 8


def test_training_sums_up_a_few_documents_at_a_time(monkeypatch):
    rows = [(f"calm day {i} " * 5 + ("you vile hiss" if i % 3 == 0 else ""), int(i % 3 == 0)) for i in range(300)]
    sizes = []
    real = toxicity.summaries
    monkeypatch.setattr(toxicity, "summaries", lambda documents, model, known: sizes.append(len(documents)) or real(documents, model, known))
    model = toxicity.train(rows)
    assert sum(sizes) == 300 and max(sizes) <= toxicity.SUMMED
    monkeypatch.setattr(toxicity, "SUMMED", 300)
    assert np.array_equal(model.curve, toxicity.train(rows).curve)
