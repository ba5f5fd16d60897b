from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerline.llm import phrases

SCHEMA = "text string, lang string"


def brute(rows, support=30, best=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i:i + m]) for m in range(1, 5) for i in range(len(w) - m + 1))
    cand = {p: a for p, a in f.items() if len(p) > 2 and a >= support}
    out = []
    for lang in n:
        mine = {p[1:]: a for p, a in cand.items() if p[0] == lang}
        gone = {p[i:j] for p, a in mine.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                if j - i < len(p) and 100 * a >= 80 * mine[p[i:j]]}
        scored = []
        for p, a in mine.items():
            if p not in gone:
                s, k = min((2_000_000 * a // (f[lang, *p[:k]] + f[lang, *p[k:]]), k) for k in range(1, len(p)))
                scored.append((-s, -a, " ".join(p).encode(), f[lang, *p[:k]], f[lang, *p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, r, n[lang], -s) for i, (s, a, p, left, r) in enumerate(sorted(scored)[:best])]
    return sorted(out)


def texts(seed, n=160):
    rng = random.Random(seed)
    vocabulary = ["New", "york", "city", "hall", "über", "a", "b", "c", "d-1", "\x1cx", "日本", "rare"] + [f"w{i}" for i in range(15)]
    ends = [" ", "  ", "\t", ". ", ",", "\n", "\r\n", " ! ", "\x0b"]
    rows = []
    for i in range(n):
        words = rng.choices(vocabulary, [9, 8, 7, 3, 4, 9, 9, 5, 3, 3, 3, 0.1] + [1] * 15, k=rng.randint(0, 60))
        body = "".join(w + rng.choices(ends, [30, 1, 1, 1, 1, 1, 1, 1, 1])[0] for w in words)
        rows.append((body + "new york city hall " * rng.randint(0, 2), rng.choice(["en", "de", None, "und"])))
    return rows + [(None, "en"), ("", None), (" . ! ", "xx"), ("a a a a a a " * 9, "rep")]


@pytest.mark.parametrize("trie", [1 << 18, 7])
def test_equals_brute_force(spark, trie):
    rows = texts(2, 900)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as phrase", "2 as f", "3 as words").repartition(5)
    want = brute(rows)
    assert len(want) > 30 and sorted(map(tuple, phrases.mine(df, trie_phrases=trie).collect())) == want


def test_reads_of_the_blocks_do_not_grow_with_the_tries(spark, monkeypatch):
    made, staged = [], phrases.staged
    monkeypatch.setattr(phrases, "staged", lambda df, name: made.append(name) or staged(df, name))
    rows = texts(5, 700)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = brute(rows)
    for at_once, reads in ((100, 1), (4, 2)):  # 171 candidates: six tries
        monkeypatch.setattr(phrases, "TRIES_AT_ONCE", at_once, raising=False)
        made.clear()
        got = sorted(map(tuple, phrases.mine(df, trie_phrases=29).collect()))
        assert got == want and made.count("counts") == reads


def test_counts_are_reported_before_they_overflow(spark, monkeypatch):
    monkeypatch.setattr(phrases, "FULL", 500)
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 200)
    rows = texts(2, 300)
    assert sorted(map(tuple, phrases.mine(spark.createDataFrame(rows, SCHEMA).repartition(1)).collect())) == brute(rows)


def test_best_of_each_language_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 200)
    monkeypatch.setattr(phrases, "BITS", 5)  # collisions everywhere: more is counted, nothing else changes
    rows = texts(3, 120)
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, phrases.mine(df, per_lang=6).collect())) == brute(rows, best=6)


def test_empty_tables_and_unsupported_phrases(spark):
    df = spark.createDataFrame([("one two three", "en")], SCHEMA)
    assert phrases.mine(df).collect() == [] and phrases.mine(df.filter("false")).collect() == []


def test_one_very_long_text(spark):
    rows = [("alpha beta gamma delta " * 60_000, "en")]
    assert sorted(map(tuple, phrases.mine(spark.createDataFrame(rows, SCHEMA)).collect())) == brute(rows)


def test_trie_counts_what_a_search_finds():
    rng = np.random.default_rng(8)
    ids = rng.integers(0, 12, 5000)
    listed = sorted({tuple(rng.integers(1, 12, rng.integers(2, 5)).tolist()) for _ in range(300)})
    want = [sum(tuple(ids[i:i + len(p)].tolist()) == p for i in range(len(ids))) for p in listed]
    assert phrases.Trie(listed, 11).count(ids).tolist() == want
