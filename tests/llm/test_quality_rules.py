from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from ledgerline.llm import quality


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


def test_counts_match_brute_force(spark):
    texts = ["", " ", "a", "a b c a b c", "x x x x", "a b \x1c c", "l\nl\n \nl\r\nl\n", "é#*<>| ü", "a b c d a b c a b", "\x0b\x0c"]
    for row in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect():
        texts.append((row.text or "")[:4000])
    for text in texts:
        assert quality.base_counts(text) == brute(text), text


def test_distance_is_a_bounded_metric_to_the_nearest():
    reference = np.array([[0.5, 0.5, 0.0, 0.0], [0.0, 0.0, 0.5, 0.5]])
    bins = np.array([0, 1])
    assert quality.distance(np.array([5, 5]), bins, reference) == 0
    assert abs(quality.distance(np.array([10]), np.array([2]), reference) - quality.distance(np.array([10]), np.array([0]), reference)) < 1e-12
    assert 0.99 < quality.distance(np.array([1]), np.array([0]), np.array([[0.0, 1.0]])) <= 1


def test_edges(spark):
    good = "the cat sat on a mat and then it went to sleep near an old door of our house " * 1
    rows = [(1, None, "en"), (2, "", None), (3, good, "en"), (3, good, "en"), (None, "x " * 60, "en"), (4, "y" * 300_000, "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("n", F.lit(1)).withColumn("word", F.lit("w"))
    got = quality.judge(df.repartition(2), carry=("lang", "n")).collect()
    assert len(got) == len(rows)
    by = {(r.doc_id, r.n_words) for r in got}
    assert {(1, 0), (2, 0), (None, 60), (4, 1)} <= by
    assert all(r.base_failed and not r.kept for r in got if r.n_words < 50)
    assert {r.in_lang for r in got} == {"en", None, "de"}
    assert quality.judge(df.filter("false")).collect() == []


def test_junk_goes_and_labelled_good_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = quality.judge(docs).join(labels, "doc_id").filter("not base_failed").select("quality", "kept").collect()
    kept = Counter((r.quality, r.kept) for r in rows)
    assert kept[1, False] <= 0.002 * kept[1, True]
    assert kept[0, False] >= 0.95 * (kept[0, True] + kept[0, False])


def test_rare_languages_are_judged_by_their_own_reference(spark):
    """A language keeps its documents however large the others are; with too little text it has no distance."""
    rng = np.random.default_rng(5)
    greek = ["".join(chr(0x3B1 + c) for c in rng.integers(0, 24, n)) for n in rng.integers(2, 9, 400)]
    share = 1 / np.arange(1, 401)

    def text(letters):
        words = rng.choice(greek, 150, p=share / share.sum())
        return " ".join(words) if letters else " ".join("#$|" for _ in words[:100]) + " " + " ".join(map(str, range(60)))

    latin = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").selectExpr("doc_id", "text", "lang")
    copies = latin.crossJoin(spark.range(4)).drop("id")
    rows = [(-i, text(True), "el") for i in range(1, 31)] + [(-31, text(False), "el")] + [(-40 - i, text(True), "xx") for i in range(3)]
    rare = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    total = copies.count() + len(rows)
    assert 31 < quality.MIN_SHARE * total
    got = {r.doc_id: r for r in quality.judge(copies.unionByName(rare), carry=("lang",)).filter("doc_id < 0").collect()}
    assert len(got) == len(rows)
    assert all(got[-i].kept and got[-i].word_distance < 0.65 and got[-i].in_lang == "el" for i in range(1, 31))
    assert not got[-31].kept
    assert all(got[-40 - i].kept and got[-40 - i].class_distance is None for i in range(3))


def test_common_words_are_limited_before_the_shuffle(spark, monkeypatch):
    real, seen = quality.staged, []
    monkeypatch.setattr(quality, "staged", lambda df, name: seen.append(df) or real(df, name))
    quality.references(spark.createDataFrame([("a b b", "en")], "text string, lang string"))
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_carried_text_goes_to_the_workers_once(spark):
    """doc_id and text are carried from where they already are, unless the operator reads them as another type."""
    from ledgerline.llm import toxicity

    model = toxicity.train([("you fool", 1), ("a fine day", 0)] * 20)
    rows = [(1, "a fine day", "en", 7), (2, None, None, None), (None, "you fool " * 60, "en", 8), (2, "", "de", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, extra int")
    narrow = docs.withColumn("doc_id", F.col("doc_id").cast("int"))
    for whole, again in ((docs, set()), (narrow, {"in_doc_id"})):
        carry = tuple(whole.columns)
        for out in (quality.judge(whole, carry=carry), toxicity.score(whole, model, carry=carry)):
            plan = out._jdf.queryExecution().analyzed().toString()
            assert set(re.findall(r"AS (in_doc_id|in_text)#", plan)) == again
            back = out.select([F.col(f"in_{c}").alias(c) for c in carry])
            assert back.schema == whole.schema
            assert Counter(back.collect()) == Counter(whole.collect())
