from __future__ import annotations

import re

import numpy as np
import pytest

from ledgerline.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def places(text):
    w = words_of(text)
    return sorted((i, label) for phrase, label in licenses.PHRASES.items() for i in range(len(w))
                  if w[i:i + len(phrase.split())] == phrase.split())


def brute_kept(rules, text):
    """All rules without the keyword gate; containment compared pair by pair."""
    line = " ".join(words_of(text)).encode().decode("latin-1")
    found = [(i, len(line[:m.start()].split()), len(line[:m.end()].split()))
             for i, r in enumerate(rules) for m in re.finditer(f"(?<![^ ])(?:{r.pattern})(?![^ ])", line)]

    def beats(a, b):
        x, y = (rules[a[0]].priority, a[2] - a[1], -a[0]), (rules[b[0]].priority, b[2] - b[1], -b[0])
        return a[1] <= b[1] and a[2] >= b[2] and x > y

    return sorted((f[1], f[2], rules[f[0]].name, not any(beats(o, f) for o in found)) for f in found)


def test_hundreds_of_rules_whose_keyword_is_part_of_every_match():
    rules = licenses.hand_written()
    assert len(rules) > 250 and len({r.name for r in rules}) == len(rules)
    for r in rules:
        text = re.sub(r"\[\^ \]\+ \)\{\d,\d+\}", "x )", r.pattern)
        assert r.keyword.split()[0] in text.replace("\xc3\xa9", "\xc3\xa9")


TEXTS = [
    None, "", " \n ", "all rights reserved", "ALL Rights, reserved. all rights reserved",
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "// SPDX-License-Identifier: GPL-2.0-or-later\nGNU General Public License version 2", "cc by cc by cc-by-sa 4.0", "ccby cc byte",
    "Copyright (c) 2020 by Ada. All rights reserved. Tous droits réservés. été cc by",
    "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License " * 3,
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
]


@pytest.mark.parametrize("text", TEXTS)
def test_a_text_equals_brute_force(text):
    rules = licenses.hand_written()
    n, hits = licenses.Scanner(rules).scan((text or "").encode())
    assert n == len(words_of(text))
    assert sorted((a, b, rules[i].name, kept) for i, a, b, kept in hits) == brute_kept(rules, text)
    assert sorted((a, rules[i].label) for i, a, _, _ in hits if rules[i].phrase) == places(text)


def test_containment_equals_comparing_all_pairs():
    rng = np.random.default_rng(3)
    rules = [licenses.Rule(f"r{i}", "x", "x", "x", int(rng.integers(0, 3)), 0.5) for i in range(9)]
    scanner = licenses.Scanner(rules)
    for _ in range(50):
        n = int(rng.integers(1, 40))
        rule, first = rng.integers(0, 9, n), rng.integers(0, 30, n)
        cases = np.unique(np.stack([rule, first, first + rng.integers(1, 8, n)], 1), axis=0)
        rule, first, after = cases.T
        order = [(rules[r].priority, b - a, -r) for r, a, b in cases.tolist()]
        want = [not any(first[j] <= first[i] and after[j] >= after[i] and order[j] > order[i] for j in range(len(cases))) for i in range(len(cases))]
        assert scanner.uncontained(rule, first, after).tolist() == want


def test_rows_of_all_kinds(spark):
    rows = [(i, t, "clash", 1) for i, t in enumerate(TEXTS)] + [(0, "mit license", "c", 2), (0, "mit license", "c", 2), (None, "cc by", None, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, detections string, n_words int")
    got = licenses.digest(licenses.scan(df)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got if r.doc_id not in (0, None)}
    for i, text in enumerate(TEXTS[1:], 1):
        at = places(text)
        r = by_id[i]
        assert (r.n_base, r.first_word, r.last_word) == (len(at), at[0][0] if at else None, at[-1][0] if at else None)
        assert r.base_labels == ",".join(sorted({x for _, x in at}))
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
    assert [r.labels for r in got if r.doc_id == 0].count("mit") == 2
    assert by_id[1].score == 0 and by_id[1].labels == ""
    assert licenses.digest(licenses.scan(df.filter("false"))).count() == 0


def test_a_very_long_text_is_scanned_whole(spark):
    text = "filler words " * 300_000 + "all rights reserved"
    r = licenses.digest(licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string"))).first()
    assert (r.n_words, r.first_word, r.n_base) == (600_003, 600_000, 1)
