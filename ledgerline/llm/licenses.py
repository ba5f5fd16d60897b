"""License scan by ordered signature rules.

A rule is a regex over a document's words (lower-cased, joined by single spaces), a label, a priority
and a confidence. One Aho-Corasick pass over the text finds which keywords it holds; only rules whose
keyword is there run. Detections are word intervals; one that lies inside a detection of higher priority,
or inside a longer or earlier listed one of the same priority, is suppressed. Phrase rules state plain
facts about a text (``phrase_rules``): their places are reported whether suppressed or not.

Nothing is shuffled: each document is scanned where it is read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, per_process


class Rule(NamedTuple):
    name: str
    label: str
    keyword: str  # words without which the pattern can't match
    pattern: str
    priority: int
    confidence: float
    phrase: bool = False


TEXT, NOTICE, TAG, NAME, LINK, HINT = 60, 50, 40, 30, 20, 10

#: The phrases every scan reports and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# label; keyword and pattern of the name; pattern of the identifier; pattern of the address
_LICENSES = (
    ("apache-2.0", "apache", "apache (?:software )?license(?: version)? 2(?: 0)?", "apache 2 0", "apache org licenses license 2 0"),
    ("apache-1.1", "apache", "apache (?:software )?license(?: version)? 1 1", "apache 1 1", "apache org licenses license 1 1"),
    ("mit", "mit", "mit (?:expat |x11 )?licen[sc]e", "mit", "opensource org licenses mit(?: license)?"),
    ("mit-0", "mit", "mit no attribution(?: license)?", "mit 0", "opensource org licenses mit 0"),
    ("bsd-2-clause", "bsd", "(?:simplified|freebsd|2 clause|two clause) bsd licen[sc]e", "bsd 2 clause", "opensource org licenses bsd 2 clause"),
    ("bsd-3-clause", "bsd", "(?:new|revised|modified|3 clause|three clause) bsd licen[sc]e", "bsd 3 clause", "opensource org licenses bsd 3 clause"),
    ("bsd-4-clause", "bsd", "(?:original|old|4 clause|four clause) bsd licen[sc]e", "bsd 4 clause", "spdx org licenses bsd 4 clause"),
    ("0bsd", "bsd", "(?:zero clause|0 clause) bsd(?: licen[sc]e)?", "0bsd", "opensource org licenses 0bsd"),
    ("isc", "isc", "isc licen[sc]e", "isc", "opensource org licenses isc(?: license)?"),
    ("gpl-1.0", "gnu", "gnu general public license v(?:ersion)? ?1(?: 0)?", "gpl 1 0(?: only| or later)?", "gnu org licenses old licenses gpl 1 0"),
    ("gpl-2.0", "gnu", "gnu general public license v(?:ersion)? ?2(?: 0)?", "gpl 2 0(?: only| or later)?", "gnu org licenses (?:old licenses )?gpl 2 0"),
    ("gpl-3.0", "gnu", "gnu general public license v(?:ersion)? ?3(?: 0)?", "gpl 3 0(?: only| or later)?", "gnu org licenses gpl 3 0"),
    ("lgpl-2.0", "gnu", "gnu library general public license(?: v(?:ersion)? ?2(?: 0)?)?", "lgpl 2 0(?: only| or later)?", "gnu org licenses (?:old licenses )?lgpl 2 0"),
    ("lgpl-2.1", "gnu", "gnu lesser general public license v(?:ersion)? ?2 1", "lgpl 2 1(?: only| or later)?", "gnu org licenses (?:old licenses )?lgpl 2 1"),
    ("lgpl-3.0", "gnu", "gnu lesser general public license v(?:ersion)? ?3(?: 0)?", "lgpl 3 0(?: only| or later)?", "gnu org licenses lgpl 3 0"),
    ("agpl-3.0", "gnu", "gnu affero general public license(?: v(?:ersion)? ?3(?: 0)?)?", "agpl 3 0(?: only| or later)?", "gnu org licenses agpl 3 0"),
    ("gfdl-1.3", "gnu", "gnu free documentation license(?: v(?:ersion)? ?1 [123])?", "gfdl 1 [123](?: only| or later)?", "gnu org (?:licenses|copyleft) fdl(?: 1 [123])?"),
    ("mpl-1.1", "mozilla", "mozilla public license(?: v(?:ersion)?)? 1 1", "mpl 1 1", "mozilla org mpl mpl 1 1"),
    ("mpl-2.0", "mozilla", "mozilla public license(?: v(?:ersion)?)? 2(?: 0)?", "mpl 2 0", "mozilla org (?:en us )?mpl 2 0"),
    ("epl-1.0", "eclipse", "eclipse public license(?: v(?:ersion)?)? 1(?: 0)?", "epl 1 0", "eclipse org legal epl v10"),
    ("epl-2.0", "eclipse", "eclipse public license(?: v(?:ersion)?)? 2(?: 0)?", "epl 2 0", "eclipse org legal epl (?:v20|2 0)"),
    ("cddl-1.0", "development", "common development and distribution license", "cddl 1 [01]", "opensource org licenses cddl(?:1| 1 0)"),
    ("cpl-1.0", "common", "common public license", "cpl 1 0", "opensource org licenses cpl(?:1 0)?"),
    ("eupl-1.2", "union", "european union public licen[sc]e", "eupl 1 [12]", "joinup ec europa eu [^ ]+ eupl"),
    ("artistic-2.0", "artistic", "artistic license(?: 2(?: 0)?)?", "artistic [12] 0", "opensource org licenses artistic(?: license)? 2 0"),
    ("bsl-1.0", "boost", "boost software license", "bsl 1 0", "boost org license 1 0 txt"),
    ("busl-1.1", "business", "business source license", "busl 1 1", "mariadb com bsl11"),
    ("sspl-1.0", "side", "server side public license", "sspl 1 0", "mongodb com licensing server side public license"),
    ("zlib", "zlib", "zlib(?: libpng)? licen[sc]e", "zlib", "zlib net zlib license html"),
    ("libpng", "libpng", "libpng license", "libpng(?: 2 0)?", "libpng org pub png src libpng license txt"),
    ("openssl", "openssl", "openssl licen[sc]e", "openssl", "openssl org source license html"),
    ("python-2.0", "python", "python software foundation license", "(?:python|psf) 2 0", "docs python org [^ ]+ license html"),
    ("php-3.01", "php", "php license", "php 3 01", "php net license 3 01 txt"),
    ("ruby", "ruby", "ruby licen[sc]e", "ruby", "ruby lang org en about license txt"),
    ("postgresql", "postgresql", "postgresql licen[sc]e", "postgresql", "postgresql org about licen[sc]e"),
    ("unlicense", "unlicense", "(?:the )?unlicense", "unlicense", "unlicense org"),
    ("wtfpl", "public", "do what the [^ ]+ you want to public license", "wtfpl", "wtfpl net"),
    ("ncsa", "ncsa", "(?:illinois )?ncsa open source license", "ncsa", "opensource org licenses (?:ncsa|uoi ncsa php)"),
    ("ofl-1.1", "open", "(?:sil )?open font license", "ofl 1 [01]", "scripts sil org ofl"),
    ("odbl-1.0", "database", "open (?:data commons open )?database license", "odbl 1 0", "opendatacommons org licenses odbl"),
    ("odc-by-1.0", "attribution", "open data commons attribution license", "odc by 1 0", "opendatacommons org licenses by"),
    ("pddl-1.0", "dedication", "public domain dedication and license", "pddl 1 0", "opendatacommons org licenses pddl"),
    ("cc0-1.0", "cc0", "cc0(?: 1 0)?(?: universal)?", "cc0 1 0", "creativecommons org publicdomain zero 1 0"),
    ("cc-by-4.0", "attribution", "creative commons attribution 4 0(?: international)?", "cc by 4 0", "creativecommons org licenses by 4 0"),
    ("cc-by-3.0", "attribution", "creative commons attribution 3 0(?: unported)?", "cc by 3 0", "creativecommons org licenses by 3 0"),
    ("cc-by-sa-4.0", "alike", "creative commons attribution share ?alike 4 0(?: international)?", "cc by sa 4 0", "creativecommons org licenses by sa 4 0"),
    ("cc-by-sa-3.0", "alike", "creative commons attribution share ?alike 3 0(?: unported)?", "cc by sa 3 0", "creativecommons org licenses by sa 3 0"),
    ("cc-by-nc-4.0", "commercial", "creative commons attribution non ?commercial 4 0(?: international)?", "cc by nc 4 0", "creativecommons org licenses by nc 4 0"),
    ("cc-by-nd-4.0", "derivatives", "creative commons attribution no ?derivatives 4 0(?: international)?", "cc by nd 4 0", "creativecommons org licenses by nd 4 0"),
    ("cc-by-nc-sa-4.0", "commercial", "creative commons attribution non ?commercial share ?alike 4 0(?: international)?", "cc by nc sa 4 0", "creativecommons org licenses by nc sa 4 0"),
    ("cc-by-nc-nd-4.0", "commercial", "creative commons attribution non ?commercial no ?derivatives 4 0(?: international)?", "cc by nc nd 4 0", "creativecommons org licenses by nc nd 4 0"),
    ("elastic-2.0", "elastic", "elastic license(?: 2 0)?", "elastic 2 0", "elastic co licensing elastic license"),
    ("ms-pl", "microsoft", "microsoft public license", "ms pl", "opensource org licenses ms pl"),
    ("ms-rl", "microsoft", "microsoft reciprocal license", "ms rl", "opensource org licenses ms rl"),
    ("osl-3.0", "open", "open software license(?: v(?:ersion)?)? 3 0", "osl 3 0", "opensource org licenses osl 3 0"),
    ("afl-3.0", "academic", "academic free license(?: v(?:ersion)?)? 3 0", "afl 3 0", "opensource org licenses afl 3 0"),
    ("upl-1.0", "universal", "universal permissive license", "upl 1 0", "oss oracle com licenses upl"),
    ("w3c", "w3c", "w3c software (?:notice and )?license", "w3c", "w3 org consortium legal"),
)

# sentences of licenses and notices: name, label, keyword, pattern, priority, confidence
_SENTENCES = (
    ("mit-grant", "mit", "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", TEXT, 0.95),
    ("mit-warranty", "mit", "the software is provided as is", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability", TEXT, 0.8),
    ("isc-grant", "isc", "permission to use copy modify", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", TEXT, 0.95),
    ("bsd-grant", "bsd", "redistribution and use in source", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", TEXT, 0.9),
    ("bsd-3-name", "bsd-3-clause", "endorse or promote", "neither the name of (?:[^ ]+ ){1,12}nor the names of its contributors may be used to endorse or promote products", TEXT, 0.95),
    ("bsd-4-advert", "bsd-4-clause", "advertising materials", "all advertising materials mentioning features or use of this software must display", TEXT, 0.95),
    ("bsd-warranty", "bsd", "this software is provided by", "this software is provided by the (?:[^ ]+ ){1,8}as is and any express or implied warranties", TEXT, 0.8),
    ("gpl-notice", "gpl", "redistribute it and or modify", "you can redistribute it and or modify it under the terms of the gnu general public license", TEXT, 0.95),
    ("lgpl-notice", "lgpl", "redistribute it and or modify", "you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license", TEXT, 0.95),
    ("agpl-notice", "agpl-3.0", "redistribute it and or modify", "you can redistribute it and or modify it under the terms of the gnu affero general public license", TEXT, 0.95),
    ("gpl-warranty", "gpl", "without any warranty", "without any warranty without even the implied warranty of merchantability or fitness for a particular purpose", TEXT, 0.7),
    ("gpl-or-later", "gpl", "any later version", "either version [23] of the license or at your option any later version", TEXT, 0.7),
    ("apache-notice", "apache-2.0", "licensed under the apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", TEXT, 0.98),
    ("apache-as-is", "apache-2.0", "as is basis", "distributed on an as is basis without warranties or conditions of any kind", TEXT, 0.7),
    ("mpl-notice", "mpl-2.0", "source code form", "this source code form is subject to the terms of the mozilla public license v 2 0", TEXT, 0.98),
    ("zlib-grant", "zlib", "permission is granted", "permission is granted to anyone to use this software for any purpose including commercial applications", TEXT, 0.9),
    ("boost-grant", "bsl-1.0", "boost software license", "distributed under the boost software license version 1 0", TEXT, 0.95),
    ("unlicense-grant", "unlicense", "unencumbered software", "this is free and unencumbered software released into the public domain", TEXT, 0.98),
    ("public-domain-release", "public-domain", "public domain", "(?:placed|released|dedicated|is) (?:in|into|to) the public domain", NOTICE, 0.8),
    ("public-domain", "public-domain", "public domain", "(?:in the )?public domain", HINT, 0.4),
    ("cc-notice", "cc", "creative commons", "licensed under a creative commons (?:[^ ]+ ){0,6}licen[sc]e", NOTICE, 0.8),
    ("cc-name", "cc", "creative commons", "creative commons(?: licen[sc]e)?", HINT, 0.5),
    ("cc-by-sa", "cc-by-sa", "cc by sa", "cc by sa", NAME, 0.7),
    ("cc-by-nc", "cc-by-nc", "cc by nc", "cc by nc", NAME, 0.7),
    ("cc-by-nd", "cc-by-nd", "cc by nd", "cc by nd", NAME, 0.7),
    ("cc-by-nc-sa", "cc-by-nc-sa", "cc by nc sa", "cc by nc sa", NAME, 0.8),
    ("cc-by-nc-nd", "cc-by-nc-nd", "cc by nc nd", "cc by nc nd", NAME, 0.8),
    ("gpl-short", "gpl", "gpl", "(?:gnu )?gpl(?: ?v?[123](?: 0)?)?", HINT, 0.5),
    ("lgpl-short", "lgpl", "lgpl", "(?:gnu )?lgpl(?: ?v?[23](?: [01])?)?", HINT, 0.5),
    ("lgpl-name", "lgpl", "lesser general public license", "(?:gnu )?lesser general public license", NAME, 0.7),
    ("gpl-name", "gpl", "general public license", "gnu general public license", NAME, 0.7),
    ("bsd-name", "bsd", "bsd", "bsd(?: style)? licen[sc]e", NAME, 0.6),
    ("mpl-name", "mpl", "mozilla public license", "mozilla public license", NAME, 0.6),
    ("copyright-reserved", "reserved", "all rights reserved", "copyright (?:c )?(?:[0-9]{4} )?(?:[^ ]+ ){0,6}all rights reserved", NOTICE, 0.8),
    ("copyright-line", "copyright", "copyright", "copyright (?:c )?(?:by )?(?:19|20)[0-9]{2}", NOTICE, 0.6),
    ("copyright-some", "some-reserved", "some rights reserved", "some rights reserved", NAME, 0.6),
    ("no-rights", "public-domain", "no rights reserved", "no rights reserved", NAME, 0.7),
    ("proprietary", "proprietary", "proprietary", "(?:proprietary and confidential|confidential and proprietary)", NOTICE, 0.9),
    ("no-reproduction", "proprietary", "may be reproduced", "no part of this (?:[^ ]+ ){1,3}may be reproduced", NOTICE, 0.9),
    ("no-redistribution", "proprietary", "prohibited", "(?:unauthorized|unauthorised) (?:copying|use|distribution|reproduction) (?:[^ ]+ ){0,12}is (?:strictly )?prohibited", NOTICE, 0.85),
    ("written-permission", "proprietary", "written permission", "without (?:the )?(?:prior |express )?(?:prior )?written permission", HINT, 0.4),
    ("eula", "proprietary", "end user license agreement", "end user license agreement", NAME, 0.7),
    ("personal-use", "non-commercial", "personal", "for personal (?:and )?(?:non ?commercial )?use only", NOTICE, 0.7),
    ("non-commercial", "non-commercial", "commercial", "(?:non ?commercial|not for commercial) (?:use|purposes)(?: only)?", HINT, 0.5),
    ("research-only", "research-only", "research", "for (?:academic (?:or |and )?)?research (?:purposes|use) only", NOTICE, 0.7),
    ("same-terms", "perl", "perl itself", "under the same terms as perl itself", NOTICE, 0.9),
    ("permission-to-copy", "permissive", "copying and distribution", "copying and distribution of this file with or without modification are permitted in any medium without royalty", TEXT, 0.9),
    ("crown", "crown-copyright", "crown copyright", "crown copyright", NAME, 0.7),
    ("ogl", "ogl-3.0", "open government licen", "open government licen[sc]e(?: v3 0)?", NAME, 0.8),
    ("used-with-permission", "permission", "permission", "(?:used|reprinted|reproduced) (?:here )?(?:with|by) (?:kind )?permission", NOTICE, 0.6),
    ("dual", "dual", "dual licensed", "dual licensed under", HINT, 0.4),
    ("see-license", "unknown", "see", "see (?:the )?(?:file )?(?:license|copying)(?: file| txt| md)? for (?:more )?(?:details|information|terms)", HINT, 0.4),
    ("licensed-under", "unknown", "licensed under", "licensed under the (?:[^ ]+ ){1,4}licen[sc]e", HINT, 0.4),
    ("reserved-de", "reserved", "alle rechte vorbehalten", "alle rechte vorbehalten", NAME, 0.7),
    ("reserved-fr", "reserved", "tous droits", "tous droits r\xc3\xa9serv\xc3\xa9s", NAME, 0.7),
    ("reserved-es", "reserved", "todos los derechos reservados", "todos los derechos reservados", NAME, 0.7),
)


def phrase_rules(phrases: dict[str, str]) -> list[Rule]:
    return [Rule(f"phrase-{label}", label, phrase, re.escape(phrase), NAME - 1, 0.6, True) for phrase, label in phrases.items()]


def hand_written() -> list[Rule]:
    """All rules in their order: earlier ones win among equals."""
    rules = [Rule(*s) for s in _SENTENCES]
    for label, keyword, name, tag, link in _LICENSES:
        rules += [Rule(f"{label}-tag", label, "spdx license identifier", f"spdx license identifier (?:{tag})", TAG, 1.0),
                  Rule(f"{label}-notice", label, keyword,
                       f"(?:licensed|released|distributed|available|provided|made available) under (?:the )?(?:terms of )?(?:the )?(?:{name})", NOTICE, 0.95),
                  Rule(f"{label}-name", label, keyword, name, NAME, 0.8),
                  Rule(f"{label}-link", label, link.split(" ")[0].strip("(?:"), link, LINK, 0.9)]
    return rules + phrase_rules(PHRASES)


class Scanner:
    """Compiled rules: words and kept or suppressed detections of one text."""

    # A-Z to a-z, every other ASCII byte that is no digit or letter to a blank; bytes above 0x7F are parts of words
    TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))

    def __init__(self, rules: Sequence[Rule]):
        self.rules = list(rules)
        self.compiled = [re.compile(f"(?<![^ ])(?:{r.pattern})(?![^ ])") for r in rules]
        self.keywords = ahocorasick.Automaton()
        by_keyword: dict[str, list[int]] = {}
        for i, r in enumerate(self.rules):
            by_keyword.setdefault(r.keyword, []).append(i)
        for keyword, at in by_keyword.items():
            self.keywords.add_word(keyword, at)
        self.keywords.make_automaton()

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int, int, bool]]]:
        """Number of words; (rule, first word, word after the last, kept) in the order of the text."""
        words = text.translate(self.TO_WORDS).split()
        line = b" ".join(words).decode("latin-1")
        there = {i for _, at in self.keywords.iter(line) for i in at}
        if not there:
            return len(words), []
        starts = np.concatenate(([0], np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32) + 1))
        found = [(i, m.start(), m.end()) for i in sorted(there) for m in self.compiled[i].finditer(line)]
        if not found:
            return len(words), []
        rule, start, end = np.array(found, np.int64).T
        first = np.searchsorted(starts, start, "right") - 1
        after = np.searchsorted(starts, end, "right")
        kept = self.uncontained(rule, first, after)
        order = np.lexsort((rule, after, first))
        return len(words), list(zip(*(c[order].tolist() for c in (rule, first, after, kept)), strict=True))

    def uncontained(self, rule: np.ndarray, first: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Which intervals lie in none of higher priority, and in no longer or earlier listed one of their own."""
        priority = np.array([r.priority for r in self.rules], np.int64)[rule]
        kept = np.zeros(len(rule), bool)
        taken_first = taken_last = np.zeros(0, np.int64)
        for level in np.unique(priority)[::-1]:
            at = np.flatnonzero(priority == level)
            at = at[np.lexsort((rule[at], -after[at], first[at]))]
            reach = np.maximum.accumulate(after[at])  # of this level, among those that start no later
            inside = np.concatenate(([False], reach[:-1] >= after[at][1:]))
            if len(taken_first):
                before = np.searchsorted(taken_first, first[at], "right")
                inside |= (before > 0) & (taken_last[np.maximum(before - 1, 0)] >= after[at])
            kept[at[~inside]] = True
            done = np.flatnonzero(kept)
            done = done[np.argsort(first[done], kind="stable")]
            taken_first, taken_last = first[done], np.maximum.accumulate(after[done])
        return kept


DETECTIONS = ("array<struct<rule:string,label:string,phrase:boolean,priority:int,confidence:double,"
              "first:long,after:long,kept:boolean>>")


def scan(docs: DataFrame, rules: Sequence[Rule] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_words and ``detections`` (word intervals in the order of the text) of every row.

    A null or empty text has no words and no detections; repeated rows each give a row; other columns are
    not read, so their names can't clash. A text of any length is scanned whole.
    """
    rules = hand_written() if rules is None else list(rules)
    fields = pa.schema([("rule", pa.string()), ("label", pa.string()), ("phrase", pa.bool_()), ("priority", pa.int32()),
                        ("confidence", pa.float64()), ("first", pa.int64()), ("after", pa.int64()), ("kept", pa.bool_())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = per_process(("licenses", tuple(rules)), lambda: Scanner(rules))
        for whole in batches:
            for batch in blocks(whole, 1):
                words, found = [], []
                for value in batch.column(1):
                    n, hits = scanner.scan((value.as_py() or "").encode("utf-8"))
                    words.append(n)
                    found.append([{"rule": rules[i].name, "label": rules[i].label, "phrase": rules[i].phrase, "priority": rules[i].priority,
                                   "confidence": rules[i].confidence, "first": a, "after": b, "kept": kept} for i, a, b, kept in hits])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(words, pa.int64()), pa.array(found, pa.list_(pa.struct(list(fields))))],
                    names=["key", "n_words", "detections"])

    kind = docs.schema[key].dataType.simpleString()
    return (docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
            .mapInArrow(run, f"key {kind}, n_words long, detections {DETECTIONS}").withColumnRenamed("key", key))


def digest(scanned: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document: places of the phrases, labels of phrases and kept detections, and a score.

    ``score``: 1 - product over the labels of (1 - the best confidence among the label's kept detections);
    0 without detections. A phrase counts with its own confidence even where it is suppressed.
    """
    hits = F.col("detections")
    phrases = F.filter(hits, lambda d: d["phrase"])
    valid = F.filter(hits, lambda d: d["kept"] | d["phrase"])
    names = F.array_sort(F.array_distinct(F.transform(valid, lambda d: d["label"])))

    def best(label):
        return F.array_max(F.transform(F.filter(valid, lambda d: d["label"] == label), lambda d: d["confidence"]))

    doubt = F.aggregate(names, F.lit(1.0), lambda doubt, label: doubt * (F.lit(1.0) - best(label)))
    return scanned.select(
        key, "n_words", F.size(phrases).cast("long").alias("n_base"),
        F.array_min(F.transform(phrases, lambda d: d["first"])).alias("first_word"),
        F.array_max(F.transform(phrases, lambda d: d["first"])).alias("last_word"),
        F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(phrases, lambda d: d["label"])))).alias("base_labels"),
        F.concat_ws(",", names).alias("labels"), F.round(F.lit(1.0) - doubt, 9).alias("score"),
        F.size(F.filter(hits, lambda d: ~d["kept"])).alias("n_suppressed"))
