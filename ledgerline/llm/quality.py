"""Quality rules by distribution divergence.

References are histograms per language over all its documents: the median share of each character
class, which junk in the corpus does not shift, and the summed counts of common words. A document is judged by the Jensen-Shannon distance of its own histograms to the
nearest reference: junk such as tables, symbol noise, shouting or one word over and over lies far
from every language. Guards leave texts that are too short for a histogram to the length rule, and
documents of a language with too little text for a reference as well.

Every language with enough text has a reference, however small it is beside the others. Those of
large languages are broadcast and each document is compared with all of them; those of the others
are joined to their own documents by language.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import carried, staged, trimmed

SYMBOLS = "#*$%&|<>"
COMMON = 200
#: documents and words that a language needs for a reference
MIN_DOCUMENTS, MIN_WORDS = 10, 2000
#: the references of languages with this share of all documents, at most 1000, are compared with every document; this bounds the broadcast
MIN_SHARE = 0.001
FLUSH = 400_000
FLUSH_LANGS = 2000
STEPS = 256

# character classes by UTF-8 byte. Digits belong to no language and count for nothing, nor do bytes
# that continue a character.
KINDS = 7  # lower, upper, space, stop, mark, symbol, other


def _class_table() -> np.ndarray:
    table = np.full(256, 6, np.int64)
    table[ord("a"):ord("z") + 1] = 0
    table[ord("A"):ord("Z") + 1] = 1
    for i, members in ((2, " \t\n\v\f\r"), (3, ".,;:"), (4, "!?'\"()-@=_+/[]"), (5, SYMBOLS + "^~`\\{}")):
        table[[ord(c) for c in members]] = i
    table[ord("0"):ord("9") + 1] = KINDS
    table[0x80:0xC0] = KINDS
    table[0xC3] = 0  # most accented Latin letters, of either case
    return table


CLASS = _class_table()
#: punctuation to spaces, A-Z to a-z
LETTERS = bytes(ord(" ") if 33 <= b < 127 and not chr(b).isalnum() else b for b in range(256)).lower()


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeat_percent: int = 50
    # distances are square roots of divergences in bits, so they lie between 0 and 1
    max_class_distance: float = 0.15
    min_class_chars: int = 200
    max_word_distance: float = 0.65
    min_word_words: int = 100


def class_histogram(raw: bytes) -> np.ndarray:
    by_byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    return np.bincount(CLASS, by_byte, KINDS + 1)[:KINDS]


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    raw = text.encode()
    words = raw.split()
    spaces = sum(map(text.count, " \t\n\v\f\r"))
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    repeat = 0
    if len(set(windows)) < len(windows):
        seen = Counter(windows)
        reach = 0  # words up to here are counted
        for i, w in enumerate(windows):
            if seen[w] > 1:
                repeat += i + 3 - max(i, reach)
                reach = i + 3
    return (len(words), len(text) - spaces, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeat)


@dataclass(frozen=True)
class References:
    """Of large languages: names, index of common words, shares of classes and of common words (last: all others).

    ``others``: lang, classes, words, shares of each further language with a reference, or None if
    every document is of a large language.
    """

    langs: list[str]
    index: dict[bytes, int]
    classes: np.ndarray
    words: np.ndarray
    others: DataFrame | None


def references(docs: DataFrame, common: int = COMMON) -> References:
    """Counts are over all documents; tasks add up before they shuffle, and only the ``common`` most frequent
    words of each large language reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter[bytes]] = {}
        shares: dict[str, np.ndarray] = {}

        def rows() -> pa.RecordBatch:
            langs, kinds, words, ns = [], [], [], []
            for lang, c in counts.items():
                langs.append(lang), kinds.append(2), words.append(""), ns.append(sum(c.values()))
                for w, n in c.items():
                    langs.append(lang), kinds.append(1), words.append(w.decode("utf-8", "replace")), ns.append(n)
            for lang, h in shares.items():
                for i in np.flatnonzero(h).tolist():
                    langs.append(lang), kinds.append(0), words.append(str(i)), ns.append(int(h[i]))
            counts.clear(), shares.clear()
            return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(kinds, pa.int32()), pa.array(words, pa.string()),
                                               pa.array(ns, pa.int64())], names=["lang", "kind", "word", "n"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = (text.as_py() or "").encode()
                counts.setdefault(lang, Counter()).update(raw.translate(LETTERS).split())
                if lang not in shares:
                    shares[lang] = np.zeros(KINDS * STEPS, np.int64)
                # how many documents have each share of each class, in steps of the root of the share
                steps = (np.sqrt(_shares(class_histogram(raw))) * (STEPS - 1)).astype(int)
                shares[lang][np.arange(KINDS) * STEPS + steps] += 1
                if len(shares) > FLUSH_LANGS or sum(map(len, counts.values())) > FLUSH:
                    yield rows()
        yield rows()

    sums = (docs.select(_lang(F.col("lang")).alias("lang"), F.col("text").cast("string").alias("text"))
            .mapInArrow(trimmed(count), "lang string, kind int, word string, n long").groupBy("lang", "kind", "word").agg(F.sum("n").alias("n")))
    # filtered by place alone, so that Spark limits each language before the shuffle
    place = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "word"))
    most = sums.filter("kind = 1").withColumn("place", place).filter(F.col("place") <= common).drop("place")
    found = staged(most.unionByName(sums.filter("kind <> 1")), "references")
    # every document is in the histogram of the first class once
    sizes = found.groupBy("lang").agg(F.sum(F.expr(f"if(kind = 0 and int(word) < {STEPS}, n, 0)")).alias("documents"),
                                      F.sum(F.expr("if(kind = 2, n, 0)")).alias("words"))
    total = sizes.agg(F.coalesce(F.sum("documents"), F.lit(0))).first()[0]
    enough = sizes.filter((F.col("documents") >= MIN_DOCUMENTS) & (F.col("words") >= MIN_WORDS))
    large = {r.lang: r.documents for r in enough.filter(F.col("documents") >= MIN_SHARE * total).collect()}
    langs = sorted(large)
    rows: dict[str, list[tuple[int, str, int]]] = {x: [] for x in langs}
    for r in found.filter(F.col("lang").isin(langs)).collect():
        rows[r.lang].append((r.kind, r.word, r.n))
    parts = [_reference(rows[x]) for x in langs]
    index = {w: i for i, w in enumerate(sorted({w for _, own, _ in parts for w in own}))}
    classes = np.array([c for c, _, _ in parts]).reshape(-1, KINDS)
    words = np.zeros((len(langs), len(index) + 1))
    for i, (_, own, shares) in enumerate(parts):
        words[i, [index[w] for w in own] + [-1]] = shares
    others = None
    if sum(large.values()) < total:
        small = found.join(enough.filter(~F.col("lang").isin(langs)).select("lang"), "lang", "left_semi")
        others = staged(small.groupBy("lang").applyInPandas(_one_reference, "lang string, classes array<double>, words array<string>,"
                                                                            "shares array<double>"), "small-references")
    return References(langs, index, classes, words, others)


def _lang(lang: Column) -> Column:
    return F.coalesce(lang.cast("string"), F.lit(""))


def _reference(rows: list[tuple[int, str, int]]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Shares of classes, common words, and their shares (last: all other words) from the rows (kind, word, n) of a language."""
    steps = np.zeros((KINDS, STEPS))
    common: dict[bytes, int] = {}
    every = 0
    for kind, word, n in rows:
        if kind == 0:
            steps.flat[int(word)] = n
        elif kind == 1:
            common[word.encode()] = common.get(word.encode(), 0) + n
        else:
            every = n
    # medians, then made to sum to 1
    classes = (((steps.cumsum(1) * 2 >= steps[0].sum()).argmax(1) + 0.5) / STEPS) ** 2
    counts = np.array([*common.values(), every - sum(common.values())], float)
    return classes / classes.sum(), list(common), _shares(counts)


def _one_reference(rows: pd.DataFrame) -> pd.DataFrame:
    classes, words, shares = _reference(list(zip(rows["kind"], rows["word"], rows["n"], strict=True)))
    return pd.DataFrame({"lang": rows["lang"].iloc[:1], "classes": [classes], "words": [[w.decode() for w in words]], "shares": [shares]})


def _shares(counts: np.ndarray) -> np.ndarray:
    return counts / np.maximum(1, counts.sum(-1, keepdims=True))


def distance(counts: np.ndarray, bins: np.ndarray, reference: np.ndarray) -> float:
    """Jensen-Shannon distance of the histogram ``counts`` over ``bins`` (others: 0) to the nearest row of ``reference``."""
    p = counts / counts.sum()
    q = reference[:, bins]
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = np.where(p > 0, p * np.log2(p / m), 0) + np.where(q > 0, q * np.log2(q / m), 0)
    bits = (parts.sum(1) + 1 - q.sum(1)) / 2  # a bin without counts adds its reference share
    return float(np.sqrt(np.clip(bits, 0, 1)).min())


def judge(docs: DataFrame, rules: Rules = Rules(), common: int = COMMON, carry: tuple[str, ...] = ()) -> DataFrame:
    """Counts, distances and verdict of every row of ``docs`` (doc_id, text, lang).

    doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    class_distance, word_distance, then the columns in ``carry``, named ``in_<name>``. A null text is empty: it has no
    words and fails the length rule. A null lang is a language of its own. A distance is null where
    the text is below its guard, or its language has no reference. Repeated rows each count and are all
    returned; an empty table gives no rows.
    """
    known = references(docs, common)
    # <= 1000 languages x common words
    shared = docs.sparkSession.sparkContext.broadcast((known.index, known.classes, known.words))
    fixed = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean,"
             "kept boolean, class_distance double, word_distance double")
    kinds = [*[pa.int64()] * 6, pa.bool_(), pa.bool_(), pa.float64(), pa.float64()]
    names = [x.split()[0] for x in fixed.split(",")]
    more, places = carried(docs, carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, classes, words = shared.value
        every = np.arange(KINDS)
        owns: dict[str, tuple[np.ndarray, dict[bytes, int], np.ndarray]] = {}

        def own(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, dict[bytes, int], np.ndarray] | None:
            """The joined reference of a small language, if it has one."""
            if not batch.column("classes")[i].is_valid:
                return None
            lang = batch.column("lang")[i].as_py()
            if lang not in owns:
                if len(owns) >= FLUSH_LANGS:
                    owns.clear()
                one, common, shares = (batch.column(c)[i].as_py() for c in ("classes", "words", "shares"))
                owns[lang] = np.array([one]), {w.encode(): k for k, w in enumerate(common)}, np.array([shares])
            return owns[lang]

        def word_distance(tokens: list[bytes], index: dict[bytes, int], words: np.ndarray) -> float:
            other = len(index)
            bins, counts = np.unique(np.fromiter((index.get(w, other) for w in tokens), np.int64, len(tokens)), return_counts=True)
            return distance(counts, bins, words)

        for batch in batches:
            out = []
            joined = "classes" in batch.schema.names
            for i, (doc, cell) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1), strict=True)):
                text = cell.as_py() or ""
                n, chars, symbols, lines, repeat = base_counts(text)
                failed = n < rules.min_words or 100 * repeat > rules.max_repeat_percent * n
                by_class = by_word = None
                raw = text.encode()
                mine = own(batch, i) if joined else None
                refs = [(classes, index, words)] * (len(classes) > 0) + [mine] * joined if mine or not joined else []
                if refs and chars >= rules.min_class_chars:
                    by_class = min(distance(class_histogram(raw), every, c) for c, _, _ in refs)
                tokens = raw.translate(LETTERS).split()
                if refs and len(tokens) >= rules.min_word_words:
                    by_word = min(word_distance(tokens, x, w) for _, x, w in refs)
                far = (by_class or 0) > rules.max_class_distance or (by_word or 0) > rules.max_word_distance
                out.append((doc, n, chars, symbols, lines, repeat, failed, not failed and not far, by_class, by_word))
            columns = list(zip(*out, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)),
                                              *map(batch.column, places)], names=[*names, *(f"in_{c}" for c in carry)])

    def rows(part: DataFrame) -> DataFrame:
        return part.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                           *[F.col(f"`{c}`").alias(f"in_{c}") for c in more], _lang(F.col("lang")).alias("lang"))

    kept = "".join(f", `in_{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    if known.others is None:
        return rows(docs).drop("lang").mapInArrow(trimmed(run), fixed + kept)
    is_large = _lang(F.col("lang")).isin(known.langs)
    # no small language has MIN_SHARE of the documents, or it has too few for the join to notice
    return (rows(docs.filter(is_large)).drop("lang").mapInArrow(trimmed(run), fixed + kept)
            .unionByName(rows(docs.filter(~is_large)).join(known.others, "lang", "left")
                         .select("doc_id", "text", *[f"`in_{c}`" for c in more], "lang", "classes", "words", "shares")
                         .mapInArrow(trimmed(run), fixed + kept)))
