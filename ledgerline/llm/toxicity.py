"""Toxic spans by a linear-chain conditional random field, summed up to document scores.

Labels are given per document. Words that are far more frequent in toxic documents than chance
allows label the tokens; a two-state chain learns from them which tokens are toxic, given a token's
own evidence, its neighbours' and the state before it. Forward-backward marginals of all tokens give
a document its expected number of toxic tokens, a logistic curve its score, and tokens that are
likelier toxic than not its offending offsets.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks, carried, trim, trimmed

#: The classifier is fitted on about this many labelled rows, taken by a hash of doc_id.
TRAIN_ROWS = 8000
SEGMENT = 128
#: The field is fitted on half as many of their segments with toxic words, taken by a hash, and on half to all as many others.
MAX_SEGMENTS = 4000
#: texts scored at once, and words whose buckets a task remembers
BLOCK_BYTES = 1 << 20
KEPT_WORDS = 200_000
#: training documents whose tokens are summed up at once
SUMMED = 64
STEPS = 150
BUCKETS = 6
CHANCE = 0.05
#: A-Z to a-z, ASCII punctuation to spaces; every byte keeps its place
LETTERS = bytes(ord(" ") if 33 <= b < 127 and not chr(b).isalnum() else b for b in range(256)).lower()
#: lengths in bytes of the word beginnings that can be evidence, besides whole words
BEGINNINGS = range(4, 11)
TOKEN = re.compile(rb"[^\x20\x09-\x0D]+")


@dataclass
class Model:
    evidence: dict[bytes, int]  # word, or beginning followed by a space: bucket from 1 on; other words have bucket 0
    emission: np.ndarray  # own, left and right bucket: (3, BUCKETS + 1), then a bias
    transition: np.ndarray  # 2 x 2 log potentials
    curve: np.ndarray  # score = logistic(curve . (1, log expected toxic tokens, log highest marginal, log expected share))


def tokens(text: str) -> list[bytes]:
    return text.encode().translate(LETTERS).split()


def _features(buckets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Own, left and right bucket of each token; sequences lie one after the other, from ``starts`` on."""
    left, right = np.roll(buckets, 1), np.roll(buckets, -1)
    first = starts[starts < len(buckets)]
    left[first] = 0
    right[first - 1] = 0
    return np.stack([buckets, left, right])


def _emission(model_emission: np.ndarray, features: np.ndarray) -> np.ndarray:
    rows = model_emission[:-1].reshape(3, -1)
    return rows[0][features[0]] + rows[1][features[1]] + rows[2][features[2]] + model_emission[-1]


def marginals(emission: np.ndarray, transition: np.ndarray, lengths: np.ndarray, pairs: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Probability that each token is toxic, and the expected number of each pair of states.

    Forward and backward run over all sequences at once, one step per position; each message is kept
    as the probability of the toxic state, which cannot under- or overflow.
    """
    n = len(emission)
    ratio = np.exp(np.clip(emission, -50, 50))
    t = np.exp(transition)
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    sizes = lengths[order]
    active = np.searchsorted(-sizes, -np.arange(1, (sizes[0] if len(sizes) else 0) + 1), "right")
    ahead, behind = np.zeros(n), np.full(n, 0.5)
    for step, k in enumerate(active):
        at = starts[:k] + step
        if step:
            a = ahead[at - 1]
            one = ((1 - a) * t[0, 1] + a * t[1, 1]) * ratio[at]
            zero = (1 - a) * t[0, 0] + a * t[1, 0]
        else:
            one, zero = ratio[at], np.ones(k)
        ahead[at] = one / (one + zero)
    for step in range(len(active) - 2, -1, -1):
        at = starts[:active[step + 1]] + step
        b, r = behind[at + 1], ratio[at + 1]
        one = t[1, 0] * (1 - b) + t[1, 1] * r * b
        zero = t[0, 0] * (1 - b) + t[0, 1] * r * b
        behind[at] = one / (one + zero)
    both = ahead * behind
    marginal = both / (both + (1 - ahead) * (1 - behind))
    expected = np.zeros((2, 2))
    if pairs and n:
        inner = np.ones(n, bool)
        inner[starts[sizes > 0]] = False
        i = np.flatnonzero(inner)
        a, b, r = ahead[i - 1], behind[i], ratio[i]
        p = np.stack([(1 - a) * t[0, 0] * (1 - b), (1 - a) * t[0, 1] * r * b, a * t[1, 0] * (1 - b), a * t[1, 1] * r * b])
        expected = (p / p.sum(0)).sum(1).reshape(2, 2)
    return marginal, expected


def _tail(hits: int, n: int, share: float) -> float:
    """Probability of ``hits`` or more among n by chance, bounded from above by its largest term times a geometric sum."""
    if hits <= n * share:
        return 1.0
    log = (math.lgamma(n + 1) - math.lgamma(hits + 1) - math.lgamma(n - hits + 1) + hits * math.log(share) + (n - hits) * math.log1p(-share))
    return min(1.0, math.exp(log) / (1 - (n - hits) * share / ((hits + 1) * (1 - share))))


def _once(words: list[bytes]) -> int:
    """One value for near copies: the smallest hash of five words in a row."""
    return min((zlib.crc32(b" ".join(words[i:i + 5])) for i in range(max(1, len(words) - 4))), default=0)


def _forms(word: bytes) -> list[bytes]:
    """The word and its beginnings; a space, which no word has, marks a beginning."""
    return [word, *(word[:n] + b" " for n in BEGINNINGS if n < len(word))]


def find_evidence(rows: Sequence[tuple[list[bytes], int]]) -> dict[bytes, int]:
    """Words and beginnings that chance does not explain in toxic documents, by bucket of their log odds; near copies count once."""
    documents = [0, 0]
    kept: tuple[list[list[bytes]], list[list[bytes]]] = ([], [])
    seen: set[tuple[int, int]] = set()
    for words, label in rows:
        if (key := (_once(words), label)) not in seen:
            seen.add(key)
            kept[label].append(words)
            documents[label] += 1
    if not all(documents):
        return {}
    toxic: Counter[bytes] = Counter()
    for words in kept[1]:
        toxic.update({f for w in set(words) for f in _forms(w)})
    share = documents[1] / sum(documents)
    limit = CHANCE / max(1, len(toxic))
    # other documents are counted for these forms only
    often = {f: n for f, n in toxic.items() if n > 2}
    del toxic
    others: Counter[bytes] = Counter()
    for words in kept[0]:
        others.update({f for w in set(words) for f in _forms(w) if f in often})
    odds = {f: math.log((n + 0.5) / (documents[1] + 1)) - math.log((others[f] + 0.5) / (documents[0] + 1))
            for f, n in often.items() if _tail(n, n + others[f], share) < limit}
    return {f: 1 + min(BUCKETS - 1, max(0, int(x))) for f, x in odds.items()}


class Buckets(dict):
    """The strongest bucket of a word's forms, kept for a bounded number of words."""

    def __init__(self, evidence: dict[bytes, int]) -> None:
        super().__init__()
        self.evidence = evidence

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 500_000:
            self.clear()
        self[word] = bucket = max(self.evidence.get(f, 0) for f in _forms(word))
        return bucket


def _buckets(words: list[bytes], known: Buckets) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


def _spread(items: list[int], most: int) -> list[int]:
    """At most ``most`` of the items, taken by a hash, in their order."""
    return sorted(sorted(items, key=lambda i: (zlib.crc32(b"%d" % i), i))[:most])


def train(rows: Sequence[tuple[str, int]]) -> Model:
    """Model from (text, label 0 or 1) rows. With no usable label all texts score the share of toxic rows."""
    same: dict[bytes, bytes] = {}  # one object for each word
    split = [([same.setdefault(w, w) for w in tokens(text)], label) for text, label in rows]
    evidence = find_evidence(split)
    known = Buckets(evidence)
    quiet = [b[i:i + SEGMENT] for words, _ in split for b in [_buckets(words, known).astype(np.int8)] for i in range(0, len(b), SEGMENT)]
    labels = [label for words, label in split for _ in range(0, len(words), SEGMENT)]
    hot = [i for i, (b, y) in enumerate(zip(quiet, labels, strict=True)) if y and b.any()]
    hot = _spread(hot, MAX_SEGMENTS // 2)
    cold = [i for i, (b, y) in enumerate(zip(quiet, labels, strict=True)) if not (y and b.any())]
    cold = cold[::max(1, len(cold) // (MAX_SEGMENTS // 2))]
    chosen = hot + cold
    lengths = np.array([len(quiet[i]) for i in chosen], np.int64)
    flat = np.concatenate([quiet[i] for i in chosen]).astype(np.int64) if chosen else np.zeros(0, np.int64)
    toxic = np.concatenate([(quiet[i] > 0) & bool(labels[i]) for i in chosen]) if chosen else np.zeros(0, bool)
    starts = np.cumsum(lengths) - lengths
    features = _features(flat, starts) if len(flat) else np.zeros((3, 0), np.int64)
    width = BUCKETS + 1
    weights = np.zeros(3 * width + 1 + 4)
    inner = np.ones(len(flat), bool)
    inner[starts[lengths > 0]] = False
    at = np.flatnonzero(inner)
    seen = np.bincount(2 * toxic[at - 1] + toxic[at], minlength=4)
    m, v = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, STEPS + 1 if len(flat) else 1):  # Adam on the penalised log likelihood
        marginal, expected = marginals(_emission(weights[:-4], features), weights[-4:].reshape(2, 2), lengths, pairs=True)
        miss = toxic - marginal
        gradient = np.concatenate([*(np.bincount(f, miss, width) for f in features), [miss.sum()], seen - expected.ravel()])
        gradient = gradient / math.sqrt(len(flat)) - 0.01 * weights
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        weights += 0.2 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    model = Model(evidence, weights[:-4], weights[-4:].reshape(2, 2), np.zeros(4))
    y = np.array([label for _, label in split], float)
    # a few documents at a time: the marginals of all tokens of the sample at once would be most of the driver's memory
    parts = [summaries([w for w, _ in split[i:i + SUMMED]], model, known)[0] for i in range(0, len(split), SUMMED)]
    x = np.concatenate([np.zeros((0, 4)), *parts])
    for _ in range(30):  # Newton steps of a logistic regression with a small penalty
        p = 1 / (1 + np.exp(-np.clip(x @ model.curve, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(4)
        model.curve += np.linalg.solve(hessian, x.T @ (y - p) - 1e-2 * model.curve)
    return model


def summaries(documents: list[list[bytes]], model: Model, known: Buckets) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per document the inputs of the curve; then all marginals, and the documents' numbers of tokens."""
    lengths = np.array([len(w) for w in documents], np.int64)
    starts = np.cumsum(lengths) - lengths
    full = lengths > 0
    sums, most, marginal = np.zeros(len(documents)), np.zeros(len(documents)), np.zeros(0)
    if full.any():
        flat = np.concatenate([_buckets(w, known) for w in documents])
        marginal, _ = marginals(_emission(model.emission, _features(flat, starts[full])), model.transition, lengths)
        sums[full] = np.add.reduceat(marginal, starts[full])
        most[full] = np.maximum.reduceat(marginal, starts[full])
    floor = math.exp(-6)
    # what hardly any token says is not summed up over long texts
    sums = np.maximum(floor, np.minimum(sums, most * 50))
    return np.stack([np.ones(len(documents)), np.log(sums), np.log(np.maximum(floor, most)), np.log(sums / (lengths + 20))], 1), marginal, lengths


def spans(text: str, marginal: np.ndarray) -> list[dict[str, int]]:
    """Code point offsets (start, end) of runs of tokens that are likelier toxic than not."""
    raw = text.encode()
    out: list[dict[str, int]] = []
    before = -2
    for i, m in enumerate(TOKEN.finditer(raw.translate(LETTERS))):
        if marginal[i] > 0.5:
            start, end = len(raw[:m.start()].decode()), len(raw[:m.end()].decode())
            if before == i - 1:
                out[-1]["end"] = end
            else:
                out.append({"start": start, "end": end})
            before = i
    return out


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, text, toxic of about ``rows`` labelled documents whose crc32(doc_id as text) mod 3 is not 1.

    The sample is by a hash of doc_id, so it does not depend on order or partitions; where there are
    fewer labelled rows it is all of them. Null ids, null labels and null texts are not used.
    """
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))))
    share = min(1.0, rows / max(1, known.count()))
    taken = F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(1_000_000)) < int(share * 1_000_000)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter(taken)
            .join(known.filter(taken), "doc_id").filter(F.col("text").isNotNull()))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    found = sorted((r.doc_id, r.text, r.toxic) for r in training_rows(docs, labels, rows).collect())
    model = train([(text, toxic) for _, text, toxic in found])
    del found
    trim()  # the driver lives on for later stages
    return model


def score(docs: DataFrame, model: Model, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, score, spans of every row of ``docs`` (doc_id, text), then the columns in ``carry``, named ``in_<name>``.

    Whole texts, in blocks of rows; a null text is empty and scores like one. Repeated rows get equal
    scores, an empty table none. spans: code point offsets of toxic runs.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # words of TRAIN_ROWS documents at most
    kept = "".join(f", `in_{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    more, places = carried(docs, carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        known = Buckets(model.evidence)
        for whole in batches:
            for batch in blocks(whole, 1, BLOCK_BYTES):
                if len(known) > KEPT_WORDS:
                    known = Buckets(model.evidence)
                texts = [x or "" for x in batch.column(1).to_pylist()]
                x, marginal, lengths = summaries([tokens(x) for x in texts], model, known)
                # row by row, so that a score does not depend on the texts beside it
                scores = 1 / (1 + np.exp(-np.clip((x * model.curve).sum(1), -30, 30)))
                ends = np.cumsum(lengths)
                found = [spans(t, marginal[e - n:e]) if n and marginal[e - n:e].max() > 0.5 else []
                         for t, e, n in zip(texts, ends.tolist(), lengths.tolist(), strict=True)]
                kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(scores, pa.float64()), pa.array(found, kind), *map(batch.column, places)],
                    names=["doc_id", "score", "spans", *(f"in_{c}" for c in carry)])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *[F.col(f"`{c}`").alias(f"in_{c}") for c in more])
    return rows.mapInArrow(trimmed(run), f"doc_id long, score double, spans array<struct<start:int,end:int>>{kept}")
