"""Language-model scores from a log-frequency Bloom filter.

Counts of the training texts' n-grams are quantised to levels of a geometric scale, and a filter
holds each n-gram once for every level up to its own. A count is read back by probing level after
level until one is missing: an n-gram is never placed too low, and rarely one level too high.
Probabilities are smoothed towards the next shorter n-gram. Filters are built in segments by n-gram
hash, broadcast to the workers, in rounds of a fixed size if they are larger than that.

The exact add-one unigram score is computed beside it: counts of the most frequent words travel as
a dictionary of bounded size, all others are joined.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks, staged, trim, trimmed

END = b""  # no word is empty
FLUSH = 400_000
BLOCK_BYTES = 1 << 20
DICTIONARY = 200_000
SEGMENT_TOKENS = 1 << 20  # a worker sorts one segment at a time
ROUND_BYTES = 128 << 20
# odd multipliers and shifts of the splitmix64 finaliser (fixed values)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


@dataclass(frozen=True)
class Settings:
    order: int = 2
    #: counts of one level lie within a factor of this
    scale: float = 2.0
    #: bits of the filter for each n-gram and level, and bits set for each
    bits: int = 10
    probes: int = 5
    #: weight of the shorter n-gram, as a number of tokens
    prior: float = 1000.0


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX[0]
    x = (x ^ (x >> np.uint64(27))) * MIX[1]
    return x ^ (x >> np.uint64(31))


def words(text: str) -> list[bytes]:
    """Runs of what is no ASCII white space, A-Z lowered."""
    return text.encode().lower().split()


@dataclass
class Block:
    """Texts of one block: distinct words, and each text's tokens after ``order - 1`` ends that begin it."""

    known: list[bytes]
    ids: np.ndarray
    lengths: np.ndarray
    order: int

    @classmethod
    def of(cls, texts: list[str | None], order: int) -> Block:
        index: dict[bytes, int] = {END: 0}
        flat: list[int] = []
        lengths = []
        for text in texts:
            found = words(text or "")
            lengths.append(len(found) + 1)
            flat += [0] * (order - 1)
            flat += [index.setdefault(w, len(index)) for w in found]
            flat.append(0)
        return cls(list(index), np.array(flat, np.int64), np.array(lengths, np.int64), order)

    def tokens(self) -> np.ndarray:
        """Places of real tokens in ``ids``."""
        starts = np.cumsum(self.lengths + self.order - 1) - self.lengths
        return np.arange(self.lengths.sum()) + np.repeat(starts - (np.cumsum(self.lengths) - self.lengths), self.lengths)

    def grams(self) -> list[np.ndarray]:
        """Hashes of the 1-, 2-, ... ``order``-grams that end at each place; places before the first real token count too."""
        import xxhash

        single = np.array([xxhash.xxh64_intdigest(w) for w in self.known], np.uint64)[self.ids]
        out = [mixed(single + GOLDEN)]
        for n in range(1, self.order):
            before = np.concatenate([np.zeros(1, np.uint64), out[-1][:-1]])
            out.append(mixed(before * GOLDEN + single + np.uint64(n)))
        return out


def word_counts(texts: DataFrame) -> DataFrame:
    """word, c over all texts; the empty word is a text's end. Tasks add up before they shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def rows() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([w.decode() for w in counts], pa.string()), pa.array(counts.values(), pa.int64())],
                                             names=["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for text in batch.column(0):
                counts.update(words(text.as_py() or ""))
                counts[END] += 1
                if len(counts) > FLUSH:
                    yield rows()
        yield rows()

    return texts.select("text").mapInArrow(trimmed(count), "word string, n long").groupBy("word").agg(F.sum("n").alias("c"))


def _segment(keys: np.ndarray, segments: int) -> np.ndarray:
    return (mixed(keys ^ GOLDEN) % np.uint64(segments)).astype(np.int64)


def filter_segments(texts: DataFrame, segments: int, settings: Settings) -> DataFrame:
    """segment, bits: the filter's parts. Each has the n-grams of one hash class, about a million tokens' worth.

    Tasks count their own n-grams first and send sorted hashes and counts by segment; equal n-grams
    of a task are one entry, so the most frequent are no larger than the rarest.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def rows() -> pa.RecordBatch:
            keys, counts = _summed(held)
            held.clear()
            segment = _segment(keys, segments)
            order = np.argsort(segment, kind="stable")
            cuts = np.searchsorted(segment[order], np.arange(segments + 1))
            full = [s for s in range(segments) if cuts[s + 1] > cuts[s]]
            return pa.RecordBatch.from_arrays(
                [pa.array(full, pa.int64()), *(pa.array([x[order[cuts[s]:cuts[s + 1]]].tobytes() for s in full], pa.binary())
                                               for x in (keys, counts.astype("<u4")))], names=["segment", "keys", "counts"])

        for batch in batches:
            for part in blocks(batch, 0, BLOCK_BYTES):
                block = Block.of(part.column(0).to_pylist(), settings.order)
                at = block.tokens()
                keys, counts = np.unique(np.concatenate([g[at] for g in block.grams()]), return_counts=True)
                held.append((keys, counts))
                size += len(keys)
                if size > 4 * FLUSH:
                    held[:] = [_summed(held)]
                    size = len(held[0][0])
                    if size > 3 * FLUSH:
                        yield rows()
                        size = 0
        if held:
            yield rows()

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        keys, counts = _summed([(np.frombuffer(k, np.uint64), np.frombuffer(c, "<u4")) for k, c in zip(rows["keys"], rows["counts"], strict=True)])
        levels = 1 + np.floor(np.log(counts) / math.log(settings.scale) + 1e-9).astype(np.int64)
        size = max(64, -(-int(levels.sum()) * settings.bits // 8) * 8)
        bits = np.zeros(size, bool)
        for level in range(1, int(levels.max(initial=0)) + 1):
            for at in _places(keys[levels >= level], level, settings.probes, np.uint64(size)):
                bits[at] = True
        del keys, counts, levels
        out = pd.DataFrame({"segment": [rows["segment"].iloc[0]], "bits": [np.packbits(bits).tobytes()]})
        del bits
        trim()
        return out

    return (texts.select("text").mapInArrow(trimmed(count), "segment long, keys binary, counts binary")
            .groupBy("segment").applyInPandas(build, "segment long, bits binary"))


def _summed(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([k for k, _ in held])
    counts = np.concatenate([c for _, c in held])
    out, at = np.unique(keys, return_inverse=True)
    return out, np.bincount(at, counts, len(out)).astype(np.int64)


def _places(keys: np.ndarray, level: int, probes: int, size: np.ndarray | np.uint64) -> Iterator[np.ndarray]:
    x = mixed(keys + np.uint64(level * int(GOLDEN) & 0xFFFFFFFFFFFFFFFF))
    first, step = x & np.uint64(0xFFFFFFFF), (x >> np.uint64(32)) | np.uint64(1)
    for i in range(probes):
        yield (first + np.uint64(i) * step) % size


@dataclass
class Filter:
    """Some segments of the filter; those of other rounds answer 0."""

    segments: int
    probes: int
    bits: np.ndarray
    start: np.ndarray  # first byte of each segment, -1 if it is not here
    size: np.ndarray  # bits of each segment

    @classmethod
    def of(cls, rows: list[tuple[int, bytes]], segments: int, probes: int) -> Filter:
        start, size = np.full(segments, -1, np.int64), np.ones(segments, np.uint64)
        at = 0
        for segment, bits in rows:
            start[segment], size[segment] = at, 8 * len(bits)
            at += len(bits)
        return cls(segments, probes, np.frombuffer(b"".join(b for _, b in rows), np.uint8), start, size)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Highest level that holds each n-gram, 0 for one that no training text has."""
        segment = _segment(keys, self.segments)
        out = np.zeros(len(keys), np.uint8)
        active = np.flatnonzero(self.start[segment] >= 0)
        for level in range(1, 100):
            start, size = self.start[segment[active]], self.size[segment[active]]
            found = np.ones(len(active), bool)
            for at in _places(keys[active], level, self.probes, size):
                at = at.astype(np.int64)
                found &= (self.bits[start + (at >> 3)] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
            active = active[found]
            if not len(active):
                break
            out[active] = level
        return out


def expected_counts(scale: float) -> np.ndarray:
    """Middle of the counts of each level."""
    level = np.arange(1, 256, dtype=float)
    return np.concatenate([[0.0], (scale ** np.minimum(level - 1, 300) + np.maximum(scale ** np.minimum(level, 300) - 1, 1)) / 2])


def log_probabilities(levels: list[np.ndarray], counts: np.ndarray, total: int, distinct: int, prior: float) -> np.ndarray:
    """log10 p of each place's token after those before it; ``levels``: of 1-, 2-, ... grams at each place."""
    p = (counts[levels[0]] + 1) / (total + distinct + 1)
    for shorter, longer in zip(levels, levels[1:], strict=False):
        both = counts[longer]
        history = np.maximum(np.concatenate([[0.0], counts[shorter[:-1]]]), both)
        p = (both + prior * p) / (history + prior)
    return np.log10(p)


def score(docs: DataFrame, held_out: Column, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs`` (doc_id, text).

    Learns from the rows that are not ``held_out`` (a column of doc_id; null counts as false). A null
    text is empty: one token, its end. Repeated rows are counted and returned like any other, an empty
    table gives no rows, other columns are not read. base_score is the exact add-one unigram score,
    score the log10 probability that the filter gives the whole text.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       F.coalesce(held_out, F.lit(False)).alias("held_out"))
    training = rows.filter("not held_out")
    counts = staged(word_counts(training), "words")
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    segments = max(1, -(-total // SEGMENT_TOKENS))
    parts = staged(filter_segments(training, segments, settings), "filter")
    sizes = {r.segment: r.n for r in parts.select("segment", F.octet_length("bits").alias("n")).collect()}
    rounds: list[list[int]] = [[]]
    room = ROUND_BYTES
    for segment, n in sorted(sizes.items()):
        if n > room and rounds[-1]:
            rounds.append([])
            room = ROUND_BYTES
        rounds[-1].append(segment)
        room -= n

    # the counts from which on at most DICTIONARY words are left
    by_size = sorted(((r.size, r.n) for r in counts.groupBy(F.floor(F.log2("c") * 4).alias("size")).agg(F.count(F.lit(1)).alias("n")).collect()),
                     reverse=True)
    least, left = math.inf, DICTIONARY
    for size, n in by_size:
        if n > left:
            break
        least, left = size, left - n
    frequent = F.floor(F.log2("c") * 4) >= (least if least < math.inf else 1 << 30)
    table = counts.filter(frequent).toArrow()
    dictionary = spark.sparkContext.broadcast(dict(zip((w.encode() for w in table.column("word").to_pylist()),
                                                       np.log10(table.column("c").to_numpy() + 1.0).tolist(), strict=True)))
    order = settings.order
    state = rows.withColumn("levels", F.lit(None).cast("array<binary>"))
    for k, chosen in enumerate(rounds):
        found = [(r.segment, bytes(r.bits)) for r in parts.filter(F.col("segment").isin(chosen)).collect()] if chosen else []
        state = _probe(state, spark.sparkContext.broadcast(Filter.of(found, segments, settings.probes)), dictionary, total, distinct,
                       settings, last=k == len(rounds) - 1)
        if k < len(rounds) - 1:  # so that one round's filter is enough to go on
            state = staged(state, "levels")
    done = staged(state, "scores")
    rare = (done.select("row", F.explode("rare").alias("word")).join(counts.filter(~frequent), "word")
            .groupBy("row").agg(F.sum(F.log10(F.col("c") + 1)).alias("rare_logs"), F.count(F.lit(1)).alias("rare_known")))
    unit = math.log10(total + distinct + 1)
    return (done.drop("rare").join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("rare_logs", F.lit(0.0)) - F.col("n_tokens") * F.lit(unit)).alias("base_score"), "score",
        F.lit(order).alias("order")))


def _probe(state: DataFrame, shared: object, dictionary: object, total: int, distinct: int, settings: Settings, last: bool) -> DataFrame:
    """One round: levels of the n-grams in the filter's segments; the last one makes them scores."""
    counts = expected_counts(settings.scale)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, frequent = shared.value, dictionary.value
        row = TaskContext.get().partitionId() << 40
        for whole in batches:
            for batch in blocks(whole, 1):
                block = Block.of(batch.column(1).to_pylist(), settings.order)
                levels = []
                for grams in block.grams():
                    keys, at = np.unique(grams, return_inverse=True)
                    levels.append(held.levels(keys)[at])
                ends = np.cumsum(block.lengths + settings.order - 1)
                starts = ends - block.lengths - settings.order + 1
                earlier = batch.column(3)
                if earlier.null_count < len(earlier):
                    levels = [np.maximum(x, np.frombuffer(b"".join(y[n] for y in earlier.to_pylist()), np.uint8))
                              for n, x in enumerate(levels)]
                if not last:
                    cells = [[x[a:b].tobytes() for x in levels] for a, b in zip(starts, ends, strict=True)]
                    yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(cells, pa.list_(pa.binary()))],
                                                     names=["doc_id", "text", "held_out", "levels"])
                    continue
                at = block.tokens()
                first = np.cumsum(block.lengths) - block.lengths
                logs = log_probabilities(levels, counts, total, distinct, settings.prior)[at]
                own = np.array([frequent.get(w, math.nan) for w in block.known])[block.ids[at]]
                known = ~np.isnan(own)
                # a word that the filter does not hold is in no training text
                other = ~known & (levels[0][at] > 0)
                doc = np.repeat(np.arange(len(block.lengths)), block.lengths)
                listed = np.flatnonzero(other)
                offsets = np.searchsorted(doc[listed], np.arange(len(block.lengths) + 1))
                rare = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()),
                                                pa.array([block.known[i].decode() for i in block.ids[at][listed]], pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row + np.arange(len(block.lengths)), pa.int64()), batch.column(0), batch.column(2), pa.array(block.lengths),
                     pa.array(np.add.reduceat(known, first), pa.int64()),
                     pa.array(np.add.reduceat(np.where(known, own, 0.0), first)), pa.array(np.add.reduceat(logs, first)), rare],
                    names=["row", "doc_id", "held_out", "n_tokens", "known", "logs", "score", "rare"])
                row += len(block.lengths)

    schema = ("row long, doc_id long, held_out boolean, n_tokens long, known long, logs double, score double, rare array<string>" if last
              else "doc_id long, text string, held_out boolean, levels array<binary>")
    return state.select("doc_id", "text", "held_out", "levels").mapInArrow(trimmed(run), schema)
