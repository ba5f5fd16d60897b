"""Phrase collocations: Apriori-safe candidates, counted by double-array tries.

Texts are read once, into blocks: a language's distinct words of some megabytes of text, and the text as
numbers of these words. Over the blocks:

1. words are counted;
2. pairs of frequent words are counted by 64-bit hashes;
3. windows of three words and more are, if all their pairs are frequent. "Frequent" is read off a bitmap
   of fixed size that every task gets. Collisions only let more through, so no candidate is lost;
4. windows whose hash is frequent, each spelled by one block that holds it, become candidates and go into double-array tries of about
   ``TRIE_PHRASES`` phrases, dealt out by the hash of their first two words and built in tasks. ``TRIES_AT_ONCE`` tries, laid end to
   end, are broadcast together: each text position begins in the one trie that its pair belongs to, so a read of the
   blocks serves all of them. Tasks move the states of all positions one word ahead at once, count states, and Spark
   sums the tasks' counts. These counts are exact; what has too few goes.

Cuts, scores and the removal of contained phrases are joins of candidates only.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import blocks, staged, trimmed

BITS = 27                 # the bitmap of frequent words or pairs has 2^27 bits, 16 MB
TRIE_PHRASES = 1 << 18    # phrases of one trie
TRIES_AT_ONCE = 6         # tries of one broadcast: some 110 MB a worker
COUNT_PARTS = 2048        # a task's counts leave it in so many rows at most
FULL = (1 << 31) - 1      # positions between two reports of a task's counts
BLOCK_BYTES = 4 << 20
RANK_PARTS = 32           # parts of a language that are ranked by themselves first
BREAK = 0

# A-Z to a-z, a tab to a blank, what ends a piece to a line feed
_TABLE = bytes(c + 32 if 65 <= c <= 90 else 32 if c == 9 else 10 if 10 <= c <= 13 or c in b".,;:!?" else c for c in range(256))
_TOKEN = re.compile(rb"[^ \n]+|\n")


def _numbered(texts: DataFrame) -> DataFrame:
    """block, lang, words, counts, hashes, ids: blocks of text as numbers of their words (bytes, see ``_ids``); number 0 ends a piece."""
    def number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = 0
        for whole in batches:
            for batch in blocks(whole, 1, BLOCK_BYTES):
                texts: dict[str, list[bytes]] = {}
                for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    texts.setdefault(lang, []).append(text.encode("utf-8"))
                for lang, many in texts.items():
                    numbers: dict[bytes, int] = {b"\n": BREAK}
                    ids = np.array([numbers.setdefault(t, len(numbers)) for t in _TOKEN.findall(b"\n".join(many).translate(_TABLE))], np.int32)
                    seed = xxhash.xxh32_intdigest(lang)
                    hashes = np.array([xxhash.xxh3_64_intdigest(w, seed=seed) for w in numbers], np.uint64).view(np.int64)
                    # a number of the block; two that share one only do some work twice
                    block, made = xxhash.xxh32_intdigest(f"{TaskContext.get().partitionId()} {made}") >> 5, made + 1
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block], pa.int32()), pa.array([lang], pa.string()), pa.array([[w.decode("utf-8") for w in numbers]], pa.list_(pa.string())),
                         *(pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x))
                           for x in (np.bincount(ids, minlength=len(numbers)).astype(np.int64), hashes)),
                         pa.array([ids.astype(_number(len(numbers))).tobytes()], pa.binary())],
                        names=["block", "lang", "words", "counts", "hashes", "ids"])
    return texts.mapInArrow(trimmed(number), "block int, lang string, words array<string>, counts array<long>, hashes array<long>, ids binary")


def _number(words: int) -> type:
    return np.uint16 if words <= 1 << 16 else np.uint32


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    """The numbers of a block's words, in the order of its text; two bytes each if that is enough for its words."""
    return np.frombuffer(batch.column("ids")[0].as_buffer(), _number(len(batch.column("hashes")[0])))


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    x = left * np.uint64(0x9E3779B97F4A7C15) + right
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """A set of hashes, that never denies a member: Spark unites equal bytes, the driver gets at most 2^(BITS-3)."""
    bits = np.zeros(1 << (BITS - 3), np.uint8)
    at = F.col("hash").bitwiseAND(F.lit((1 << BITS) - 1))
    one = F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (at % 8 + 1).cast("int"))
    found = hashes.select((at - at % 8).alias("place"), one.alias("bit")).groupBy("place").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits[found.column("place").to_numpy() >> 3] = found.column("bits").to_numpy().astype(np.uint8)
    return bits


def _has(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = (hashes & np.uint64(len(bits) * 8 - 1)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _windows(batch: pa.RecordBatch, known: np.ndarray, sizes: tuple[int, ...]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(words, where, hash) of a block's windows: pairs of known words, or longer ones all of whose pairs are known."""
    ids = _ids(batch)
    if not len(ids):
        return
    word = batch.column("hashes").flatten().to_numpy().view(np.uint64)
    whole = ids != BREAK
    at = word[ids]
    hashes = {1: at, 2: _mixed(at[:-1], at[1:])}
    if sizes == (2,):
        fine = _has(known, word)[ids] & whole
        safe = fine[:-1] & fine[1:]
    else:
        safe = whole[:-1] & whole[1:]
        safe[safe] = _has(known, hashes[2][safe])
    for size in range(2, max(sizes) + 1):
        if len(ids) < size:
            return
        n = len(ids) - size + 1
        if size > 2:
            hashes[size] = _mixed(hashes[size - 1][:n], at[size - 1:])
        if size in sizes:
            ok = np.logical_and.reduce([safe[j:j + n] for j in range(size - 1)])
            starts = np.flatnonzero(ok)
            yield size, starts, hashes[size][starts]


def _frequent(texts: DataFrame, known: np.ndarray, sizes: tuple[int, ...], support: int) -> DataFrame:
    """hash, block of the windows that reach ``support``: a block that holds one. Equal ones of a block are added up before the shuffle."""
    shared = texts.sparkSession.sparkContext.broadcast(known)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(whole.num_rows):
                block = whole.column("block")[i].as_py()
                for _, _, found in _windows(whole.slice(i, 1), shared.value, sizes):
                    hashes, counts = np.unique(found, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts.astype(np.int64)),
                                                      pa.array(np.full(len(hashes), block, np.int32))], names=["hash", "f", "block"])

    return (texts.select("block", "hashes", "ids").mapInArrow(trimmed(count), "hash long, f long, block int").groupBy("hash")
            .agg(F.sum("f").alias("f"), F.min("block").alias("block")).filter(F.col("f") >= support).select("hash", "block"))


def _phrases(texts: DataFrame, pairs: np.ndarray, frequent: DataFrame, longest: int) -> DataFrame:
    """lang, phrase, first of the windows whose hash is frequent, from the block named beside it; ``first``: hash of the first two words."""
    owned = frequent.select(F.col("hash").bitwiseXOR(F.col("block").cast("long")).alias("hash"))
    shared = texts.sparkSession.sparkContext.broadcast((pairs, _bitmap(owned)))

    def spell(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, owned = shared.value
        for whole in batches:
            for i in range(whole.num_rows):
                batch = whole.slice(i, 1)
                words, ids = batch.column("words").flatten(), _ids(batch)
                word = batch.column("hashes").flatten().to_numpy().view(np.uint64)
                lang, block = batch.column("lang")[0].as_py(), np.uint64(batch.column("block")[0].as_py())
                for size, starts, found in _windows(batch, pairs, tuple(range(2, max(longest, 3) + 1))):
                    if size > longest:
                        continue
                    likely = _has(owned, found ^ block)
                    hashes, first = np.unique(found[likely], return_index=True)
                    starts = starts[likely][first]
                    columns = [words.take(pa.array(ids[starts + j])).to_pylist() for j in range(size)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(hashes.view(np.int64)), pa.array([lang] * len(hashes), pa.string()),
                         pa.array([" ".join(w) for w in zip(*columns, strict=True)], pa.string()),
                         pa.array(_mixed(word[ids[starts]], word[ids[starts + 1]]).view(np.int64))], names=["hash", "lang", "phrase", "first"])

    return (texts.select("block", "lang", "words", "hashes", "ids").mapInArrow(trimmed(spell), "hash long, lang string, phrase string, first long")
            .join(frequent, "hash", "left_semi").select("lang", "phrase", "first").distinct())


class Trie:
    """A double-array trie over word numbers: the child of ``s`` by ``w`` is ``base[s] + w`` if ``check`` says so.

    ``phrases``: tuples of numbers from 1 to ``words``, or an array with a row each, filled up with zeros.
    """

    def __init__(self, phrases: list[tuple[int, ...]] | np.ndarray, words: int):
        if not isinstance(phrases, np.ndarray):
            codes = np.zeros((len(phrases), max(map(len, phrases), default=0)), np.int64)
            for row, p in zip(codes, phrases, strict=True):
                row[:len(p)] = p
        else:
            codes = phrases.astype(np.int64)
        # nodes by level, 0 is the root: parent and word of each, and the node each phrase ends in
        at, parents, by, made = np.zeros(len(codes), np.int64), [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], 1
        for column in codes.T:
            on = np.flatnonzero(column)
            edges, node = np.unique(at[on] * (words + 1) + column[on], return_inverse=True)
            at[on] = made + node
            parents.append(edges // (words + 1))
            by.append(edges % (words + 1))
            made += len(edges)
        parent, word = np.concatenate(parents), np.concatenate(by)
        free = np.ones(made + made // 2 + words + 3, bool)
        free[0] = False
        rng = np.random.default_rng(0)
        # the children of a node are a run of numbers, as the nodes of a level are in order of parent and word
        inner, begin, many = np.unique(parent[1:], return_index=True, return_counts=True)
        bases = np.zeros(made, np.int64)
        order = np.lexsort((inner, -many))
        for i in order[many[order] > 1].tolist():
            ids = word[1 + begin[i]:1 + begin[i] + many[i]]
            while True:
                tried = rng.integers(1 - ids[0], len(free) - 1 - ids[-1], 256)
                fits = np.flatnonzero(free[tried[:, None] + ids].all(1))
                if len(fits):
                    base = int(tried[fits[0]])
                    break
                free = np.concatenate([free, np.ones(words + 1, bool)])  # no room found: a little more of it
            free[base + ids] = False
            bases[inner[i]] = base
        lone = order[many[order] == 1]
        places = np.flatnonzero(free[:-1])[:len(lone)]
        if len(places) < len(lone):
            places = np.concatenate([places, len(free) - 1 + np.arange(len(lone) - len(places))])
        bases[inner[lone]] = places - word[1 + begin[lone]]
        state = np.zeros(made, np.int64)
        state[1:] = bases[parent[1:]] + word[1:]
        # what lies beyond the ends is looked up at the ends, which no node has for a child
        self.base = np.zeros(int(state.max()) + 2, np.int32)
        self.check = np.full(len(self.base), -1, np.int32)
        self.base[state] = bases
        self.check[state[1:]] = state[parent[1:]]
        # a node without children keeps base 0; no check names it, so it leads nowhere
        self.accepting = state[at]
        self.most = codes.shape[1]

    def count(self, ids: np.ndarray) -> np.ndarray:
        """How often each phrase stands in ``ids`` (0: no word of any phrase)."""
        total = np.zeros(len(self.base), np.int64)
        starts = np.flatnonzero(ids)
        _walk(self.base, self.check, self.most, ids, starts, np.zeros(len(starts), np.int64), total)
        return total[self.accepting]


def _walk(base: np.ndarray, check: np.ndarray, most: int, ids: np.ndarray, starts: np.ndarray, states: np.ndarray, total: np.ndarray) -> None:
    """Moves ``states``, those of the positions ``starts`` of ``ids``, ahead by up to ``most`` words; counts in ``total`` the states they get to."""
    for j in range(most):
        inside = starts + j < len(ids)
        starts, states = starts[inside], states[inside]
        word = ids[starts + j]
        after = base[states] + word
        lives = (word != 0) & (check.take(after, mode="clip") == states)
        starts, states = starts[lives], after[lives].astype(np.int64)
        np.add.at(total, states, 1)


def _trie_rows(candidates: DataFrame, vocabulary: dict[str, tuple[int, pa.Array]], words: int) -> DataFrame:
    """shard, lang, phrase, state of each candidate in the trie of its shard; one row of a shard has the trie's arrays."""
    shared = candidates.sparkSession.sparkContext.broadcast(vocabulary)

    def build(rows: pa.Table) -> pa.Table:
        codes = np.zeros((rows.num_rows, 0), np.int32)
        langs = rows.column("lang").combine_chunks()
        for lang, (offset, known) in shared.value.items():
            at = np.flatnonzero(pa.compute.equal(langs, lang).to_numpy(zero_copy_only=False))
            if len(at):
                split = pa.compute.split_pattern(rows.column("phrase").combine_chunks().take(pa.array(at)), " ")
                many = pa.compute.list_value_length(split).to_numpy()
                if many.max() > codes.shape[1]:
                    codes = np.pad(codes, ((0, 0), (0, int(many.max()) - codes.shape[1])))
                place = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                codes[np.repeat(at, many), place] = pa.compute.index_in(split.flatten(), value_set=known).to_numpy() + offset
        trie = Trie(codes, words)
        arrays = [[x.tobytes(), *[None] * (rows.num_rows - 1)] for x in (trie.base, trie.check)]
        return pa.table([rows.column("shard"), rows.column("lang"), rows.column("phrase"), pa.array(trie.accepting), *(pa.array(x, pa.binary()) for x in arrays)],
                        names=["shard", "lang", "phrase", "state", "base", "check"])

    return (candidates.select("shard", "lang", "phrase").groupBy("shard")
            .applyInArrow(build, "shard int, lang string, phrase string, state long, base binary, check binary"))


def _counted(texts: DataFrame, candidates: DataFrame, longest: int, trie_phrases: int) -> DataFrame:
    """lang, phrase, words, f of all candidates, a bounded number of bounded tries at a time."""
    spark = texts.sparkSession
    shards = max(1, -(-candidates.count() // trie_phrases))
    split = candidates.withColumn("shard", F.pmod("first", F.lit(shards)).cast("int"))
    done: list[DataFrame] = []
    for low in range(0, shards, TRIES_AT_ONCE):
        some = split.filter((F.col("shard") >= low) & (F.col("shard") < low + TRIES_AT_ONCE))
        listed = some.select("lang", F.explode(F.split("phrase", " ")).alias("word")).distinct().toArrow()
        vocabulary: dict[str, tuple[int, pa.Array]] = {}
        words = 0
        for lang in listed.column("lang").unique().to_pylist():
            known = listed.column("word").filter(pa.compute.equal(listed.column("lang"), lang)).combine_chunks()
            vocabulary[lang], words = (words + 1, known), words + len(known)
        rows = staged(_trie_rows(some, vocabulary, words), "tries")
        # the tries end to end: states and bases of each are moved by where it begins
        ends, begins, base, check = 0, np.zeros(min(TRIES_AT_ONCE, shards - low), np.int64), [], []
        for shard, b, c in zip(*rows.filter("base is not null").select("shard", "base", "check").toArrow().columns, strict=True):
            b, c = np.frombuffer(b.as_buffer(), np.int32), np.frombuffer(c.as_buffer(), np.int32)
            begins[shard.as_py() - low] = ends
            base.append(b + np.int32(ends))
            check.append(np.where(c < 0, c, c + np.int32(ends)))
            ends += len(b)
        if not base:
            base, check = [np.zeros(1, np.int32)], [np.full(1, -1, np.int32)]
        begin = F.element_at(F.array(*[F.lit(x) for x in begins.tolist()]), F.col("shard") - low + 1)
        states = rows.select("lang", "phrase", (F.col("state") + begin).alias("state"))
        shared = spark.sparkContext.broadcast((np.concatenate(base), np.concatenate(check), begins, low, shards, longest, vocabulary))
        del base, check
        packed = texts.select("lang", "words", "hashes", "ids").mapInArrow(trimmed(_counter(shared)), "part int, places binary, f binary")
        summed = packed.repartition("part").sortWithinPartitions("part").mapInArrow(trimmed(_sums), "state long, f long")
        done.append(staged(summed.join(states, "state").select("lang", "phrase", "f"), "counts"))
        shared.destroy()
    counts = done[0]
    for more in done[1:]:
        counts = counts.unionByName(more)
    return counts.withColumn("words", F.size(F.split("phrase", " ")))


def _counter(shared) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, check, begins, low, shards, longest, vocabulary = shared.value
        total, walked = np.zeros(len(base), np.int32), 0

        def counts() -> pa.RecordBatch:
            rows = []
            for part in range(min(COUNT_PARTS, len(total))):
                at = np.flatnonzero(mine := total[part::COUNT_PARTS])
                if len(at):
                    rows.append((part, at.astype(np.int32).tobytes(), mine[at].tobytes()))
            kinds = (pa.int32(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=["part", "places", "f"])

        for whole in batches:
            for i in range(whole.num_rows):
                batch = whole.slice(i, 1)
                lang = batch.column("lang")[0].as_py()
                if lang not in vocabulary:
                    continue
                offset, known = vocabulary[lang]
                found = pa.compute.index_in(batch.column("words").flatten(), value_set=known).fill_null(-1).to_numpy()
                ids = _ids(batch)
                code = np.where(found < 0, 0, found + offset).astype(np.int32)[ids]
                starts = np.flatnonzero((code[:-1] != 0) & (code[1:] != 0))
                word = batch.column("hashes").flatten().to_numpy().view(np.uint64)
                # the pair that a position begins with says which trie has all phrases from there
                trie = _mixed(word[ids[starts]], word[ids[starts + 1]]).view(np.int64) % shards - low
                mine = (trie >= 0) & (trie < len(begins))
                if walked + len(ids) > FULL:  # before a count could pass its 32 bits
                    yield counts()
                    total[:], walked = 0, 0
                walked += len(ids)
                _walk(base, check, longest, code, starts[mine], begins[trie[mine]], total)
        yield counts()
    return count


def _sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """state, f of counts that come in order of their part."""
    def whole() -> pa.RecordBatch:
        at = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays([pa.array(at * COUNT_PARTS + now), pa.array(total[at])], names=["state", "f"])

    now, total = -1, np.zeros(0, np.int64)
    for batch in batches:
        for part, places, f in zip(*batch.columns, strict=True):
            if part.as_py() != now:
                if len(total):
                    yield whole()
                now, total = part.as_py(), np.zeros(0, np.int64)
            at = np.frombuffer(places.as_buffer(), np.int32)
            if at[-1] >= len(total):
                total = np.pad(total, (0, int(at[-1]) + 1 - len(total)))
            total[at] += np.frombuffer(f.as_buffer(), np.int32)
    if len(total):
        yield whole()


def _ranked(scored: DataFrame, order: list[Column | str], per_lang: int) -> DataFrame:
    """``rank`` within a language, the first ``per_lang``; parts of a language are ranked first, so no task sorts all of it."""
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    first = (scored.withColumn("part", part).withColumn("place", F.row_number().over(W.partitionBy("lang", "part").orderBy(*order)))
             .filter(F.col("place") <= per_lang).drop("part", "place"))
    return first.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= per_lang)


def mine(docs: DataFrame, support: int = 30, longest: int = 4, contained_percent: int = 80, per_lang: int = 2000,
         trie_phrases: int = TRIE_PHRASES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of 2 to ``longest`` words.

    ``docs``: text and lang; other columns are not read. A null text is empty, a null lang ``und``; repeated
    rows each count; ties in score go to the more frequent, then to the smaller phrase in UTF-8 order.
    An empty table, or no phrase with ``support``: no rows. Texts of any length are read whole.
    """
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    numbered = staged(_numbered(texts), "numbered")
    word = F.explode(F.arrays_zip("words", "hashes", "counts")).alias("w")
    words = staged(numbered.select("lang", word).filter("w.words <> '\n'")
                   .groupBy("lang", F.col("w.words").alias("phrase"), F.col("w.hashes").alias("hash")).agg(F.sum("w.counts").alias("f")), "words")
    total = words.groupBy("lang").agg(F.sum("f").alias("n"))
    known = words.filter(F.col("f") >= support)
    frequent = staged(_frequent(numbered, _bitmap(known), (2,), support), "pairs")
    pairs = _bitmap(frequent)
    if longest > 2:
        frequent = frequent.unionByName(staged(_frequent(numbered, pairs, tuple(range(3, longest + 1)), support), "longer"))
    candidates = staged(_phrases(numbered, pairs, frequent, longest), "candidates")
    counted = staged(_counted(numbered, candidates, longest, trie_phrases).filter(F.col("f") >= support), "counted")

    parts = known.select("lang", "phrase", "f").unionByName(counted.select("lang", "phrase", "f"))
    split = F.split("phrase", " ")
    cuts = (counted.withColumn("w", split).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
            .select("lang", "phrase", F.col("f").alias("a"), "words", "k",
                    F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
                    F.array_join(F.slice("w", F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("right")))
    side = lambda name, f: parts.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    scored = (cuts.join(side("left", "l"), ["lang", "left"]).join(side("right", "r"), ["lang", "right"])
              .withColumn("score", F.expr("(cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + r)"))
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))

    # the greatest f of the longer candidates around each phrase
    inner = F.expr("""flatten(transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1),
                      i -> array_join(slice(w, i, m), ' '))))""")
    around = (counted.filter("words > 2").withColumn("w", split).withColumn("phrase", F.explode(inner))
              .groupBy("lang", "phrase").agg(F.max("f").alias("around")))
    alone = (scored.join(around, ["lang", "phrase"], "left")
             .filter(F.col("around").isNull() | F.expr(f"cast(around as decimal(20,0)) * 100 < cast(a as decimal(20,0)) * {int(contained_percent)}")))
    best = _ranked(alone, [F.desc("cut.score"), F.desc("a"), "phrase"], per_lang).join(total, "lang")
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n",
                       F.col("cut.score").cast("long").alias("score"))
