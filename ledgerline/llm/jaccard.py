"""Grouped prefix join: documents whose sets of word shingles are similar, as classes and their links.

Equal sets are one class. A class is known by its size, its prefix - the shingles that come first in
an order that all documents share, enough that similar sets must meet in one - and a parity bitmap.
Classes with equal prefixes and sizes form a group; groups that meet in a shingle of their prefixes
are filtered by size and by the places of that shingle, and only then expanded to their members,
whose bitmaps bound the difference of the sets. Of what is left, pairs that would connect anything
new are verified on the sets themselves, in rounds, until no such pair is left: dense neighbourhoods
cost a few pairs per member instead of all pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import blocks, staged, trimmed
from .lm import GOLDEN, mixed, words

BUCKETS = 1 << 19
BLOCK = 512
LEADERS = 8
#: a pair whose bitmaps differ by this share of the limit is near beyond doubt; of others a member names so many a round
SURE = 0.7
NAMED = 8
#: tables of this many narrow rows at most are broadcast, larger ones are shuffled
SMALL_ROWS = 2_000_000


@dataclass(frozen=True)
class Rule:
    """Sets link if 100 * intersection >= percent * union."""

    width: int = 4
    percent: int = 85

    def prefix(self, n: int) -> int:
        return n - -(-self.percent * n // 100) + 1

    def overlap(self, both: np.ndarray) -> np.ndarray:
        """Smallest intersection of two linked sets of ``both`` members together."""
        return -(-self.percent * both // (100 + self.percent))


def shingle_hashes(texts: list[str | None], width: int) -> list[np.ndarray]:
    """Per text the hashes of its shingles, in order and with repeats; a shorter text is one shingle, an empty one none."""
    import xxhash

    index: dict[bytes, int] = {}
    ids, lengths = [], []
    for text in texts:
        found = words(text or "")
        lengths.append(len(found))
        ids += [index.setdefault(w, len(index)) for w in found]
    single = np.array([xxhash.xxh64_intdigest(w) for w in index], np.uint64)[np.array(ids, np.int64)] if ids else np.zeros(0, np.uint64)
    whole = mixed(single + GOLDEN)
    for k in range(1, width):
        whole = mixed(whole[:max(0, len(single) - k)] * GOLDEN + single[k:])
    out, at = [], 0
    for n in lengths:
        if 0 < n < width:
            short = mixed(single[at:at + 1] + GOLDEN)
            for k in range(1, n):
                short = mixed(short * GOLDEN + single[at + k:at + k + 1])
            out.append(mixed(short + np.uint64(n)))  # unlike any full shingle
        else:
            out.append(whole[at:at + max(0, n - width + 1)])
        at += n
    return out


def frequency_levels(docs: DataFrame, width: int) -> np.ndarray:
    """Level of each hash bucket: 0 up to the mean count, then one per factor 1.2. The table's size is fixed.

    Prefixes prefer low levels, so that very frequent shingles hardly ever bring documents together;
    any table gives the same links.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part in blocks(batch, 0):
                found = np.concatenate(shingle_hashes(part.column(0).to_pylist(), width))
                sums += np.bincount((found % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(sums[at])], names=["bucket", "n"])

    found = docs.select("text").mapInArrow(trimmed(count), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    sums = np.zeros(BUCKETS, np.int64)
    sums[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    mean = max(1.0, sums.mean())
    return np.maximum(0, np.floor(np.log2(np.maximum(sums, 1) / mean) * 4)).astype(np.int8)


def parity_bitmap(members: np.ndarray) -> bytes:
    """Bits that an odd number of members hash to; a power of two of them, one for each member or more."""
    size = max(64, 1 << int(len(members) - 1).bit_length())
    at = (mixed(members) & np.uint64(size - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=size) & 1, bitorder="little").tobytes()


def folded(bitmap: np.ndarray, words: int) -> np.ndarray:
    """A parity bitmap as one of ``words`` 64-bit words: halves are added up."""
    while len(bitmap) > words:
        half = len(bitmap) // 2
        bitmap = bitmap[:half] ^ bitmap[half:]
    return bitmap


def sketches(docs: DataFrame, levels: np.ndarray, rule: Rule) -> DataFrame:
    """doc_id, n, digest, prefix, bitmap of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)  # BUCKETS bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = shared.value
        for batch in batches:
            for part in blocks(batch, 1):
                sizes, digests, prefixes, bitmaps = [], [], [], []
                for h in shingle_hashes(part.column(1).to_pylist(), rule.width):
                    members = np.unique(h)
                    order = np.lexsort((members, levels[(members % np.uint64(BUCKETS)).astype(np.int64)]))
                    n = len(members)
                    sizes.append(n)
                    digests.append(hashlib.blake2b(members.tobytes(), digest_size=16).digest())
                    prefixes.append(members[order[:rule.prefix(n) if n else 0]].view(np.int64))
                    bitmaps.append(parity_bitmap(members) if n else b"")
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(prefixes, pa.list_(pa.int64())),
                     pa.array(bitmaps, pa.binary())], names=["doc_id", "n", "digest", "prefix", "bitmap"])

    return docs.select("doc_id", "text").mapInArrow(trimmed(run), "doc_id long, n long, digest binary, prefix array<bigint>, bitmap binary")


def _small(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if it has few rows; it is a stored table, so counting is cheap."""
    return F.broadcast(df) if df.count() <= SMALL_ROWS else df


def shared_postings(classes: DataFrame) -> DataFrame:
    """shingle, place, cls of prefix shingles that more than one class has, and the list's size.

    Shingles whose lists have the same classes bring the same pairs together: one of them stays.
    """
    postings = classes.select("cls", F.posexplode("prefix").alias("place", "shingle"))
    often = staged(postings.groupBy("shingle").count().filter("count > 1").select("shingle"), "shingles")
    found = staged(postings.join(_small(often), "shingle"), "postings")
    lists = staged(found.groupBy("shingle").agg(F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("cls")).alias("one"),
                                                F.bit_xor(F.xxhash64("cls", F.lit(1))).alias("two"))
                   .groupBy("size", "one", "two").agg(F.min("shingle").alias("shingle")).select("shingle", "size"), "lists")
    return staged(found.join(_small(lists), "shingle"), "lists-kept")


def _pairs_of(rows: list[tuple], rule: Rule) -> list[tuple[int, int]]:
    """Pairs of one block that may link and would connect components; each row: (place, cls, n, grp, bitmap, comp, failed, side).

    Member by member: those it may still be connected with, by their groups' sizes and places, then by
    bitmaps. Pairs that are near beyond doubt come first and join two components for the rest of the
    block, so dense blocks are one component after a few members. Of pairs close to the limit, which
    may fail, each member names a few at a time and joins nothing; the block is looked at again.
    """
    comp = np.unique(np.array([r[5] for r in rows], np.int64), return_inverse=True)[1]
    if comp.max() == 0:
        return []
    place, n = (np.array([r[k] for r in rows], np.int64) for k in (0, 2))
    # groups: sizes, and the most that sets can share if they meet at these places of their orders
    first, group = np.unique(np.array([(r[3], r[0]) for r in rows], np.int64), axis=0, return_index=True, return_inverse=True)[1:]
    group = group.ravel()
    gp, gn = place[first], n[first]
    small, large = np.minimum.outer(gn, gn), np.maximum.outer(gn, gn)
    most = np.minimum.outer(gp, gp) + 1 + np.minimum.outer(gn - gp - 1, gn - gp - 1)
    need = rule.overlap(np.add.outer(gn, gn))
    near = (100 * small >= rule.percent * large) & (most >= need)
    side = np.array([r[7] for r in rows])
    index = {r[1]: k for k, r in enumerate(rows)}
    bitmaps = [np.frombuffer(r[4], np.uint64) for r in rows]
    words = np.array([len(b) for b in bitmaps])
    stacked: dict[int, np.ndarray] = {}
    out: list[tuple[int, int]] = []
    for sure in (True, False):
        for i, row in enumerate(rows[:-1]):
            open_ = near[group[i]][group] & (comp != comp[i]) & ((side != side[i]) | (side[i] < 0))
            open_[:i + 1] = False
            for missed in row[6]:
                if missed in index:
                    open_[index[missed]] = False
            js = np.flatnonzero(open_)
            named = 0
            for size in np.unique(np.minimum(words[js], words[i])).tolist() if len(js) else []:
                if size not in stacked:
                    stacked[size] = np.stack([folded(b, size) if len(b) >= size else np.zeros(size, np.uint64) for b in bitmaps])
                these = js[np.minimum(words[js], words[i]) == size]
                apart = np.bitwise_count(stacked[size][these] ^ stacked[size][i]).sum(1, dtype=np.int64)
                # linked sets differ in no more members
                limit = n[these] + n[i] - 2 * need[group[i]][group[these]]
                for j in these[apart <= limit * SURE if sure else apart <= limit].tolist():
                    if comp[j] != comp[i] and row[1] not in rows[j][6] and named < NAMED:
                        out.append((min(row[1], rows[j][1]), max(row[1], rows[j][1])))
                        if sure:
                            comp[comp == comp[j]] = comp[i]
                        else:
                            named += 1
    return out


def candidate_pairs(postings: DataFrame, classes: DataFrame, labels: DataFrame, failed: DataFrame, rule: Rule, full: bool) -> DataFrame:
    """shingle, a, b: pairs that may link, not yet verified, that would connect components; a forest within each block.

    Lists longer than BLOCK are dealt into blocks. Not ``full``: each block by itself, with a few
    leaders of its list, which costs no more than the list is long. ``full``: each pair of blocks,
    but for lists, and pairs of blocks, that are one component already.
    """
    known = postings.join(labels, "cls")
    spread = known.groupBy("shingle").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low <> high").select("shingle")
    spread = staged(spread, "spread")
    known = known.join(_small(spread), "shingle", "left_semi")
    many = F.ceil(F.col("size") / BLOCK).cast("int")
    if full:
        # members of one component stand together, so most blocks of a large list are of one component
        order = W.partitionBy("shingle").orderBy("comp", "cls")
        long = known.filter(F.col("size") > BLOCK).withColumn("block", F.floor((F.row_number().over(order) - 1) / BLOCK).cast("int"))
        pure = staged(long.groupBy("shingle", "block").agg(F.min("comp").alias("low"), F.max("comp").alias("high")), "blocks")
        other = pure.select("shingle", F.col("block").alias("block_b"), F.col("low").alias("low_b"), F.col("high").alias("high_b"))
        # pairs of blocks, each of hundreds of rows, of one list
        todo = staged(pure.join(other, "shingle").filter("block <= block_b and not (low = high and low_b = high_b and low = low_b)")
                      .select("shingle", "block", "block_b"), "block-pairs")
        ends = todo.select("shingle", "block", "block_b", F.explode(F.array_distinct(F.array("block", "block_b"))).alias("own"))
        long = (long.withColumnRenamed("block", "own").join(ends, ["shingle", "own"])
                .withColumn("side", F.when(F.col("block") == F.col("block_b"), -1).otherwise(F.col("own"))).drop("own"))
    else:
        leaders = F.row_number().over(W.partitionBy("shingle").orderBy(F.xxhash64("cls"), "cls")) <= LEADERS
        long = known.filter(F.col("size") > BLOCK).withColumn("leads", leaders)
        own = F.pmod(F.xxhash64("cls"), many).cast("int")
        long = (long.withColumn("block", F.explode(F.when(F.col("leads"), F.sequence(F.lit(0), many - 1)).otherwise(F.array(own))))
                .withColumn("block_b", F.col("block")).withColumn("side", F.lit(-1)).drop("leads"))
    short = known.filter(F.col("size") <= BLOCK).withColumns({"block": F.lit(0), "block_b": F.lit(0), "side": F.lit(-1)})
    columns = ["shingle", "block", "block_b", "side", "place", "cls", "comp"]
    missed = failed.groupBy("a").agg(F.collect_set("b").alias("failed"))  # false hits of the bitmaps, a few each
    rows = (short.select(*columns).unionByName(long.select(*columns))
            .join(classes.select("cls", "n", "grp", "bitmap"), "cls").join(missed, F.col("cls") == F.col("a"), "left").drop("a"))
    dealt = rows.repartition("shingle", "block", "block_b").sortWithinPartitions("shingle", "block", "block_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        key: tuple | None = None

        def done() -> pa.RecordBatch:
            pairs = _pairs_of(held, rule)
            columns = [[key[0]] * len(pairs), [p[0] for p in pairs], [p[1] for p in pairs]]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["shingle", "a", "b"])

        for batch in batches:
            listed = [batch.column(c).to_pylist() for c in ("shingle", "block", "block_b", "place", "cls", "n", "grp", "bitmap", "comp",
                                                            "failed", "side")]
            for s, b, c, place, cls, n, grp, bitmap, comp, missed, side in zip(*listed, strict=True):
                if (s, b, c) != key:
                    if held:
                        yield done()
                    key, held = (s, b, c), []
                held.append((place, cls, n, grp, bitmap, comp, missed or (), side))
        if held:
            yield done()

    return dealt.mapInArrow(trimmed(run), "shingle long, a long, b long")


def verify(pairs: DataFrame, classes: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """``pairs`` (a, b) with ``linked``, from the whole texts of the classes' first documents."""
    ends = staged(pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
                  .join(classes.select("cls", "rep", "digest"), "cls").select("cls", F.col("rep").alias("doc_id"), "digest"), "ends")
    # a null id is an id like another here, and equal ids may have unlike texts: the digest decides
    wanted = _small(ends)
    texts = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["doc_id"])).select("cls", "digest", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, 2):
                sets = [np.unique(h) for h in shingle_hashes(part.column(2).to_pylist(), rule.width)]
                right = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() == d for s, d in zip(sets, part.column(1).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).filter(pa.array(right)), pa.array([s.tobytes() for s, r in zip(sets, right, strict=True) if r], pa.binary())],
                    names=["cls", "members"])

    sets = staged(texts.mapInArrow(trimmed(run), "cls long, members binary").dropDuplicates(["cls"]), "sets")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                first, second = (np.frombuffer(m.as_buffer(), np.uint64) for m in (x, y))
                shared = len(np.intersect1d(first, second, assume_unique=True))
                linked.append(100 * shared >= rule.percent * (len(first) + len(second) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])

    both = (pairs.join(sets.select(F.col("cls").alias("a"), F.col("members").alias("first")), "a")
            .join(sets.select(F.col("cls").alias("b"), F.col("members").alias("second")), "b"))
    return both.select("a", "b", "first", "second").mapInArrow(trimmed(compare), "a long, b long, linked boolean")


def connect(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """cls, comp after joining the components that ``edges`` (a, b) link: the smallest class of each.

    Rounds of taking the least neighbour and jumping to its own label; only components that edges
    touch take part, and each round is stored.
    """
    one = labels.select(F.col("cls").alias("a"), F.col("comp").alias("u"))
    two = labels.select(F.col("cls").alias("b"), F.col("comp").alias("v"))
    links = edges.join(one, "a").join(two, "b").filter("u <> v").select("u", "v")
    links = staged(links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "links")
    state = staged(links.groupBy("u").agg(F.least("u", F.min("v")).alias("to")), "state")
    while True:
        step = (links.join(state.select(F.col("u").alias("v"), F.col("to").alias("near")), "v").groupBy("u").agg(F.min("near").alias("near"))
                .join(state, "u").select("u", F.least("to", "near").alias("to"), F.col("to").alias("was")))
        step = staged(step, "step")
        jumped = (step.join(step.select(F.col("u").alias("to"), F.col("to").alias("on")), "to", "left")
                  .select("u", F.coalesce("on", "to").alias("to"), "was"))
        jumped = staged(jumped, "state")
        state = jumped.select("u", "to")
        if not jumped.filter("`to` <> was").limit(1).count():
            break
    return staged(labels.join(_small(state), F.col("comp") == F.col("u"), "left")
                  .select("cls", F.coalesce("to", "comp").alias("comp")), "labels")


def components(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs`` (doc_id, text).

    component_id: the smallest doc_id that links reach, the row's own included. Null, empty and
    blank texts have no shingles and link with nothing, so their component is their own id. Rows
    repeated, or equal in their sets, are one class. A null id is larger than any other; if all ids
    of a component are null, it is null. An empty table gives no rows; other columns are not read.
    """
    return _grouped(docs, rule).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def _grouped(docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, n, digest, component_id of every row, and grp, which tells components apart that have one id; null without shingles."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = staged(sketches(docs, frequency_levels(docs, rule.width), rule), "sketches")
    found = sketch.filter("n > 0").groupBy("digest", "n").agg(F.min("doc_id").alias("rep"), F.first("prefix").alias("prefix"),
                                                              F.first("bitmap").alias("bitmap"))
    classes = staged(found.withColumns({"cls": F.monotonically_increasing_id(), "grp": F.xxhash64("n", "prefix")}), "classes")
    postings = shared_postings(classes)
    labels = staged(postings.select("cls").distinct().select("cls", F.col("cls").alias("comp")), "labels")
    failed = docs.sparkSession.createDataFrame([], "a long, b long")
    full = False
    while True:
        found = staged(candidate_pairs(postings, classes, labels, failed, rule, full), "found")
        pairs = staged(found.select("a", "b").distinct(), "pairs")
        if pairs.limit(1).count():
            done = staged(verify(pairs, classes, docs, rule), "verified")
            labels = connect(labels, done.filter("linked"))
            failed = staged(failed.unionByName(done.filter("not linked").select("a", "b")), "failed")
        # a list that yielded no pair has none left, now or later; long ones were not looked at in full yet
        left = found.select("shingle")
        if not full:
            left = left.unionByName(postings.filter(F.col("size") > BLOCK).select("shingle"))
        left = staged(left.distinct(), "left")
        if not left.limit(1).count():
            break
        postings = staged(postings.join(_small(left), "shingle", "left_semi"), "lists-left")
        full = True
    least = classes.join(labels, "cls").groupBy("comp").agg(F.min("rep").alias("component_id"))
    named = labels.join(least, "comp").select("cls", "comp", "component_id")
    own = staged(classes.select("cls", "digest", "n", "rep").join(named, "cls", "left")
                 .select("digest", "n", F.coalesce("comp", "cls").alias("grp"), F.coalesce("component_id", "rep").alias("component_id")), "named")
    return (sketch.select("doc_id", "n", "digest").join(own, ["digest", "n"], "left")
            .select("doc_id", "n", "digest", "grp", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def one_of_each(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``docs`` with one row of each component: that whose doc_id is the component's smallest.

    Rows without shingles link with nothing and all stay. Rows without an id cannot be told apart by
    a result, so they stay as well. Rows that share an id are told apart by their sets: each goes with
    its own component, and of several under the staying id one stays.
    """
    rows = staged(_grouped(docs, rule).filter("doc_id is not null"), "grouped")
    stay = staged(rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"), F.max(F.expr("component_id = doc_id")).alias("stays"))
                  .filter("stays").select(F.col("doc_id").alias("stays"), "rows"), "stay")
    once = staged(stay.filter("rows = 1").select("stays"), "once")
    shared = _small(staged(stay.filter("rows > 1").select("stays"), "shared"))
    same = docs["doc_id"].cast("long") == F.col("stays")
    kept = docs.join(_small(once), same, "left_semi").unionByName(docs.filter(F.col("doc_id").isNull()))
    chosen = (rows.filter("component_id = doc_id and n > 0").join(shared, F.col("doc_id") == F.col("stays"), "left_semi")
              .groupBy("grp", "doc_id").agg(F.min("digest").alias("digest")).select(F.col("doc_id").alias("stays"), F.col("digest").alias("set")))
    told = with_digest(docs.join(shared, same, "left_semi"), rule)
    one = (told.join(_small(staged(chosen, "chosen")), (told["doc_id"].cast("long") == F.col("stays")) & (told["__digest"] == F.col("set")), "left_semi")
           .dropDuplicates(["doc_id", "__digest"]))
    return kept.unionByName(one.unionByName(told.filter("__digest is null")).drop("__digest"))


def with_digest(docs: DataFrame, rule: Rule) -> DataFrame:
    """``docs`` and the digest of each row's set, as in ``sketches``; null without shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, 0):
                sets = [np.unique(h) for h in shingle_hashes(part.column(0).to_pylist(), rule.width)]
                digests = [hashlib.blake2b(m.tobytes(), digest_size=16).digest() if len(m) else None for m in sets]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(digests, pa.binary())], names=[*part.schema.names[1:], "__digest"])

    kinds = ", ".join(f"`{c.name}` {c.dataType.simpleString()}" for c in docs.schema)
    return docs.select(F.col("text").cast("string").alias("__text"), *[F.col(f"`{c}`") for c in docs.columns]).mapInArrow(trimmed(run), f"{kinds}, __digest binary")
