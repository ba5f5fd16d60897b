"""Best-fit packing planned over a histogram of lengths.

Only how many pieces have each length goes to the driver: at most one number per length, whatever
the number of documents. Best-fit decreasing runs over these counts and yields slots for runs of
pieces of one length; a piece takes the slot that its rank among pieces of its length points to.
"""

from __future__ import annotations

import bisect
import os
import re
import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import blocks, per_process, staged, trimmed

CAPACITY = 4096
END = b"\x01\x00\x00\x00"  # id 1 ends each document
PART_ROWS = 1 << 20
KEPT_BYTES = 96 << 20  # of each of the two tables of words
ENTRY_BYTES = 200  # of the table of words, beside the word and its ids
CALL_WORDS = 256
BLOCK_BYTES = 2 << 20
# runs of letters (a-z and U+00C0 to U+00FF in UTF-8, which no normal form changes) and of ASCII signs but the apostrophe
RUNS = re.compile(rb"(?:[a-z]+|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+|[!-&(-/:-@\[-`{-~]+")


class WordIds:
    """Ids of whole texts by the tokenizers file at ``path``, whose words never reach across white space.

    Arrow splits the texts and numbers their distinct words; Python meets only those, and ids of a text
    are gathered by number. The library encodes each distinct word once while it is kept, many in one
    call. Two tables of ``kept_bytes`` each keep them, so that words in use stay when others go. The file
    lower-cases, so A-Z are lowered first, and a run of Latin letters or of signs without an apostrophe is
    a word of its own: runs go to the library between spaces and end with an id that bears the suffix of
    word ends. Other words go between special tokens.
    """

    def __init__(self, path: str, kept_bytes: int | None = None) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks; threads here would each hold memory
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = self.tokenizer.get_added_tokens_decoder()
        special = {i: t.content for i, t in added.items() if not (t.lstrip or t.rstrip or t.single_word)}
        self.cut, self.cut_text = min(special.items()) if special else (None, "")
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(1 + max(vocabulary.values(), default=0), bool)  # ids that end a word
        if suffix:
            self.last[[i for t, i in vocabulary.items() if t.endswith(suffix) and i not in added]] = True
        #: words met since the last change of tables, and those of the table before it
        self.ids: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.kept, self.kept_bytes = 0, kept_bytes or KEPT_BYTES

    def _encoded(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _runs_encoded(self, runs: list[bytes], made: dict[bytes, bytes]) -> list[bytes]:
        """Ids of ``runs`` join ``made``; those that could not be told apart are returned."""
        left: list[bytes] = []
        for at in range(0, len(runs), CALL_WORDS):
            part = runs[at:at + CALL_WORDS]
            ids = self._encoded([b" ".join(part).decode()])[0]
            stops = (4 * (np.flatnonzero(self.last[ids]) + 1)).tolist()
            if len(stops) != len(part) or stops[-1] != 4 * len(ids):
                left += part
                continue
            raw = ids.tobytes()
            made.update(zip(part, map(raw.__getitem__, map(slice, [0, *stops], stops)), strict=True))
        return left

    def _learn(self, missing: set[bytes]) -> None:
        made: dict[bytes, bytes] = {}
        new, others, split = [], [], {}  # runs, words that are no runs, words of several runs
        for w in missing:
            runs = RUNS.findall(w)
            if runs == [w]:
                new.append(w)
            elif b"<|" not in w and b"".join(runs) == w:
                split[w] = runs
            else:
                others.append(w)
        parts = set().union(*split.values()).difference(new)
        known = {w: self.ids[w] for w in parts if w in self.ids}
        moved = {w: self.older[w] for w in parts.difference(known) if w in self.older}
        made |= moved
        new += parts.difference(known, moved)
        others += self._runs_encoded(new, made)
        alone = [w for w in others if self.cut is None or b"<|" in w]  # may hold a special token
        joined = [w for w in others if self.cut is not None and b"<|" not in w]
        for w, ids in zip(alone, self._encoded([w.decode() for w in alone]), strict=True):
            made[w] = ids.tobytes()
        for at in range(0, len(joined), CALL_WORDS):
            part = joined[at:at + CALL_WORDS]
            ids = self._encoded([self.cut_text.join(w.decode() for w in part)])[0]
            ends = [-1, *np.flatnonzero(ids == self.cut).tolist(), len(ids)]
            for w, a, b in zip(part, ends[:-1], ends[1:], strict=True):
                made[w] = ids[a + 1:b].tobytes()
        for w, runs in split.items():
            made[w] = b"".join([known[r] if r in known else made[r] for r in runs])
        self._keep(made)

    def _keep(self, made: dict[bytes, bytes]) -> None:
        self.ids.update(made)
        self.kept += ENTRY_BYTES * len(made) + sum(map(len, made)) + sum(map(len, made.values()))

    def _looked_up(self, words: list[bytes]) -> list[bytes]:
        if self.kept > self.kept_bytes:  # words in use move on to the new table, others go with the next change
            self.older, self.ids, self.kept = self.ids, {}, 0
        found = list(map(self.ids.get, words))
        missing = {w for w, ids in zip(words, found, strict=True) if ids is None}
        if not missing:
            return found
        again = {w: self.older[w] for w in missing if w in self.older}
        self._keep(again)
        self._learn(missing.difference(again))
        return [self.ids[w] if ids is None else ids for w, ids in zip(words, found, strict=True)]

    def packed(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; a null text has none."""
        split = pa.compute.ascii_split_whitespace(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        stops = np.cumsum(pa.compute.list_value_length(split).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
        words = split.flatten().dictionary_encode()
        lowered = pa.compute.ascii_lower(words.dictionary)
        marked = pa.compute.match_substring(words.dictionary, "<|")  # special tokens are found before lower-casing
        lowered = pa.compute.if_else(marked, words.dictionary, lowered).cast(pa.large_binary())
        ids = pa.array(self._looked_up(lowered.to_numpy(zero_copy_only=False).tolist()), pa.large_binary())
        joined = ids.take(words.indices)
        _, offsets, raw = joined.buffers()
        at = np.frombuffer(offsets, np.int64)[joined.offset:] if len(joined) else np.zeros(1, np.int64)
        cuts = [int(at[0]), *at[stops].tolist()]
        view = memoryview(raw) if raw else memoryview(b"")
        return [bytes(view[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, kept_bytes: int | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each document's ids, cut only where longer than ``capacity``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: WordIds = per_process(("words", path, kept_bytes), lambda: WordIds(path, kept_bytes))
        step = 4 * capacity
        for batch in (part for whole in batches for part in blocks(whole, 1, BLOCK_BYTES)):
            rows = []
            for doc, packed in zip(batch.column(0).to_pylist(), words.packed(batch.column(1)), strict=True):
                ids = packed + END
                rows += [(doc, k, at // 4, (min(at + step, len(ids)) - at) // 4, zlib.crc32(ids[at:at + step]))
                         for k, at in enumerate(range(0, len(ids), step))]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        trimmed(run), "doc_id long, piece int, start long, length long, ids_crc32 long")


def plan(histogram: Mapping[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Best-fit decreasing over counts: rows (length, first rank, count, first sequence, offset).

    Sequences are kept as runs of numbers per room left. A step places one run of pieces of one
    length into one run of sequences, so there are steps for lengths and rooms, not for documents.
    """
    room: dict[int, list[tuple[int, int]]] = {}
    open_rooms: list[int] = []
    out: list[tuple[int, int, int, int, int]] = []
    sequences = 0

    def add(left: int, run: tuple[int, int]) -> None:
        if left:
            if left not in room:
                room[left] = []
                bisect.insort(open_rooms, left)
            room[left].append(run)

    for length in sorted(histogram, reverse=True):
        rank, todo = 0, histogram[length]
        while todo:
            k = bisect.bisect_left(open_rooms, length)
            if k == len(open_rooms):
                break
            left = open_rooms[k]
            first, many = room[left].pop()
            used = min(many, todo)
            out.append((length, rank, used, first, capacity - left))
            rank, todo = rank + used, todo - used
            if used < many:
                room[left].append((first + used, many - used))
            if not room[left]:
                del room[left]
                open_rooms.pop(k)
            add(left - length, (first, used))
        fit = capacity // length
        new, spare = -(-todo // fit), todo % fit
        for layer in range(fit if new else 0):  # pieces of this length only fill new sequences
            used = new if not spare or layer < spare else new - 1
            if used:
                out.append((length, rank, used, sequences, layer * length))
                rank += used
        if new:
            full = new - bool(spare)
            if full:
                add(capacity - fit * length, (sequences, full))
            if spare:
                add(capacity - spare * length, (sequences + full, 1))
            sequences += new
    return np.array(out, np.int64).reshape(-1, 5)


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` (doc_id, piece, length, ...) with sequence_id and offset; it is read twice, so pass a stored table.

    Ranks within a length are counted in parts of about PART_ROWS pieces, a sum over parts makes
    them ranks of the whole, so one length may hold any share of the pieces. Any order gives the
    same number of sequences; here it is doc_id, piece within a hash part.
    """
    spark = cut.sparkSession
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # <= capacity rows
    parts = max(1, -(-max(histogram.values(), default=0) // PART_ROWS))
    slots = plan(histogram, capacity)
    keys = slots[:, 0] << 40 | slots[:, 1]
    order = np.argsort(keys)
    shared = spark.sparkContext.broadcast((keys[order], slots[order]))  # steps: lengths and rooms bound them

    rows = cut.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)).cast("int"))
    before = F.coalesce(F.sum("count").over(W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = rows.groupBy("length", "part").count().select("length", "part", before.alias("before"))
    in_part = F.row_number().over(W.partitionBy("length", "part").orderBy("doc_id", "piece"))
    ranked = (rows.withColumn("in_part", in_part).join(starts, ["length", "part"])
              .withColumn("rank", F.col("before") + F.col("in_part") - 1).select(*cut.columns, "rank"))

    names = cut.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts_at, steps = shared.value
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            step = steps[np.searchsorted(starts_at, length << 40 | rank, "right") - 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(step[:, 3] + rank - step[:, 1]), pa.array(step[:, 4])],
                names=[*names, "sequence_id", "offset"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)
    return ranked.mapInArrow(place, f"{kept}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, kept_bytes: int | None = None) -> DataFrame:
    """All documents (doc_id, text) in sequences of at most ``capacity`` ids of the vocabulary at ``path``.

    One row per piece. A null or empty text is the end id alone. Repeated rows are packed like any
    other; other columns are not read; an empty table gives no rows. With less ``kept_bytes`` a worker
    holds less memory and encodes more words anew; the ids are the same.
    """
    return pack(staged(pieces(docs, path, capacity, kept_bytes), "pieces"), capacity)
