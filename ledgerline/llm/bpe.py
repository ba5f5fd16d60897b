"""Byte-level BPE without a merge loop: longest matches, checked against neighbours, with backtracking.

An Aho-Corasick automaton finds every vocabulary token at every position of a word. From left to
right the longest token is taken that is *compatible* with the token before it; where none is, the
last choice is undone and its position is closed for good. A sequence whose neighbours are all
compatible is the merge result, and each position is closed at most once, so the work is linear in
the text. Pairs are compatible if the merges, played back along the edge where the two tokens meet,
never join across it; verdicts are kept in a table. Decoding gathers slices of one byte string by an
offset table.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_process

# Unicode White_Space; the word pattern of the public byte-level vocabulary (fixed values)
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORDS = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+"
         rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
KEPT = 300_000


class Kept(dict):
    """A dictionary that makes what it lacks, and starts anew when it holds KEPT entries."""

    def __init__(self, make: Callable[[Any], Any]) -> None:
        super().__init__()
        self.make = make

    def __missing__(self, key: Any) -> Any:
        made = self.make(key)
        if len(self) >= KEPT:
            self.clear()
        self[key] = made
        return made


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it prints, else the next from 256 on."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return {b: chr(b if b in prints else next(rest)) for b in range(256)}


class Codec:
    """Encoder and decoder for the byte-level BPE vocabulary in a tokenizers file at ``path``."""

    def __init__(self, path: str) -> None:
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        letters = {c: b for b, c in byte_letters().items()}
        vocabulary: dict[str, int] = told["model"]["vocab"]
        added = {x["content"]: x["id"] for x in told["added_tokens"]}
        # bytes as Latin-1 text, which the automaton takes
        names = {i: "".join(chr(letters[c]) for c in s) for s, i in vocabulary.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int, int]] = {}
        for r, pair in enumerate(told["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left, right = vocabulary[a], vocabulary[b]
            self.rank[left, right] = r
            self.halves.setdefault(vocabulary[a + b], (left, right, r))
        self.tokens = ahocorasick.Automaton()
        for i, s in names.items():
            self.tokens.add_word(s, (len(s), i))
        self.tokens.make_automaton()
        self.special = added
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.words = regex.compile(WORDS)
        self.uneven = re.compile(f"[{SPACE}][{SPACE}]")
        self.verdicts = Kept(lambda pair: self._compatible(*pair))
        self.pieces = Kept(lambda word: np.array(self._encode_word(word), "<u4").tobytes())
        self.plain = Kept(self._encode_words)
        self.spaced = Kept(lambda word: self._encode_words(" " + word))
        # decoding: one byte string, and where each token starts in it
        spelled = [b""] * (1 + max([*names, *added.values()]))
        for i, s in names.items():
            spelled[i] = s.encode("latin-1")
        for s, i in added.items():
            spelled[i] = s.encode()
        self.offsets = np.cumsum([0, *map(len, spelled)])
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """(token at that edge, rank of the merge that uses it up), from the whole token down to a byte."""
        edge, until = [], len(self.rank)
        while token in self.halves:
            edge.append((token, until))
            until = self.halves[token][2]
            token = self.halves[token][side]
        return [*edge, (token, until)]

    def _compatible(self, a: int, b: int) -> bool:
        left, right = self._edge(a, 1), self._edge(b, 0)
        i, j = len(left) - 1, len(right) - 1
        while True:  # from single bytes up to the whole tokens, in the order of the merges
            (x, x_until), (y, y_until) = left[i], right[j]
            joined = self.rank.get((x, y))
            # of equal merges, the one further left happens first
            if joined is not None and joined < x_until and joined <= y_until:
                return False
            if i == 0 and j == 0:
                return True
            if j == 0 or (i > 0 and x_until <= y_until):
                i -= 1
            else:
                j -= 1

    def _encode_word(self, word: str) -> list[int]:
        text = word.encode().decode("latin-1")
        n = len(text)
        found: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for last, (size, token) in self.tokens.iter(text):
            found[last + 1 - size].append((last + 1, token))  # by growing length
        chosen: list[tuple[int, int]] = []
        taken: list[int] = []
        closed = bytearray(n + 1)
        at, k = 0, len(found[0]) - 1
        while at < n:
            options = found[at]
            while k >= 0 and (closed[options[k][0]] or (taken and not self.verdicts[taken[-1], options[k][1]])):
                k -= 1
            if k >= 0:
                chosen.append((at, k))
                at, token = options[k]
                taken.append(token)
                k = len(found[at]) - 1 if at < n else 0
            else:
                closed[at] = 1
                at, k = chosen.pop()
                taken.pop()
                k -= 1
        return taken

    def _encode_words(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.words.findall(text)))

    def _encode_part(self, text: str) -> Iterable[bytes]:
        if self.uneven.search(text):
            return [self._encode_words(text)]
        # single spaces go with the word after them, other white space stands alone: words never
        # reach across a space or a line end, so text between two of them can be looked up whole
        out: list[bytes] = []
        for i, line in enumerate(text.split("\n")):
            if i:
                out.append(self.plain["\n"])
            head, *rest = line.split(" ")
            if head:
                out.append(self.plain[head])
            out.extend(map(self.spaced.__getitem__, rest))
        return out

    def encode(self, text: str) -> np.ndarray:
        """Token ids; the strings of added tokens stand for those tokens."""
        out: list[bytes] = []
        for part in self.cut.split(text) if self.cut else [text]:
            if part in self.special:
                out.append(np.array([self.special[part]], "<u4").tobytes())
            elif part:
                out.extend(self._encode_part(part))
        return np.frombuffer(b"".join(out), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        starts = self.offsets[ids]
        sizes = self.offsets[ids + np.uint32(1)] - starts
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)
        return self.spelled[at].tobytes().decode("utf-8", "replace")


def encode_decode(docs: DataFrame, path: str, digests_only: bool = False) -> DataFrame:
    """doc_id, ids, decoded and n_tokens of every text of ``docs`` (doc_id, text); a null text is empty.

    With ``digests_only`` the digests of ids (decimal, joined by commas) and decoded text stand in
    their place. Rows are independent: repeated rows give repeated results, an empty table none, and
    other columns are not read. ``path``: the vocabulary file, which every executor can read.
    """
    schema = "doc_id long, n_tokens long, " + (
        "ids_sha256 string, decoded_sha256 string" if digests_only else "ids array<int>, decoded string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec: Codec = per_process(("bpe", path), lambda: Codec(path))
        numerals = per_process(("numerals", path), lambda: [str(i) for i in range(len(codec.offsets))])

        def hexes(text: str) -> str:
            return hashlib.sha256(text.encode()).hexdigest()

        for batch in batches:
            counts, first, second = [], [], []
            for text in batch.column(1):
                ids = codec.encode(text.as_py() or "")
                decoded = codec.decode(ids)
                counts.append(len(ids))
                if digests_only:
                    first.append(hexes(",".join(map(numerals.__getitem__, ids.tolist()))))
                    second.append(hexes(decoded))
                else:
                    first.append(ids.astype(np.int32))
                    second.append(decoded)
            kinds = (pa.string(), pa.string()) if digests_only else (pa.list_(pa.int32()), pa.string())
            names = [x.split(" ")[0] for x in schema.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(first, kinds[0]),
                                              pa.array(second, kinds[1])], names=names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)
