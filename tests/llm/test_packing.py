from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from ledgerline.llm import packing
from ledgerline.llm.queries import tokenizer_file

PATH = "word_bpe_49k.json"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file(PATH))


def test_ids_equal_the_library(library):
    from test_bpe import HARD

    rnd = random.Random(3)
    texts = HARD + ["".join(rnd.choice("ab E'ts \n\t.,!é ́<|>0İΣ") for _ in range(rnd.randint(1, 60))) for _ in range(3000)]
    texts += ["<|startoftext|>A b.<|endoftext|>", "Word, word. Word., WORD"]
    words = packing.WordIds(tokenizer_file(PATH))
    for at in range(0, len(texts), 100):  # kept words of earlier calls are used by later ones
        part = texts[at:at + 100]
        for text, packed, right in zip(part, words.packed(part), library.encode_batch(part, add_special_tokens=False), strict=True):
            assert np.frombuffer(packed, "<u4").tolist() == right.ids, text


def test_words_in_use_are_encoded_once(monkeypatch, library):
    """The table of words is bounded, but a word that every call needs is not encoded again when others go."""
    monkeypatch.setattr(packing, "KEPT_BYTES", 4000)
    words, seen = packing.WordIds(tokenizer_file(PATH)), []
    learn = packing.WordIds._learn
    monkeypatch.setattr(packing.WordIds, "_learn", lambda self, missing: (seen.extend(missing), learn(self, missing)))
    for k in range(60):
        text = f"common bread. rare{k} other{k}"
        assert np.frombuffer(words.packed([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert seen.count(b"common") == 1 and seen.count(b"bread.") == 1
    assert len(words.ids) + len(words.older) < 100


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once(seed):
    rnd = random.Random(seed)
    histogram = {rnd.randint(1, 100): rnd.randint(1, 40) for _ in range(30)} | {100: 7}
    rows = packing.plan(histogram, 100)
    ranks, sequences = {}, {}
    for length, rank, count, first, offset in rows.tolist():
        for k in range(count):
            ranks.setdefault(length, []).append(rank + k)
            sequences.setdefault(first + k, []).append((offset, length))
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in histogram.items()}
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 100
    # best-fit decreasing over single pieces, one by one
    room = []
    for length in sorted((n for n, c in histogram.items() for _ in range(c)), reverse=True):
        fits = [i for i, r in enumerate(room) if r >= length]
        if fits:
            room[min(fits, key=room.__getitem__)] -= length
        else:
            room.append(100 - length)
    assert len(sequences) <= len(room)


def check(rows, got, library, capacity):
    want = []
    for doc, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at:at + capacity], "<u4")
            want.append((doc if doc is not None else -1, k, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_documents(spark, library, monkeypatch):
    monkeypatch.setattr(packing, "PART_ROWS", 50)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = packing.pack_documents(docs, tokenizer_file(PATH)).collect()
    assert check(rows, got, library, 4096) <= -(-sum(r.length for r in got) // 4096) + 1


def test_edges(spark, library):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "x"), (4, "word " * 500), (5, "é")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as length", "2 as offset", "3 as rank")
    check(rows, packing.pack_documents(df.repartition(3), tokenizer_file(PATH), 64).collect(), library, 64)
    assert packing.pack_documents(df.filter("false"), tokenizer_file(PATH)).collect() == []


def test_a_smaller_table_of_words_gives_the_same_ids(library):
    """A pipeline's workers may hold less than the operator alone: fewer words are kept, no id changes."""
    texts = [" ".join(f"w{i}x{j}" for j in range(40)) + " the, end." for i in range(200)]
    small = packing.WordIds(tokenizer_file(PATH), kept_bytes=20_000)
    held, out = 0, []
    for at in range(0, len(texts), 10):
        out += small.packed(texts[at:at + 10])
        held = max(held, len(small.ids) + len(small.older))
    assert held < 1500  # of more than 8000 words
    assert [np.frombuffer(x, "<u4").tolist() for x in out] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_a_run_is_encoded_once_whatever_signs_follow(monkeypatch, library):
    """Words that differ in case or in signs around the same letters cost the library one call's worth of them."""
    words, sent = packing.WordIds(tokenizer_file(PATH)), []
    encoded = packing.WordIds._encoded
    monkeypatch.setattr(packing.WordIds, "_encoded", lambda self, texts: (sent.extend(texts), encoded(self, texts))[1])
    texts = ["Zürichberg*** zürichberg### (zürichberg) zürichberg.", "zürichberg&&& ZürichBerg, zürichberg", "(zürichberg)***"]
    for text in texts:
        assert np.frombuffer(words.packed([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert "".join(sent).count("zürichberg") == 1


def test_runs_of_letters_and_signs(library):
    """Latin letters and signs in any mixture, and what may not be cut at runs: accents apart, apostrophes, digits, special tokens."""
    rnd = random.Random(11)
    letters = "abstzÀÉÖØÞßàíöøÿªµ×÷é́ñ"
    texts = ["".join(rnd.choice(letters + "''**##..,,<|>/w</w>\\^`~_-12 \t\n\xa0\x85\x1c\x00ŁσΣ") for _ in range(rnd.randint(0, 80))) for _ in range(2000)]
    texts += ["É</w>é </w> é*** x<|endoftext|>Y*** <|ENDOFTEXT|> " + "ß" * 300, " ", "*** ***abc***def"]
    words = packing.WordIds(tokenizer_file(PATH), kept_bytes=100_000)
    for at in range(0, len(texts), 50):
        part = texts[at:at + 50]
        for text, packed, right in zip(part, words.packed(part), library.encode_batch(part, add_special_tokens=False), strict=True):
            assert np.frombuffer(packed, "<u4").tolist() == right.ids, text


def test_texts_of_an_arrow_slice_with_nulls(library):
    import pyarrow as pa

    texts = ["left out", None, "", " a  b ", None, "C. d"]
    for kind in (pa.string(), pa.large_string()):
        got = packing.WordIds(tokenizer_file(PATH)).packed(pa.array(texts, kind).slice(1))
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == [library.encode(x or "", add_special_tokens=False).ids for x in texts[1:]]
    assert packing.WordIds(tokenizer_file(PATH)).packed([None, ""]) == [b"", b""] and packing.WordIds(tokenizer_file(PATH)).packed([]) == []
