from __future__ import annotations

import hashlib
import random

import pytest

from ledgerline.llm import bpe
from ledgerline.llm.queries import tokenizer_file

HARD = ["", " ", "  ", "a  b", " a\n\n b\n", "x\ty  z\n \n", "<|endoftext|>hi <|endoftext|> x", "it's we'll I'd ''s", "naïve ÉÉÉ 中文 字 １２３ 45a",
        "a b  c", "\x1c a\x1fb", "a\x00b", "́ é é", "İstanbul ΣΑΣ. ΣΑΣ", "a" * 300, "...,,. a.,b ,a., a.\x85b 🎉🎉 ñ.",
        "\r\n a\r\n\r\n b \n", "trail ", "\n", "a \n", " 　x", "<|endoftext|", "<|ENDOFTEXT|>", "thth" * 50]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(tokenizer_file("byte_bpe_50k.json"))


def test_equals_the_library(codec, library):
    rnd = random.Random(1)
    alphabet = "ab e'tsrhn \n\t.,!é中 ́\x1f<|>0İΣ🎉"
    texts = HARD + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 80))) for _ in range(3000)]
    for text, right in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        ids = codec.encode(text)
        assert ids.tolist() == right.ids, text
        assert codec.decode(ids) == library.decode(right.ids, skip_special_tokens=False), text


def test_small_caches_change_nothing(codec, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 3)
    text = "the cat sat on the mat, and the dog did not.\nAnd so on"
    assert bpe.Codec(tokenizer_file("byte_bpe_50k.json")).encode(text).tolist() == codec.encode(text).tolist()


def test_pairs_are_compatible_if_merging_keeps_them(codec, library):
    rnd = random.Random(2)
    letters = bpe.byte_letters()
    assert len(set(letters.values())) == 256
    for _ in range(2000):
        a, b = rnd.randrange(256, 50_000), rnd.randrange(256, 50_000)
        try:
            text = codec.spelled[codec.offsets[a]:codec.offsets[a + 1]].tobytes().decode() + codec.spelled[codec.offsets[b]:codec.offsets[b + 1]].tobytes().decode()
        except UnicodeDecodeError:
            continue
        if len(codec.words.findall(text)) == 1:
            assert codec._compatible(a, b) == (library.encode(text, add_special_tokens=False).ids == [a, b])


def test_rows(spark):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "é 中\n"), (4, "word " * 60_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as ids", "0 as n_tokens")
    got = bpe.encode_decode(df, tokenizer_file("byte_bpe_50k.json")).collect()
    assert sorted((r.doc_id or -1, r.decoded) for r in got) == sorted((i or -1, t or "") for i, t in rows)
    digests = bpe.encode_decode(df, tokenizer_file("byte_bpe_50k.json"), digests_only=True).collect()
    whole = {(r.doc_id, hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest(), len(r.ids)) for r in got}
    assert {(r.doc_id, r.ids_sha256, r.n_tokens) for r in digests} == whole
    assert bpe.encode_decode(df.filter("false"), tokenizer_file("byte_bpe_50k.json")).collect() == []
