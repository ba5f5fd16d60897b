from __future__ import annotations

import base64
import hashlib

import numpy as np
import pytest

from ledgerline.llm import common, warc

FAKE = ("x WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
        "WARC/1.1\r\n tail WARC/1.1\r\n")
ROWS = [(1, "u", "a"), (2, "u", "a"), (3, None, None), (4, "u", ""), (5, "u", FAKE), (6, "u", "é" * 50_000), (7, "u", FAKE), (7, "u", FAKE),
        (None, "u", "a"), (None, "u", "zz"), (8, "u", "WARC/1.1\r\n"), (9, "a\r\nb c", "\r\n\r\n"), (10, "é", "HTTP/1.1 200\r\n\r\nx")]


def want(rows, least=0):
    top = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= least:
            top[h or ""] = max(top.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        target = top.get(h or "")
        again = len(raw) >= least and target is not None and target != i
        out.append((i if i is not None else -1, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                    "revisit" if again else "response", target if again else -1))
    return sorted(out)


def got(df):
    return sorted((r.page_id if r.page_id is not None else -1, r.payload_bytes, r.payload_digest, r.record_type,
                   r.refers_to if r.refers_to is not None else -1) for r in df.collect())


@pytest.mark.parametrize("least", [0, 2])
def test_round_trip(spark, least):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string").selectExpr("*", "1 as value", "2 as sha1", "3 as target")
    assert got(warc.warc_round_trip(df.repartition(3), least)) == want(ROWS, least)
    assert got(warc.warc_round_trip(df.filter("false"))) == []


@pytest.mark.parametrize("split", ["700", "20000", "128m"])
def test_files_split_anywhere(spark, split):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url", "html")
    rows = [tuple(r) for r in pages.collect()] + [(1000 + (i or 0), u, h) for i, u, h in ROWS]
    folder = common.scratch(spark, "test")
    warc.write_archives(spark.createDataFrame(rows, pages.schema).coalesce(2), folder, compression="none")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        assert got(warc.read_archives(spark, folder)) == want(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_pointer_jumping_follows_the_chain_only():
    rng = np.random.default_rng(1)
    for _ in range(50):
        sizes = rng.integers(1, 30, 40)
        real = np.cumsum(np.r_[0, sizes])
        fake = np.setdiff1d(rng.integers(1, real[-1], 30), real)
        offsets = np.sort(np.r_[real[:-1], fake])
        jump = dict(zip(real[:-1].tolist(), real[1:].tolist(), strict=True)) | {int(f): int(rng.integers(0, real[-1] + 5)) for f in fake}
        mask = warc.reachable(offsets, np.array([jump[int(o)] for o in offsets]))
        assert set(offsets[mask].tolist()) == set(real[:-1].tolist())
    assert warc.reachable(np.zeros(0, np.int64), np.zeros(0, np.int64)).tolist() == []
