"""The registered queries against SQL, the pipeline against its stages one by one."""

from __future__ import annotations

import zlib

import duckdb
import pytest

import corpus_pipeline
from ledgerline.llm import jaccard, toxicity
from ledgerline.llm.queries import ORACLE_SQL, QUERIES

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    cursor = con.execute(ORACLE_SQL[name])
    names = [c[0] for c in cursor.description]
    want = sorted(map(repr, cursor.fetchall()))
    df = QUERIES[name](spark, DIR)
    assert sorted(df.columns) == sorted(names)
    assert sorted(repr(tuple(r)) for r in df.select(names).collect()) == want


CONTRACT = {
    "op1_lm": "doc_id:bigint held_out:boolean n_tokens:bigint n_known:bigint train_tokens:bigint base_score:double score:double",
    "op2_html": "page_id:bigint url:string text:string n_chars:bigint",
    "op3_quality": "doc_id:bigint n_words:bigint word_chars:bigint n_symbols:bigint n_dup_lines:bigint n_repeat_words:bigint base_failed:boolean kept:boolean",
    "op4_bpe": "doc_id:bigint n_tokens:bigint ids_sha256:string decoded_sha256:string",
    "op5_jaccard": "doc_id:bigint n_shingles:bigint component_id:bigint",
    "op6_toxicity": "doc_id:bigint held_out:boolean score:double predicted:int",
    "op7_pack": "doc_id:bigint piece:int start:bigint length:bigint ids_crc32:bigint sequence_id:bigint offset:bigint",
    "op8_reshard": "doc_id:bigint size:bigint text_crc32:bigint law:string shard:int slot:bigint grown_shard:int",
    "op9_knn": "query_id:bigint rank:int vec_id:bigint score:bigint",
    "op10_warc": "page_id:bigint payload_bytes:bigint payload_digest:string record_type:string refers_to:bigint",
}


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_columns_and_rows(spark, name):
    df = QUERIES[name](spark, DIR)
    kinds = dict(df.dtypes)
    for column in CONTRACT[name].split():
        c, kind = column.split(":")
        assert kinds[c] == kind, column
    source = "pages" if name in ("op2_html", "op10_warc") else "documents"
    if name not in ("op7_pack", "op9_knn"):
        assert df.count() == spark.read.parquet(f"{DIR}/{source}.parquet").count()


def test_shard_digests(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}
    for r in QUERIES["op8_reshard"](spark, DIR).collect():
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(texts[r.doc_id].encode()) + 1, zlib.crc32(texts[r.doc_id].encode()), "bytes", None)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    rows = docs.collect()
    # quality, stage by stage against the operators' own verdicts
    kept = {r.doc_id for r in QUERIES["op3_quality"](spark, DIR).filter("kept").collect()}
    one = corpus_pipeline.quality_rules(spark, docs, DIR).cache()
    assert {r.doc_id for r in one.collect()} == kept and one.columns == docs.columns
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{DIR}/labels.parquet").collect()}
    train = sorted((r.doc_id, r.text, labels[r.doc_id]) for r in rows
                   if r.doc_id in kept and labels.get(r.doc_id) is not None and zlib.crc32(str(r.doc_id).encode()) % 3 != 1)
    model = toxicity.train([(t, y) for _, t, y in train])
    clean = {r.doc_id for r in toxicity.score(one, model).filter("score < 0.7").collect()}
    two = corpus_pipeline.toxicity_filter(spark, one, DIR).cache()
    assert {r.doc_id for r in two.collect()} == clean and two.columns == docs.columns
    from test_jaccard import brute

    want = {c for _, _, c in brute([(r.doc_id, r.text) for r in rows if r.doc_id in clean], jaccard.Rule(5, 80))}
    three = corpus_pipeline.near_duplicates(spark, two, DIR).cache()
    assert {r.doc_id for r in three.collect()} == want and three.count() == len(want) and three.columns == docs.columns
    packed = corpus_pipeline.run(spark, DIR).collect()
    assert {r.doc_id for r in packed} == want
    assert len(corpus_pipeline.STAGES) == 4
