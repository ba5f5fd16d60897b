"""From raw documents to packed training sequences: four stages, each on all that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import jaccard, packing, quality, toxicity
from ledgerline.llm.common import staged, table
from ledgerline.llm.queries import TOXIC_FROM, tokenizer_file

#: of each table of words: an executor still holds what earlier stages grew to
PACKING_BYTES = 24 << 20

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _columns(judged: DataFrame, docs: DataFrame) -> DataFrame:
    return judged.select([F.col(f"`in_{c}`").alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the length and repetition rules and lie near a language of the corpus."""
    return _columns(quality.judge(docs, carry=tuple(docs.columns)).filter("kept"), docs)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model of the labelled ones among them does not call toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return _columns(toxicity.score(docs, model, carry=tuple(docs.columns)).filter(F.col("score") < TOXIC_FROM), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles are similar by 0.8 or more."""
    return jaccard.one_of_each(docs, jaccard.Rule(width=5, percent=80)).select(docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 4096 tokens."""
    return packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"), kept_bytes=PACKING_BYTES)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("n-gram Jaccard join", near_duplicates),
    ("best-fit packing", best_fit_packing),
]

#: The distances, the random field and the tokenizer are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; what each returns is stored and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
