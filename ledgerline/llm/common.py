"""Helpers that the operators share."""

from __future__ import annotations

import ctypes
import sys
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerline.session import checkpoint_root


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared folder; it goes when the application ends."""
    folder = f"{checkpoint_root(spark)}/llm-{name}-{uuid.uuid4().hex[:12]}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage, and survives lost executors."""
    folder = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def blocks(batch: pa.RecordBatch, text: int, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Row ranges of ``batch`` with about ``size`` bytes in column ``text`` each; a longer text is a block of its own."""
    sizes = np.array(pa.compute.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False), np.int64)
    block = np.cumsum(sizes) // size
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def carried(docs: DataFrame, carry: tuple[str, ...]) -> tuple[list[str], list[int]]:
    """Those of ``carry`` to send after doc_id (long) and text (string), and where each one of ``carry`` then is.

    doc_id and text go a second time only where the first time casts them to another type.
    """
    kinds = {f.name: f.dataType for f in docs.schema}
    sent = [c for c, kind in (("doc_id", T.LongType()), ("text", T.StringType())) if kinds.get(c) == kind]
    place = {c: ("doc_id", "text").index(c) for c in sent}
    more = [c for c in carry if c not in place]
    place |= {c: 2 + i for i, c in enumerate(more)}
    return more, [place[c] for c in carry]


def trim() -> None:
    """Freed memory goes back to the system."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow; after its last batch the worker gives freed memory back to the system.

    Workers live on for later tasks, and what the allocators hold for themselves would add up over the stages.
    """

    def to_the_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            trim()

    return to_the_end


def per_process(key: Any, make: Callable[[], Any]) -> Any:
    """What ``make`` returns, kept for the life of this worker process and its later tasks."""
    kept = sys.__dict__.setdefault("_ledgerline_llm_kept", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]
