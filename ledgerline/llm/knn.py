"""Exact top-k by inner product: a Voronoi join.

Rows go to the nearest of a fixed number of pivots. Summaries of the cells - how many rows, how far
from the pivot, how long, and the few ids next to the pivot - give each query cell a score that its
queries' k-th neighbours are sure to reach. A data row is sent to a group of query cells only if its
own distance bound reaches that score for one of them; groups are then solved locally, in blocks of
bounded size, and the blocks' best are ranked once more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import staged

PIVOTS = 64
BLOCK_ROWS = 8192
GROUP_QUERIES = 2048
SCALE = 256.0


def integer_vectors(df: DataFrame, scale: float = SCALE) -> DataFrame:
    """vec_id, v: floor(scale * x) of each component as a long; rows with a null or non-finite part, or no id, are out.

    A product beyond a long's range becomes the end of that range.
    """
    x = F.col("embedding").cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    low, high = -float(1 << 62), float(1 << 62)

    def scaled(c: Column) -> Column:
        return F.floor(F.least(F.greatest(c * scale, F.lit(low)), F.lit(high))).cast("long")

    return (df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding"))
            .filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(~bad)
            .select("vec_id", F.transform(x, scaled).alias("v")))


def _matrix(column: pa.Array | pd.Series, width: int) -> np.ndarray:
    """Rows as longs, shorter vectors padded with zeros."""
    if isinstance(column, pd.Series):
        column = pa.array(column, pa.list_(pa.int64()))
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy()
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products as longs; in doubles where every partial sum is a whole number they hold."""
    most = lambda m: float(np.abs(m.astype(np.float64)).max(initial=0))
    if most(a) * most(b) * max(1, a.shape[1]) < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def local_top(queries: pd.DataFrame, data: pd.DataFrame, width: int, k: int) -> pd.DataFrame:
    """Each query's k best rows of one block; more only if scores tie beyond k, then the smaller ids."""
    data = data.sort_values("vec_id", kind="stable", ignore_index=True)
    ids = data["vec_id"].to_numpy()
    scores = _products(_matrix(queries["v"], width), _matrix(data["v"], width))
    own_from, own_to = (np.searchsorted(ids, queries["vec_id"].to_numpy(), side) for side in ("left", "right"))
    rows: list[tuple[int, int, int, int]] = []
    for q, (query, key) in enumerate(zip(queries["vec_id"], queries["key"], strict=True)):
        line = scores[q]
        others = np.r_[0:own_from[q], own_to[q]:len(ids)]
        if not len(others):
            continue
        line = line[others]
        floor = np.partition(line, len(line) - k)[len(line) - k] if len(line) > k else line.min()
        best = np.flatnonzero(line >= floor)
        best = best[np.argsort(-line[best].astype(np.float64) if abs(float(floor)) < 2**52 else [-int(s) for s in line[best]], kind="stable")][:k]
        rows += [(query, key, int(ids[others[b]]), int(line[b])) for b in best]
    return pd.DataFrame(rows, columns=["query_id", "key", "vec_id", "score"])


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of each row with ``is_query``, over all other rows.

    ``vectors``: vec_id, v (array of longs); both are needed, other columns are not read. Rows with
    the query's own vec_id are not candidates; ties go to the smaller vec_id; rows repeated under
    another id each count. Vectors of unlike length are compared as if the shorter went on with
    zeros. Fewer rows than k: all of them. An empty table: no rows.
    """
    spark = vectors.sparkSession
    rows = staged(vectors.select("vec_id", "v", is_query.alias("is_query"), F.xxhash64("v").alias("key")), "vectors")
    width, count = rows.agg(F.coalesce(F.max(F.size("v")), F.lit(0)), F.count(F.lit(1))).first()
    # a bounded sample, spread by hash; it only steers the work
    sample = rows.orderBy(F.xxhash64("vec_id", F.lit("pivot")), "vec_id", "key").limit(pivots).collect()
    centres = np.zeros((len(sample), width))
    for i, r in enumerate(sample):
        centres[i, :len(r.v)] = r.v
    blocks = max(1, -(-count // BLOCK_ROWS))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() * 7919
        for batch in batches:
            x = _matrix(batch.column("v"), width).astype(np.float64)
            square = (x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)
            cell = square.argmin(1) if len(x) else np.zeros(0, int)
            distance = np.sqrt(((x - centres[cell]) ** 2).sum(1)) if len(x) else np.zeros(0)
            extra = {"cell": pa.array(cell, pa.int32()), "distance": pa.array(distance, pa.float64()),
                     "norm": pa.array(np.sqrt((x * x).sum(1)), pa.float64()),
                     "block": pa.array((row + np.arange(len(x))) % blocks, pa.int32())}
            row += len(x)
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra.values()], names=[*batch.schema.names, *extra])

    if not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    placed = staged(rows.mapInArrow(cells, "vec_id long, v array<bigint>, is_query boolean, key long, cell int, distance double,"
                                           "norm double, block int"), "cells")
    # per cell: one row of sums, and the k + 1 ids next to the pivot, each with its nearest row
    told = placed.groupBy("cell").agg(F.sum(F.col("is_query").cast("long")).alias("queries"),
                                      F.max(F.when(F.col("is_query"), F.col("distance"))).alias("radius"),
                                      F.max(F.when(F.col("is_query"), F.col("norm"))).alias("norm")).collect()
    nearest = (placed.groupBy("cell", "vec_id").agg(F.min("distance").alias("distance"))
               .withColumn("n", F.row_number().over(W.partitionBy("cell").orderBy("distance", "vec_id")))
               .filter(F.col("n") <= k + 1).collect())
    near_ids, near_id = np.unique(np.array([r.vec_id for r in nearest], np.int64), return_inverse=True)
    near_cell = np.array([r.cell for r in nearest], int)
    near = np.array([r.distance for r in nearest])

    asking = [r for r in told if r.queries]
    slack = 1e-6
    bounds = np.full((len(asking), 3), -np.inf)  # radius, norm, sure score of the k-th neighbour
    for i, r in enumerate(asking):
        p = centres[r.cell]
        # q.x >= p.c - radius |c| - |q| d(x, c) for the rows x next to pivot c; one id may be the query's own, in any number of cells
        sure = centres[near_cell] @ p - r.radius * np.linalg.norm(centres[near_cell], axis=1) - r.norm * near
        by_id = np.full(len(near_ids), -np.inf)
        np.maximum.at(by_id, near_id, sure)
        score = np.sort(by_id)[-(k + 1)] if len(by_id) > k else -np.inf
        bounds[i] = r.radius, r.norm, score - slack * (1 + abs(score)) if np.isfinite(score) else -np.inf
    parts = {r.cell: -(-r.queries // GROUP_QUERIES) for r in asking}
    group_of, group, held = {}, -1, GROUP_QUERIES
    for r in sorted(asking, key=lambda r: -r.queries):  # small cells share a group, a large one has several
        if parts[r.cell] > 1 or held + r.queries > GROUP_QUERIES:
            group, held = group + 1, 0
        group_of[r.cell] = group
        held += r.queries
        group += parts[r.cell] - 1
        held = GROUP_QUERIES if parts[r.cell] > 1 else held
    ask = np.array([r.cell for r in asking], int)

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("v"), width).astype(np.float64)
            norm = batch.column("norm").to_numpy()[:, None]
            # q.x <= p.x + radius |x| and q.x <= |q| |x|
            reach = np.minimum(x @ centres[ask].T + bounds[:, 0] * norm, bounds[:, 1] * norm)
            reach += slack * (1 + np.abs(reach))
            needed = reach >= bounds[:, 2]
            for g in sorted({(group_of[c], parts[c]) for c in ask.tolist()}):
                own = [i for i, c in enumerate(ask.tolist()) if group_of[c] == g[0]]
                rows_in = np.flatnonzero(needed[:, own].any(1))
                for part in range(g[1]):
                    taken = batch.select(["vec_id", "v", "block"]).take(pa.array(rows_in))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows_in), g[0] + part), pa.int32()), *taken.columns],
                                                     names=["group", "vec_id", "v", "block"])

    data = placed.select("vec_id", "v", "norm", "block").mapInArrow(replicate, "group int, vec_id long, v array<bigint>, block int")
    starts = F.create_map(*[F.lit(x) for c in group_of for x in (c, group_of[c])]) if group_of else F.lit(None)
    many = F.create_map(*[F.lit(x) for c in parts for x in (c, parts[c])]) if parts else F.lit(None)
    if not asking:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    queries = (placed.filter("is_query").dropDuplicates(["vec_id", "key", "v"])
               .select((starts[F.col("cell")] + F.pmod(F.xxhash64("vec_id", "key"), many[F.col("cell")].cast("long"))).cast("int").alias("group"),
                       F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "vec_id", "key", "v"))
    best = (queries.groupBy("group", "block").cogroup(data.groupBy("group", "block"))
            .applyInPandas(lambda q, d: local_top(q, d, width, k) if len(q) and len(d) else local_top(q[:0], d[:0], width, k),
                           "query_id long, key long, vec_id long, score long"))
    rank = F.row_number().over(W.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
