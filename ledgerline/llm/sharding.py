"""Resharding by minimum-cost flow: which bytes of which old shard go to which new one.

Old shard sizes and new capacities are a small transport problem; its solution says how many bytes
stay and how many move between each pair of shards, moving the fewest. Each old shard is laid out in
one order (large documents first), the flow cuts that order into consecutive blocks, and a document
goes where the block that holds its middle byte goes. Documents at the cuts are small ones, so new
sizes are equal but for a fraction of a small document per cut.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import scratch

GROUP_BYTES = 64 << 20


def solve_transfers(old_sizes: Sequence[int], capacities: Sequence[int],
                    cost: Sequence[Sequence[int]] | None = None) -> list[tuple[int, int, int]]:
    """Minimum-cost flow of bytes from old to new shards: (old, new, bytes), bytes > 0.

    ``cost[i][j]`` is the price of one byte from i to j; by default 0 where the number stays the
    same and 1 elsewhere. Capacities must hold all bytes. Successive cheapest paths; the graph has
    a node per shard, whatever the data's size.
    """
    n, m = len(old_sizes), len(capacities)
    if sum(old_sizes) > sum(capacities):
        raise ValueError("the new shards cannot hold the old ones")
    price = cost or [[0 if i == j else 1 for j in range(m)] for i in range(n)]
    source, sink = n + m, n + m + 1
    graph: list[list[int]] = [[] for _ in range(n + m + 2)]
    to: list[int] = []
    room: list[int] = []
    fee: list[int] = []

    def edge(a: int, b: int, capacity: int, c: int) -> None:
        for x, y, r, f in ((a, b, capacity, c), (b, a, 0, -c)):
            graph[x].append(len(to))
            to.append(y), room.append(r), fee.append(f)

    for i, size in enumerate(old_sizes):
        edge(source, i, size, 0)
        for j in range(m):
            edge(i, n + j, size, price[i][j])
    for j, capacity in enumerate(capacities):
        edge(n + j, sink, capacity, 0)
    while True:
        dist: dict[int, int] = {source: 0}
        by: dict[int, int] = {}
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in graph[a]:
                if room[e] and dist[a] + fee[e] < dist.get(to[e], 1 << 62):
                    dist[to[e]], by[to[e]] = dist[a] + fee[e], e
                    queue.append(to[e])
        if sink not in dist:
            break
        path, at = [], sink
        while at != source:
            path.append(by[at])
            at = to[by[at] ^ 1]
        pushed = min(room[e] for e in path)
        for e in path:
            room[e] -= pushed
            room[e ^ 1] += pushed
    return [(i, to[e] - n, room[e ^ 1]) for i in range(n) for e in graph[i] if not e & 1 and room[e ^ 1]]


def equal_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (j < total % shards) for j in range(shards)]


def assign(docs: DataFrame, old_shard: Column, capacities: Sequence[int] | int,
           cost: Sequence[Sequence[int]] | None = None) -> DataFrame:
    """``doc_id, text, size, old_shard, shard`` and the place in the old layout (layer, part, place).

    size: UTF-8 bytes plus 1 (null text: 1). ``capacities``: bytes of each new shard, or a number of
    shards that are to be of equal size. Repeated rows are rows like any other. The old layout's
    order is (power of two of the size, descending; a hash part; doc_id; text), kept as groups of
    about GROUP_BYTES so that no window holds a whole shard: an offset per group comes from sums
    over groups, places within it from a window over the group alone.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1)
    rows = rows.withColumn("old_shard", F.coalesce(old_shard.cast("int"), F.lit(0))).withColumn("layer", F.length(F.bin("size")))
    totals = {r.old_shard: r.bytes for r in rows.groupBy("old_shard").agg(F.sum("size").alias("bytes")).collect()}
    old_sizes = [totals.get(i, 0) for i in range(max(totals, default=-1) + 1)]
    if isinstance(capacities, int):
        capacities = equal_capacities(sum(old_sizes), capacities)
    parts = max(1, -(-max(old_sizes, default=0) // GROUP_BYTES))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int"))

    group = ["old_shard", "layer", "part"]
    before = F.coalesce(F.sum("bytes").over(W.partitionBy("old_shard").orderBy(F.desc("layer"), "part")
                                            .rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = rows.groupBy(*group).agg(F.sum("size").alias("bytes")).withColumn("group_start", before).drop("bytes")

    cuts, at = [], dict.fromkeys(range(len(old_sizes)), 0)
    flows = solve_transfers(old_sizes, capacities, cost)
    for i, j, n in sorted(flows, key=lambda x: (x[0], x[0] != x[1], x[1])):  # what stays comes first
        cuts.append((i, at[i], at[i] + n, j))
        at[i] += n
    # at most one row for each pair of shards
    table = docs.sparkSession.createDataFrame(cuts, "old_shard int, low long, high long, shard int")
    blocks = table.groupBy("old_shard").agg(F.sort_array(F.collect_list(F.struct("low", "shard"))).alias("blocks"))

    order = W.partitionBy(*group).orderBy("doc_id", "text")
    placed = (rows.withColumn("place", F.row_number().over(order).cast("long"))
              .withColumn("start", F.sum("size").over(order.rowsBetween(W.unboundedPreceding, 0)) - F.col("size")))
    middle = F.col("group_start") + F.col("start") + F.expr("size div 2")
    shard = F.element_at(F.filter("blocks", lambda b: b["low"] <= middle), -1)["shard"]
    return (placed.join(starts, group).join(F.broadcast(blocks), "old_shard")
            .select("doc_id", "text", "size", "old_shard", "layer", "part", "place", shard.alias("shard")))


def rewrite(assigned: DataFrame, folder: str, keep: Sequence[int] = ()) -> None:
    """Writes the shards that the flow changes, a folder ``shard=<n>`` each; those in ``keep`` have their old files.

    Each task appends a file to the shards that its rows go to, so text is not shuffled once more.
    """
    changed = assigned.filter(~F.col("shard").isin(list(keep))) if keep else assigned
    (changed.write.option("compression", "zstd").partitionBy("shard").parquet(folder))


def unchanged_shards(assigned: DataFrame) -> list[int]:
    """Shards that neither give nor take a row: their files need no rewrite."""
    moved = assigned.filter("old_shard <> shard")
    touched = {r[0] for r in moved.select(F.explode(F.array("old_shard", "shard"))).distinct().collect()}
    return sorted({r[0] for r in assigned.select("shard").distinct().collect()} - touched)


def slots(written: DataFrame) -> DataFrame:
    """``written`` with ``slot``: a gapless number from 0 within each shard, in the layout's order.

    Rows are joined with sums over groups, so pass what is needed of a text, not the text.
    """
    group = ["shard", "old_shard", "layer", "part"]
    sums = written.groupBy(*group).agg(F.count(F.lit(1)).alias("rows"), F.min("place").alias("first"))
    order = W.partitionBy("shard").orderBy("old_shard", F.desc("layer"), "part")
    sums = sums.withColumn("slots_before", F.coalesce(F.sum("rows").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    return (written.join(sums, group).withColumn("slot", F.col("slots_before") + F.col("place") - F.col("first"))
            .drop("rows", "first", "slots_before"))


def reshard(docs: DataFrame, old_shard: Column, shards: int) -> DataFrame:
    """Documents moved from ``old_shard`` into ``shards`` shards of near equal bytes, as files; the files, read back.

    Columns: doc_id, text, size, old_shard, shard, and the place in the old layout that ``slots``
    turns into numbers. A null text is stored as null, has size 1 and counts like any row; no row is
    dropped or merged, and columns besides doc_id and text are not read. An empty table gives no rows.
    """
    folder = scratch(docs.sparkSession, "shards")
    assigned = assign(docs, old_shard, shards)
    rewrite(assigned, folder)
    schema = "doc_id long, text string, size long, old_shard int, layer int, part int, place long, shard int"
    return docs.sparkSession.read.schema(schema).parquet(folder)
