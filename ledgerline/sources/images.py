"""Current row images clustered by key, so that a delta reads only the key ranges it needs.

An image table is Parquet below ``<path>/__range=<n>``: ``ranges`` ranges of the padded key, cut by
Spark's range exchange at the quantiles it samples, each sorted by key, so row groups have narrow
bounds; Bloom filter indexes on the key columns serve lookups of single keys. The lowest key of each
range is kept below ``<path>/_bounds``.

A lookup maps the netted keys to ranges by these bounds (an expression, no join), collects which
ranges occur (at most ``ranges`` numbers, whatever the number of keys) and reads those alone, as a
partition filter. A delta of recent documents falls into few ranges; one spread evenly over all keys
reaches them all, and then the lookup costs what it costs without bounds.

The same bounds split a database table: gapless predicates that do not overlap, one per range, for
the initial load (even parts for character keys) or, for a delta, of its ranges only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.formats import tabkey_decode, tabkey_encode
from ledgerline.schemas import TABLES, TableSpec

RANGES = 256
MAX_RANGES = 4096       # bounds are literals of a plan and pass through the driver
GROUP = 64              # bounds compared at a time: a key meets at most ranges / GROUP + GROUP of them
RANGE = "__range"


def write_images(source: DataFrame, spec: TableSpec, path: str, ranges: int = RANGES) -> None:
    """The rows of ``source`` as an image table at ``path`` (a new folder). Rows with a null in the key form the first range."""
    if not 1 <= ranges <= MAX_RANGES:
        raise ValueError(f"ranges must be 1 to {MAX_RANGES}")
    key = tabkey_encode(list(spec.keys))
    placed = (source.select(*spec.fields, key.alias("__key")).repartitionByRange(ranges, "__key")
              .withColumn(RANGE, F.spark_partition_id()).sortWithinPartitions(RANGE, "__key").drop("__key"))
    writer = placed.write.partitionBy(RANGE)
    for k in spec.keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{k}", "true")
    writer.parquet(path)
    bounds = read_images(source.sparkSession, spec, path).groupBy(RANGE).agg(F.min(key).alias("low"))
    bounds.coalesce(1).write.parquet(f"{path}/_bounds")       # one row per range


def read_images(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    """The whole image table with its range numbers."""
    return spark.read.schema(T.StructType([*spec.source_schema.fields, T.StructField(RANGE, T.IntegerType())])).parquet(path)


def read_bounds(spark: SparkSession, path: str) -> list[tuple[int, str | None]]:
    """(range, its lowest padded key) in the order of keys; a range of null keys alone has no lowest key."""
    rows = spark.read.schema(f"{RANGE} int, low string").parquet(f"{path}/_bounds").collect()
    return sorted((r[RANGE], r["low"]) for r in rows)


def range_of(key: Column, bounds: Sequence[tuple[int, str | None]]) -> Column:
    """The range in which a row with the padded ``key`` would be; null where there are no ranges.

    Keys below every bound belong to the first range, as null keys do. The bounds are compared in two
    steps, those that begin a group first.
    """
    if not bounds:
        return F.lit(None).cast("int")
    # the first range needs no bound: what is below all others is there
    lows = [low for _, low in bounds[1:]]
    if not lows:
        return F.lit(bounds[0][0])
    groups = [lows[i:i + GROUP] for i in range(0, len(lows), GROUP)]
    firsts = F.array(*[F.lit(g[0]) for g in groups])
    inner = F.array(*[F.array(*[F.lit(x) for x in g]) for g in groups])
    group = F.size(F.filter(firsts, lambda x: x <= key))
    within = F.size(F.filter(F.get(inner, group - 1), lambda x: x <= key))
    at = F.when(key.isNull() | (group == 0), 0).otherwise((group - 1) * GROUP + within)
    return F.get(F.array(*[F.lit(n) for n, _ in bounds]), at.cast("int"))


def ranges_of(netted: DataFrame, spec: TableSpec, bounds: Sequence[tuple[int, str | None]]) -> list[int]:
    """The ranges that hold a key of ``netted`` (column ``tabkey``): at most one number per range."""
    # decoded and padded again: the log may leave out blanks at a key's end
    decoded = tabkey_decode("tabkey", spec.keys)
    found = netted.select(range_of(tabkey_encode(dict(decoded)), bounds).alias("r")).distinct().collect()
    return sorted(r["r"] for r in found if r["r"] is not None)


def images_of(netted: DataFrame, spec: TableSpec, path: str) -> DataFrame:
    """The images in the ranges that hold a netted key: what ``cdc.delta_events`` needs of the source.

    Equal events as over the whole table: a key whose row is missing from its range is missing from the table.
    """
    spark = netted.sparkSession
    wanted = ranges_of(netted, spec, read_bounds(spark, path))
    return read_images(spark, spec, path).filter(F.col(RANGE).isin(wanted) if wanted else F.lit(False)).select(*spec.fields)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _below(keys: Sequence[str], values: Sequence[str], strict: bool) -> str:
    """SQL: the key columns, compared from left to right, are below ``values`` (or equal, unless strict)."""
    key, value = keys[0], _text(values[0])
    if len(keys) == 1:
        return f"{key} {'<' if strict else '<='} {value}"
    return f"({key} < {value} OR ({key} = {value} AND {_below(keys[1:], values[1:], strict)}))"


def key_predicates(keys: Sequence[str], bounds: Sequence[Sequence[str]]) -> list[str]:
    """One SQL predicate per range of rows between the sorted, distinct key tuples ``bounds``.

    Every row satisfies exactly one of them: a range begins with its bound and ends before the next,
    the first also takes what is below all bounds and rows with a null in the key. Without bounds one
    predicate takes all. Pass them to ``erp.read_jdbc``. The database must compare the columns
    as Spark does, by bytes (a binary collation).
    """
    cuts = sorted({tuple(b) for b in bounds})
    nulls = " OR ".join(f"{k} IS NULL" for k in keys)
    full = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    if not cuts:
        return ["1 = 1"]
    out = [f"({_below(keys, cuts[0], True)}) OR {nulls}"]
    for low, high in zip(cuts, [*cuts[1:], None], strict=True):
        ends = f" AND {_below(keys, high, True)}" if high else ""
        out.append(f"{full} AND NOT ({_below(keys, low, True)}){ends}")
    return out


def quantile_bounds(keys: DataFrame, spec: TableSpec, ranges: int) -> list[tuple[str, ...]]:
    """Key tuples that cut ``keys`` (the key columns of a table, or of a sample of it) into about even ranges.

    Spark's range exchange finds them; at most ``ranges`` rows come to the driver.
    """
    if not 1 <= ranges <= MAX_RANGES:
        raise ValueError(f"ranges must be 1 to {MAX_RANGES}")
    key = F.struct(*spec.keys)
    parts = keys.select(*spec.keys).dropna().repartitionByRange(ranges, *spec.keys)
    lows = parts.groupBy(F.spark_partition_id().alias("p")).agg(F.min(key).alias("low")).collect()
    return sorted(tuple(r["low"]) for r in lows)[1:]


def delta_predicates(netted: DataFrame, table: str, bounds: Sequence[Sequence[str]]) -> list[str]:
    """The predicates of ``key_predicates`` whose range holds a netted key: a delta's JDBC read leaves the others out."""
    spec = TABLES[table]
    cuts = sorted({tuple(b) for b in bounds})
    every = key_predicates(spec.keys, cuts)
    decoded = tabkey_decode("tabkey", spec.keys)
    at = F.lit(0)
    if cuts:
        starts = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in zip(spec.keys, cut, strict=True)]) for cut in cuts])
        at = F.size(F.filter(starts, lambda x: x <= F.struct(*[decoded[k].alias(k) for k in spec.keys])))
    found = netted.select(at.alias("at")).distinct().collect()          # one row per range at most
    return [every[i] for i in sorted(r["at"] for r in found)] or ["1 = 0"]
