"""Append-only bronze event tables on plain Parquet, with the watermark published atomically.

Layout per table::

    <root>/<table>/_extracted_day=<date>/_watermark=<high mark>/_batch_id=<id>/part-*.parquet
    <root>/<table>/_staging/<id>/...                       (never read: '_' prefix, no '=')

A batch has one landing time, so it is exactly one leaf directory. It is written to staging
first and then moved into place with **one** directory rename: data and watermark become
visible together or not at all, and a crash before the rename leaves only invisible staging
files (the window is simply re-read next run). Rename is atomic on HDFS and POSIX file systems;
on object stores use a table format with snapshot properties instead.

The watermark is read from the directory names (a listing, no data scan). Reading bronze as of
an earlier landing time drops later batches, and with them their watermarks.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators import cdc
from ledgerline.operators.state import current_state
from ledgerline.schemas import BRONZE_META, TABLES, TableSpec

PARTITION_COLUMNS = ("_extracted_day", "_watermark", "_batch_id")


def new_batch_id(now: dt.datetime | None = None) -> str:
    now = now or dt.datetime.now(dt.UTC)
    return f"{now:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"


def read_schema(spec: TableSpec) -> T.StructType:
    meta = [f for f in BRONZE_META.fields if f.name != "_batch_id"]
    return T.StructType(list(spec.source_schema.fields) + meta + [
        T.StructField("_extracted_day", T.DateType(), True),
        T.StructField("_watermark", T.LongType(), True),
        T.StructField("_batch_id", T.StringType(), True),
    ])


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def fs_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def fs_delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def fs_rename_if_absent(spark: SparkSession, src: str, dst: str) -> bool:
    """Move ``src`` to ``dst`` unless ``dst`` exists (another run published it first)."""
    fs, s = _fs(spark, src)
    d = _path(spark, dst)
    if fs.exists(d):
        fs.delete(s, True)
        return False
    fs.mkdirs(d.getParent())
    if not fs.rename(s, d):
        raise RuntimeError(f"rename {src} -> {dst} failed")
    return True


def published_batches(spark: SparkSession, root: str, table: str) -> list[dict]:
    """Published batches of a table from the directory names: day, watermark, batch id."""
    fs, base = _fs(spark, f"{root}/{table}")
    if not fs.exists(base):
        return []
    pattern = _path(spark, f"{root}/{table}/_extracted_day=*/_watermark=*/_batch_id=*")
    statuses = fs.globStatus(pattern) or []
    out = []
    for st in statuses:
        parts = {}
        p = st.getPath()
        for _ in range(3):
            k, _, v = p.getName().partition("=")
            parts[k] = v
            p = p.getParent()
        out.append({"extracted_day": parts["_extracted_day"],
                    "watermark": int(parts["_watermark"]), "batch_id": parts["_batch_id"]})
    return out


def current_watermark(spark: SparkSession, root: str, table: str,
                      as_of_day: str | None = None) -> int | None:
    """Highest published watermark (None before the first batch); ``as_of_day`` ignores
    batches that landed after that day (a rolled-back extraction rolls its watermark back)."""
    batches = published_batches(spark, root, table)
    if as_of_day is not None:
        batches = [b for b in batches if b["extracted_day"] <= as_of_day]
    return max((b["watermark"] for b in batches), default=None)


def published_leaf(spark: SparkSession, root: str, table: str, batch_id: str) -> str | None:
    """Where a batch is published, or None: a listing of that one id, however many batches there are."""
    fs, base = _fs(spark, f"{root}/{table}")
    found = fs.globStatus(_path(spark, f"{root}/{table}/_extracted_day=*/_watermark=*/_batch_id={batch_id}"))
    return found[0].getPath().toString() if fs.exists(base) and found else None


def publish_batch(spark: SparkSession, events: DataFrame, root: str, table: str,
                  watermark: int, batch_id: str, extracted_at: dt.datetime) -> int:
    """Write one stamped event batch and publish it with a single rename. Returns its row
    count; an empty batch publishes nothing and returns 0. A batch id that is published already
    is left as it is, and its row count returned: publishing twice changes nothing."""
    day = extracted_at.astimezone(dt.UTC).date().isoformat()
    # each attempt stages in a folder of its own, so two runs of one batch cannot mix their files
    staging = f"{root}/{table}/_staging/{batch_id}-{uuid.uuid4().hex[:8]}"
    spec = TABLES[table]
    cols = [*spec.fields, *[f.name for f in BRONZE_META.fields if f.name != "_batch_id"]]
    fs, staged = _fs(spark, staging)
    done = published_leaf(spark, root, table, batch_id)
    if done:
        return spark.read.parquet(done).count()
    (events.select(*cols).sortWithinPartitions("_seq")
           .write.mode("errorifexists").option("compression", "zstd").parquet(staging))
    rows = spark.read.parquet(staging).count()  # footer metadata only
    if rows == 0:
        fs.delete(staged, True)
        return 0
    target = f"{root}/{table}/_extracted_day={day}/_watermark={watermark}/_batch_id={batch_id}"
    if not fs_rename_if_absent(spark, staging, target):
        return spark.read.parquet(target).count()  # another run of this batch was faster
    return rows


def read_bronze(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All published events of a table (partition columns included)."""
    spec = TABLES[table]
    path = f"{root}/{table}"
    fs, base = _fs(spark, path)
    if not published_batches(spark, root, table):
        return spark.createDataFrame([], read_schema(spec))
    return spark.read.schema(read_schema(spec)).option("basePath", path).parquet(path)


def batch_history(bronze: DataFrame) -> DataFrame:
    """Per load: batch id, load type, rows, landing time and day (UTC, from the partition),
    watermark (from the partition)."""
    return (bronze.groupBy("_batch_id", "_load_type")
                  .agg(F.count(F.lit(1)).alias("rows_added"),
                       F.min("_extracted_at").alias("extracted_at"),
                       F.min("_extracted_day").alias("extracted_day"),
                       F.max("_watermark").alias("watermark"))
                  .withColumnRenamed("_batch_id", "batch_id")
                  .withColumnRenamed("_load_type", "load_type"))


def roll_back(spark: SparkSession, root: str, table: str, as_of_day: str) -> int | None:
    """Remove the batches that landed after ``as_of_day`` and return the watermark that is left: the next
    extraction resumes from it and sends again what has changed since."""
    for b in published_batches(spark, root, table):
        if b["extracted_day"] > as_of_day:
            fs_delete(spark, f"{root}/{table}/_extracted_day={b['extracted_day']}/_watermark={b['watermark']}"
                             f"/_batch_id={b['batch_id']}")
    return current_watermark(spark, root, table)


def extract_table(spark: SparkSession, log: DataFrame, source: DataFrame, root: str,
                  table: str, batch_id: str | None = None,
                  extracted_at: dt.datetime | None = None, safe: bool = False,
                  high: int | None = None,
                  lookup: Callable[[DataFrame], DataFrame] | None = None) -> dict:
    """One extraction run for one table (INIT, DELTA or NONE), published atomically.

    ``safe`` also deletes keys that were created and removed inside the window but that bronze holds
    as live (an earlier run read them after its high mark). ``high``: the log's high mark, if the
    caller has read it, before any source. ``lookup`` returns, for a delta's netted keys, the part of
    the source that can hold them (``images.images_of``); without it the whole source is looked at.
    """
    spec = TABLES[table]
    watermark = current_watermark(spark, root, table)
    if high is None:
        high = cdc.high_mark_value(log)            # read before the source is scanned
    batch_id = batch_id or new_batch_id()
    extracted_at = extracted_at or dt.datetime.now(dt.UTC)
    kept = None
    load_type = cdc.load_mode(watermark, has_events=True)
    if load_type == "INIT":
        events = cdc.initial_events(source, spec, high)
    else:
        netted = cdc.net_change(cdc.log_window(log, table, watermark, high))
        if lookup:
            # read twice, for the ranges to look at and for the lookup: kept for the run
            netted = kept = netted.persist(StorageLevel.MEMORY_AND_DISK)
        live = current_state(read_bronze(spark, root, table), spec.keys).select(*spec.keys) if safe else None
        events = cdc.delta_events(netted, lookup(netted) if lookup else source, spec, live_keys=live)
    stamped = cdc.stamp_batch(events, load_type, batch_id, extracted_at)
    try:
        rows = publish_batch(spark, stamped, root, table, high, batch_id, extracted_at)
    finally:
        if kept is not None:
            kept.unpersist()
    if rows == 0:
        return {"table": table, "load_type": "NONE", "inserts": 0, "updates": 0, "deletes": 0,
                "watermark": watermark, "batch_id": None}
    published = read_bronze(spark, root, table).filter(F.col("_batch_id") == batch_id)
    counts = cdc.batch_counts(published).first()
    return {"table": table, "load_type": load_type, "inserts": counts["inserts"],
            "updates": counts["updates"], "deletes": counts["deletes"], "watermark": high,
            "batch_id": batch_id}


def extract_all(spark: SparkSession, log: DataFrame, sources: dict[str, DataFrame], root: str,
                batch_id: str | None = None, extracted_at: dt.datetime | None = None,
                parallelism: int = 1, safe: bool = False) -> list[dict]:
    """All tables in declared order under one batch id. The log's high mark is read once, before
    any source, so the runs are independent; ``parallelism > 1`` submits them as concurrent Spark
    jobs."""
    from concurrent.futures import ThreadPoolExecutor

    from ledgerline.session import release
    batch_id = batch_id or new_batch_id()
    names = [t for t in TABLES if t in sources]
    high = cdc.high_mark_value(log)

    def run(t: str) -> dict:
        done = extract_table(spark, log, sources[t], root, t, batch_id, extracted_at, safe, high)
        release(spark)
        return done

    if parallelism <= 1:
        return [run(t) for t in names]
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return list(pool.map(run, names))
