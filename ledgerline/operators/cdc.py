"""CDC extraction from a key-only change log plus current row images.

A run for one table:

1. the high mark ``coalesce(max(seq), 0)`` of the whole log is read *before* the source is
   planned or scanned; anything changing later is picked up by the next run (bronze is an
   append-only log and silver keeps the latest event per key, so overlap is harmless);
2. INIT (no watermark yet): every current row becomes an ``I`` event at the high mark;
3. DELTA: the log window ``(watermark, high]`` is netted per key (first op, last seq, time of
   the last seq), the current image is looked up, and each key is classified:
   row present -> ``I`` if the window began with an insert, else ``U``;
   row missing -> ``D`` (key columns only) unless the window began with an insert (created and
   deleted inside the window: nothing is sent).

Plan notes: netting is a hash aggregation with fixed-width buffers (the op travels as a small
int), so a key changed millions of times collapses map-side. The image lookup is one left join
from the netted keys to the source; Spark sizes it (a small side is broadcast, by the planner's
estimate or by adaptive execution from real sizes), so no row count of ours changes the plan. Images
kept clustered by key (``sources.images``) are read only in the key ranges that the delta touches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.formats import tabkey_decode, tabkey_encode
from ledgerline.schemas import TableSpec


def _op_code():
    return F.when(F.col("op") == "I", 0).when(F.col("op") == "U", 1).otherwise(2)


def _decode_op(code: str):
    return F.when(F.col(code) == 0, "I").when(F.col(code) == 1, "U").otherwise("D")


def high_mark(log: DataFrame) -> DataFrame:
    """One row: ``high_mark`` = highest sequence in the log, 0 for an empty log."""
    return log.agg(F.coalesce(F.max("seq"), F.lit(0)).cast("long").alias("high_mark"))


def high_mark_value(log: DataFrame) -> int:
    """The high mark as a driver value (a single aggregated row)."""
    return int(high_mark(log).first()["high_mark"])


def log_window(log: DataFrame, table: str, low: int, high: int) -> DataFrame:
    """Change-log entries of ``table`` with ``low < seq <= high`` (pushed to the scan)."""
    return log.filter((F.col("tabname") == table.upper())
                      & (F.col("seq") > F.lit(low)) & (F.col("seq") <= F.lit(high)))


def net_change(window: DataFrame) -> DataFrame:
    """Per TABKEY: first op, last seq and the log time of the last seq."""
    netted = window.groupBy("tabkey").agg(
        F.min_by(_op_code(), F.col("seq")).alias("__first_code"),
        F.max("seq").alias("last_seq"),
        F.max_by("logged_at", "seq").alias("last_logged_at"))
    return netted.select("tabkey", _decode_op("__first_code").alias("first_op"), "last_seq",
                         "last_logged_at")


def initial_events(source: DataFrame, spec: TableSpec, high: int) -> DataFrame:
    """INIT: every current row as an insert at the high mark, without change time."""
    return source.select(*spec.fields).withColumns({
        "_op": F.lit("I"),
        "_seq": F.lit(high).cast("long"),
        "_changed_at": F.lit(None).cast("timestamp_ntz"),
    })


def delta_events(netted: DataFrame, source: DataFrame, spec: TableSpec,
                 live_keys: DataFrame | None = None) -> DataFrame:
    """Classify netted keys against the current images (see module doc).

    ``live_keys`` (optional safe mode): the key columns of the keys that are live in bronze
    (e.g. ``current_state(bronze, keys).select(*keys)``). A key whose window starts with an
    insert but whose row is missing is then sent as a delete when bronze still holds it as
    live; that happens when an earlier run overlapped the window (the row was read after the
    high mark). Without it the default semantics apply: such a key is not sent.
    """
    decoded = tabkey_decode("tabkey", spec.keys)
    keyed = netted.select(*[decoded[k].alias(f"__k_{k}") for k in spec.keys],
                          "first_op", "last_seq", "last_logged_at")
    on = [F.col(k) == F.col(f"__k_{k}") for k in spec.keys]
    images = source.select(*spec.fields).withColumn("__present", F.lit(True))
    joined = keyed.join(images, on, "left")
    present, first = F.col("__present"), F.col("first_op")
    gone = first != "I"
    if live_keys is not None:
        live = live_keys.select(*[F.col(k).alias(f"__l_{k}") for k in spec.keys])
        live = live.withColumn("__live", F.lit(True)).dropDuplicates([f"__l_{k}" for k in spec.keys])
        joined = joined.join(live, [F.col(f"__l_{k}") == F.col(f"__k_{k}") for k in spec.keys],
                             "left")
        gone = gone | F.coalesce(F.col("__live"), F.lit(False))
    op = (F.when(present, F.when(first == "I", "I").otherwise("U"))
           .when(gone, "D"))
    key_cols = {k: F.coalesce(F.col(k), F.col(f"__k_{k}")).alias(k) for k in spec.keys}
    out = [key_cols[f] if f in key_cols else F.col(f) for f in spec.fields]
    return (joined.withColumn("_op", op).filter(F.col("_op").isNotNull())
                  .select(*out, "_op", F.col("last_seq").alias("_seq"),
                          F.col("last_logged_at").cast("timestamp_ntz").alias("_changed_at")))


def stamp_batch(events: DataFrame, load_type: str, batch_id: str, extracted_at) -> DataFrame:
    """Batch metadata: one load type, batch id and landing time for every row of the batch."""
    return events.withColumns({
        "_load_type": F.lit(load_type),
        "_batch_id": F.lit(batch_id),
        "_extracted_at": F.lit(extracted_at).cast("timestamp"),
    })


def batch_counts(events: DataFrame) -> DataFrame:
    """One row: inserts, updates, deletes of an event batch."""
    op = F.col("_op")
    return events.agg(
        F.count(F.when(op == "I", 1)).alias("inserts"),
        F.count(F.when(op == "U", 1)).alias("updates"),
        F.count(F.when(op == "D", 1)).alias("deletes"))


def load_mode(watermark: int | None, has_events: bool) -> str:
    """INIT without a watermark; NONE when the batch is empty (nothing written); else DELTA."""
    if not has_events:
        return "NONE"
    return "INIT" if watermark is None else "DELTA"


def encode_tabkeys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumn("tabkey", tabkey_encode(list(keys)))
