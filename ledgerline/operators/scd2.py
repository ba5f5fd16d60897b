"""SCD type 2 history from a CDC event stream, with bounded window groups.

Semantics:

1. equal events (an extraction re-run) count once; unlike images of one key and seq all stay, in the
   order of change time, op and attributes. With ``latest_image`` only that of the latest extraction does;
2. an event is a new version when ``md5(op | tracked attributes)`` differs from the previous
   event's of the same key (ordered by ``_seq``). The op is part of the hash, so the first
   update after an insert always opens a version;
3. a version is valid until the next version's change time (deletes included), then deletes
   are dropped; ``is_current`` = no next version.

Scale: a plain ``lag``/``lead`` over ``partitionBy(key)`` puts all events of a key into one task,
so one hot key (a third of the log) would be a single straggler. Here every window runs over
``(key, _seq div bucket_width)``: a group never holds more than ``bucket_width`` sequence
numbers. The neighbour across a bucket boundary comes from a per-bucket summary (one row per
key and bucket, read off the window output by a filter) windowed by key and joined back on
(key, bucket). One exchange on (key, bucket) serves the removal of equal events and both
row-level windows. The summaries are branches of the same plan with fewer columns, which Spark
shuffles for themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

NULL_KEY = "\u0000<null>"


def change_hash(op_col: str, tracked: Sequence[str], strict: bool = False):
    """md5 of ``op | tracked attributes`` (parity: an update after an insert always differs).
    ``strict`` hashes only a delete marker instead of the op, so a version opens on a real
    attribute change or a delete, not on the insert -> update transition alone."""
    op = F.col(op_col)
    marker = F.when(op == "D", F.lit("D")).otherwise(F.lit("")) if strict else op
    return F.md5(F.concat_ws("|", marker, *[F.col(c) for c in tracked]))


def _bucketed(events: DataFrame, key: str, bucket_width: int) -> DataFrame:
    return (events
            .withColumn("__k", F.coalesce(F.col(key).cast("string"), F.lit(NULL_KEY)))
            .withColumn("__b", F.expr(f"_seq div {int(bucket_width)}")))


def scd2_versions(events: DataFrame, key: str, tracked: Sequence[str],
                  time_col: str = "changed_at", op_col: str = "_op",
                  bucket_width: int = 1 << 20, strict: bool = False,
                  landed_col: str = "_extracted_at", latest_image: bool = False) -> DataFrame:
    """Events that open a version, with ``valid_from``/``valid_to`` (deletes still included).

    ``events`` needs ``key``, ``tracked``, ``op_col``, ``_seq`` and ``time_col``. With ``latest_image`` the
    greatest ``landed_col`` says which of several images of one (key, seq) holds, without that column
    the greatest image does.
    """
    cols = [key, *tracked, op_col, "_seq", time_col]
    landed = [landed_col] if latest_image and landed_col in events.columns else []
    # one exchange on (key, bucket) serves the removal of copies and both row-level windows below
    ev = _bucketed(events.select(*cols, *landed), key, bucket_width).repartition("__k", "__b")
    if latest_image:
        image = [*landed, *[c for c in cols if c != "_seq"]]
        ev = (ev.groupBy("__k", "__b", "_seq").agg(F.max(F.struct(*image)).alias("__e"))
                .select("__k", "__b", "_seq", "__e.*").select("__k", "__b", *cols))
    else:
        ev = ev.distinct()
    ev = ev.withColumn("__h", change_hash(op_col, tracked, strict))

    wb = Window.partitionBy("__k", "__b").orderBy("_seq", time_col, op_col, *tracked)
    wk = Window.partitionBy("__k").orderBy("__b")
    ev = (ev.withColumn("__prev_h", F.lag("__h").over(wb))
            .withColumn("__first", F.row_number().over(wb) == 1)
            .withColumn("__last", F.lead("_seq").over(wb).isNull()))

    # the last hash of each bucket (one row per key and bucket, taken from the window output),
    # handed to the first event of the key's next bucket
    carry_h = (ev.filter("__last").select("__k", "__b", F.col("__h").alias("__last_h"))
                 .select("__k", "__b", F.lag("__last_h").over(wk).alias("__carry_h")))
    ev = ev.drop("__last").join(carry_h, ["__k", "__b"], "left")
    prev_h = F.when(F.col("__first"), F.col("__carry_h")).otherwise(F.col("__prev_h"))
    versions = ev.filter(~F.col("__h").eqNullSafe(prev_h)).drop("__prev_h", "__first", "__carry_h")

    # next version's change time: inside the bucket by lead, across buckets from the first
    # version of the key's next non-empty bucket
    versions = (versions.withColumn("__next_t", F.lead(time_col).over(wb))
                        .withColumn("__last", F.lead("_seq").over(wb).isNull())
                        .withColumn("__vfirst", F.row_number().over(wb) == 1))
    carry_t = (versions.filter("__vfirst").select("__k", "__b", F.col(time_col).alias("__first_t"))
                       .select("__k", "__b", F.lead("__first_t").over(wk).alias("__carry_t")))
    versions = versions.join(carry_t, ["__k", "__b"], "left")
    valid_to = F.when(F.col("__last"), F.col("__carry_t")).otherwise(F.col("__next_t"))
    return versions.select(*cols, F.col(time_col).alias("valid_from"), valid_to.alias("valid_to"))


def scd2_history(events: DataFrame, key: str, tracked: Sequence[str],
                 time_col: str = "changed_at", op_col: str = "_op",
                 bucket_width: int = 1 << 20, strict: bool = False,
                 landed_col: str = "_extracted_at", latest_image: bool = False) -> DataFrame:
    """One row per version of a key: ``version_key``, key, tracked attributes, validity."""
    v = scd2_versions(events, key, tracked, time_col, op_col, bucket_width, strict, landed_col, latest_image)
    return v.filter(F.col(op_col) != "D").select(
        F.md5(F.concat(F.col(key), F.lit("|"), F.col("_seq").cast("string"))).alias("version_key"),
        key, *tracked, "valid_from", "valid_to",
        F.col("valid_to").isNull().alias("is_current"))

