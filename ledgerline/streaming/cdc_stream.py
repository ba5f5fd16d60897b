"""CDC extraction as Structured Streaming micro-batches.

The change log arrives as files (one folder per table feed, any number of files). A file stream
with a checkpoint tracks which files were consumed, so the stream resumes where it stopped and a
re-run over the same files is a no-op. Each micro-batch is one extraction window:

* ``foreachBatch`` nets the batch's log entries per key, looks up the current images in the
  source, classifies I/U/D and publishes the batch to bronze with one rename;
* the batch id is the stream's own id, kept in its checkpoint folder, and the epoch: an epoch that
  is replayed after a failure finds its batch published and adds nothing (at-least-once delivery
  becomes exactly-once in bronze), while another stream, or one that lost its checkpoint, has ids
  of its own and never passes for it;
* a table without a watermark is initialised first, from its current rows at the log's high mark;
  entries up to that mark are in those rows and are not sent again;
* the bronze watermark of a micro-batch is the highest sequence number it consumed.

Late or re-delivered change-log entries need no event-time watermark: state is resolved by
sequence number downstream (current state and SCD2 both order by ``_seq`` and de-duplicate).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.operators import cdc
from ledgerline.operators.state import current_state
from ledgerline.schemas import CHANGE_LOG_SCHEMA, TABLES
from ledgerline.sources import bronze


def read_change_log(spark: SparkSession, log_dir: str, max_files_per_trigger: int | None = None
                    ) -> DataFrame:
    """The change-log feed as a streaming DataFrame (declared schema, no inference)."""
    reader = spark.readStream.schema(CHANGE_LOG_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(log_dir)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream with this checkpoint folder; made when the stream first starts."""
    folder = f"{checkpoint}/stream-id"
    fs, path = bronze._fs(spark, folder)
    if not fs.exists(path):
        # the id is a folder name, and the rename that publishes it happens once
        staging = f"{checkpoint}/stream-id-{uuid.uuid4().hex[:12]}"
        fs.mkdirs(bronze._path(spark, f"{staging}/{uuid.uuid4().hex[:12]}"))
        bronze.fs_rename_if_absent(spark, staging, folder)
    return fs.listStatus(path)[0].getPath().getName()


def initialise(spark: SparkSession, log_dir: str, source: Callable[[], DataFrame], table: str,
               bronze_root: str, batch_id: str, clock: Callable[[], dt.datetime]) -> int:
    """INIT of a table without a watermark; returns the mark up to which the log is in its first batch.

    The log's high mark is read before the source. Where the table was initialised before, by a
    batch run or another stream, its lowest watermark is that mark.
    """
    done = bronze.published_batches(spark, bronze_root, table)
    if done:
        return min(b["watermark"] for b in done)
    high = cdc.high_mark_value(spark.read.schema(CHANGE_LOG_SCHEMA).parquet(log_dir))
    now = clock()
    events = cdc.stamp_batch(cdc.initial_events(source(), TABLES[table], high), "INIT", batch_id, now)
    # an empty source publishes nothing: the whole log is then sent
    return high if bronze.publish_batch(spark, events, bronze_root, table, high, batch_id, now) else 0


def extraction_batch(spark: SparkSession, source: Callable[[], DataFrame], table: str,
                     bronze_root: str, stream: str, after: int = 0,
                     clock: Callable[[], dt.datetime] | None = None, safe: bool = False,
                     lookup: Callable[[DataFrame], DataFrame] | None = None):
    """The ``foreachBatch`` function: one micro-batch = one DELTA extraction window over the log
    entries above ``after``. ``lookup`` returns the part of the source that can hold a micro-batch's
    netted keys, instead of all of it."""
    spec = TABLES[table]
    clock = clock or (lambda: dt.datetime.now(dt.UTC))

    def run(batch: DataFrame, epoch_id: int) -> None:
        batch_id = f"stream-{stream}-{epoch_id:08d}"
        if bronze.published_leaf(spark, bronze_root, table, batch_id):
            return                                            # replayed epoch: already published
        # the micro-batch is read several times (high mark, netting, lookup): read it once
        window = batch.filter((F.col("tabname") == table.upper()) & (F.col("seq") > after)).persist(
            StorageLevel.MEMORY_AND_DISK)
        try:
            high = window.agg(F.max("seq").alias("h")).first()["h"]
            if high is None:
                return
            netted = cdc.net_change(window)
            live = (current_state(bronze.read_bronze(spark, bronze_root, table), spec.keys).select(*spec.keys)
                    if safe else None)
            events = cdc.delta_events(netted, lookup(netted) if lookup else source(), spec, live_keys=live)
            extracted_at = clock()
            stamped = cdc.stamp_batch(events, "DELTA", batch_id, extracted_at)
            bronze.publish_batch(spark, stamped, bronze_root, table, int(high), batch_id,
                                 extracted_at)
        finally:
            window.unpersist()

    return run


def start_extraction(spark: SparkSession, log_dir: str, source: Callable[[], DataFrame],
                     table: str, bronze_root: str, checkpoint: str, available_now: bool = True,
                     processing_time: str | None = None,
                     clock: Callable[[], dt.datetime] | None = None, safe: bool = False,
                     max_files_per_trigger: int | None = None,
                     lookup: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Start the streaming extraction of ``table``, after its INIT if it has no watermark.
    ``source`` returns the current image table when called (re-read per micro-batch)."""
    stream = stream_id(spark, checkpoint)
    now = clock or (lambda: dt.datetime.now(dt.UTC))
    after = initialise(spark, log_dir, source, table, bronze_root, f"stream-{stream}-init", now)
    writer = (read_change_log(spark, log_dir, max_files_per_trigger).writeStream
              .foreachBatch(extraction_batch(spark, source, table, bronze_root, stream, after, now, safe, lookup))
              .option("checkpointLocation", f"{checkpoint}/spark"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def start_append(spark: SparkSession, events_dir: str, schema, sink_dir: str, checkpoint: str,
                 partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    """Plain incremental append of arriving event files into a Parquet sink (file sink with a
    checkpoint: exactly-once, resumable, a re-run with no new files writes nothing)."""
    stream = spark.readStream.schema(schema).parquet(events_dir)
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(availableNow=True).start(sink_dir)


def start_deduplicated_append(spark: SparkSession, log_dir: str, sink_dir: str, checkpoint: str, within: str = "7 days",
                              max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Append of the arriving change log, entries that are delivered again left out.

    An entry is its table, key and sequence number; the first delivery stays. Spark's state holds what
    arrived during the last ``within`` and drops older keys, so it is bounded by the arrivals of that
    time, however long the stream runs. The watermark is on the time of arrival (of the micro-batch),
    not on ``logged_at``: no entry is ever late, so none is lost, and one delivered again after more
    than ``within`` passes (current state and history resolve it by its sequence number).
    """
    arrived = read_change_log(spark, log_dir, max_files_per_trigger).withColumn("__arrived", F.current_timestamp())
    once = (arrived.withWatermark("__arrived", within)
            .dropDuplicatesWithinWatermark(["tabname", "tabkey", "seq"]).drop("__arrived"))
    return (once.writeStream.format("parquet").option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start(sink_dir))
