"""Streaming extraction: resumable, re-runs are no-ops, replay still equals the source."""

from __future__ import annotations

import datetime as dt

from test_cdc import key, kna1_df, log_df

from ledgerline.operators.setops import table_diff
from ledgerline.operators.state import replay
from ledgerline.schemas import CHANGE_LOG_SCHEMA, TABLES
from ledgerline.sources import bronze
from ledgerline.streaming.cdc_stream import start_append, start_extraction

KNA1 = TABLES["kna1"]


def test_stream_extraction_resumes(spark, scratch):
    log_dir, root, ckpt = f"{scratch}/log", f"{scratch}/bronze", f"{scratch}/ckpt"
    first = [("kna1", key("0000000001"), "I"), ("kna1", key("0000000002"), "I")]
    log_df(spark, first).write.parquet(f"{log_dir}/part=1")
    state = {"src": kna1_df(spark, [("0000000001", "a", "x"), ("0000000002", "b", "y")])}

    def run():
        q = start_extraction(spark, log_dir, lambda: state["src"], "kna1", root, ckpt)
        q.awaitTermination()
        assert q.exception() is None

    run()
    assert bronze.current_watermark(spark, root, "kna1") == 2
    run()                                                     # nothing new: no new batch
    assert len(bronze.published_batches(spark, root, "kna1")) == 1

    # the next file continues the sequence: update one key, delete the other
    more = log_df(spark, first + [("kna1", key("0000000001"), "U"), ("kna1", key("0000000002"), "D")])
    more.filter("seq > 2").write.parquet(f"{log_dir}/part=2")
    state["src"] = kna1_df(spark, [("0000000001", "a2", "x")])
    run()
    assert bronze.current_watermark(spark, root, "kna1") == 4
    replayed = replay(bronze.read_bronze(spark, root, "kna1"), KNA1.keys, KNA1.fields)
    assert table_diff(replayed, state["src"]).count() == 0


def test_stream_append_is_exactly_once(spark, scratch):
    src, sink, ckpt = f"{scratch}/in", f"{scratch}/out", f"{scratch}/ckpt2"
    df = log_df(spark, [("kna1", key(str(i)), "I") for i in range(50)])
    df.write.parquet(f"{src}/part=a")
    for _ in range(2):
        q = start_append(spark, src, df.schema, sink, ckpt)
        q.awaitTermination()
    assert spark.read.parquet(sink).count() == 50
    df.write.parquet(f"{src}/part=b")
    q = start_append(spark, src, df.schema, sink, ckpt)
    q.awaitTermination()
    assert spark.read.parquet(sink).count() == 100
    assert dt.date.today()


def _extract(spark, log_dir, source, root, ckpt, **kw):
    q = start_extraction(spark, log_dir, lambda: source, "kna1", root, ckpt, **kw)
    q.awaitTermination()
    assert q.exception() is None


def test_two_streams_into_one_root_lose_nothing(spark, scratch):
    root = f"{scratch}/bronze"
    source = kna1_df(spark, [("0000000001", "a", "x"), ("0000000002", "b", "y"), ("0000000003", "c", "z")])
    bronze.extract_table(spark, log_df(spark, []), kna1_df(spark, [("0000000009", "old", "x")]), root, "kna1")
    log = log_df(spark, [("kna1", key("0000000001"), "I"), ("kna1", key("0000000002"), "I"), ("kna1", key("0000000003"), "I")])
    log.filter("seq < 3").write.parquet(f"{scratch}/a")
    log.filter("seq = 3").write.parquet(f"{scratch}/b")
    _extract(spark, f"{scratch}/a", source, root, f"{scratch}/ckpt-a")
    _extract(spark, f"{scratch}/b", source, root, f"{scratch}/ckpt-b")
    _extract(spark, f"{scratch}/a", source, root, f"{scratch}/ckpt-a")
    events = bronze.read_bronze(spark, root, "kna1").filter("_load_type = 'DELTA'")
    assert sorted(r["_seq"] for r in events.collect()) == [1, 2, 3]


def test_a_lost_checkpoint_sends_again_and_drops_nothing(spark, scratch):
    root = f"{scratch}/bronze"
    log_df(spark, []).write.parquet(f"{scratch}/log")
    _extract(spark, f"{scratch}/log", kna1_df(spark, [("0000000001", "a", "x")]), root, f"{scratch}/one")
    log_df(spark, [("kna1", key("0000000001"), "U")]).write.mode("append").parquet(f"{scratch}/log")
    source = kna1_df(spark, [("0000000001", "b", "x")])
    _extract(spark, f"{scratch}/log", source, root, f"{scratch}/two")
    replayed = replay(bronze.read_bronze(spark, root, "kna1"), KNA1.keys, KNA1.fields)
    assert table_diff(replayed, source).count() == 0


def test_entries_delivered_again_count_once_and_state_is_bounded(spark, scratch):
    import time

    from ledgerline.streaming.cdc_stream import start_deduplicated_append

    def deliver(seqs, within):
        rows = [(s, "KNA1", f"100{s % 7:010d}", "U", dt.datetime(2026, 1, 1 + s % 20)) for s in seqs]
        spark.createDataFrame(rows, CHANGE_LOG_SCHEMA).write.mode("append").parquet(f"{scratch}/{within}/in")
        q = start_deduplicated_append(spark, f"{scratch}/{within}/in", f"{scratch}/{within}/out", f"{scratch}/{within}/ckpt", within)
        q.awaitTermination()
        assert q.exception() is None
        progress = q.recentProgress
        return progress[-1]["stateOperators"][0]["numRowsTotal"] if progress else None

    def sent(within):
        return sorted(r["seq"] for r in spark.read.parquet(f"{scratch}/{within}/out").collect())

    # an entry logged long before the others is not late; a key's other entries are no repeats
    deliver([5, 6, 7, 7, 19], "1 day")
    deliver([5, 6, 8, 1], "1 day")
    assert deliver([8, 19, 20], "1 day") == len(sent("1 day")) == 7
    assert sent("1 day") == [1, 5, 6, 7, 8, 19, 20]
    sizes = []
    for k in range(4):
        sizes.append(deliver(range(100 * k, 100 * k + 100), "1 second"))
        time.sleep(2)
    assert sizes[-1] < 400 and sent("1 second") == list(range(400))
