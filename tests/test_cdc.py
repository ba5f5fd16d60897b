"""CDC extraction: netting, classification, atomic publish, watermark, replay property."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from ledgerline.operators import cdc
from ledgerline.operators.setops import table_diff
from ledgerline.operators.state import replay
from ledgerline.schemas import CHANGE_LOG_SCHEMA, TABLES
from ledgerline.sources import bronze

KNA1 = TABLES["kna1"]
T0 = dt.datetime(2026, 2, 1, 9, 0)


def key(kunnr):
    return "100" + kunnr.ljust(10)


def log_df(spark, entries):
    rows = [(i + 1, t.upper(), k, op, T0 + dt.timedelta(minutes=i)) for i, (t, k, op) in enumerate(entries)]
    return spark.createDataFrame(rows, CHANGE_LOG_SCHEMA)


def kna1_df(spark, rows):
    return spark.createDataFrame([("100", k, n, "PT", c, "0001", "20260101", "") for k, n, c in rows],
                                 KNA1.source_schema)


def test_net_change_and_classification(spark):
    """Two updates -> one U with the current image; insert -> I; insert+delete -> nothing;
    delete -> D with the key only."""
    log = log_df(spark, [("kna1", key("0000100001"), "U"), ("kna1", key("0000100001"), "U"),
                         ("kna1", key("0000999999"), "I"), ("kna1", key("0000888888"), "I"),
                         ("kna1", key("0000888888"), "D"), ("kna1", key("0000100002"), "D"),
                         ("vbak", "1000010000001", "D")])
    source = kna1_df(spark, [("0000100001", "Old Co", "Coimbra"), ("0000999999", "New Co", "")])
    high = cdc.high_mark_value(log)
    assert high == 7
    netted = cdc.net_change(cdc.log_window(log, "kna1", 0, high))
    assert netted.count() == 4
    events = {r["kunnr"]: r for r in cdc.delta_events(netted, source, KNA1).collect()}
    assert {k: r["_op"] for k, r in events.items()} == {
        "0000100001": "U", "0000999999": "I", "0000100002": "D"}
    assert events["0000100001"]["ort01"] == "Coimbra" and events["0000100001"]["_seq"] == 2
    assert events["0000100001"]["_changed_at"] is not None
    assert events["0000100002"]["name1"] is None and events["0000100002"]["mandt"] == "100"
    counts = cdc.batch_counts(cdc.delta_events(netted, source, KNA1)).first()
    assert (counts["inserts"], counts["updates"], counts["deletes"]) == (1, 1, 1)


def test_delta_events_gather_no_keys_in_one_task(spark):
    log = log_df(spark, [("kna1", key("0000100001"), "U"), ("kna1", key("0000100002"), "D")])
    source = kna1_df(spark, [("0000100001", "A", "X")])
    netted = cdc.net_change(cdc.log_window(log, "kna1", 0, 2))
    events = cdc.delta_events(netted, source, KNA1)
    assert {r["kunnr"]: r["_op"] for r in events.collect()} == {"0000100001": "U", "0000100002": "D"}
    assert "SinglePartition" not in events._jdf.queryExecution().executedPlan().toString()


def test_extract_init_delta_none_and_watermark(spark, scratch):
    log = log_df(spark, [("kna1", key("0000100001"), "I")])
    src = kna1_df(spark, [("0000100001", "A", "X")])
    empty = log.filter(F.lit(False))
    r0 = bronze.extract_table(spark, empty, src.filter(F.lit(False)), scratch, "kna1")
    assert r0["load_type"] == "NONE" and bronze.current_watermark(spark, scratch, "kna1") is None
    r1 = bronze.extract_table(spark, log, src, scratch, "kna1")
    assert (r1["load_type"], r1["inserts"], r1["watermark"]) == ("INIT", 1, 1)
    r2 = bronze.extract_table(spark, log, src, scratch, "kna1")
    assert r2["load_type"] == "NONE"                          # re-run without changes
    log2 = log_df(spark, [("kna1", key("0000100001"), "I"), ("kna1", key("0000100001"), "U")])
    src2 = kna1_df(spark, [("0000100001", "A", "Y")])
    r3 = bronze.extract_table(spark, log2, src2, scratch, "kna1")
    assert (r3["load_type"], r3["updates"], r3["watermark"]) == ("DELTA", 1, 2)
    assert bronze.current_watermark(spark, scratch, "kna1") == 2  # published with the data
    hist = {r["load_type"]: r["watermark"] for r in
            bronze.batch_history(bronze.read_bronze(spark, scratch, "kna1")).collect()}
    assert hist == {"INIT": 1, "DELTA": 2}
    assert not any(b["batch_id"] is None for b in bronze.published_batches(spark, scratch, "kna1"))


def test_replay_equals_source_property(spark, scratch):
    """After any sequence of runs, replaying bronze gives exactly the source table."""
    rnd = random.Random(5)
    live: dict[str, tuple] = {}
    entries: list[tuple] = []
    for run in range(4):
        for _ in range(25):
            k = f"{rnd.randint(1, 15):010d}"
            if k in live and rnd.random() < 0.3:
                del live[k]
                entries.append(("kna1", key(k), "D"))
            elif k in live:
                live[k] = (k, f"n{rnd.randint(0, 9)}", "c")
                entries.append(("kna1", key(k), "U"))
            else:
                live[k] = (k, "n", "c")
                entries.append(("kna1", key(k), "I"))
        src = kna1_df(spark, list(live.values())) if live else kna1_df(spark, [("x", "x", "x")]).filter(F.lit(False))
        bronze.extract_table(spark, log_df(spark, entries), src, scratch, "kna1",
                             extracted_at=T0 + dt.timedelta(days=run))
        replayed = replay(bronze.read_bronze(spark, scratch, "kna1"), KNA1.keys, KNA1.fields)
        assert table_diff(replayed, src).count() == 0, run


def test_publish_is_invisible_until_renamed(spark, scratch):
    """A staged batch that was never published is not read and carries no watermark."""
    spec = TABLES["kna1"]
    staged = f"{scratch}/kna1/_staging/crashed"
    kna1_df(spark, [("0000100001", "A", "X")]).withColumns({
        "_op": F.lit("I"), "_seq": F.lit(9).cast("long"),
        "_changed_at": F.lit(None).cast("timestamp_ntz"), "_load_type": F.lit("INIT"),
        "_extracted_at": F.current_timestamp()}).write.parquet(staged)
    assert bronze.current_watermark(spark, scratch, "kna1") is None
    assert bronze.read_bronze(spark, scratch, "kna1").count() == 0
    assert spec.name == "kna1"


def test_safe_mode_sends_delete_for_live_phantom(spark):
    """Window I..D for a key that bronze still holds as live (an overlapping earlier run read
    it): the reference sends nothing, safe mode sends a delete."""
    log = log_df(spark, [("kna1", key("0000100009"), "I"), ("kna1", key("0000100009"), "D")])
    source = kna1_df(spark, [("0000100001", "A", "X")])
    netted = cdc.net_change(cdc.log_window(log, "kna1", 0, 2))
    assert cdc.delta_events(netted, source, KNA1).count() == 0
    live = spark.createDataFrame([("100", "0000100009"), ("100", "0000100001")], "mandt string, kunnr string")
    ev = cdc.delta_events(netted, source, KNA1, live_keys=live).collect()
    assert [(r["kunnr"], r["_op"]) for r in ev] == [("0000100009", "D")]


def test_extract_all_concurrent(spark, scratch):
    log = log_df(spark, [("kna1", key("0000100001"), "I"), ("tcurx", "JPY  ", "I")])
    sources = {"kna1": kna1_df(spark, [("0000100001", "A", "X")]),
               "tcurx": spark.createDataFrame([("JPY", "0")], TABLES["tcurx"].source_schema)}
    runs = bronze.extract_all(spark, log, sources, scratch, parallelism=2)
    assert [(r["table"], r["load_type"], r["inserts"]) for r in runs] == [("tcurx", "INIT", 1), ("kna1", "INIT", 1)]
    assert len({r["batch_id"] for r in runs}) == 1


def test_rerun_after_crash_before_publish(spark, scratch):
    """A batch whose attempt died after staging and before the rename is simply redone."""
    log = log_df(spark, [("kna1", key("0000100001"), "I")])
    src = kna1_df(spark, [("0000100001", "A", "X")])
    src.write.parquet(f"{scratch}/kna1/_staging/B1")           # the dead attempt's files
    r = bronze.extract_table(spark, log, src, scratch, "kna1", batch_id="B1")
    assert (r["load_type"], r["inserts"]) == ("INIT", 1)
    assert bronze.read_bronze(spark, scratch, "kna1").count() == 1
