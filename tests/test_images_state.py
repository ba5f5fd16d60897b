"""Key-pruned image lookup and the state table."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import cdc, setops, state
from ledgerline.schemas import CHANGE_LOG_SCHEMA, TABLES, bronze_schema
from ledgerline.sources import bronze, images, state_table

KNA1 = TABLES["kna1"]


def customers(spark, ids):
    return ids.select(F.lit("100").alias("mandt"), F.lpad(F.col("id").cast("string"), 10, "0").alias("kunnr"),
                      F.concat(F.lit("n"), F.col("id").cast("string")).alias("name1"),
                      *[F.lit("x").alias(c) for c in KNA1.fields[3:]])


def netted(spark, rows):
    return spark.createDataFrame([(f"100{k}", op, i + 1, dt.datetime(2026, 1, 1)) for i, (k, op) in enumerate(rows)],
                                 "tabkey string, first_op string, last_seq long, last_logged_at timestamp_ntz")


@pytest.fixture(scope="module")
def stored(spark):
    from ledgerline.session import shared_dir
    path = shared_dir(spark, "images")
    source = customers(spark, spark.range(0, 20_000, 2))
    images.write_images(source, KNA1, path, ranges=100)
    return source, path


def test_delta_of_few_keys_reads_few_files(spark, stored):
    source, path = stored
    keys = [(f"{i:010d}", "U") for i in range(12_000, 12_010)]          # a tenth of a percent, every other one missing
    delta = netted(spark, keys)
    found = images.images_of(delta, KNA1, path)
    files = found.select(F.input_file_name()).distinct().count()
    every = images.read_images(spark, KNA1, path).select(F.input_file_name()).distinct().count()
    assert files <= 2 and every >= 90
    assert re.search(r"PartitionFilters: \[[^\]]*__range", found._jdf.queryExecution().executedPlan().toString())
    pruned = cdc.delta_events(delta, found, KNA1)
    assert setops.table_diff(pruned, cdc.delta_events(delta, source, KNA1)).count() == 0
    assert {r["_op"]: r["count"] for r in pruned.groupBy("_op").count().collect()} == {"U": 5, "D": 5}


def test_keys_at_bounds_below_above_and_unpadded(spark, stored):
    source, path = stored
    bounds = images.read_bounds(spark, path)
    assert [n for n, _ in bounds] == sorted(n for n, _ in bounds) and [b for _, b in bounds] == sorted(b for _, b in bounds)
    edge = [(low[3:].rstrip(), "U") for _, low in bounds] + [("", "U"), ("!", "U"), ("zzz", "I"), ("9999999999", "U")]
    delta = netted(spark, edge)
    got = cdc.delta_events(delta, images.images_of(delta, KNA1, path), KNA1)
    assert setops.table_diff(got, cdc.delta_events(delta, source, KNA1)).count() == 0
    assert got.filter("_op = 'U'").count() == len(bounds)
    # each stored row's key maps to the range it is stored in
    key = images.tabkey_encode(list(KNA1.keys))
    table = images.read_images(spark, KNA1, path)
    assert table.filter(images.range_of(key, bounds) != F.col(images.RANGE)).count() == 0


def test_empty_images_and_empty_delta(spark, stored, scratch):
    _, path = stored
    none = netted(spark, [("1", "U")]).filter("false")
    assert images.images_of(none, KNA1, path).count() == 0
    images.write_images(customers(spark, spark.range(0)), KNA1, f"{scratch}/empty", ranges=4)
    delta = netted(spark, [("0000000001", "U"), ("0000000002", "I")])
    got = cdc.delta_events(delta, images.images_of(delta, KNA1, f"{scratch}/empty"), KNA1).collect()
    assert [r["_op"] for r in got] == ["D"]
    with pytest.raises(ValueError):
        images.write_images(customers(spark, spark.range(1)), KNA1, f"{scratch}/many", ranges=images.MAX_RANGES + 1)


def test_predicates_take_each_row_once(spark):
    rows = [("100", f"{i:04d}") for i in range(300)] + [("200", "O'Neil"), ("200", ""), ("", "x"), (None, "1"), ("100", None), (None, None)]
    df = spark.createDataFrame(rows, "mandt string, kunnr string")
    cuts = images.quantile_bounds(df, KNA1, 8)
    assert 4 <= len(cuts) <= 8
    for bounds in (cuts, [], [("200", "O'Neil")], [("", "")], [*cuts, *cuts, ("zzz", "z")]):
        predicates = images.key_predicates(KNA1.keys, bounds)
        hits = df.select(*KNA1.keys, sum((F.when(F.expr(p), 1).otherwise(0) for p in predicates), F.lit(0)).alias("n"))
        assert hits.filter("n <> 1").count() == 0
    sizes = [df.filter(p).count() for p in images.key_predicates(KNA1.keys, cuts)]
    assert max(sizes) <= 120
    some = images.delta_predicates(netted(spark, [("0007", "U"), ("0008", "U")]), "kna1", cuts)
    assert len(some) == 1 and df.filter(some[0]).filter("kunnr = '0007'").count() == 1
    assert images.delta_predicates(netted(spark, [("1", "U")]).filter("false"), "kna1", cuts) == ["1 = 0"]


def test_stream_and_batch_take_a_pruned_lookup(spark, scratch, stored):
    from ledgerline.streaming.cdc_stream import start_extraction
    source, path = stored
    log = spark.createDataFrame([(i + 1, "KNA1", f"100{k:010d}", "U", dt.datetime(2026, 1, 1)) for i, k in enumerate((10, 11, 19_998))],
                                CHANGE_LOG_SCHEMA)
    log.filter("false").write.parquet(f"{scratch}/log")
    asked = []

    def lookup(keys):
        asked.append(images.images_of(keys, KNA1, path))
        return asked[-1]

    def run():
        q = start_extraction(spark, f"{scratch}/log", lambda: source, "kna1", f"{scratch}/bronze", f"{scratch}/ckpt", lookup=lookup)
        q.awaitTermination()
    run()
    log.write.mode("append").parquet(f"{scratch}/log")
    run()
    sent = bronze.read_bronze(spark, f"{scratch}/bronze", "kna1").filter("_load_type = 'DELTA'")
    assert {r["kunnr"][-5:]: r["_op"] for r in sent.collect()} == {"00010": "U", "00011": "D", "19998": "U"}
    assert len(asked) == 1 and asked[0].count() < 1000
    # the batch extractor over the same log, from the INIT alone
    at = dt.datetime(2026, 1, 5, tzinfo=dt.UTC)
    bronze.extract_table(spark, log.filter("false"), source, f"{scratch}/batch", "kna1", "i", at)
    done = bronze.extract_table(spark, log, source, f"{scratch}/batch", "kna1", "d", at, lookup=lookup)
    assert (done["inserts"], done["updates"], done["deletes"]) == (0, 2, 1) and len(asked) == 2


def events(spark, rows):
    """(number, op, seq, name) as stamped bronze events."""
    df = spark.createDataFrame(rows, "id int, _op string, _seq long, name1 string")
    base = df.select(F.lit("100").alias("mandt"), F.col("id").cast("string").alias("kunnr"), "name1",
                     *[F.lit("x").alias(c) for c in KNA1.fields[3:]], "_op", "_seq", F.lit(None).cast("timestamp_ntz").alias("_changed_at"))
    return base


def publish(spark, root, rows, batch, day):
    at = dt.datetime(2026, 1, day, 6, 0, tzinfo=dt.UTC)
    stamped = cdc.stamp_batch(events(spark, rows), "DELTA", batch, at)
    bronze.publish_batch(spark, stamped, root, "kna1", max(r[2] for r in rows), batch, at)


def differs(spark, root):
    fields = [*KNA1.fields, "_op", "_seq", "_batch_id"]
    whole = state.current_state(bronze.read_bronze(spark, root, "kna1"), KNA1.keys).select(*fields)
    return setops.table_diff(state_table.read_state(spark, root, "kna1").select(*fields), whole).count()


def test_state_follows_batches(spark, scratch):
    root = f"{scratch}/bronze"
    assert state_table.read_state(spark, root, "kna1").count() == 0
    publish(spark, root, [(i, "I", 1, "a") for i in range(50)], "b1", 5)
    assert state_table.refresh(spark, root, "kna1", buckets=4) == {"table": "kna1", "version": 1, "batches": 1, "rebuilt": False}
    assert differs(spark, root) == 0
    # a hot key, a delete, a new key, an old event that comes late, one equal in sequence but landed later
    publish(spark, root, [(1, "U", s, f"hot{s}") for s in range(2, 200)] + [(2, "D", 9, None), (77, "I", 9, "new"), (3, "U", 0, "late"), (4, "U", 1, "again")],
            "b2", 6)
    assert state_table.refresh(spark, root, "kna1")["batches"] == 1 and differs(spark, root) == 0
    # the delete holds against an older event of a later batch
    publish(spark, root, [(2, "U", 5, "zombie"), (77, "D", 10, None)], "b3", 7)
    publish(spark, root, [(77, "I", 11, "back")], "b4", 8)
    assert state_table.refresh(spark, root, "kna1")["batches"] == 2 and differs(spark, root) == 0
    names = {r["kunnr"]: r["name1"] for r in state_table.read_state(spark, root, "kna1").collect()}
    assert "2" not in names and names["1"] == "hot199" and names["3"] == "a" and names["4"] == "again" and names["77"] == "back"
    assert state_table.refresh(spark, root, "kna1")["batches"] == 0
    assert state_table.versions(spark, root, "kna1") == [2, 3]           # one version before the last stays
    # bronze readers do not see the state
    assert bronze.read_bronze(spark, root, "kna1").count() == 50 + 202 + 2 + 1
    # a rollback takes its batches out of the state too
    bronze.roll_back(spark, root, "kna1", "2026-01-06")
    assert state_table.refresh(spark, root, "kna1")["rebuilt"] and differs(spark, root) == 0


def test_old_version_is_not_shuffled(spark, scratch):
    root = f"{scratch}/bronze"
    publish(spark, root, [(i, "I", 1, "a") for i in range(500)], "b1", 5)
    state_table.refresh(spark, root, "kna1", buckets=4)
    publish(spark, root, [(1, "U", 2, "b")], "b2", 6)
    new = bronze.read_bronze(spark, root, "kna1").filter("_batch_id = 'b2'")
    old = state_table.latest_events(spark, root, "kna1")
    plan = state_table.merged(old, new, KNA1.keys, 4)._jdf.queryExecution().executedPlan().toString()
    # the old side comes first in the plan: the only exchanges are those of the new batch
    assert "SortMergeJoin" in plan and "Exchange" not in plan[:plan.index("Bucketed: true")], plan


def test_schema_of_state_is_that_of_bronze(spark, scratch):
    assert state_table.latest_events(spark, scratch, "kna1").schema == bronze.read_schema(KNA1)
    assert set(bronze_schema(KNA1).fieldNames()) <= set(bronze.read_schema(KNA1).fieldNames())
