"""Publishing is safe: batches once, tables without a gap, constraints before publish, sessions as given."""

from __future__ import annotations

import datetime as dt
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F
from test_cdc import key, kna1_df, log_df

from ledgerline import __main__ as cli
from ledgerline.operators import cdc
from ledgerline.operators.setops import table_diff
from ledgerline.operators.state import replay
from ledgerline.plans import build, catalog
from ledgerline.schemas import CHANGE_LOG_SCHEMA, TABLES
from ledgerline.session import checkpoint_root
from ledgerline.sources import bronze, fixtures

KNA1 = TABLES["kna1"]
NOW = dt.datetime(2026, 3, 1, 6, tzinfo=dt.UTC)


def test_a_batch_published_twice_reads_back_once(spark, scratch):
    events = cdc.stamp_batch(cdc.initial_events(kna1_df(spark, [("1", "a", "x"), ("2", "b", "y")]), KNA1, 5), "INIT", "B1", NOW)
    assert [bronze.publish_batch(spark, events, scratch, "kna1", 5, "B1", NOW) for _ in range(2)] == [2, 2]
    assert bronze.read_bronze(spark, scratch, "kna1").count() == 2
    # an attempt that finds the batch in place at its last step leaves it alone, too
    late = f"{scratch}/kna1/_staging/late"
    events.drop("_batch_id").write.parquet(late)
    assert not bronze.fs_rename_if_absent(spark, late, bronze.published_leaf(spark, scratch, "kna1", "B1"))
    assert bronze.read_bronze(spark, scratch, "kna1").count() == 2


def test_extraction_resumes_from_a_rolled_back_point(spark, scratch):
    one = kna1_df(spark, [("0000000001", "a", "x")])
    two = kna1_df(spark, [("0000000001", "b", "x"), ("0000000002", "n", "y")])
    log = log_df(spark, [("kna1", key("0000000001"), "U"), ("kna1", key("0000000002"), "I")])
    bronze.extract_table(spark, log.limit(0), one, scratch, "kna1", "B0", NOW)
    bronze.extract_table(spark, log, two, scratch, "kna1", "B1", NOW + dt.timedelta(days=1))
    assert bronze.roll_back(spark, scratch, "kna1", "2026-03-01") == 0
    assert bronze.read_bronze(spark, scratch, "kna1").count() == 1
    assert bronze.extract_table(spark, log, two, scratch, "kna1", "B2", NOW + dt.timedelta(days=2))["load_type"] == "DELTA"
    assert table_diff(replay(bronze.read_bronze(spark, scratch, "kna1"), KNA1.keys, KNA1.fields), two).count() == 0


def test_safe_mode_in_the_extractor(spark, scratch):
    """A key that INIT read after its high mark, then created and removed in the log."""
    bronze.extract_table(spark, log_df(spark, []), kna1_df(spark, [("0000000001", "a", "x"), ("0000000007", "late", "x")]), scratch, "kna1", "B0", NOW)
    log = log_df(spark, [("kna1", key("0000000007"), "I"), ("kna1", key("0000000007"), "D"), ("kna1", key("0000000001"), "U")])
    left = kna1_df(spark, [("0000000001", "b", "x")])
    bronze.extract_table(spark, log, left, scratch, "kna1", "B1", NOW, safe=True)
    assert table_diff(replay(bronze.read_bronze(spark, scratch, "kna1"), KNA1.keys, KNA1.fields), left).count() == 0


def test_a_broken_constraint_keeps_the_old_table(spark, scratch):
    path = f"{scratch}/t"
    build.write_table(spark.createDataFrame([(1, "a")], "k int, v string"), path, ("k",), ("v",))
    for rows in ([(1, "a"), (1, "b")], [(None, "a")], [(2, None)]):
        with pytest.raises(build.ConstraintViolated):
            build.write_table(spark.createDataFrame(rows, "k int, v string"), path, ("k",), ("v",))
        assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(1, "a")]
    build.write_table(spark.createDataFrame([(2, "b")], "k int, v string"), path, ("k",), ("v",))
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(2, "b")]
    names = {st.getPath().getName() for st in bronze._fs(spark, scratch)[0].listStatus(bronze._path(spark, scratch))}
    assert names == {"t"}


def test_findings_end_the_command_with_one(monkeypatch, capsys):
    for ok, code in ((True, 0), (False, 1)):
        monkeypatch.setattr(cli, "run", lambda argv, ok=ok: {"ok": ok})
        assert cli.main() == code
    monkeypatch.setattr(cli, "run", lambda argv: {"batches": []})
    assert cli.main() == 0
    capsys.readouterr()


def test_the_scenario_of_all_tables_is_not_empty(spark, scratch):
    moments = fixtures.change_scenario(spark, "/root/testdata/sf0.001", scratch)
    final, log = moments[2]
    ops = {(r["tabname"], r["op"]) for r in log.groupBy("tabname", "op").count().collect()}
    assert {(t.upper(), op) for t in TABLES if t != "tcurx" for op in "IUD"} <= ops
    assert all(moments[0][0][t].count() != 0 and table_diff(moments[0][0][t], final[t]).count() for t in ("vbak", "vbap", "kna1"))
    assert catalog.QUERIES["replay_equals_source"]


def test_the_launchers_master_stays():
    code = "from ledgerline.session import get_session\nprint('MASTER', get_session().sparkContext.master)"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--master local[2] pyspark-shell", "PYTHONPATH": root}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=240).stdout
    assert "MASTER local[2]" in out


def test_a_session_without_a_shared_folder_is_refused(spark):
    class Without:
        class conf:  # noqa: N801
            @staticmethod
            def get(key, default=None):
                return None

        class sparkContext:  # noqa: N801
            @staticmethod
            def getCheckpointDir():
                return None

    with pytest.raises(RuntimeError):
        checkpoint_root(Without)


def test_scenario_derives_the_sources_once(spark, scratch):
    """Each moment of a table is one read of its stored derivation, whatever the derivation joins."""
    moments = fixtures.change_scenario(spark, "/root/testdata/sf0.001", scratch)
    for sources, _ in moments:
        for table in TABLES:
            plan = sources[table]._jdf.queryExecution().executedPlan().toString()
            assert plan.count("FileScan parquet") == 1, table
            assert "Join" not in plan and "Window" not in plan and "Exchange" not in plan, table


def test_delta_without_lookup_keeps_nothing_in_memory(spark, scratch, monkeypatch):
    """The netted keys are read once, so they are not cached; with a lookup they are read twice and are."""
    kept = []
    monkeypatch.setattr(type(spark.range(1)), "persist", lambda self, *a: kept.append(1) or self)
    monkeypatch.setattr(type(spark.range(1)), "unpersist", lambda self, *a: self)
    rows = [("100", "0000000001", *[""] * (len(TABLES["kna1"].fields) - 2))]
    source = spark.createDataFrame(rows, TABLES["kna1"].source_schema)
    log = spark.createDataFrame([(5, "KNA1", "100" + "0000000001", "U", dt.datetime(2026, 1, 5))], CHANGE_LOG_SCHEMA)
    at = dt.datetime(2026, 1, 6, tzinfo=dt.UTC)
    bronze.extract_table(spark, log.limit(0), source, scratch, "kna1", "a", at)
    for lookup, batch, count in ((None, "b", 0), (lambda netted: source, "c", 1)):
        log = log.withColumn("seq", F.col("seq") + 1)
        run = bronze.extract_table(spark, log, source, scratch, "kna1", batch, at, lookup=lookup)
        assert run["updates"] == 1 and len(kept) == count


def small_tables(spark, folder):
    """Customers, suppliers, parts, orders, items and events of a few rows each."""
    t = "timestamp'2024-01-0{}'".format
    for name, n, columns in (
            ("customer", 6, ["id as c_custkey", "concat('C', id) as c_name", "cast(id as int) as c_nationkey", "1.0D as c_acctbal", "'M' as c_mktsegment"]),
            ("supplier", 3, ["id as s_suppkey", "'S' as s_name", "0 as s_nationkey", "1.0D as s_acctbal"]),
            ("part", 9, ["id as p_partkey", "'p' as p_name", "'b' as p_brand", "'t' as p_type", "cast(id as int) as p_size", "1.0D as p_retailprice"]),
            ("orders", 12, ["id as o_orderkey", "id % 6 as o_custkey", "element_at(array('O', 'P', 'F'), cast(id % 3 + 1 as int)) as o_orderstatus",
                            "10.0D as o_totalprice", f"{t(1)} as o_orderdate", "'1-URGENT' as o_orderpriority"]),
            ("lineitem", 36, ["id div 3 as l_orderkey", "id % 9 as l_partkey", "id % 3 as l_suppkey", "cast(id % 3 as int) as l_linenumber", "2.0D as l_quantity",
                              "5.0D as l_extendedprice", "0.0D as l_discount", "0.0D as l_tax", "'N' as l_returnflag", "'O' as l_linestatus", f"{t(2)} as l_shipdate"]),
            ("events", 8, ["id as event_id", f"cast({t(3)} as timestamp_ntz) as ts", "id % 4 as user_id", "'update' as event_type", "1.0D as value", "'' as props"])):
        spark.range(n).selectExpr(*columns).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_replays_hold_the_shuffles_of_one_table_at_a_time(spark, scratch):
    sf_dir = small_tables(spark, scratch)
    for name in ("replay_equals_source", "replay_state_equals_source"):
        found = catalog.QUERIES[name](spark, sf_dir)
        assert exchanges(found) == 0 and found.count() == 0
    images, wrong = {t: spark.createDataFrame([], s.source_schema) for t, s in TABLES.items()}, spark.createDataFrame([("EUR", "2"), ("X", None)], TABLES["tcurx"].source_schema)
    found = catalog._differences(spark, lambda t: wrong if t == "tcurx" else images[t], images)
    assert sorted(map(tuple, found.collect())) == [("tcurx", "EUR|2", "left_only"), ("tcurx", "X|<null>", "left_only")]


def test_order_fulfillment_joins_stored_parts(spark, scratch):
    from ledgerline.plans.lakehouse import Lakehouse
    sf_dir = small_tables(spark, scratch)
    found = catalog.QUERIES["fct_order_fulfillment"](spark, sf_dir)
    assert "Window" not in found._jdf.queryExecution().executedPlan().toString()
    want = Lakehouse.from_fixtures(spark, sf_dir).model("fct_order_fulfillment")
    assert found.schema == want.schema and found.count() > 20 and table_diff(found, want).count() == 0


def test_buckets_are_counted_by_size(spark, scratch, monkeypatch):
    from ledgerline.sources import state_table
    log = log_df(spark, [])
    bronze.extract_table(spark, log, kna1_df(spark, [(f"{i:010d}", "a", "x") for i in range(50)]), scratch, "kna1", "B0", NOW)
    assert state_table.buckets_by_size(spark, scratch, "kna1") == 8
    monkeypatch.setattr(state_table, "BUCKET_BYTES", 100)
    n = state_table.buckets_by_size(spark, scratch, "kna1")
    state_table.refresh(spark, scratch, "kna1", buckets=None)
    assert n > 8 and state_table.latest_events(spark, scratch, "kna1").count() == 50
    assert state_table._buckets(spark, f"{state_table._folder(scratch, 'kna1')}/version=1") == n
