"""The command line drives the library end to end: extract twice, history, build."""

from __future__ import annotations

import datetime as dt

from test_cdc import key, kna1_df, log_df

from ledgerline.__main__ import run


def test_cli_extract_history_build(spark, scratch):
    log_path, src_path = f"{scratch}/log", f"{scratch}/kna1"
    log_df(spark, [("kna1", key("0000100001"), "I")]).write.parquet(log_path)
    kna1_df(spark, [("0000100001", "A", "X")]).write.parquet(src_path)
    first = run(["extract", "--bronze", f"{scratch}/bronze", "--log", log_path,
                 "--source", f"KNA1={src_path}"], spark)
    assert [(r["table"], r["load_type"]) for r in first["runs"]] == [("kna1", "INIT")]
    again = run(["extract", "--bronze", f"{scratch}/bronze", "--log", log_path,
                 "--source", f"kna1={src_path}:parquet"], spark)
    assert again["runs"][0]["load_type"] == "NONE"
    hist = run(["history", "--bronze", f"{scratch}/bronze", "--table", "kna1"], spark)
    assert [(b["load_type"], b["rows_added"], b["watermark"]) for b in hist["batches"]] == [("INIT", 1, 1)]
    assert hist["batches"][0]["extracted_day"] == str(dt.datetime.now(dt.UTC).date())


def test_cli_extract_all_tables_then_build(spark, scratch):
    """Real extraction (INIT of all ten source tables) feeding the daily build."""
    from conftest import SF0001
    from ledgerline.schemas import GOLD_CONTRACTS, TABLES, CHANGE_LOG_SCHEMA
    from ledgerline.sources.fixtures import fixture

    memo: dict = {}
    names = {"tcurx": "fx_tcurx", "kna1": "fx_kna1", "mara": "fx_mara", "makt": "fx_makt",
             "vbak": "fx_vbak", "vbap": "fx_vbap", "likp": "fx_likp", "lips": "fx_lips",
             "vbrk": "fx_vbrk", "vbrp": "fx_vbrp"}
    args = []
    for table, fx in names.items():
        path = f"{scratch}/src/{table}"
        fixture(spark, SF0001, fx, memo).select(*TABLES[table].fields).write.parquet(path)
        args += ["--source", f"{table}={path}"]
    log_path = f"{scratch}/log"
    spark.createDataFrame([], CHANGE_LOG_SCHEMA).write.parquet(log_path)
    runs = run(["extract", "--bronze", f"{scratch}/bronze", "--log", log_path,
                "--parallelism", "4", *args], spark)["runs"]
    assert [r["table"] for r in runs] == list(TABLES) and {r["load_type"] for r in runs} == {"INIT"}
    result = run(["build", "--bronze", f"{scratch}/bronze", "--gold", f"{scratch}/gold"], spark)
    for name, path in result["tables"].items():
        assert spark.read.parquet(path).schema.simpleString() == GOLD_CONTRACTS[name].simpleString()
    items = spark.read.parquet(result["tables"]["fct_sales_order_items"]).count()
    assert items == memo["fx_vbap"].count()            # every item has its (undeleted) order
    assert result["checks"]["fct_order_fulfillment.accepted.fulfillment_status"] == 0
