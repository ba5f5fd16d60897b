"""Data-quality checks find planted violations and pass on clean data."""

from __future__ import annotations

import pytest

from ledgerline.operators import quality
from ledgerline.schemas import GOLD_CONTRACTS


def test_checks(spark):
    df = spark.createDataFrame([(1, "a", "X"), (1, "b", None), (2, "b", "Y"), (None, "c", "Z")],
                               "id int, k string, v string")
    assert [r["id"] for r in quality.unique(df, "id").collect()] == [1]
    assert quality.not_null(df, "v").count() == 1
    assert {r["v"]: r["occurrences"] for r in quality.accepted_values(df, "v", ["X", "Y"]).collect()} == {"Z": 1}
    parent = spark.createDataFrame([(1,), (3,)], "id int")
    assert sorted(r["id"] for r in quality.relationships(df, "id", parent, "id").collect()) == [2]
    assert [tuple(r)[:2] for r in quality.unique_combination(df, ["k"]).collect()] == [("b", 2)]
    pk = {r["violation"] for r in quality.primary_key(df, ["id"]).collect()}
    assert pk == {"null_key", "duplicate_key"}


def test_contract(spark):
    contract = GOLD_CONTRACTS["agg_daily_sales"]
    ok = spark.createDataFrame([], contract)
    assert quality.conform(ok, contract) is ok
    with pytest.raises(ValueError):
        quality.conform(ok.withColumnRenamed("sales_org", "org"), contract)
    with pytest.raises(ValueError):
        quality.conform(ok.withColumn("orders_booked", ok["orders_booked"].cast("long")), contract)


def test_csv_source_keeps_blanks(spark, scratch):
    from ledgerline.sources.erp import read_csv
    path = f"{scratch}/kna1.csv"
    import os
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/part.csv", "w") as f:
        f.write("mandt,kunnr,name1,land1,ort01,ktokd,erdat,loevm\n100,0000100001,A,PT,,0001,20260101,\n")
    row = read_csv(spark, "kna1", path).first()
    assert row["ort01"] == "" and row["loevm"] == "" and row["ktokd"] == "0001"


def test_seed_csv_declared_types(spark, scratch):
    import os
    from decimal import Decimal

    from ledgerline.seeds import read_seed_csv
    os.makedirs(f"{scratch}/seeds", exist_ok=True)
    with open(f"{scratch}/seeds/reasons.csv", "w") as f:
        f.write("rejection_reason_code,rejection_reason\n01,Delivery date too late\n03,Too expensive\n")
    with open(f"{scratch}/seeds/types.csv", "w") as f:
        f.write("billing_type,billing_type_name,is_credit_memo\nF2,Invoice,false\nG2,Credit Memo,true\n")
    with open(f"{scratch}/seeds/fx.csv", "w") as f:
        f.write("currency_code,eur_per_unit\nJPY,0.006250\n")
    reasons = read_seed_csv(spark, "sap_rejection_reasons", f"{scratch}/seeds/reasons.csv").collect()
    assert [r["rejection_reason_code"] for r in reasons] == ["01", "03"]          # stays a string
    types = {r["billing_type"]: r["is_credit_memo"]
             for r in read_seed_csv(spark, "sap_billing_types", f"{scratch}/seeds/types.csv").collect()}
    assert types == {"F2": False, "G2": True}
    fx = read_seed_csv(spark, "fx_rates_to_eur", f"{scratch}/seeds/fx.csv").first()
    assert fx["eur_per_unit"] == Decimal("0.006250")
