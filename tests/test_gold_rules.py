"""Golden business rules on a tiny hand-built lakehouse (independent of the oracle SQL)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from ledgerline.plans import worklists
from ledgerline.plans.lakehouse import Lakehouse
from ledgerline.schemas import TABLES, bronze_schema

LANDED = dt.datetime(2026, 3, 1, 6, 0)


def bz(spark, table, rows):
    spec = TABLES[table]
    data = []
    for r in rows:
        op, seq = r.pop("_op", "I"), r.pop("_seq", 1)
        vals = [r.get(f, None if op == "D" and f not in spec.keys else
                      ("100" if f == "mandt" else "")) for f in spec.fields]
        data.append((*vals, op, seq, None, "INIT", "t", LANDED))
    return spark.createDataFrame(data, bronze_schema(spec))


@pytest.fixture(scope="module")
def lh(spark):
    order = dict(erdat="20260102", erzet="080000", auart="TA", vkorg="1000", kunnr="0000100001",
                 waerk="EUR", aedat="00000000", gbstk="C")
    t = {
        "tcurx": [dict(currkey="JPY", currdec="0")],
        "vbak": [dict(vbeln="0010000001", netwr="100.00", **order),
                 dict(vbeln="0010000002", netwr="0.00", **{**order, "gbstk": "C"}),
                 dict(vbeln="0010000003", netwr="50.00", **{**order, "gbstk": "A"}),
                 dict(vbeln="0010000004", netwr="9.00", **order),
                 dict(vbeln="0010000004", _op="D", _seq=2)],
        "vbap": [dict(vbeln="0010000001", posnr="000010", matnr="M1", kwmeng="2.000", vrkme="ST",
                      netwr="100.00", waerk="EUR", abgru="", erdat="20260102", aedat="00000000"),
                 dict(vbeln="0010000002", posnr="000010", matnr="M1", kwmeng="1.000", vrkme="ST",
                      netwr="30.00", waerk="EUR", abgru="01", erdat="20260102", aedat="00000000"),
                 dict(vbeln="0010000003", posnr="000010", matnr="M1", kwmeng="1.000", vrkme="ST",
                      netwr="50.00", waerk="EUR", abgru="", erdat="20260102", aedat="00000000")],
        "likp": [dict(vbeln="0080000001", erdat="20260103", kunnr="0000100001", wadat_ist="20260101",
                      aedat="00000000")],
        "lips": [dict(vbeln="0080000001", posnr="000010", vgbel="0010000001", vgpos="000010",
                      matnr="M1", lfimg="2.000", vrkme="ST")],
        "vbrk": [dict(vbeln="0090000001", fkart="F2", fkdat="20260105", kunrg="0000100001",
                      netwr="100.00", waerk="EUR", fksto=""),
                 dict(vbeln="0090000002", fkart="F2", fkdat="20260105", kunrg="0000100001",
                      netwr="9.00", waerk="EUR", fksto="")],
        "vbrp": [dict(vbeln="0090000001", posnr="000010", vgbel="0080000001", vgpos="000010",
                      aubel="0010000001", aupos="000010", matnr="M1", fkimg="2.000", netwr="100.00"),
                 dict(vbeln="0090000002", posnr="000010", vgbel="0080000009", vgpos="000010",
                      aubel="0010000004", aupos="000010", matnr="M1", fkimg="1.000", netwr="9.00")],
    }
    frames = {name: bz(spark, name, rows) for name, rows in t.items()}
    return Lakehouse(spark, lambda name: frames[name])


def test_daily_sales_rules(lh):
    rows = {(r["sales_date"], r["sales_org"]): r for r in lh.model("agg_daily_sales").collect()}
    booked = rows[(dt.date(2026, 1, 2), "1000")]
    # three orders booked (the all-rejected order 2 counts), rejected value excluded
    assert booked["orders_booked"] == 3 and booked["booked_eur"] == Decimal("150.00")
    billed = rows[(dt.date(2026, 1, 5), "1000")]
    assert billed["invoiced_eur"] == Decimal("100.00") and billed["sales_org_name"] == "Iberia"
    # billing of the deleted order 4: null sales org, never matched, its own row
    orphan = rows[(dt.date(2026, 1, 5), None)]
    assert orphan["invoiced_eur"] == Decimal("9.00") and orphan["orders_booked"] == 0


def test_fulfillment_ladder_and_negative_days(lh):
    f = {r["order_id"]: r for r in lh.model("fct_order_fulfillment").collect()}
    assert f["10000001"]["fulfillment_status"] == "invoiced"
    assert f["10000001"]["days_order_to_goods_issue"] == -1      # goods issue before the order
    assert f["10000001"]["days_goods_issue_to_invoice"] == 4
    assert f["10000002"]["fulfillment_status"] == "rejected"
    assert f["10000003"]["fulfillment_status"] == "open"
    assert "10000004" not in f                                     # deleted order


def test_rollup_and_worklists(lh):
    roll = {r["order_id"]: r for r in worklists.order_rollup(lh).collect()}
    assert roll["10000002"]["all_items_rejected"] and roll["10000002"]["rolled_up_status"] == "C"
    assert roll["10000001"]["net_value"] == Decimal("100.000")
    due = {r["order_id"]: r for r in worklists.due_deliveries(lh, dt.date(2026, 1, 6)).collect()}
    # order 3: open, lead time 1 + 10000003 % 4 = 4 days -> due on 2026-01-06
    assert set(due) == {"10000003"} and due["10000003"]["lead_time_days"] == 4
    assert worklists.due_deliveries(lh, dt.date(2026, 1, 5)).count() == 0
    assert worklists.due_billing(lh, dt.date(2026, 1, 6)).count() == 0   # already billed


def test_orphans_need_no_amounts(spark):
    """Invoice items without a delivery, once for each header of their id; the currency table is not read."""
    from ledgerline.plans import checks
    header = dict(fkdat="20260105", kunrg="0000100001", netwr="1.00", waerk="EUR", fksto="")
    item = dict(posnr="000010", vgpos="000010", aubel="0010000001", aupos="000010", matnr="M1", fkimg="1.000", netwr="1.00")
    t = {"vbak": [dict(vbeln="0010000001")], "likp": [dict(vbeln="0080000001")],
         "lips": [dict(vbeln="0080000001", posnr="000010", vgbel="0010000009", vgpos="000010", lfimg="1.000")],
         "vbrk": [dict(vbeln="0090000001", fkart="F2", **header), dict(vbeln="0090000002", fkart="G2", **header),
                  dict(vbeln="0090000003", fkart="F2", **header), dict(vbeln="0090000003", fkart="G2", mandt="200", **header)],
         "vbrp": [dict(vbeln=f"009000000{k}", vgbel=f"008000000{d}", **item) for k, d in ((1, 1), (1, 7), (2, 7), (3, 8), (4, 7))]}
    for k, row in enumerate(t["vbrp"]):
        row["posnr"] = f"0000{k + 1}0"
    frames, read = {name: bz(spark, name, rows) for name, rows in t.items()}, []
    frames["tcurx"] = bz(spark, "tcurx", [dict(currkey="JPY", currdec="0")])
    got = checks.orphans(Lakehouse(spark, lambda name: read.append(name) or frames[name])).collect()
    assert sorted(map(tuple, got)) == [("delivery_without_order", "80000001", 10, "10000009"),
                                       ("invoice_without_delivery", "90000001", 20, "80000007"),
                                       ("invoice_without_delivery", "90000003", 40, "80000008"),
                                       ("invoice_without_delivery", "90000003", 40, "80000008")]
    assert "tcurx" not in read and sorted(read) == sorted(set(read))
