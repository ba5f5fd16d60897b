"""Current state (golden order headers) and SCD2 history (golden versions, bucket property)."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.operators.scd2 import change_hash, scd2_history, scd2_versions
from ledgerline.operators.setops import table_diff
from ledgerline.operators.state import current_state, state_as_of
from ledgerline.plans.lakehouse import Lakehouse
from ledgerline.schemas import TABLES, bronze_schema

# own rows for the written rules: newest event, deletes, ALPHA, blank dates, currency shift, trailing minus
VBAK_ROWS = [
    ("100", "0000000451", "20250310", "142233", "SO", "2000", "10", "00", "0000000777", "8.40", "JPY", "00000000", "B", "I", 11, "INIT"),
    ("100", "0000000451", "20250310", "142233", "SO", "2000", "10", "00", "0000000777", "9.15", "JPY", "20250314", "B", "U", 19, "DELTA"),
    ("100", "0000000452", "20250311", "070000", "TA", "1000", "10", "00", "0000000778", "61.00", "USD", "00000000", "A", "I", 12, "INIT"),
    ("100", "0000000452", None, None, None, None, None, None, None, None, None, None, None, "D", 23, "DELTA"),
    ("100", "0000000453", "20250312", "235959", "TA", "3000", "10", "00", "EXT-77", "36.25-", "KWD", "00000000", "C", "I", 13, "INIT"),
]
LANDED = dt.datetime(2025, 3, 15, 12, 0)


def bronze_df(spark, table, rows):
    spec = TABLES[table]
    full = [r[:-2] + (r[-2], None, r[-1], "unit-test", LANDED) for r in rows]
    return spark.createDataFrame(full, bronze_schema(spec))


def tcurx(spark):
    return bronze_df(spark, "tcurx", [("JPY", "0", "I", 1, "INIT"), ("KWD", "3", "I", 1, "INIT")])


def test_sales_orders_resolve_cdc_and_formats(spark):
    """Latest event wins, deletes drop out, ALPHA only strips numeric keys, 00000000 is null,
    JPY is shifted by TCURX and trailing minus signs are parsed."""
    bronze = {"vbak": bronze_df(spark, "vbak", VBAK_ROWS), "tcurx": tcurx(spark)}
    lh = Lakehouse(spark, lambda t: bronze[t])
    rows = {r["order_id"]: r for r in lh.model("stg_sales_orders").collect()}
    assert set(rows) == {"451", "453"}
    a, c = rows["451"], rows["453"]
    assert (a["customer_id"], a["net_value"], a["currency_code"]) == ("777", Decimal("915.000"), "JPY")
    assert (a["created_on"], a["last_changed_on"]) == (dt.date(2025, 3, 10), dt.date(2025, 3, 14))
    assert a["created_at"] == dt.datetime(2025, 3, 10, 14, 22, 33)
    assert (c["customer_id"], c["net_value"], c["last_changed_on"]) == ("EXT-77", Decimal("-3.625"), None)


def test_current_state_tie_break_and_as_of(spark):
    rows = [("100", "0000000001", "A", "I", 1, "INIT"), ("100", "0000000001", "B", "U", 2, "DELTA")]
    spec = TABLES["likp"]
    data = [(m, v, e, "", "", "", op, seq, None, lt, "b", LANDED + dt.timedelta(days=seq))
            for m, v, e, op, seq, lt in rows]
    # a re-delivery of seq 2 with a different image, landed later: it wins the tie
    data.append(("100", "0000000001", "C", "", "", "", "U", 2, None, "DELTA", "b2", LANDED + dt.timedelta(days=9)))
    df = spark.createDataFrame(data, bronze_schema(spec))
    assert [r["erdat"] for r in current_state(df, spec.keys).collect()] == ["C"]
    as_of = state_as_of(df, spec.keys, LANDED + dt.timedelta(days=1))
    assert [r["erdat"] for r in as_of.collect()] == ["A"]


# own rows: a move, an unchanged re-delivery, a name change, a delete
SCD2_EVENTS = [
    ("9", "Werk Nord", "DE", "Kiel", "I", 3, dt.datetime(2024, 6, 1)),
    ("9", "Werk Nord", "DE", "Emden", "U", 5, dt.datetime(2024, 7, 2, 8)),
    ("9", "Werk Nord", "DE", "Emden", "U", 8, dt.datetime(2024, 7, 9, 8)),
    ("9", "Werk Nordsee", "DE", "Emden", "U", 13, dt.datetime(2024, 8, 20)),
    ("12", "Mills Ltd", "GB", "Leeds", "I", 4, dt.datetime(2024, 6, 3)),
    ("12", None, None, None, "D", 21, dt.datetime(2024, 9, 30, 17)),
]
SCD2_SCHEMA = ("customer_id string, customer_name string, country_code string, city string, "
               "_op string, _seq long, changed_at timestamp_ntz")
TRACKED = ["customer_name", "country_code", "city"]


def test_customer_history_golden(spark):
    """A relocation creates a second version, a no-op re-delivery does not, a delete closes."""
    ev = spark.createDataFrame(SCD2_EVENTS + SCD2_EVENTS[:2], SCD2_SCHEMA)  # duplicates count once
    for width in (1 << 20, 7, 1):
        got = sorted((r["customer_id"], r["city"], r["valid_from"], r["valid_to"], r["is_current"])
                     for r in scd2_history(ev, "customer_id", TRACKED, bucket_width=width).collect())
        assert got == [
            ("12", "Leeds", dt.datetime(2024, 6, 3), dt.datetime(2024, 9, 30, 17), False),
            ("9", "Emden", dt.datetime(2024, 7, 2, 8), dt.datetime(2024, 8, 20), False),
            ("9", "Emden", dt.datetime(2024, 8, 20), None, True),
            ("9", "Kiel", dt.datetime(2024, 6, 1), dt.datetime(2024, 7, 2, 8), False),
        ], width


def test_unlike_images_of_one_sequence(spark):
    """Images of one (key, seq): each distinct one is a version, or that of the latest extraction alone."""
    rows = [("1", "n", "PT", city, "U", 7, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, h))
            for city, h in (("Faro", 9), ("Evora", 6), ("Braga", 3))]
    ev = spark.createDataFrame(rows, SCD2_SCHEMA + ", _extracted_at timestamp").repartition(3)
    got = scd2_history(ev, "customer_id", TRACKED, latest_image=True).collect()
    assert [r["city"] for r in got] == ["Faro"]
    for width in (1, 1 << 20):
        got = scd2_history(ev.unionByName(ev), "customer_id", TRACKED, bucket_width=width).collect()
        assert sorted((r["city"], r["is_current"]) for r in got) == [("Braga", False), ("Evora", False), ("Faro", True)]


def test_history_models_take_the_latest_image(spark):
    """A re-run that brings another image of a sequence number corrects the version, whatever the order of
    the images' contents; version keys stay unique."""
    spec = TABLES["kna1"]
    images = [("Z-TOWN", 7, 6), ("A-TOWN", 7, 9), ("A-TOWN", 7, 9), ("B-TOWN", 8, 6), ("B-TOWN", 8, 9)]
    rows = [("100", "0000000001", "n", "PT", city, "0001", "20230101", "", "U", seq, dt.datetime(2024, 1, seq), "DELTA", "b",
             dt.datetime(2024, 2, 1, hour)) for city, seq, hour in images]
    lh = Lakehouse(spark, lambda t: spark.createDataFrame(rows, bronze_schema(spec)).repartition(3))
    expected = [("A-TOWN", dt.datetime(2024, 1, 7), dt.datetime(2024, 1, 8)), ("B-TOWN", dt.datetime(2024, 1, 8), None)]
    for model in ("dim_customer_history", "scd2_changes"):
        got = lh.model(model).collect()
        assert sorted((r["city"], r["valid_from"], r["valid_to"]) for r in got) == expected, model
    assert lh.model("dim_customer_history").select("customer_version_key").distinct().count() == 2


def scd2_changes_single_window(events, key, tracked, op_col="_op"):
    """Single-window formulation (one group per key): the brute-force check."""
    cols = [key, *tracked, op_col, "_seq", "changed_at"]
    ev = events.select(*cols).distinct().withColumn("__h", change_hash(op_col, tracked))
    w = Window.partitionBy(key).orderBy("_seq", "changed_at", op_col, *tracked)
    return (ev.withColumn("__prev", F.lag("__h").over(w))
              .filter(~F.col("__h").eqNullSafe(F.col("__prev")))
              .withColumn("valid_to", F.lead("changed_at").over(w))
              .select(*cols, F.col("changed_at").alias("valid_from"), "valid_to"))


def test_bucketed_scd2_equals_single_window(spark):
    """Property: for random event streams (hot keys, duplicates, deletes) every bucket width
    gives the single-window result."""
    rnd = random.Random(11)
    rows, seq = [], 0
    for _ in range(600):
        seq += rnd.randint(1, 3)
        cust = "HOT" if rnd.random() < 0.4 else f"C{rnd.randint(1, 12)}"
        op = rnd.choice("IUUUD")
        city = None if op == "D" else rnd.choice(["A", "B"])
        rows.append((cust, None if op == "D" else "n", None if op == "D" else "PT", city, op, seq,
                     dt.datetime(2026, 1, 1) + dt.timedelta(minutes=seq)))
        if rnd.random() < 0.1:
            rows.append(rows[-1])
        if rnd.random() < 0.1:  # another image of the same sequence number
            rows.append((cust, "n", "PT", "C", "U", seq, rows[-1][-1]))
    ev = spark.createDataFrame(rows, SCD2_SCHEMA)
    cols = ["customer_id", *TRACKED, "_op", "_seq", "valid_from", "valid_to"]
    expected = sorted(map(tuple, scd2_changes_single_window(ev, "customer_id", TRACKED).select(*cols).collect()),
                      key=str)
    for width in (1, 5, 64, 1 << 20):
        got = sorted(map(tuple, scd2_versions(ev, "customer_id", TRACKED, bucket_width=width)
                         .select(*cols).collect()), key=str)
        assert got == expected, width


def test_scd2_window_groups_are_bounded(spark):
    """With a small bucket width no window partition holds more than that many sequence numbers."""
    ev = spark.createDataFrame([("HOT", "n", "PT", str(i % 2), "U", i, dt.datetime(2026, 1, 1))
                                for i in range(200)], SCD2_SCHEMA)
    plan = scd2_versions(ev, "customer_id", TRACKED, bucket_width=16)
    # all buckets of the hot key exist and the result is complete (every change is a version)
    assert plan.count() == 200
    assert ev.select(F.expr("max(_seq div 16)")).first()[0] == 12


def test_strict_mode_ignores_insert_to_update_without_change(spark):
    """Parity: I then an unchanged U opens a second version; strict mode does not."""
    ev = spark.createDataFrame([
        ("1", "n", "PT", "Porto", "I", 1, dt.datetime(2026, 1, 1)),
        ("1", "n", "PT", "Porto", "U", 2, dt.datetime(2026, 1, 2)),
        ("1", "n", "PT", "Braga", "U", 3, dt.datetime(2026, 1, 3)),
    ], SCD2_SCHEMA)
    assert scd2_history(ev, "customer_id", TRACKED).count() == 3
    strict = scd2_history(ev, "customer_id", TRACKED, strict=True).collect()
    assert sorted((r["city"], r["valid_to"]) for r in strict) == [
        ("Braga", None), ("Porto", dt.datetime(2026, 1, 3))]


def test_table_diff_counts_repeated_rows_and_reads_each_side_once(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (None, None), (2, "b")], "k int, v string")
    right = spark.createDataFrame([("a", 1), (None, None), (None, None), ("c", 3)], "v string, k int")
    got = sorted(map(tuple, table_diff(left, right).collect()), key=str)
    assert got == sorted([(1, "a", "left_only")] * 2 + [(2, "b", "left_only"), (3, "c", "right_only"), (None, None, "right_only")], key=str)
    assert table_diff(left, left).count() == 0 and table_diff(left.limit(0), right.limit(0)).count() == 0
    plan = table_diff(left, right)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
