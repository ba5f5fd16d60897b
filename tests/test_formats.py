"""ERP format decoders: golden values (amount table and documented pairs of the source)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import formats as fm


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("o")).first()["o"]


@pytest.mark.parametrize("stored, expected", [
    ("0000100042", "100042"), ("IC-NORTH", "IC-NORTH"), ("0000000000", "0"),
    ("000000000000100001", "100001"), ("12\n", "12\n"), ("", ""), (None, None), ("MAT-40", "MAT-40"),
])
def test_alpha_out(spark, stored, expected):
    assert one(spark, fm.alpha_out("v"), stored) == expected


def test_alpha_in(spark):
    assert one(spark, fm.alpha_in("v", 10), "100042") == "0000100042"
    assert one(spark, fm.alpha_in("v", 10), "IC-NORTH") == "IC-NORTH"


@pytest.mark.parametrize("stored, expected", [
    ("20260901", dt.date(2026, 9, 1)), ("00000000", None), ("", None), (None, None),
])
def test_dats(spark, stored, expected):
    assert one(spark, fm.dats("v"), stored) == expected


def test_dats_strict_and_lenient(spark):
    df = spark.createDataFrame([("2026xx01",)], "v string")
    with pytest.raises(Exception):
        df.select(fm.dats("v")).collect()
    assert df.select(fm.dats("v", lenient=True).alias("o")).first()["o"] is None


@pytest.mark.parametrize("stored, expected", [
    ("125.00-", Decimal("-125.000")), ("1250.50", Decimal("1250.500")), ("", None), ("   ", None),
    (None, None), (" 7.5 ", Decimal("7.500")), ("3--", Decimal("-3.000")),
])
def test_number(spark, stored, expected):
    assert one(spark, fm.number("v"), stored) == expected


def test_number_scale(spark):
    assert one(spark, fm.number("v", 2), "99.9-") == Decimal("-99.90")


# fixed values that state the format: value <-> stored text per currency (JPY has 0 decimals, KWD 3)
AMOUNTS = [
    (Decimal("99.90"), "EUR", "99.90"),
    (Decimal("15000"), "JPY", "150.00"),
    (Decimal("12.345"), "KWD", "123.45"),
    (Decimal("-125.00"), "EUR", "125.00-"),
    (Decimal("22920.760"), "KWD", "229207.60"),
]


def _factors(spark):
    dec = spark.createDataFrame([("JPY", 0), ("KWD", 3)], "c string, d int")
    return dec.select("c", fm.amount_factor("d").alias("f"))


@pytest.mark.parametrize("value, currency, stored", AMOUNTS)
def test_amount_round_trip(spark, value, currency, stored):
    df = spark.createDataFrame([(stored, currency)], "s string, c string").join(
        _factors(spark), "c", "left")
    row = df.select(fm.amount("s", "f").alias("v")).first()
    assert row["v"] == value
    again = df.select(fm.amount_encode(fm.amount("s", "f"), "f").alias("t")).first()["t"]
    assert again == stored


def test_price_in(spark):
    df = spark.createDataFrame(
        [(Decimal("10.005"), Decimal("1.10"), None), (Decimal("99.99"), Decimal("160"), 0),
         (Decimal("1.234"), Decimal("0.34"), 3)], "p decimal(18,3), r decimal(18,6), d int")
    got = [r["o"] for r in df.select(fm.price_in("p", "r", "d").alias("o")).collect()]
    assert got == [Decimal("11.010"), Decimal("15998.000"), Decimal("0.420")]


def test_timestamp_of(spark):
    df = spark.createDataFrame([("20260901", "081500")], "d string, t string")
    assert df.select(fm.timestamp_of("d", "t").alias("o")).first()["o"] == dt.datetime(2026, 9, 1, 8, 15)


def test_tabkey_roundtrip_and_no_truncation(spark):
    df = spark.createDataFrame([("100", "0010000001", "000010"), ("100", "TOO-LONG-DOC-NO", "10")],
                               "mandt string, vbeln string, posnr string")
    keyed = df.select(fm.tabkey_encode(["mandt", "vbeln", "posnr"]).alias("k")).collect()
    assert keyed[0]["k"] == "1000010000001000010"
    assert "TOO-LONG-DOC-NO" in keyed[1]["k"]      # longer than its width: kept whole
    dec = fm.tabkey_decode(F.lit(keyed[0]["k"]), ["mandt", "vbeln", "posnr"])
    row = df.limit(1).select(*[dec[k].alias(k) for k in dec]).first()
    assert (row["mandt"], row["vbeln"], row["posnr"]) == ("100", "0010000001", "000010")


@pytest.mark.parametrize(("decimals", "price"), [(0, "2"), (1, "1.5"), (2, "1.52"), (None, "1.52"), (3, "1.525"), (4, "1.5247"), (6, "1.524690")])
def test_price_rounds_to_the_currencys_own_decimals(spark, decimals, price):
    df = spark.createDataFrame([(Decimal("1.235"), Decimal("1.234567"), decimals)], "p decimal(18,3), r decimal(18,6), d int")
    assert df.select(fm.price_in("p", "r", "d").alias("x")).first()["x"] == Decimal(price)


def test_price_with_too_many_decimals_is_an_error(spark):
    df = spark.createDataFrame([(Decimal("1"), Decimal("1"), 9)], "p decimal(18,3), r decimal(18,6), d int")
    with pytest.raises(Exception, match="decimals"):
        df.select(fm.price_in("p", "r", "d")).collect()
