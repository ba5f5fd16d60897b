"""Reference code tables ("seeds") with declared types.

They are a handful of rows each, fixed in code, so broadcasting them is always safe: their size
does not grow with the data. ``read_seed_csv`` loads a replacement from CSV with the same schema.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.schemas import _schema

SEED_SCHEMAS: dict[str, T.StructType] = {
    "sap_units": _schema(
        "sap_unit string, unit_code string, iso_code string, unit_name string"),
    "sap_order_types": _schema(
        "order_type_sap string, order_type_code string, order_type_name string"),
    "sap_billing_types": _schema(
        "billing_type string, billing_type_name string, is_credit_memo boolean"),
    "sap_rejection_reasons": _schema(
        "rejection_reason_code string, rejection_reason string"),
    "sap_languages": _schema(
        "language_key string, language_iso string, language_name string"),
    "sap_sales_orgs": _schema("sales_org string, sales_org_name string"),
    "fx_rates_to_eur": _schema("currency_code string, eur_per_unit decimal(18,6)"),
    "currency_per_eur": _schema("currency string, units_per_eur decimal(18,6)"),
}

# The code tables' rows, as published with the source system's reference data.
SEED_ROWS: dict[str, list[tuple]] = {
    "sap_units": [
        ("ST", "PC", "PCE", "Piece"),
        ("KAR", "CAR", "CT", "Carton"),
        ("KG", "KG", "KGM", "Kilogram"),
    ],
    "sap_order_types": [
        ("TA", "OR", "Standard Order"),
        ("SO", "RO", "Rush Order"),
    ],
    "sap_billing_types": [
        ("F2", "Invoice", False),
        ("G2", "Credit Memo", True),
    ],
    "sap_rejection_reasons": [
        ("01", "Delivery date too late"),
        ("03", "Too expensive"),
        ("04", "Competitor better"),
    ],
    "sap_languages": [
        ("E", "EN", "English"),
        ("D", "DE", "German"),
        ("P", "PT", "Portuguese"),
    ],
    "sap_sales_orgs": [
        ("1000", "Iberia"),
        ("2000", "Europe"),
        ("3000", "International"),
    ],
    "fx_rates_to_eur": [
        ("EUR", Decimal("1.000000")),
        ("USD", Decimal("0.909091")),
        ("GBP", Decimal("1.162791")),
        ("JPY", Decimal("0.006250")),
        ("KWD", Decimal("2.941176")),
    ],
}
# Currency decimals that deviate from 2 (the source's TCURX content).
CURRENCY_DECIMALS: dict[str, int] = {"JPY": 0, "KWD": 3}


def _literal(value, dtype: T.DataType) -> str:
    if value is None:
        return f"CAST(NULL AS {dtype.simpleString()})"
    if isinstance(dtype, T.BooleanType):
        return "TRUE" if value else "FALSE"
    if isinstance(dtype, T.DecimalType):
        return f"CAST('{value}' AS {dtype.simpleString()})"
    return "'" + str(value).replace("'", "''") + "'"


def seed(spark: SparkSession, name: str) -> DataFrame:
    """A seed as a broadcast-hinted DataFrame (fixed size, so the hint is always safe).

    Built as an inline ``VALUES`` relation: a local relation with exact statistics that is
    broadcast without running a Spark job (a DataFrame created from a Python list would be an
    RDD scan that needs one collect job per broadcast).
    """
    schema = SEED_SCHEMAS[name]
    rows = ", ".join(
        "(" + ", ".join(_literal(v, f.dataType) for v, f in zip(row, schema.fields)) + ")"
        for row in SEED_ROWS[name])
    cols = ", ".join(f.name for f in schema.fields)
    return F.broadcast(spark.sql(f"SELECT * FROM VALUES {rows} AS t({cols})"))


def read_seed_csv(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Load a seed from CSV with its declared schema; ``01`` stays a string, blanks stay ''."""
    return (spark.read.schema(SEED_SCHEMAS[name])
            .option("header", True).option("emptyValue", "").option("nullValue", "\\N")
            .csv(path))

# Units of each currency per EUR, used to price a EUR list price in a currency.
CURRENCY_PER_EUR: dict[str, Decimal] = {
    "EUR": Decimal("1"),
    "USD": Decimal("1.10"),
    "GBP": Decimal("0.86"),
    "JPY": Decimal("160"),
    "KWD": Decimal("0.34"),
}

SEED_ROWS["currency_per_eur"] = list(CURRENCY_PER_EUR.items())
