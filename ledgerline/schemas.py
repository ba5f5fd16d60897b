"""Declared schemas: ERP source tables, bronze event tables, gold contracts.

Nothing is inferred. Source tables are all-string (the ERP hands every field over as text);
bronze adds typed CDC metadata; gold tables are checked against the contracts below.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------------
# Fixed values that must equal the source system's definitions.
# Key field widths in the change log's concatenated TABKEY.
KEY_WIDTHS: dict[str, int] = {
    "mandt": 3,
    "currkey": 5,
    "kunnr": 10,
    "matnr": 18,
    "spras": 1,
    "vbeln": 10,
    "posnr": 6,
}
CLIENT = "100"


@dataclass(frozen=True)
class TableSpec:
    name: str
    description: str
    keys: tuple[str, ...]
    fields: tuple[str, ...]

    @property
    def source_schema(self) -> T.StructType:
        return T.StructType([T.StructField(f, T.StringType(), True) for f in self.fields])

    @property
    def non_keys(self) -> tuple[str, ...]:
        return tuple(f for f in self.fields if f not in self.keys)


# The ten source tables, their keys and fields, in extraction order.
TABLES: dict[str, TableSpec] = {
    t.name: t
    for t in [
        TableSpec("tcurx", "currency decimals (only currencies that deviate from 2)",
                  ("currkey",), ("currkey", "currdec")),
        TableSpec("kna1", "customer master",
                  ("mandt", "kunnr"),
                  ("mandt", "kunnr", "name1", "land1", "ort01", "ktokd", "erdat", "loevm")),
        TableSpec("mara", "material master",
                  ("mandt", "matnr"),
                  ("mandt", "matnr", "mtart", "matkl", "meins", "brgew", "gewei", "ersda", "laeda")),
        TableSpec("makt", "material descriptions, one row per language",
                  ("mandt", "matnr", "spras"), ("mandt", "matnr", "spras", "maktx")),
        TableSpec("vbak", "sales document header",
                  ("mandt", "vbeln"),
                  ("mandt", "vbeln", "erdat", "erzet", "auart", "vkorg", "vtweg", "spart", "kunnr",
                   "netwr", "waerk", "aedat", "gbstk")),
        TableSpec("vbap", "sales document item",
                  ("mandt", "vbeln", "posnr"),
                  ("mandt", "vbeln", "posnr", "matnr", "kwmeng", "vrkme", "netwr", "waerk", "abgru",
                   "erdat", "aedat")),
        TableSpec("likp", "delivery header",
                  ("mandt", "vbeln"), ("mandt", "vbeln", "erdat", "kunnr", "wadat_ist", "aedat")),
        TableSpec("lips", "delivery item",
                  ("mandt", "vbeln", "posnr"),
                  ("mandt", "vbeln", "posnr", "vgbel", "vgpos", "matnr", "lfimg", "vrkme")),
        TableSpec("vbrk", "billing document header",
                  ("mandt", "vbeln"),
                  ("mandt", "vbeln", "fkart", "fkdat", "kunrg", "netwr", "waerk", "fksto")),
        TableSpec("vbrp", "billing document item",
                  ("mandt", "vbeln", "posnr"),
                  ("mandt", "vbeln", "posnr", "vgbel", "vgpos", "aubel", "aupos", "matnr", "fkimg",
                   "netwr")),
    ]
}

CHANGE_LOG_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType(), False),
    T.StructField("tabname", T.StringType(), False),
    T.StructField("tabkey", T.StringType(), False),
    T.StructField("op", T.StringType(), False),
    T.StructField("logged_at", T.TimestampNTZType(), False),
])

# CDC metadata appended to every bronze event table.
BRONZE_META = T.StructType([
    T.StructField("_op", T.StringType(), True),
    T.StructField("_seq", T.LongType(), True),
    T.StructField("_changed_at", T.TimestampNTZType(), True),
    T.StructField("_load_type", T.StringType(), True),
    T.StructField("_batch_id", T.StringType(), True),
    T.StructField("_extracted_at", T.TimestampType(), True),
])
META_COLUMNS = tuple(f.name for f in BRONZE_META.fields)


def bronze_schema(spec: TableSpec) -> T.StructType:
    return T.StructType(list(spec.source_schema.fields) + list(BRONZE_META.fields))


_PRIMITIVES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(),
    "boolean": T.BooleanType(), "date": T.DateType(), "timestamp_ntz": T.TimestampNTZType(),
    "timestamp": T.TimestampType(),
}


def _schema(columns: str) -> T.StructType:
    """``"name type, ..."`` with primitive or ``decimal(p,s)`` types -> StructType (no session
    needed, unlike ``StructType.fromDDL``)."""
    fields = []
    for part in re.split(r",\s*(?![^()]*\))", columns.strip()):
        name, type_name = part.split(None, 1)
        m = re.fullmatch(r"decimal\((\d+),\s*(\d+)\)", type_name.strip())
        dtype = T.DecimalType(int(m[1]), int(m[2])) if m else _PRIMITIVES[type_name.strip()]
        fields.append(T.StructField(name, dtype, True))
    return T.StructType(fields)


# Gold contracts: exact column names, order and types.
GOLD_CONTRACTS: dict[str, T.StructType] = {
    "dim_customer": _schema(
        "customer_id string, customer_name string, country_code string, city string, "
        "account_group string, is_intercompany boolean, created_on date, "
        "is_marked_for_deletion boolean"),
    "dim_customer_history": _schema(
        "customer_version_key string, customer_id string, customer_name string, "
        "country_code string, city string, valid_from timestamp_ntz, valid_to timestamp_ntz, "
        "is_current boolean"),
    "dim_material": _schema(
        "material_id string, material_name string, description_de string, description_pt string, "
        "material_type string, material_group string, base_unit string, base_unit_iso string, "
        "gross_weight_kg decimal(18,3), created_on date, last_changed_on date"),
    "fct_sales_order_items": _schema(
        "order_item_key string, order_id string, item_number int, order_date date, "
        "customer_id string, material_id string, order_type string, sales_org string, "
        "order_quantity decimal(18,3), sales_unit string, net_value decimal(18,3), "
        "currency_code string, net_value_eur decimal(18,2), is_rejected boolean, "
        "rejection_reason string, overall_status string"),
    "fct_billing_items": _schema(
        "billing_item_key string, billing_id string, item_number int, billing_type string, "
        "billing_type_name string, is_credit_memo boolean, billing_date date, customer_id string, "
        "material_id string, order_id string, order_item_number int, sales_org string, "
        "reference_document_id string, billed_quantity decimal(18,3), net_value decimal(18,3), "
        "currency_code string, net_value_eur decimal(18,2)"),
    "fct_order_fulfillment": _schema(
        "order_item_key string, order_id string, item_number int, customer_id string, "
        "material_id string, sales_org string, order_date date, delivery_id string, "
        "delivery_created_on date, goods_issue_on date, invoiced_on date, "
        "days_order_to_goods_issue int, days_goods_issue_to_invoice int, "
        "days_order_to_invoice int, fulfillment_status string, net_value_eur decimal(18,2)"),
    "agg_daily_sales": _schema(
        "sales_date date, sales_org string, sales_org_name string, orders_booked int, "
        "booked_eur decimal(18,2), invoiced_eur decimal(18,2), credited_eur decimal(18,2), "
        "net_revenue_eur decimal(18,2)"),
}

# Declared primary keys / not-null constraints of the gold contracts.
GOLD_PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "dim_customer": ("customer_id",),
    "dim_customer_history": ("customer_version_key",),
    "dim_material": ("material_id",),
    "fct_sales_order_items": ("order_item_key",),
    "fct_billing_items": ("billing_item_key",),
    "fct_order_fulfillment": ("order_item_key",),
    "agg_daily_sales": ("sales_date", "sales_org"),
}
GOLD_NOT_NULL: dict[str, tuple[str, ...]] = {
    "dim_customer": ("customer_id",),
    "dim_customer_history": ("customer_version_key", "customer_id", "valid_from"),
    "dim_material": ("material_id", "material_name"),
    "fct_sales_order_items": ("order_item_key", "order_id", "item_number", "order_date"),
    "fct_billing_items": ("billing_item_key", "billing_id", "billing_date"),
    "fct_order_fulfillment": ("order_item_key",),
    "agg_daily_sales": ("sales_date", "sales_org"),
}
