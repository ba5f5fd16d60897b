"""Silver models: current state per key, decoded and typed (lazy DataFrames, like views).

Each function takes a ``Lakehouse`` and returns a DataFrame; ``Lakehouse.model(name)`` memoises
them. Ids lose the client (``mandt``) here, as in the source project: multi-client data would
collide on the decoded ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.formats import alpha_out, amount, dats, flag, number, timestamp_of
from ledgerline.operators.state import current_state
from ledgerline.schemas import TABLES


def _current(lh, table: str) -> DataFrame:
    return current_state(lh.bronze(table), TABLES[table].keys)


def with_amount(lh, df: DataFrame, stored: str, currency: str, out: str) -> DataFrame:
    """Add ``out`` = stored CURR text shifted by the currency's decimals (default 2).

    One left join against the broadcast currency table replaces the per-row scalar subquery.
    """
    factors = lh.currency_factors()
    joined = df.join(factors, F.col(currency) == F.col("__currency"), "left")
    return joined.withColumn(out, amount(stored, "__factor")).drop("__currency", "__factor")


def _meta() -> list:
    return [F.col("_seq").alias("source_seq"), F.col("_extracted_at")]


def stg_currency_decimals(lh) -> DataFrame:
    return current_state(lh.bronze("tcurx"), ["currkey"]).select(
        F.col("currkey").alias("currency_code"),
        F.col("currdec").cast("int").alias("currency_decimals"))


def stg_customer_events(lh) -> DataFrame:
    """Every KNA1 event, typed but not collapsed (feeds current state and SCD2 history)."""
    kna1 = lh.bronze("kna1")
    created = dats("erdat")
    return kna1.select(
        alpha_out("kunnr").alias("customer_id"),
        F.col("name1").alias("customer_name"),
        F.col("land1").alias("country_code"),
        F.col("ort01").alias("city"),
        F.col("ktokd").alias("account_group"),
        created.alias("created_on"),
        F.col("loevm").alias("deletion_flag"),
        "_op", "_seq",
        # initial-load rows have no change time: the creation date stands in
        F.coalesce(F.col("_changed_at"), created.cast("timestamp_ntz")).alias("changed_at"),
        "_extracted_at")


def stg_customers(lh) -> DataFrame:
    """Current customers, keyed by the decoded id (no client)."""
    cur = current_state(lh.model("stg_customer_events"), ["customer_id"])
    return cur.select(
        "customer_id", "customer_name", "country_code", "city", "account_group",
        (F.col("account_group") == "0005").alias("is_intercompany"),
        "created_on",
        (F.col("deletion_flag") == "X").alias("is_marked_for_deletion"),
        *_meta())


def stg_materials(lh) -> DataFrame:
    return _current(lh, "mara").select(
        alpha_out("matnr").alias("material_id"),
        F.col("mtart").alias("material_type"),
        F.col("matkl").alias("material_group"),
        F.col("meins").alias("base_unit_sap"),
        number("brgew").alias("gross_weight"),
        F.col("gewei").alias("weight_unit"),
        dats("ersda").alias("created_on"),
        dats("laeda").alias("last_changed_on"),
        *_meta())


def stg_material_texts(lh) -> DataFrame:
    return _current(lh, "makt").select(
        alpha_out("matnr").alias("material_id"),
        F.col("spras").alias("language_key"),
        F.col("maktx").alias("description"),
        *_meta())


def _order_columns() -> list:
    return [
        alpha_out("vbeln").alias("order_id"),
        dats("erdat").alias("created_on"),
        timestamp_of("erdat", "erzet").alias("created_at"),
        F.col("auart").alias("order_type_sap"),
        F.col("vkorg").alias("sales_org"),
        F.col("vtweg").alias("distribution_channel"),
        F.col("spart").alias("division"),
        alpha_out("kunnr").alias("customer_id"),
        F.col("waerk").alias("currency_code"),
        dats("aedat").alias("last_changed_on"),
        F.col("gbstk").alias("overall_status"),
        *_meta()]


def stg_sales_orders(lh) -> DataFrame:
    cur = with_amount(lh, _current(lh, "vbak"), "netwr", "waerk", "net_value")
    columns = _order_columns()
    return cur.select(*columns[:8], "net_value", *columns[8:])


def order_headers(lh) -> DataFrame:
    """Current orders without their amount, so without a look at the currency table."""
    if lh.is_stored("stg_sales_orders"):
        return lh.model("stg_sales_orders").drop("net_value")
    return _current(lh, "vbak").select(*_order_columns())


def stg_sales_order_items(lh) -> DataFrame:
    cur = with_amount(lh, _current(lh, "vbap"), "netwr", "waerk", "__net_value")
    return cur.select(
        alpha_out("vbeln").alias("order_id"),
        F.col("posnr").cast("int").alias("item_number"),
        alpha_out("matnr").alias("material_id"),
        number("kwmeng").alias("order_quantity"),
        F.col("vrkme").alias("sales_unit_sap"),
        F.col("__net_value").alias("net_value"),
        F.col("waerk").alias("currency_code"),
        F.nullif(F.col("abgru"), F.lit("")).alias("rejection_reason_code"),
        (F.col("abgru") != "").alias("is_rejected"),
        dats("erdat").alias("created_on"),
        dats("aedat").alias("last_changed_on"),
        *_meta())


def stg_deliveries(lh) -> DataFrame:
    return _current(lh, "likp").select(
        alpha_out("vbeln").alias("delivery_id"),
        dats("erdat").alias("created_on"),
        alpha_out("kunnr").alias("customer_id"),
        dats("wadat_ist").alias("goods_issue_on"),
        dats("aedat").alias("last_changed_on"),
        *_meta())


def stg_delivery_items(lh) -> DataFrame:
    return _current(lh, "lips").select(
        alpha_out("vbeln").alias("delivery_id"),
        F.col("posnr").cast("int").alias("item_number"),
        alpha_out("vgbel").alias("order_id"),
        F.col("vgpos").cast("int").alias("order_item_number"),
        alpha_out("matnr").alias("material_id"),
        number("lfimg").alias("delivered_quantity"),
        F.col("vrkme").alias("sales_unit_sap"),
        *_meta())


def _billing_columns() -> list:
    return [
        alpha_out("vbeln").alias("billing_id"),
        F.col("fkart").alias("billing_type"),
        dats("fkdat").alias("billing_date"),
        alpha_out("kunrg").alias("payer_id"),
        F.col("waerk").alias("currency_code"),
        flag("fksto").alias("is_cancelled"),
        *_meta()]


def stg_billing_documents(lh) -> DataFrame:
    cur = with_amount(lh, _current(lh, "vbrk"), "netwr", "waerk", "net_value")
    columns = _billing_columns()
    return cur.select(*columns[:4], "net_value", *columns[4:])


def billing_headers(lh) -> DataFrame:
    """Current billing documents without their amount."""
    if lh.is_stored("stg_billing_documents"):
        return lh.model("stg_billing_documents").drop("net_value")
    return _current(lh, "vbrk").select(*_billing_columns())


HEADER_COLUMNS = ("billing_type", "billing_date", "payer_id", "is_cancelled")


def billing_items_with_headers(lh) -> DataFrame:
    """Billing items valued in their header's currency (items carry none), with HEADER_COLUMNS and
    ``has_header``. Headers include cancelled documents; an item without one keeps a null currency."""
    items = _current(lh, "vbrp").withColumn("__billing_id", alpha_out("vbeln"))
    headers = billing_headers(lh).select(
        F.col("billing_id").alias("__h_billing_id"), F.col("currency_code").alias("__h_currency"), *HEADER_COLUMNS)
    joined = items.join(headers, F.col("__billing_id") == F.col("__h_billing_id"), "left")
    valued = with_amount(lh, joined, "netwr", "__h_currency", "__net_value")
    return valued.select(
        F.col("__billing_id").alias("billing_id"),
        F.col("posnr").cast("int").alias("item_number"),
        alpha_out("vgbel").alias("reference_document_id"),
        F.col("vgpos").cast("int").alias("reference_item_number"),
        alpha_out("aubel").alias("order_id"),
        F.col("aupos").cast("int").alias("order_item_number"),
        alpha_out("matnr").alias("material_id"),
        number("fkimg").alias("billed_quantity"),
        F.col("__net_value").alias("net_value"),
        F.col("__h_currency").alias("currency_code"),
        *_meta(), *HEADER_COLUMNS, F.col("__h_billing_id").isNotNull().alias("has_header"))


def stg_billing_items(lh) -> DataFrame:
    return billing_items_with_headers(lh).drop(*HEADER_COLUMNS, "has_header")


def billing_item_references(lh) -> DataFrame:
    """``billing_id``, ``item_number`` and reference of every current billing item: no header, no amount."""
    return _current(lh, "vbrp").select(
        alpha_out("vbeln").alias("billing_id"),
        F.col("posnr").cast("int").alias("item_number"),
        alpha_out("vgbel").alias("reference_document_id"))


def invoiced_order_items(lh) -> DataFrame:
    """Order item, type and date of every billing item of a document that is not cancelled: no order, no amount."""
    headers = billing_headers(lh).filter(~F.col("is_cancelled")).select("billing_id", "billing_type", "billing_date")
    if lh.is_stored("stg_billing_items"):
        return lh.model("stg_billing_items").join(headers, "billing_id").select("order_id", "order_item_number", "billing_type", "billing_date")
    items = _current(lh, "vbrp").withColumn("billing_id", alpha_out("vbeln"))
    return items.join(headers, "billing_id").select(
        alpha_out("aubel").alias("order_id"), F.col("aupos").cast("int").alias("order_item_number"), "billing_type", "billing_date")


def billed_references(lh) -> DataFrame:
    """``delivery_id`` of every current billing item's reference: no header, no amount."""
    if lh.is_stored("stg_billing_items"):
        return lh.model("stg_billing_items").select(F.col("reference_document_id").alias("delivery_id"))
    return _current(lh, "vbrp").select(alpha_out("vgbel").alias("delivery_id"))


SILVER_MODELS = (
    "stg_currency_decimals", "stg_customer_events", "stg_customers", "stg_materials",
    "stg_material_texts", "stg_sales_orders", "stg_sales_order_items", "stg_deliveries",
    "stg_delivery_items", "stg_billing_documents", "stg_billing_items",
)
