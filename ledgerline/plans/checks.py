"""Data-quality checks over the lakehouse models (the source project's dbt tests).

Each returns the violating rows; an empty DataFrame means the check passes.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.formats import tabkey_encode
from ledgerline.operators import quality
from ledgerline.plans.silver import billing_headers, billing_item_references, order_headers
from ledgerline.schemas import GOLD_PRIMARY_KEYS, TABLES

TOLERANCE = Decimal("0.01")


def billing_reconcile(lh) -> DataFrame:
    """Billing headers whose value differs from the sum of their items by more than 0.01."""
    h = lh.model("stg_billing_documents").select("billing_id", F.col("net_value").alias("header_value"))
    i = (lh.model("stg_billing_items").groupBy("billing_id").agg(F.sum("net_value").alias("items_value")))
    # items are added up before the join, so it meets one row of a document on each side
    sums = h.join(i, "billing_id", "left")
    diff = F.abs(F.col("header_value") - F.coalesce(F.col("items_value"), F.lit(0)))
    return sums.filter(diff > F.lit(TOLERANCE)).select(
        "billing_id", "header_value", F.col("items_value").cast("decimal(18,3)").alias("items_value"))


def overbilling(lh) -> DataFrame:
    """Order items invoiced (credit memos excluded) for more than was ordered."""
    billed = (lh.model("fct_billing_items").filter(~F.col("is_credit_memo"))
              .groupBy("order_id", "order_item_number")
              .agg(F.sum("billed_quantity").cast("decimal(18,3)").alias("billed_quantity"))
              .alias("b"))
    items = lh.model("fct_sales_order_items").select("order_id", "item_number", "order_quantity"
                                                      ).alias("i")
    j = billed.join(items, (F.col("b.order_id") == F.col("i.order_id"))
                    & (F.col("b.order_item_number") == F.col("i.item_number")), "inner")
    return j.filter(F.col("b.billed_quantity") > F.col("i.order_quantity")).select(
        "b.order_id", "b.order_item_number", "b.billed_quantity", "i.order_quantity")


def orphans(lh) -> DataFrame:
    """Delivery items whose order does not exist, and invoice items (F2) whose delivery does
    not exist, in the current state."""
    orders = order_headers(lh).select("order_id")
    deliveries = lh.model("stg_deliveries").select("delivery_id")
    di = lh.model("stg_delivery_items")
    lost_orders = (di.join(orders, "order_id", "left_anti")
                     .select(F.lit("delivery_without_order").alias("violation"),
                             F.col("delivery_id").alias("document_id"), "item_number",
                             F.col("order_id").alias("missing_reference")))
    if lh.is_stored("stg_billing_items"):
        f2 = billing_headers(lh).filter(F.col("billing_type") == "F2").select("billing_id")
        invoice_items = lh.model("stg_billing_items").join(f2, "billing_id", "left_semi")
    else:
        # no amounts, so no look at the currency table, and the headers are read once: an item counts
        # once for each header of its document's id, as it does where it is valued
        headers = billing_headers(lh).groupBy("billing_id").agg(
            F.count(F.lit(1)).cast("int").alias("headers"), F.max(F.col("billing_type") == "F2").alias("is_f2"))
        invoice_items = (billing_item_references(lh).join(headers.filter("is_f2"), "billing_id")
                         .withColumn("header", F.explode(F.sequence(F.lit(1), F.col("headers")))).drop("header", "headers", "is_f2"))
    lost_deliveries = (invoice_items.join(deliveries, F.col("reference_document_id")
                                          == F.col("delivery_id"), "left_anti")
                       .select(F.lit("invoice_without_delivery").alias("violation"),
                               F.col("billing_id").alias("document_id"), "item_number",
                               F.col("reference_document_id").alias("missing_reference")))
    return lost_orders.unionByName(lost_deliveries)


def log_complete(live: DataFrame, log: DataFrame, table: str) -> DataFrame:
    """Live source rows whose key has no insert in the change log."""
    spec = TABLES[table]
    keyed = live.withColumn("tabkey", tabkey_encode(list(spec.keys)))
    inserts = (log.filter((F.col("tabname") == table.upper()) & (F.col("op") == "I"))
                  .select("tabkey").distinct())
    return keyed.join(inserts, "tabkey", "left_anti").select("tabkey", *spec.keys)


def gold_primary_key(lh, model: str) -> DataFrame:
    return quality.primary_key(lh.model(model), GOLD_PRIMARY_KEYS[model])

