"""Work lists: the order-to-cash business rules of the source system, as set-based queries over
the current state (what the source system's nightly jobs select to process).

``day`` is the business date the list is computed for.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.plans.silver import billed_references, order_headers


def _day(day) -> F.Column:
    return F.lit(day).cast("date") if not isinstance(day, F.Column) else day


def due_deliveries(lh, day) -> DataFrame:
    """Open orders whose lead time (1 + order number mod 4 days) has passed and that still have
    a non-rejected item: they get a delivery today."""
    orders = order_headers(lh)
    lead = F.lit(1) + F.col("order_id").try_cast("long") % 4
    open_due = orders.filter((F.col("overall_status") == "A")
                             & (F.date_add(F.col("created_on"), lead.cast("int")) <= _day(day)))
    deliverable = lh.model("stg_sales_order_items").filter(~F.col("is_rejected")).select("order_id")
    return open_due.join(deliverable, "order_id", "left_semi").select(
        "order_id", "customer_id", "created_on", lead.cast("int").alias("lead_time_days"))


def pending_goods_issue(lh, day) -> DataFrame:
    """Deliveries created before ``day`` without goods issue."""
    d = lh.model("stg_deliveries")
    return d.filter(F.col("goods_issue_on").isNull() & (F.col("created_on") < _day(day))).select(
        "delivery_id", "customer_id", "created_on")


def due_billing(lh, day) -> DataFrame:
    """Deliveries with goods issue before ``day`` that no billing item references yet."""
    d = lh.model("stg_deliveries").filter(F.col("goods_issue_on") < _day(day))
    billed = billed_references(lh).filter(F.col("delivery_id").isNotNull())
    return d.join(billed, "delivery_id", "left_anti").select(
        "delivery_id", "customer_id", "goods_issue_on")


def invoice_proposal(lh, day) -> DataFrame:
    """One proposed invoice per due delivery: its items valued from their order items."""
    due = due_billing(lh, day).select("delivery_id", F.col("customer_id").alias("payer_id"))
    # the payer comes with the delivery, so deliveries are read once
    di = lh.model("stg_delivery_items").join(due, "delivery_id").alias("di")
    oi = lh.model("stg_sales_order_items").select(
        "order_id", "item_number", "net_value", "currency_code").alias("oi")
    j = di.join(oi, (F.col("di.order_id") == F.col("oi.order_id"))
                & (F.col("di.order_item_number") == F.col("oi.item_number")), "left")
    per = j.groupBy(F.col("di.delivery_id").alias("delivery_id")).agg(
        F.min("di.order_id").alias("order_id"),
        F.min("di.payer_id").alias("payer_id"),
        F.count(F.lit(1)).alias("items"),
        F.sum("oi.net_value").cast("decimal(18,3)").alias("net_value"),
        F.min("oi.currency_code").alias("currency_code"))
    return per.select(
        "delivery_id", "order_id", "payer_id", F.col("items").cast("int").alias("items"),
        "net_value", "currency_code")


def order_rollup(lh) -> DataFrame:
    """Per order: value of its non-rejected items and whether all items are rejected (an order
    without items counts as all rejected, i.e. complete)."""
    items = lh.model("stg_sales_order_items").groupBy("order_id").agg(
        F.sum(F.when(~F.col("is_rejected"), F.col("net_value"))).alias("__value"),
        F.bool_and("is_rejected").alias("__all_rejected"),
        F.count(F.lit(1)).alias("__items"))
    orders = order_headers(lh).select("order_id", "currency_code", "overall_status")
    j = orders.join(items, "order_id", "left")
    all_rej = F.coalesce(F.col("__all_rejected"), F.lit(True))
    return j.select(
        "order_id", "currency_code",
        F.coalesce(F.col("__items"), F.lit(0)).cast("int").alias("items"),
        F.coalesce(F.col("__value"), F.lit(0)).cast("decimal(18,3)").alias("net_value"),
        all_rej.alias("all_items_rejected"),
        F.when(all_rej, F.lit("C")).otherwise(F.col("overall_status")).alias("rolled_up_status"))


def deletable_orders(lh, day) -> DataFrame:
    """Open orders created since yesterday that no delivery item references."""
    orders = order_headers(lh).filter(
        (F.col("overall_status") == "A") & (F.col("created_on") >= F.date_sub(_day(day), 1)))
    delivered = lh.model("stg_delivery_items").select("order_id")
    return orders.join(delivered, "order_id", "left_anti").select(
        "order_id", "customer_id", "created_on")


def credit_candidates(lh, day) -> DataFrame:
    """Invoices (F2) of the last 30 days: candidates for a credit memo."""
    h = lh.model("stg_billing_documents")
    return h.filter((F.col("billing_type") == "F2")
                    & (F.col("billing_date") >= F.date_sub(_day(day), 30))).select(
        "billing_id", "payer_id", "billing_date", "net_value", "currency_code")


def business_day_after(df: DataFrame, column: str) -> dt.date:
    """The day after the latest ``column`` value: one aggregated scalar to the driver."""
    latest = df.agg(F.max(column).alias("d")).first()["d"]
    return latest + dt.timedelta(days=1)
