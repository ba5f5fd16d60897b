"""Gold models: the typed star schema (tables with enforced contracts).

Join plan: large relations are joined on document numbers (order id, billing id), which Spark
shuffles once per key; seeds are broadcast (fixed size); AQE splits a skewed document key at
run time. Every aggregate is cast to its contract type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.scd2 import scd2_history, scd2_versions
from ledgerline.plans.silver import HEADER_COLUMNS, billing_items_with_headers, invoiced_order_items, order_headers

EUR = "decimal(18,2)"
SUM_EUR = "decimal(38,2)"   # sums of EUR amounts before the contract cast
QTY = "decimal(18,3)"


def _doc_key(doc: str, item: str):
    return F.concat(F.col(doc), F.lit("/"), F.col(item).cast("string"))


def _eur(value: str, rate: str = "fx.eur_per_unit"):
    return (F.col(value) * F.col(rate)).cast(EUR)


def dim_customer(lh) -> DataFrame:
    return lh.model("stg_customers").select(
        "customer_id", "customer_name", "country_code", "city", "account_group",
        "is_intercompany", "created_on", "is_marked_for_deletion")


CUSTOMER_TRACKED = ("customer_name", "country_code", "city")


def customer_events_deduplicable(lh) -> DataFrame:
    return lh.model("stg_customer_events").select(
        "customer_id", *CUSTOMER_TRACKED, "_op", "_seq", "changed_at", "_extracted_at")


def scd2_changes(lh) -> DataFrame:
    """Events that open a customer version, with validity (deletes still included).

    An extraction re-run may bring another image of a sequence number: that of the latest one holds.
    """
    return scd2_versions(customer_events_deduplicable(lh), "customer_id", CUSTOMER_TRACKED,
                         bucket_width=lh.scd2_bucket_width, latest_image=True)


def dim_customer_history(lh) -> DataFrame:
    """Versions of ``scd2_changes`` but deletes. One image a sequence number, so a version key is unique."""
    h = scd2_history(customer_events_deduplicable(lh), "customer_id", CUSTOMER_TRACKED,
                     bucket_width=lh.scd2_bucket_width, latest_image=True)
    return h.select(F.col("version_key").alias("customer_version_key"), "customer_id",
                    *CUSTOMER_TRACKED, "valid_from", "valid_to", "is_current")


def material_text_pivot(lh) -> DataFrame:
    """One row per material with its E/D/P descriptions (conditional max = pivot)."""
    t = lh.model("stg_material_texts")
    lang = F.col("language_key")
    return t.groupBy("material_id").agg(
        F.max(F.when(lang == "E", F.col("description"))).alias("description_en"),
        F.max(F.when(lang == "D", F.col("description"))).alias("description_de"),
        F.max(F.when(lang == "P", F.col("description"))).alias("description_pt"))


def dim_material(lh) -> DataFrame:
    m = lh.model("stg_materials").alias("m")
    texts = material_text_pivot(lh).alias("t")
    units = lh.seed("sap_units").alias("u")
    j = (m.join(texts, F.col("m.material_id") == F.col("t.material_id"), "left")
          .join(units, F.col("m.base_unit_sap") == F.col("u.sap_unit"), "left"))
    return j.select(
        F.col("m.material_id").alias("material_id"),
        F.coalesce("t.description_en", "t.description_de", "t.description_pt", "m.material_id"
                   ).alias("material_name"),
        F.col("t.description_de").alias("description_de"),
        F.col("t.description_pt").alias("description_pt"),
        F.col("m.material_type").alias("material_type"),
        F.col("m.material_group").alias("material_group"),
        F.col("u.unit_code").alias("base_unit"),
        F.col("u.iso_code").alias("base_unit_iso"),
        F.col("m.gross_weight").cast(QTY).alias("gross_weight_kg"),
        F.col("m.created_on").alias("created_on"),
        F.col("m.last_changed_on").alias("last_changed_on"))


def fct_sales_order_items(lh) -> DataFrame:
    items = lh.model("stg_sales_order_items").alias("i")
    orders = order_headers(lh).alias("o")
    j = (items.join(orders, F.col("i.order_id") == F.col("o.order_id"), "inner")
         .join(lh.seed("sap_order_types").alias("ot"),
               F.col("o.order_type_sap") == F.col("ot.order_type_sap"), "left")
         .join(lh.seed("sap_units").alias("u"), F.col("i.sales_unit_sap") == F.col("u.sap_unit"),
               "left")
         .join(lh.seed("sap_rejection_reasons").alias("r"),
               F.col("i.rejection_reason_code") == F.col("r.rejection_reason_code"), "left")
         .join(lh.seed("fx_rates_to_eur").alias("fx"),
               F.col("i.currency_code") == F.col("fx.currency_code"), "left"))
    return j.select(
        _doc_key("i.order_id", "i.item_number").alias("order_item_key"),
        F.col("i.order_id").alias("order_id"),
        F.col("i.item_number").alias("item_number"),
        F.col("o.created_on").alias("order_date"),
        F.col("o.customer_id").alias("customer_id"),
        F.col("i.material_id").alias("material_id"),
        F.col("ot.order_type_code").alias("order_type"),
        F.col("o.sales_org").alias("sales_org"),
        F.col("i.order_quantity").cast(QTY).alias("order_quantity"),
        F.col("u.unit_code").alias("sales_unit"),
        F.col("i.net_value").cast(QTY).alias("net_value"),
        F.col("i.currency_code").alias("currency_code"),
        _eur("i.net_value").alias("net_value_eur"),
        F.col("i.is_rejected").alias("is_rejected"),
        F.col("r.rejection_reason").alias("rejection_reason"),
        F.col("o.overall_status").alias("overall_status"))


def fct_billing_items(lh) -> DataFrame:
    """One row per billing item of a document that is not cancelled. Items meet their header once."""
    if lh.is_stored("stg_billing_items") and lh.is_stored("stg_billing_documents"):
        headers = lh.model("stg_billing_documents").select("billing_id", *HEADER_COLUMNS)
        items = lh.model("stg_billing_items").join(headers, "billing_id")
    else:
        items = billing_items_with_headers(lh).filter("has_header")
    orders = order_headers(lh).select("order_id", "sales_org").alias("o")
    j = (items.filter(~F.col("is_cancelled")).alias("i")
         .join(orders, F.col("i.order_id") == F.col("o.order_id"), "left")
         .join(lh.seed("sap_billing_types").alias("bt"),
               F.col("i.billing_type") == F.col("bt.billing_type"), "left")
         .join(lh.seed("fx_rates_to_eur").alias("fx"),
               F.col("i.currency_code") == F.col("fx.currency_code"), "left"))
    return j.select(
        _doc_key("i.billing_id", "i.item_number").alias("billing_item_key"),
        F.col("i.billing_id").alias("billing_id"),
        F.col("i.item_number").alias("item_number"),
        F.col("i.billing_type").alias("billing_type"),
        F.col("bt.billing_type_name").alias("billing_type_name"),
        F.col("bt.is_credit_memo").alias("is_credit_memo"),
        F.col("i.billing_date").alias("billing_date"),
        F.col("i.payer_id").alias("customer_id"),
        F.col("i.material_id").alias("material_id"),
        F.col("i.order_id").alias("order_id"),
        F.col("i.order_item_number").alias("order_item_number"),
        F.col("o.sales_org").alias("sales_org"),
        F.col("i.reference_document_id").alias("reference_document_id"),
        F.col("i.billed_quantity").cast(QTY).alias("billed_quantity"),
        F.col("i.net_value").cast(QTY).alias("net_value"),
        F.col("i.currency_code").alias("currency_code"),
        _eur("i.net_value").alias("net_value_eur"))


def first_delivery(lh) -> DataFrame:
    """Per order item: smallest delivery id and earliest delivery dates (independent minima)."""
    di = lh.model("stg_delivery_items").alias("di")
    d = lh.model("stg_deliveries").alias("d")
    j = di.join(d, F.col("di.delivery_id") == F.col("d.delivery_id"), "inner")
    return j.groupBy(F.col("di.order_id").alias("order_id"),
                     F.col("di.order_item_number").alias("order_item_number")).agg(
        F.min("di.delivery_id").alias("delivery_id"),
        F.min("d.created_on").alias("delivery_created_on"),
        F.min("d.goods_issue_on").alias("goods_issue_on"))


def first_invoice(lh) -> DataFrame:
    """Per order item: earliest billing date of a non-credit billing item."""
    if lh.is_stored("fct_billing_items"):
        b = lh.model("fct_billing_items")
    else:  # orders and amounts, which the facts also look up, tell nothing about dates
        b = invoiced_order_items(lh).join(lh.seed("sap_billing_types"), "billing_type", "left")
    return (b.filter(~F.col("is_credit_memo"))
             .groupBy("order_id", "order_item_number")
             .agg(F.min("billing_date").alias("invoiced_on")))


# what fct_order_fulfillment reads of the order items
FULFILLMENT_ITEMS = ("order_item_key", "order_id", "item_number", "customer_id", "material_id", "sales_org", "order_date",
                     "is_rejected", "net_value_eur")


def fct_order_fulfillment(lh) -> DataFrame:
    items = lh.model("fct_sales_order_items").alias("i")
    dl = lh.model("first_delivery").alias("d")
    inv = lh.model("first_invoice").alias("v")
    j = (items.join(dl, (F.col("i.order_id") == F.col("d.order_id"))
                    & (F.col("i.item_number") == F.col("d.order_item_number")), "left")
              .join(inv, (F.col("i.order_id") == F.col("v.order_id"))
                    & (F.col("i.item_number") == F.col("v.order_item_number")), "left"))
    order_date, gi, inv_on = F.col("i.order_date"), F.col("d.goods_issue_on"), F.col("v.invoiced_on")
    status = (F.when(F.col("i.is_rejected"), "rejected")
               .when(inv_on.isNotNull(), "invoiced")
               .when(gi.isNotNull(), "shipped")
               .when(F.col("d.delivery_created_on").isNotNull(), "in_delivery")
               .otherwise("open"))
    return j.select(
        F.col("i.order_item_key").alias("order_item_key"),
        F.col("i.order_id").alias("order_id"),
        F.col("i.item_number").alias("item_number"),
        F.col("i.customer_id").alias("customer_id"),
        F.col("i.material_id").alias("material_id"),
        F.col("i.sales_org").alias("sales_org"),
        order_date.alias("order_date"),
        F.col("d.delivery_id").alias("delivery_id"),
        F.col("d.delivery_created_on").alias("delivery_created_on"),
        gi.alias("goods_issue_on"),
        inv_on.alias("invoiced_on"),
        F.datediff(gi, order_date).cast("int").alias("days_order_to_goods_issue"),
        F.datediff(inv_on, gi).cast("int").alias("days_goods_issue_to_invoice"),
        F.datediff(inv_on, order_date).cast("int").alias("days_order_to_invoice"),
        status.alias("fulfillment_status"),
        F.col("i.net_value_eur").alias("net_value_eur"))


def agg_bookings(lh) -> DataFrame:
    """Orders booked (rejected items count) and booked EUR (rejected items excluded) per day/org."""
    f = lh.model("fct_sales_order_items")
    return f.groupBy(F.col("order_date").alias("sales_date"), "sales_org").agg(
        F.count_distinct("order_id").alias("orders_booked"),
        F.sum(F.when(~F.col("is_rejected"), F.col("net_value_eur"))).cast(SUM_EUR).alias("booked_eur"))


def agg_billing(lh) -> DataFrame:
    f = lh.model("fct_billing_items")
    credit = F.col("is_credit_memo")
    return f.groupBy(F.col("billing_date").alias("sales_date"), "sales_org").agg(
        F.sum(F.when(~credit, F.col("net_value_eur"))).cast(SUM_EUR).alias("invoiced_eur"),
        F.sum(F.when(credit, F.col("net_value_eur"))).cast(SUM_EUR).alias("credited_eur"))


def agg_daily_sales(lh) -> DataFrame:
    """Bookings vs billing per day and sales org. Full outer join on (date, org); a null org
    (billing of a deleted order) never matches and stays its own row."""
    bk = agg_bookings(lh).alias("bk")
    bl = agg_billing(lh).alias("bl")
    on = ((F.col("bk.sales_date") == F.col("bl.sales_date"))
          & (F.col("bk.sales_org") == F.col("bl.sales_org")))
    c = bk.join(bl, on, "full").select(
        F.coalesce("bk.sales_date", "bl.sales_date").alias("sales_date"),
        F.coalesce("bk.sales_org", "bl.sales_org").alias("sales_org"),
        F.coalesce(F.col("bk.orders_booked"), F.lit(0)).alias("orders_booked"),
        F.coalesce(F.col("bk.booked_eur"), F.lit(0)).alias("booked_eur"),
        F.coalesce(F.col("bl.invoiced_eur"), F.lit(0)).alias("invoiced_eur"),
        F.coalesce(F.col("bl.credited_eur"), F.lit(0)).alias("credited_eur")).alias("c")
    orgs = lh.seed("sap_sales_orgs").alias("g")
    return c.join(orgs, F.col("c.sales_org") == F.col("g.sales_org"), "left").select(
        F.col("c.sales_date").alias("sales_date"),
        F.col("c.sales_org").alias("sales_org"),
        F.col("g.sales_org_name").alias("sales_org_name"),
        F.col("c.orders_booked").cast("int").alias("orders_booked"),
        F.col("c.booked_eur").cast(EUR).alias("booked_eur"),
        F.col("c.invoiced_eur").cast(EUR).alias("invoiced_eur"),
        F.col("c.credited_eur").cast(EUR).alias("credited_eur"),
        (F.col("c.invoiced_eur") + F.col("c.credited_eur")).cast(EUR).alias("net_revenue_eur"))


GOLD_MODELS = (
    "dim_customer", "dim_customer_history", "dim_material", "fct_sales_order_items",
    "fct_billing_items", "fct_order_fulfillment", "agg_daily_sales",
)
