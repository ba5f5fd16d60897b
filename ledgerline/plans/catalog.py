"""Registered queries: name -> ``(spark, sf_dir) -> DataFrame``.

Every query reads the TESTDATA tables of ``sf_dir`` (through the fixture derivations) so its
work grows with them. Silver outputs leave out ``_extracted_at`` (a zoned landing timestamp whose
value is a fixture literal); everything else is the model as built.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import formats
from ledgerline.operators import cdc, quality, setops, state
from ledgerline.plans import checks, worklists
from ledgerline.plans.gold import FULFILLMENT_ITEMS, GOLD_MODELS
from ledgerline.plans.lakehouse import Lakehouse
from ledgerline.plans.silver import SILVER_MODELS
from ledgerline.schemas import TABLES
from ledgerline.sources import bronze, images, state_table
from ledgerline.sources.fixtures import INIT_BATCH, change_scenario, fixture

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def lakehouse(spark: SparkSession, sf_dir: str) -> Lakehouse:
    return Lakehouse.from_fixtures(spark, sf_dir)


def _model_query(name: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = lakehouse(spark, sf_dir).model(name)
        return df.drop("_extracted_at") if "_extracted_at" in df.columns else df
    q.__name__ = name
    return q


for _name in SILVER_MODELS + GOLD_MODELS + (
        "scd2_changes", "material_text_pivot", "first_delivery", "first_invoice",
        "agg_bookings", "agg_billing"):
    register(_name)(_model_query(_name))


@register("fct_order_fulfillment")
def q_fct_order_fulfillment(spark, sf_dir):
    """Its three parts are written first, one at a time: together their shuffles would be held until the join ends."""
    lh = lakehouse(spark, sf_dir)
    lh.store({"fct_sales_order_items": FULFILLMENT_ITEMS, "first_delivery": (), "first_invoice": ()})
    return lh.model("fct_order_fulfillment")


# ---- helpers --------------------------------------------------------------------------------

KNA1 = TABLES["kna1"]
# Fixed values of the extraction scenario (deterministic batch ids and landing times).
SCENARIO_INIT = ("20260105T060000-1f2e3d4c", dt.datetime(2026, 1, 5, 6, 0, tzinfo=dt.UTC))
SCENARIO_DELTA = ("20260106T060000-5b6a7988", dt.datetime(2026, 1, 6, 6, 0, tzinfo=dt.UTC))
SCENARIO_RERUN = ("20260107T060000-9a8b7c6d", dt.datetime(2026, 1, 7, 6, 0, tzinfo=dt.UTC))


def _fx(spark, sf_dir, name):
    return fixture(spark, sf_dir, name)


def kna1_delta_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DELTA for KNA1 over the whole change log against the live customer images."""
    log = _fx(spark, sf_dir, "fx_delta_log")
    high = cdc.high_mark_value(log)
    netted = cdc.net_change(cdc.log_window(log, "kna1", 0, high))
    return cdc.delta_events(netted, _fx(spark, sf_dir, "fx_kna1_live"), KNA1)


def publish_kna1_scenario(spark: SparkSession, sf_dir: str, safe: bool = False) -> tuple[str, list[dict]]:
    """INIT of the customer master (before any logged change), DELTA over the whole change
    log against the current ERP table, the same batch published once more, then a re-run with
    nothing new. Returns the bronze root and the three run results."""
    from ledgerline.session import shared_dir
    root = shared_dir(spark, "bronze-kna1")
    log = _fx(spark, sf_dir, "fx_delta_log")
    empty_log = log.filter(F.lit(False))           # the log as it was before the first change
    init = bronze.extract_table(spark, empty_log, _fx(spark, sf_dir, "fx_kna1"), root, "kna1", *SCENARIO_INIT)
    source = _fx(spark, sf_dir, "fx_kna1_source")
    delta = bronze.extract_table(spark, log, source, root, "kna1", *SCENARIO_DELTA, safe=safe)
    again = bronze.read_bronze(spark, root, "kna1").filter(F.col("_batch_id") == SCENARIO_DELTA[0])
    bronze.publish_batch(spark, again, root, "kna1", delta["watermark"], *SCENARIO_DELTA)
    rerun = bronze.extract_table(spark, log, source, root, "kna1", *SCENARIO_RERUN)
    return root, [init, delta, rerun]


def publish_all(spark: SparkSession, sf_dir: str, parallelism: int = 4) -> tuple[str, dict[str, DataFrame], list[list[dict]]]:
    """INIT and two DELTA runs of all ten tables through the extractor: the bronze root, the source
    tables as they are at the end, and the runs."""
    from ledgerline.session import shared_dir
    base = shared_dir(spark, "bronze-all")
    runs = []
    for k, (sources, log) in enumerate(change_scenario(spark, sf_dir, base)):
        at = dt.datetime(2026, 1, 5 + k, 6, 0, tzinfo=dt.UTC)
        runs.append(bronze.extract_all(spark, log, sources, f"{base}/bronze", f"run-{k}", at, parallelism=parallelism))
    return f"{base}/bronze", sources, runs


# ---- CDC extraction ---------------------------------------------------------------------------
@register("cdc_high_watermark")
def q_cdc_high_watermark(spark, sf_dir):
    return cdc.high_mark(_fx(spark, sf_dir, "fx_delta_log"))


@register("cdc_log_window")
def q_cdc_log_window(spark, sf_dir):
    log = _fx(spark, sf_dir, "fx_delta_log")
    return cdc.log_window(log, "kna1", 0, cdc.high_mark_value(log))


@register("cdc_net_change")
def q_cdc_net_change(spark, sf_dir):
    log = _fx(spark, sf_dir, "fx_delta_log")
    return cdc.net_change(cdc.log_window(log, "kna1", 0, cdc.high_mark_value(log)))


@register("cdc_delta_events")
def q_cdc_delta_events(spark, sf_dir):
    return kna1_delta_events(spark, sf_dir)


@register("cdc_delta_events_pruned")
def q_cdc_delta_events_pruned(spark, sf_dir):
    """The same delta over customer images kept clustered by key: only the key ranges it touches are read."""
    from ledgerline.session import shared_dir
    path = shared_dir(spark, "images-kna1")
    images.write_images(_fx(spark, sf_dir, "fx_kna1_live"), KNA1, path)
    log = _fx(spark, sf_dir, "fx_delta_log")
    netted = cdc.net_change(cdc.log_window(log, "kna1", 0, cdc.high_mark_value(log)))
    return cdc.delta_events(netted, images.images_of(netted, KNA1, path), KNA1)


@register("cdc_batch_counts")
def q_cdc_batch_counts(spark, sf_dir):
    return cdc.batch_counts(kna1_delta_events(spark, sf_dir))


@register("cdc_initial_load")
def q_cdc_initial_load(spark, sf_dir):
    high = cdc.high_mark_value(_fx(spark, sf_dir, "fx_delta_log"))
    return cdc.initial_events(_fx(spark, sf_dir, "fx_kna1"), KNA1, high)


@register("cdc_load_mode")
def q_cdc_load_mode(spark, sf_dir):
    """Per table of the demo lakehouse: the next run's load type, judged from the watermark of
    its INIT batch and the change-log entries after it."""
    lh = lakehouse(spark, sf_dir)
    lh.derive(spark, sf_dir, list(TABLES))
    marks = None
    for t in TABLES:
        m = (lh.bronze(t).filter(F.col("_load_type") == "INIT")
             .agg(F.max("_seq").alias("watermark")).select(F.lit(t.upper()).alias("tabname"),
                                                           "watermark"))
        marks = m if marks is None else marks.unionByName(m)
    log = _fx(spark, sf_dir, "fx_delta_log")
    # one row per table (bounded by the table list): broadcast it to the log scan, count the
    # entries after each mark with a map-side partial count, then attach to the marks
    after = (log.select("tabname", "seq").join(F.broadcast(marks), "tabname", "inner")
                .filter(F.col("seq") > F.coalesce(F.col("watermark"), F.lit(-1)))
                .groupBy("tabname").agg(F.count(F.lit(1)).alias("__n")))
    pending = marks.join(after, "tabname", "left").withColumn(
        "pending_changes", F.coalesce(F.col("__n"), F.lit(0)))
    rows = [(r["tabname"], r["watermark"], r["pending_changes"],
             cdc.load_mode(r["watermark"], r["watermark"] is None or r["pending_changes"] > 0))
            for r in pending.collect()]                     # one row per table
    return spark.createDataFrame(rows, "tabname string, watermark long, pending_changes long, load_type string")


@register("tabkey_roundtrip")
def q_tabkey_roundtrip(spark, sf_dir):
    spec = TABLES["vbap"]
    items = _fx(spark, sf_dir, "fx_vbap").select(*spec.keys)
    keyed = cdc.encode_tabkeys(items, spec.keys)
    decoded = formats.tabkey_decode("tabkey", spec.keys)
    same = F.lit(True)
    for k in spec.keys:
        same = same & (decoded[k] == F.col(k))
    return keyed.select("tabkey", *[decoded[k].alias(f"decoded_{k}") for k in spec.keys],
                        same.alias("roundtrip_ok"))


@register("replay_equals_source")
def q_replay_equals_source(spark, sf_dir):
    """Rows by which the replay of the published events and the source differ, over all ten tables: none."""
    root, sources, _ = publish_all(spark, sf_dir, parallelism=2)
    return _differences(spark, lambda t: state.replay(bronze.read_bronze(spark, root, t), TABLES[t].keys, TABLES[t].fields), sources)


def _differences(spark: SparkSession, replayed: Callable[[str], DataFrame], sources: dict[str, DataFrame]) -> DataFrame:
    """Written table by table, so that the disk holds the shuffles of one comparison at a time."""
    from ledgerline.session import release, shared_dir
    folder = shared_dir(spark, "differences")
    for table, spec in TABLES.items():
        setops.table_diff(replayed(table), sources[table]).select(
            F.lit(table).alias("tabname"), F.concat_ws("|", *[F.coalesce(f, F.lit("<null>")) for f in spec.fields]).alias("row"),
            F.col("_side").alias("side")).write.mode("append").parquet(folder)
        release(spark)
    return spark.read.schema("tabname string, row string, side string").parquet(folder)


@register("replay_safe_mode")
def q_replay_safe_mode(spark, sf_dir):
    """The customer scenario in which INIT holds keys that the log creates and removes: in safe mode
    they are deleted, and the replay equals the source again."""
    root, _ = publish_kna1_scenario(spark, sf_dir, safe=True)
    replayed = state.replay(bronze.read_bronze(spark, root, "kna1"), KNA1.keys, KNA1.fields)
    return setops.table_diff(replayed, _fx(spark, sf_dir, "fx_kna1_source"))


@register("current_state_incremental")
def q_current_state_incremental(spark, sf_dir):
    """Customers' current state from the state table: made from INIT, brought up to date with DELTA alone."""
    from ledgerline.session import shared_dir
    root = shared_dir(spark, "bronze-state")
    log = _fx(spark, sf_dir, "fx_delta_log")
    bronze.extract_table(spark, log.filter(F.lit(False)), _fx(spark, sf_dir, "fx_kna1"), root, "kna1", *SCENARIO_INIT)
    state_table.refresh(spark, root, "kna1", buckets=8)
    bronze.extract_table(spark, log, _fx(spark, sf_dir, "fx_kna1_source"), root, "kna1", *SCENARIO_DELTA)
    state_table.refresh(spark, root, "kna1")
    return state_table.read_state(spark, root, "kna1").select(*KNA1.fields, "_op", "_seq", "_changed_at", "_load_type", "_batch_id")


@register("replay_state_equals_source")
def q_replay_state_equals_source(spark, sf_dir):
    """Rows by which the state tables, brought up to date after each run, and the source differ, over
    all ten tables: none."""
    from ledgerline.session import shared_dir
    base = shared_dir(spark, "bronze-states")
    for k, (sources, log) in enumerate(change_scenario(spark, sf_dir, base)):
        at = dt.datetime(2026, 1, 5 + k, 6, 0, tzinfo=dt.UTC)
        bronze.extract_all(spark, log, sources, f"{base}/bronze", f"run-{k}", at, parallelism=2)
        state_table.refresh_all(spark, f"{base}/bronze", buckets=None, parallelism=2)
    return _differences(spark, lambda t: state_table.read_state(spark, f"{base}/bronze", t).select(*TABLES[t].fields), sources)


@register("agg_daily_sales_published")
def q_agg_daily_sales_published(spark, sf_dir):
    """The flagship model over bronze that the extractor published."""
    root, _, _ = publish_all(spark, sf_dir)
    return Lakehouse.from_bronze_root(spark, root).model("agg_daily_sales")


@register("table_diff")
def q_table_diff(spark, sf_dir):
    spec = TABLES["vbak"]
    current = state.current_state(lakehouse(spark, sf_dir).bronze("vbak"), spec.keys)
    return setops.table_diff(current.select(*spec.fields), _fx(spark, sf_dir, "fx_vbak"))


# ---- bronze store -----------------------------------------------------------------------------
BRONZE_OUT = [*KNA1.fields, "_op", "_seq", "_changed_at", "_load_type", "_batch_id",
              "_extracted_day", "_watermark"]


@register("bronze_append_readback")
def q_bronze_append_readback(spark, sf_dir):
    root, _ = publish_kna1_scenario(spark, sf_dir)
    return bronze.read_bronze(spark, root, "kna1").select(*BRONZE_OUT)


@register("bronze_batch_history")
def q_bronze_batch_history(spark, sf_dir):
    root, _ = publish_kna1_scenario(spark, sf_dir)
    hist = bronze.batch_history(bronze.read_bronze(spark, root, "kna1"))
    return hist.select("batch_id", "load_type", "rows_added", "extracted_day", "watermark")


@register("watermark_as_of")
def q_watermark_as_of(spark, sf_dir):
    """The watermark as it was after the INIT run, after the DELTA run, and now: excluding the
    batches that landed later rolls their watermark back with them."""
    root, _ = publish_kna1_scenario(spark, sf_dir)
    b = bronze.read_bronze(spark, root, "kna1")
    day = F.col("_extracted_day")

    def as_of(d: dt.datetime):
        return F.max(F.when(day <= F.lit(d.date()), F.col("_watermark")))
    return b.agg(as_of(SCENARIO_INIT[1]).alias("watermark_at_init"),
                 as_of(SCENARIO_DELTA[1]).alias("watermark_at_delta"),
                 F.max("_watermark").alias("watermark_now"))


@register("state_as_of")
def q_state_as_of(spark, sf_dir):
    """Orders as they were once the INIT batch had landed (before updates and deletes)."""
    spec = TABLES["vbak"]
    events = lakehouse(spark, sf_dir).bronze("vbak")
    return state.state_as_of(events, spec.keys, INIT_BATCH[2]).select(*spec.fields, "_seq")


@register("current_state_vbak")
def q_current_state_vbak(spark, sf_dir):
    spec = TABLES["vbak"]
    cur = state.current_state(lakehouse(spark, sf_dir).bronze("vbak"), spec.keys)
    return cur.select(*spec.fields, "_op", "_seq", "_load_type", "_batch_id")


@register("current_state_kna1")
def q_current_state_kna1(spark, sf_dir):
    spec = TABLES["kna1"]
    cur = state.current_state(lakehouse(spark, sf_dir).bronze("kna1"), spec.keys)
    return cur.select(*spec.fields, "_op", "_seq", "_changed_at", "_load_type", "_batch_id")


@register("events_dedup")
def q_events_dedup(spark, sf_dir):
    ev = lakehouse(spark, sf_dir).model("stg_customer_events")
    return ev.select("customer_id", "customer_name", "country_code", "city", "_op", "_seq",
                     "changed_at").distinct()


# ---- format functions ---------------------------------------------------------------------------
@register("fn_alpha_out")
def q_fn_alpha_out(spark, sf_dir):
    orders = _fx(spark, sf_dir, "fx_vbak").select(F.lit("kunnr").alias("field"),
                                                  F.col("kunnr").alias("stored"))
    mats = _fx(spark, sf_dir, "fx_mara").select(F.lit("matnr").alias("field"),
                                                F.col("matnr").alias("stored"))
    both = orders.unionByName(mats)
    return both.select("field", "stored", formats.alpha_out("stored").alias("external"))


@register("fn_dats")
def q_fn_dats(spark, sf_dir):
    d = _fx(spark, sf_dir, "fx_likp")
    return d.select("vbeln", "erdat", "wadat_ist", formats.dats("erdat").alias("created_on"),
                    formats.dats("wadat_ist").alias("goods_issue_on"))


@register("fn_number")
def q_fn_number(spark, sf_dir):
    i = _fx(spark, sf_dir, "fx_vbap")
    return i.select("vbeln", "posnr", "netwr", "kwmeng",
                    formats.number("netwr", 2).alias("netwr_value"),
                    formats.number("kwmeng").alias("quantity"))


@register("fn_amount")
def q_fn_amount(spark, sf_dir):
    lh = lakehouse(spark, sf_dir)
    i = _fx(spark, sf_dir, "fx_vbap").select("vbeln", "posnr", "netwr", "waerk")
    from ledgerline.plans.silver import with_amount
    return with_amount(lh, i, "netwr", "waerk", "amount")


@register("fn_amount_roundtrip")
def q_fn_amount_roundtrip(spark, sf_dir):
    """Stored text -> value -> stored text for every order item amount."""
    lh = lakehouse(spark, sf_dir)
    i = _fx(spark, sf_dir, "fx_vbap").select("vbeln", "posnr", "netwr", "waerk")
    f = lh.currency_factors()
    j = i.join(f, F.col("waerk") == F.col("__currency"), "left")
    value = formats.amount("netwr", "__factor")
    again = formats.amount_encode(value, "__factor")
    return j.select("vbeln", "posnr", "netwr", "waerk", value.alias("amount"),
                    again.alias("stored_again"), (again == F.col("netwr")).alias("roundtrip_ok"))


@register("fn_price_in")
def q_fn_price_in(spark, sf_dir):
    """Each order's total as a EUR price converted into its document currency, and each item's price in
    its supplier's, which have 0 to 4 decimals."""
    lh = lakehouse(spark, sf_dir)
    rates = lh.seed("currency_per_eur")                     # fixed rows: broadcast
    dec = lh.model("stg_currency_decimals")                 # one row per currency: sized by Spark
    o = _fx(spark, sf_dir, "fx_vbak").select(F.col("vbeln").alias("document"), "waerk", formats.number("netwr").alias("eur_price"))
    o = o.join(rates, F.col("waerk") == F.col("currency"), "left").drop("currency")
    s = _fx(spark, sf_dir, "fx_supplier_prices").select(
        F.concat_ws("/", "l_orderkey", "l_linenumber").alias("document"), "waerk", "eur_price", "units_per_eur")
    j = o.unionByName(s).join(dec, F.col("waerk") == F.col("currency_code"), "left")
    return j.select("document", "waerk", "eur_price",
                    formats.price_in("eur_price", "units_per_eur", "currency_decimals").alias("price"))


# ---- data-quality checks ------------------------------------------------------------------------
@register("dq_unique")
def q_dq_unique(spark, sf_dir):
    return quality.unique(lakehouse(spark, sf_dir).model("stg_sales_order_items"), "order_id")


@register("dq_not_null")
def q_dq_not_null(spark, sf_dir):
    fb = lakehouse(spark, sf_dir).model("fct_billing_items")
    return quality.not_null(fb, "sales_org").select("billing_item_key", "order_id")


@register("dq_accepted_values")
def q_dq_accepted_values(spark, sf_dir):
    c = lakehouse(spark, sf_dir).model("dim_customer")
    return quality.accepted_values(c, "country_code", ["PT", "ES", "DE", "FR", "GB", "US", "JP", "KW"])


@register("dq_relationships")
def q_dq_relationships(spark, sf_dir):
    lh = lakehouse(spark, sf_dir)
    return quality.relationships(lh.model("stg_sales_order_items"), "order_id",
                                 lh.model("stg_sales_orders"), "order_id").select(
        "order_id", "item_number")


@register("dq_unique_combination")
def q_dq_unique_combination(spark, sf_dir):
    return quality.unique_combination(lakehouse(spark, sf_dir).model("stg_material_texts"),
                                      ["material_id", "language_key"])


@register("dq_primary_key")
def q_dq_primary_key(spark, sf_dir):
    return checks.gold_primary_key(lakehouse(spark, sf_dir), "agg_daily_sales")


@register("dq_billing_reconcile")
def q_dq_billing_reconcile(spark, sf_dir):
    return checks.billing_reconcile(lakehouse(spark, sf_dir))


@register("dq_overbilling")
def q_dq_overbilling(spark, sf_dir):
    return checks.overbilling(lakehouse(spark, sf_dir))


@register("dq_orphans")
def q_dq_orphans(spark, sf_dir):
    return checks.orphans(lakehouse(spark, sf_dir))


@register("dq_log_complete")
def q_dq_log_complete(spark, sf_dir):
    return checks.log_complete(_fx(spark, sf_dir, "fx_kna1_source"),
                               _fx(spark, sf_dir, "fx_delta_log"), "kna1")


# ---- work lists ---------------------------------------------------------------------------------
def _order_day(lh) -> dt.date:
    return worklists.business_day_after(lh.model("stg_sales_orders"), "created_on")


def _billing_day(lh) -> dt.date:
    return worklists.business_day_after(lh.model("stg_billing_documents"), "billing_date")


@register("due_deliveries")
def q_due_deliveries(spark, sf_dir):
    lh = lakehouse(spark, sf_dir)
    return worklists.due_deliveries(lh, _order_day(lh))


@register("pending_goods_issue")
def q_pending_goods_issue(spark, sf_dir):
    lh = lakehouse(spark, sf_dir)
    return worklists.pending_goods_issue(lh, _order_day(lh))


@register("due_billing")
def q_due_billing(spark, sf_dir):
    lh = lakehouse(spark, sf_dir)
    return worklists.due_billing(lh, _order_day(lh))


@register("invoice_proposal")
def q_invoice_proposal(spark, sf_dir):
    lh = lakehouse(spark, sf_dir)
    return worklists.invoice_proposal(lh, _order_day(lh))


@register("order_rollup")
def q_order_rollup(spark, sf_dir):
    return worklists.order_rollup(lakehouse(spark, sf_dir))


@register("deletable_orders")
def q_deletable_orders(spark, sf_dir):
    lh = lakehouse(spark, sf_dir)
    open_orders = lh.model("stg_sales_orders").filter(F.col("overall_status") == "A")
    return worklists.deletable_orders(lh, worklists.business_day_after(open_orders, "created_on"))


@register("credit_candidates")
def q_credit_candidates(spark, sf_dir):
    lh = lakehouse(spark, sf_dir)
    return worklists.credit_candidates(lh, _billing_day(lh))


# ---- streaming ----------------------------------------------------------------------------------
STREAM_CLOCK = dt.datetime(2026, 1, 6, 6, 0, tzinfo=dt.UTC)


def _finished(query) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


@register("stream_delta_events")
def q_stream_delta_events(spark, sf_dir):
    """The change log lands as files of two feeds; two streaming extractions (AvailableNow), each with
    a checkpoint of its own, net them against the live customer images and publish into one bronze
    table that INIT began. Starting a stream again adds nothing."""
    from ledgerline.session import shared_dir
    from ledgerline.streaming.cdc_stream import start_extraction
    base = shared_dir(spark, "stream-kna1")
    log = _fx(spark, sf_dir, "fx_delta_log")
    bronze.extract_table(spark, log.filter(F.lit(False)), _fx(spark, sf_dir, "fx_kna1"), f"{base}/bronze", "kna1", *SCENARIO_INIT)
    live = _fx(spark, sf_dir, "fx_kna1_live")
    for feed in (0, 1):
        log.filter(F.col("seq") % 2 == feed).write.parquet(f"{base}/log{feed}")
    for feed in (0, 1, 0):
        _finished(start_extraction(spark, f"{base}/log{feed}", lambda: live, "kna1", f"{base}/bronze",
                                   f"{base}/checkpoint{feed}", clock=lambda: STREAM_CLOCK))
    b = bronze.read_bronze(spark, f"{base}/bronze", "kna1")
    return b.select(*KNA1.fields, "_op", "_seq", "_changed_at", "_load_type")


@register("stream_replay_equals_source")
def q_stream_replay_equals_source(spark, sf_dir):
    """A stream over an empty bronze root: INIT first, then the log that lands later. The replay of
    what it published differs from the source by no row."""
    from ledgerline.session import shared_dir
    from ledgerline.streaming.cdc_stream import start_extraction
    base = shared_dir(spark, "stream-init")
    log = _fx(spark, sf_dir, "fx_delta_log")
    log.filter(F.lit(False)).write.parquet(f"{base}/log")
    for current, entries in ((_fx(spark, sf_dir, "fx_kna1"), None), (_fx(spark, sf_dir, "fx_kna1_source"), log)):
        if entries is not None:
            entries.write.mode("append").parquet(f"{base}/log")
        _finished(start_extraction(spark, f"{base}/log", lambda: current, "kna1", f"{base}/bronze",
                                   f"{base}/checkpoint", clock=lambda: STREAM_CLOCK, safe=True))
    replayed = state.replay(bronze.read_bronze(spark, f"{base}/bronze", "kna1"), KNA1.keys, KNA1.fields)
    return setops.table_diff(replayed, _fx(spark, sf_dir, "fx_kna1_source"))


@register("stream_append_events")
def q_stream_append_events(spark, sf_dir):
    """The change log lands as files and is appended to a Parquet sink by a file stream with a
    checkpoint; a second run over the same files appends nothing."""
    from ledgerline.schemas import CHANGE_LOG_SCHEMA
    from ledgerline.session import shared_dir
    from ledgerline.streaming.cdc_stream import start_append
    base = shared_dir(spark, "stream-append")
    _fx(spark, sf_dir, "fx_delta_log").write.parquet(f"{base}/in/part=0")
    for _ in range(2):
        q = start_append(spark, f"{base}/in", CHANGE_LOG_SCHEMA, f"{base}/out", f"{base}/ckpt")
        q.awaitTermination()
        if q.exception():
            raise q.exception()
    return spark.read.schema(CHANGE_LOG_SCHEMA).parquet(f"{base}/out")


@register("stream_append_once")
def q_stream_append_once(spark, sf_dir):
    """The change log lands in three parts, each with the part before it once more: the sink holds every
    entry once."""
    from ledgerline.schemas import CHANGE_LOG_SCHEMA
    from ledgerline.session import shared_dir
    from ledgerline.streaming.cdc_stream import start_deduplicated_append
    base = shared_dir(spark, "stream-once")
    log = _fx(spark, sf_dir, "fx_delta_log")
    part = F.pmod(F.xxhash64("seq"), F.lit(3))
    for k in range(3):
        log.filter(part.isin(k, k - 1)).write.mode("append").parquet(f"{base}/in")
        _finished(start_deduplicated_append(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint"))
    return spark.read.schema(CHANGE_LOG_SCHEMA).parquet(f"{base}/out")
