"""Oracle SQL per registered query (DuckDB dialect, TESTDATA tables as views)."""

from __future__ import annotations

from ledgerline.oracle import alpha, amt, dats, diff_sql, latest, lookup, num, sql
from ledgerline.plans.gold import GOLD_MODELS
from ledgerline.plans.silver import SILVER_MODELS

ORACLE_SQL: dict[str, str] = {}

for _name in SILVER_MODELS:
    _cols = "* exclude (_extracted_at)" if _name != "stg_currency_decimals" else "*"
    ORACLE_SQL[_name] = sql(f"select {_cols} from {_name}")

for _name in GOLD_MODELS + ("scd2_changes", "material_text_pivot", "first_delivery",
                            "first_invoice", "agg_bookings", "agg_billing"):
    ORACLE_SQL[_name] = sql(f"select * from {_name}")

KNA1_FIELDS = "mandt, kunnr, name1, land1, ort01, ktokd, erdat, loevm"
VBAK_FIELDS = "mandt, vbeln, erdat, erzet, auart, vkorg, vtweg, spart, kunnr, netwr, waerk, aedat, gbstk"

ORACLE_SQL.update({
    # CDC extraction
    "cdc_high_watermark": sql("select high_mark from log_high"),
    "cdc_log_window": sql("select * from kna1_window"),
    "cdc_net_change": sql("select * from kna1_netted"),
    "cdc_delta_events": sql("select * from kna1_delta_live"),
    "cdc_delta_events_pruned": sql("select * from kna1_delta_live"),
    "cdc_batch_counts": sql("""
select count(*) filter (where _op = 'I') as inserts, count(*) filter (where _op = 'U') as updates,
  count(*) filter (where _op = 'D') as deletes from kna1_delta_live"""),
    "cdc_initial_load": sql(f"""
select {KNA1_FIELDS}, 'I' as _op, (select high_mark from log_high) as _seq,
  cast(null as timestamp) as _changed_at from fx_kna1"""),
    "cdc_load_mode": sql("""
select m.tabname, m.watermark, count(l.seq) as pending_changes,
  case when m.watermark is null then 'INIT' when count(l.seq) > 0 then 'DELTA' else 'NONE' end as load_type
from init_marks m left join fx_delta_log l on l.tabname = m.tabname and l.seq > coalesce(m.watermark, -1)
group by m.tabname, m.watermark"""),
    "tabkey_roundtrip": sql("""
select tabkey, rtrim(substr(tabkey, 1, 3)) as decoded_mandt, rtrim(substr(tabkey, 4, 10)) as decoded_vbeln,
  rtrim(substr(tabkey, 14, 6)) as decoded_posnr,
  rtrim(substr(tabkey, 1, 3)) = mandt and rtrim(substr(tabkey, 4, 10)) = vbeln
    and rtrim(substr(tabkey, 14, 6)) = posnr as roundtrip_ok
from (select mandt, vbeln, posnr, rpad(mandt, 3, ' ') || rpad(vbeln, 10, ' ') || rpad(posnr, 6, ' ') as tabkey
      from fx_vbap) k"""),
    # whatever the data, a replay differs from its source by no row
    "replay_equals_source": "select '' as tabname, '' as row, '' as side where false",
    "replay_safe_mode": sql("select *, '' as _side from fx_kna1_source where false"),
    "stream_replay_equals_source": sql("select *, '' as _side from fx_kna1_source where false"),
    "replay_state_equals_source": "select '' as tabname, '' as row, '' as side where false",
    "current_state_incremental": sql(f"""
select {KNA1_FIELDS}, _op, _seq, _changed_at, _load_type, _batch_id
from ({latest('kna1_published', 'mandt, kunnr')}) c"""),
    "agg_daily_sales_published": sql("select * from agg_daily_sales", source_only=True),
    "table_diff": sql(diff_sql("vbak_current_fields", "fx_vbak")),
    # bronze store
    "bronze_append_readback": sql(f"""
select {KNA1_FIELDS}, _op, _seq, _changed_at, _load_type, _batch_id, _extracted_day, _watermark
from kna1_published"""),
    "bronze_batch_history": sql("""
select _batch_id as batch_id, _load_type as load_type, count(*) as rows_added,
  min(_extracted_day) as extracted_day, max(_watermark) as watermark
from kna1_published group by all"""),
    "watermark_as_of": sql("""
select max(_watermark) filter (where _extracted_day <= date '2026-01-05') as watermark_at_init,
  max(_watermark) filter (where _extracted_day <= date '2026-01-06') as watermark_at_delta,
  max(_watermark) as watermark_now
from kna1_published"""),
    "state_as_of": sql(f"""
select {VBAK_FIELDS}, _seq from ({latest(
    "(from bz_vbak where _extracted_at <= cast('2026-01-05 06:00:00' as timestamptz))", 'mandt, vbeln')}) c"""),
    "current_state_vbak": sql(f"""
select {VBAK_FIELDS}, _op, _seq, _load_type, _batch_id from ({latest('bz_vbak', 'mandt, vbeln')}) c"""),
    "current_state_kna1": sql(f"""
select {KNA1_FIELDS}, _op, _seq, _changed_at, _load_type, _batch_id
from ({latest('bz_kna1', 'mandt, kunnr')}) c"""),
    "events_dedup": sql("""
select customer_id, customer_name, country_code, city, _op, _seq, changed_at from stg_customer_events group by all"""),
    # functions
    "fn_alpha_out": sql(f"""
select field, stored, {alpha('stored')} as external from (
  select 'kunnr' as field, kunnr as stored from fx_vbak
  union all select 'matnr', matnr from fx_mara) s"""),
    "fn_dats": sql(f"""
select vbeln, erdat, wadat_ist, {dats('erdat')} as created_on, {dats('wadat_ist')} as goods_issue_on
from fx_likp"""),
    "fn_number": sql(f"""
select vbeln, posnr, netwr, kwmeng, {num('netwr', 2)} as netwr_value, {num('kwmeng')} as quantity
from fx_vbap"""),
    "fn_amount": sql(f"""
select vbeln, posnr, netwr, waerk, {amt('netwr', 'i.waerk')} as amount from fx_vbap i"""),
    "fn_amount_roundtrip": sql(f"""
select vbeln, posnr, netwr, waerk, amount, stored_again, stored_again = netwr as roundtrip_ok
from (select *, case when internal < 0 then cast(abs(internal) as varchar) || '-'
                     else cast(internal as varchar) end as stored_again
      from (select vbeln, posnr, netwr, waerk, amount,
              cast(round(amount * (case coalesce(d.currency_decimals, 2) when 0 then 0.01 when 1 then 0.1
                                      when 2 then 1 when 3 then 10 else 100 end), 2) as decimal(20,2)) as internal
            from (select vbeln, posnr, netwr, waerk, {amt('netwr', 'i.waerk')} as amount from fx_vbap i) a
            left join stg_currency_decimals d on d.currency_code = a.waerk) b) c"""),
    "fn_price_in": sql(f"""
select document, waerk, eur_price,
  case coalesce(d.currency_decimals, 2) {' '.join(
      f'when {k} then cast(round(cast(eur_price as decimal(24,6)) * rate, {k}) as decimal(28,8))' for k in range(9))} end as price
from (select vbeln as document, waerk, {num('netwr')} as eur_price, {lookup('currency_per_eur', 'units_per_eur', 'waerk')} as rate
      from fx_vbak
      union all select concat(l_orderkey, '/', l_linenumber), waerk, eur_price, units_per_eur from fx_supplier_prices) o
left join stg_currency_decimals d on d.currency_code = o.waerk"""),
    # data quality
    "dq_unique": sql("""
select order_id, count(*) as occurrences from stg_sales_order_items where order_id is not null
group by order_id having count(*) > 1"""),
    "dq_not_null": sql("select billing_item_key, order_id from fct_billing_items where sales_org is null"),
    "dq_accepted_values": sql("""
select country_code, count(*) as occurrences from dim_customer
where country_code is not null and country_code not in ('PT', 'ES', 'DE', 'FR', 'GB', 'US', 'JP', 'KW')
group by country_code"""),
    "dq_relationships": sql("""
select order_id, item_number from stg_sales_order_items i
where order_id is not null and not exists (select 1 from stg_sales_orders o where o.order_id = i.order_id)"""),
    "dq_unique_combination": sql("""
select material_id, language_key, count(*) as occurrences from stg_material_texts
group by material_id, language_key having count(*) > 1"""),
    "dq_primary_key": sql("""
select sales_date, sales_org, count(*) as occurrences, 'null_key' as violation from agg_daily_sales
where sales_date is null or sales_org is null group by sales_date, sales_org
union all
select sales_date, sales_org, count(*), 'duplicate_key' from agg_daily_sales
where sales_date is not null and sales_org is not null group by sales_date, sales_org having count(*) > 1"""),
    "dq_billing_reconcile": sql("""
select h.billing_id, h.net_value as header_value, cast(sum(i.net_value) as decimal(18,3)) as items_value
from stg_billing_documents h left join stg_billing_items i on i.billing_id = h.billing_id
group by h.billing_id, h.net_value
having abs(h.net_value - coalesce(sum(i.net_value), 0)) > 0.01::decimal(3,2)"""),
    "dq_overbilling": sql("""
select b.order_id, b.order_item_number, b.billed_quantity, i.order_quantity
from (select order_id, order_item_number, cast(sum(billed_quantity) as decimal(18,3)) as billed_quantity
      from fct_billing_items where not is_credit_memo group by all) b
join fct_sales_order_items i on i.order_id = b.order_id and i.item_number = b.order_item_number
where b.billed_quantity > i.order_quantity"""),
    "dq_orphans": sql("""
select 'delivery_without_order' as violation, delivery_id as document_id, item_number, order_id as missing_reference
from stg_delivery_items di where not exists (select 1 from stg_sales_orders o where o.order_id = di.order_id)
union all
select 'invoice_without_delivery', bi.billing_id, bi.item_number, bi.reference_document_id
from stg_billing_items bi
where bi.billing_id in (select billing_id from stg_billing_documents where billing_type = 'F2')
  and not exists (select 1 from stg_deliveries d where d.delivery_id = bi.reference_document_id)"""),
    "dq_log_complete": sql("""
select tabkey, mandt, kunnr from (select *, rpad(mandt, 3, ' ') || rpad(kunnr, 10, ' ') as tabkey from fx_kna1_source) k
where tabkey not in (select tabkey from fx_delta_log where tabname = 'KNA1' and op = 'I')"""),
    # work lists
    "due_deliveries": sql("""
select order_id, customer_id, created_on, cast(1 + try_cast(order_id as bigint) % 4 as integer) as lead_time_days
from stg_sales_orders o
where overall_status = 'A'
  and created_on + cast(1 + try_cast(order_id as bigint) % 4 as integer) <= (select d from order_day)
  and exists (select 1 from stg_sales_order_items i where i.order_id = o.order_id and not i.is_rejected)"""),
    "pending_goods_issue": sql("""
select delivery_id, customer_id, created_on from stg_deliveries
where goods_issue_on is null and created_on < (select d from order_day)"""),
    "due_billing": sql("select * from due_billing"),
    "invoice_proposal": sql("""
select p.delivery_id, p.order_id, b.customer_id as payer_id, cast(p.items as integer) as items,
  p.net_value, p.currency_code
from (select di.delivery_id, min(di.order_id) as order_id, count(*) as items,
        cast(sum(oi.net_value) as decimal(18,3)) as net_value, min(oi.currency_code) as currency_code
      from stg_delivery_items di
      left join stg_sales_order_items oi on oi.order_id = di.order_id and oi.item_number = di.order_item_number
      where di.delivery_id in (select delivery_id from due_billing)
      group by di.delivery_id) p
join due_billing b on b.delivery_id = p.delivery_id"""),
    "order_rollup": sql("""
select o.order_id, o.currency_code, cast(coalesce(i.n, 0) as integer) as items,
  cast(coalesce(i.v, 0) as decimal(18,3)) as net_value,
  coalesce(i.all_rej, true) as all_items_rejected,
  case when coalesce(i.all_rej, true) then 'C' else o.overall_status end as rolled_up_status
from stg_sales_orders o
left join (select order_id, sum(net_value) filter (where not is_rejected) as v, bool_and(is_rejected) as all_rej,
             count(*) as n from stg_sales_order_items group by order_id) i on i.order_id = o.order_id"""),
    "deletable_orders": sql("""
select order_id, customer_id, created_on from stg_sales_orders o
where overall_status = 'A' and created_on >= (select d from open_order_day) - 1
  and not exists (select 1 from stg_delivery_items di where di.order_id = o.order_id)"""),
    "credit_candidates": sql("""
select billing_id, payer_id, billing_date, net_value, currency_code from stg_billing_documents
where billing_type = 'F2' and billing_date >= (select d from billing_day) - 30"""),
})

ORACLE_SQL["stream_delta_events"] = sql(
    f"""select {KNA1_FIELDS}, _op, _seq, _changed_at, 'DELTA' as _load_type from kna1_delta_feeds
union all select {KNA1_FIELDS}, 'I', cast(0 as bigint), cast(null as timestamp), 'INIT' from fx_kna1""")

ORACLE_SQL["stream_append_events"] = sql("select seq, tabname, tabkey, op, logged_at from fx_delta_log")
ORACLE_SQL["stream_append_once"] = ORACLE_SQL["stream_append_events"]
