"""DuckDB oracle SQL for every registered query.

These texts are the correctness gate: the same question answered by a different engine from
the same TESTDATA derivations (``sources.fixtures``). They are written as plain SQL over CTEs,
independently of the DataFrame code. ``sql(final, *needs)`` prepends every CTE that ``final``
needs, fixtures first.
"""

from __future__ import annotations

import re

from ledgerline import seeds
from ledgerline.sources import fixtures


# ---- SQL snippets for the source formats, from the written rules (DuckDB dialect) ------------
def alpha(c: str) -> str:
    """Digits only: without leading zeros, but with one digit left."""
    return f"regexp_replace({c}, '^0*([0-9]+)$', '\\1')"


def dats(c: str) -> str:
    return f"strptime(nullif(nullif({c}, '00000000'), ''), '%Y%m%d')::date"


def num(c: str, scale: int = 3) -> str:
    """A minus at the end belongs to the front."""
    return f"cast(nullif(regexp_replace(trim({c}), '^(.*[^-])-+$', '-\\1'), '') as decimal(18,{scale}))"


def amt(c: str, currency: str) -> str:
    return f"cast({num(c)} * coalesce((select shift from currency_shift)[{currency}], 1) as decimal(18,3))"


def latest(rel: str, keys: str) -> str:
    """Current state: per key the event that is greatest by sequence and landing time, unless it is a delete."""
    return (f"select unnest(top) from (select arg_max(e, (e._seq, e._extracted_at)) as top from {rel} e "
            f"group by {', '.join('e.' + k.strip() for k in keys.split(','))}) g where top._op <> 'D'")


def lookup(seed: str, column: str, key: str) -> str:
    """A code table's ``column`` for the value of ``key``, null where it has none."""
    schema = seeds.SEED_SCHEMAS[seed]
    at = schema.fieldNames().index(column)
    kind = schema[at].dataType.simpleString().replace("string", "varchar")
    keys = ", ".join(f"'{row[0]}'" for row in seeds.SEED_ROWS[seed])
    values = ", ".join(f"cast('{row[at]}' as {kind})" for row in seeds.SEED_ROWS[seed])
    return f"map([{keys}], [{values}])[{key}]"


def eur(value: str, currency: str) -> str:
    return f"cast({value} * {lookup('fx_rates_to_eur', 'eur_per_unit', currency)} as decimal(18,2))"


# ---- CTE library ---------------------------------------------------------------------------
CTES: dict[str, str] = {}

CTES["stg_currency_decimals"] = f"""
select currkey as currency_code, cast(currdec as integer) as currency_decimals
from ({latest('bz_tcurx', 'currkey')}) c"""

# what a stored amount is multiplied by: stored with two decimals, whatever the currency has
CTES["currency_shift"] = """
select map(list(currency_code), list(cast(10.0 ** (2 - currency_decimals) as decimal(22,12)))) as shift
from stg_currency_decimals"""

CTES["stg_customer_events"] = f"""
select {alpha('kunnr')} as customer_id, name1 as customer_name, land1 as country_code, ort01 as city,
  ktokd as account_group, {dats('erdat')} as created_on, loevm as deletion_flag, _op, _seq,
  ifnull(_changed_at, cast({dats('erdat')} as timestamp)) as changed_at, _extracted_at
from bz_kna1"""

CTES["stg_customers"] = f"""
select customer_id, customer_name, country_code, city, account_group,
  account_group = '0005' as is_intercompany, created_on, deletion_flag = 'X' as is_marked_for_deletion,
  _seq as source_seq, _extracted_at
from ({latest('stg_customer_events', 'customer_id')}) c"""


def _staged(table: str, keys: str, columns: dict[str, str]) -> str:
    """A silver model: decoded columns of a table's current rows."""
    listed = ", ".join(f"{expression} as {name}" for name, expression in columns.items())
    return f"select {listed}, _seq as source_seq, _extracted_at from ({latest('bz_' + table, keys)}) c"


CTES["stg_materials"] = _staged("mara", "mandt, matnr", {
    "material_id": alpha("matnr"), "material_type": "mtart", "material_group": "matkl", "base_unit_sap": "meins",
    "gross_weight": num("brgew"), "weight_unit": "gewei", "created_on": dats("ersda"), "last_changed_on": dats("laeda")})
CTES["stg_material_texts"] = _staged("makt", "mandt, matnr, spras", {
    "material_id": alpha("matnr"), "language_key": "spras", "description": "maktx"})
CTES["stg_sales_orders"] = _staged("vbak", "mandt, vbeln", {
    "order_id": alpha("vbeln"), "created_on": dats("erdat"),
    "created_at": "strptime(concat(erdat, erzet), '%Y%m%d%H%M%S')", "order_type_sap": "auart", "sales_org": "vkorg",
    "distribution_channel": "vtweg", "division": "spart", "customer_id": alpha("kunnr"),
    "net_value": amt("netwr", "waerk"), "currency_code": "waerk", "last_changed_on": dats("aedat"), "overall_status": "gbstk"})
CTES["stg_sales_order_items"] = _staged("vbap", "mandt, vbeln, posnr", {
    "order_id": alpha("vbeln"), "item_number": "cast(posnr as integer)", "material_id": alpha("matnr"),
    "order_quantity": num("kwmeng"), "sales_unit_sap": "vrkme", "net_value": amt("netwr", "waerk"),
    "currency_code": "waerk", "rejection_reason_code": "if(abgru = '', null, abgru)", "is_rejected": "length(abgru) > 0",
    "created_on": dats("erdat"), "last_changed_on": dats("aedat")})
CTES["stg_deliveries"] = _staged("likp", "mandt, vbeln", {
    "delivery_id": alpha("vbeln"), "created_on": dats("erdat"), "customer_id": alpha("kunnr"),
    "goods_issue_on": dats("wadat_ist"), "last_changed_on": dats("aedat")})
CTES["stg_delivery_items"] = _staged("lips", "mandt, vbeln, posnr", {
    "delivery_id": alpha("vbeln"), "item_number": "cast(posnr as integer)", "order_id": alpha("vgbel"),
    "order_item_number": "cast(vgpos as integer)", "material_id": alpha("matnr"),
    "delivered_quantity": num("lfimg"), "sales_unit_sap": "vrkme"})
CTES["stg_billing_documents"] = _staged("vbrk", "mandt, vbeln", {
    "billing_id": alpha("vbeln"), "billing_type": "fkart", "billing_date": dats("fkdat"), "payer_id": alpha("kunrg"),
    "net_value": amt("netwr", "waerk"), "currency_code": "waerk", "is_cancelled": "fksto = 'X'"})

# an item has its header's currency
CTES["header_currency"] = "select map(list(billing_id), list(currency_code)) as of_header from stg_billing_documents"
CTES["stg_billing_items"] = f"""
select * exclude (netwr_text), cast({num('netwr_text')} * coalesce((select shift from currency_shift)[currency_code], 1)
  as decimal(18,3)) as net_value
from (select {alpha('vbeln')} as billing_id, cast(posnr as integer) as item_number,
        {alpha('vgbel')} as reference_document_id, cast(vgpos as integer) as reference_item_number,
        {alpha('aubel')} as order_id, cast(aupos as integer) as order_item_number, {alpha('matnr')} as material_id,
        {num('fkimg')} as billed_quantity, netwr as netwr_text,
        (select of_header from header_currency)[{alpha('vbeln')}] as currency_code, _seq as source_seq, _extracted_at
      from ({latest('bz_vbrp', 'mandt, vbeln, posnr')}) c) i"""

CTES["dim_customer"] = "select * exclude (source_seq, _extracted_at) from stg_customers"

# history: one image per sequence number, numbered; a version opens where an image differs from the
# one numbered before it, and ends where the next version opens
CTES["customer_images"] = """
select unnest(image) from (select arg_max(e, (e._extracted_at, e.customer_name, e.country_code, e.city, e._op)) as image
  from stg_customer_events e group by e.customer_id, e._seq) g"""
CTES["customer_steps"] = """
select customer_id, customer_name, country_code, city, _op, _seq, changed_at,
  count(*) over (partition by customer_id order by _seq) as step from customer_images"""
CTES["customer_openings"] = """
select now.*, row_number() over (partition by now.customer_id order by now.step) as opening
from customer_steps now left join customer_steps was on was.customer_id = now.customer_id and was.step = now.step - 1
where was.step is null or not (was._op = now._op and was.customer_name is not distinct from now.customer_name
  and was.country_code is not distinct from now.country_code and was.city is not distinct from now.city)"""
CTES["scd2_changes"] = """
select o.* exclude (step, opening), o.changed_at as valid_from, following.changed_at as valid_to
from customer_openings o left join customer_openings following
  on following.customer_id = o.customer_id and following.opening = o.opening + 1"""
CTES["dim_customer_history"] = """
select md5(concat_ws('|', customer_id, _seq)) as customer_version_key, customer_id, customer_name, country_code, city,
  valid_from, valid_to, valid_to is null as is_current
from scd2_changes where _op in ('I', 'U')"""

CTES["material_text_pivot"] = """
select material_id, text['E'] as description_en, text['D'] as description_de, text['P'] as description_pt
from (select material_id, map(list(language_key), list(description)) as text
      from (select material_id, language_key, max(description) as description from stg_material_texts group by all) t
      group by material_id) m"""

CTES["dim_material"] = f"""
select m.material_id,
  ifnull(t.description_en, ifnull(t.description_de, ifnull(t.description_pt, m.material_id))) as material_name,
  t.description_de, t.description_pt, m.material_type, m.material_group,
  {lookup('sap_units', 'unit_code', 'm.base_unit_sap')} as base_unit,
  {lookup('sap_units', 'iso_code', 'm.base_unit_sap')} as base_unit_iso,
  m.gross_weight as gross_weight_kg, m.created_on, m.last_changed_on
from stg_materials m left join material_text_pivot t using (material_id)"""

CTES["fct_sales_order_items"] = f"""
select concat_ws('/', order_id, i.item_number) as order_item_key, order_id, i.item_number, o.created_on as order_date,
  o.customer_id, i.material_id, {lookup('sap_order_types', 'order_type_code', 'o.order_type_sap')} as order_type,
  o.sales_org, i.order_quantity, {lookup('sap_units', 'unit_code', 'i.sales_unit_sap')} as sales_unit, i.net_value,
  i.currency_code, {eur('i.net_value', 'i.currency_code')} as net_value_eur, i.is_rejected,
  {lookup('sap_rejection_reasons', 'rejection_reason', 'i.rejection_reason_code')} as rejection_reason, o.overall_status
from stg_sales_orders o join stg_sales_order_items i using (order_id)"""

CTES["order_org"] = "select map(list(order_id), list(sales_org)) as of_order from stg_sales_orders"
CTES["fct_billing_items"] = f"""
select concat_ws('/', billing_id, i.item_number) as billing_item_key, billing_id, i.item_number, h.billing_type,
  {lookup('sap_billing_types', 'billing_type_name', 'h.billing_type')} as billing_type_name,
  {lookup('sap_billing_types', 'is_credit_memo', 'h.billing_type')} as is_credit_memo, h.billing_date,
  h.payer_id as customer_id, i.material_id, i.order_id, i.order_item_number,
  (select of_order from order_org)[i.order_id] as sales_org, i.reference_document_id, i.billed_quantity, i.net_value,
  i.currency_code, {eur('i.net_value', 'i.currency_code')} as net_value_eur
from (from stg_billing_documents where is_cancelled is not distinct from false) h
join stg_billing_items i using (billing_id)"""

CTES["first_delivery"] = """
select order_id, order_item_number, list_min(list(delivery_id)) as delivery_id,
  list_min(list(d.created_on)) as delivery_created_on, list_min(list(d.goods_issue_on)) as goods_issue_on
from stg_deliveries d join stg_delivery_items using (delivery_id) group by order_id, order_item_number"""

CTES["first_invoice"] = """
select order_id, order_item_number, list_min(list(billing_date)) as invoiced_on
from (from fct_billing_items where is_credit_memo = false) b group by order_id, order_item_number"""

CTES["fct_order_fulfillment"] = """
select order_item_key, order_id, item_number, customer_id, material_id, sales_org, order_date, delivery_id,
  delivery_created_on, goods_issue_on, invoiced_on, cast(goods_issue_on - order_date as integer) as days_order_to_goods_issue,
  cast(invoiced_on - goods_issue_on as integer) as days_goods_issue_to_invoice,
  cast(invoiced_on - order_date as integer) as days_order_to_invoice,
  list_extract(list_filter([if(is_rejected, 'rejected', null), if(invoiced_on is null, null, 'invoiced'),
    if(goods_issue_on is null, null, 'shipped'), if(delivery_created_on is null, null, 'in_delivery'), 'open'],
    lambda s: s is not null), 1) as fulfillment_status, net_value_eur
from fct_sales_order_items
left join (select * rename (order_item_number as item_number) from first_delivery) using (order_id, item_number)
left join (select * rename (order_item_number as item_number) from first_invoice) using (order_id, item_number)"""

CTES["agg_bookings"] = """
select order_date as sales_date, sales_org, len(list(distinct order_id)) as orders_booked,
  cast(sum(if(is_rejected, null, net_value_eur)) as decimal(38,2)) as booked_eur
from fct_sales_order_items group by order_date, sales_org"""

CTES["agg_billing"] = """
select billing_date as sales_date, sales_org,
  cast(sum(if(is_credit_memo, null, net_value_eur)) as decimal(38,2)) as invoiced_eur,
  cast(sum(if(is_credit_memo, net_value_eur, null)) as decimal(38,2)) as credited_eur
from fct_billing_items group by billing_date, sales_org"""

# both sides stacked, then one grouping
CTES["sales_lines"] = """
select order_date as day, sales_org as org, order_id as booked_order, if(is_rejected, 0, net_value_eur) as booked,
  0 as invoiced, 0 as credited from fct_sales_order_items
union all by name
select billing_date as day, sales_org as org, null as booked_order, 0 as booked,
  if(is_credit_memo, 0, net_value_eur) as invoiced, if(is_credit_memo, net_value_eur, 0) as credited from fct_billing_items"""
CTES["agg_daily_sales"] = f"""
select day as sales_date, org as sales_org, {lookup('sap_sales_orgs', 'sales_org_name', 'org')} as sales_org_name,
  cast(count(distinct booked_order) as integer) as orders_booked, cast(sum(booked) as decimal(18,2)) as booked_eur,
  cast(sum(invoiced) as decimal(18,2)) as invoiced_eur, cast(sum(credited) as decimal(18,2)) as credited_eur,
  cast(sum(invoiced + credited) as decimal(18,2)) as net_revenue_eur
from sales_lines group by day, org"""


_IDENT = re.compile(r"\b([a-z_][a-z0-9_]*)\b")


def _refs(text: str) -> list[str]:
    names = set(CTES) | set(fixtures.FIXTURE_SQL)
    return [n for n in dict.fromkeys(_IDENT.findall(text)) if n in names]


def sql(final: str, source_only: bool = False) -> str:
    """``WITH`` every fixture/CTE that ``final`` (transitively) references, then ``final``. With
    ``source_only`` bronze holds the source's rows and nothing else."""
    order: list[str] = []
    fixture_names: list[str] = []

    def visit(name: str, stack: tuple = ()) -> None:
        if name in order or name in fixture_names or name in stack:
            return
        if name in fixtures.FIXTURE_SQL:
            fixture_names.append(name)
            return
        for r in _refs(CTES[name]):
            if r != name:
                visit(r, stack + (name,))
        order.append(name)

    for r in _refs(final):
        visit(r)
    parts = []
    if fixture_names:
        parts.append(fixtures.duckdb_ctes(*fixture_names, source_only=source_only))
    parts += [f"{n} AS ({CTES[n].strip()}\n)" for n in order]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + final.strip()


# ---- CDC ------------------------------------------------------------------------------------
CTES["log_high"] = "select cast(coalesce(max(seq), 0) as bigint) as high_mark from fx_delta_log"

CTES["kna1_window"] = """
select * from fx_delta_log
where tabname = 'KNA1' and seq > 0 and seq <= (select high_mark from log_high)"""

CTES["kna1_netted"] = """
select tabkey, list_extract(list(op order by seq), 1) as first_op, max(seq) as last_seq,
  list_extract(list(logged_at order by seq desc), 1) as last_logged_at
from kna1_window group by tabkey"""


def delta_events_sql(source: str, netted: str = "kna1_netted") -> str:
    """Classify the netted KNA1 keys against the images in ``source``."""
    return f"""
select coalesce(s.mandt, n.k_mandt) as mandt, coalesce(s.kunnr, n.k_kunnr) as kunnr, s.name1, s.land1,
  s.ort01, s.ktokd, s.erdat, s.loevm,
  case when s.kunnr is not null then (case when n.first_op = 'I' then 'I' else 'U' end)
       when n.first_op <> 'I' then 'D' end as _op,
  n.last_seq as _seq, cast(n.last_logged_at as timestamp) as _changed_at
from (select rtrim(substr(tabkey, 1, 3)) as k_mandt, rtrim(substr(tabkey, 4, 10)) as k_kunnr,
        first_op, last_seq, last_logged_at from {netted}) n
left join {source} s on s.mandt = n.k_mandt and s.kunnr = n.k_kunnr"""


CTES["kna1_delta_live"] = f"select * from ({delta_events_sql('fx_kna1_live')}) d where _op is not null"
# two feeds, netted each by itself
for _feed in (0, 1):
    CTES[f"kna1_netted_{_feed}"] = f"""
select tabkey, list_extract(list(op order by seq), 1) as first_op, max(seq) as last_seq,
  list_extract(list(logged_at order by seq desc), 1) as last_logged_at
from kna1_window where seq % 2 = {_feed} group by tabkey"""
CTES["kna1_delta_feeds"] = " union all ".join(
    f"select * from ({delta_events_sql('fx_kna1_live', f'kna1_netted_{_feed}')}) d where _op is not null" for _feed in (0, 1))
CTES["kna1_delta_source"] = f"select * from ({delta_events_sql('fx_kna1_source')}) d where _op is not null"

# the published extraction scenario: INIT of fx_kna1 before any change, DELTA over the whole log
CTES["kna1_published"] = """
select mandt, kunnr, name1, land1, ort01, ktokd, erdat, loevm, 'I' as _op, cast(0 as bigint) as _seq,
  cast(null as timestamp) as _changed_at, 'INIT' as _load_type, '20260105T060000-1f2e3d4c' as _batch_id,
  timestamptz '2026-01-05 06:00:00+00' as _extracted_at, date '2026-01-05' as _extracted_day,
  cast(0 as bigint) as _watermark
from fx_kna1
union all
select mandt, kunnr, name1, land1, ort01, ktokd, erdat, loevm, _op, _seq, _changed_at, 'DELTA',
  '20260106T060000-5b6a7988', timestamptz '2026-01-06 06:00:00+00', date '2026-01-06',
  (select high_mark from log_high)
from kna1_delta_source"""

def diff_sql(left: str, right: str) -> str:
    return (f"select *, 'left_only' as _side from (select * from {left} except all select * from {right}) a "
            f"union all select *, 'right_only' as _side from (select * from {right} except all "
            f"select * from {left}) b")


CTES["vbak_current_fields"] = f"""
select mandt, vbeln, erdat, erzet, auart, vkorg, vtweg, spart, kunnr, netwr, waerk, aedat, gbstk
from ({latest('bz_vbak', 'mandt, vbeln')}) c"""

_TABLE_NAMES = ["tcurx", "kna1", "mara", "makt", "vbak", "vbap", "likp", "lips", "vbrk", "vbrp"]
CTES["init_marks"] = "\nunion all\n".join(
    f"select '{t.upper()}' as tabname, max(_seq) as watermark from bz_{t} where _load_type = 'INIT'"
    for t in _TABLE_NAMES)

# ---- work lists -----------------------------------------------------------------------------
CTES["open_order_day"] = "select max(created_on) + 1 as d from stg_sales_orders where overall_status = 'A'"
CTES["order_day"] = "select max(created_on) + 1 as d from stg_sales_orders"
CTES["billing_day"] = "select max(billing_date) + 1 as d from stg_billing_documents"

CTES["due_billing"] = """
select delivery_id, customer_id, goods_issue_on from stg_deliveries
where goods_issue_on < (select d from order_day)
  and delivery_id not in (select reference_document_id from stg_billing_items
                          where reference_document_id is not null)"""
