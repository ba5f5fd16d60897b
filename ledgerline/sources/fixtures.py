"""ERP-shaped fixtures derived from the TESTDATA tables (see FIXTURES.md §6).

Each derivation is one SQL text that both Spark and DuckDB accept. ``{name}`` placeholders are
either a TESTDATA table or another derivation. Spark builds them with ``spark.sql(text, **dfs)``
(no global temp views); the DuckDB oracle inlines the same texts as CTEs, so both engines start
from identical inputs. ``$NTZ`` / ``$TZ`` stand for the engine's naive / zoned timestamp type.

The ``bz_*`` derivations are the bronze event tables of a demo lakehouse:

* INIT batch (``_seq`` 0, extracted 2026-01-05 06:00) of every table,
* ``bz_vbak``: INIT plus a DELTA batch with updates (``_seq`` 5) and deletes (``_seq`` 6),
* ``bz_kna1``: INIT of the customer master, a DELTA batch replaying the ``events`` change
  stream, and a second delivery of that same DELTA batch (an extraction re-run) in which some
  events have another image.

Rules that plant faults for the checks: customers of an unknown country, texts of a second client
whose decoded ids collide, corrected headers and items, deleted orders whose items remain.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Fixed values of the demo batches.
INIT_BATCH = ("INIT", "20260105T060000-0a1b2c3d", "2026-01-05 06:00:00")
DELTA_BATCH = ("DELTA", "20260106T060000-4e5f6a7b", "2026-01-06 06:00:00")
REDELIVERY_BATCH = ("DELTA", "20260107T060000-8c9d0e1f", "2026-01-07 06:00:00")
DELTA_CHANGED_AT = "2026-01-05 18:30:00"


def _meta(op: str, seq: str, changed_at: str, batch: tuple[str, str, str]) -> str:
    load_type, batch_id, extracted_at = batch
    return (f"{op} as _op, cast({seq} as bigint) as _seq, {changed_at} as _changed_at, "
            f"'{load_type}' as _load_type, '{batch_id}' as _batch_id, "
            f"cast('{extracted_at}' as $TZ) as _extracted_at")


INIT_META = _meta("'I'", "0", "cast(null as $NTZ)", INIT_BATCH)

FIXTURE_SQL: dict[str, str] = {
    "fx_kna1": """
select '100' as mandt,
  case when c_custkey % 50 = 0 then concat('IC-', cast(c_custkey as string)) else lpad(cast(c_custkey + 100000 as string), 10, '0') end as kunnr,
  c_name as name1,
  case when c_custkey % 211 = 0 then 'XX' else case c_nationkey % 8 when 0 then 'PT' when 1 then 'ES' when 2 then 'DE' when 3 then 'FR' when 4 then 'GB' when 5 then 'US' when 6 then 'JP' else 'KW' end end as land1,
  c_mktsegment as ort01,
  case when c_custkey % 50 = 0 then '0005' else '0001' end as ktokd,
  replace(cast((date '1994-01-01' + cast(c_custkey % 300 as int)) as string), '-', '') as erdat,
  case when c_custkey % 97 = 0 then 'X' else '' end as loevm
from {customer}""",
    "fx_mara": """
select '100' as mandt,
  case when p_partkey % 40 = 0 then concat('MAT-', cast(p_partkey as string)) else lpad(cast(p_partkey + 100000 as string), 18, '0') end as matnr,
  case when p_size % 2 = 0 then 'FERT' else 'HAWA' end as mtart,
  p_type as matkl,
  case p_partkey % 3 when 0 then 'ST' when 1 then 'KAR' else 'KG' end as meins,
  cast(cast(p_size as decimal(18,3)) as string) as brgew,
  'KG' as gewei,
  '19940101' as ersda,
  case when p_partkey % 4 = 0 then '19950615' else '00000000' end as laeda
from {part}""",
    # one text per language: English for parts not divisible by 5, German by 10, Portuguese by 20
    "fx_makt": """
select m.mandt, m.matnr, t.spras, concat(t.spras, ' ', t.p_name) as maktx
from (select p_partkey, p_name, 'E' as spras from {part} where p_partkey % 5 <> 0
      union all select p_partkey, p_name, 'D' from {part} where p_partkey % 10 <> 0
      union all select p_partkey, p_name, 'P' from {part} where p_partkey % 20 <> 0) t
join {fx_mara} m on m.matnr = case when t.p_partkey % 40 = 0 then concat('MAT-', cast(t.p_partkey as string)) else lpad(cast(t.p_partkey + 100000 as string), 18, '0') end
union all
select '200', lpad(cast(p_partkey + 100000 as string), 18, '0'), 'E', concat('second client ', p_name) from {part} where p_partkey % 50 = 7""",
    "fx_vbak": """
select '100' as mandt,
  lpad(cast(o_orderkey + 10000000 as string), 10, '0') as vbeln,
  replace(cast(cast(o_orderdate as date) as string), '-', '') as erdat,
  concat(lpad(cast(o_orderkey % 24 as string), 2, '0'), '0000') as erzet,
  case when o_orderpriority = '1-URGENT' then 'SO' else 'TA' end as auart,
  case o_custkey % 3 when 0 then '1000' when 1 then '2000' else '3000' end as vkorg,
  '10' as vtweg, '00' as spart,
  case when o_custkey % 50 = 0 then concat('IC-', cast(o_custkey as string)) else lpad(cast(o_custkey + 100000 as string), 10, '0') end as kunnr,
  cast(cast(o_totalprice as decimal(18,2)) as string) as netwr,
  case o_custkey % 5 when 0 then 'EUR' when 1 then 'USD' when 2 then 'GBP' when 3 then 'JPY' else 'KWD' end as waerk,
  case when o_orderkey % 2 = 0 then '00000000' else replace(cast((cast(o_orderdate as date) + 1) as string), '-', '') end as aedat,
  case o_orderstatus when 'O' then 'A' when 'P' then 'B' else 'C' end as gbstk
from {orders}""",
    "fx_vbap": """
select '100' as mandt,
  lpad(cast(l.l_orderkey + 10000000 as string), 10, '0') as vbeln,
  lpad(cast(10 * row_number() over (partition by l.l_orderkey order by l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice, l.l_quantity, l.l_shipdate) as string), 6, '0') as posnr,
  case when l.l_partkey % 40 = 0 then concat('MAT-', cast(l.l_partkey as string)) else lpad(cast(l.l_partkey + 100000 as string), 18, '0') end as matnr,
  cast(cast(l.l_quantity as decimal(18,3)) as string) as kwmeng,
  case l.l_partkey % 3 when 0 then 'ST' when 1 then 'KAR' else 'KG' end as vrkme,
  concat(cast(cast(l.l_extendedprice as decimal(18,2)) as string), case when l.l_partkey % 11 = 0 then '-' else '' end) as netwr,
  case o.o_custkey % 5 when 0 then 'EUR' when 1 then 'USD' when 2 then 'GBP' when 3 then 'JPY' else 'KWD' end as waerk,
  case when l.l_returnflag = 'R' and l.l_linestatus = 'O' then case l.l_partkey % 3 when 0 then '01' when 1 then '03' else '04' end else '' end as abgru,
  replace(cast(cast(o.o_orderdate as date) as string), '-', '') as erdat,
  '00000000' as aedat
from {lineitem} l join {orders} o on l.l_orderkey = o.o_orderkey""",
    "fx_likp": """
select '100' as mandt,
  lpad(cast(o_orderkey + 80000000 as string), 10, '0') as vbeln,
  replace(cast((cast(o_orderdate as date) + cast(1 + o_orderkey % 4 as int)) as string), '-', '') as erdat,
  case when o_custkey % 50 = 0 then concat('IC-', cast(o_custkey as string)) else lpad(cast(o_custkey + 100000 as string), 10, '0') end as kunnr,
  case when o_orderstatus = 'F' or o_orderkey % 2 = 0 then replace(cast((cast(o_orderdate as date) + cast(2 + o_orderkey % 4 + o_orderkey % 3 as int)) as string), '-', '') else '00000000' end as wadat_ist,
  '00000000' as aedat
from {orders} where o_orderstatus in ('P', 'F')""",
    "fx_lips": """
select i.mandt, lpad(cast(cast(i.vbeln as bigint) + 70000000 as string), 10, '0') as vbeln, i.posnr, i.vbeln as vgbel, i.posnr as vgpos, i.matnr, i.kwmeng as lfimg, i.vrkme
from {fx_vbap} i join {fx_vbak} h on i.vbeln = h.vbeln
where h.gbstk in ('B', 'C') and i.abgru = ''""",
    "fx_vbrp": """
select i.mandt, lpad(cast(cast(i.vbeln as bigint) + 80000000 as string), 10, '0') as vbeln, i.posnr,
  lpad(cast(cast(i.vbeln as bigint) + 70000000 as string), 10, '0') as vgbel, i.posnr as vgpos, i.vbeln as aubel, i.posnr as aupos, i.matnr, i.kwmeng as fkimg, i.netwr
from {fx_vbap} i join {fx_vbak} h on i.vbeln = h.vbeln
where h.gbstk = 'C' and i.abgru = ''
union all
select '100', lpad(cast(o_orderkey + 95000000 as string), 10, '0'), '000010', lpad(cast(o_orderkey + 90000000 as string), 10, '0'), '000010',
  lpad(cast(o_orderkey + 10000000 as string), 10, '0'), '000010', lpad('100001', 18, '0'), '0.000',
  concat(cast(cast(o_orderkey % 900 + 100 as decimal(18,2)) as string), '-')
from {orders} where o_orderstatus = 'F' and o_orderkey % 7 = 0""",
    "fx_vbrk": """
select '100' as mandt, t.vbeln, case when t.vbeln >= '0095000000' then 'G2' else 'F2' end as fkart,
  replace(cast((cast(o.o_orderdate as date) + cast(3 + o.o_orderkey % 4 + o.o_orderkey % 3 as int)) as string), '-', '') as fkdat,
  case when o.o_custkey % 50 = 0 then concat('IC-', cast(o.o_custkey as string)) else lpad(cast(o.o_custkey + 100000 as string), 10, '0') end as kunrg,
  case when t.amt < 0 then concat(cast(-t.amt as string), '-') else cast(t.amt as string) end as netwr,
  case o.o_custkey % 5 when 0 then 'EUR' when 1 then 'USD' when 2 then 'GBP' when 3 then 'JPY' else 'KWD' end as waerk,
  case when o.o_orderkey % 101 = 0 then 'X' else '' end as fksto
from (select vbeln, max(aubel) as aubel, cast(sum(case when netwr like '%-' then -1 * cast(replace(netwr, '-', '') as decimal(18,2)) else cast(netwr as decimal(18,2)) end) as decimal(18,2)) as amt from {fx_vbrp} r group by vbeln) t
join {orders} o on lpad(cast(o.o_orderkey + 10000000 as string), 10, '0') = t.aubel""",
    "fx_tcurx": """
select distinct case o_custkey % 5 when 3 then 'JPY' else 'KWD' end as currkey, case o_custkey % 5 when 3 then '0' else '3' end as currdec
from {orders} where o_custkey % 5 in (3, 4)
union all
select concat('S', lpad(cast(s_suppkey as string), 4, '0')), cast(s_suppkey % 5 as string)
from {supplier} where s_suppkey < 10000""",  # five characters hold no more codes
    # the price of each order item in the currency of its supplier
    "fx_supplier_prices": """
select l_orderkey, l_linenumber, case when l_suppkey < 10000 then concat('S', lpad(cast(l_suppkey as string), 4, '0')) else 'EUR' end as waerk,
  cast(l_extendedprice as decimal(18,3)) as eur_price,
  cast(1 + l_suppkey % 7 + cast(l_suppkey as decimal(18,6)) * 0.001237 as decimal(18,6)) as units_per_eur
from {lineitem}""",
    "fx_delta_log": """
select event_id + 1 as seq, 'KNA1' as tabname, rpad('100', 3, ' ') || rpad(lpad(cast(user_id + 100000 as string), 10, '0'), 10, ' ') as tabkey,
  case event_type when 'signup' then 'I' when 'error' then 'D' else 'U' end as op, ts as logged_at
from {events}""",
    "fx_kna1_events": """
select '100' as mandt, lpad(cast(user_id + 100000 as string), 10, '0') as kunnr,
  case when event_type <> 'error' then concat('Customer ', cast(user_id as string)) end as name1,
  case when event_type <> 'error' then 'PT' end as land1,
  case when event_type <> 'error' then concat('CITY_', cast(cast(floor(value) as bigint) % 3 as string)) end as ort01,
  case when event_type <> 'error' then '0001' end as ktokd,
  case when event_type <> 'error' then '20230101' end as erdat,
  case when event_type <> 'error' then '' end as loevm,
  case event_type when 'signup' then 'I' when 'error' then 'D' else 'U' end as _op,
  event_id + 1 as _seq, ts as _changed_at
from {events}""",
    "fx_kna1_live": """
select mandt, kunnr, name1, land1, ort01, ktokd, erdat, loevm
from (select *, row_number() over (partition by mandt, kunnr order by _seq desc) as rn from {fx_kna1_events} e) r
where rn = 1 and _op <> 'D'""",
    "fx_vbak_events": """
select *, 'I' as _op, cast(1 as bigint) as _seq from {fx_vbak} a
union all
select mandt, vbeln, erdat, erzet, auart, vkorg, vtweg, spart, kunnr, '175.00', waerk, erdat, gbstk, 'U', cast(5 as bigint)
from {fx_vbak} b where cast(vbeln as bigint) % 10 = 3
union all
select mandt, vbeln, null, null, null, null, null, null, null, null, null, null, null, 'D', cast(6 as bigint)
from {fx_vbak} c where cast(vbeln as bigint) % 37 = 0""",
    # the ERP's customer table after the change stream: untouched customers plus the live
    # image of every customer the stream touched
    "fx_kna1_source": """
select k.* from {fx_kna1} k where k.kunnr not in (select e.kunnr from {fx_kna1_events} e)
union all
select * from {fx_kna1_live}""",
    # ---- bronze event tables of the demo lakehouse -----------------------------------------
    "bz_tcurx": f"select currkey, currdec, {INIT_META} from {{fx_tcurx}}",
    "bz_mara": f"select *, {INIT_META} from {{fx_mara}}",
    "bz_makt": f"select *, {INIT_META} from {{fx_makt}}",
    "bz_vbap": f"select *, {INIT_META} from {{fx_vbap}}",
    "bz_likp": f"select *, {INIT_META} from {{fx_likp}}",
    "bz_lips": f"select *, {INIT_META} from {{fx_lips}}",
    # correction batches (planted faults for the checks): cancelled billing headers are
    # re-sent with a zero amount (reconciliation finds them); billing items of external
    # material numbers are re-sent with twice the billed quantity (over-billing finds them).
    "bz_vbrk": f"""
select *, {INIT_META} from {{fx_vbrk}}
union all
select mandt, vbeln, fkart, fkdat, kunrg, '0.00', waerk, fksto,
  {_meta("'U'", "7", f"cast('{DELTA_CHANGED_AT}' as $NTZ)", DELTA_BATCH)}
from {{fx_vbrk}} where fksto = 'X'""",
    "bz_vbrp": f"""
select *, {INIT_META} from {{fx_vbrp}}
union all
select mandt, vbeln, posnr, vgbel, vgpos, aubel, aupos, matnr,
  cast(cast(cast(fkimg as decimal(18,3)) * 2 as decimal(18,3)) as string), netwr,
  {_meta("'U'", "7", f"cast('{DELTA_CHANGED_AT}' as $NTZ)", DELTA_BATCH)}
from {{fx_vbrp}} where length(matnr) < 18""",
    "bz_vbak": f"""
select mandt, vbeln, erdat, erzet, auart, vkorg, vtweg, spart, kunnr, netwr, waerk, aedat, gbstk,
  {_meta("'I'", "_seq", "cast(null as $NTZ)", INIT_BATCH)}
from {{fx_vbak_events}} where _op = 'I'
union all
select mandt, vbeln, erdat, erzet, auart, vkorg, vtweg, spart, kunnr, netwr, waerk, aedat, gbstk,
  {_meta("_op", "_seq", f"cast('{DELTA_CHANGED_AT}' as $NTZ)", DELTA_BATCH)}
from {{fx_vbak_events}} where _op <> 'I'""",
    "bz_kna1": f"""
select mandt, kunnr, name1, land1, ort01, ktokd, erdat, loevm, {INIT_META} from {{fx_kna1}}
union all
select mandt, kunnr, name1, land1, ort01, ktokd, erdat, loevm,
  {_meta("_op", "_seq", "cast(_changed_at as $NTZ)", DELTA_BATCH)}
from {{fx_kna1_events}}
union all
select mandt, kunnr, name1, land1, case when _seq % 40 = 3 and _op <> 'D' then 'CITY_CORRECTED' else ort01 end, ktokd, erdat, loevm,
  {_meta("_op", "_seq", "cast(_changed_at as $NTZ)", REDELIVERY_BATCH)}
from {{fx_kna1_events}}""",
}

ENGINE_TYPES = {
    "spark": {"$NTZ": "timestamp_ntz", "$TZ": "timestamp"},
    "duckdb": {"$NTZ": "timestamp", "$TZ": "timestamptz"},
}

_PLACEHOLDER = re.compile(r"\{(\w+)\}")
# derivations that other derivations read: where their bronze table is written, its INIT rows are them
SHARED_DERIVATIONS = ("fx_vbap", "fx_vbak", "fx_vbrp")
# tables in the order of their derivations: those of one step need only earlier ones
STEPS = (("vbak", "vbap", "likp", "kna1", "mara", "makt", "tcurx"), ("vbrp", "lips"), ("vbrk",))


def dependencies(name: str) -> list[str]:
    return list(dict.fromkeys(_PLACEHOLDER.findall(FIXTURE_SQL[name])))


def _typed(text: str, engine: str) -> str:
    for token, type_name in ENGINE_TYPES[engine].items():
        text = text.replace(token, type_name)
    return text


def load_base(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str,
            memo: dict[str, DataFrame] | None = None) -> DataFrame:
    """A TESTDATA table or a derivation, as a lazily planned Spark DataFrame.

    ``memo`` shares one DataFrame per derivation across a build, so a derivation used twice
    is one logical subtree (Spark can then reuse its exchanges).
    """
    memo = {} if memo is None else memo
    if name not in memo:
        if name in BASE_TABLES:
            memo[name] = load_base(spark, sf_dir, name)
        else:
            deps = {d: fixture(spark, sf_dir, d, memo) for d in dependencies(name)}
            memo[name] = spark.sql(_typed(FIXTURE_SQL[name], "spark"), **deps)
    return memo[name]


def _fingerprint(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Changes whenever a file that ``name`` is derived from, or a derivation's text, changes: names,
    sizes and times from a listing of the inputs, on whatever file system they are."""
    from ledgerline.sources.bronze import _fs
    h = hashlib.sha1(f"{sf_dir}:{name}".encode())
    inputs = {d for x in _closure(name) for d in dependencies(x) if d in BASE_TABLES}
    for t in sorted(inputs):
        fs, path = _fs(spark, f"{sf_dir.rstrip('/')}/{t}.parquet")
        if fs.exists(path):
            files = fs.listFiles(path, True)
            found = []
            while files.hasNext():
                st = files.next()
                found.append(f"{st.getPath().toString()}:{st.getLen()}:{st.getModificationTime()}")
            h.update(f"{t}:{sorted(found)}".encode())
    for x in _closure(name):
        h.update(FIXTURE_SQL[x].encode())
    return h.hexdigest()[:16]


def materialize_bronze(spark: SparkSession, sf_dir: str, tables, rebuild: bool = False,
                       parallelism: int = 4) -> dict[str, str]:
    """Write the ``bz_*`` event tables derived from ``sf_dir`` once (the extraction step of the
    demo lakehouse) below the shared folder and return their paths.

    A derivation that another one reads is not computed again where its own table is written: its INIT rows
    are read back. Billing headers are sums of billing items, so those are written before them. The
    independent table writes of a step run as concurrent Spark jobs. Each table is written to a
    staging path and published with one rename, so a crash never leaves a half-written table that a
    later run would trust.
    """
    from concurrent.futures import ThreadPoolExecutor

    from pyspark.sql import functions as F

    from ledgerline.schemas import TABLES, bronze_schema
    from ledgerline.session import checkpoint_root, release
    from ledgerline.sources.bronze import fs_delete, fs_exists, fs_rename_if_absent
    root = f"{checkpoint_root(spark)}/ledgerline-bronze"

    def path_of(t: str) -> str:
        return f"{root}/{t}-{_fingerprint(spark, sf_dir, f'bz_{t}')}"

    def written(t: str) -> bool:
        return fs_exists(spark, f"{path_of(t)}/_SUCCESS")

    paths = {t: path_of(t) for t in tables}
    todo = [t for t in tables if rebuild or not written(t)]
    if "vbrk" in todo and "vbrp" not in todo and not written("vbrp"):
        todo.append("vbrp")
    memo: dict[str, DataFrame] = {}

    def write(t: str) -> None:
        staging = f"{root}/_staging-{t}-{uuid.uuid4().hex[:8]}"
        plans.pop(t).write.option("compression", "zstd").parquet(staging)
        release(spark)
        if rebuild:
            fs_delete(spark, path_of(t))
        fs_rename_if_absent(spark, staging, path_of(t))

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        for step in STEPS:
            now = [t for t in step if t in todo]
            needed = {x for t in now for x in _closure(f"bz_{t}")}
            for name in SHARED_DERIVATIONS:
                t = name.removeprefix("fx_")
                if name in needed and t not in now and name not in memo and written(t):
                    spec = TABLES[t]
                    events = spark.read.schema(bronze_schema(spec)).parquet(path_of(t))
                    memo[name] = events.filter(F.col("_load_type") == INIT_BATCH[0]).select(*spec.fields)
            plans = {t: fixture(spark, sf_dir, f"bz_{t}", memo) for t in now}
            list(pool.map(write, now))
            # what was planned from the inputs is planned from the written tables in the next step
            memo = {name: df for name, df in memo.items() if name in SHARED_DERIVATIONS and name.removeprefix("fx_") not in now}
    return paths


@lru_cache(maxsize=None)
def _closure(name: str) -> tuple[str, ...]:
    """Derivations ``name`` depends on, in dependency order, ``name`` last."""
    if name in BASE_TABLES:
        return ()
    out: list[str] = []
    for d in dependencies(name):
        for x in _closure(d):
            if x not in out:
                out.append(x)
    out.append(name)
    return tuple(out)


def duckdb_ctes(*names: str, source_only: bool = False) -> str:
    """``name AS (...)`` CTE definitions for DuckDB covering ``names`` and their inputs. With
    ``source_only`` each bronze table holds the source's rows and nothing else."""
    texts = dict(FIXTURE_SQL)
    if source_only:
        texts |= {n: f"select *, {INIT_META} from {{fx_{n.removeprefix('bz_')}}}" for n in texts if n.startswith("bz_")}
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in BASE_TABLES and name not in order:
            for d in dict.fromkeys(_PLACEHOLDER.findall(texts[name])):
                visit(d)
            order.append(name)

    for n in names:
        visit(n)
    parts = []
    for n in order:
        body = _PLACEHOLDER.sub(lambda m: m.group(1), _typed(texts[n], "duckdb"))
        parts.append(f"{n} AS ({body.strip()}\n)")
    return ",\n".join(parts)


def store_sources(spark: SparkSession, sf_dir: str, folder: str, parallelism: int = 4) -> dict[str, DataFrame]:
    """The ten source tables, each derived once, written below ``folder`` and read back, with ``__part``: a tenth
    of the keys (0 to 9). Derivations that read another one read its written table."""
    from concurrent.futures import ThreadPoolExecutor

    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from ledgerline.schemas import TABLES
    from ledgerline.session import release

    memo: dict[str, DataFrame] = {}
    stored: dict[str, DataFrame] = {}

    def store(t: str) -> DataFrame:
        spec, part = TABLES[t], T.StructField("__part", T.LongType())
        rows = plans.pop(t).select(*spec.fields).withColumn("__part", F.pmod(F.xxhash64(*spec.keys), F.lit(10)))
        rows.write.option("compression", "zstd").parquet(f"{folder}/{t}")
        del rows
        release(spark)
        return spark.read.schema(T.StructType([*spec.source_schema.fields, part])).parquet(f"{folder}/{t}")

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        for step in STEPS:
            plans = {t: fixture(spark, sf_dir, f"fx_{t}", memo) for t in step}
            stored |= zip(step, pool.map(store, step), strict=True)
            memo = {f"fx_{t}": df.drop("__part") for t, df in stored.items()}
    return stored


def change_scenario(spark: SparkSession, sf_dir: str, folder: str) -> list[tuple[dict[str, DataFrame], DataFrame]]:
    """Three moments of all ten source tables: (images by table, change log so far).

    At first a tenth of the keys is missing, two tenths have an older image, and a tenth has a
    phantom twin (of another client, or another currency). Then the missing keys come and half of
    the older images change; at last the other half change and the phantoms go. What is left is
    the source as derived. The source is derived once and written below ``folder``; each moment reads
    it once. The log is written there too and read back, so that its sequence numbers are fixed.
    """
    from pyspark.sql import functions as F

    from ledgerline.operators.cdc import encode_tabkeys
    from ledgerline.schemas import CHANGE_LOG_SCHEMA, TABLES

    moments: list[dict[str, DataFrame]] = [{}, {}, {}]
    logs: list[list[DataFrame]] = [[], []]
    part = F.col("__part")
    for table, stored in store_sources(spark, sf_dir, f"{folder}/source").items():
        spec = TABLES[table]
        value = spec.fields[-1]
        twin_key, twin = (("mandt", F.lit("300")) if "mandt" in spec.keys else
                          (spec.keys[0], F.concat(F.lit("X"), F.substring(F.col(spec.keys[0]), 2, 9))))

        def images(rows: DataFrame, old: tuple[int, ...], twin_key=twin_key, twin=twin, value=value, spec=spec) -> DataFrame:
            """The rows, those of the parts ``old`` with their older image, and the twins of part 3."""
            copies = F.when(part == 3, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
            older = F.when(part.isin(*old), F.concat(F.lit("old "), F.col(value))).otherwise(F.col(value))
            return (rows.withColumn(value, older).withColumn("__twin", F.explode(copies))
                        .withColumn(twin_key, F.when(F.col("__twin"), twin).otherwise(F.col(twin_key))).select(*spec.fields))

        moments[0][table] = images(stored.filter(part != 0), (1, 2))
        moments[1][table] = images(stored, (2,))
        moments[2][table] = stored.select(*spec.fields)

        def entries(rows: DataFrame, op, table: str = table, keys=spec.keys) -> DataFrame:
            return encode_tabkeys(rows, keys).select(F.lit(table.upper()).alias("tabname"), "tabkey", op.alias("op"))

        logs[0].append(entries(stored.filter(part.isin(0, 1)), F.when(part == 0, "I").otherwise("U")))
        later = stored.filter(part.isin(2, 3)).withColumn(twin_key, F.when(part == 3, twin).otherwise(F.col(twin_key)))
        logs[1].append(entries(later, F.when(part == 3, "D").otherwise("U")))
    for k, parts in enumerate(logs):
        log = parts[0]
        for p in parts[1:]:
            log = log.unionByName(p)
        seq = F.monotonically_increasing_id() + F.lit(1 + (k << 52))
        when = F.lit(f"2026-01-0{6 + k} 05:00:00").cast(CHANGE_LOG_SCHEMA["logged_at"].dataType)
        (log.select(seq.alias("seq"), "tabname", "tabkey", "op", when.alias("logged_at"))
            .write.option("compression", "zstd").parquet(f"{folder}/log/window={k}"))
    read = [spark.read.schema(CHANGE_LOG_SCHEMA).parquet(*[f"{folder}/log/window={i}" for i in range(k)]) for k in (1, 2)]
    return [(moments[0], read[0].limit(0)), (moments[1], read[0]), (moments[2], read[1])]
