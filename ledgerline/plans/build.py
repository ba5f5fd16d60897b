"""The daily build: bronze -> shared silver tables -> gold tables -> data-quality checks.

Silver models that several gold models share are written once. Gold models are tables (full
refresh): each is written aside, its contract and declared constraints are checked there, and only
then it takes the place of the old one; a table that breaks a constraint is not published and the
old one stays. Downstream models read the written tables, like a dbt ``ref`` to a table. Checks are
one job per model, submitted concurrently from a small driver thread pool.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators import quality
from ledgerline.plans import checks
from ledgerline.schemas import GOLD_CONTRACTS, GOLD_NOT_NULL, GOLD_PRIMARY_KEYS

# Independent gold models, level by level (a level only reads earlier levels).
GOLD_LEVELS = (
    ("dim_customer", "dim_customer_history", "dim_material", "fct_sales_order_items",
     "fct_billing_items"),
    ("fct_order_fulfillment", "agg_daily_sales"),
)
# Silver models read by more than one gold model or check.
SHARED_SILVER = ("stg_sales_orders", "stg_billing_documents", "stg_billing_items",
                 "stg_sales_order_items")


class ConstraintViolated(ValueError):
    """A declared constraint does not hold, so the table was not published."""


def write_table(df: DataFrame, path: str, primary_key: tuple[str, ...] = (),
                required: tuple[str, ...] = ()) -> None:
    """Full refresh of a table directory: write aside, check the constraints there, then swap.

    The old table is renamed aside, the new one renamed into place, and the old one deleted; if the
    second rename fails, the old one is put back.
    """
    from ledgerline.sources.bronze import _fs, _path, fs_delete
    spark = df.sparkSession
    mark = uuid.uuid4().hex[:8]
    staging, aside = f"{path}.staging-{mark}", f"{path}.old-{mark}"
    df.write.mode("errorifexists").parquet(staging)
    tests = [("not_null", c) for c in required] + ([("primary_key", primary_key)] if primary_key else [])
    broken = {k: n for k, n in count_violations(spark.read.schema(df.schema).parquet(staging), tests).items() if n}
    if broken:
        fs_delete(spark, staging)
        raise ConstraintViolated(f"{path}: {broken}")
    fs, target = _fs(spark, path)
    fs.mkdirs(target.getParent())
    had = fs.exists(target)
    if had and not fs.rename(target, _path(spark, aside)):
        raise RuntimeError(f"moving {path} aside failed")
    if not fs.rename(_path(spark, staging), target):
        if had:
            fs.rename(_path(spark, aside), target)
        raise RuntimeError(f"publishing {staging} -> {path} failed")
    if had:
        fs_delete(spark, aside)


def store_shared(lh, out_root: str, names=SHARED_SILVER, parallelism: int = 4) -> None:
    """Write the silver models that several gold models and checks read, one concurrent job per
    model; from now on they are read from there."""
    spark = lh.spark
    plans = {n: lh.model(n) for n in names}
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        list(pool.map(lambda n: write_table(plans[n], f"{out_root}/_silver/{n}"), names))
    for n in names:
        lh.use_table(n, spark.read.schema(plans[n].schema).parquet(f"{out_root}/_silver/{n}"))


@dataclass
class Built:
    tables: dict[str, str] = field(default_factory=dict)
    rejected: dict[str, str] = field(default_factory=dict)


def build_gold(lh, out_root: str, levels=GOLD_LEVELS, parallelism: int = 4) -> Built:
    """Write the gold tables below ``out_root``: the published ones, and why others were rejected.

    Models of one dependency level are independent and written as concurrent Spark jobs; the
    next level then reads the written tables.
    """
    spark = lh.spark
    built = Built()
    for level in levels:
        # plans are built on the calling thread (the memo is not shared across threads)
        plans = {name: quality.conform(lh.model(name), GOLD_CONTRACTS[name]) for name in level}

        def write(name: str) -> str | None:
            try:
                write_table(plans[name], f"{out_root}/{name}", GOLD_PRIMARY_KEYS[name], GOLD_NOT_NULL[name])
            except ConstraintViolated as e:
                return str(e)
            return None

        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            problems = dict(zip(level, pool.map(write, level)))
        for name, problem in problems.items():
            if problem:
                built.rejected[name] = problem
            else:
                built.tables[name] = f"{out_root}/{name}"
                # downstream models read the written table from now on
                lh.use_table(name, spark.read.schema(GOLD_CONTRACTS[name]).parquet(built.tables[name]))
    return built


# Fixed values, the models' declared tests: (model, kind, argument). Kinds: unique / not_null (column),
# accepted (column, values), relationships (column, parent model, parent column),
# unique_combination (columns).
DATA_TESTS: tuple[tuple, ...] = (
    ("stg_currency_decimals", "unique", "currency_code"),
    ("stg_currency_decimals", "not_null", "currency_code"),
    ("stg_customer_events", "accepted", ("_op", ("I", "U", "D"))),
    ("stg_customers", "unique", "customer_id"),
    ("stg_customers", "not_null", "customer_id"),
    ("stg_materials", "unique", "material_id"),
    ("stg_materials", "not_null", "material_id"),
    ("stg_material_texts", "unique_combination", ("material_id", "language_key")),
    ("stg_sales_orders", "unique", "order_id"),
    ("stg_sales_orders", "not_null", "order_id"),
    ("stg_sales_orders", "not_null", "net_value"),
    ("stg_sales_order_items", "unique_combination", ("order_id", "item_number")),
    ("stg_sales_order_items", "relationships", ("order_id", "stg_sales_orders", "order_id")),
    ("stg_deliveries", "unique", "delivery_id"),
    ("stg_deliveries", "not_null", "delivery_id"),
    ("stg_delivery_items", "unique_combination", ("delivery_id", "item_number")),
    ("stg_billing_documents", "unique", "billing_id"),
    ("stg_billing_documents", "not_null", "billing_id"),
    ("stg_billing_items", "unique_combination", ("billing_id", "item_number")),
    ("stg_billing_items", "not_null", "currency_code"),
    ("dim_customer", "unique", "customer_id"),
    ("dim_customer", "accepted", ("country_code", ("PT", "ES", "DE", "FR", "GB", "US", "JP", "KW"))),
    ("dim_customer_history", "unique", "customer_version_key"),
    ("dim_material", "unique", "material_id"),
    ("dim_material", "accepted", ("material_type", ("FERT", "HAWA"))),
    ("dim_material", "not_null", "base_unit"),
    ("fct_sales_order_items", "unique", "order_item_key"),
    ("fct_sales_order_items", "relationships", ("customer_id", "dim_customer", "customer_id")),
    ("fct_sales_order_items", "relationships", ("material_id", "dim_material", "material_id")),
    ("fct_sales_order_items", "not_null", "order_type"),
    ("fct_sales_order_items", "not_null", "net_value_eur"),
    ("fct_sales_order_items", "accepted", ("overall_status", ("A", "B", "C"))),
    ("fct_billing_items", "unique", "billing_item_key"),
    ("fct_billing_items", "not_null", "billing_type_name"),
    ("fct_billing_items", "relationships", ("customer_id", "dim_customer", "customer_id")),
    ("fct_billing_items", "not_null", "net_value_eur"),
    ("fct_order_fulfillment", "unique", "order_item_key"),
    ("fct_order_fulfillment", "not_null", "fulfillment_status"),
    ("fct_order_fulfillment", "accepted",
     ("fulfillment_status", ("open", "in_delivery", "shipped", "invoiced", "rejected"))),
    ("agg_daily_sales", "unique_combination", ("sales_date", "sales_org")),
)


def model_tests() -> dict[str, list[tuple]]:
    """Per model its tests: the declared ones, then the contract's primary key and not-null columns."""
    out: dict[str, list[tuple]] = {}
    for model, kind, arg in DATA_TESTS:
        out.setdefault(model, []).append((kind, arg))
    for model, columns in GOLD_PRIMARY_KEYS.items():
        out.setdefault(model, []).append(("constraint.primary_key", columns))
    for model, columns in GOLD_NOT_NULL.items():
        out.setdefault(model, []).extend(("constraint.not_null", c) for c in columns)
    return out


def label(kind: str, arg) -> str:
    if kind.endswith("primary_key"):
        return kind
    return f"{kind}.{arg if isinstance(arg, str) else '+'.join(arg) if kind == 'unique_combination' else arg[0]}"


def violation_counts(df: DataFrame, tests: list[tuple], parent=None) -> DataFrame:
    """(check, n): violations of all ``tests`` of one model. One pass counts what rows show by
    themselves, one grouping per key serves every test of that key, one anti join each relation."""
    columns, keys, parts = {}, {}, []
    for kind, arg in tests:
        name = label(kind, arg)
        if kind.endswith("not_null"):
            columns[name] = F.count(F.when(F.col(arg).isNull(), 1))
        elif kind == "accepted":
            bad = F.col(arg[0]).isNotNull() & ~F.col(arg[0]).isin(list(arg[1]))
            columns[name] = F.count_distinct(F.when(bad, F.col(arg[0])))
        elif kind == "relationships":
            lost = quality.relationships(df, arg[0], parent(arg[1]), arg[2])
            parts.append(lost.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("check"), "n"))
        else:
            keys.setdefault((arg,) if isinstance(arg, str) else tuple(arg), []).append((kind, name))

    def stacked(one_row: DataFrame, names: list[str]) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(n).alias("check"), F.col(f"`{n}`").alias("n")) for n in names])
        return one_row.select(F.explode(pairs).alias("x")).select("x.check", "x.n")

    if columns:
        parts.append(stacked(df.agg(*[c.alias(n) for n, c in columns.items()]), list(columns)))
    for key, wanted in keys.items():
        some_null = F.lit(False)
        for c in key:
            some_null = some_null | F.col(c).isNull()
        groups = df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).withColumns(
            {"null": some_null, "twice": F.col("rows") > 1})
        count = {
            "unique": F.count(F.when(F.col("twice") & ~F.col("null"), 1)),
            "unique_combination": F.count(F.when(F.col("twice"), 1)),
            "primary_key": F.count(F.when(F.col("null") | F.col("twice"), 1)),
        }
        parts.append(stacked(groups.agg(*[count[kind.removeprefix("constraint.")].alias(n) for kind, n in wanted]),
                             [n for _, n in wanted]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def count_violations(df: DataFrame, tests: list[tuple], parent=None) -> dict[str, int]:
    return {r["check"]: r["n"] for r in violation_counts(df, tests, parent).collect()} if tests else {}


def run_checks(lh, parallelism: int = 8) -> dict[str, int]:
    """Violation count per check: every data test, the two cross-model tests (reconciliation,
    over-billing) and the gold contracts' constraints. One job per model, submitted concurrently."""
    jobs = {model: violation_counts(lh.model(model), tests, lh.model) for model, tests in model_tests().items()}
    for name, df in (("billing_reconcile", checks.billing_reconcile(lh)), ("overbilling", checks.overbilling(lh))):
        jobs[name] = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit("").alias("check"), "n")

    def count(item: tuple[str, DataFrame]) -> dict[str, int]:
        model, df = item
        return {f"{model}.{r['check']}".rstrip("."): r["n"] for r in df.collect()}

    out: dict[str, int] = {}
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        for found in pool.map(count, jobs.items()):
            out |= found
    return out


def run_daily(lh, out_root: str) -> dict:
    """Store the shared silver models, build gold, then check it: the published tables, the rejected
    ones, the check results, and ``ok`` if nothing was rejected and no check found anything."""
    store_shared(lh, out_root)
    built = build_gold(lh, out_root)
    results = run_checks(lh)
    return {"tables": built.tables, "rejected": built.rejected, "checks": results,
            "ok": not built.rejected and not any(results.values())}
