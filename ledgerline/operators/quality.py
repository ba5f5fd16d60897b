"""Data-quality checks. Each returns a DataFrame of violations: empty means the check passes.

All are single aggregations or anti joins; none collects data to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values of ``column`` that occur more than once (nulls are not checked)."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column)
              .agg(F.count(F.lit(1)).alias("occurrences")).filter(F.col("occurrences") > 1))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Each value of ``column`` outside ``values``, with its count (nulls pass)."""
    return (df.filter(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))
              .groupBy(column).agg(F.count(F.lit(1)).alias("occurrences")))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str
                  ) -> DataFrame:
    """Child rows whose non-null ``column`` has no match in ``parent.parent_column``."""
    keys = parent.select(F.col(parent_column).alias("__parent_key")).distinct()
    return (child.filter(F.col(column).isNotNull())
                 .join(keys, F.col(column) == F.col("__parent_key"), "left_anti"))


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations of ``columns`` that appear more than once."""
    return (df.groupBy(*columns).agg(F.count(F.lit(1)).alias("occurrences"))
              .filter(F.col("occurrences") > 1))


def primary_key(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows violating a declared primary key: a null key column, or a duplicated key."""
    null_key = F.lit(False)
    for c in columns:
        null_key = null_key | F.col(c).isNull()
    nulls = (df.filter(null_key).groupBy(*columns).agg(F.count(F.lit(1)).alias("occurrences"))
               .withColumn("violation", F.lit("null_key")))
    dups = unique_combination(df.filter(~null_key), columns).withColumn("violation",
                                                                          F.lit("duplicate_key"))
    return nulls.unionByName(dups)


def contract_violations(df: DataFrame, contract: T.StructType) -> list[str]:
    """Names/types that differ from a declared contract (exact order, names and types)."""
    problems = []
    actual = [(f.name, f.dataType) for f in df.schema.fields]
    expected = [(f.name, f.dataType) for f in contract.fields]
    if [n for n, _ in actual] != [n for n, _ in expected]:
        problems.append(f"columns {[n for n, _ in actual]} != {[n for n, _ in expected]}")
    for (n, t), (en, et) in zip(actual, expected):
        if n == en and t != et:
            problems.append(f"{n}: {t.simpleString()} != {et.simpleString()}")
    return problems


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Return ``df`` unchanged if it matches ``contract``, else raise with the differences."""
    problems = contract_violations(df, contract)
    if problems:
        raise ValueError("contract violated: " + "; ".join(problems))
    return df

