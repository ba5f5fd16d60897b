"""Readers for the ERP source tables and the change log, always with a declared schema.

Every source field is a character string and "missing" is ``''``, never null, in live rows:
CSV readers must keep empty fields as ``''`` (``emptyValue``) and must not turn them into null.
JDBC reads can be split across executors by a numeric partition column or explicit predicates
(e.g. one per document-number range), so no single task reads a whole table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.schemas import CHANGE_LOG_SCHEMA, TABLES


def read_parquet(spark: SparkSession, table: str, path: str) -> DataFrame:
    return spark.read.schema(TABLES[table].source_schema).parquet(path)


def read_csv(spark: SparkSession, table: str, path: str, header: bool = True) -> DataFrame:
    """CSV with the declared all-string schema; empty fields stay ``''``.

    The CSV reader returns null for an unquoted empty field; source columns are never null
    (``NOT NULL DEFAULT ''``), so a null can only be an empty field and is mapped back to ''.
    """
    spec = TABLES[table]
    df = (spark.read.schema(spec.source_schema)
          .option("header", header).option("emptyValue", "").option("mode", "FAILFAST").csv(path))
    return df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in spec.fields])


def read_jdbc(spark: SparkSession, table: str, url: str, properties: dict,
              predicates: Sequence[str] | None = None) -> DataFrame:
    """A source table over JDBC, one partition per predicate (e.g. document-number ranges).
    The declared all-string schema is enforced on the result."""
    spec = TABLES[table]
    cols = ", ".join(spec.fields)
    query = f"(SELECT {cols} FROM {table.upper()}) src"
    if predicates:
        df = spark.read.jdbc(url, query, predicates=list(predicates), properties=properties)
    else:
        df = spark.read.jdbc(url, query, properties=properties)
    return df.select(*[F.col(c.upper() if c.upper() in df.columns else c).cast("string").alias(c)
                       for c in spec.fields])


def read_change_log(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The change log (``seq, tabname, tabkey, op, logged_at``) with its declared schema."""
    reader = spark.read.schema(CHANGE_LOG_SCHEMA)
    if fmt == "csv":
        return reader.option("header", True).option("mode", "FAILFAST").csv(path)
    return reader.format(fmt).load(path)
