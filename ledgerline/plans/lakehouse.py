"""The model graph: bronze sources, seeds and memoised silver/gold models.

A ``Lakehouse`` owns a bronze accessor (fixtures, published Parquet batches, or any function
returning an event DataFrame per table) and builds each model once per instance, so one gold
plan that uses a silver model twice references the same logical subtree (the single-read rule of
the source project). Spark reuses an exchange only where both uses ask for the same columns, so
gold models read a source once by themselves where they can.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline import seeds
from ledgerline.sources import fixtures


class Lakehouse:
    def __init__(self, spark: SparkSession, bronze: Callable[[str], DataFrame],
                 scd2_bucket_width: int = 1 << 20):
        self.spark = spark
        self._bronze_fn = bronze
        self._memo: dict[str, DataFrame] = {}
        self._stored: set[str] = set()
        self.scd2_bucket_width = scd2_bucket_width

    # -- sources -------------------------------------------------------------------------------
    @classmethod
    def from_fixtures(cls, spark: SparkSession, sf_dir: str, materialize: bool = True,
                      rebuild: bool = False, **kw) -> Lakehouse:
        """Bronze tables derived from the TESTDATA parquet files (``bz_*`` fixtures).

        ``materialize`` (default) writes them once per input folder below the shared folder,
        as an extraction job would, and every model reads the written event tables; otherwise
        the derivations are planned inline into every query.
        """
        from ledgerline.schemas import TABLES, bronze_schema
        if not materialize:
            memo: dict[str, DataFrame] = {}
            return cls(spark, lambda t: fixtures.fixture(spark, sf_dir, f"bz_{t}", memo), **kw)
        if rebuild:
            fixtures.materialize_bronze(spark, sf_dir, list(TABLES), rebuild=True)

        def written(t: str) -> DataFrame:
            # a model's tables are derived when the model first reads them
            path = fixtures.materialize_bronze(spark, sf_dir, [t])[t]
            return spark.read.schema(bronze_schema(TABLES[t])).parquet(path)

        return cls(spark, written, **kw)

    @classmethod
    def from_bronze_root(cls, spark: SparkSession, root: str, **kw) -> Lakehouse:
        """Bronze tables published by ``sources.bronze.publish_batch`` below ``root``."""
        from ledgerline.sources.bronze import read_bronze
        return cls(spark, lambda t: read_bronze(spark, root, t), **kw)

    @staticmethod
    def derive(spark: SparkSession, sf_dir: str, tables) -> None:
        """Write the bronze tables that a query reads in one go: concurrently, each derivation once."""
        fixtures.materialize_bronze(spark, sf_dir, tables)

    def bronze(self, table: str) -> DataFrame:
        key = f"bronze:{table}"
        if key not in self._memo:
            self._memo[key] = self._bronze_fn(table)
        return self._memo[key]

    def seed(self, name: str) -> DataFrame:
        key = f"seed:{name}"
        if key not in self._memo:
            self._memo[key] = seeds.seed(self.spark, name)
        return self._memo[key]

    def use_table(self, name: str, df: DataFrame) -> None:
        """From now on, ``model(name)`` is this DataFrame (e.g. the written gold table)."""
        self._memo[name] = df
        self._stored.add(name)

    def is_stored(self, name: str) -> bool:
        """``model(name)`` is a written table, so reading it costs a scan and no joins."""
        return name in self._stored

    def store(self, columns: dict[str, tuple[str, ...]]) -> None:
        """Write models (these columns of them, or all if none are named) one after another to a folder below the shared
        one, to be read from there: the shuffle files of one go before the next is made, so the disk holds those of one."""
        from ledgerline.session import release, shared_dir
        folder = shared_dir(self.spark, "models")
        for name, some in columns.items():
            df = self.model(name).select(*some or "*")
            df.write.option("compression", "zstd").parquet(f"{folder}/{name}")
            self.use_table(name, self.spark.read.schema(df.schema).parquet(f"{folder}/{name}"))
            del df
            release(self.spark)

    def model(self, name: str) -> DataFrame:
        if name not in self._memo:
            from ledgerline.plans import gold, silver
            fn = getattr(silver, name, None) or getattr(gold, name)
            self._memo[name] = fn(self)
        return self._memo[name]

    # -- shared small relations ------------------------------------------------------------------
    def currency_factors(self) -> DataFrame:
        """``(__currency, __factor)``: exact amount factor per currency (one row per currency).

        The join strategy is left to Spark's size checks: the planner broadcasts it when its
        file-based size estimate is under ``spark.sql.autoBroadcastJoinThreshold`` and AQE
        re-checks the real size at run time; above the threshold it is a shuffle join.
        """
        if "currency_factors" not in self._memo:
            from ledgerline.functions.formats import amount_factor
            from pyspark.sql import functions as F
            dec = self.model("stg_currency_decimals")
            self._memo["currency_factors"] = dec.select(
                F.col("currency_code").alias("__currency"), amount_factor("currency_decimals").alias("__factor"))
        return self._memo["currency_factors"]
