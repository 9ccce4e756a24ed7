"""The star schema as a warehouse that grows load by load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import star
from ..operators.keys import extend_dimension
from ..sources.warehouse import LoadResult, load_by_date, read_loads


class StarWarehouse:
    """Dimensions with lasting keys and a fact in one folder a date and load, under ``base``."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def table(self, name: str) -> DataFrame | None:
        return read_loads(self.spark, f"{self.base}/{name}")

    @property
    def fact_path(self) -> str:
        return f"{self.base}/fact_transactions"

    def load(self, validated: DataFrame, metadata: DataFrame, load_id: str) -> LoadResult:
        """One load of validated rows: new members join their dimensions, then the load's own facts are built with
        the stored keys and brought in by date. Attributes of known wallets stay as first stored."""
        wallets = extend_dimension(f"{self.base}/dim_wallet", star.wallet_rows(validated, metadata), "wallet_address", "wallet_key")
        types = extend_dimension(f"{self.base}/dim_tx_type", star.tx_type_rows(validated), "tx_type", "tx_type_key", "int")
        networks = extend_dimension(f"{self.base}/dim_network", star.network_rows(validated), "network", "network_key", "int")
        fact = star.fact_transactions(validated, star.dim_date(validated), wallets, types, networks)
        return load_by_date(fact, self.fact_path, load_id)

    def dim_date(self) -> DataFrame:
        """Every day from the first to the last partition of the fact: only folder names are read."""
        days = self.table("fact_transactions").select(F.to_date(F.col("date_key").cast("string"), "yyyyMMdd").cast("timestamp_ntz").alias("timestamp"))
        return star.dim_date(days.distinct())
