"""Stage compositions: ingest -> process -> star, as lazy DataFrame functions.

``Ledger`` holds one run's stage outputs. Stage boundaries that several later jobs read
(clean, validated) are written as Parquet stage tables in the shared checkpoint folder, the
counterpart of the Parquet files the reference writes between stages: later multi-pass
operators (median, global statistics, distributed ranks) re-read only the columns they need
instead of recomputing the dedupe shuffle, and lost executors do not force a recompute from
the raw scan.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators import star
from ..operators.clean import clean_transactions, dedupe_first, enrich_with_metadata
from ..operators.features import add_features
from ..operators.normalize import scale_and_flag
from ..operators.quality import split_valid
from ..session import counted_stage_table, stage_table, work_dir
from ..sources.io import write_by_date
from ..sources.ledger_views import load_ledger

CODEC = "zstd"                  # half the bytes of the ledger's hex digits, which snappy leaves as they are


def ingest(raw: DataFrame, wallets: DataFrame) -> DataFrame:
    """S -> C1..C4 -> J1 -> F1..F6."""
    return enrich_with_metadata(clean_transactions(raw), wallets).transform(add_features)


def score(valid: DataFrame) -> DataFrame:
    """N1, N2 and N3 over valid rows only (the reference's order), from one statistics scan."""
    return scale_and_flag(valid)


class Ledger:
    """Stage outputs for one data folder (or for given raw/wallet frames)."""

    def __init__(self, spark: SparkSession, sf_dir: str | None = None, raw: DataFrame | None = None,
                 wallets: DataFrame | None = None, checkpoint: bool = True):
        self.spark = spark
        if raw is None:
            raw, wallets = load_ledger(spark, sf_dir)
        self.raw = raw
        self.wallets = wallets
        self._checkpoint = checkpoint

    def _stage(self, df: DataFrame, name: str) -> DataFrame:
        return stage_table(df, name, CODEC) if self._checkpoint else df

    @cached_property
    def deduped(self) -> DataFrame:
        """C1 over the raw rows; written, since the median reads it several times."""
        return self._stage(dedupe_first(self.raw), "deduped-raw")

    @cached_property
    def _clean_counted(self) -> tuple[DataFrame, int | None]:
        df = ingest(self.raw, self.wallets)
        return counted_stage_table(df, "clean", CODEC) if self._checkpoint else (df, None)

    @property
    def clean(self) -> DataFrame:
        return self._clean_counted[0]

    @property
    def clean_rows(self) -> int | None:
        """Row count of the clean table, observed while it was written (None if not staged)."""
        return self._clean_counted[1]

    @cached_property
    def _split(self) -> tuple[DataFrame, DataFrame]:
        return split_valid(self.clean)

    @cached_property
    def _validated_counted(self) -> tuple[DataFrame, int | None]:
        df = score(self._split[0])
        return counted_stage_table(df, "validated", CODEC) if self._checkpoint else (df, None)

    @property
    def validated(self) -> DataFrame:
        return self._validated_counted[0]

    @property
    def validated_rows(self) -> int | None:
        return self._validated_counted[1]

    @property
    def invalid(self) -> DataFrame:
        return self._split[1]

    # star schema
    @cached_property
    def dim_date(self) -> DataFrame:
        return self._stage(star.dim_date(self.validated), "dim_date")

    @cached_property
    def dim_wallet(self) -> DataFrame:
        # a stage table, so Spark sees its real size when it plans the fact's wallet joins
        return self._stage(star.dim_wallet(self.validated, self.wallets), "dim_wallet")

    @cached_property
    def dim_tx_type(self) -> DataFrame:
        return self._stage(star.dim_tx_type(self.validated), "dim_tx_type")

    @cached_property
    def dim_network(self) -> DataFrame:
        return self._stage(star.dim_network(self.validated), "dim_network")

    @cached_property
    def fact(self) -> DataFrame:
        """The persisted fact, partitioned by date: Q and V queries scan its pruned columns and join no
        wallets again."""
        fact = star.fact_transactions(self.validated, self.dim_date, self.dim_wallet,
                                      self.dim_tx_type, self.dim_network)
        if not self._checkpoint:
            return fact
        path = work_dir(self.spark, "stage-fact")
        write_by_date(fact, path)
        return self.spark.read.parquet(path)

    # 3NF
    @cached_property
    def wallets_3nf(self) -> DataFrame:
        return star.wallets_table(self.dim_wallet)

    @cached_property
    def blocks_3nf(self) -> DataFrame:
        return star.blocks_table(self.validated)

    @cached_property
    def transactions_3nf(self) -> DataFrame:
        return self._stage(star.transactions_table(self.validated, self.wallets_3nf), "transactions")
