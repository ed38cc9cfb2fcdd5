"""Batches of accounts for import into a provider."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterforge.config import Config
from rosterforge.operators.ranking import position_by_column

# The header a provider import expects.
EXPORT_COLUMNS = {"account_id": "Account ID", "company_name": "Company Name", "domain": "Domain"}


def export_batches(raw_accounts: DataFrame, cfg: Config) -> DataFrame:
    """Accounts with a real domain in id order, cut into batches of `batch_size` rows."""
    chosen = raw_accounts.filter(F.col("is_real_domain") == "True").select(*EXPORT_COLUMNS)
    placed = position_by_column(chosen, "account_id", "_pos")
    batch = F.floor(F.col("_pos") / F.lit(cfg.batch_size)).cast("bigint") + 1
    return placed.select(batch.alias("batch_no"), *[F.col(c).alias(n) for c, n in EXPORT_COLUMNS.items()])


def write_batches(batches: DataFrame, folder: str) -> None:
    """One folder per batch. Rows of a batch are brought together first, so it is one sorted file."""
    (
        batches.repartition("batch_no")
        .sortWithinPartitions("batch_no", "`Account ID`")
        .write.mode("overwrite")
        .partitionBy("batch_no")
        .csv(folder, header=True, quote='"', escape='"')
    )
