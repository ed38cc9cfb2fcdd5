"""Provider enrichment: wide rows to account-matched field values and back to one row per account."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rosterforge.config import Config
from rosterforge.functions.dates import is_older_than
from rosterforge.functions.numbers import int_via_double, size_band_high, size_band_low
from rosterforge.functions.text import normalize_domain
from rosterforge.operators.skew import join_many_to_one

# The enrichment fields, in output order.
FIELDS = (
    "industry", "employee_count", "hq_country", "founded_year", "size_band", "description", "matched_name",
)
ROWS_A_TASK = 200_000  # matched rows that one task turns into a row per field, about


def match_accounts(wide: DataFrame, raw_accounts: DataFrame, cfg: Config) -> DataFrame:
    """Attach `record_id`, the account with the same domain, or NULL where there is none.

    The match runs on the wide rows, before they become one row per field, so the join moves a
    seventh of the rows. Two accounts with one domain both receive the enrichment. The rows have
    no id and may be exact copies, so those of a frequent (or missing) domain are told apart by
    their place in the files. By that place the matched rows are dealt evenly over tasks: one row
    per field is seven times as many to sort, and a compressed file or a frequent domain can hold
    very many.
    """
    accounts = raw_accounts.select(
        normalize_domain(F.col("domain"), "match").alias("domain_norm"),
        F.col("account_id").alias("record_id"),
    )
    wide = wide.withColumn("domain_norm", normalize_domain(F.col("domain"), "loader"))
    spread = wide.withColumn("_row", F.monotonically_increasing_id())
    matched = join_many_to_one(spread, accounts, ["domain_norm"], "left", "_row", cfg)
    parts = int(wide.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return matched.repartition(max(parts, math.ceil((cfg.most_rows or 0) / ROWS_A_TASK)), "_row").drop("_row")


def to_long(matched: DataFrame) -> DataFrame:
    """One row per (matched enrichment row, field); blank values are kept."""
    present = [f for f in FIELDS if f in matched.columns]
    return matched.unpivot(
        ["record_id", "provider", "source_file", "enriched_at"], present, "field", "value"
    ).select(
        "record_id",
        F.lit("account").alias("entity_type"),
        "field",
        "value",
        "provider",
        "source_file",
        "enriched_at",
        F.current_timestamp().alias("_loaded_at"),
    )


def enrichment_long(wide: DataFrame, raw_accounts: DataFrame, cfg: Config) -> DataFrame:
    return to_long(match_accounts(wide, raw_accounts, cfg))


def match_summary(long: DataFrame) -> DataFrame:
    """Values, unmatched values and distinct matched accounts per provider."""
    # one row per (provider, record) first, so a provider with most of the rows stays spread out
    per_record = long.groupBy("provider", "record_id").agg(F.count(F.lit(1)).alias("_values"))
    return per_record.groupBy("provider").agg(
        F.sum("_values").alias("n_values"),
        F.coalesce(F.sum(F.when(F.col("record_id").isNull(), F.col("_values"))), F.lit(0)).alias("n_unmatched"),
        F.count("record_id").alias("n_accounts"),
    )


def pivot_enrichment(long: DataFrame) -> DataFrame:
    """One row per (account, provider, file, date) with a column per field; unmatched rows drop out."""
    return (
        long.filter(F.col("record_id").isNotNull())
        .groupBy(F.col("record_id").alias("account_id"), "provider", "source_file", "enriched_at")
        .agg(*[F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in FIELDS])
        .withColumn("enriched_at", F.col("enriched_at").cast("date"))
    )


def latest_per_key(df: DataFrame, key: str, order: list) -> DataFrame:
    """First row per key. Spark keeps one row per key and task before the shuffle."""
    w = W.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def standardize_enrichment(long: DataFrame, cfg: Config) -> DataFrame:
    """Newest enrichment per account, typed. The file name settles equal dates and providers."""
    newest = latest_per_key(
        pivot_enrichment(long),
        "account_id",
        [F.desc_nulls_last("enriched_at"), F.asc_nulls_last("provider"), F.asc_nulls_last("source_file")],
    )
    return newest.select(
        "account_id",
        "provider",
        "source_file",
        "enriched_at",
        is_older_than(F.col("enriched_at"), cfg.reference_date, cfg.stale_enrichment_days).alias(
            "is_stale_enrichment"
        ),
        F.col("industry").alias("industry_label"),
        int_via_double(F.col("employee_count")).alias("employee_count"),
        F.upper(F.trim("hq_country")).alias("hq_country"),
        int_via_double(F.col("founded_year")).alias("founded_year"),
        "size_band",
        size_band_low(F.col("size_band")).alias("size_min"),
        size_band_high(F.col("size_band")).alias("size_max"),
        "description",
        "matched_name",
    )
