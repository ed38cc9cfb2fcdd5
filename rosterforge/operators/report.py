"""Tables behind the data-quality report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterforge.config import Config
from rosterforge.functions.mapping import is_small, label_lookup
from rosterforge.operators.resolve import join_labels

# Findings about providers, in report order.
PROVIDER_CHECKS = (
    "suspected_wrong_entity", "country_conflict", "industry_conflict", "headcount_band_mismatch",
)


def provider_findings(failures: DataFrame, accounts: DataFrame, provider: str = "clay") -> DataFrame:
    """Disagreements in one provider's data, worst kind first."""
    order = F.array_position(F.array(*[F.lit(c) for c in PROVIDER_CHECKS]), F.col("check_name"))
    names = accounts.filter(F.col("enrichment_status") == provider).select(
        F.col("account_id").alias("record_id"), "company_name"
    )
    return (
        failures.filter(F.col("check_name").isin(*PROVIDER_CHECKS))
        .join(names, "record_id")
        .orderBy(order, "company_name", "detail")
        .select("check_name", "company_name", "detail")
    )


def industry_rule_mix(accounts: DataFrame) -> DataFrame:
    return (
        accounts.groupBy("enrichment_status", "industry_rule")
        .agg(F.count(F.lit(1)).alias("accounts"))
        .orderBy("enrichment_status", F.desc("accounts"), "industry_rule")
    )


def headline_counts(raw_contacts: DataFrame, contacts: DataFrame, accounts: DataFrame) -> DataFrame:
    """Row counts for the top of the report, on one line."""
    def tagged(df: DataFrame, name: str, status=F.lit(None).cast("string")) -> DataFrame:
        return df.select(F.lit(name).alias("_t"), status.alias("_s"))

    rows = (
        tagged(raw_contacts, "raw").unionAll(tagged(contacts, "clean"))
        .unionAll(tagged(accounts, "account", F.col("enrichment_status")))
    )
    return rows.agg(
        F.count_if(F.col("_t") == "raw").alias("raw_contacts"),
        F.count_if(F.col("_t") == "clean").alias("clean_contacts"),
        F.count_if(F.col("_t") == "account").alias("accounts"),
        F.count_if(F.col("_s") == "clay").alias("enriched_clay"),
        F.count_if(F.col("_s") == "missing").alias("missing_enrichment"),
    )


def strict_conflicts(resolved: DataFrame, mapping: DataFrame, manifest: DataFrame, cfg: Config) -> DataFrame:
    """Accounts that a mapping without the generic-label exception would override.

    `was_planted` tells a planted error apart from a correct seed that would be overwritten.
    Conflicts the normal rule finds as well are left out unless they were planted.
    """
    labels = label_lookup(mapping).select(
        F.col("provider_label").alias("industry_label"), F.col("label_buckets").alias("_buckets")
    )
    planted = (
        manifest.filter("error_type = 'conflicting_industry'")
        .select(F.col("record_id").alias("account_id"), F.lit(True).alias("_planted"))
        .distinct()
    )
    fits = F.coalesce(F.array_contains("_buckets", F.col("seed_industry")), F.lit(False))
    return (
        resolved.select("account_id", "company_name", "enrichment_provider", "industry_label", "seed_industry",
                        "has_industry_conflict")
        .transform(join_labels, labels, is_small(mapping), "inner", cfg)
        .filter(~fits)
        .join(planted, "account_id", "left")
        .withColumn("was_planted", F.coalesce("_planted", F.lit(False)))
        .filter("was_planted or not has_industry_conflict")
        .select("account_id", "company_name", "enrichment_provider", "was_planted")
    )


def strict_tradeoff(conflicts: DataFrame, provider: str = "clay") -> DataFrame:
    """Planted conflicts a strict mapping would find, and correct seeds it would overwrite.

    The companies behind the second number are the rows of `strict_overridden`.
    """
    overridden = ~F.col("was_planted") & (F.col("enrichment_provider") == provider)
    return conflicts.agg(
        F.count_if("was_planted").alias("planted_caught"), F.count_if(overridden).alias("false_overrides")
    )


def strict_overridden(conflicts: DataFrame, provider: str = "clay") -> DataFrame:
    """The companies behind `false_overrides`, one row each, in name order."""
    return (
        conflicts.filter(~F.col("was_planted") & (F.col("enrichment_provider") == provider))
        .select("company_name")
        .orderBy("company_name")
    )
