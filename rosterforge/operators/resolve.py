"""Account attributes: seed and provider values resolved field by field, with the rule that decided."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterforge.config import Config
from rosterforge.functions.mapping import is_small, label_lookup
from rosterforge.operators.skew import join_many_to_one


def join_enrichment(accounts: DataFrame, enrichment: DataFrame) -> DataFrame:
    """Accounts with their newest enrichment; both sides have one row per account."""
    e = enrichment.select(
        "account_id",
        F.lit(True).alias("has_enrichment"),
        F.col("provider").alias("enrichment_provider"),
        "enriched_at",
        "is_stale_enrichment",
        "industry_label",
        "employee_count",
        F.col("hq_country").alias("enriched_country"),
        "founded_year",
        "size_band",
        "size_min",
        "size_max",
        "description",
        "matched_name",
    )
    return accounts.join(e, "account_id", "left").withColumn(
        "has_enrichment", F.coalesce("has_enrichment", F.lit(False))
    )


def join_labels(df: DataFrame, labels: DataFrame, small: bool, how: str, cfg: Config) -> DataFrame:
    """Rows of accounts with what is known of their label; frequent and missing labels are salted
    where the label table is too large to be broadcast."""
    if small:
        return df.join(F.broadcast(labels), "industry_label", how)
    return join_many_to_one(df, labels, ["industry_label"], how, "account_id", cfg)


def lookup_labels(df: DataFrame, mapping: DataFrame, cfg: Config) -> DataFrame:
    """What the mapping says about each row's label, from one join with one row per label."""
    labels = label_lookup(mapping).withColumnRenamed("provider_label", "industry_label")
    generic = F.coalesce("label_is_generic", F.lit(False))
    mapped = F.col("label_buckets").isNotNull()
    fits = mapped & (generic | F.coalesce(F.array_contains("label_buckets", F.col("seed_industry")), F.lit(False)))
    return (
        join_labels(df, labels, is_small(mapping), "left", cfg)
        .withColumns(
            {"label_is_mapped": mapped, "label_is_generic": generic, "seed_industry_compatible": fits}
        )
        .drop("label_buckets")
    )


def resolve_industry(df: DataFrame) -> DataFrame:
    """A specific label that contradicts the seed wins; blank, unknown and generic labels do not."""
    blank = F.col("industry_label").isNull()
    mapped, fits = F.col("label_is_mapped"), F.col("seed_industry_compatible")
    conflict = ~blank & mapped & ~fits
    rule = (
        F.when(~F.col("has_enrichment"), "seed_only_no_enrichment")
        .when(blank, "seed_only_provider_blank")
        .when(~mapped, "seed_kept_label_unmapped")
        .when(F.col("label_is_generic"), "seed_kept_generic_label")
        .when(fits, "seed_kept_compatible")
        .otherwise("enrichment_overrides_conflict")
    )
    return df.withColumns({
        "industry": F.when(conflict, F.col("enriched_industry")).otherwise(F.col("seed_industry")),
        "industry_rule": rule,
        "has_industry_conflict": conflict,
    })


def resolve_country(df: DataFrame) -> DataFrame:
    """The curated seed wins and enrichment fills gaps; a disagreement is flagged."""
    return df.withColumns({
        "country": F.coalesce("hq_country", "enriched_country"),
        "has_country_conflict": F.coalesce(F.col("hq_country") != F.col("enriched_country"), F.lit(False)),
    })


def headcount_plausibility(df: DataFrame) -> DataFrame:
    """Headcount against the provider's own band: ten times outside it is another company."""
    n = F.col("employee_count").cast("double")
    low, high = F.col("size_min").cast("double"), F.col("size_max").cast("double")

    def outside(times: int):
        return (n < low / times) | (high.isNotNull() & (n > high * times))

    return df.withColumns({
        "is_suspected_wrong_entity": F.coalesce(outside(10), F.lit(False)),
        "has_headcount_band_mismatch": F.coalesce(outside(2) & ~outside(10), F.lit(False)),
    })


def resolve_accounts(accounts: DataFrame, enrichment: DataFrame, mapping: DataFrame, cfg: Config) -> DataFrame:
    joined = lookup_labels(join_enrichment(accounts, enrichment), mapping, cfg)
    return headcount_plausibility(resolve_country(resolve_industry(joined)))


def conflict_log(resolved: DataFrame) -> DataFrame:
    """One row per (account, field) in disagreement, from a single pass over the accounts."""

    def entry(flag: str, field: str, seed: str, provider: str, kept: str, rule):
        return F.when(
            F.col(flag),
            F.struct(
                F.lit(field).alias("field"),
                F.col(seed).alias("seed_value"),
                F.col(provider).alias("enrichment_value"),
                F.col(kept).alias("resolved_value"),
                rule.alias("resolution_rule"),
            ),
        )

    entries = F.array(
        entry("has_industry_conflict", "industry", "seed_industry", "industry_label", "industry",
              F.col("industry_rule")),
        entry("has_country_conflict", "hq_country", "hq_country", "enriched_country", "country",
              F.lit("seed_wins_curated_source")),
    )
    return (
        resolved.filter("has_industry_conflict or has_country_conflict")
        .select("account_id", "company_name", "enrichment_provider",
                F.explode(F.array_compact(entries)).alias("c"))
        .select("account_id", "company_name", "c.*", "enrichment_provider")
    )


def dim_account(resolved: DataFrame) -> DataFrame:
    return resolved.select(
        "account_id",
        "company_name",
        "domain",
        "is_real_domain",
        "industry",
        F.col("industry_label").alias("provider_industry_label"),
        "industry_rule",
        "country",
        "employee_count",
        "size_band",
        "founded_year",
        "description",
        F.when(F.col("has_enrichment"), F.col("enrichment_provider")).otherwise("missing").alias(
            "enrichment_status"
        ),
        "enriched_at",
        F.coalesce("is_stale_enrichment", F.lit(False)).alias("is_stale_enrichment"),
        "has_industry_conflict",
        "has_country_conflict",
        "is_suspected_wrong_entity",
        "has_headcount_band_mismatch",
        "sim_hiring_data_roles",
        "sim_months_since_funding",
        "sim_tech_stack_match",
    )
