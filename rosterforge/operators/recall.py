"""How many of the planted errors the checks found."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterforge.functions.numbers import pct

# The check that must find each kind of planted error.
EXPECTED_CHECK = {
    "invalid_email": "invalid_email",
    "missing_title": "missing_title",
    "stale_record": "stale_contact",
    "orphan_contact": "orphan_contact",
    "duplicate_contact": "duplicate_contact",
    "conflicting_industry": "industry_conflict",
}


def planted_detail(manifest: DataFrame, failures: DataFrame, resolved: DataFrame) -> DataFrame:
    """Each planted error with the check expected to find it, and whether it did.

    A planted industry is only detectable where the provider returned a specific label.
    """
    expected = F.lit(None).cast("string")
    for kind, check in EXPECTED_CHECK.items():
        expected = F.when(F.col("error_type") == kind, check).otherwise(expected)
    is_industry = F.col("error_type") == "conflicting_industry"
    planted = manifest.select(
        "error_id", "error_type", "record_id", "field", "original_value", "planted_value",
        expected.alias("expected_check"),
    )
    # a manifest is small beside the tables: only its records are looked at
    ids = planted.select("record_id").distinct()
    labels = resolved.select(
        F.col("account_id").alias("record_id"),
        F.col("industry_label").alias("_label"),
        "label_is_generic",
    ).join(ids, "record_id", "left_semi")
    found = failures.join(ids, "record_id", "left_semi").select(
        F.col("check_name").alias("expected_check"), "record_id", F.lit(True).alias("_found")
    ).distinct()
    label = F.col("_label")
    return (
        # every record id takes part, so rows without a label do not pile up on a missing key
        planted.join(labels, "record_id", "left")
        .join(found, ["expected_check", "record_id"], "left")
        .select(
            *planted.columns,
            F.when(is_industry, label).alias("enrichment_industry_label"),
            F.when(
                is_industry, label.isNotNull() & ~F.coalesce("label_is_generic", F.lit(False))
            ).alias("is_detectable"),
            F.coalesce("_found", F.lit(False)).alias("was_caught"),
        )
    )


def planted_vs_caught(detail: DataFrame) -> DataFrame:
    """Recall per kind, and over the errors the data could reveal at all."""
    caught, visible = F.col("was_caught"), F.coalesce("is_detectable", F.lit(True))
    return (
        detail.groupBy("error_type", "expected_check")
        .agg(
            F.count(F.lit(1)).alias("planted"),
            F.count_if(caught).alias("caught"),
            F.count_if(~caught).alias("missed"),
            F.count_if(visible).alias("detectable"),
        )
        .select(
            "error_type", "expected_check", "planted", "caught", "missed",
            pct(F.col("caught"), F.col("planted")).alias("recall_pct"),
            "detectable",
            pct(F.col("caught"), F.nullif(F.col("detectable"), F.lit(0))).alias("detectable_recall_pct"),
        )
        .orderBy(F.asc_nulls_last("recall_pct"), "error_type")
    )


def missed_by_rules(detail: DataFrame) -> DataFrame:
    """Planted errors a deterministic check should have found and did not; must be empty."""
    return detail.filter("expected_check <> 'industry_conflict' and not was_caught")


def missed_detectable(detail: DataFrame) -> DataFrame:
    """Detectable industry conflicts that were not found; must be empty."""
    return detail.filter("expected_check = 'industry_conflict' and is_detectable and not was_caught")
