"""Provider industry labels and the buckets they are compatible with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_MAX_ROWS = 100_000
MAPPING_SCHEMA = "provider_label string, industry_bucket string, is_primary boolean, is_generic boolean"

# Label, then its buckets with the primary one first.
GENERIC_LABELS = {
    "Software Development": (
        "Software", "Developer Tools", "Data & Analytics", "Sales Tech", "Marketing Tech", "HR Tech",
    ),
    "Computer Software": (
        "Software", "Developer Tools", "Data & Analytics", "Sales Tech", "Marketing Tech", "HR Tech",
    ),
    "IT Services and IT Consulting": ("Developer Tools", "Software", "Data & Analytics"),
    "Information Technology & Services": ("Software", "Data & Analytics", "Developer Tools"),
    "Technology, Information and Internet": (
        "Software", "Data & Analytics", "Fintech", "E-commerce & Retail", "Media",
    ),
}
SPECIFIC_LABELS = {
    "Data Infrastructure and Analytics": "Data & Analytics",
    "Computer and Network Security": "Cybersecurity",
    "Financial Services": "Fintech",
    "Banking": "Fintech",
    "Hospitals and Health Care": "Healthcare",
    "Health, Wellness & Fitness": "Healthcare",
    "Biotechnology Research": "Healthcare",
    "Marketing Services": "Marketing Tech",
    "Advertising Services": "Marketing Tech",
    "Human Resources Services": "HR Tech",
    "Staffing and Recruiting": "HR Tech",
    "Retail": "E-commerce & Retail",
    "Internet Marketplace Platforms": "E-commerce & Retail",
    "Transportation, Logistics, Supply Chain and Storage": "Logistics",
    "Online Audio and Video Media": "Media",
    "Entertainment Providers": "Media",
    "Design Services": "Software",
}


def mapping_rows() -> list[tuple[str, str, bool, bool]]:
    generic = [
        (label, bucket, i == 0, True)
        for label, buckets in GENERIC_LABELS.items()
        for i, bucket in enumerate(buckets)
    ]
    return generic + [(label, bucket, True, False) for label, bucket in SPECIFIC_LABELS.items()]


def default_mapping(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(mapping_rows(), MAPPING_SCHEMA)


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """A mapping kept as a CSV file with a header."""
    return spark.read.schema(MAPPING_SCHEMA).csv(path, header=True, quote='"', escape='"')


def label_lookup(mapping: DataFrame) -> DataFrame:
    """One row per label: its primary bucket, whether it is generic, and all of its buckets.

    The bucket list holds one entry per distinct bucket, so it is as short as the taxonomy.
    """
    return mapping.groupBy("provider_label").agg(
        F.min(F.when(F.col("is_primary"), F.col("industry_bucket"))).alias("enriched_industry"),
        F.coalesce(F.bool_or("is_generic"), F.lit(False)).alias("label_is_generic"),
        F.collect_set("industry_bucket").alias("label_buckets"),
    )


def is_small(mapping: DataFrame) -> bool:
    """Whether a mapping may be broadcast: it is counted, up to `BROADCAST_MAX_ROWS` rows."""
    return mapping.limit(BROADCAST_MAX_ROWS + 1).count() <= BROADCAST_MAX_ROWS
