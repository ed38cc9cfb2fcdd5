"""Raw text tables to typed, standardised tables. Every row is kept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterforge.config import Config
from rosterforge.functions import text as tx
from rosterforge.functions.dates import is_older_than
from rosterforge.functions.numbers import int_from_text


def _is_true(column: str):
    # the word 'True' exactly; a boolean cast would also take '1', 't' or 'yes'
    return (F.col(column) == "True").alias(column)


def standardize_accounts(raw: DataFrame) -> DataFrame:
    return raw.select(
        "account_id",
        F.trim("company_name").alias("company_name"),
        tx.normalize_domain(F.col("domain"), "staging").alias("domain"),
        "seed_industry",
        F.upper(F.trim("hq_country")).alias("hq_country"),
        _is_true("is_real_domain"),
        "source",
        F.col("source_updated_at").cast("date").alias("source_updated_at"),
        _is_true("sim_hiring_data_roles"),
        int_from_text(F.col("sim_months_since_funding")).alias("sim_months_since_funding"),
        _is_true("sim_tech_stack_match"),
    )


def standardize_contacts(raw: DataFrame, cfg: Config) -> DataFrame:
    first, last = F.trim("first_name"), F.trim("last_name")
    updated = F.col("source_updated_at").cast("date")
    # worked out once per row, ahead of the many rules that look at them
    prepared = raw.withColumns({
        "_email": tx.normalize_email(F.col("email")),
        "_title": F.lower(tx.expand_title(F.col("title"))),
    })
    email, title = F.col("_email"), F.col("_title")
    return prepared.select(
        "contact_id",
        "account_id",
        first.alias("first_name"),
        last.alias("last_name"),
        F.concat(first, F.lit(" "), last).alias("full_name"),
        F.col("email").alias("email_raw"),
        email.alias("email"),
        tx.is_valid_email(email).alias("is_valid_email"),
        tx.blank_to_null(F.trim("title")).alias("title_raw"),
        tx.title_case(title).alias("title"),
        tx.seniority(title).alias("seniority"),
        tx.department(title).alias("department"),
        updated.alias("source_updated_at"),
        is_older_than(updated, cfg.reference_date, cfg.stale_contact_days).alias("is_stale"),
    )


def standardize_events(raw: DataFrame) -> DataFrame:
    return raw.select(
        "event_id", "contact_id", "event_type", F.col("event_ts").cast("timestamp_ntz").alias("event_ts")
    )
