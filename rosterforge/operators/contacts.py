"""The clean contact dimension and the events that follow its survivors."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterforge.config import Config
from rosterforge.functions.text import persona
from rosterforge.operators.skew import hot_keys, join_many_to_one, salted_join


def dim_contact(
    deduped: DataFrame, accounts: DataFrame, cfg: Config, hot: Mapping[int, int] | None = None
) -> DataFrame:
    """Survivors with a valid email and a known account, and how many were merged into them.

    The merged ids are rows of `merged_links` and lists of `merged_ids`. `hot` are hot account
    ids, where they are known.
    """
    clean = deduped.filter(F.col("is_survivor") & F.col("is_valid_email"))
    ids = accounts.select("account_id").distinct()
    known = join_many_to_one(clean, ids, ["account_id"], "inner", "contact_id", cfg, hot)
    return known.select(
        "contact_id",
        "account_id",
        "first_name",
        "last_name",
        "full_name",
        "email",
        "title",
        "seniority",
        "department",
        persona(F.col("department"), F.col("seniority")).alias("persona"),
        F.col("title").isNull().alias("is_missing_title"),
        "is_stale",
        "possible_duplicate_of",
        (F.col("group_size") - 1).alias("merged_count"),
        "source_updated_at",
    )


def survivor_links(deduped: DataFrame, contacts: DataFrame, cfg: Config) -> DataFrame:
    """(contact_id, survivor_contact_id) for every raw contact whose survivor is clean."""
    links = deduped.filter("is_valid_email").select("contact_id", "survivor_contact_id", "group_size")
    # one row per survivor carries the size of its group, which is how often it is linked to
    sizes = links.filter("contact_id = survivor_contact_id").drop("contact_id")
    hot = hot_keys(sizes, ["survivor_contact_id"], "group_size", cfg)
    clean = contacts.select(F.col("contact_id").alias("survivor_contact_id"))
    return salted_join(
        links.drop("group_size"), clean, ["survivor_contact_id"], "left_semi", hot, "contact_id"
    ).select("contact_id", "survivor_contact_id")


def repoint_events(events: DataFrame, links: DataFrame, cfg: Config) -> DataFrame:
    """Events moved to the surviving contact; events of dropped contacts are left out."""
    return join_many_to_one(events, links, ["contact_id"], "inner", "event_id", cfg).select(
        "event_id", F.col("survivor_contact_id").alias("contact_id"), "event_type", "event_ts"
    )
