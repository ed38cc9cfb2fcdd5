"""Record-level data-quality checks, the failure log and its summary."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterforge.config import Config
from rosterforge.functions.numbers import pct
from rosterforge.operators.skew import join_many_to_one

# Check, entity, severity, action; in report order.
CHECKS = (
    ("invalid_email", "contact", "error", "quarantine"),
    ("orphan_contact", "contact", "error", "quarantine"),
    ("duplicate_contact", "contact", "warn", "merge"),
    ("possible_duplicate", "contact", "warn", "review"),
    ("missing_title", "contact", "warn", "flag"),
    ("unmapped_title", "contact", "warn", "flag"),
    ("stale_contact", "contact", "warn", "refresh"),
    ("missing_enrichment", "account", "warn", "queue_for_enrichment"),
    ("stale_enrichment", "account", "warn", "re_enrich"),
    ("missing_industry", "account", "warn", "flag"),
    ("missing_employee_count", "account", "warn", "flag"),
    ("unmapped_industry_label", "account", "warn", "add_mapping"),
    ("industry_conflict", "account", "warn", "resolved_by_rule"),
    ("country_conflict", "account", "warn", "resolved_by_rule"),
    ("suspected_wrong_entity", "account", "error", "review"),
    ("headcount_band_mismatch", "account", "warn", "flag"),
)
REMOVING_ACTIONS = ("quarantine", "merge")


def _run_checks(df: DataFrame, entity: str, id_col: str, tests: dict[str, tuple[Column, Column]]) -> DataFrame:
    """All checks of an entity in one pass: each row turns into one line per check it fails."""
    lines = [
        F.when(
            tests[name][0],
            F.struct(
                F.lit(name).alias("check_name"),
                F.lit(entity).alias("entity"),
                F.col(id_col).alias("record_id"),
                F.lit(severity).alias("severity"),
                F.lit(action).alias("action"),
                tests[name][1].cast("string").alias("detail"),
            ),
        )
        for name, kind, severity, action in CHECKS
        if kind == entity
    ]
    return df.select(F.explode(F.array_compact(F.array(*lines))).alias("f")).select("f.*")


def contact_failures(
    deduped: DataFrame, accounts: DataFrame, cfg: Config, hot: Mapping[int, int] | None = None
) -> DataFrame:
    """An account that is listed twice is still one known account."""
    known = accounts.select("account_id").distinct().withColumn("_known", F.lit(True))
    df = join_many_to_one(deduped, known, ["account_id"], "left", "contact_id", cfg, hot)
    title = F.col("title")
    tests = {
        "invalid_email": (~F.col("is_valid_email"), F.col("email_raw")),
        # a missing account id is unknown, not wrong
        "orphan_contact": (F.col("account_id").isNotNull() & F.col("_known").isNull(), F.col("account_id")),
        "duplicate_contact": (~F.col("is_survivor"), F.concat(F.lit("merged into "), "survivor_contact_id")),
        "possible_duplicate": (
            F.col("possible_duplicate_of").isNotNull(), F.concat(F.lit("similar to "), "possible_duplicate_of")
        ),
        "missing_title": (title.isNull(), F.lit(None)),
        "unmapped_title": (title.isNotNull() & (F.col("seniority").isNull() | F.col("department").isNull()), title),
        "stale_contact": (F.col("is_stale"), F.col("source_updated_at")),
    }
    return _run_checks(df, "contact", "contact_id", tests)


def account_failures(resolved: DataFrame) -> DataFrame:
    enriched, label = F.col("has_enrichment"), F.col("industry_label")
    provider = F.col("enrichment_provider")

    def text(*parts: Column) -> Column:
        return F.concat(*[p.cast("string") for p in parts])

    versus = F.lit(" vs ")
    band = text(F.lit(' employees vs "'), F.col("size_band"), F.lit('"'))
    name = F.coalesce("matched_name", "company_name")
    headcount = F.col("employee_count")
    tests = {
        "missing_enrichment": (~enriched, F.col("domain")),
        "stale_enrichment": (F.col("is_stale_enrichment"), F.col("enriched_at")),
        "missing_industry": (enriched & label.isNull(), provider),
        "missing_employee_count": (enriched & headcount.isNull(), provider),
        "unmapped_industry_label": (label.isNotNull() & ~F.col("label_is_mapped"), label),
        "industry_conflict": (F.col("has_industry_conflict"), text(F.col("seed_industry"), versus, label)),
        "country_conflict": (
            F.col("has_country_conflict"), text(F.col("hq_country"), versus, F.col("enriched_country"))
        ),
        "suspected_wrong_entity": (
            F.col("is_suspected_wrong_entity"), text(name, F.lit(": "), headcount, band)
        ),
        "headcount_band_mismatch": (F.col("has_headcount_band_mismatch"), text(headcount, band)),
    }
    return _run_checks(resolved, "account", "account_id", tests)


def dq_failures(
    deduped: DataFrame, accounts: DataFrame, resolved: DataFrame, cfg: Config, hot: Mapping[int, int] | None = None
) -> DataFrame:
    """One row per (check, record): two passes for sixteen checks. `hot` are hot account ids, if known."""
    return contact_failures(deduped, accounts, cfg, hot).unionByName(account_failures(resolved))


def check_catalogue(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(
        [(name, entity) for name, entity, _, _ in CHECKS], "check_name string, entity string"
    )


def dq_summary(failures: DataFrame, contacts: DataFrame, accounts: DataFrame) -> DataFrame:
    """Tested, failed and pass rate per check, including checks nothing failed."""
    # the distinct record count is planned in two steps, so a frequent check is spread by record
    failed = failures.groupBy("check_name", "entity").agg(
        F.max("severity").alias("severity"),
        F.max("action").alias("action"),
        F.count_distinct("record_id").alias("rows_failed"),
    )
    totals = contacts.agg(F.count(F.lit(1)).alias("rows_tested")).withColumn("entity", F.lit("contact")).unionByName(
        accounts.agg(F.count(F.lit(1)).alias("rows_tested")).withColumn("entity", F.lit("account"))
    )
    rows_failed = F.coalesce("rows_failed", F.lit(0).cast("bigint"))
    return (
        check_catalogue(failures)
        .join(totals, "entity")
        .join(failed, ["check_name", "entity"], "left")
        .select(
            "check_name",
            "entity",
            F.coalesce("severity", F.lit("-")).alias("severity"),
            F.coalesce("action", F.lit("-")).alias("action"),
            "rows_tested",
            rows_failed.alias("rows_failed"),
            pct(F.col("rows_tested") - rows_failed, F.col("rows_tested")).alias("pass_rate_pct"),
        )
        .orderBy(F.desc("entity"), F.desc("rows_failed"), "check_name")
    )


def quarantine_leaks(contacts: DataFrame, failures: DataFrame) -> DataFrame:
    """Clean contacts that a check removed; must be empty."""
    removed = failures.filter(F.col("action").isin(*REMOVING_ACTIONS)).select(
        F.col("record_id").alias("contact_id"), "check_name"
    )
    return contacts.select("contact_id").join(removed, "contact_id")


def scores_out_of_range(scores: DataFrame) -> DataFrame:
    """Contacts with a score part outside 0-100; an unknown part passes."""
    bad = F.lit(False)
    for part in ("fit_score", "role_score", "engagement_score", "intent_score", "priority_score"):
        bad = bad | F.coalesce(~F.col(part).between(0, 100), F.lit(False))
    return scores.filter(bad).select("contact_id")


def reconciliation(raw_contacts: DataFrame, clean: DataFrame, failures: DataFrame) -> DataFrame:
    """Raw, clean and removed counts on one line; raw less removed must equal clean."""
    removed = failures.filter(F.col("action").isin(*REMOVING_ACTIONS)).select("record_id").distinct()
    counts = [
        df.select(F.lit(name).alias("_what"))
        for name, df in (("raw_rows", raw_contacts), ("clean_rows", clean), ("removed_rows", removed))
    ]
    stacked = counts[0].unionAll(counts[1]).unionAll(counts[2])
    return stacked.agg(
        *[F.count_if(F.col("_what") == n).alias(n) for n in ("raw_rows", "clean_rows", "removed_rows")]
    ).withColumn("is_explained", F.col("clean_rows") == F.col("raw_rows") - F.col("removed_rows"))


def enrichment_queue(failures: DataFrame, accounts: DataFrame) -> DataFrame:
    """Queued accounts next to real-domain accounts without enrichment."""
    queued = failures.filter("check_name = 'missing_enrichment'").select(F.lit("queued").alias("_what"))
    waiting = accounts.filter("is_real_domain and enrichment_status = 'missing'").select(
        F.lit("waiting").alias("_what")
    )
    return queued.unionAll(waiting).agg(
        F.count_if(F.col("_what") == "queued").alias("queued"),
        F.count_if(F.col("_what") == "waiting").alias("unenriched_real"),
    )


def unexplained_alarms(failures: DataFrame, planted: DataFrame) -> DataFrame:
    """Failures of the rule-based contact checks that no planted error explains."""
    rules = ("invalid_email", "missing_title", "stale_contact", "orphan_contact", "duplicate_contact")
    known = planted.select("record_id").distinct()
    return failures.filter((F.col("entity") == "contact") & F.col("check_name").isin(*rules)).join(
        known, "record_id", "left_anti"
    )
