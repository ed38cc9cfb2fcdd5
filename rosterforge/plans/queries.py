"""Every operator as a query on the driver's tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterforge.config import Config
from rosterforge.functions import ids, text
from rosterforge.functions.mapping import default_mapping, label_lookup
from rosterforge.operators import (
    changes, constraints, decay, dedupe, enrichment, planting, quality, ranking, recall, report, resolve, scoring,
    standardize,
)
from rosterforge.plans.bindings import RawTables, bind, bind_clean, binding_config, table
from rosterforge.plans.pipeline import LAYERS, Build, build, read_layers
from rosterforge.sources import export, provider, raw, state
from rosterforge.sources.staging import scratch_path, stored
from rosterforge.sources.state_log import StateLog
from rosterforge.streaming import engagement

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def built(spark: SparkSession, sf_dir: str, cfg: Config | None = None) -> Build:
    r = bind(spark, sf_dir)
    return build(r.accounts, r.contacts, r.engagement, r.enrichment_wide, cfg or binding_config())


def text_of(c: str) -> Column:
    return F.col(c).cast("string").alias(c)


def with_text(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("string") for n in names})


def with_double(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


# sources and sinks ---------------------------------------------------------------------------

@query
def raw_load(spark, sf_dir):
    folder = scratch_path(spark, "raw_accounts")
    named = bind(spark, sf_dir).accounts.withColumn(
        "company_name", F.concat(F.lit(' "'), F.trim("company_name"), F.lit('", ok '))
    )
    named.write.csv(folder, header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False,
                    ignoreTrailingWhiteSpace=False)
    return raw.load_raw(spark, "raw_accounts", folder).withColumn(
        "_loaded_at", F.col("_loaded_at").isNotNull()
    ).withColumnRenamed("_loaded_at", "is_stamped")


def _lines_of(accounts: DataFrame) -> DataFrame:
    """Accounts as CSV lines, of which some have a field too many, too few, or a quote that nothing closes."""
    number = F.substring("account_id", 5, 20).cast("bigint")
    quoted = F.concat(F.lit('"'), F.trim("company_name"), F.lit(', "'), F.lit('"Inc"'), F.lit('""'))
    opened = F.concat(F.lit('"'), F.trim("company_name"))
    fields = {c: F.coalesce(F.col(c), F.lit("")) for c in raw.RAW_COLUMNS["raw_accounts"]}
    whole = F.concat_ws(",", *(fields | {"company_name": quoted}).values())
    return accounts.select(
        F.when(number % 11 == 3, F.concat(whole, F.lit(",surplus")))
        .when(number % 13 == 5, F.concat_ws(",", *list(fields.values())[:4]))
        .when(number % 17 == 7, F.concat_ws(",", *(fields | {"company_name": opened}).values()))
        .otherwise(whole).alias("value")
    )


def _with_header(header: str):
    def run(batches):
        yield pd.DataFrame({"value": [header]})
        yield from batches

    return run


@query
def raw_rejects(spark, sf_dir):
    """Every broken line with its text, and how many whole ones were loaded beside them."""
    folder = scratch_path(spark, "broken_accounts")
    header = ",".join(raw.RAW_COLUMNS["raw_accounts"])
    _lines_of(bind(spark, sf_dir).accounts).mapInPandas(_with_header(header), "value string").write.text(folder)
    rejects = raw.raw_rejects(spark, "raw_accounts", folder, multi_line=False)
    loaded = raw.load_raw(spark, "raw_accounts", folder, multi_line=False, broken="drop")
    whole = loaded.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return rejects.select("line_text", "n_fields", "reason", F.lit(None).cast("bigint").alias("whole_lines")).unionByName(
        whole.select(
            F.col("source").alias("line_text"), F.lit(len(raw.RAW_COLUMNS["raw_accounts"])).alias("n_fields"),
            F.lit("none").alias("reason"), F.col("n").alias("whole_lines"),
        )
    )


def _write_export(df: DataFrame, folder: str, headers: dict[str, str]) -> None:
    df.select(*[F.col(c).alias(h) for c, h in headers.items()]).write.csv(
        folder, header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


@query
def provider_ingest(spark, sf_dir):
    cfg = binding_config()
    root = scratch_path(spark, "exports")
    headers = {v: k for k, v in cfg.column_map.items()} | {"enriched_at": provider.DATE_COLUMN}
    wide = bind(spark, sf_dir).enrichment_wide.withColumn(
        "hq_country", F.when(F.col("hq_country") == "US", "NA").otherwise(F.col("hq_country"))
    )
    full = wide.filter("provider = 'clay'")
    narrow = wide.filter("provider = 'mock'")
    short = {c: h for c, h in headers.items() if c not in ("size_band", "description")}
    _write_export(full, f"{root}/batch_01.csv", headers)
    _write_export(narrow, f"{root}/mock_accounts.csv", short)
    return provider.read_exports(spark, root, cfg)


@query
def batch_export_index(spark, sf_dir):
    named = export.export_batches(bind(spark, sf_dir).accounts, binding_config())
    return named.select(
        "batch_no", F.col("Account ID").alias("account_id"), F.col("Company Name").alias("company_name"),
        F.col("Domain").alias("domain"),
    )


@query
def industry_labels(spark, sf_dir):
    wide = bind(spark, sf_dir).enrichment_wide.select(F.col("industry").alias("provider_label"))
    used = wide.filter("provider_label is not null").groupBy("provider_label").agg(
        F.count(F.lit(1)).alias("rows_using")
    )
    return label_lookup(default_mapping(spark)).join(used, "provider_label", "left").select(
        "provider_label", "enriched_industry", "label_is_generic",
        F.array_join(F.array_sort("label_buckets"), "|").alias("buckets"),
        F.coalesce("rows_using", F.lit(0).cast("bigint")).alias("rows_using"),
    )


@query
def layer_tables(spark, sf_dir):
    """A whole build written layer by layer, and the rows of every table it wrote."""
    tables = built(spark, sf_dir).materialize(scratch_path(spark, "warehouse"))
    counts = [
        df.select(F.lit(LAYERS[name]).alias("layer"), F.lit(name).alias("table_name")) for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts).groupBy("layer", "table_name").agg(F.count(F.lit(1)).alias("n_rows"))


# standardising -------------------------------------------------------------------------------

@query
def standardize_accounts(spark, sf_dir):
    return with_text(standardize.standardize_accounts(bind(spark, sf_dir).accounts), "source_updated_at")


@query
def normalize_page_domains(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id", *[text.normalize_domain(url, mode).alias(f"domain_{mode}") for mode in ("loader", "staging", "match")]
    )


@query
def contact_emails_titles(spark, sf_dir):
    return with_text(
        standardize.standardize_contacts(bind(spark, sf_dir).contacts, binding_config()), "source_updated_at"
    )


@query
def standardize_events(spark, sf_dir):
    df = standardize.standardize_events(bind(spark, sf_dir).engagement)
    return df.withColumn("event_ts", F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss"))


@query
def rewritten_emails(spark, sf_dir):
    email = text.normalize_email(F.col("email"))
    cfg = binding_config()
    return bind(spark, sf_dir).contacts.select(
        "contact_id",
        F.when(text.is_valid_email(email), text.rewrite_email(email, cfg.email_rewrite)).alias("rewritten"),
        text.rewrite_email(email, "as_is").alias("as_is"),
    )


@query
def surrogate_ids(spark, sf_dir):
    return bind(spark, sf_dir).accounts.select(
        "account_id", ids.target_id(changes.PATHS["company"], F.col("account_id")).alias("target_id")
    )


# enrichment ----------------------------------------------------------------------------------

@query
def enrichment_long_match(spark, sf_dir):
    r = bind(spark, sf_dir)
    return enrichment.enrichment_long(r.enrichment_wide, r.accounts, binding_config()).drop("_loaded_at")


@query
def match_summary(spark, sf_dir):
    r = bind(spark, sf_dir)
    return enrichment.match_summary(enrichment.enrichment_long(r.enrichment_wide, r.accounts, binding_config()))


@query
def enrichment_pivot(spark, sf_dir):
    return with_text(enrichment.pivot_enrichment(built(spark, sf_dir).enrichment), "enriched_at")


@query
def enrichment_latest(spark, sf_dir):
    return with_text(built(spark, sf_dir).stg_enrichment, "enriched_at")


# entity resolution ---------------------------------------------------------------------------

@query
def dedupe_exact(spark, sf_dir):
    b = built(spark, sf_dir)
    return dedupe.dedupe_exact(
        b.stg_contacts, "email", "contact_id", dedupe.contact_preference(), b.cfg
    ).select("contact_id", "email", "group_size", "survivor_contact_id", "is_survivor", "match_rule")


@query
def fuzzy_pairs(spark, sf_dir):
    b = built(spark, sf_dir)
    exact = stored(
        dedupe.dedupe_exact(b.stg_contacts, "email", "contact_id", dedupe.contact_preference(), b.cfg), "exact"
    )
    return dedupe.fuzzy_pairs(exact.filter("is_survivor"), b.cfg)


@query
def fuzzy_part_names(spark, sf_dir):
    """Blocks with far more names than are paired in full: the sub-key path on a given table."""
    parts = table(spark, sf_dir, "part").select(
        F.format_string("P%09d", "p_partkey").alias("part_id"), "p_type",
        F.concat_ws(" ", "p_name", "p_brand").alias("label"),
    )
    return dedupe.fuzzy_pairs(
        parts, binding_config(fuzzy_threshold=0.95), id_col="part_id", block=("p_type",), text="label", other="part_id"
    )


@query
def merged_links(spark, sf_dir):
    return dedupe.merged_links(built(spark, sf_dir).int_contacts_deduped)


@query
def merged_ids(spark, sf_dir):
    b = built(spark, sf_dir)
    return dedupe.merged_ids(b.int_contacts_deduped, b.cfg).select(
        "survivor_contact_id", "slice", F.array_join("merged_contact_ids", ",").alias("merged_contact_ids")
    )


@query
def clean_contacts(spark, sf_dir):
    return with_text(built(spark, sf_dir).dim_contact, "source_updated_at")


@query
def repointed_events(spark, sf_dir):
    return built(spark, sf_dir).fct_engagement.withColumn(
        "event_ts", F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss")
    )


@query
def accounts_resolved(spark, sf_dir):
    return with_text(built(spark, sf_dir).int_accounts_resolved, "source_updated_at", "enriched_at")


@query
def conflict_log(spark, sf_dir):
    return built(spark, sf_dir).int_enrichment_conflicts


@query
def clean_accounts(spark, sf_dir):
    return with_text(built(spark, sf_dir).dim_account, "enriched_at")


# scoring -------------------------------------------------------------------------------------

@query
def account_fit(spark, sf_dir):
    return with_double(built(spark, sf_dir).int_account_fit, "fit_score")


@query
def engagement_score(spark, sf_dir):
    return built(spark, sf_dir).int_contact_engagement


@query
def daily_engagement_stream(spark, sf_dir):
    """Three arrivals of event files, out of order of date and with repeated events, counted by a stream."""
    source, folder = scratch_path(spark, "arrivals"), scratch_path(spark, "daily_counts")
    events = bind(spark, sf_dir).engagement
    number = F.substring("event_id", 5, 20).cast("bigint")
    for arrival in range(3):
        again = (number % 10 == 0) & (number % 3 < arrival)
        events.filter((number % 3 == arrival) | again).write.parquet(f"{source}/arrival-{arrival}")
        engagement.count_arrivals(spark, f"{source}/*", folder)
    return with_text(engagement.read_counts(spark, folder), "event_date")


@query
def engagement_from_totals(spark, sf_dir):
    """Scores from totals of two runs that were added and moved to another landmark; no event is read twice."""
    cfg, b = binding_config(), built(spark, sf_dir)
    days = engagement.daily_counts(b.stg_engagement)
    early = F.col("event_date") < F.lit("2024-01-16").cast("date")
    first = decay.decayed_totals(days.filter(early), cfg, "2024-01-01")
    later = decay.decayed_totals(days.filter(~early | early.isNull()), cfg, "2024-01-20")
    totals = decay.added(decay.moved(first, cfg, "2024-01-01", "2024-01-20"), later)
    return decay.engagement_from_totals(b.dim_contact, totals, cfg, "2024-01-20", b.survivor_links)


@query
def line_price_rank(spark, sf_dir):
    """Order lines ranked by price: many values, with ties."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("double"))
    return ranking.rank_desc(lines, "l_extendedprice", "price_rank", "l_orderkey", max_values=1_000).select(
        "l_orderkey", "l_linenumber", "price_rank"
    )


@query
def layers_in_force(spark, sf_dir):
    """Two builds published, the second after one that died half way: the tables in force."""
    root = scratch_path(spark, "published")
    built(spark, sf_dir, binding_config(tier_a_min=70)).publish(root)
    built(spark, sf_dir).publish(root)
    dead = built(spark, sf_dir)
    dead.root = f"{root}/builds/dead"
    dead._write(dead.dim_account, "dim_account")
    tables = read_layers(spark, root)
    counts = [df.select(F.lit(name).alias("table_name")) for name, df in tables.items()]
    found = reduce(DataFrame.unionAll, counts).groupBy("table_name").agg(F.count(F.lit(1)).alias("n_rows"))
    tiers = tables["fct_prospect_scores"].groupBy("tier").agg(F.count(F.lit(1)).alias("n_rows"))
    return found.unionAll(tiers)


@query
def prospect_scores(spark, sf_dir):
    return with_double(built(spark, sf_dir).fct_prospect_scores, "fit_score").withColumn(
        "segment", scoring.segment(F.col("tier"), F.col("persona"))
    )


@query
def tier_distribution(spark, sf_dir):
    return scoring.tier_distribution(built(spark, sf_dir).fct_prospect_scores)


@query
def role_averages(spark, sf_dir):
    return scoring.role_averages(built(spark, sf_dir).fct_prospect_scores)


# quality -------------------------------------------------------------------------------------

@query
def dq_failures(spark, sf_dir):
    return built(spark, sf_dir).dq_failures


@query
def dq_failures_repeated_accounts(spark, sf_dir):
    """Contact checks against accounts that were loaded twice: still one line per check and record."""
    b = built(spark, sf_dir)
    twice = b.stg_accounts.unionAll(b.stg_accounts)
    return quality.contact_failures(b.int_contacts_deduped, twice, b.cfg)


@query
def dq_summary(spark, sf_dir):
    return built(spark, sf_dir).dq_summary


@query
def constraint_report(spark, sf_dir):
    return built(spark, sf_dir).constraints()


@query
def table_constraints(spark, sf_dir):
    names = ("customer", "orders", "lineitem", "nation", "events")
    tables = {n: table(spark, sf_dir, n) for n in names}
    c = constraints.Constraints
    return constraints.constraint_report(tables, [
        c("orders", ("o_orderkey", "o_custkey"), ("o_orderkey", "o_custkey"), {"o_orderstatus": ("F", "O")},
          {"o_custkey": ("customer", "c_custkey")}),
        c("lineitem", ("l_orderkey",), ("l_orderkey", "l_shipdate"), {"l_returnflag": ("A", "N")},
          {"l_orderkey": ("orders", "o_orderkey")}),
        c("customer", ("c_custkey",), ("c_name",), {}, {"c_nationkey": ("nation", "n_nationkey")}),
        c("events", ("event_id",), ("user_id",), {"event_type": ("view", "click", "purchase", "signup")},
          {"user_id": ("customer", "c_custkey")}),
    ])


@query
def select_option_report(spark, sf_dir):
    scores = built(spark, sf_dir).fct_prospect_scores
    return constraints.constraint_report(
        {"fct_prospect_scores": scores},
        [constraints.Constraints("fct_prospect_scores", accepted=constraints.SELECT_OPTIONS)],
    )


@query
def quarantine_leaks(spark, sf_dir):
    b = built(spark, sf_dir)
    return quality.quarantine_leaks(b.dim_contact, b.dq_failures)


@query
def quarantine_leaks_unclean(spark, sf_dir):
    """The assertion on contacts that were never cleaned: every removed record shows."""
    b = built(spark, sf_dir)
    return quality.quarantine_leaks(b.int_contacts_deduped, b.dq_failures)


@query
def scores_out_of_range(spark, sf_dir):
    return quality.scores_out_of_range(built(spark, sf_dir).fct_prospect_scores)


@query
def scores_out_of_range_doubled(spark, sf_dir):
    """The assertion on scores that were scaled wrongly."""
    scores = built(spark, sf_dir).fct_prospect_scores
    return quality.scores_out_of_range(scores.withColumn("priority_score", F.col("priority_score") * 2))


@query
def reconciliation(spark, sf_dir):
    b = built(spark, sf_dir)
    return quality.reconciliation(b.contacts, b.dim_contact, b.dq_failures)


@query
def enrichment_queue(spark, sf_dir):
    b = built(spark, sf_dir)
    return quality.enrichment_queue(b.dq_failures, b.dim_account)


@query
def provider_findings(spark, sf_dir):
    b = built(spark, sf_dir)
    return report.provider_findings(b.dq_failures, b.dim_account)


@query
def rule_mix(spark, sf_dir):
    return report.industry_rule_mix(built(spark, sf_dir).dim_account)


@query
def headline_counts(spark, sf_dir):
    b = built(spark, sf_dir)
    return report.headline_counts(b.contacts, b.dim_contact, b.dim_account)


# planted errors ------------------------------------------------------------------------------

def planted(spark: SparkSession, sf_dir: str) -> tuple[Build, DataFrame]:
    """A build over the clean tables with errors planted, and the manifest."""
    cfg = binding_config()
    r: RawTables = bind_clean(spark, sf_dir)
    contacts, contact_errors = planting.plant_contact_errors(r.contacts, cfg, r.accounts)
    accounts, account_errors = planting.plant_account_errors(r.accounts, cfg)
    manifest = stored(account_errors.unionByName(contact_errors), "manifest")
    b = build(stored(accounts, "dirty_accounts"), stored(contacts, "dirty_contacts"), r.engagement,
              r.enrichment_wide, cfg)
    return b, manifest


@query
def planted_contacts(spark, sf_dir):
    r = bind_clean(spark, sf_dir)
    return planting.plant_contact_errors(r.contacts, binding_config(), r.accounts)[0]


@query
def planted_accounts(spark, sf_dir):
    dirty, _ = planting.plant_account_errors(bind_clean(spark, sf_dir).accounts, binding_config())
    return dirty.select("account_id", "seed_industry")


@query
def planted_manifest(spark, sf_dir):
    r, cfg = bind_clean(spark, sf_dir), binding_config()
    return planting.plant_account_errors(r.accounts, cfg)[1].unionByName(
        planting.plant_contact_errors(r.contacts, cfg, r.accounts)[1]
    )


@query
def planted_sparse_manifest(spark, sf_dir):
    """Errors planted in contacts whose ids have gaps: no new id is one that exists."""
    r, cfg = bind_clean(spark, sf_dir), binding_config()
    number = F.substring("contact_id", 5, 20).cast("bigint")
    sparse = r.contacts.withColumn("contact_id", F.format_string("CON-%08d", number * 2))
    return planting.plant_contact_errors(sparse, cfg, r.accounts)[1]


@query
def planted_detail(spark, sf_dir):
    b, manifest = planted(spark, sf_dir)
    return recall.planted_detail(manifest, b.dq_failures, b.int_accounts_resolved)


@query
def planted_vs_caught(spark, sf_dir):
    return recall.planted_vs_caught(planted_detail(spark, sf_dir))


@query
def missed_by_rules(spark, sf_dir):
    return recall.missed_by_rules(planted_detail(spark, sf_dir))


@query
def missed_detectable(spark, sf_dir):
    return recall.missed_detectable(planted_detail(spark, sf_dir))


def _recall_without(spark: SparkSession, sf_dir: str, check: str) -> DataFrame:
    """Planted errors against a failure log from which one check is missing."""
    b, manifest = planted(spark, sf_dir)
    return recall.planted_detail(manifest, b.dq_failures.filter(F.col("check_name") != check), b.int_accounts_resolved)


@query
def missed_by_rules_unchecked(spark, sf_dir):
    return recall.missed_by_rules(_recall_without(spark, sf_dir, "stale_contact"))


@query
def missed_detectable_unchecked(spark, sf_dir):
    return recall.missed_detectable(_recall_without(spark, sf_dir, "industry_conflict"))


@query
def unexplained_alarms_partial(spark, sf_dir):
    """The assertion with a manifest that lacks one kind of error."""
    b, manifest = planted(spark, sf_dir)
    return quality.unexplained_alarms(b.dq_failures, manifest.filter("error_type <> 'stale_record'"))


@query
def unexplained_alarms(spark, sf_dir):
    b, manifest = planted(spark, sf_dir)
    return quality.unexplained_alarms(b.dq_failures, manifest)


def _strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, manifest = planted(spark, sf_dir)
    return stored(report.strict_conflicts(b.int_accounts_resolved, b.industry_mapping, manifest, b.cfg), "strict")


@query
def strict_tradeoff(spark, sf_dir):
    return report.strict_tradeoff(_strict(spark, sf_dir))


@query
def strict_overridden(spark, sf_dir):
    return report.strict_overridden(_strict(spark, sf_dir))


# change plan ---------------------------------------------------------------------------------

REQUEST_SCHEMA = (
    "entity string, local_id string, method string, path string, matching_attribute string, parent_object string, "
    "parent_record_id string, payload string"
)
REJECTS = (changes.RejectRule("company", "domains", r"\.example\z"),)


def account_view(b: Build) -> DataFrame:
    """The account dimension with its fit, for accounts that have scored contacts."""
    accounts = b.dim_account.join(b.int_account_fit.select("account_id", "fit_score"), "account_id")
    return changes.scope(accounts, b.fct_prospect_scores)[0]


def two_runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """A first run with higher tier limits and some failed writes, then a run with the usual ones.

    Returns the outcomes and the state after each of the two.
    """
    return two_logged_runs(spark, sf_dir, *run_scope(spark, sf_dir))[:4]


def run_scope(spark: SparkSession, sf_dir: str) -> tuple[Build, DataFrame, DataFrame]:
    """A build, and the accounts and scored contacts of its runs. The scores stand on a stored table."""
    b = built(spark, sf_dir, binding_config())
    return b, stored(account_view(b), "scope"), b.fct_prospect_scores


def two_logged_runs(
    spark: SparkSession, sf_dir: str, b: Build, accounts: DataFrame, scores: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, StateLog]:
    """The two runs and the state log that the first has been appended to."""
    cfg = binding_config()
    empty = changes.no_state(spark)
    strict = binding_config(tier_a_min=70, tier_b_min=55)
    before = scores.withColumn("tier", scoring.tier(F.col("priority_score"), strict))
    no_title = scores.filter("title is null").select(F.lit("person").alias("entity"), F.col("contact_id").alias("local_id"))
    no_country = accounts.filter("country is null").select(F.lit("company").alias("entity"), F.col("account_id").alias("local_id"))
    failures = no_title.unionByName(no_country).withColumns(
        {"status": F.lit(400), "message": F.lit("rejected")}
    )
    first, _ = changes.plan_run(
        accounts, before, empty, strict, rejects=REJECTS, failures=failures, hot=b.hot_accounts
    )
    log = StateLog(spark, scratch_path(spark, "state_log"))
    log.append(first, "run-1")
    state1 = log.read()
    second, state2 = changes.plan_run(accounts, scores, state1, cfg, rejects=REJECTS, hot=b.hot_accounts)
    return first, state1, second, state2, log


@query
def change_plan(spark, sf_dir):
    second = two_runs(spark, sf_dir)[2]
    return second.select("entity", "local_id", "action", "target_id", "parent_id", "payload", "payload_hash",
                         F.col("dropped_values").cast("bigint").alias("dropped_values"))


@query
def first_run_stats(spark, sf_dir):
    return changes.run_stats(two_runs(spark, sf_dir)[0])


@query
def second_run_stats(spark, sf_dir):
    return changes.run_stats(two_runs(spark, sf_dir)[2])


@query
def state_after_runs(spark, sf_dir):
    """State written to and read back from its snapshot folders after both runs."""
    root = scratch_path(spark, "state_store")
    first, state1, second, state2 = two_runs(spark, sf_dir)
    state.save_run(first, state1, root, "run-1")
    state.save_run(second, state2, root, "run-2")
    return state.read_state(spark, root).drop("synced_at")


@query
def state_log_after_runs(spark, sf_dir):
    """Both runs appended to a state log, one of its buckets compacted, and the state in force."""
    _, _, second, _, log = two_logged_runs(spark, sf_dir, *run_scope(spark, sf_dir))
    log.append(second, "run-2")
    log.compact(max_segments=1)
    return log.read().drop("synced_at")


@query
def rerun_stats(spark, sf_dir):
    """A run right after a complete one: nothing is sent."""
    cfg = binding_config()
    b = built(spark, sf_dir, cfg)
    accounts, scores = stored(account_view(b), "scope"), stored(b.fct_prospect_scores, "scores")
    empty = changes.no_state(spark)
    _, after = changes.plan_run(accounts, scores, empty, cfg)
    return changes.run_stats(changes.plan_run(accounts, scores, stored(after, "state"), cfg)[0])


@query
def lost_state_stats(spark, sf_dir):
    """All state lost: records are found again in the target, so nothing is created twice."""
    cfg = binding_config()
    b = built(spark, sf_dir, cfg)
    accounts, scores = stored(account_view(b), "scope"), stored(b.fct_prospect_scores, "scores")
    empty = changes.no_state(spark)
    targets = {
        "company": accounts.select(
            F.col("account_id").alias("local_id"),
            ids.target_id(changes.PATHS["company"], F.col("account_id")).alias("target_id")),
        "person": scores.select(
            F.col("contact_id").alias("local_id"),
            ids.target_id(changes.PATHS["person"], F.col("contact_id")).alias("target_id")),
    }
    return changes.run_stats(changes.plan_run(accounts, scores, empty, cfg, targets=targets)[0])


@query
def dry_run_requests(spark, sf_dir):
    """Writes of the second run as JSON lines, counted back from the written files."""
    cfg = binding_config()
    folder = scratch_path(spark, "requests")
    state.write_requests(two_runs(spark, sf_dir)[2], folder, cfg)
    return spark.read.schema(REQUEST_SCHEMA).json(folder)


@query
def forced_dry_run(spark, sf_dir):
    """A forced run against the state of an earlier one: every record is written, nothing is saved."""
    cfg = binding_config()
    b, accounts, scores = run_scope(spark, sf_dir)
    _, state1, _, _, _ = two_logged_runs(spark, sf_dir, b, accounts, scores)
    outcomes, _ = changes.plan_run(accounts, scores, state1, cfg, force=True, rejects=REJECTS, hot=b.hot_accounts)
    folder = scratch_path(spark, "requests")
    state.write_requests(outcomes, folder, cfg)
    return spark.read.schema(REQUEST_SCHEMA).json(folder)


@query
def two_rule_payloads(spark, sf_dir):
    """Company payloads under two reject rules, of which one, both or none hits a record."""
    cfg = binding_config()
    rules = (*REJECTS, changes.RejectRule("company", "name", "[0-4]$"), changes.RejectRule("company", "name", "2$"))
    empty = changes.no_state(spark)
    plan = changes.plan_companies(account_view(built(spark, sf_dir, cfg)), empty, cfg, rejects=rules)
    return plan.select("local_id", "payload", F.col("dropped_values").cast("bigint").alias("dropped_values"))


@query
def run_log(spark, sf_dir):
    """Run and error log of two runs, the first with failures, read back from the store."""
    root = scratch_path(spark, "run_log")
    first, state1, second, state2 = two_runs(spark, sf_dir)
    failed = first.filter("failed").select("entity", "local_id", F.lit(400).alias("status"), F.lit("refused").alias("message"))
    state.save_run(first, state1, root, "run-1", failed)
    state.save_run(second, state2, root, "run-2")
    errors = spark.read.parquet(f"{root}/errors").groupBy("run_id", "entity").agg(F.count(F.lit(1)).alias("errors"))
    runs = spark.read.parquet(f"{root}/runs").drop("finished_at")
    return runs.join(errors, ["run_id", "entity"], "left").withColumn("errors", F.coalesce("errors", F.lit(0).cast("bigint")))


@query
def verify_target(spark, sf_dir):
    """The target as the first run left it, with companies present twice, against the second state."""
    _, state1, _, state2 = two_runs(spark, sf_dir)
    target = state1.select("entity", "local_id").unionByName(
        state1.filter("entity = 'company'").select("entity", "local_id")
    ).filter("entity <> 'entry'")
    return changes.verify_target(target, state2)


@query
def scoped_top_accounts(spark, sf_dir):
    b = built(spark, sf_dir)
    chosen, people = changes.scope(account_view(b), b.fct_prospect_scores, limit=20)
    return chosen.select("account_id", "enrichment_status").join(
        people.groupBy("account_id").agg(F.count(F.lit(1)).alias("people")), "account_id"
    )


@query
def smoke_scope(spark, sf_dir):
    b = built(spark, sf_dir)
    return changes.scope(account_view(b), b.fct_prospect_scores, smoke=True)[1].select(
        "account_id", "contact_id", "priority_rank"
    )
