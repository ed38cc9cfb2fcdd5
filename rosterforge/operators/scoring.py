"""Fit, role, engagement, intent and the priority built from them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

from rosterforge.config import Config
from rosterforge.functions.dates import age_days
from rosterforge.functions.numbers import round1
from rosterforge.operators.ranking import rank_desc
from rosterforge.operators.skew import join_many_to_one
from rosterforge.sources.staging import stored

# Points and their parts.
FIT_WEIGHTS = {"industry": "0.50", "size": "0.35", "country": "0.15"}
FUNDING_MONTHS = 12
CORE_ROLE_POINTS = {"VP": 100, "Director": 100, "C-level": 90, "Manager": 70}
CORE_ROLE_DEFAULT = 40
OTHER_ROLE_POINTS = {"C-level": 60, "VP": 60, "Director": 50, "Manager": 35}
OTHER_ROLE_DEFAULT = 15
NO_ROLE_POINTS = 10


def _decimal(value, precision: int = 5, scale: int = 4) -> Column:
    return F.lit(str(value)).cast(T.DecimalType(precision, scale))


def _points(c: Column, table: dict[str, int], default: int) -> Column:
    out = F.lit(default)
    for value, points in table.items():
        out = F.when(c == value, points).otherwise(out)
    return out


def account_fit(accounts: DataFrame, cfg: Config, keep: tuple[str, ...] = ("account_id",)) -> DataFrame:
    """Fit (exact decimal) and intent per account: a projection, no shuffle.

    Intent is NULL when a signal is unknown, except funding, whose absence counts as no signal.
    """
    n = F.col("employee_count")
    industry = (
        F.when(F.col("industry").isin(*cfg.icp_industries), 100)
        .when(F.col("industry").isin(*cfg.adjacent_industries), 60)
        .otherwise(20)
    )
    size = (
        F.when(n.between(200, 2000), 100).when(n.between(50, 199) | n.between(2001, 10000), 60).otherwise(30)
    )
    country = F.when(F.col("country").isin(*cfg.home_countries), 100).otherwise(50)
    signals = (
        F.col("sim_hiring_data_roles").cast("int")
        + F.coalesce(F.col("sim_months_since_funding") <= FUNDING_MONTHS, F.lit(False)).cast("int")
        + F.col("sim_tech_stack_match").cast("int")
    )
    fit = (
        _decimal(FIT_WEIGHTS["industry"], 3, 2) * F.col("industry_pts")
        + _decimal(FIT_WEIGHTS["size"], 3, 2) * F.col("size_pts")
        + _decimal(FIT_WEIGHTS["country"], 3, 2) * F.col("country_pts")
    )
    return (
        accounts.withColumns(
            {"industry_pts": industry, "size_pts": size, "country_pts": country, "intent_signals": signals}
        )
        .withColumns({
            "fit_score": F.round(fit, 1).cast(T.DecimalType(5, 1)),
            "intent_score": round1(F.lit(100.0) * F.col("intent_signals") / F.lit(3.0)),
        })
        .select(*keep, "industry_pts", "size_pts", "country_pts", "fit_score", "intent_signals", "intent_score")
    )


def role_score(level: Column, dept: Column) -> Column:
    return (
        F.when(level.isNull(), NO_ROLE_POINTS)
        .when(dept.isin("Data", "RevOps"), _points(level, CORE_ROLE_POINTS, CORE_ROLE_DEFAULT))
        .otherwise(_points(level, OTHER_ROLE_POINTS, OTHER_ROLE_DEFAULT))
    )


def event_points(event_type: Column, event_ts: Column, cfg: Config) -> Column:
    """Points of one event, halved every half-life of age. Unknown types are worth nothing."""
    base = F.lit(0.0)
    for name, points in cfg.event_points.items():
        base = F.when(event_type == name, float(points)).otherwise(base)
    age = age_days(event_ts, cfg.reference_date).cast("double")
    return base * F.pow(F.lit(0.5), age / F.lit(float(cfg.engagement_half_life_days)))


def _event_totals(events: DataFrame, cfg: Config) -> DataFrame:
    kind = F.col("event_type")
    return events.groupBy("contact_id").agg(
        F.sum(event_points(kind, F.col("event_ts"), cfg)).alias("_pts"),
        F.count(F.lit(1)).alias("events_90d"),
        F.count_if(kind == "reply").alias("replies"),
        F.count_if(kind == "meeting").alias("meetings"),
        F.count_if(kind.isin("email_open", "web_visit")).alias("touches"),
    )


def engagement_score(
    contacts: DataFrame, events: DataFrame, cfg: Config, links: DataFrame | None = None
) -> DataFrame:
    """Time-decayed engagement (0-100) and counters for every contact.

    Events shrink to one row per contact before any join. With `links` the events may still
    carry their raw contact ids: the totals, not the events, are moved to the survivors.
    """
    counters = ["events_90d", "replies", "meetings", "touches"]
    totals = _event_totals(events, cfg)
    if links is not None:
        totals = (
            totals.join(links, "contact_id")
            .groupBy(F.col("survivor_contact_id").alias("contact_id"))
            .agg(*[F.sum(c).alias(c) for c in ["_pts", *counters]])
        )
    points = F.least(F.lit(100.0), round1(F.coalesce("_pts", F.lit(0.0))))
    return (
        contacts.select("contact_id")
        .join(totals, "contact_id", "left")
        .select(
            "contact_id",
            points.alias("engagement_score"),
            *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in counters],
        )
    )


def priority_score(cfg: Config) -> Column:
    """Weighted sum: fit and role exactly in decimals first, then engagement and intent."""
    exact = _decimal(cfg.w_fit) * F.col("fit_score") + _decimal(cfg.w_role) * F.col("role_score")
    return round1(
        exact.cast("double")
        + F.lit(float(cfg.w_engagement)) * F.col("engagement_score")
        + F.lit(float(cfg.w_intent)) * F.col("intent_score")
    )


def tier(score: Column, cfg: Config) -> Column:
    return F.when(score >= cfg.tier_a_min, "A").when(score >= cfg.tier_b_min, "B").otherwise("C")


def stage() -> Column:
    return (
        F.when(F.col("meetings") > 0, "Meeting booked")
        .when(F.col("replies") > 0, "Replied")
        .when(F.col("events_90d") > 0, "Engaged")
        .otherwise("New")
    )


def segment(tier_col: Column, persona_col: Column) -> Column:
    return F.concat(tier_col, F.lit(" / "), persona_col)


def score_contacts(
    contacts: DataFrame, accounts: DataFrame, engagement: DataFrame, cfg: Config, hot: Mapping[int, int] | None = None
) -> DataFrame:
    """Every part of the score for each clean contact; all but the rank. `hot` are hot account ids, if known."""
    attributes = account_fit(
        accounts,
        cfg,
        ("account_id", "company_name", "domain", "industry", "employee_count", "country",
         "enrichment_status", F.col("description").alias("company_description")),
    )
    # the counters first: they are narrower than the account's attributes, which then move no more
    counted = contacts.join(engagement, "contact_id")
    joined = join_many_to_one(counted, attributes, ["account_id"], "inner", "contact_id", cfg, hot)
    scored = joined.withColumn("role_score", role_score(F.col("seniority"), F.col("department")))
    return scored.select(
        "contact_id", "account_id", "full_name", "first_name", "last_name", "email", "title", "seniority",
        "department", "persona", "is_missing_title", "is_stale", "company_name", "domain", "industry",
        "employee_count", "country", "enrichment_status", "company_description", "fit_score", "role_score",
        "engagement_score", "intent_score", "events_90d", "replies", "meetings",
        priority_score(cfg).alias("priority_score"),
    ).withColumns({"tier": tier(F.col("priority_score"), cfg), "stage": stage()})


def prospect_scores(
    contacts: DataFrame, accounts: DataFrame, engagement: DataFrame, cfg: Config, hot: Mapping[int, int] | None = None
) -> DataFrame:
    scored = stored(score_contacts(contacts, accounts, engagement, cfg, hot), "scored")
    return rank_desc(scored, "priority_score", "priority_rank")


def tier_distribution(scores: DataFrame) -> DataFrame:
    """Contacts and share per tier. The window sees the three counted rows only."""
    total = F.sum("contacts").over(W.partitionBy())
    return scores.groupBy("tier").agg(F.count(F.lit(1)).alias("contacts")).select(
        "tier", "contacts", (F.col("contacts").cast("double") / total).alias("share")
    )


def role_averages(scores: DataFrame) -> DataFrame:
    """Average role score of data leaders and of individual contributors."""
    return scores.agg(
        F.avg(F.when(F.col("persona") == "Data/RevOps leader", F.col("role_score"))).alias("leader_avg"),
        F.avg(F.when(F.col("seniority") == "IC", F.col("role_score"))).alias("ic_avg"),
    )
