"""Engagement totals that can be added across runs and moved to any reference date.

Forward decay: every event is weighed against a fixed day, the landmark, and grows with its date. All
weights shrink alike as time passes, so a total stands still until somebody asks for a date.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterforge.config import Config
from rosterforge.functions.numbers import round1

COUNTERS = ("events_90d", "replies", "meetings", "touches")


def _halvings(later: Column, earlier: Column, cfg: Config) -> Column:
    return F.date_diff(later, earlier).cast("double") / F.lit(float(cfg.engagement_half_life_days))


def decayed_totals(days: DataFrame, cfg: Config, landmark: str) -> DataFrame:
    """(contact_id, weight, counters) from daily counts (contact_id, event_date, event_type, n).

    `weight` is the sum of points, doubled for every half-life after the landmark. Unknown types are
    worth nothing but count as events.
    """
    kind, n = F.col("event_type"), F.col("n")
    points = F.lit(0.0)
    for name, worth in cfg.event_points.items():
        points = F.when(kind == name, float(worth)).otherwise(points)
    grown = F.pow(F.lit(2.0), _halvings(F.col("event_date"), F.lit(landmark).cast("date"), cfg))

    def of(*kinds: str) -> Column:
        return F.sum(F.when(kind.isin(*kinds), n).otherwise(0))

    return days.groupBy("contact_id").agg(
        F.sum(points * n * grown).alias("weight"), F.sum("n").alias("events_90d"), of("reply").alias("replies"),
        of("meeting").alias("meetings"), of("email_open", "web_visit").alias("touches"),
    )


def added(*totals: DataFrame) -> DataFrame:
    """Totals of several runs with one landmark, as if all days had come at once."""
    return reduce(DataFrame.unionByName, totals).groupBy("contact_id").agg(
        *[F.sum(c).alias(c) for c in ("weight", *COUNTERS)]
    )


def moved(totals: DataFrame, cfg: Config, landmark: str, to: str) -> DataFrame:
    """The same totals against another landmark, for stores that outlive many half-lives."""
    by = F.pow(F.lit(0.5), _halvings(F.lit(to).cast("date"), F.lit(landmark).cast("date"), cfg))
    return totals.withColumn("weight", F.col("weight") * by)


def engagement_from_totals(
    contacts: DataFrame, totals: DataFrame, cfg: Config, landmark: str, links: DataFrame | None = None
) -> DataFrame:
    """The engagement score of every contact on `cfg.reference_date`, without looking at an event.

    Equals `engagement_score` over the events that the totals were made of. With `links` the totals
    of merged contacts move to their survivors.
    """
    names = ("weight", *COUNTERS)
    if links is not None:
        totals = totals.join(links, "contact_id").groupBy(F.col("survivor_contact_id").alias("contact_id")).agg(
            *[F.sum(c).alias(c) for c in names]
        )
    shrunk = moved(totals, cfg, landmark, cfg.reference_date)
    points = F.least(F.lit(100.0), round1(F.coalesce("weight", F.lit(0.0))))
    return contacts.select("contact_id").join(shrunk, "contact_id", "left").select(
        "contact_id", points.alias("engagement_score"),
        *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in COUNTERS],
    )
