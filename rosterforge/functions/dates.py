"""Freshness checks against a fixed reference date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ref_date(day: str) -> Column:
    return F.lit(day).cast("date")


def age_days(c: Column, day: str) -> Column:
    return F.datediff(ref_date(day), c.cast("date"))


def is_older_than(c: Column, day: str, days: int) -> Column:
    """Strictly more than `days` old; NULL for a missing date."""
    return age_days(c, day) > days
