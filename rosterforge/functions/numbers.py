"""Number helpers that round and parse the way the reference results require."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round1(x: Column) -> Column:
    """One decimal, scaling before rounding: 61.949999999999996 gives 62.0, not 61.9."""
    return F.round(x.cast("double") * 10, 0) / 10


# Fixed value: plain decimal or scientific notation; rejects suffixes such as '5d' or 'NaN'.
NUMBER_PATTERN = r"\A\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*\z"


def _parsed(text: Column) -> Column:
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def int_via_double(text: Column) -> Column:
    """Text to int through a double: halves go to the even neighbour."""
    return F.bround(_parsed(text), 0).try_cast("int")


def int_from_text(text: Column) -> Column:
    """Text straight to int: halves go away from zero."""
    return F.round(_parsed(text), 0).try_cast("int")


def pct(part: Column, whole: Column) -> Column:
    """Percentage with one decimal, NULL when there is nothing to divide by."""
    return round1(F.try_divide(F.lit(100.0) * part, whole.cast("double")))


def size_band_low(band: Column) -> Column:
    """'1,001-5,000 employees' gives 1001."""
    return int_from_text(F.replace(F.regexp_extract(band, r"^([0-9,]+)", 1), F.lit(","), F.lit("")))


def size_band_high(band: Column) -> Column:
    """'1,001-5,000 employees' gives 5000; an open band such as '10,001+' gives NULL."""
    return int_from_text(F.replace(F.regexp_extract(band, r"-([0-9,]+)", 1), F.lit(","), F.lit("")))
