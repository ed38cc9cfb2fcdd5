"""Stable identifiers and fingerprints built from column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The URL namespace of RFC 4122, and its variant bits as hex digits.
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"
HEX_DIGITS = "0123456789abcdef"
VARIANT_DIGITS = "89ab89ab89ab89ab"


def uuid5_digest(name: Column, namespace: str = URL_NAMESPACE) -> Column:
    """The digest that a version 5 id is cut from."""
    return F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "UTF-8")))


def uuid5_of(h: Column) -> Column:
    """The id cut from its digest. Six pieces refer to it: give it as a column, or it may be worked out six times."""
    return F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.concat(F.lit("5"), F.substring(h, 14, 3)),
        F.concat(F.translate(F.substring(h, 17, 1), HEX_DIGITS, VARIANT_DIGITS), F.substring(h, 18, 3)),
        F.substring(h, 21, 12),
    )


def uuid5(name: Column, namespace: str = URL_NAMESPACE) -> Column:
    """RFC 4122 version 5 id of a text."""
    return uuid5_of(uuid5_digest(name, namespace))


def target_name(path: str, external_id: Column) -> Column:
    return F.concat(F.lit(f"{path}|"), external_id)


def target_id(path: str, external_id: Column) -> Column:
    """Surrogate id of a record addressed by (path, external id)."""
    return uuid5(target_name(path, external_id))


def fingerprint(payload: Column) -> Column:
    """sha1 of a struct whose fields are already in name order; empty fields are left out."""
    return F.sha1(F.to_json(payload))
