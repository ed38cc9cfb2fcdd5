"""Standardising emails, domains, names and job titles with built-in column functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns, replacements and ordered rules that decide results.
EMAIL_PATTERN = r"\A[a-z0-9_%+-]+(\.[a-z0-9_%+-]+)*@[a-z0-9-]+(\.[a-z0-9-]+)*\.[a-z]{2,}\z"
TITLE_EXPANSIONS = (("Sr.", "Senior"), ("Dir.", "Director of"), ("VP, ", "VP of "))
TITLE_CASE_FIXES = (("Vp ", "VP "), (" Of ", " of "), ("Revops", "RevOps"), (" And ", " and "))
SENIORITY_RULES = (
    ("C-level", ("chief %", "% officer")),
    ("VP", ("vp%", "vice president%")),
    ("Director", ("director%", "head of%")),
    ("Manager", ("%manager%",)),
)
DEPARTMENT_RULES = (
    ("RevOps", ("%revenue operations%", "%revops%", "%sales operations%")),
    ("Finance", ("%financ%",)),
    ("Operations", ("%operat%",)),
    ("Data", ("%data%", "%analytics%")),
    ("Engineering", ("%engineer%", "%technology%")),
    ("Sales", ("%sales%", "%account executive%", "%revenue%")),
    ("Marketing", ("%market%", "%growth%")),
)


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def normalize_email(email: Column) -> Column:
    return F.lower(F.trim(email))


def is_valid_email(email: Column) -> Column:
    return email.rlike(EMAIL_PATTERN)


def normalize_domain(domain: Column, mode: str = "staging") -> Column:
    """The three spellings of a domain that are compared with each other.

    loader   provider files: scheme and www. removed one after the other, no trailing slash
    staging  account table: scheme and www. removed while still case-sensitive, slash kept
    match    account side of the provider match: only trimmed and lowered
    """
    if mode == "match":
        return F.lower(F.trim(domain))
    if mode == "staging":
        return F.lower(F.regexp_replace(F.trim(domain), r"\A(https?://)?(www\.)?", ""))
    if mode != "loader":
        raise ValueError(f"unknown domain mode {mode!r}")
    # the provider files are read with wider whitespace rules than the account table
    stripped = F.lower(F.regexp_replace(domain, r"(?U)\A\s+|\s+\z", ""))
    bare = F.regexp_replace(stripped, r"\A(https://)?(http://)?(www\.)?", "")
    return F.when(stripped != "", F.regexp_replace(bare, r"/+\z", ""))


def _replaced(c: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def expand_title(raw: Column) -> Column:
    """Collapse whitespace and spell out abbreviations; still in the source's casing."""
    collapsed = F.regexp_replace(F.trim(raw), r"\s+", " ")
    return blank_to_null(F.trim(_replaced(blank_to_null(collapsed), TITLE_EXPANSIONS)))


def title_case(lowered: Column) -> Column:
    return _replaced(F.initcap(lowered), TITLE_CASE_FIXES)


def _first_rule(text: Column, rules: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """Label of the first rule with a LIKE pattern that fits, else NULL."""
    chosen = None
    for label, patterns in rules:
        fits = text.like(patterns[0])
        for p in patterns[1:]:
            fits = fits | text.like(p)
        chosen = F.when(fits, label) if chosen is None else chosen.when(fits, label)
    return chosen


def seniority(lowered: Column) -> Column:
    """Level of an expanded, lower-case title; anything unrecognised is an individual contributor."""
    return F.when(lowered.isNotNull(), F.coalesce(_first_rule(lowered, SENIORITY_RULES), F.lit("IC")))


def department(lowered: Column) -> Column:
    """Department of an expanded, lower-case title, or NULL."""
    return _first_rule(lowered, DEPARTMENT_RULES)


def persona(dept: Column, level: Column) -> Column:
    core = dept.isin("Data", "RevOps")
    return (
        F.when(core & level.isin("Director", "VP", "C-level"), "Data/RevOps leader")
        .when(core, "Data/RevOps practitioner")
        .when(level.isin("VP", "C-level"), "Executive")
        .when(level.isNull(), "Unknown")
        .otherwise("Other")
    )


def rewrite_email(email: Column, mode: str = "example_com") -> Column:
    """jane@acme.test becomes jane+acme@example.com, a valid address nobody can receive."""
    if mode == "as_is":
        return email
    return F.regexp_replace(email, r"(?s)\A([^@]*)@(.*)\.test\z", "$1+$2@example.com")
