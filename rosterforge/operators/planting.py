"""Planting known errors in a table, with a manifest that says where they are.

Choices depend on a digest of (seed, salt word, id), so they are the same for any partitioning
and on a rerun. Error kinds are given disjoint sets of rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterforge.config import INDUSTRY_BUCKETS, Config
from rosterforge.functions.dates import ref_date
from rosterforge.operators.ranking import first_by_hash
from rosterforge.sources.staging import stored

# The order in which kinds take their rows, and the forms of a duplicate.
CONTACT_KINDS = ("missing_title", "invalid_email", "stale_record", "orphan_contact", "duplicate_contact")
DUPLICATE_FORMS = ("email_case", "name_typo", "whitespace", "exact")
STALE_DAYS = (400, 900)
MANIFEST = (
    "error_id", "error_type", "table_name", "record_id", "field", "original_value", "planted_value",
    "related_record_id",
)


def digest(id_col: str, word: str, cfg: Config) -> Column:
    return F.md5(F.concat(F.lit(f"{cfg.random_seed}:{word}:"), F.col(id_col)))


def _draw(id_col: str, word: str, n: int, cfg: Config) -> Column:
    """An evenly spread number below n that depends on the row id only."""
    head = F.substring(digest(id_col, word, cfg), 1, 8)
    return F.pmod(F.conv(head, 16, 10).cast("bigint"), F.lit(n)).cast("int")


def _pick(options: Sequence[Column], choice: Column) -> Column:
    out = options[-1]
    for i, option in enumerate(options[:-1]):
        out = F.when(choice == i, option).otherwise(out)
    return out


def assign_kinds(
    df: DataFrame, id_col: str, kinds: Sequence[str], cfg: Config
) -> tuple[DataFrame, DataFrame]:
    """Give round(n * rate) rows to each kind, in digest order, one stretch after the other.

    Returns the rows around those stretches, stored, with _kind (NULL for rows just behind the
    last stretch), _nth (1-based inside a kind) and _total, and the rows no kind can reach.
    """
    ends = [F.lit(0).cast("bigint")]
    for kind in kinds:
        quota = F.bround(F.col("_total") * F.lit(float(cfg.error_rates[kind])), 0).cast("bigint")
        ends.append(ends[-1] + quota)
    near, rest = first_by_hash(df, digest(id_col, "pool", cfg), id_col, "_pos", "_total", ends[-1])
    kind_col, nth = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    for i in reversed(range(len(kinds))):
        inside = F.col("_pos") <= ends[i + 1]
        kind_col = F.when(inside, kinds[i]).otherwise(kind_col)
        nth = F.when(inside, F.col("_pos") - ends[i]).otherwise(nth)
    return stored(near.withColumns({"_kind": kind_col, "_nth": nth}).drop("_pos"), "planted"), rest


def break_email(email: Column, choice: Column) -> Column:
    """Five ways to make an address invalid."""
    first_dot = F.instr(email, ".")
    spaced = F.when(
        first_dot > 0, F.concat(F.substring(email, F.lit(1), first_dot - 1), F.lit(" "), F.substr(email, first_dot + 1))
    ).otherwise(email)

    def swapped(old: str, new: str) -> Column:
        return F.replace(email, F.lit(old), F.lit(new))

    return _pick([swapped("@", ""), swapped("@", "@@"), swapped(".test", ""), spaced, swapped("@", ".@")], choice)


def swap_last_two(name: Column) -> Column:
    n = F.length(name)
    swapped = F.concat(F.substring(name, F.lit(1), n - 2), F.substr(name, n, F.lit(1)), F.substr(name, n - 1, F.lit(1)))
    return F.when(n > 3, swapped).otherwise(name)


def largest_numbers(contacts: DataFrame, accounts: DataFrame | None) -> tuple[int, int]:
    """Largest number at the end of a contact id and of an account id, from one pass over the ids.

    Ids that start above it are not taken. Ids that end in more than 18 digits or in none do not count.
    """
    def number(column: str) -> Column:
        return F.regexp_extract(column, r"([0-9]{1,18})\z", 1).try_cast("bigint")

    numbers = contacts.select(number("contact_id").alias("c"), number("account_id").alias("a"))
    if accounts is not None:
        numbers = numbers.unionAll(accounts.select(F.lit(None).cast("bigint"), number("account_id")))
    contact, account = numbers.agg(F.max("c"), F.max("a")).first()
    return contact or 0, account or 0


def plant_contact_errors(
    contacts: DataFrame, cfg: Config, accounts: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(contacts with errors, manifest). Expects the raw contact columns, all text.

    New contact ids start above the largest there is, and invented account ids above the largest
    of `accounts` and of the contacts' own, so neither can be a real one.
    """
    first_copy, largest_account = largest_numbers(contacts, accounts)
    first_orphan = max(90_000, largest_account)
    marked, rest = assign_kinds(contacts, "contact_id", CONTACT_KINDS, cfg)
    kind = F.col("_kind")
    low, high = STALE_DAYS
    aged = F.date_sub(ref_date(cfg.reference_date), F.lit(low) + _draw("contact_id", "age", high - low + 1, cfg))
    planted = {
        "missing_title": ("title", F.lit("")),
        "invalid_email": ("email", break_email(F.col("email"), _draw("contact_id", "break", 5, cfg))),
        "stale_record": ("source_updated_at", aged.cast("string")),
        "orphan_contact": ("account_id", F.format_string("ACC-%05d", F.lit(first_orphan) + F.col("_nth"))),
    }
    original = F.lit(None).cast("string")
    value, changed_field = original, original
    for name, (column, new) in planted.items():
        original = F.when(kind == name, F.col(column)).otherwise(original)
        value = F.when(kind == name, new).otherwise(value)
        changed_field = F.when(kind == name, column).otherwise(changed_field)
    form = _pick([F.lit(f) for f in DUPLICATE_FORMS], _draw("contact_id", "form", 4, cfg))
    is_copy = kind == "duplicate_contact"
    copy_id = F.format_string("CON-%08d", F.lit(first_copy) + F.col("_nth"))
    marked = marked.withColumns({
        "_original": original,
        "_value": value,
        "_field": F.when(is_copy, form).otherwise(changed_field),
        "_copy_id": F.when(is_copy, copy_id),
    })
    kept = marked.withColumns(
        {col: F.when(kind == name, F.col("_value")).otherwise(F.col(col)) for name, (col, _) in planted.items()}
    )
    email, first, last = F.col("email"), F.col("first_name"), F.col("last_name")
    spaced = form == "whitespace"
    copies = marked.filter(is_copy).withColumns({
        "email": F.when(form == "email_case", F.upper(email))
        .when(spaced, F.concat(F.lit(" "), email, F.lit(" ")))
        .otherwise(email),
        "first_name": F.when(form == "name_typo", swap_last_two(first)).otherwise(first),
        "last_name": F.when(spaced, F.concat(last, F.lit(" "))).otherwise(last),
        "contact_id": F.col("_copy_id"),
    })
    manifest = marked.filter(kind.isNotNull()).select(
        F.concat(F.lit("ERR-"), kind, F.lit("-"), F.col("_nth").cast("string")).alias("error_id"),
        kind.alias("error_type"),
        F.lit("contacts").alias("table_name"),
        F.coalesce("_copy_id", "contact_id").alias("record_id"),
        F.col("_field").alias("field"),
        F.col("_original").alias("original_value"),
        F.col("_value").alias("planted_value"),
        F.when(is_copy, F.col("contact_id")).alias("related_record_id"),
    )
    names = contacts.columns
    return rest.unionByName(kept.select(*names)).unionByName(copies.select(*names)), manifest


def plant_account_errors(accounts: DataFrame, cfg: Config) -> tuple[DataFrame, DataFrame]:
    """(accounts with a wrong seed industry on some rows, manifest)."""
    kind = "conflicting_industry"
    marked, rest = assign_kinds(accounts, "account_id", (kind,), cfg)
    seed = F.col("seed_industry")
    # a bucket other than the row's own: step 1 to 11 places ahead in the ring of twelve
    ring = F.array(*[F.lit(b) for b in INDUSTRY_BUCKETS])
    n = len(INDUSTRY_BUCKETS)
    step = _draw("account_id", "industry", n - 1, cfg) + 1
    other = F.element_at(ring, F.pmod(F.array_position(ring, seed) - 1 + step, F.lit(n)).cast("int") + 1)
    marked = marked.withColumn("_planted", F.when(F.col("_kind").isNotNull(), other))
    manifest = marked.filter(F.col("_kind").isNotNull()).select(
        F.concat(F.lit(f"ERR-{kind}-"), F.col("_nth").cast("string")).alias("error_id"),
        F.lit(kind).alias("error_type"),
        F.lit("accounts").alias("table_name"),
        F.col("account_id").alias("record_id"),
        F.lit("seed_industry").alias("field"),
        seed.alias("original_value"),
        F.col("_planted").alias("planted_value"),
        F.lit(None).cast("string").alias("related_record_id"),
    )
    dirty = marked.withColumn("seed_industry", F.coalesce("_planted", "seed_industry"))
    return rest.unionByName(dirty.select(*accounts.columns)), manifest
