"""Declared constraints on tables: unique, not null, accepted values, relationships."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from rosterforge import config as c


@dataclass(frozen=True)
class Constraints:
    """What must hold for one table. `relationships` maps a column to (table, column)."""

    table: str
    unique: Sequence[str] = ()
    not_null: Sequence[str] = ()
    accepted: Mapping[str, Sequence[str]] = field(default_factory=dict)
    relationships: Mapping[str, tuple[str, str]] = field(default_factory=dict)


# The constraints every build must satisfy.
LAYER_CONSTRAINTS = (
    Constraints("stg_accounts", ("account_id", "domain"), ("account_id", "domain")),
    Constraints("stg_contacts", ("contact_id",), ("contact_id",), {"seniority": c.SENIORITIES}),
    Constraints("stg_enrichment", ("account_id",), ("account_id",), {"provider": c.PROVIDERS}),
    Constraints(
        "dim_account", ("account_id",), ("account_id", "industry"),
        {"enrichment_status": c.ENRICHMENT_STATUSES},
    ),
    Constraints(
        "dim_contact", ("contact_id", "email"), ("contact_id", "email", "account_id"), {},
        {"account_id": ("dim_account", "account_id")},
    ),
    Constraints(
        "fct_engagement", ("event_id",), ("event_id",), {}, {"contact_id": ("dim_contact", "contact_id")}
    ),
    Constraints(
        "fct_prospect_scores", ("contact_id",), ("contact_id", "tier"), {"tier": c.TIERS, "stage": c.STAGES}
    ),
    Constraints("int_account_fit", ("account_id",), ("account_id",)),
)

# The option lists of the select fields a target system is told to accept.
SELECT_OPTIONS = {
    "industry": c.INDUSTRY_BUCKETS,
    "enrichment_status": c.ENRICHMENT_STATUSES,
    "tier": c.TIERS,
    "stage": c.STAGES,
    "persona": c.PERSONAS,
    "seniority": c.SENIORITIES,
}


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Values seen more than once, with their counts; NULL is not a value."""
    return (
        df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    )


def orphan_keys(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Distinct child values without a parent, with their row counts.

    The child shrinks to one row per value before the join, so frequent values cost nothing.
    """
    values = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return values.join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")


def _common_type(spark: SparkSession, a: DataType, b: DataType) -> DataType:
    """The type in which Spark compares the two."""
    both = F.array(F.lit(None).cast(a), F.lit(None).cast(b))
    return spark.range(0).select(both.alias("both")).schema["both"].dataType.elementType


def _entry(rule: int, key: Column, is_child: bool, found: Column) -> Column:
    """What one row contributes to a rule, or nothing."""
    entry = F.struct(F.lit(rule).alias("rule"), key.cast("string").alias("key"), F.lit(int(is_child)).alias("child"))
    return F.when(found, entry)


def constraint_report(tables: Mapping[str, DataFrame], specs: Iterable[Constraints]) -> DataFrame:
    """(table, column, constraint, failures) for every declared constraint.

    Failures are rows, except for unique: there they are the values that repeat. Every table is read
    once: a row becomes one (rule, key, side) entry for each rule it bears on, and one aggregation by
    rule and key settles all of them. Entries are combined before that shuffle, so frequent keys cost
    nothing. A missing key breaks neither unique nor a relationship.
    """
    specs = list(specs)
    lines: list[tuple[int, str, str, str]] = []
    entries: dict[str, list[Column]] = {}

    def rule(table: str, column: str, name: str) -> int:
        lines.append((len(lines), table, column, name))
        return lines[-1][0]

    for spec in specs:
        df = tables[spec.table]
        own = entries.setdefault(spec.table, [])
        nothing = F.lit(None)
        for col in spec.not_null:
            own.append(_entry(rule(spec.table, col, "not_null"), nothing, True, F.col(col).isNull()))
        for col, values in spec.accepted.items():
            own.append(_entry(rule(spec.table, col, "accepted_values"), nothing, True, ~F.col(col).isin(*values)))
        for col in spec.unique:
            own.append(_entry(rule(spec.table, col, "unique"), F.col(col), True, F.col(col).isNotNull()))
        for col, (parent, parent_col) in spec.relationships.items():
            number = rule(spec.table, col, "relationships")
            kind = _common_type(df.sparkSession, df.schema[col].dataType, tables[parent].schema[parent_col].dataType)
            own.append(_entry(number, F.col(col).cast(kind), True, F.col(col).isNotNull()))
            entries.setdefault(parent, []).append(
                _entry(number, F.col(parent_col).cast(kind), False, F.col(parent_col).isNotNull())
            )
    if not lines:
        raise ValueError("no constraint is declared")
    parts = [
        tables[name].select(F.explode(F.array_compact(F.array(*own))).alias("entry")).select("entry.*")
        for name, own in entries.items() if own
    ]
    settled = reduce(DataFrame.unionAll, parts).groupBy("rule", "key").agg(
        F.sum("child").alias("n"), F.min("child").alias("side")
    )
    kinds = {name: [number for number, _, _, n in lines if n == name] for name in ("unique", "relationships")}
    failures = (
        F.when(F.col("rule").isin(*kinds["unique"]), (F.col("n") > 1).cast("bigint"))
        .when(F.col("rule").isin(*kinds["relationships"]), F.when(F.col("side") == 1, F.col("n")).otherwise(0))
        .otherwise(F.col("n"))
    )
    counted = settled.groupBy("rule").agg(F.sum(failures).alias("failures"))
    names = parts[0].sparkSession.createDataFrame(
        lines, "rule int, table_name string, column_name string, constraint_name string"
    )
    # one line a rule on both sides
    return names.join(F.broadcast(counted), "rule", "left").select(
        "table_name", "column_name", "constraint_name", F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures")
    )
