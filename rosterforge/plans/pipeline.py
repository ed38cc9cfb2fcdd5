"""The layers of a build, from raw tables to scores and quality tables."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field, replace
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterforge.config import Config
from rosterforge.functions.mapping import default_mapping
from rosterforge.operators import contacts, dedupe, enrichment, quality, resolve, scoring, standardize
from rosterforge.operators.skew import hot_row_keys
from rosterforge.operators.constraints import LAYER_CONSTRAINTS, constraint_report
from rosterforge.sources.staging import PACKED, stored

# Layer of every table that a build writes; staging stays a view.
LAYERS = {
    "stg_accounts": "staging",
    "stg_contacts": "staging",
    "stg_engagement": "staging",
    "stg_enrichment": "staging",
    "int_accounts_resolved": "intermediate",
    "int_enrichment_conflicts": "intermediate",
    "int_contacts_deduped": "intermediate",
    "dim_account": "marts",
    "dim_contact": "marts",
    "fct_engagement": "marts",
    "int_account_fit": "intermediate",
    "int_contact_engagement": "intermediate",
    "fct_prospect_scores": "marts",
    "dq_failures": "quality",
    "dq_summary": "quality",
}


@dataclass
class Build:
    """Every table of a build, worked out when first asked for.

    Tables that several others read are stored once, below `root` if there is one and otherwise
    in the shared scratch folder; the rest stay lazy.
    """

    accounts: DataFrame
    contacts: DataFrame
    engagement: DataFrame
    enrichment_wide: DataFrame
    cfg: Config
    mapping: DataFrame | None = None
    root: str | None = None
    written: set[str] = field(default_factory=set)

    def _write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{LAYERS[name]}/{name}"
        df.write.mode("overwrite").options(**PACKED).parquet(path)
        self.written.add(name)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        return stored(df, name) if self.root is None else self._write(df, name)

    @cached_property
    def stg_accounts(self) -> DataFrame:
        return standardize.standardize_accounts(self.accounts)

    @cached_property
    def stg_contacts(self) -> DataFrame:
        return standardize.standardize_contacts(self.contacts, self.cfg)

    @cached_property
    def stg_engagement(self) -> DataFrame:
        return standardize.standardize_events(self.engagement)

    @cached_property
    def enrichment(self) -> DataFrame:
        """Long form, matched to accounts."""
        return enrichment.enrichment_long(self.enrichment_wide, self.accounts, self.cfg)

    @cached_property
    def stg_enrichment(self) -> DataFrame:
        return enrichment.standardize_enrichment(self.enrichment, self.cfg)

    @cached_property
    def industry_mapping(self) -> DataFrame:
        return self.mapping if self.mapping is not None else default_mapping(self.accounts.sparkSession)

    @cached_property
    def hot_accounts(self) -> dict[int, int]:
        """Hot account ids among all contacts; every later table of contacts has fewer rows of each."""
        keys = ["account_id"]
        return hot_row_keys(self.contacts.select(*keys), keys, self.cfg)

    @cached_property
    def int_accounts_resolved(self) -> DataFrame:
        return self._keep(
            resolve.resolve_accounts(
                self.stg_accounts, self.stg_enrichment, self.industry_mapping, self.cfg
            ),
            "int_accounts_resolved",
        )

    @cached_property
    def int_enrichment_conflicts(self) -> DataFrame:
        return resolve.conflict_log(self.int_accounts_resolved)

    @cached_property
    def int_contacts_deduped(self) -> DataFrame:
        return self._keep(
            dedupe.dedupe_contacts(self.stg_contacts, self.cfg), "int_contacts_deduped"
        )

    @cached_property
    def dim_account(self) -> DataFrame:
        return resolve.dim_account(self.int_accounts_resolved)

    @cached_property
    def dim_contact(self) -> DataFrame:
        return self._keep(
            contacts.dim_contact(self.int_contacts_deduped, self.stg_accounts, self.cfg, self.hot_accounts), "dim_contact"
        )

    @cached_property
    def survivor_links(self) -> DataFrame:
        return contacts.survivor_links(self.int_contacts_deduped, self.dim_contact, self.cfg)

    @cached_property
    def fct_engagement(self) -> DataFrame:
        return contacts.repoint_events(self.stg_engagement, self.survivor_links, self.cfg)

    @cached_property
    def int_account_fit(self) -> DataFrame:
        return scoring.account_fit(self.dim_account, self.cfg)

    @cached_property
    def int_contact_engagement(self) -> DataFrame:
        return scoring.engagement_score(self.dim_contact, self.stg_engagement, self.cfg, self.survivor_links)

    @cached_property
    def fct_prospect_scores(self) -> DataFrame:
        return scoring.prospect_scores(
            self.dim_contact, self.dim_account, self.int_contact_engagement, self.cfg, self.hot_accounts
        )

    @cached_property
    def dq_failures(self) -> DataFrame:
        return quality.dq_failures(
            self.int_contacts_deduped, self.stg_accounts, self.int_accounts_resolved, self.cfg, self.hot_accounts
        )

    @cached_property
    def dq_summary(self) -> DataFrame:
        return quality.dq_summary(self.dq_failures, self.contacts, self.accounts)

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in LAYERS}

    def constraints(self) -> DataFrame:
        return constraint_report(self.tables(), LAYER_CONSTRAINTS)

    def materialize(self, root: str) -> dict[str, DataFrame]:
        """Write each layer table once, in order; later tables read the stored copies.

        Staging tables are recomputed on read. A stored table survives the loss of executors
        and cuts the lineage of everything built on it.
        """
        self.root = root
        for name, layer in LAYERS.items():
            if layer == "staging":
                continue
            df = getattr(self, name)
            if name not in self.written:
                self.__dict__[name] = self._write(df, name)
        return self.tables()

    def publish(self, root: str) -> str:
        """Materialize into a folder of its own below `root`, and put it in force when it is complete.

        `read_layers` never sees half a build: the line in `root/manifest` comes last, and a build
        that dies leaves the one before it as it was. Returns the build's id.
        """
        build_id = uuid.uuid4().hex
        self.materialize(f"{root}/builds/{build_id}")
        line = self.accounts.sparkSession.createDataFrame(
            [(build_id, sorted(self.written))], "build_id string, tables array<string>"
        ).withColumn("finished_at", F.current_timestamp())
        line.coalesce(1).write.mode("append").parquet(f"{root}/manifest")
        return build_id

    def create_views(self) -> None:
        """A temp view per table, for SQL users."""
        for name, df in self.tables().items():
            df.createOrReplaceTempView(name)


def read_layers(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The stored tables of the newest complete build below `root`."""
    newest = spark.read.parquet(f"{root}/manifest").agg(
        F.max_by(F.struct("build_id", "tables"), F.struct("finished_at", "build_id")).alias("b")
    ).first()["b"]
    return {
        name: spark.read.parquet(f"{root}/builds/{newest['build_id']}/{LAYERS[name]}/{name}") for name in newest["tables"]
    }


def build(accounts: DataFrame, contacts: DataFrame, engagement: DataFrame, enrichment_wide: DataFrame, cfg: Config,
          mapping: DataFrame | None = None) -> Build:
    if cfg.most_rows is None:
        # read from file footers; no table that is joined by a key has more rows than the largest input
        tables = (accounts, contacts, engagement, enrichment_wide)
        counts = reduce(DataFrame.unionAll, [t.agg(F.count(F.lit(1)).alias("n")) for t in tables])
        cfg = replace(cfg, most_rows=counts.agg(F.max("n")).first()[0])
    return Build(accounts, contacts, engagement, enrichment_wide, cfg, mapping)
