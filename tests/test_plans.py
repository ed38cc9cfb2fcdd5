"""The plans are the ones a large cluster needs, and the queries agree with their SQL."""

from __future__ import annotations

import os
import sys

import pytest

from conftest import SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import canonical, connect  # noqa: E402


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


# one value per score or per slice passes through a single task in these; never the rows
SMALL_WINDOWS = {"fct_prospect_scores"}


@pytest.fixture
def plans(monkeypatch):
    """Plans of all tables that a build stores, taken before they are written."""
    from rosterforge.sources import staging

    seen, original = [], staging.stored

    def recording(df, name):
        seen.append((name, plan_of(df)))
        return original(df, name)

    for module in [m for n, m in sys.modules.items() if n.startswith("rosterforge") and hasattr(m, "stored")]:
        monkeypatch.setattr(module, "stored", recording)
    return seen


@pytest.mark.parametrize("name", [
    "stg_enrichment", "int_contacts_deduped", "dim_contact", "int_contact_engagement", "fct_prospect_scores", "dq_failures",
])
def test_no_plan_gathers_or_crosses_rows(spark, plans, name):
    from rosterforge.plans.queries import built as fresh

    last = plan_of(getattr(fresh(spark, SMALL), name))
    for table, plan in [*plans, (name, last)]:
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, table
        if name not in SMALL_WINDOWS:
            assert "SinglePartition" not in plan, table


def test_duplicates_take_one_read_and_one_exchange_of_the_contacts(spark, plans):
    from rosterforge.plans.queries import built as fresh

    fresh(spark, SMALL).int_contacts_deduped
    exact = dict(plans)["exact"].split("== Physical Plan ==")[1]
    assert "SortAggregate" not in exact and "Join" not in exact
    assert exact.count("Exchange") == 1 and exact.count("FileScan") == 1
    others = [plan.split("== Physical Plan ==")[1] for name, plan in plans if name != "exact"]
    assert not any("orders.parquet" in plan for plan in others)


def test_latest_enrichment_limits_before_the_shuffle(built):
    assert "WindowGroupLimit" in plan_of(built.stg_enrichment)


def test_scan_reads_only_what_is_needed(spark):
    plan = plan_of(entry.queries()["standardize_events"](spark, SMALL).select("event_type"))
    assert "ReadSchema: struct<event_type:string>" in plan


def test_every_query_has_sql():
    from rosterforge.plans.oracle import oracle_queries
    from rosterforge.plans.queries import QUERIES

    assert set(QUERIES) == set(oracle_queries())
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


SAMPLE = [
    "raw_load", "provider_ingest", "batch_export_index", "normalize_page_domains", "contact_emails_titles",
    "enrichment_latest", "fuzzy_pairs", "clean_contacts", "accounts_resolved", "prospect_scores", "dq_summary",
    "constraint_report", "layer_tables", "planted_manifest", "strict_tradeoff", "change_plan", "merged_ids",
    "two_rule_payloads", "forced_dry_run", "planted_sparse_manifest", "quarantine_leaks_unclean",
]


@pytest.mark.parametrize("name", SAMPLE)
def test_query_agrees_with_its_sql(spark, name):
    df = entry.queries()[name](spark, SMALL)
    got = canonical([tuple(r) for r in df.collect()], df.columns)
    cur = connect(SMALL).execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == canonical(cur.fetchall(), columns) and got


def test_layers_are_written_once_and_read_back(spark, tmp_path):
    from rosterforge.plans.queries import built as fresh

    b = fresh(spark, SMALL)
    tables = b.materialize(str(tmp_path))
    for layer, name in (("intermediate", "int_contacts_deduped"), ("marts", "fct_prospect_scores"), ("quality", "dq_summary")):
        assert all(f"{tmp_path}/{layer}/{name}/" in f for f in tables[name].inputFiles())
    b.create_views()
    per_tier = spark.sql("select tier, count(*) from fct_prospect_scores group by tier").collect()
    assert sum(r[1] for r in per_tier) == tables["dim_contact"].count()


@pytest.mark.parametrize("gone", ["corpus_pipeline", "rosterforge.llm", "rosterforge.llm.queries"])
def test_the_library_stands_without_the_training_data_operators(monkeypatch, gone):
    from rosterforge.plans.queries import QUERIES

    for name in [n for n in sys.modules if n == "corpus_pipeline" or n.startswith("rosterforge.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, gone, None)    # imports of it fail as if it were not there
    assert set(entry.queries()) == set(QUERIES) == set(entry.oracle_sql())
