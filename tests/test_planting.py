"""Planted errors: rates, truthful manifest, independence from partitions, and full recall."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, rows
from rosterforge.functions.text import is_valid_email
from rosterforge.operators import planting, quality, recall
from rosterforge.plans.bindings import bind_clean
from rosterforge.plans.queries import planted


@pytest.fixture(scope="module")
def dirty(spark):
    build, manifest = planted(spark, SMALL)
    return build, manifest


def test_counts_match_the_rates(spark, dirty, cfg):
    clean = bind_clean(spark, SMALL)
    n, accounts = clean.contacts.count(), clean.accounts.count()
    got = {r["error_type"]: r["count"] for r in dirty[1].groupBy("error_type").count().collect()}
    for kind, rate in cfg.error_rates.items():
        assert got[kind] == round((accounts if kind == "conflicting_industry" else n) * rate)
    assert dirty[0].contacts.count() == n + got["duplicate_contact"]


def test_sets_are_disjoint_and_ids_unique(dirty):
    contacts = dirty[1].filter("table_name = 'contacts'")
    hit = contacts.select(F.coalesce("related_record_id", "record_id").alias("r"))
    assert hit.distinct().count() == hit.count()
    assert dirty[1].select("error_id").distinct().count() == dirty[1].count()


def test_manifest_tells_the_truth(dirty, spark):
    build, manifest = dirty
    m = manifest.join(build.contacts, manifest["record_id"] == build.contacts["contact_id"])
    assert m.filter("error_type = 'missing_title' and title <> ''").count() == 0
    assert m.filter((F.col("error_type") == "invalid_email") & is_valid_email(F.col("email"))).count() == 0
    assert m.filter("error_type = 'stale_record' and source_updated_at <> planted_value").count() == 0
    assert m.filter("error_type = 'duplicate_contact'").count() == manifest.filter("error_type = 'duplicate_contact'").count()
    forms = {r["field"] for r in m.filter("error_type = 'duplicate_contact'").select("field").distinct().collect()}
    assert forms == set(planting.DUPLICATE_FORMS)
    known = build.accounts.select(F.col("account_id").alias("planted_value"))
    assert manifest.filter("error_type = 'orphan_contact'").join(known, "planted_value").count() == 0
    assert manifest.filter("error_type = 'conflicting_industry' and original_value = planted_value").count() == 0


def test_new_ids_are_free_where_ids_have_gaps(spark, cfg):
    clean = bind_clean(spark, SMALL)
    number = F.substring("contact_id", 5, 20).cast("bigint")
    contacts = clean.contacts.withColumn("contact_id", F.format_string("CON-%08d", number * 2))
    taken = F.format_string("ACC-%05d", 90_000 + F.monotonically_increasing_id())
    accounts = clean.accounts.coalesce(1).withColumn("account_id", taken)
    dirty, manifest = planting.plant_contact_errors(contacts, cfg, accounts)
    assert dirty.select("contact_id").distinct().count() == dirty.count()
    orphans = manifest.filter("error_type = 'orphan_contact'").select(F.col("planted_value").alias("account_id"))
    assert orphans.count() > 0 and orphans.join(accounts, "account_id").count() == 0


def test_planting_does_not_depend_on_partitions(spark, cfg):
    contacts = bind_clean(spark, SMALL).contacts
    a = planting.plant_contact_errors(contacts.repartition(1), cfg)
    b = planting.plant_contact_errors(contacts.repartition(11, "email"), cfg)
    assert rows(a[0]) == rows(b[0]) and rows(a[1]) == rows(b[1])


def test_every_planted_error_is_found_and_nothing_else(dirty):
    build, manifest = dirty
    detail = recall.planted_detail(manifest, build.dq_failures, build.int_accounts_resolved).cache()
    assert recall.missed_by_rules(detail).count() == 0
    assert recall.missed_detectable(detail).count() == 0
    assert quality.unexplained_alarms(build.dq_failures, manifest).count() == 0
    for r in recall.planted_vs_caught(detail).collect():
        assert r["detectable_recall_pct"] in (100.0, None)
    assert quality.quarantine_leaks(build.dim_contact, build.dq_failures).count() == 0
    line = quality.reconciliation(build.contacts, build.dim_contact, build.dq_failures).first()
    assert line["is_explained"]


def test_swap_and_break_helpers(spark):
    df = spark.createDataFrame([("Anna", "a.b@c.test"), ("Bob", "ab@c.test")], "n string, e string")
    assert [r[0] for r in df.select(planting.swap_last_two(F.col("n"))).collect()] == ["Anan", "Bob"]
    broken = [[r[0] for r in df.select(planting.break_email(F.col("e"), F.lit(i))).collect()] for i in range(5)]
    assert broken == [
        ["a.bc.test", "abc.test"], ["a.b@@c.test", "ab@@c.test"], ["a.b@c", "ab@c"], ["a b@c.test", "ab@c test"],
        ["a.b.@c.test", "ab.@c.test"],
    ]
