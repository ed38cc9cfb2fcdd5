"""Deduplication, resolution and scoring on hand-made rows and against brute force."""

from __future__ import annotations

import datetime as dt
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import rows
from rosterforge.config import Config
from rosterforge.operators import contacts as ct
from rosterforge.operators import dedupe, quality, resolve, scoring, standardize
from rosterforge.operators.skew import hot_keys, join_many_to_one, key_sizes, salted_join

RAW = "contact_id string, account_id string, first_name string, last_name string, email string, title string, source_updated_at string"
SMALL_LIMITS = dict(hot_key_rows=2, salts=3, block_names_max=1)


def raw_contacts(spark, lines):
    return spark.createDataFrame(lines, RAW)


@pytest.fixture(scope="module")
def deduped(spark):
    lines = [
        ("C1", "A1", "Steven", "Smith", "s@x.test", "", "2026-01-01"),
        ("C2", "A1", "Steven", "Smith", " S@X.test ", "CEO", "2025-01-01"),       # has a title: survives
        ("C3", "A1", "Steven", "Smith", "s@x.test", "CEO", "2025-01-01"),         # same, higher id
        ("C4", "A1", "Steve", "SMITH", "t@x.test", "CFO", "2026-01-01"),          # looks like C2
        ("C5", "A1", "Bob", "Smith", None, "CFO", "2026-01-01"),
        ("C6", "A1", "Bob", "Smith", None, "CFO", "2026-02-01"),                  # newest of the missing emails
        ("C7", "ZZ", "Ann", "Roe", "o@x.test", "CFO", "2026-02-01"),              # orphan survivor
        ("C8", "A1", "Ann", "Roe", "o@x.test", None, "2026-03-01"),
        ("C9", None, "Ann", "Poe", "p@x.test", "CFO", "2026-02-01"),
        ("D1", "A2", "Tim", "Loe", "bad@@x.test", "CFO", "2026-02-01"),
    ]
    contacts = standardize.standardize_contacts(raw_contacts(spark, lines), Config())
    return dedupe.dedupe_contacts(contacts, Config(**SMALL_LIMITS)).cache()


def accounts(spark):
    return spark.createDataFrame([("A1",), ("A2",)], "account_id string")


def test_survivor_rule(deduped):
    got = {r["contact_id"]: (r["group_size"], r["survivor_contact_id"], r["match_rule"]) for r in deduped.collect()}
    assert got["C1"] == got["C2"] == got["C3"] == (3, "C2", "exact_email")
    assert got["C4"] == (1, "C4", None)
    assert got["C5"] == got["C6"] == (2, "C6", "exact_email")
    assert got["C8"] == (2, "C7", "exact_email")


def test_possible_duplicates_are_hints_on_later_survivors(deduped):
    got = {r["contact_id"]: r["possible_duplicate_of"] for r in deduped.collect()}
    assert got["C4"] == "C2"
    assert [k for k, v in got.items() if v] == ["C4"]


def test_failures_of_missing_and_orphan_values(spark, deduped):
    got = rows(quality.contact_failures(deduped, accounts(spark), Config()).select("check_name", "record_id"))
    by_check = {}
    for check, record in got:
        by_check.setdefault(check, set()).add(record)
    assert by_check["invalid_email"] == {"D1"}            # a missing email is merged, not invalid
    assert by_check["duplicate_contact"] == {"C1", "C3", "C5", "C8"}
    assert by_check["orphan_contact"] == {"C7"}           # a missing account id is not an orphan
    assert by_check["possible_duplicate"] == {"C4"}


def test_group_with_orphan_survivor_vanishes(spark, deduped):
    clean = ct.dim_contact(deduped, accounts(spark), Config())
    assert rows(clean.select("contact_id", "merged_count")) == [("C2", 2), ("C4", 0)]


@pytest.mark.parametrize("limits", [{}, dict(hot_key_rows=20, salts=3)])
def test_every_id_of_a_long_merge_list_is_in_a_slice(spark, limits):
    """One group far larger than a slice, settled by the window and by salted minima."""
    lines = [(f"C{i:04d}", "A1", "Ann", "Roe", None if i % 2 else f"m{i}@x.test", "CEO", "2026-01-01") for i in range(900)]
    cfg = Config(list_slice=50, **limits)
    contacts = standardize.standardize_contacts(raw_contacts(spark, lines), cfg)
    got = dedupe.merged_ids(dedupe.dedupe_exact(contacts, "email", "contact_id", dedupe.contact_preference(), cfg), cfg)
    parts = got.collect()
    ids = [i for r in parts for i in r["merged_contact_ids"]]
    assert {r["survivor_contact_id"] for r in parts} == {"C0001"} and len(parts) == 9
    assert sorted(ids) == [f"C{i:04d}" for i in range(3, 900, 2)]
    assert max(len(r["merged_contact_ids"]) for r in parts) < 100


def test_a_contact_fails_a_check_once_though_its_account_is_listed_twice(spark, deduped):
    once = rows(quality.contact_failures(deduped, accounts(spark), Config()))
    assert rows(quality.contact_failures(deduped, accounts(spark).unionAll(accounts(spark)), Config())) == once


def test_hot_keys_are_bounded_by_their_share_of_the_rows(spark):
    sizes = spark.createDataFrame([(f"k{i}", 10 + i) for i in range(50)], "k string, n bigint")
    assert hot_keys(sizes, ["k"], "n", Config(hot_key_rows=100)) == {}
    assert len(hot_keys(sizes, ["k"], "n", Config(hot_key_rows=1, max_hot_keys=10_000))) == 50
    # a thirtieth of all rows is 57.5
    assert len(hot_keys(sizes, ["k"], "n", Config(hot_key_rows=1, max_hot_keys=30))) == 2


def test_merged_links_carry_the_group_size(spark, deduped):
    links = rows(dedupe.merged_links(deduped).filter("survivor_contact_id = 'C2'"))
    assert links == [("C2", "C1", 3), ("C2", "C3", 3)]


def test_events_follow_survivors(spark, deduped):
    clean = ct.dim_contact(deduped, accounts(spark), Config())
    links = ct.survivor_links(deduped, clean, Config(**SMALL_LIMITS))
    assert rows(links) == [("C1", "C2"), ("C2", "C2"), ("C3", "C2"), ("C4", "C4")]
    ts = dt.datetime(2026, 9, 27)
    events = spark.createDataFrame(
        [(f"E{i}", c, k, ts) for i, (c, k) in enumerate([("C1", "reply"), ("C3", "odd"), ("C7", "reply"), ("C3", "web_visit")])],
        "event_id string, contact_id string, event_type string, event_ts timestamp_ntz",
    )
    moved = ct.repoint_events(events, links, Config(**SMALL_LIMITS))
    assert rows(moved.select("event_id", "contact_id")) == [("E0", "C2"), ("E1", "C2"), ("E3", "C2")]
    direct = scoring.engagement_score(clean, moved, Config())
    totals = scoring.engagement_score(clean, events, Config(), links)
    assert rows(direct) == rows(totals) == [("C2", 65.0, 3, 1, 0, 1), ("C4", 0.0, 0, 0, 0, 0)]


def test_future_events_count_more_and_the_sum_is_capped(spark):
    people = spark.createDataFrame([("P",), ("Q",)], "contact_id string")
    events = spark.createDataFrame(
        [("P", "meeting", dt.datetime(2026, 10, 27)), ("Q", "web_visit", dt.datetime(2026, 10, 27))],
        "contact_id string, event_type string, event_ts timestamp_ntz",
    )
    got = scoring.engagement_score(people, events, Config()).select("contact_id", "engagement_score")
    assert rows(got) == [("P", 100.0), ("Q", 30.0)]


def brute_force_pairs(people):
    con = duckdb.connect()
    con.execute("create table p(id varchar, acc varchar, fn varchar, ln varchar, email varchar)")
    con.executemany("insert into p values (?, ?, ?, ?, ?)", people)
    return sorted(con.execute(
        """select a.id, min(b.id) from p a, p b where a.acc = b.acc and a.id > b.id and a.email <> b.email
           and lower(a.ln) = lower(b.ln) and jaro_winkler_similarity(lower(a.fn), lower(b.fn)) >= 0.9 group by 1"""
    ).fetchall())


@pytest.mark.parametrize("limits", [{}, dict(block_names_max=5), dict(block_names_max=1, hot_key_rows=10, salts=4)])
def test_fuzzy_pairs_equal_brute_force(spark, limits):
    """One block holds a third of all rows and most names differ by a letter or two."""
    rng = random.Random(11)
    stems = ["katharina", "kathrin", "steven", "stephan", "maria", "marian", "jo", "li", "anneliese", ""]
    people = []
    for i in range(900):
        name = list(rng.choice(stems))
        for _ in range(rng.randint(0, 2)):
            if name:
                name[rng.randrange(len(name))] = rng.choice("aeinrst")
        hot = i % 3 == 0
        first = "".join(name).title() if rng.random() > 0.02 else None
        people.append((f"P{rng.randrange(10**6):06d}-{i}", "HOT" if hot else f"A{i % 40}", first,
                       "Roe" if hot else rng.choice(["Roe", "ROE", "Lin"]), f"m{i}" if i % 50 else None))
    df = spark.createDataFrame(people, "contact_id string, account_id string, first_name string, last_name string, email string")
    got = rows(dedupe.fuzzy_pairs(df.repartition(5), Config(**limits)))
    assert got == brute_force_pairs(people)
    assert len(got) > 200


def test_crowded_blocks_give_few_candidates(spark, monkeypatch):
    """The sub-keys bring together distinct pairs only, a small multiple of the similar ones."""
    rng = random.Random(3)
    syllables = ["ka", "tha", "ri", "na", "ste", "ven", "mar", "lo", "bert", "ing"]
    names = sorted({"".join(rng.choice(syllables) for _ in range(rng.randint(2, 4))) for _ in range(1500)})
    people = [(f"P{i:05d}", "A", n, "Roe", f"m{i}") for i, n in enumerate(names)]
    df = spark.createDataFrame(people, "contact_id string, account_id string, first_name string, last_name string, email string")
    seen = []
    original = dedupe._candidates
    monkeypatch.setattr(dedupe, "_candidates", lambda *a: seen.append(original(*a).cache()) or seen[0])
    got = rows(dedupe.fuzzy_pairs(df, Config(block_names_max=64)))
    assert got == brute_force_pairs(people)
    candidates = seen[0]
    assert candidates.count() == candidates.distinct().count()
    similar = candidates.filter(dedupe.sim.jaro_winkler_similarity("_text", "_text2") >= 0.9).count()
    assert similar > 500 and candidates.count() < 6 * similar < len(names) ** 2 / 8


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_join_equals_plain_join(spark, how, null_safe):
    left = spark.createDataFrame([(i, "hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{i % 10}") for i in range(90)],
                                 "id int, k string")
    right = spark.createDataFrame([("hot", 1), (None, 2), ("k2", 3), ("k5", 4), ("gone", 5)], "k string, v int")
    cfg = Config(hot_key_rows=10, salts=7)
    hot = hot_keys(key_sizes(left, ["k"]), ["k"], "_rows", cfg)
    assert sorted(hot.values()) == [7, 7]
    many = hot_keys(key_sizes(left, ["k"]), ["k"], "_rows", Config(hot_key_rows=3, salts=2))
    assert max(many.values()) == 10      # thirty rows in slices of three
    got = salted_join(left, right, ["k"], how, hot, "id", null_safe)
    want = salted_join(left, right, ["k"], how, {}, "id", null_safe)
    assert rows(got.select(sorted(got.columns))) == rows(want.select(sorted(want.columns)))


def test_salting_refuses_keys_of_different_types(spark):
    left, right = spark.createDataFrame([(1, 1)], "id int, k int"), spark.createDataFrame([(1,)], "k bigint")
    with pytest.raises(TypeError):
        salted_join(left, right, ["k"], "inner", {1: 2}, "id")


def test_hot_rows_are_spread_over_slices(spark):
    many = spark.range(3000).select(F.col("id").cast("string").alias("id"),
                                    F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    one = many.select("k").distinct()
    cfg = Config(hot_key_rows=500, salts=16)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = join_many_to_one(many, one, ["k"], "inner", "id", cfg).withColumn("p", F.spark_partition_id())
        per_part = [r["count"] for r in joined.filter("k = 'hot'").groupBy("p").count().collect()]
        assert sum(per_part) == 1000 and max(per_part) < 600 and len(per_part) >= 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_headcount_rules(spark):
    df = spark.createDataFrame(
        [(14, 1001, 5000), (4613, 501, 1000), (100, 201, 500), (300, 201, 500), (None, 1, 10), (11, 2, None), (100011, 1, 50005)],
        "employee_count int, size_min int, size_max int",
    )
    got = resolve.headcount_plausibility(df).select("is_suspected_wrong_entity", "has_headcount_band_mismatch")
    assert [tuple(r) for r in got.collect()] == [
        (True, False), (False, True), (False, True), (False, False), (False, False), (False, False), (False, True)
    ]


def test_unknown_signal_leaves_priority_unknown_and_last(spark, built):
    scores = built.fct_prospect_scores
    total = scores.count()
    unknown = scores.filter("priority_score is null").select("tier", "priority_rank").distinct().collect()
    known = scores.filter("priority_score is not null").count()
    assert [tuple(r) for r in unknown] == [("C", known + 1)] and known < total


def test_scores_do_not_depend_on_partitions_or_salting(spark):
    from conftest import SMALL
    from rosterforge.plans.bindings import binding_config
    from rosterforge.plans.queries import built

    want = rows(built(spark, SMALL).fct_prospect_scores)
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        salted = built(spark, SMALL, binding_config(hot_key_rows=3, salts=5, block_names_max=2, max_hot_keys=20))
        assert rows(salted.fct_prospect_scores) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_labels_and_ranks_are_the_same_with_and_without_broadcast(spark, monkeypatch):
    from rosterforge.functions import mapping as mp
    from rosterforge.operators import ranking

    labels = ["Software Development", None, "Unheard of", "Retail"]
    df = spark.createDataFrame(
        [(f"A{i}", labels[0] if i % 3 == 0 else labels[i % 4], "Software", float(i % 7) if i % 5 else None) for i in range(120)],
        "account_id string, industry_label string, seed_industry string, score double",
    )
    mapping = mp.default_mapping(spark)
    columns = ["account_id", "industry_label", "label_is_mapped", "label_is_generic", "seed_industry_compatible"]
    want = rows(resolve.lookup_labels(df, mapping, Config()).select(columns))
    ranks = rows(ranking.rank_desc(df, "score", "place").select("account_id", "place"))
    monkeypatch.setattr(mp, "BROADCAST_MAX_ROWS", 0)
    monkeypatch.setattr(ranking, "BROADCAST_MAX_VALUES", 0)
    assert rows(resolve.lookup_labels(df, mapping, Config(hot_key_rows=5, salts=3)).select(columns)) == want
    assert rows(ranking.rank_desc(df, "score", "place").select("account_id", "place")) == ranks
    assert len(want) == 120
