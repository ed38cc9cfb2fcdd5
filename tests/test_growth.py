"""What a task holds and what a run writes must not grow faster than the input."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import rows
from rosterforge.config import Config
from rosterforge.functions import ids
from rosterforge.operators import changes, dedupe, enrichment, ranking, scoring, skew
from rosterforge.operators.skew import hot_keys, hot_row_keys, key_sizes
from rosterforge.sources.staging import stored
from rosterforge.sources.state_log import StateLog

WIDE = "domain string, " + ", ".join(f"{f} string" for f in enrichment.FIELDS) + ", provider string, source_file string, enriched_at string"


def test_matched_enrichment_is_dealt_over_tasks_before_it_has_a_row_per_field(spark):
    """One file of one frequent domain is one task's input, and one key of the join."""
    one = ("acme.example", *["x"] * len(enrichment.FIELDS), "clay", "f", "2026-01-01")
    wide = spark.createDataFrame([one] * 4000, WIDE).coalesce(1)
    accounts = spark.createDataFrame([("A1", "acme.example")], "account_id string, domain string")
    long = enrichment.enrichment_long(wide, accounts, Config(most_rows=8 * enrichment.ROWS_A_TASK))
    per_task = [r["n"] for r in long.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(per_task) == 8 and max(per_task) < 2 * 7 * 4000 / 8
    assert rows(enrichment.pivot_enrichment(long).select("account_id", "industry")) == [("A1", "x")]


def test_hot_keys_of_rows_shuffle_bucket_counts_alone(spark):
    rows_of = spark.range(20_000).select(
        F.when(F.col("id") < 900, None).when(F.col("id") < 2_000, "often").otherwise(F.col("id").cast("string")).alias("k")
    )
    for cfg in (Config(hot_key_rows=500, salts=2), Config(hot_key_rows=1_000, salts=2), Config(hot_key_rows=1),
                Config(hot_key_rows=1, max_hot_keys=20, salts=3), Config(hot_key_rows=50_000)):
        assert hot_row_keys(rows_of, ["k"], cfg) == hot_keys(key_sizes(rows_of, ["k"]), ["k"], "_rows", cfg)


def test_a_build_counts_no_key_of_its_contacts_one_by_one(built, monkeypatch):
    counted = []
    monkeypatch.setattr(skew, "key_sizes", lambda df, keys: counted.append(keys))
    keys = ["contact_id"]
    assert hot_row_keys(built.contacts.select(*keys), keys, Config(hot_key_rows=1_000)) == {} and not counted


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


SCORES = (
    "contact_id string, account_id string, first_name string, full_name string, last_name string, email string, title string, "
    "priority_score double, tier string, persona string, seniority string, stage string"
)


def test_payloads_are_made_where_nothing_moves_them(spark):
    """No exchange above a payload or its hash; by account move two ids; a first run meets no state."""
    one = ("C1", "A1", "Ann", "Ann Lee", "Lee", "a@b.test", "Head", 70.0, "A", "Other", "VP", "New")
    scores = spark.createDataFrame([one], SCORES)
    companies = spark.createDataFrame([("A1", "T1")], "local_id string, target_id string")
    failures = spark.createDataFrame([("person", "C9", 400, "no")], "entity string, local_id string, status int, message string")
    known = spark.createDataFrame([("person", "C1", "T9", "h", None)], changes.STATE_SCHEMA)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = changes.plan_people(scores, companies, known, Config(), {}, failures=failures)
        lines = plan_of(plan).splitlines()
        assert plan.columns[-1] == "failed"
        assert [(r["action"], r["target_id"], r["failed"]) for r in plan.collect()] == [("update", "T9", False)]
        assert not any("Exchange" in line for line in lines[: 1 + max(i for i, x in enumerate(lines) if "sha1" in x or "to_json" in x)])
        first = plan_of(changes.plan_people(scores, companies, changes.no_state(spark), Config(), {}))
        assert first.count("Join") == 2 and first.count("Exchange hashpartitioning(contact_id") == 2
        assert first.count("to_json") + first.count("StructsToJson") <= 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_an_entity_with_failures_is_planned_as_before(spark):
    scores = spark.createDataFrame(
        [(f"C{i}", "A1", "Ann", "Ann Lee", "Lee", "a@b.test", "Head", 70.0, "A", "Other", "VP", "New") for i in range(6)], SCORES
    )
    companies = spark.createDataFrame([("A1", "T1")], "local_id string, target_id string")
    failures = spark.createDataFrame(
        [("person", "C1", 400, "no"), ("person", "C1", 500, "no"), ("company", "C2", 400, "no")],
        "entity string, local_id string, status int, message string",
    )
    state = changes.no_state(spark)
    plan = changes.plan_people(scores, companies, state, Config(), {})
    joined = changes.plan_people(scores, companies, state, Config(), {}, failures=failures)
    assert rows(joined) == rows(changes.with_outcomes(plan, failures))
    assert joined.filter("failed").count() == 1


def test_stored_tables_are_packed_with_zstandard(spark, tmp_path):
    ids = spark.range(20_000).select(F.sha1(F.col("id").cast("string")).alias("h"))
    kept = [f for f in stored(ids, "ids").inputFiles() if f.endswith(".parquet")]
    assert kept and all(f.endswith(".zstd.parquet") for f in kept)
    log = StateLog(spark, str(tmp_path / "log"), 4)
    log.append(ids.select(F.lit("person").alias("entity"), F.col("h").alias("local_id"), F.lit("create").alias("action"),
                          F.col("h").alias("target_id"), F.col("h").alias("payload_hash"), F.lit(0).alias("dropped_values"),
                          F.lit(False).alias("failed")), "run-1")
    assert all("zstd" in path for _, path in log._files(log.version().segments[0][1]))
    assert log.read().count() == 20_000


def test_counters_are_joined_before_the_attributes_of_accounts(spark, built):
    """The account join comes last, so attributes are not moved again by contact."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(scoring.score_contacts(built.dim_contact, built.dim_account, built.int_contact_engagement, built.cfg, {}))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "account_id" in next(line for line in plan.splitlines() if "Join" in line)


def test_names_of_a_block_meet_through_one_exchange(spark):
    names = spark.createDataFrame([("b", "ann", "1"), ("b", "anne", "2")], "_block0 string, _text string, _low string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = dedupe._candidates(stored(names, "names"), ["_block0"], 2, Config())
        assert [tuple(r) for r in pairs.collect()] == [("b", "anne", "2", "ann", "1")]
        assert "ReusedExchange" in plan_of(pairs)
        # as fuzzy_pairs goes on, which says of one side that its text is there
        lowest = pairs.groupBy("_block0", "_text").agg(F.min("_low2").alias("_low2"))
        answers = stored(names, "names").join(lowest, ["_block0", "_text"], "left")
        assert sorted(r["_low2"] or "" for r in answers.collect()) == ["", "1"]
        assert "ReusedExchange" in plan_of(answers)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_ids_are_cut_from_one_digest_a_record(spark):
    current = spark.createDataFrame([("a", None, ("x",), "h")], "local_id string, parent_id string, payload struct<name: string>, payload_hash string")
    plan = changes.plan_changes(current, "company", changes.no_state(spark), Config())
    assert plan_of(plan).count("sha1(") == 1
    want = spark.range(1).select(ids.target_id(changes.PATHS["company"], F.lit("a"))).first()[0]
    assert [(r["target_id"], r["payload"]) for r in plan.collect()] == [(want, '{"name":"x"}')]


def test_groups_of_exact_duplicates_take_one_window(spark):
    people = spark.createDataFrame(
        [("c1", "x", 1), ("c2", "x", 3), ("c3", None, None), ("c4", None, 2), ("c5", "y", 1)], "id string, email string, n int"
    )
    groups = dedupe.dedupe_exact(people, "email", "id", [-F.col("n")], Config(hot_key_rows=100))
    assert sum("Window" in line and "Group" not in line for line in plan_of(groups).splitlines()) == 1
    assert [(r["id"], r["group_size"], r["survivor_id"]) for r in groups.orderBy("id").collect()] == [
        ("c1", 2, "c2"), ("c2", 2, "c2"), ("c3", 2, "c4"), ("c4", 2, "c4"), ("c5", 1, "c5")]


def test_readers_of_ranks_do_not_count_the_table_again(spark):
    scored = stored(spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 2.0), ("d", None)], "id string, score double"), "scored")
    for most in (10, 1):
        ranked = ranking.rank_desc(scored, "score", "place", max_values=most)
        assert sum("scored-" in line for line in plan_of(ranked).splitlines()) == 1
        assert rows(ranked.select("id", "place")) == [("a", 3), ("b", 1), ("c", 1), ("d", 4)]


def test_a_lone_segment_of_a_log_is_read_without_grouping(spark, tmp_path):
    """Unless a run named a record twice."""
    def run(*ids):
        lines = [("person", i, "create", "t" + i, "h" + i, 0, False) for i in ids]
        return spark.createDataFrame(
            lines, "entity string, local_id string, action string, target_id string, payload_hash string, dropped_values int, failed boolean"
        )

    log, twice = StateLog(spark, str(tmp_path / "log"), 4), StateLog(spark, str(tmp_path / "twice"), 4)
    log.append(run("a", "b"), "run-1")
    assert log.version().once == (1,) and "Aggregate" not in plan_of(log.read())
    assert rows(log.read().select("local_id", "target_id")) == [("a", "ta"), ("b", "tb")]
    log.append(run("b", "c"), "run-2")
    assert "Aggregate" in plan_of(log.read()) and rows(log.read().select("local_id")) == [("a",), ("b",), ("c",)]
    log.compact(max_segments=1)
    assert log.read().count() == 3
    twice.append(run("a", "a", "b"), "run-1")
    assert twice.version().once == () and rows(twice.read().select("local_id")) == [("a",), ("b",)]
