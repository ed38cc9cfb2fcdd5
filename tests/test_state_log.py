"""The state as a log: runs append what they changed, and joins leave it where it lies."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from rosterforge.config import Config
from rosterforge.operators import changes
from rosterforge.sources import state
from rosterforge.sources.state_log import StateLog

OUTCOMES = "entity string, local_id string, action string, target_id string, parent_id string, payload string, payload_hash string, dropped_values int, failed boolean"


def run_of(spark, lines):
    return spark.createDataFrame([(e, i, a, t, None, None, h, 0, bad) for e, i, a, t, h, bad in lines], OUTCOMES)


def kept(df):
    return rows(df.drop("synced_at"))


def random_run(rng, n):
    out = {}
    for _ in range(n):
        key = (rng.choice(["company", "person"]), f"id{rng.randrange(60)}")
        out[key] = (*key, rng.choice(["create", "update", "remove", "unchanged"]), f"t{key[1]}", f"h{rng.random()}", rng.random() < 0.2)
    return list(out.values())


def test_ten_runs_equal_the_snapshot(spark, tmp_path):
    rng, log = random.Random(5), StateLog(spark, str(tmp_path / "log"), 4)
    snapshot = spark.createDataFrame([], changes.STATE_SCHEMA)
    for number in range(10):
        outcomes = run_of(spark, random_run(rng, 25))
        log.append(outcomes, f"run-{number}")
        snapshot = spark.createDataFrame(changes.merge_state(snapshot, outcomes).collect(), changes.STATE_SCHEMA)
        if number in (4, 8):
            assert log.compact(max_segments=2)
        if number == 8:
            log.vacuum()
        assert kept(log.read()) == kept(snapshot)
    assert StateLog(spark, str(tmp_path / "log"), 99).version().n_buckets == 4  # the log knows its buckets
    assert spark.read.parquet(str(tmp_path / "log/runs")).select("run_id").distinct().count() == 10


def test_a_run_writes_what_it_changed(spark, tmp_path):
    log = StateLog(spark, str(tmp_path / "log"), 8)
    first = [("person", f"id{i}", "create", f"t{i}", "h", False) for i in range(400)]
    assert log.append(run_of(spark, first), "run-1") == 400
    held = log.version()
    few = [("person", f"id{i}", "update" if i < 3 else "unchanged", f"t{i}", "g", False) for i in range(400)]
    assert log.append(run_of(spark, few), "run-2") == 3
    folder = log.version().segments[-1][1]
    assert spark.read.parquet(str(tmp_path / "log/segments" / folder)).count() == 3
    assert len(log._files(folder)) <= 3  # buckets without a change get no file
    before = log.version()
    assert log.append(run_of(spark, [x for x in few if x[2] == "unchanged"]), "run-3") == 0
    assert log.version() == before and held.segments == before.segments[:1]
    assert {r["run_id"] for r in spark.read.parquet(str(tmp_path / "log/runs")).collect()} == {"run-1", "run-2", "run-3"}


def test_compaction_touches_full_buckets_only_and_a_dead_run_changes_nothing(spark, tmp_path):
    log = StateLog(spark, str(tmp_path / "log"), 16)
    log.append(run_of(spark, [("person", f"id{i}", "create", f"t{i}", "h", False) for i in range(200)]), "run-0")
    for number in range(3):
        log.append(run_of(spark, [("person", "id7", "update", "t7", f"h{number}", False)]), f"run-{number + 1}")
    log.append(run_of(spark, [("person", "id8", "remove", None, None, False)]), "run-4")
    want = kept(log.read())
    own = log.spark.createDataFrame([("id7",)], "local_id string").select(F.pmod(F.hash("local_id"), F.lit(16))).first()[0]
    assert log.compact(max_segments=3) == [own] and kept(log.read()) == want and len(want) == 199
    folder = log.version().segments[-1][1]
    assert {b for b, _ in log._files(folder)} == {own}
    log._write_segment(spark.createDataFrame([("person", "x", "t", "h", None, False)], changes.STATE_SCHEMA + ", deleted boolean"), log.version())
    assert kept(log.read()) == want         # a segment without its manifest line does not count
    assert log.vacuum() > 0 and kept(log.read()) == want
    assert log.compact(max_segments=3) == []


def test_a_plan_moves_no_state(spark, tmp_path):
    """No exchange between the scan of the state and its join with the current records."""
    log = StateLog(spark, str(tmp_path / "log"), int(spark.conf.get("spark.sql.shuffle.partitions")))
    log.append(run_of(spark, [("company", f"id{i}", "create", f"t{i}", f"h{i}", False) for i in range(50)]), "run-1")
    payload = F.struct(F.col("local_id").alias("name"))
    current = spark.range(60).select(F.concat(F.lit("id"), "id").alias("local_id")).select(
        "local_id", F.lit(None).cast("string").alias("parent_id"), payload.alias("payload"), F.lit("h").alias("payload_hash")
    )
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = changes.plan_changes(current, "company", log.read(), Config())
        tree = plan._jdf.queryExecution().executedPlan().toString()
        ids = changes.ids_after(log.read(), run_of(spark, []), "company")
        other = ids._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    for text, moved in ((tree, 1), (other, 1)):
        assert "Bucketed: true" in text and text.count("Exchange hashpartitioning") == moved
    assert plan.filter("action = 'update'").count() == 50 and plan.filter("action = 'create'").count() == 10


@pytest.mark.parametrize("entity", ["company", "person"])
def test_ids_after_a_run_equal_the_merged_state(spark, entity):
    rng = random.Random(8)
    before = spark.createDataFrame(
        [(e, f"id{i}", f"old{i}", "h", None) for e in ("company", "person") for i in range(0, 60, 2)], changes.STATE_SCHEMA
    )
    outcomes = run_of(spark, [x for x in random_run(rng, 50) if x[0] == entity])
    want = changes.entity_ids(changes.merge_state(before, outcomes), entity)
    assert rows(changes.ids_after(before, outcomes, entity)) == rows(want)


def test_the_snapshot_store_still_reads_the_newest_run(spark, tmp_path):
    outcomes = run_of(spark, [("person", "a", "create", "t", "h", False)])
    empty = spark.createDataFrame([], changes.STATE_SCHEMA)
    state.save_run(outcomes, changes.merge_state(empty, outcomes), str(tmp_path), "r1")
    assert kept(state.read_state(spark, str(tmp_path))) == [("person", "a", "t", "h")]
