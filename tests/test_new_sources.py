"""Broken raw lines, header probes, the event stream, decayed totals, ranks, one-shuffle constraints, published builds."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, rows
from rosterforge.config import Config
from rosterforge.operators import constraints, decay, ranking, scoring
from rosterforge.plans import pipeline
from rosterforge.sources import provider, raw
from rosterforge.streaming import engagement

HEADER = "event_id,contact_id,event_type,event_ts\n"
BROKEN = [
    ("E2,C2,reply,2026-01-01 00:00:00,surplus", "extra fields"),
    ("E3,C3", "missing fields"),
    ('E4,"C4,reply,2026-01-01 00:00:00', "unclosed quote"),
    ('E5,"he said ""no"", then",reply,x,y', "extra fields"),
]
WHOLE = ["E1,C1,reply,2026-01-01 00:00:00", 'E6,"a, b",reply,', 'E7,5" pipe,reply,x', 'E8," ""q"" ",reply,']


def test_broken_lines_are_kept_with_their_reason(spark, tmp_path):
    lines = WHOLE[:2] + [t for t, _ in BROKEN] + ["", "   "] + WHOLE[2:]
    (tmp_path / "a.csv").write_text(HEADER + "\n".join(lines) + "\n")
    (tmp_path / "b.csv").write_text(HEADER + "E9,C9,open,z\n")
    path = str(tmp_path)
    got = raw.raw_rejects(spark, "raw_engagement", path, multi_line=False)
    assert {(r["line_text"], r["reason"]) for r in got.collect()} == set(BROKEN)
    assert {r["source_file"].rsplit("/", 1)[-1] for r in got.collect()} == {"a.csv"}
    loaded = raw.load_raw(spark, "raw_engagement", path, multi_line=False, broken="drop")
    assert [r[0] for r in rows(loaded)] == ["E1", "E6", "E7", "E8", "E9"]
    assert loaded.filter("event_id = 'E8'").first()["contact_id"] == ' "q" '
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        raw.load_raw(spark, "raw_engagement", path, multi_line=False).select("event_id").collect()
    assert raw.load_raw(spark, "raw_engagement", path, multi_line=False, broken="pad").count() == 9
    both = raw.load_all_raw(spark, {"raw_engagement": path}, {"raw_engagement": False}, broken="drop")
    assert both["raw_engagement"].count() == 5


def test_broken_records_with_line_breaks(spark, tmp_path):
    text = HEADER + 'E1,C1,"two\nlines",x\nE2,"a\nb"\nE3,C3,reply,x,"y\nz"\nE4,C4,reply,x\nE5,C5,"open,x\nE6,C6,reply,x\n'
    (tmp_path / "a.csv").write_text(text)
    got = raw.raw_rejects(spark, "raw_engagement", str(tmp_path))
    assert {(r["line_text"].rstrip("\n"), r["reason"]) for r in got.collect()} == {
        ('E2,"a\nb"', "missing fields"), ('E3,C3,reply,x,"y\nz"', "extra fields"),
        ('E5,C5,"open,x\nE6,C6,reply,x', "unclosed quote"),
    }
    loaded = raw.load_raw(spark, "raw_engagement", str(tmp_path), broken="drop")
    assert [r[:3] for r in rows(loaded)] == [("E1", "C1", "two\nlines"), ("E4", "C4", "reply")]


def test_a_file_without_a_header_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("E1,C1,reply,x\n")
    with pytest.raises(ValueError, match="a.csv"):
        raw.raw_rejects(spark, "raw_engagement", str(tmp_path), multi_line=False)
    with pytest.raises(FileNotFoundError):
        raw.raw_rejects(spark, "raw_engagement", str(tmp_path / "none"), multi_line=False)


def test_headers_are_found_in_the_first_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(provider, "PROBE_BYTES", 8)
    (tmp_path / "a.csv").write_text("Domain,Industry\r\n" + "x,y\n" * 1000)
    (tmp_path / "b.csv").write_text("Domain,Industry")
    (tmp_path / "c.csv").write_text("")
    (tmp_path / "ä b.csv").write_text("Straße,Größe\nx,y\n")
    found = provider._headers(spark, [f"{tmp_path}/*.csv"])
    assert {h: len(f) for h, f in found.items()} == {"Domain,Industry": 2, "Straße,Größe": 1}


# events --------------------------------------------------------------------------------------

def events_of(spark, lines):
    return spark.createDataFrame(lines, "event_id string, contact_id string, event_type string, event_ts string")


def test_three_arrivals_equal_the_batch(spark, tmp_path):
    rng = random.Random(2)
    every = [
        (f"E{i}", f"C{rng.randrange(9)}", rng.choice(["reply", "meeting", None]), f"2026-0{rng.randrange(1, 9)}-1{i % 10} 10:00:00")
        for i in range(120)
    ]
    every += [(None, "C1", "reply", "2026-01-01 00:00:00")] * 2 + [("E200", None, "reply", None)]
    arrivals = [every[:40], every[30:80], every[70:] + every[:5]]  # repeated, and later than their date
    source, folder = str(tmp_path / "in"), str(tmp_path / "out")
    for k, lines in enumerate(arrivals):
        events_of(spark, lines).write.parquet(f"{source}/a{k}")
        engagement.count_arrivals(spark, f"{source}/*", folder)
    batch = engagement.daily_counts(engagement.standardize_events(events_of(spark, every)))
    assert rows(engagement.read_counts(spark, folder)) == rows(batch)
    engagement.count_arrivals(spark, f"{source}/*", folder)  # nothing new
    assert rows(engagement.read_counts(spark, folder)) == rows(batch)
    assert engagement.read_counts(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("day", ["2026-10-01", "2026-12-27"])
def test_decayed_totals_equal_the_scores_of_events(spark, day):
    rng, cfg = random.Random(3), Config(reference_date=day)
    lines = [
        (f"E{i}", f"C{rng.randrange(12)}", rng.choice(["reply", "meeting", "email_open", "web_visit", "other"]),
         f"2026-0{rng.randrange(1, 9)}-{rng.randrange(10, 28)} 10:00:00") for i in range(300)
    ]
    events = engagement.standardize_events(events_of(spark, lines))
    contacts = spark.range(14).select(F.concat(F.lit("C"), "id").alias("contact_id"))
    links = spark.createDataFrame([(f"C{i}", f"C{i // 2}") for i in range(12)], "contact_id string, survivor_contact_id string")
    days = engagement.daily_counts(events)
    first, second = days.filter("event_date < '2026-04-01'"), days.filter("event_date >= '2026-04-01'")
    totals = decay.added(
        decay.moved(decay.decayed_totals(first, cfg, "2025-01-01"), cfg, "2025-01-01", "2026-06-01"),
        decay.decayed_totals(second, cfg, "2026-06-01"),
    )
    for to in (None, links):
        got = rows(decay.engagement_from_totals(contacts, totals, cfg, "2026-06-01", to))
        want = rows(scoring.engagement_score(contacts, events, cfg, to))
        assert [r[0] for r in got] == [r[0] for r in want] and [r[2:] for r in got] == [r[2:] for r in want]
        assert all(abs(a[1] - b[1]) < 0.11 for a, b in zip(got, want)) and any(0 < r[1] < 100 for r in got)


# ranks and constraints -------------------------------------------------------------------------

@pytest.mark.parametrize("many", [False, True])
def test_ranks_of_many_values_with_ties(spark, many):
    rng = random.Random(1)
    data = [(i, rng.choice([None, 1.5, 1.5, rng.random(), float(rng.randrange(50))])) for i in range(500)]
    df = spark.createDataFrame(data, "id int, score double").repartition(5)
    cfg = Config(hot_key_rows=20, salts=3)
    got = ranking.rank_desc(df, "score", "place", "id", cfg, 10 if many else 10_000)
    value = {i: s for i, s in data}
    order = sorted((s is None, -(s or 0)) for s in value.values())
    assert {r["id"]: r["place"] for r in got.collect()} == {
        i: 1 + order.index((s is None, -(s or 0))) for i, s in value.items()
    }


def test_all_keys_are_settled_by_one_exchange(spark):
    child = spark.createDataFrame([(1, 5, "x"), (1, 6, "y"), (2, None, None), (None, 5, "x"), (3, 7, "z")], "id int, up int, kind string")
    parent = spark.createDataFrame([(5,), (6,), (6,), (None,)], "key bigint")
    specs = [
        constraints.Constraints("child", ("id",), ("id", "up"), {"kind": ("x", "y")}, {"up": ("parent", "key")}),
        constraints.Constraints("parent", ("key",)),
    ]
    report = constraints.constraint_report({"child": child, "parent": parent}, specs)
    assert {r[:3]: r[3] for r in rows(report)} == {
        ("child", "id", "unique"): 1, ("child", "id", "not_null"): 1, ("child", "up", "not_null"): 1,
        ("child", "kind", "accepted_values"): 1, ("child", "up", "relationships"): 1, ("parent", "key", "unique"): 1,
    }
    plan = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("Exchange hashpartitioning(rule") == 2  # by rule and key, then a line a rule
    assert plan.count("Join") == plan.count("BroadcastHashJoin") == 1  # the rules themselves
    with pytest.raises(ValueError):
        constraints.constraint_report({}, [])


def test_only_complete_builds_are_in_force(spark, tmp_path, monkeypatch):
    from rosterforge.plans.queries import built as fresh

    root = str(tmp_path)
    b = fresh(spark, SMALL)
    first = b.publish(root)
    assert all(first in f for f in pipeline.read_layers(spark, root)["dim_contact"].inputFiles())
    dying, real = fresh(spark, SMALL), pipeline.Build._write

    def write(self, df, name):
        if name == "dim_contact":
            raise RuntimeError("lost")
        return real(self, df, name)

    monkeypatch.setattr(pipeline.Build, "_write", write)
    with pytest.raises(RuntimeError):
        dying.publish(root)
    tables = pipeline.read_layers(spark, root)
    assert set(tables) == set(b.written) and all(first in f for df in tables.values() for f in df.inputFiles())
    assert tables["fct_prospect_scores"].count() == b.fct_prospect_scores.count()
