from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import rows
from rosterforge.config import Config
from rosterforge.functions.mapping import MAPPING_SCHEMA, default_mapping, label_lookup, read_mapping
from rosterforge.operators import changes, enrichment
from rosterforge.operators.ranking import position_by_column
from rosterforge.sources import export, provider, raw, staging, state


def test_raw_text_is_kept_as_it_is(spark, tmp_path):
    f = tmp_path / "engagement.csv"
    f.write_text('event_id,contact_id,event_type,event_ts\nE1," x ","he said ""hi"", ok",""\nE2,NA,"two\nlines",007\n')
    df = raw.load_raw(spark, "raw_engagement", str(f))
    assert rows(df.drop("_loaded_at")) == [
        ("E1", " x ", 'he said "hi", ok', None), ("E2", "NA", "two\nlines", "007")
    ]
    assert df.filter("_loaded_at is null").count() == 0
    assert {t for c, t in df.dtypes if c != "_loaded_at"} == {"string"}


def test_missing_source_is_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="raw_contacts"):
        raw.load_all_raw(spark, {"raw_contacts": str(tmp_path / "none.csv")})


FULL = "Domain,Industry,Employee Count,Country,Founded,Size,Description,Enrich company,Enriched At"


@pytest.fixture()
def exports(tmp_path):
    folder = tmp_path / "exports"
    folder.mkdir()
    (folder / "batch_01.csv").write_text(
        f'{FULL}\nHTTPS://www.Acme.example/,Banking,14.0,NA,1999.0,"1,001-5,000 employees","a ""b"", c",Acme,2026-01-02\n'
        "other.example,N/A,n.a.,us,,,,,2026-01-03\n"
    )
    (folder / "batch_02.csv").write_text(f"{FULL}\nthird.example,Retail,7,US,2001,,,Third,2026-01-04\n")
    (folder / "mock_accounts.csv").write_text("Industry,Domain,Employee Count,Country,Founded\nRetail,fourth.example,9,GB,null\n")
    stamp = dt.datetime(2026, 3, 4, 12, tzinfo=dt.timezone.utc).timestamp()
    os.utime(folder / "mock_accounts.csv", (stamp, stamp))
    (folder / "notes.txt").write_text("not an export")
    return folder


def test_provider_exports(spark, exports):
    wide = provider.read_exports(spark, str(exports), Config())
    got = {r["domain"]: r.asDict() for r in wide.collect()}
    first, second, third, fourth = (got[d] for d in ("HTTPS://www.Acme.example/", "other.example", "third.example", "fourth.example"))
    assert (first["provider"], first["source_file"], first["enriched_at"]) == ("clay", "batch_01.csv", "2026-01-02")
    assert first["hq_country"] is None and first["description"] == 'a "b", c'
    assert second["industry"] is None and second["employee_count"] == "n.a." and second["hq_country"] == "us"
    assert third["source_file"] == "batch_02.csv"
    assert (fourth["provider"], fourth["enriched_at"]) == ("mock", "2026-03-04")
    assert fourth["size_band"] is None and fourth["founded_year"] is None


def test_an_empty_export_folder_gives_none(spark, tmp_path):
    assert provider.read_exports(spark, str(tmp_path), Config()) is None
    assert provider.read_exports(spark, str(tmp_path / "absent"), Config()) is None


def test_a_file_is_dated_in_utc_whatever_the_session_zone(spark, tmp_path):
    (tmp_path / "x.csv").write_text("Domain,Industry,Employee Count,Country,Founded\na.example,Retail,1,US,2000\n")
    evening = dt.datetime(2026, 1, 1, 20, tzinfo=dt.timezone.utc).timestamp()
    os.utime(tmp_path / "x.csv", (evening, evening))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("Asia/Tokyo", "America/Los_Angeles", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", name)
            assert provider.read_exports(spark, str(tmp_path), Config()).first()["enriched_at"] == "2026-01-01"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_single_line_sources_are_split(spark, tmp_path):
    from rosterforge.sources import raw

    lines = "".join(f"E{i},C{i},reply,2026-01-01 00:00:00\n" for i in range(4000))
    (tmp_path / "e.csv").write_text("event_id,contact_id,event_type,event_ts\n" + lines)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        whole = raw.load_raw(spark, "raw_engagement", str(tmp_path / "e.csv"))
        split = raw.load_raw(spark, "raw_engagement", str(tmp_path / "e.csv"), multi_line=False)
        assert whole.rdd.getNumPartitions() == 1 < split.rdd.getNumPartitions()
        assert rows(whole.drop("_loaded_at")) == rows(split.drop("_loaded_at"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_missing_required_columns_are_reported(spark, tmp_path):
    (tmp_path / "x.csv").write_text("Domain,Industry\na.example,Retail\n")
    with pytest.warns(UserWarning, match="Employee Count"):
        provider.read_exports(spark, str(tmp_path), Config())
    assert provider.missing_columns(["Domain"], Config()) == ["Industry", "Employee Count", "Country", "Founded"]


def test_match_keeps_unmatched_and_fans_out_on_shared_domains(spark, exports):
    wide = provider.read_exports(spark, str(exports), Config())
    accounts = spark.createDataFrame(
        [("A1", "acme.example "), ("A2", "ACME.example"), ("A3", "https://third.example"), ("A4", None)],
        "account_id string, domain string",
    )
    long = enrichment.enrichment_long(wide, accounts, Config(hot_key_rows=1, salts=2))
    per_record = {r["record_id"]: r["n"] for r in long.groupBy("record_id").agg(F.count("*").alias("n")).collect()}
    assert per_record == {"A1": 7, "A2": 7, None: 21}
    assert rows(enrichment.match_summary(long)) == [("clay", 28, 14, 2), ("mock", 7, 7, 0)]


def test_newest_enrichment_wins_with_fixed_tie_breaks(spark):
    def line(account, day, prov, file, field, value):
        return (account, "account", field, value, prov, file, day)

    long = spark.createDataFrame(
        [
            line("A", "2026-01-01", "mock", "f1", "industry", "Old"),
            line("A", "2026-02-01", "mock", "f2", "industry", "Mock"),
            line("A", "2026-02-01", "clay", "f4", "industry", "Late file"),
            line("A", "2026-02-01", "clay", "f3", "industry", "Clay"),
            line("A", "2026-02-01", "clay", "f3", "employee_count", "10"),
            line("A", "2026-02-01", "clay", "f3", "employee_count", "9"),
            line(None, "2026-02-01", "clay", "f3", "industry", "Nobody"),
        ],
        "record_id string, entity_type string, field string, value string, provider string, source_file string, enriched_at string",
    )
    got = enrichment.standardize_enrichment(long, Config()).select("account_id", "industry_label", "employee_count")
    assert rows(got) == [("A", "Clay", 9)]      # text maximum: '9' is above '10'


def test_mapping_file_round_trip(spark, tmp_path):
    mapping = default_mapping(spark)
    mapping.coalesce(1).write.csv(str(tmp_path / "m"), header=True, quote='"', escape='"')
    again = read_mapping(spark, str(tmp_path / "m"))
    assert mapping.count() == 40 and rows(again) == rows(mapping)
    odd = spark.createDataFrame([("L", None, None, None), ("L", "Media", True, None)], MAPPING_SCHEMA)
    assert rows(label_lookup(odd)) == [("L", "Media", False, ["Media"])]


def test_batches_are_files_of_equal_size_in_id_order(spark, tmp_path):
    accounts = spark.createDataFrame(
        [(f"A{i:03d}", f"Name, {i}", f"d{i}", "True" if i % 5 else "False") for i in range(100)],
        "account_id string, company_name string, domain string, is_real_domain string",
    ).repartition(7)
    batches = export.export_batches(accounts, Config(batch_size=30))
    export.write_batches(batches, str(tmp_path / "out"))
    sizes = []
    for n in (1, 2, 3):
        back = spark.read.csv(str(tmp_path / "out" / f"batch_no={n}"), header=True, escape='"')
        assert back.columns == ["Account ID", "Company Name", "Domain"]
        ids = [r[0] for r in back.collect()]
        assert ids == sorted(ids)
        sizes.append((len(ids), ids[0]))
    assert sizes == [(30, "A001"), (30, "A038"), (20, "A076")]


def test_position_does_not_depend_on_partitions(spark):
    df = spark.range(1000).select(F.sha1(F.col("id").cast("string")).alias("k"))
    want = {k: i for i, k in enumerate(sorted(r["k"] for r in df.collect()))}
    for parts in (1, 13):
        got = position_by_column(df.repartition(parts), "k", "pos")
        assert {r["k"]: r["pos"] for r in got.collect()} == want


def test_stored_tables_lie_in_the_shared_folder(spark):
    copy = staging.stored(spark.range(5), "five")
    assert spark.conf.get("spark.checkpoint.dir") in copy.inputFiles()[0]
    assert rows(copy) == [(i,) for i in range(5)]


def test_state_is_read_from_the_last_finished_run(spark, tmp_path):
    root = str(tmp_path / "store")
    assert state.read_state(spark, root).count() == 0

    def one(value):
        return spark.createDataFrame([("company", "A", "T", value, dt.datetime(2026, 1, 1))], changes.STATE_SCHEMA)

    outcomes = spark.createDataFrame(
        [("company", "A", "create", "T", "{}", "h", 0, False)],
        "entity string, local_id string, action string, target_id string, payload string, payload_hash string, dropped_values int, failed boolean",
    )
    failures = spark.createDataFrame([("company", "B", 400, "x" * 600)], "entity string, local_id string, status int, message string")
    state.save_run(outcomes, one("h1"), root, "20260101T000000Z", failures)
    one("half").write.parquet(f"{root}/record_map/20260102T000000Z")     # this run died before its log line
    assert [r["payload_hash"] for r in state.read_state(spark, root).collect()] == ["h1"]
    state.save_run(outcomes, one("h3"), root, "20260103T000000Z")
    assert [r["payload_hash"] for r in state.read_state(spark, root).collect()] == ["h3"]
    assert spark.read.parquet(f"{root}/runs").count() == 2
    for n in range(8, 12):      # names have no order: run-9 is above run-10 as text
        state.save_run(outcomes, one(f"n{n}"), root, f"run-{n}")
    assert [r["payload_hash"] for r in state.read_state(spark, root).collect()] == ["n11"]
    with pytest.raises(AnalysisException):
        state.save_run(outcomes, one("again"), root, "run-9")
    assert [r["payload_hash"] for r in state.read_state(spark, root).collect()] == ["n11"]
    assert spark.read.parquet(f"{root}/errors").select(F.length("message")).first()[0] == 500
