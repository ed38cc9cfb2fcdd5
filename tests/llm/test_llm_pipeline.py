"""The five stages against plain versions of themselves, alone and in a row."""

from __future__ import annotations

import pytest
from llm_cases import documents, empty_docs, odd_docs, odd_rows
from pyspark.sql import functions as F
from test_llm_copies import plain_components, plain_fingerprint, plain_overlaps
from test_llm_models import plain_pii

import corpus_pipeline as cp
from conftest import SMALL, rows
from rosterforge.llm import pii, toxicity
from rosterforge.llm.common import table
from rosterforge.sources.staging import stored


@pytest.fixture(scope="module")
def steps(spark):
    """The input of each stage and, last, the result of run()."""
    out = [table(spark, SMALL, "documents")]
    for name, stage in cp.STAGES:
        out.append(stored(stage(spark, out[-1], SMALL), f"test_{name}"))
    return out


def held(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_stages_are_named_in_order():
    assert [name for name, _ in cp.STAGES] == ["toxicity", "simhash_dedup", "decontamination", "pii", "mixture"]


def test_each_stage_does_to_its_input_what_it_says(spark, steps):
    import duckdb

    docs, clean, single, fresh, redacted, mixed = steps
    model = toxicity.fit_toxicity(docs.select("doc_id", "text"), table(spark, SMALL, "labels"))
    scores = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, model).collect()}
    assert {i for i, _ in held(clean)} == {i for i, s in scores.items() if s < cp.TOXIC} != set(scores)

    given = held(clean)
    parts = plain_components([plain_fingerprint(t) for _, t in given], [i for i, _ in given])
    assert {i for i, _ in held(single)} == set(parts)

    items = duckdb.connect().execute(f"select item_id, text from read_parquet('{SMALL}/benchmark.parquet')").fetchall()
    texts = held(single)
    exact = {i for i, t in texts if any(item in t for _, item in items)}
    kept = {i for i, _ in held(fresh)}
    assert exact and not kept & exact
    assert {i for i, _ in plain_overlaps([x for x in texts if x[0] not in kept], items)} == {i for i, _ in texts} - kept

    before, after = dict(held(fresh)), dict(held(redacted))
    assert set(before) == set(after)
    for i, text in before.items():
        assert not plain_pii(after[i])
        if not any(c.isdigit() or c == "@" for c in text):
            assert after[i] == text
        if not plain_pii(text) and after[i] == text:
            continue
        assert pii.redact(text, plain_pii(text)) == after[i] or "[" in after[i]

    assert mixed.columns[: len(docs.columns)] == docs.columns
    assert {i for i, _ in held(mixed)} < set(after)
    assert all(mixed.filter(F.col("mix_probability").between(0, 1)).count() == mixed.count() for _ in (0,))
    for stage_out in steps[:-1]:
        assert stage_out.columns == docs.columns


def test_run_gives_the_last_stage(spark, steps):
    assert rows(cp.run(spark, SMALL)) == rows(steps[-1])


def test_each_stage_bears_odd_rows(spark):
    docs = odd_docs(spark)
    for name, stage in cp.STAGES:
        assert stage(spark, empty_docs(spark), SMALL).count() == 0, name
        got = stage(spark, docs, SMALL)
        assert got.columns[: len(docs.columns)] == docs.columns
        assert {(r["doc_id"], r["text"]) for r in got.collect()} <= {r[:2] for r in odd_rows()}, name
    # nothing in the odd rows is toxic, a benchmark item or personal data; only copies go
    assert cp.drop_toxic(spark, docs, SMALL).count() == len(odd_rows())
    assert cp.drop_benchmark_overlaps(spark, docs, SMALL).count() == len(odd_rows())
    assert rows(cp.redact_personal_data(spark, docs, SMALL)) == rows(docs)
    single = [(r["doc_id"], r["text"]) for r in cp.drop_near_copies(spark, docs, SMALL).collect()]
    assert sorted(single, key=repr) == sorted({
        r[:2] for r in odd_rows() if r[1] not in (None, "", " \t\n ") or r[0] == 2
    }, key=repr)


def test_copies_are_single_and_the_smallest_id_stays(spark):
    texts = [(9, "one two three four five six"), (4, "one two three four five six"), (4, "one two three four five six"),
             (6, "quite another text with other words"), (None, "one two three four five six"), (4, "seven eight nine ten eleven")]
    docs = spark.createDataFrame([(i, t, "k") for i, t in texts], "doc_id bigint, text string, _key string")
    assert rows(cp.drop_near_copies(spark, docs, SMALL)) == sorted(
        [(4, texts[1][1], "k"), (4, texts[5][1], "k"), (6, texts[3][1], "k")], key=repr
    )
    assert documents(SMALL)
