"""The corpus pipeline: five stages, each one operator, applied to `documents` one after the other."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterforge.llm.common import free_name, table
from rosterforge.llm.decontaminate import contaminated
from rosterforge.llm.mixture import mix_sources
from rosterforge.llm.pii import find_pii, fit_pii
from rosterforge.llm.simhash import simhash_components
from rosterforge.llm.toxicity import fit_toxicity, score_toxicity
from rosterforge.sources.staging import stored

TOXIC = 0.5

def _key() -> Column:
    """A row's key: nulls last, then the id, then the contents.

    Rows that repeat an id with other texts are told apart; equal rows share a key.
    """
    return F.struct(
        F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("text_hash")
    )


def _without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose key is not listed; `keys` has one column `key` of distinct keys."""
    gone = keys.select(F.col("key.id").alias("_id"), F.col("key.text_hash").alias("_hash"))
    same = docs["doc_id"].eqNullSafe(gone["_id"]) & (F.xxhash64(docs["text"]) == gone["_hash"])
    return docs.join(gone, same, "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; the model learns from the labelled ones among them."""
    model = fit_toxicity(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    # the whole row is the id, so the score comes back beside it and no text is shuffled
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    scored = score_toxicity(docs.select(row.alias("row"), "text"), model, "row", "text")
    return scored.filter(F.col("score") < TOXIC).select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest id stays.

    A document without an id stays only where its group has none with an id. Of rows with equal
    id and text one stays.
    """
    found = stored(simhash_components(docs.select(_key().alias("key"), "text"), "key"), "near_copies")
    gone = found.filter("key <> component_id").select("key").distinct()
    kept = _without(docs, gone)
    twice = found.filter("key = component_id").groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if not twice.head(1):
        return kept
    name = free_name("_key", docs.columns)
    same = twice.select(F.col("key").alias(name))
    equal = docs.withColumn(name, _key()).join(same, name, "left_semi").dropDuplicates([name])
    return _without(kept, twice.select("key")).unionByName(equal.drop(name))


def drop_benchmark_overlaps(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    found = contaminated(docs.select(_key().alias("key"), "text"), table(spark, sf_dir, "benchmark"), "key")
    return _without(docs, found.select("key").distinct())


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data is replaced by its kind; n_chars follows the new text."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    found = find_pii(docs.select(row.alias("row"), "text"), fit_pii(docs.select("text")), "row", "text")
    new = {"text": F.col("redacted")}
    if "n_chars" in docs.columns:
        # a text without spans keeps what the table says about it
        size = F.length("redacted").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.col("spans") != "", size).otherwise(F.col("row.n_chars"))
    return found.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sampled documents, with the tokens, topic, probability and weight they were sampled by."""
    own = ("tokens", "topic", "probability", "weight")
    return mix_sources(docs).filter("sampled").select(
        "row.*", *[F.col(c).alias(free_name(f"mix_{c}", docs.columns)) for c in own]
    )


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_overlaps),
    ("pii", redact_personal_data),
    ("mixture", mix),
]

#: Training, hashing and neural decoding are not expressible in SQL; tests hold run() against
#: brute-force versions of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each result is written to the shared folder and read back for the next one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
