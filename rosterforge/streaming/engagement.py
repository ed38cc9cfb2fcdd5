"""Daily engagement counts kept up by a file stream: the same numbers as a batch over all events."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rosterforge.operators.standardize import standardize_events
from rosterforge.sources.raw import RAW_COLUMNS, text_schema

COUNTS = "contact_id string, event_date date, event_type string, n bigint"


def daily_counts(events: DataFrame) -> DataFrame:
    """(contact_id, event_date, event_type, n) of standardised events."""
    return events.groupBy("contact_id", F.to_date("event_ts").alias("event_date"), "event_type").agg(
        F.count(F.lit(1)).alias("n")
    )


def event_stream(spark: SparkSession, source: str, horizon: str, file_format: str = "parquet") -> DataFrame:
    """New event files as standardised events, each event once.

    An event that is delivered again within `horizon` of its first arrival is left out; its id is
    held in the state for that long. Arrival is the time of the file, so an event may be dated
    as far back as it likes and is still counted. Events without an id cannot be told
    apart and all count.
    """
    raw = spark.readStream.schema(text_schema(RAW_COLUMNS["raw_engagement"])).format(file_format).load(source).select(
        "*", F.col("_metadata.file_modification_time").alias("arrived")
    )
    known = raw.filter("event_id IS NOT NULL").withWatermark("arrived", horizon).dropDuplicatesWithinWatermark(["event_id"])
    return standardize_events(known.unionByName(raw.filter("event_id IS NULL")))


def count_arrivals(
    spark: SparkSession, source: str, folder: str, horizon: str = "7 days", file_format: str = "parquet",
    max_files: int | None = None,
) -> StreamingQuery:
    """Count all files of `source` (a folder or pattern) that no earlier call has counted; returns when they are.

    `folder` holds the stream's progress and state and one small table of counts per micro-batch. A
    batch that is done again after a failure overwrites its own table, so nothing counts twice.
    """
    events = event_stream(spark, source, horizon, file_format)

    def write(batch: DataFrame, number: int) -> None:
        daily_counts(batch).write.mode("overwrite").parquet(f"{folder}/counts/batch={number}")

    query = (
        events.writeStream.foreachBatch(write).option("checkpointLocation", f"{folder}/progress")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def read_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counts per contact, day and type over all batches so far."""
    try:
        parts = spark.read.schema(COUNTS).parquet(f"{folder}/counts")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], COUNTS)
        raise
    return parts.groupBy("contact_id", "event_date", "event_type").agg(F.sum("n").alias("n"))
