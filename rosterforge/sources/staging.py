"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Ids and digests are hex text, of which zstandard leaves about half and Snappy all. Its lowest
# level leaves no more of them than the usual one.
PACKED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}


def scratch_root(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only where none is set, as in tests."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="rosterforge-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the scratch root, never used before."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table that several plans read, and go on from the written copy.

    This ends the lineage: a lost executor costs a re-read, not the work before it, and plans
    built on the copy stay small. Parquet keeps column pruning and known sizes, so Spark can
    choose a broadcast from the real size of a small table.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**PACKED).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
