"""Positions in a total order without sorting a whole table in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rosterforge.config import Config
from rosterforge.operators.skew import hot_keys, running_totals, salted_join
from rosterforge.sources.staging import stored


BROADCAST_MAX_VALUES = 100_000  # distinct scores whose ranks are broadcast; more are joined


def _ranks_of_many(per_value: DataFrame, score: str, out: str) -> DataFrame:
    """(_value, out) for any number of distinct values, none of which is ever in one task with all others.

    Values are range-partitioned, so a slice holds neighbouring ones; the rows of the slices before it and the
    running total inside it make the rank.
    """
    parts = int(per_value.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = F.desc_nulls_last(score)
    sliced = stored(per_value.repartitionByRange(parts, order).withColumn("_slice", F.spark_partition_id()), "values")
    offsets = running_totals(
        sliced.groupBy("_slice").agg(F.sum("_n").alias("_n")), [F.asc("_slice")], "_n"
    ).drop("_n")
    inside = W.partitionBy("_slice").orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    rank = F.col("_before") + F.coalesce(F.sum("_n").over(inside), F.lit(0)) + 1
    # one line a slice
    return sliced.join(F.broadcast(offsets), "_slice").select(F.col(score).alias("_value"), rank.cast("bigint").alias(out))


def rank_desc(
    df: DataFrame, score: str, out: str, spread: str | None = None, cfg: Config | None = None,
    max_values: int = BROADCAST_MAX_VALUES,
) -> DataFrame:
    """Competition rank, highest first and NULL last, with no sort of the rows.

    Counting rows per value and adding up the counts above gives `rank()`. A score between 0 and
    100 with one decimal has at most 1,001 values and NULL, whose ranks are broadcast. Beyond
    `max_values` values are ranked in slices and joined; rows of frequent values are then cut apart
    by `spread`, a column that varies inside a value (the first column by default). The table is
    counted once, when this is called, and read again by every reader of the ranks, so pass a stored one.
    """
    per_value = stored(df.groupBy(score).agg(F.count(F.lit(1)).alias("_n")), "value_counts")
    if per_value.limit(max_values + 1).count() <= max_values:
        ranks = F.broadcast(running_totals(per_value, [F.desc_nulls_last(score)], "_n").select(
            F.col(score).alias("_value"), (F.col("_before") + 1).cast("bigint").alias(out)
        ))
        return df.join(ranks, df[score].eqNullSafe(ranks["_value"]), "inner").drop("_value")
    cfg = cfg or Config()
    ranks = _ranks_of_many(per_value, score, out).withColumnRenamed("_value", score)
    hot = hot_keys(per_value, [score], "_n", cfg)
    return salted_join(df, ranks, [score], "inner", hot, spread or df.columns[0], null_safe=True)


def first_by_hash(
    df: DataFrame, digest: Column, tie: str, out: str, total: str, wanted: Column
) -> tuple[DataFrame, DataFrame]:
    """Rows that may be among the first `wanted` in the order of a hex digest, and all others.

    The first part carries its 1-based position and the number of rows; `wanted` may refer to
    that number. The first four hex digits split the rows evenly into 65,536 slices. Slice counts
    give each slice its offset, so slices that start after the wanted rows are never shuffled,
    and only the rows of one slice are ever sorted together.
    """
    keyed = df.withColumn("_digest", digest).withColumn("_slice", F.substring("_digest", 1, 4))
    counts = keyed.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    offsets = stored(
        running_totals(counts, [F.asc("_slice")], "_n")
        .withColumn(total, F.sum("_n").over(W.partitionBy()))
        .drop("_n"),
        "offsets",
    )
    # at most 65,536 lines
    sliced = keyed.join(F.broadcast(offsets), "_slice")
    inside = W.partitionBy("_slice").orderBy("_digest", tie)
    near = (
        sliced.filter(F.col("_before") < wanted)
        .withColumn(out, (F.col("_before") + F.row_number().over(inside)).cast("bigint"))
        .drop("_digest", "_slice", "_before")
    )
    return near, sliced.filter(F.col("_before") >= wanted).select(*df.columns)


def position_by_column(df: DataFrame, column: str, out: str) -> DataFrame:
    """0-based position in the ascending order of a column with few repeats, such as an id.

    Rows are range-partitioned, sorted, numbered inside their partition and written down once, so
    that no number can change if a task runs again. Each slice is then shifted by the rows before it.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = F.asc_nulls_last(column)
    sliced = stored(
        df.repartitionByRange(parts, order).sortWithinPartitions(order).withColumns({
            "_slice": F.spark_partition_id(),
            # the lower 33 bits count the rows of a partition
            "_inside": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
        }),
        "slices",
    )
    offsets = running_totals(
        sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n")), [F.asc("_slice")], "_n"
    ).drop("_n")
    return (
        sliced.join(F.broadcast(offsets), "_slice")
        .withColumn(out, (F.col("_before") + F.col("_inside")).cast("bigint"))
        .drop("_slice", "_inside", "_before")
    )
