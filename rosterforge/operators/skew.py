"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rosterforge.config import Config

KEY_BUCKETS = 1 << 14  # more than max_hot_keys, so the average bucket is never full


def hot_keys(sizes: DataFrame, keys: Sequence[str], size: str, cfg: Config) -> dict[int, int]:
    """Hash and number of slices of the keys worth salting, from a table with one row count per key.

    A slice holds about `hot_key_rows` rows, however large the key. A hot key has at least
    `hot_key_rows` rows and at least 1 / `max_hot_keys` of all rows, so no more than
    `max_hot_keys` pairs of numbers can reach the driver. No job where `cfg.most_rows` already
    rules hot keys out. Which keys are listed never changes a result: a hash collision only salts
    one more key.
    """
    if cfg.most_rows is not None and cfg.most_rows < cfg.hot_key_rows:
        return {}
    total, most = sizes.agg(F.sum(size), F.max(size)).first()
    if (most or 0) < cfg.hot_key_rows:
        return {}
    return _slices(sizes, keys, size, max(cfg.hot_key_rows, total / cfg.max_hot_keys), cfg)


def _slices(sizes: DataFrame, keys: Sequence[str], size: str, least: float, cfg: Config) -> dict[int, int]:
    listed = sizes.filter(F.col(size) >= least).select(F.xxhash64(*keys).alias("h"), F.col(size).alias("n"))
    slices: dict[int, int] = {}
    for row in listed.collect():
        slices[row["h"]] = max(slices.get(row["h"], cfg.salts), math.ceil(row["n"] / cfg.hot_key_rows))
    return slices


def key_sizes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))


def hot_row_keys(df: DataFrame, keys: Sequence[str], cfg: Config) -> dict[int, int]:
    """`hot_keys` of a table's rows, without counting every key.

    A key cannot have more rows than the hash bucket it falls into. Buckets are few, so a task
    sends a bounded number of lines; only keys of buckets with enough rows for a hot key, normally
    none, are then counted one by one. At most `max_hot_keys` bucket numbers reach the driver.
    """
    if cfg.most_rows is not None and cfg.most_rows < cfg.hot_key_rows:
        return {}
    bucket = F.pmod(F.xxhash64(*keys), F.lit(KEY_BUCKETS)).cast("int")
    buckets = df.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_rows"))
    large = F.when(F.col("_rows") >= cfg.hot_key_rows, F.struct("_bucket", "_rows"))
    total, found = buckets.agg(F.sum("_rows"), F.collect_list(large)).first()
    least = max(cfg.hot_key_rows, (total or 0) / cfg.max_hot_keys)
    full = [b["_bucket"] for b in found if b["_rows"] >= least]
    if not full:
        return {}
    sizes = key_sizes(df.filter(bucket.isin(full)), keys)
    return _slices(sizes, keys, "_rows", least, cfg)


def _marked(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    return df.join(F.broadcast(hot), F.xxhash64(*[df[k] for k in keys]) == hot["_hot"], "left")


def _join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, null_safe: bool) -> DataFrame:
    if not null_safe:
        return left.join(right, list(keys), how)
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = reduce(Column.__and__, [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys])
    return left.join(renamed, same, how).drop(*[f"_r_{k}" for k in keys])


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str,
    hot: Mapping[int, int],
    spread: str,
    null_safe: bool = False,
) -> DataFrame:
    """`left.join(right, keys, how)` with the rows of hot left keys cut into slices.

    `spread` is a left column that varies inside a key, normally the row id. The right side
    is repeated once per slice for the hot keys only; without hot keys this is a plain join.
    `how` is inner, left, left_semi or left_anti: the kinds for which repeating right rows
    across slices cannot repeat a result.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot salt a {how} join")
    if not hot:
        return _join(left, right, keys, how, null_safe)
    for k in keys:
        # equal values of different types hash differently
        if left.schema[k].dataType != right.schema[k].dataType:
            raise TypeError(f"key {k!r} has different types on the two sides")
    listed = left.sparkSession.createDataFrame(sorted(hot.items()), "_hot bigint, _slices int")
    is_hot = F.col("_hot").isNotNull()
    slice_no = F.pmod(F.xxhash64(spread), F.col("_slices")).cast("int")
    copies = F.when(is_hot, F.sequence(F.lit(0), F.col("_slices") - 1)).otherwise(F.array(F.lit(0)))
    sliced = _marked(left, keys, listed).withColumn("_salt", F.when(is_hot, slice_no).otherwise(0))
    repeated = _marked(right, keys, listed).withColumn("_salt", F.explode(copies))
    sliced, repeated = sliced.drop("_hot", "_slices"), repeated.drop("_hot", "_slices")
    return _join(sliced, repeated, [*keys, "_salt"], how, null_safe).drop("_salt")


def join_many_to_one(
    many: DataFrame, one: DataFrame, keys: Sequence[str], how: str, spread: str, cfg: Config,
    hot: Mapping[int, int] | None = None,
) -> DataFrame:
    """Join a large table to a dimension; keys are counted on the large side to find hot ones.

    The count reads only the key columns and shuffles counts of hash buckets. A caller that
    joins several tables by one key counts once, on the largest, and passes `hot` on.
    """
    if hot is None:
        hot = hot_row_keys(many.select(*keys), keys, cfg)
    return salted_join(many, one, keys, how, hot, spread)


def running_totals(histogram: DataFrame, order: Sequence[Column], count: str) -> DataFrame:
    """Rows that sort before each line of a small histogram, as `_before`.

    The window sees one row per distinct line, a number fixed by the caller, not by the data.
    """
    w = W.orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return histogram.withColumn("_before", F.coalesce(F.sum(count).over(w), F.lit(0)))
