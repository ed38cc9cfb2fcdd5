"""Duplicate contacts: exact merge by key, and similar names for review."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rosterforge.config import Config
from rosterforge.functions import similarity as sim
from rosterforge.operators.skew import hot_keys, hot_row_keys, salted_join
from rosterforge.sources.staging import stored


def contact_preference() -> list[Column]:
    """Survivor rule, lower is better: has a title, then newest; the id settles the rest."""
    return [F.col("title").isNull(), -F.unix_date("source_updated_at")]


def _nulls_last(order: Sequence[Column]) -> list[Column]:
    return [part for c in order for part in (c.isNull(), c)]


def _ordinary_groups(df: DataFrame, key: str, id_col: str, prefer: Sequence[Column]) -> DataFrame:
    """Size and survivor by one window over whole groups: one exchange of the rows, one pass."""
    group = W.partitionBy(key).orderBy(*_nulls_last(prefer), F.col(id_col))
    group = group.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return df.withColumns({"_size": F.count(F.lit(1)).over(group), "_survivor": F.first(id_col).over(group)})


def _hot_groups(
    df: DataFrame, key: str, id_col: str, prefer: Sequence[Column], hot: dict[int, int]
) -> DataFrame:
    """The same for groups too large for a window: minima per slice, then per group, and a salted join."""
    order = F.struct(*[p.alias(f"_{i}") for i, p in enumerate(_nulls_last(prefer))], F.col(id_col))
    slices = df.select(key, order.alias("_order"), F.pmod(F.xxhash64(id_col), F.lit(max(hot.values()))).alias("_slice"))
    per_slice = slices.groupBy(key, "_slice").agg(F.min("_order").alias("_best"), F.count(F.lit(1)).alias("_n"))
    groups = per_slice.groupBy(key).agg(
        F.sum("_n").alias("_size"), F.min("_best").getField(id_col).alias("_survivor")
    )
    return salted_join(df, groups, [key], "inner", hot, id_col, null_safe=True)


def dedupe_exact(
    df: DataFrame, key: str, id_col: str, prefer: Sequence[Column], cfg: Config
) -> DataFrame:
    """Add group_size, survivor id, is_survivor and match_rule for rows that share `key`.

    NULL keys form one group. Ordinary keys are settled by a window; keys with at least
    `hot_key_rows` rows (typically the missing key) are never gathered in one place.
    """
    survivor = f"survivor_{id_col}"
    hot = hot_row_keys(df.select(key), [key], cfg)
    if hot:
        is_hot = F.xxhash64(key).isin(list(hot))
        grouped = _ordinary_groups(df.filter(~is_hot), key, id_col, prefer).unionByName(
            _hot_groups(df.filter(is_hot), key, id_col, prefer, hot)
        )
    else:
        grouped = _ordinary_groups(df, key, id_col, prefer)
    return grouped.select(
        *df.columns,
        F.col("_size").alias("group_size"),
        F.col("_survivor").alias(survivor),
        F.col("_survivor").eqNullSafe(F.col(id_col)).alias("is_survivor"),
        F.when(F.col("_size") > 1, "exact_email").alias("match_rule"),
    )


def merged_links(deduped: DataFrame) -> DataFrame:
    """One row per merged contact: the survivor it went into."""
    return deduped.filter(~F.col("is_survivor")).select(
        "survivor_contact_id", F.col("contact_id").alias("merged_contact_id"), "group_size"
    )


def merged_ids(deduped: DataFrame, cfg: Config) -> DataFrame:
    """Sorted merged ids per survivor, cut by hash into rows of about `list_slice` ids.

    (survivor_contact_id, slice, merged_contact_ids): a group has as many slices as its size
    asks for, so no list grows with the data and every id is in one of them.
    """
    slices = F.ceil(F.col("group_size") / cfg.list_slice)
    return (
        merged_links(deduped)
        .withColumn("slice", F.pmod(F.xxhash64("merged_contact_id"), slices).cast("int"))
        .groupBy("survivor_contact_id", "slice")
        .agg(F.array_sort(F.collect_list("merged_contact_id")).alias("merged_contact_ids"))
    )


def _candidates(names: DataFrame, on: list[str], crowd: int, cfg: Config) -> DataFrame:
    """Pairs of distinct texts of a block, the second with the lower id, that may be similar.

    Every text of a small block meets the others; no block is larger than `block_names_max`
    there. A text of a larger block writes keys that any similar text must share, and meets
    only the texts with such a key and just the common prefix the key was made for.
    """
    keyed = names.select(*on, "_text", "_low")
    if crowd > cfg.block_names_max:
        blocks = names.groupBy(*on).agg(F.count(F.lit(1)).alias("_names")).filter("_names > 1")
        hot = hot_keys(blocks, on, "_names", cfg)
        sized = salted_join(keyed, blocks, on, "inner", hot, "_text")
        # few bytes but much work per name: a fixed number of partitions keeps all cores busy
        parts = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        sized = sized.repartition(parts, *on, "_text")
        large = F.col("_names") > cfg.block_names_max
        keys = sim.pairing_keys_udf(cfg.fuzzy_threshold)(F.when(large, F.col("_text")))
        written = sized.select(*on, "_text", "_low", F.explode(F.coalesce(keys, F.array(F.lit("")))).alias("_key"))
        # a key is made for two lengths: a text meets only texts of the other one
        own, lengths = F.octet_length("_text"), F.split("_key", r"\.")
        other = lengths[2].cast("int") + lengths[3].cast("int") - own
        for_all = F.col("_key") == ""
        keyed = stored(
            written.withColumns({"_own": F.when(for_all, 0).otherwise(own), "_other": F.when(for_all, 0).otherwise(other)}),
            "name_keys",
        )
        return _meet(keyed, [*on, "_key"], on, cfg)
    # the same columns and filters on both sides, renamed above the join, so that one exchange serves both;
    # nothing is missing, and what is done with one side later would say so of that side alone
    keyed = keyed.filter(reduce(Column.__and__, [F.col(c).isNotNull() for c in (*on, "_text", "_low")]))
    a, b = keyed.alias("a"), keyed.alias("b")
    ratio = sim.min_length_ratio(cfg.fuzzy_threshold)
    size1, size2 = F.octet_length("a._text"), F.octet_length("b._text")
    near = F.least(size1, size2) >= ratio * F.greatest(size1, size2) - 1e-9
    same = reduce(Column.__and__, [F.col(f"a.{c}") == F.col(f"b.{c}") for c in on])
    return a.join(b, same & (F.col("b._low") < F.col("a._low")) & near).select(
        *[F.col(f"a.{c}") for c in (*on, "_text", "_low")], F.col("b._text").alias("_text2"), F.col("b._low").alias("_low2")
    )


def _meet(keyed: DataFrame, by: list[str], on: list[str], cfg: Config) -> DataFrame:
    """Distinct pairs of texts with a common key that was made for their lengths and common prefix.

    Keys that very many texts write are cut into slices on the later side.
    """
    keys = [*by, "_own"]
    earlier = keyed.select(
        *by, F.col("_other").alias("_own"), F.col("_text").alias("_text2"), F.col("_low").alias("_low2")
    )
    # a name writes many keys, so the size of the input tables says nothing here
    hot = hot_row_keys(keyed.select(*keys), keys, replace(cfg, most_rows=None))
    made_for = F.split_part("_key", F.lit("."), F.lit(1))
    common = sim.common_prefix(F.col("_text"), F.col("_text2")).cast("string")
    pairs = salted_join(keyed.drop("_other"), earlier, keys, "inner", hot, "_text").filter(
        (F.col("_low2") < F.col("_low")) & ((F.col("_key") == "") | (made_for == common))
    )
    return pairs.select(*on, "_text", "_low", "_text2", "_low2").distinct()


def fuzzy_pairs(
    df: DataFrame,
    cfg: Config,
    id_col: str = "contact_id",
    block: Sequence[str] = ("account_id", "last_name"),
    text: str = "first_name",
    other: str = "email",
) -> DataFrame:
    """(id, possible_duplicate_of): the lowest earlier id in the block with a similar text.

    Expects one row per `other` value, as survivors have. Similarity depends on the text only,
    so rows shrink to distinct texts with their lowest id, and the answer of a row is the lowest
    id over all similar texts, if it is below its own.
    """
    on = [f"_block{i}" for i in range(len(block))]
    parts = [F.col(b) for b in block[:-1]] + [F.lower(block[-1])]
    rows = stored(
        df.filter(F.col(other).isNotNull() & (F.col(text) != ""))
        .select(
            F.col(id_col).alias("_id"),
            *[part.alias(name) for part, name in zip(parts, on)],
            F.lower(text).alias("_text"),
        )
        .dropna(),
        "fuzzy_rows",
    )
    names = stored(
        rows.groupBy(*on, "_text").agg(
            F.min("_id").alias("_low"), F.max("_id").alias("_high"), F.count(F.lit(1)).alias("_rows")
        ),
        "names",
    )
    per_block = names.groupBy(*on).agg(F.count(F.lit(1)).alias("_names"), F.max("_rows").alias("_most"))
    crowd, most = per_block.agg(F.max("_names"), F.max("_most")).first()

    similar = _candidates(names, on, crowd or 0, cfg).filter(
        sim.jaro_winkler_similarity("_text", "_text2") >= cfg.fuzzy_threshold
    )
    lowest = similar.groupBy(*on, "_text").agg(F.min("_low2").alias("_low2"))
    answers = (
        names.join(lowest, [*on, "_text"], "left")
        .select(*on, "_text", F.coalesce("_low2", "_low").alias("_first"), "_high")
        .filter("_first < _high")
        .drop("_high")
    )
    hot = hot_keys(names, [*on, "_text"], "_rows", cfg) if (most or 0) >= cfg.hot_key_rows else {}
    return (
        salted_join(rows, answers, [*on, "_text"], "inner", hot, "_id")
        .filter("_first < _id")
        .select(F.col("_id").alias(id_col), F.col("_first").alias("possible_duplicate_of"))
    )


def dedupe_contacts(contacts: DataFrame, cfg: Config) -> DataFrame:
    """Exact groups on every row, plus the review hint for survivors that look alike.

    The groups are stored, so contacts are read and standardised once.
    """
    exact = stored(dedupe_exact(contacts, "email", "contact_id", contact_preference(), cfg), "exact")
    hints = fuzzy_pairs(exact.filter("is_survivor"), cfg)
    return exact.join(hints, "contact_id", "left")
