"""Filter interaction audit: truth-table survival words, counted by carry-save positional popcounts."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterforge.config import Config
from rosterforge.llm.common import id_schema, pieces, small_batches
from rosterforge.operators.skew import hot_keys, join_many_to_one, salted_join
from rosterforge.sources.staging import stored

FILTERS = "ABCDE"
N_SUBSETS = 1 << len(FILTERS)
LEAST_WORDS = 200
PENDING = 1 << 16          # words of one counter that wait before they are pressed together
HELD_PARTS = 4_096         # parts a task counts at once; their sums go on before more are begun
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_MARKS = b"#$%&*|"
_CONTINUED = bytes(range(0x80, 0xC0))


def survival_words() -> np.ndarray:
    """For each set of failed filters, the word whose bit S is set if the filters of S all pass."""
    subsets = np.arange(N_SUBSETS, dtype=np.uint32)
    return np.array([
        np.bitwise_or.reduce(np.where(subsets & failed, 0, np.uint32(1) << subsets).astype(np.uint32))
        for failed in range(N_SUBSETS)
    ], np.uint32)


class BitCounter:
    """How many of many 32-bit words have each bit set.

    Words of weight 2**k stand on level k. Three words become one of the same weight (their sum
    bits) and one of twice the weight (their carries), so a level with many words shrinks by
    thirds in whole-array steps; bits are only unpacked where two words or fewer are left.
    """

    def __init__(self) -> None:
        self.levels: list[list[np.ndarray]] = [[]]
        self.waiting = 0

    def add(self, words: np.ndarray) -> None:
        self.levels[0].append(words)
        self.waiting += len(words)
        if self.waiting > PENDING:
            self._press()

    def _press(self) -> None:
        k = 0
        while k < len(self.levels):
            words = np.concatenate(self.levels[k]) if self.levels[k] else np.zeros(0, np.uint32)
            while (third := len(words) // 3):
                a, b, c, rest = words[:third], words[third : 2 * third], words[2 * third : 3 * third], words[3 * third :]
                half = a ^ b
                if k + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[k + 1].append((a & b) | (half & c))
                words = np.concatenate([half ^ c, rest])
            self.levels[k] = [words]
            k += 1
        self.waiting = 0

    def counts(self) -> np.ndarray:
        self._press()
        total = np.zeros(N_SUBSETS, np.int64)
        for k, level in enumerate(self.levels):
            for word in level[0]:
                total += ((int(word) >> np.arange(N_SUBSETS)) & 1).astype(np.int64) << k
        return total


def failures(data: bytes) -> int:
    """Filters A to D that a text fails, as bits."""
    words, seen = 0, set()
    for piece in pieces(data):
        found = piece.split()
        words += len(found)
        seen.update(found)
    chars = len(data.translate(None, _CONTINUED))
    upper = len(data) - len(data.translate(None, _UPPER))
    marks = len(data) - len(data.translate(None, _MARKS))
    return (words < LEAST_WORDS) | (100 * len(seen) < 50 * words) << 1 | (100 * upper > 3 * chars) << 2 | (marks > 0) << 3


def _judged(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """(id, part, failed, digest, spread) of every row: one pass over the whole texts.

    `spread` is the row's number within its task, which cuts hot keys into even slices.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = 0
        for batch in batches:
            texts = [t or b"" for t in batch.column(2).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([failures(t) for t in texts], pa.int32()),
                pa.array([xxhash.xxh3_128_digest(t) for t in texts], pa.binary()),
                pa.array(np.arange(done, done + len(texts), dtype=np.int32)),
            ], ["id", "part", "failed", "digest", "spread"])
            done = (done + len(texts)) % (1 << 30)

    picked = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.col(text_col).cast("string"),
    )
    return picked.mapInArrow(run, id_schema(picked, "id", "part string, failed int, digest binary, spread int"))


def _with_copies(rows: DataFrame, cfg: Config) -> DataFrame:
    """Bit E is added where a smaller id has the same text; large groups of copies are salted."""
    groups = stored(
        rows.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("_rows")).filter("_rows > 1"),
        "survival_copies",
    )
    hot = hot_keys(groups, ["digest"], "_rows", cfg)
    joined = salted_join(rows, groups.select("digest", "first"), ["digest"], "left", hot, "spread")
    late = F.coalesce(F.col("id") > F.col("first"), F.lit(False))
    return joined.withColumn("failed", F.col("failed") + F.when(late, 16).otherwise(0)).drop("first", "digest")


def survivors(rows: DataFrame) -> DataFrame:
    """(part, subset, kept, good, toxic): rows of each part that pass all filters of each subset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = survival_words()
        held: dict[str, tuple[BitCounter, BitCounter, BitCounter]] = {}

        def sums() -> Iterator[pa.RecordBatch]:
            for part, counters in held.items():
                counts = [pa.array(c.counts()) for c in counters]
                subset = pa.array(np.arange(N_SUBSETS, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * N_SUBSETS, pa.string()), subset, *counts], ["part", "subset", "kept", "good", "toxic"]
                )
            held.clear()

        for batch in batches:
            codes = batch.column(0).dictionary_encode()
            own = words[batch.column(1).to_numpy()]
            labels = [batch.column(i).to_numpy(zero_copy_only=False).astype(bool) for i in (2, 3)]
            order = np.argsort(at := codes.indices.to_numpy(), kind="stable")
            cuts = np.flatnonzero(np.diff(at[order], prepend=-1)).tolist() + [len(order)]
            for low, high in zip(cuts, cuts[1:]):
                mine = order[low:high]
                part = codes.dictionary[int(at[mine[0]])].as_py()
                if part not in held and len(held) >= HELD_PARTS:
                    yield from sums()
                counters = held.setdefault(part, (BitCounter(), BitCounter(), BitCounter()))
                counters[0].add(own[mine])
                counters[1].add(own[mine[labels[0][mine]]])
                counters[2].add(own[mine[labels[1][mine]]])
        yield from sums()

    counted = rows.select("part", "failed", "good", "toxic").mapInArrow(
        run, "part string, subset int, kept bigint, good bigint, toxic bigint"
    )
    return counted.groupBy("part", "subset").agg(*[F.sum(c).alias(c) for c in ("kept", "good", "toxic")])


def _at(column: str, subset: Column) -> Column:
    return F.get(F.col("counts"), subset)[column]


def _shapley(own: Column) -> Column:
    """What the filter removes, summed over all orders: it stands behind S in |S|! (n - 1 - |S|)! of them."""
    n = len(FILTERS)
    orders = F.array(*[F.lit(factorial(k) * factorial(n - 1 - k)) for k in range(n)])

    def more(total: Column, before: Column) -> Column:
        lost = _at("kept", before) - _at("kept", before.bitwiseOR(own))
        free = before.bitwiseAND(own) == 0
        return total + F.when(free, F.get(orders, F.bit_count(before)) * lost).otherwise(0)

    return F.aggregate(F.sequence(F.lit(0), F.lit(N_SUBSETS - 1)), F.lit(0).cast("bigint"), more)


def filter_audit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
    cfg: Config | None = None,
) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    Five filters, named in FILTERS, fail a text with under 200 words (A), with fewer distinct words
    than half its words (B), with over 3 % capitals A-Z (C), with one of the marks (D), or that a
    smaller id has too (E, over the whole table). Each row becomes the word of the 32 subsets it
    survives; positional counts of these words per part hold every figure of all 120 orders, so
    the texts are read once and nothing is filtered 120 times.

    Null texts count as empty, null parts as the empty string. Rows without an id are judged as any other and
    never fail E; rows that repeat an id count once each. A row is good or toxic if any label of its
    id says so; labels of unknown ids count nowhere. Copies are told by a 128-bit hash of the whole
    text. No rows give no parts.
    """
    cfg = cfg or Config()
    rows = stored(_judged(docs, id_col, text_col, part_col), "survival_rows")
    flags = labels.groupBy(F.col(id_col).alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    ).filter("id IS NOT NULL").withColumn("id", F.col("id").cast(rows.schema["id"].dataType))
    known = join_many_to_one(_with_copies(rows, cfg), flags, ["id"], "left", "spread", cfg)
    known = known.withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in ("good", "toxic")})
    # 32 rows a part
    parts = survivors(known).groupBy("part").agg(
        F.sort_array(F.collect_list(F.struct("subset", "kept", "good", "toxic"))).alias("counts")
    )
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    steps = parts.withColumn("filter_order", F.explode(orders)).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS))))
    )

    def bit(place: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1), F.ascii(F.substr("filter_order", place, F.lit(1))) - ord(FILTERS[0]))

    before = F.aggregate(
        F.sequence(F.lit(1), F.lit(len(FILTERS))), F.lit(0),
        lambda total, place: total + F.when(place < F.col("step"), bit(place)).otherwise(0),
    )
    steps = steps.withColumn("before", before).withColumn("own", bit(F.col("step")))
    after, every = F.col("before").bitwiseOR(F.col("own")), F.lit(N_SUBSETS - 1)

    def lost(c: str) -> Column:
        return _at(c, F.col("before")) - _at(c, after)

    return steps.select(
        "part", "filter_order", "step", _at("kept", after).alias("kept"), lost("kept").alias("removed"),
        (_at("kept", F.lit(0)) - _at("kept", F.col("own")) - lost("kept")).alias("redundant"),
        (_at("kept", every - F.col("own")) - _at("kept", every)).alias("unique_fails"),
        lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"), _shapley(F.col("own")).alias("shapley"),
    )
