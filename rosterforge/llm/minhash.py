"""MinHash near-duplicates: an inverted join over the coordinates of the signatures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterforge.llm.common import (
    BATCH_BYTES, hash_order, id_schema, parts_for, pieces, rows_that_may_match, small_batches,
)
from rosterforge.llm.components import connected_components
from rosterforge.sources.staging import stored

COORDINATES = 64
#: Coordinates that must agree before two sets are compared. A pair at similarity 0.8 agrees in
#: 51 on average and in fewer than 32 once in two million; closer pairs still more seldom.
AGREE = 32
#: Of its 64 postings a set needs only the rarest 33: two sets that agree in 32 share one of them.
PREFIX = COORDINATES - AGREE + 1
CROWD_BITS = 16            # postings are counted in 65,536 cells, which fixes their order
SLICE_ROWS = 100_000       # postings of a list that one task reads in a row
BLOCK = 1024               # sets of a list that meet in one unit of work
UNIT_ROWS = 100_000        # rows of units handled by one task
PAIRS = 1 << 18            # pairs of a task whose agreements are counted together
BLOCK_SHINGLES = 1 << 21   # shingles of sets that meet in one unit of work, and of a task
COLUMNS = 2048             # shingles that are counted in one product
CACHE_WORDS = 300_000
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        self[word] = code = xxhash.xxh64_intdigest(word)
        return code


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def shingle_set(data: bytes | None, width: int, words: _Words) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles; all of its words where it has fewer."""
    found, carried = [], np.zeros(0, np.uint64)
    for piece in pieces(data or b""):
        own = piece.lower().split()
        codes = np.concatenate([carried, np.fromiter(map(words.__getitem__, own), np.uint64, len(own))])
        n = len(codes) - width + 1
        if n > 0:
            hashes = np.full(n, np.uint64(width), np.uint64)
            for i in range(width):
                hashes = _mixed(hashes * _GOLD + codes[i : i + n])
            found.append(np.unique(hashes))
        carried = codes[max(0, n) :]
    if found:
        return found[0] if len(found) == 1 else np.unique(np.concatenate(found))
    if not len(carried):
        return carried
    code = np.full(1, np.uint64(len(carried) + (1 << 20)), np.uint64)  # never equal to a full shingle's
    for word in carried:
        code = _mixed(code * _GOLD + word)
    return code


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    return rng.integers(0, 2**64, (2, COORDINATES, 1), dtype=np.uint64) | np.array([1, 0], np.uint64)[:, None, None]


def signature(shingles: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """The smallest value of every permutation, as 32 bits."""
    least = np.full(COORDINATES, 2**64 - 1, np.uint64)
    for low in range(0, len(shingles), 2048):
        least = np.minimum(least, (shingles[low : low + 2048] * factors + shifts).min(axis=1))
    return (least >> np.uint64(32)).astype(np.uint32)


def _signed(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(id, text_hash, n, cls, sig) of every row; cls is a 128-bit digest of the whole shingle set."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, (factors, shifts) = _Words(), _permutations()
        for batch in batches:
            sets = [shingle_set(t, width, words) for t in batch.column(2).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                pa.array([signature(s, factors, shifts).tobytes() if len(s) else None for s in sets], pa.binary()),
            ], ["id", "text_hash", "n", "cls", "sig"])

    picked = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).cast("string"))
    return picked.mapInArrow(run, id_schema(picked, "id", "text_hash bigint, n bigint, cls binary, sig binary"))


def _tokens(sigs: np.ndarray) -> np.ndarray:
    """The coordinate-value pairs of each signature as 64-bit names."""
    return _mixed(sigs.astype(np.uint64) + (np.arange(1, COORDINATES + 1, dtype=np.uint64) << np.uint64(32)))


def _cells(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - CROWD_BITS)).astype(np.int64)


def _read_sigs(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, COORDINATES)


def _crowds(classes: DataFrame) -> np.ndarray:
    """Postings per cell of names, over all sets: 65,536 numbers whatever the corpus.

    They rank postings from rare to common. Any order that all sets share keeps the prefix
    exact, so cells that hold several names cost time, never a link.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << CROWD_BITS, np.int64)
        for batch in batches:
            counts += np.bincount(_cells(_tokens(_read_sigs(batch.column(0)))).ravel(), minlength=len(counts))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(counts))), pa.array(counts)], ["cell", "n"])

    total = classes.select("sig").mapInArrow(run, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    out = np.zeros(1 << CROWD_BITS, np.int64)
    for row in total.collect():
        out[row["cell"]] = row["n"]
    return out


def _lows(sigs: np.ndarray) -> np.ndarray:
    """The last four bits of every coordinate, two to a byte: enough to count agreements from above."""
    low = (sigs & np.uint32(15)).astype(np.uint8)
    return low[:, 0::2] | low[:, 1::2] << np.uint8(4)


def _bytes(rows: np.ndarray) -> pa.Array:
    """One binary value per row."""
    flat = pa.py_buffer(np.ascontiguousarray(rows))
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(rows.shape[1]), len(rows), [None, flat]).cast(pa.binary())


def _read_lows(values) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.uint8).reshape(-1, COORDINATES // 2)


def _class_lows(classes: DataFrame) -> DataFrame:
    """(cls, low) of every class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), _bytes(_lows(_read_sigs(batch.column(1))))], ["cls", "low"])

    return classes.select("cls", "sig").mapInArrow(run, "cls binary, low binary")


def _postings(classes: DataFrame, crowds: np.ndarray) -> DataFrame:
    """(token, slice, cls, low): each set under the rarest PREFIX of its coordinate-value pairs.

    Tokens in crowded cells are cut into slices 1, 2 and so on, so no list must pass one task whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sigs = _read_sigs(batch.column(1))
            tokens = _tokens(sigs)
            crowd = crowds[_cells(tokens)]
            # ties of the crowd are broken by the name, as everywhere
            first = np.lexsort((tokens, crowd), axis=1)[:, :PREFIX]
            picked, crowd = (np.take_along_axis(x, first, axis=1).ravel() for x in (tokens, crowd))
            at = np.repeat(np.arange(len(sigs)), PREFIX)
            own = np.frombuffer(b"".join(c[:4] for c in batch.column(0).to_pylist()), np.uint32)[at]
            slices = -(-crowd // SLICE_ROWS)
            yield pa.RecordBatch.from_arrays([
                pa.array(picked.view(np.int64)), pa.array(np.where(slices > 1, 1 + own % slices, 0).astype(np.int32)),
                batch.column(0).take(pa.array(at)), _bytes(_lows(sigs)).take(pa.array(at)),
            ], ["token", "slice", "cls", "low"])

    return classes.select("cls", "sig").mapInArrow(run, "token bigint, slice int, cls binary, low binary")


def _agreements(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Coordinates in which rows of a and b may agree, 0 as soon as AGREE is out of reach.

    The coordinates are merged sixteen at a time; rows that cannot reach AGREE any more are
    skipped by the blocks that follow.
    """
    found = np.zeros(len(a), np.int64)
    alive = np.arange(len(a))
    for low in range(0, COORDINATES, 16):
        half = slice(low // 2, low // 2 + 8)
        differ = a[alive, half] ^ b[alive, half]
        found[alive] += (differ & 15 == 0).sum(axis=1) + (differ < 16).sum(axis=1)
        alive = alive[found[alive] + COORDINATES - low - 16 >= AGREE]
    return np.where(found >= AGREE, found, 0)


def _lists(postings: DataFrame, n_parts: int) -> DataFrame:
    """(token, cls, is_long, leader, agree): the rows of all lists with two sets or more, and of all slices.

    Sorted lists are streamed. The first set of a list or slice leads it, and each other row tells
    in how many coordinates it agrees with its leader; nothing but the leader is held. `is_long`
    marks the rows of slices and those beyond the first BLOCK of a list.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["token", "cls", "is_long", "leader", "agree"]
        key, lead, lead_low, told, waiting, length = None, None, None, True, None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in (0, 1)], axis=1)
            low = _read_lows(batch.column(3).to_pylist())
            new = np.r_[key is None or tuple(keys[0]) != key, (keys[1:] != keys[:-1]).any(axis=1)]
            if not new[0] and not told:
                yield waiting
            told = told if not new[0] else True
            starts = np.maximum.accumulate(np.where(new, np.arange(n), -1))
            led = np.where(starts[:, None] >= 0, low[starts], 0 if lead_low is None else lead_low)
            agree = np.where(new, 0, _agreements(low, led)).astype(np.int32)
            cls = batch.column(2)
            leads = pa.concat_arrays([cls, pa.array([lead], pa.binary())]).take(pa.array(np.where(starts >= 0, starts, n)))
            leads = pc.if_else(pa.array(agree > 0), leads, pa.scalar(None, pa.binary()))
            open_end = bool(new[-1] and not keys[-1, 1])  # the last row may turn out to be alone
            alone = new & np.r_[new[1:], open_end] & (keys[:, 1] == 0)
            place = np.arange(n) - np.where(starts >= 0, starts, -length)
            is_long = pa.array((place >= BLOCK) | (keys[:, 1] > 0))
            length = int(place[-1]) + 1
            rows = pa.RecordBatch.from_arrays([batch.column(0), cls, is_long, leads, pa.array(agree)], names)
            yield rows.filter(pa.array(~alone))
            key, told = tuple(keys[-1]), not open_end
            waiting = rows.slice(n - 1) if open_end else None
            if starts[-1] >= 0:
                lead, lead_low = cls[int(starts[-1])].as_py(), low[starts[-1]].copy()

    dealt = postings.repartition(n_parts, "token", "slice").sortWithinPartitions("token", "slice", "cls")
    return dealt.mapInArrow(run, "token bigint, cls binary, is_long boolean, leader binary, agree int")


def _units(placed: DataFrame, long: DataFrame) -> tuple[DataFrame, int]:
    """(unit, own, cls, comp, low) and rows added: any two sets of a list in different components share a unit.

    A list is a unit. One that is `long` is left out if all its sets are in one component; else it is
    cut by hash into slices of about BLOCK, and every two of them meet in a unit.
    """
    plain = placed.select(F.col("token").alias("unit"), F.lit(0).alias("own"), "cls", "comp", "low")
    if not long.head(1):
        return plain, 0
    sizes = placed.join(long, "token").groupBy("token").agg(
        F.count(F.lit(1)).alias("_n"), F.min("comp").alias("_a"), F.max("comp").alias("_b")
    )
    slices = F.when(F.col("_a") < F.col("_b"), F.ceil(F.col("_n") / BLOCK).cast("int")).otherwise(0)
    sizes = stored(sizes.select("token", slices.alias("_k"), "_n"), "minhash_sizes")
    added = sizes.agg(F.sum(F.col("_n") * (F.col("_k") - 1))).first()[0] or 0
    own = F.pmod(hash_order("cls", seed=5), F.col("_k")).cast("int")
    cut = (
        placed.join(sizes.filter("_k > 0"), "token").withColumn("own", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
        .select(
            F.xxhash64("token", F.least("own", "_other"), F.greatest("own", "_other")).alias("unit"),
            "own", "cls", "comp", "low",
        )
    )
    short = placed.join(long, "token", "left_anti")
    return short.select(F.col("token").alias("unit"), F.lit(0).alias("own"), "cls", "comp", "low").unionByName(cut), added


def forest(comp: np.ndarray, i: np.ndarray, j: np.ndarray, weight: np.ndarray):
    """(pairs, components): of the pairs (i, j) as many as join all components they join, heaviest first.

    There are fewer pairs than components, however many are given.
    """
    taken = []
    rest = np.flatnonzero(comp[i] != comp[j])
    while len(rest):
        # each component takes its best pair; what they join is one component from here on
        best = np.full(int(comp.max()) + 1, -1, np.int64)
        rank = weight[rest].astype(np.int64) << 32 | np.arange(len(rest))
        np.maximum.at(best, comp[i[rest]], rank)
        np.maximum.at(best, comp[j[rest]], rank)
        taken.append(rest[np.unique(best[best >= 0] & ((1 << 32) - 1))])
        comp = _joined(comp, comp[i[taken[-1]]], comp[j[taken[-1]]])
        rest = rest[comp[i[rest]] != comp[j[rest]]]
    return np.concatenate(taken) if taken else np.zeros(0, np.int64), comp


def unit_pairs(unit: np.ndarray, own: np.ndarray, comp: np.ndarray, low: np.ndarray):
    """Rows (i, j): a forest of the pairs of one unit that may agree in AGREE coordinates.

    Rows are sorted by unit. All units are worked through together, PAIRS pairs at a time.
    """
    n = len(unit)
    starts = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
    ends = np.append(starts[1:], n)
    sizes = ends - starts
    # pairs inside a slice meet in the slice's own unit
    across = np.repeat(np.minimum.reduceat(own, starts) != np.maximum.reduceat(own, starts), sizes)
    later = np.repeat(ends, sizes) - np.arange(n) - 1
    before = np.cumsum(later) - later
    total, out = int(later.sum()), [(np.zeros(0, np.int64),) * 2]
    for at in range(0, total, PAIRS):
        entry = np.arange(at, min(at + PAIRS, total))
        i = np.searchsorted(before, entry, side="right") - 1
        j = i + 1 + entry - before[i]
        keep = (comp[i] != comp[j]) & (~across[i] | (own[i] != own[j]))
        i, j = i[keep], j[keep]
        agree = _agreements(low[i], low[j])
        hit = np.flatnonzero(agree)
        taken, comp = forest(comp, i[hit], j[hit], agree[hit])
        out.append((i[hit][taken], j[hit][taken]))
    return tuple(np.concatenate(x) for x in zip(*out))


def family_links(sets: list[np.ndarray], own: np.ndarray, comp: np.ndarray, percent: int):
    """Rows (i, j): a forest of the pairs of a family whose full sets reach the similarity.

    The sets become the rows of a matrix of ones and zeros, a stretch of shingles at a time, and its
    products with itself add up to all intersections. Shingles of a single set cannot count.
    """
    n = np.array([len(s) for s in sets])
    _, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[at] > 1
    row = np.repeat(np.arange(len(sets)), n)[shared]
    column = (np.cumsum(times > 1) - 1)[at[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((len(sets), len(sets)), np.float32)  # whole numbers below 2**24 are exact
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        some = slice(*np.searchsorted(column, (low, low + COLUMNS)))
        ones = np.zeros((len(sets), COLUMNS), np.float32)
        ones[row[some], column[some] - low] = 1
        both += ones @ ones.T
    both = np.triu(both, 1).astype(np.int64)
    i, j = np.nonzero((both > 0) & (100 * both >= percent * (n[:, None] + n[None, :] - both)))
    if own.min() != own.max():  # pairs inside a slice meet in the slice's own unit
        keep = own[i] != own[j]
        i, j = i[keep], j[keep]
    taken, _ = forest(comp, i, j, both[i, j])
    return i[taken], j[taken]


def _joined(comp: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Components after a[k] and b[k] have become one, each named by its smallest."""
    parent = np.arange(int(comp.max()) + 1)
    while True:
        while not np.array_equal(up := parent[parent], parent):
            parent = up
        ra, rb = parent[a], parent[b]
        if np.array_equal(ra, rb):
            return parent[comp]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))


def _pairs_across(lists: DataFrame, long: DataFrame, info: DataFrame) -> DataFrame:
    """(a, b): pairs between components that join whatever candidates join, with fewer rows than sets and tasks.

    `info` has the low bits and the component of every class.
    """
    units, added = _units(lists.select("token", "cls").join(info, "cls"), long)
    n_parts = parts_for(lists.count() + added, UNIT_ROWS)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("unit", kind="stable")
        cls, comp = pdf["cls"].to_numpy(), pd.factorize(pdf["comp"])[0]
        i, j = unit_pairs(pdf["unit"].to_numpy(), pdf["own"].to_numpy(), comp, _read_lows(pdf["low"]))
        return pd.DataFrame({"a": cls[i], "b": cls[j]})

    part = F.pmod(F.xxhash64("unit"), F.lit(n_parts))
    return units.withColumn("part", part).groupBy("part").applyInPandas(run, "a binary, b binary").distinct()


def _linked_in_families(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that connect exactly what full sets connect, inside families and between components.

    `members` has (family, cls, comp, n). Families of one component need no look. One of many sets or
    shingles is cut by hash into slices, every two of which meet in a unit: no pair is written that
    is not a link, and no task holds more than two slices of a family.
    """
    sizes = members.groupBy("family").agg(
        F.count(F.lit(1)).alias("_sets"), F.sum("n").alias("_n"), F.min("comp").alias("_a"), F.max("comp").alias("_b")
    ).filter(F.col("_a") < F.col("_b"))
    slices = F.greatest(F.ceil(F.col("_sets") / BLOCK), F.ceil(F.col("_n") / BLOCK_SHINGLES)).cast("int")
    sizes = stored(sizes.select("family", slices.alias("_k"), "_n"), "minhash_families")
    work = sizes.agg(F.sum(F.col("_n") * F.col("_k"))).first()[0] or 0
    n_parts = parts_for(work, BLOCK_SHINGLES)
    own = F.pmod(hash_order("cls", seed=6), F.col("_k")).cast("int")
    units = (
        members.join(sizes.select("family", "_k"), "family").withColumn("own", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
        .select(
            F.xxhash64("family", F.least("own", "_other"), F.greatest("own", "_other")).alias("unit"), "own", "cls", "comp"
        )
    )

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"a": [], "b": []}, dtype=object)]
        for _, rows in pdf.groupby("unit", sort=False):
            cls, comp = rows["cls"].to_numpy(), pd.factorize(rows["comp"])[0]
            shingles = [np.frombuffer(s, np.uint64) for s in rows["shingles"]]
            i, j = family_links(shingles, rows["own"].to_numpy(), comp, percent)
            out.append(pd.DataFrame({"a": cls[i], "b": cls[j]}))
        return pd.concat(out)

    part = F.pmod(F.xxhash64("unit"), F.lit(n_parts))
    return units.withColumn("part", part).join(sets, "cls").groupBy("part").applyInPandas(run, "a binary, b binary")


def _best(found: DataFrame) -> DataFrame:
    """Of each class `a` the partner it agrees with most."""
    return found.groupBy("a").agg(F.max_by("b", F.struct("agree", "b")).alias("b"), F.max("agree").alias("agree"))


def _pairs(found: DataFrame) -> DataFrame:
    return found.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max("agree").alias("agree"))


def _sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(cls, shingles) of the wanted classes, from the text of the row that stands for each."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).cast("string").alias("text"))
    reps = wanted.select("rep.id", "rep.text_hash", "cls")
    rows = rows_that_may_match(rows, reps, "id", "text_hash")
    reps = reps.select(F.col("id").alias("rep_id"), F.col("text_hash").alias("rep_hash"), "cls")
    same = rows["id"].eqNullSafe(reps["rep_id"]) & (rows["text_hash"] == reps["rep_hash"])
    picked = rows.join(reps, same).select("cls", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in batches:
            cls = batch.column(0).to_pylist()
            sets = [shingle_set(t, width, words).tobytes() for t in batch.column(1).cast(pa.binary()).to_pylist()]
            own = [i for i, s in enumerate(sets) if xxhash.xxh3_128_digest(s) == cls[i]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(own, pa.int64())), pa.array([sets[i] for i in own], pa.binary())],
                ["cls", "shingles"],
            )

    # equal rows under one id give equal sets; one is enough
    return picked.mapInArrow(run, "cls binary, shingles binary").groupBy("cls").agg(F.min("shingles").alias("shingles"))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets reach the similarity: 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keep, pa.bool_())], ["a", "b", "linked"])

    small_batches(pairs.sparkSession)
    left = sets.select(F.col("cls").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("cls").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "sa", "sb")
    return both.mapInArrow(run, "a binary, b binary, linked boolean")


def minhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 2, percent: int = 80
) -> DataFrame:
    """(id_col, n_shingles, component_id, kept) per row: near copies by their sets of word shingles.

    Rows with equal sets are one class. Every class posts under the rarest of its 64
    coordinate-value pairs. Three steps turn postings into links.
    The leader each class agrees with most is confirmed on full sets, which joins large groups of
    copies in linear work. Then candidates between the components so found are counted, as a forest
    that joins whatever they join: its components are families. Last, the full sets of each family
    are compared, slice with slice, wherever two components meet. Neither candidates nor links are
    ever written out as all pairs of a group. `percent` is at least 80: AGREE rests on it.

    Upper case A-Z counts as lower case, words are separated by ASCII white space. A text with
    fewer words than `width` has one shingle, its whole sequence; null texts and texts without words
    have none, link with nothing and are kept under their own id. Rows that repeat an id keep a line
    each. A null id never names a component that has another, and is kept only where it has none.
    """
    if percent < 80:
        raise ValueError("percent must be at least 80")
    spark = docs.sparkSession
    signed = stored(_signed(docs, id_col, text_col, width), "minhash_signed")
    rep = F.struct(F.col("id").isNull().alias("unnamed"), F.col("id").alias("id"), F.col("text_hash").alias("text_hash"))
    classes = stored(
        signed.filter("n > 0").groupBy("cls").agg(
            F.min(rep).alias("rep"), F.min("sig").alias("sig"), F.min("n").alias("n")
        ),
        "minhash_classes",
    )
    postings = _postings(classes, _crowds(classes))
    n_parts = parts_for(classes.count() * PREFIX * 60, 2 * BATCH_BYTES)
    lists = stored(_lists(postings, max(n_parts, int(spark.conf.get("spark.sql.shuffle.partitions")))), "minhash_lists")

    def sets_of(wanted: DataFrame) -> DataFrame:
        return stored(
            _sets(docs, classes.join(wanted.select("cls").distinct(), "cls"), id_col, text_col, width), "minhash_sets"
        )

    led = lists.filter("leader IS NOT NULL").select(F.col("cls").alias("a"), F.col("leader").alias("b"), "agree")
    pairs = stored(_pairs(_best(led)), "minhash_pairs")
    sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("cls")))
    tried = stored(_confirmed(pairs, sets, percent), "minhash_tried")
    roots = connected_components(tried.filter("linked"), "a", "b")
    info = _class_lows(classes).join(roots, F.col("cls") == roots["node"], "left").select(
        "cls", "low", F.coalesce("root", "cls").alias("comp")
    )
    info = stored(info, "minhash_info")
    long = stored(lists.filter("is_long").select("token").distinct(), "minhash_long")
    near = _pairs_across(lists, long, info).unionByName(tried.filter("linked").select("a", "b"))
    families = connected_components(near, "a", "b").select(F.col("node").alias("cls"), F.col("root").alias("family"))
    members = stored(
        families.join(info.select("cls", "comp"), "cls").join(classes.select("cls", "n"), "cls"), "minhash_members"
    )
    links = stored(_linked_in_families(members, sets_of(members), percent), "minhash_links")
    roots = connected_components(tried.filter("linked").select("a", "b").unionByName(links), "a", "b")
    rooted = classes.join(roots, classes["cls"] == roots["node"], "left").select(
        "cls", F.col("rep.id").alias("first"), F.coalesce("root", "cls").alias("root")
    )
    named = rooted.join(rooted.groupBy("root").agg(F.min("first").alias("least")), "root").select("cls", "least")
    linked = signed.filter("n > 0").join(named, "cls").select("id", "n", F.col("least").alias("component_id"))
    empty = signed.filter("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return linked.unionByName(empty).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
