"""SimHash near-duplicates: bit-sliced comparison of fingerprints inside exact candidate buckets."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterforge.llm.common import id_schema, parts_for, pieces, small_batches
from rosterforge.llm.components import connected_components
from rosterforge.sources.staging import stored

SEED = 42
BLOCK = 4096               # fingerprints of one bucket that meet in one unit of work
PART_ROWS = 200_000        # fingerprints handled by one task
ENTRIES = 1 << 18          # (fingerprint, word of 64 fingerprints) pairs compared at once
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def _count_bits(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits."""
    lanes = hashes.view(np.uint8).reshape(-1, 8)
    return np.concatenate([np.bincount(lanes[:, i], minlength=256) @ _BITS for i in range(8)])


def fingerprint(data: bytes | None, width: int = 3) -> int:
    """SimHash of a text's shingles, as an unsigned number; bit 1 where over half the hashes have 1."""
    counts, total, carried = np.zeros(64, np.int64), 0, []
    words: list[bytes] = []
    for piece in pieces(data or b""):
        words = carried + piece.lower().split()
        n = len(words) - width + 1
        if n > 0:
            joined, sizes = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
            ends = np.cumsum(sizes) + np.arange(len(words))
            spans = zip((ends - sizes)[:n].tolist(), ends[width - 1 :].tolist())
            digest = xxhash.xxh64_intdigest
            counts += _count_bits(np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, n))
            total += n
        carried = words[max(0, len(words) - width + 1) :]
    if not total and words:
        counts, total = _count_bits(np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)), 1
    return int(np.packbits(2 * counts > total, bitorder="little").view(np.uint64)[0]) if total else 0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(id, fp) of every row; fp holds the 64 bits as a signed number."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            found = np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["id", "fp"])

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string"))
    return picked.mapInArrow(run, id_schema(picked, "id", "fp bigint"))


def _planes(words: np.ndarray) -> np.ndarray:
    """Vertical form of words of 64 fingerprints: [word, bit] holds that bit of all 64."""
    bits = np.unpackbits(words.view(np.uint8).reshape(-1, 64, 8), axis=2, bitorder="little")
    turned = np.ascontiguousarray(bits.transpose(0, 2, 1))
    return np.packbits(turned, axis=2, bitorder="little").view(np.uint64).reshape(-1, 64)


def _close(fp: np.ndarray, word: np.ndarray, planes: np.ndarray, filled: np.ndarray, radius: int):
    """For each pair of a fingerprint and a word, the members within the radius, as (pair, bits).

    The distances of 64 members are counted together, one bit per counter plane: adding a plane
    of differences is a ripple of AND and XOR (carry-save). A member whose count passes the
    radius is marked; a pair whose members are all marked is abandoned at the next look.
    """
    planes_needed = max(1, radius.bit_length())
    alive = np.arange(len(fp))
    counters = [np.zeros(len(fp), np.uint64) for _ in range(planes_needed)]
    beyond = ~filled[word]
    for bit in range(64):
        asked = (np.uint64(0) - ((fp >> np.uint64(bit)) & np.uint64(1)))
        carry = planes[word, bit] ^ asked
        for i in range(planes_needed):
            counters[i], carry = counters[i] ^ carry, counters[i] & carry
        beyond |= carry
        over = np.zeros(len(fp), np.uint64)  # members whose counter now exceeds the radius
        equal = ~over
        for i in reversed(range(planes_needed)):
            if radius >> i & 1:
                equal &= counters[i]
            else:
                over |= equal & counters[i]
                equal &= ~counters[i]
        beyond |= over
        if bit % 8 == 7:
            keep = np.flatnonzero(~beyond)
            if len(keep) < len(fp):
                fp, word, beyond, alive = fp[keep], word[keep], beyond[keep], alive[keep]
                counters = [c[keep] for c in counters]
            if not len(fp):
                break
    return alive, ~beyond


def _union(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Merge the sets of a[i] and b[i]; parent holds each item's smallest known member."""
    while True:
        while not np.array_equal(up := parent[parent], parent):
            parent = up
        ra, rb = parent[a], parent[b]
        if np.array_equal(ra, rb):
            return parent
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))


def linked(unit: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (fp, fp) between fingerprints of the same unit that are chained by the radius.

    No list of all pairs is made: links only merge sets, and each set gives one link per member.
    """
    order = np.lexsort((fp, unit))
    unit, fp = unit[order], fp[order]
    starts = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
    sizes = np.diff(np.r_[starts, len(unit)])
    keep = sizes > 1
    starts, sizes = starts[keep], sizes[keep]
    parent = np.arange(len(fp))
    if not len(starts):
        return fp[:0], fp[:0]
    n_words = -(-sizes // 64)
    word_start = np.cumsum(n_words) - n_words
    # members of each word: row numbers, padded with the row's own first member
    at = np.repeat(starts, n_words) + 64 * (np.arange(n_words.sum()) - np.repeat(word_start, n_words))
    last = np.repeat(starts + sizes, n_words)
    rows = at[:, None] + np.arange(64)
    real = rows < last[:, None]
    filled = np.packbits(real, axis=1, bitorder="little").view(np.uint64).ravel()
    rows = np.where(real, rows, at[:, None])
    member = np.repeat(starts, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    own_words, own_first = np.repeat(n_words, sizes), np.repeat(word_start, sizes)
    before = np.cumsum(own_words) - own_words
    total = int(own_words.sum())
    for low in range(0, total, ENTRIES):
        entry = np.arange(low, min(low + ENTRIES, total))
        which = np.searchsorted(before, entry, side="right") - 1
        query, word = member[which], own_first[which] + entry - before[which]
        needed, local = np.unique(word, return_inverse=True)
        planes = _planes(np.ascontiguousarray(fp[rows[needed]]))
        pair, bits = _close(fp[query], local, planes, filled[needed], radius)
        for cut in range(0, len(pair), 1 << 14):
            some, found = pair[cut : cut + (1 << 14)], bits[cut : cut + (1 << 14)]
            hit = np.unpackbits(found.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            i, j = np.nonzero(hit)
            parent = _union(parent, query[some[i]], rows[word[some[i]], j])
    parent = _union(parent, np.zeros(0, int), np.zeros(0, int))
    moved = np.flatnonzero(parent != np.arange(len(fp)))
    return fp[moved], fp[parent[moved]]


def _units(fps: DataFrame, radius: int) -> DataFrame:
    """(unit, fp): any two fingerprints within the radius share a unit.

    The 64 bits fall into radius + 2 blocks, of which any two such fingerprints share at least two,
    so each pair of blocks is a bucket key. A bucket of more than BLOCK fingerprints is cut by
    hash into slices, and every two slices meet in a unit: exact, and no unit is larger than
    about 2 x BLOCK. Units are names; nothing is compared here.
    """
    n_blocks = radius + 2
    edges = [round(i * 64 / n_blocks) for i in range(n_blocks + 1)]

    def block(i: int):
        size = edges[i + 1] - edges[i]
        return F.shiftrightunsigned("fp", edges[i]).bitwiseAND((1 << size) - 1)

    keys = F.array(*[
        F.xxhash64(F.lit(i), F.lit(j), block(i), block(j)) for i, j in combinations(range(n_blocks), 2)
    ])
    keyed = fps.select("fp", F.explode(keys).alias("bucket"))
    sizes = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    slices = F.ceil(F.col("_n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("_k")).cast("int")
    return (
        keyed.join(sizes, "bucket")
        .withColumn("_k", slices)
        .withColumn("_own", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
        .select(F.xxhash64("bucket", F.least("_own", "_other"), F.greatest("_own", "_other")).alias("unit"), "fp")
    )


def fingerprint_links(fps: DataFrame, radius: int = 2) -> DataFrame:
    """(a, b): links that connect exactly the distinct fingerprints within the radius of each other."""
    units = stored(_units(fps, radius), "units")
    n_parts = parts_for(units.count(), PART_ROWS)

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = linked(pdf["unit"].to_numpy(), pdf["fp"].to_numpy().view(np.uint64), radius)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    part = F.pmod(F.xxhash64("unit"), F.lit(n_parts))
    return units.withColumn("part", part).groupBy("part").applyInPandas(compare, "a bigint, b bigint").distinct()


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 2
) -> DataFrame:
    """(id_col, fp, component_id) per row: the smallest id reachable over fingerprints that link.

    Exact copies share a fingerprint, so all further work is on distinct fingerprints with their
    smallest id. Null and empty texts have fingerprint zero and link like any other; rows with
    the same id each keep their own line; null ids never name a component unless it has no other.
    """
    prints = stored(fingerprints(docs, id_col, text_col, width), "fingerprints")
    distinct = stored(prints.groupBy("fp").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")), "distinct")
    roots = stored(connected_components(fingerprint_links(distinct.select("fp"), radius), "a", "b"), "roots")
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "component_id")
    # one line per fingerprint on the right: an ordinary join whose large partitions Spark splits
    return prints.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component_id")
