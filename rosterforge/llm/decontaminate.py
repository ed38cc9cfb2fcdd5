"""Benchmark decontamination by spaced seeds, with overlaps that tolerate substituted words."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterforge.config import Config
from rosterforge.llm.common import id_schema, pieces, rows_that_may_match, small_batches
from rosterforge.operators.skew import join_many_to_one
from rosterforge.sources.staging import stored

WINDOW = 13                # words that must line up, or the whole item where it is shorter
LEAST_WORDS = 5            # items with fewer words are too short to tell anything
WORDS_PER_SUBSTITUTION = 6 # one word in so many of a window may differ
MAX_WEIGHT = 5             # positions that a mask looks at, at most
CACHE_WORDS = 300_000
LEAST_BITS, MOST_BITS = 20, 28  # size of the table that tells which seeds the benchmark may hold
SEEDS_AT_ONCE = 1 << 20    # places of a text that are hashed at once
STEP_CANDIDATES = 50_000   # candidates of one text that a task verifies
PUNCTUATION = ".,;:!?\"'()[]{}<>«»¿¡…-–—*_/\\|。、，．！？：；「」『』（）《》〈〉【】・"
#: Characters of scripts that are written without spaces; each counts as a word.
UNSPACED = re.compile(
    "[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]"
)


class WordHashes(dict):
    """Raw word -> 64-bit hash of its lower-case form without punctuation at the ends; 0 is no word."""

    def __missing__(self, raw: str) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        word = raw.strip(PUNCTUATION)
        self[raw] = code = (xxhash.xxh64_intdigest(word) | 1) if word else 0
        return code

    def read(self, text: str) -> np.ndarray:
        if not text.isascii():
            text = UNSPACED.sub(r" \g<0> ", text)
        words = text.lower().split()
        found = np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
        return found[found != 0]

    def read_all(self, data: bytes | None) -> np.ndarray:
        found = [self.read(piece.decode("utf-8", "replace")) for piece in pieces(data or b"")]
        return np.concatenate(found) if found else np.zeros(0, np.uint64)


def substitutions(window: int) -> int:
    return window // WORDS_PER_SUBSTITUTION


def seed_masks(window: int) -> tuple[tuple[int, ...], ...]:
    """Fixed masks, as positions looked at, of which one fits any window with the allowed substitutions.

    Greedy cover: of all masks of the greatest weight that can work, take the one that catches
    most of the substitution patterns not yet caught, until none is left.
    """
    wrong = substitutions(window)
    patterns = [frozenset(p) for p in combinations(range(window), wrong)]
    # by the pigeonhole some run of this many words is whole, so this weight always works
    for weight in range(min(MAX_WEIGHT, window - wrong), 0, -1):
        caught = {}
        for rest in combinations(range(1, min(window, weight + 4)), weight - 1):
            mask = (0, *rest)
            caught[mask] = {
                p for p in patterns
                if any(not p & {at + i for i in mask} for at in range(window - mask[-1]))
            }
        chosen, left = [], set(patterns)
        while left and len(chosen) < 4:
            best = max(caught, key=lambda m: (len(caught[m] & left), -m[-1], m))
            if not caught[best] & left:
                break
            chosen.append(best)
            left -= caught[best]
        if not left:
            return tuple(chosen)
    return ((0,),)


def seed_hashes(words: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    """Hash of the looked-at words at every place where the whole mask fits."""
    n = len(words) - mask[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, np.uint64(0x9E3779B97F4A7C15 * (1 + sum(1 << i for i in mask)) % 2**64), np.uint64)
    for i in mask:
        out = (out ^ words[i : i + n]) * np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
    return out


def _item_seeds(items: DataFrame) -> DataFrame:
    """(item_key, seed, own) of every seed of every item, with its place in the item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, seeds, places = [], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for i, data in enumerate(batch.column(1).to_pylist()):
                words = np.frombuffer(data, np.uint64)
                for mask in seed_masks(min(len(words), WINDOW)):
                    found = seed_hashes(words, mask)
                    at += [i] * len(found)
                    seeds.append(found)
                    places.append(np.arange(len(found)))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(at, pa.int64())), pa.array(np.concatenate(seeds).view(np.int64)),
                pa.array(np.concatenate(places)),
            ], ["item_key", "seed", "own"])

    return items.select("item_key", "words").mapInArrow(run, "item_key binary, seed bigint, own bigint")


def _cells(seeds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bits out of 2**size for each seed."""
    again = (seeds ^ seeds >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
    return seeds >> np.uint64(64 - size), again >> np.uint64(64 - size)


def _bits(seeds: DataFrame, size: int) -> np.ndarray:
    """2**size bits, two set for every seed: what a text's seeds are held against before they are joined.

    At most 2**MOST_BITS bits, 32 MB, however large the benchmark; a bit set by chance costs a row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << (size - 6), np.uint64)
        for batch in batches:
            for cells in _cells(batch.column(0).to_numpy().view(np.uint64), size):
                np.bitwise_or.at(bits, cells >> np.uint64(6), np.uint64(1) << (cells & np.uint64(63)))
        at = np.flatnonzero(bits)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(bits[at].view(np.int64))], ["at", "bits"])

    parts = seeds.select("seed").mapInArrow(run, "at bigint, bits bigint")
    table = parts.groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (size - 6), np.int64)
    out[table.column("at").to_numpy()] = table.column("bits").to_numpy()
    return out.view(np.uint64)


def _text_seeds(texts: DataFrame, masks: list[tuple[int, ...]], bits: np.ndarray) -> DataFrame:
    """(text_key, seed, place) of the seeds of whole texts that the benchmark may hold."""
    size = (len(bits) * 64).bit_length() - 1

    def held(cells: np.ndarray) -> np.ndarray:
        return (bits[cells >> np.uint64(6)] >> (cells & np.uint64(63))) & np.uint64(1) != 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordHashes()
        for batch in batches:
            at, seeds, places = [], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for i, data in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                words = table.read_all(data)
                for low in range(0, len(words), SEEDS_AT_ONCE):
                    for mask in masks:
                        found = seed_hashes(words[low : low + SEEDS_AT_ONCE + mask[-1]], mask)
                        one, other = _cells(found, size)
                        hit = np.flatnonzero(held(one))
                        hit = hit[held(other[hit])]
                        at += [i] * len(hit)
                        seeds.append(found[hit])
                        places.append(hit + low)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(at, pa.int64())), pa.array(np.concatenate(seeds).view(np.int64)),
                pa.array(np.concatenate(places)),
            ], ["text_key", "seed", "place"])

    return texts.select("text_key", "text").mapInArrow(run, "text_key binary, seed bigint, place bigint")


def overlap(item: np.ndarray, words: np.ndarray, start: int) -> tuple[int, int, int] | None:
    """(most equal words in one window, equal words of the whole item, window) with the item laid at `start`."""
    window = min(len(item), WINDOW)
    first, last = max(0, -start), min(len(item), len(words) - start)
    if last - first < window:
        return None
    same = item[first:last] == words[start + first : start + last]
    sums = np.concatenate([[0], np.cumsum(same)])
    most = int((sums[window:] - sums[:-window]).max())
    return (most, int(sums[-1]), window) if most >= window - substitutions(window) else None


def _verified(candidates: DataFrame, texts: DataFrame) -> DataFrame:
    """(text_key, item_key, window, matched, matched_item): the best overlap of each text and item.

    `candidates` (text_key, item_key, start, words) meet the one text of their key. A text with very many is
    sent out once per STEP_CANDIDATES of them.
    """
    sizes = candidates.groupBy("text_key").agg(F.ceil(F.count(F.lit(1)) / STEP_CANDIDATES).cast("int").alias("steps"))
    sizes = stored(sizes, "overlap_sizes")
    step = F.pmod(F.xxhash64("item_key", "start"), F.col("steps")).cast("int")
    asked = candidates.join(sizes, "text_key").withColumn("step", step).drop("steps")
    sent = texts.join(sizes, "text_key").withColumn("step", F.explode(F.sequence(F.lit(0), F.col("steps") - 1)))

    def run(texts: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        best: dict[bytes, tuple[int, int, int]] = {}
        words = WordHashes().read_all(texts["text"].iloc[0].encode()) if len(texts) else np.zeros(0, np.uint64)
        for item, start, own in zip(asked["item_key"], asked["start"], asked["words"]):
            found = overlap(np.frombuffer(own, np.uint64), words, start)
            if found:
                best[item] = max(best.get(item, (0, 0, 0)), found)
        key = asked["text_key"].iloc[0] if len(asked) else None
        return pd.DataFrame(
            [(key, item, window, most, same) for item, (most, same, window) in best.items()],
            columns=["text_key", "item_key", "window", "matched", "matched_item"],
        )

    found = sent.select("text_key", "step", "text").groupBy("text_key", "step").cogroup(
        asked.groupBy("text_key", "step")
    ).applyInPandas(run, "text_key binary, item_key binary, window int, matched int, matched_item int")
    most = F.max(F.struct("matched", "matched_item", "window")).alias("best")
    return found.groupBy("text_key", "item_key").agg(most).select(
        "text_key", "item_key", "best.window", "best.matched", "best.matched_item"
    )


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", cfg: Config | None = None,
) -> DataFrame:
    """(id_col, item_id, window, matched, matched_item): items that overlap a document.

    An item overlaps where WINDOW successive words of it, or all of a shorter item, stand in the
    document in line with at most one substituted word in WORDS_PER_SUBSTITUTION. Case and
    punctuation at the ends of words do not count. In scripts without spaces every character is a
    word. The seed masks catch every such window.

    The seeds of documents and items are joined by their hashes, with seeds that stand in very many
    places cut into slices; every place at which an item may lie is then verified word by word
    against the whole text. Both tables stay in Spark; the tasks that read the texts hold a bit table of at
    most 32 MB, which spares the join most seeds. Equal texts are looked at once.

    One row per document row and item, with the best overlap; an item that repeats with equal id and
    text counts once, and items without an id are found under a null one. Null and empty texts
    and items, and items of fewer than LEAST_WORDS words, have no overlaps; rows that repeat an id
    are judged on their own.
    """
    cfg = cfg or Config()
    small_batches(docs.sparkSession)
    item_id, item_text = F.col(item_col), F.col(item_text_col).cast("string")
    listed = benchmark.select(item_id.alias("item_id"), item_text.alias("text")).filter("text IS NOT NULL").distinct()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordHashes()
        for batch in batches:
            found = [table.read_all(t) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            keys = [xxhash.xxh3_128_digest(w.tobytes()) for w in found]
            rows = pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), pa.array([w.tobytes() for w in found], pa.binary())],
                ["item_id", "item_key", "words"],
            )
            yield rows.filter(pa.array([len(w) >= LEAST_WORDS for w in found], pa.bool_()))

    named = stored(listed.mapInArrow(read, id_schema(listed, "item_id", "item_key binary, words binary")), "overlap_items")
    items = named.groupBy("item_key").agg(F.min("words").alias("words"))
    seeds = stored(_item_seeds(items), "overlap_item_seeds")
    lengths = F.least(F.octet_length("words") / 8, F.lit(WINDOW)).cast("int")
    windows = [r["window"] for r in named.select(lengths.alias("window")).distinct().collect()]  # at most WINDOW of them
    masks = sorted({mask for window in windows for mask in seed_masks(window)})
    size = min(MOST_BITS, max(LEAST_BITS, (16 * seeds.count()).bit_length()))

    text_key = F.unhex(F.md5(F.col(text_col).cast("string").cast("binary")))
    texts = docs.select(F.col(id_col).alias("id"), text_key.alias("text_key"), F.col(text_col).cast("string").alias("text"))
    hits = stored(_text_seeds(texts, masks, _bits(seeds, size)).distinct(), "overlap_hits")
    # an item lies where its seed says; the same place may be told by many seeds
    places = join_many_to_one(hits, seeds, ["seed"], "inner", "place", cfg)
    starts = places.select("text_key", "item_key", (F.col("place") - F.col("own")).alias("start")).distinct()
    candidates = stored(join_many_to_one(starts, items, ["item_key"], "inner", "start", cfg), "overlap_candidates")
    wanted = candidates.select("text_key").distinct()
    near = rows_that_may_match(texts, wanted, "text_key").join(wanted, "text_key", "left_semi")
    whole = near.groupBy("text_key").agg(F.min("text").alias("text"))
    found = _verified(candidates, whole).join(named.select("item_key", "item_id"), "item_key").drop("item_key")
    # several spellings of one item may share its words
    best = found.groupBy("text_key", "item_id").agg(F.max(F.struct("matched", "matched_item", "window")).alias("best"))
    best = stored(best, "overlaps")
    rows = rows_that_may_match(texts.drop("text"), best.select("text_key").distinct(), "text_key")
    return rows.join(best, "text_key").select(
        F.col("id").alias(id_col), "item_id", "best.window", "best.matched", "best.matched_item"
    )
