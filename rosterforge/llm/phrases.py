"""Phrase collocations from a weighted de Bruijn graph of word triples."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rosterforge.llm.common import PIECE, parts_for, small_batches
from rosterforge.sources.staging import stored

CHUNK_BYTES = 12 << 20     # text whose equal pieces are counted together
HELD_WORDS = 400_000       # distinct words of a task counted together
CELL_BITS = 16             # nodes are counted in 65,536 cells, which tells crowded ones
SLICE_EDGES = 500_000      # edges in a cell beyond which its nodes are dealt in slices
BUCKET_EDGES = 1_500_000   # edges merged by one task, about
FAN = 1024                 # buckets written in one pass; more are reached by dividing again
RARE_BITS = 22             # bits that tell words which may be frequent
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz\n\n\n\n\n\n\n\n\n ")
_SEPARATOR = re.compile(rb"[.,;:!?\x0A-\x0D]")
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_EDGE = np.dtype([("h1", "<u8"), ("h2", "<u8"), ("h3", "<u8"), ("n", "<u8")])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def _segments(data: bytes) -> Iterator[bytes]:
    """The text cut at separators into stretches of about PIECE bytes; every piece stays whole."""
    at = 0
    while at < len(data):
        cut = _SEPARATOR.search(data, at + PIECE) if at + PIECE < len(data) else None
        end = cut.start() if cut else len(data)
        yield data[at:end]
        at = end


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Counter]]:
    """(language, pieces with their number): equal pieces of a chunk are one path with a weight."""
    held: dict[str, Counter] = {}
    size = 0
    for batch in batches:
        for lang, data in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            for segment in _segments(data or b""):
                held.setdefault(lang, Counter()).update(segment.translate(_FOLD).split(b"\n"))
                size += len(segment)
                if size > CHUNK_BYTES:
                    yield from held.items()
                    held, size = {}, 0
    yield from held.items()


class _Codes(dict):
    """Word -> 64-bit hash, never 0."""

    def __init__(self, seed: int) -> None:
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        if len(self) > HELD_WORDS:
            self.clear()
        self[word] = code = xxhash.xxh64_intdigest(word, self.seed) or 1
        return code


def _coded(paths: Counter, codes: _Codes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all words of the paths, the place of each path's last word, and every word's weight."""
    words: list[bytes] = []
    ends, weights = [], []
    for path, n in paths.items():
        before = len(words)
        words += path.split()
        if len(words) > before:
            ends.append(len(words))
            weights.append(n)
    found = np.fromiter(map(codes.__getitem__, words), np.uint64, len(words))
    ends = np.array(ends, np.int64)
    return found, ends - 1, np.repeat(np.array(weights, np.uint64), np.diff(ends, prepend=0))


def _edges(found: np.ndarray, last: np.ndarray, weight: np.ndarray, bits: np.ndarray | None) -> np.ndarray:
    """One edge per word: the word and the two after it; 0 stands for the end of the path.

    The edge of a path's last two words, and that of its last, are the corrections by which the
    counts of shorter phrases follow from the flow of their node. A word that is too rare for any
    candidate ends a path like a separator.
    """
    if not len(found):
        return np.zeros(0, _EDGE)
    h2, h3 = np.append(found[1:], np.uint64(0)), np.append(found[2:], np.zeros(2, np.uint64))[: len(found)]
    h2[last] = h3[last] = h3[last - 1] = 0
    out = np.zeros(len(found), _EDGE)
    out["h1"], out["n"] = found, weight
    if bits is not None:
        def common(h: np.ndarray) -> np.ndarray:
            cell = h >> np.uint64(64 - RARE_BITS)
            return (bits[cell >> np.uint64(6)] >> (cell & np.uint64(63))) & np.uint64(1) != 0

        often = common(found)
        h2 = np.where(np.append(often[1:], False), h2, np.uint64(0))
        h3 = np.where((h2 != 0) & np.append(often[2:], [False, False])[: len(found)], h3, np.uint64(0))
        out["h2"], out["h3"] = h2, h3
        return out[often]
    out["h2"], out["h3"] = h2, h3
    return out


def _nodes(edges: np.ndarray) -> np.ndarray:
    return _mixed(_mixed(edges["h1"]) * _GOLD + edges["h2"])


def _slices(nodes: np.ndarray, crowds: np.ndarray) -> np.ndarray:
    """In how many slices the edges of each node are dealt; 1 for all but crowded cells."""
    return np.maximum(-(-crowds[(nodes >> np.uint64(64 - CELL_BITS)).astype(np.int64)] // SLICE_EDGES), 1)


def _buckets(edges: np.ndarray, crowds: np.ndarray, n: int) -> np.ndarray:
    """All edges of a node, or of a slice of a crowded node, go to one of n buckets."""
    nodes = _nodes(edges)
    part = _mixed(edges["h3"] + np.uint64(7)) % _slices(nodes, crowds).astype(np.uint64)
    return (_mixed(nodes + part * _GOLD) % np.uint64(n)).astype(np.int64)


def _summed(edges: np.ndarray) -> np.ndarray:
    """Equal edges added up, in order of their words."""
    edges = edges[np.lexsort((edges["h3"], edges["h2"], edges["h1"]))]
    if not len(edges):
        return edges
    new = np.ones(len(edges), bool)
    new[1:] = False
    for c in ("h1", "h2", "h3"):
        new[1:] |= edges[c][1:] != edges[c][:-1]
    at = np.flatnonzero(new)
    out = edges[at]
    out["n"] = np.add.reduceat(edges["n"], at)
    return out


def _packed(lang: str, edges: np.ndarray, crowds: np.ndarray, n_buckets: int, n_now: int) -> Iterator[pa.RecordBatch]:
    """(lang, bucket, edges) rows: summed edges, dealt to n_now groups of the n_buckets buckets."""
    edges = _summed(edges)
    bucket = _buckets(edges, crowds, n_buckets) * n_now // n_buckets
    order = np.argsort(bucket, kind="stable")
    edges, bucket = edges[order], bucket[order]
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist() + [len(edges)]
    press = zstandard.ZstdCompressor(level=1)
    for low in range(0, len(cuts) - 1, 64):
        some = list(zip(cuts[low:], cuts[low + 1 :]))[:64]
        blobs = [press.compress(b"".join(edges[c][a:b].tobytes() for c in _EDGE.names)) for a, b in some]
        yield pa.RecordBatch.from_arrays([
            pa.array([lang] * len(some), pa.string()), pa.array(bucket[[a for a, _ in some]]), pa.array(blobs, pa.binary()),
        ], ["lang", "bucket", "edges"])


def _unpacked(blobs: list[bytes]) -> np.ndarray:
    expand = zstandard.ZstdDecompressor()
    parts = []
    for blob in blobs:
        columns = np.frombuffer(expand.decompress(blob), np.uint64).reshape(4, -1)
        part = np.zeros(columns.shape[1], _EDGE)
        for c, values in zip(_EDGE.names, columns):
            part[c] = values
        parts.append(part)
    return np.concatenate(parts) if parts else np.zeros(0, _EDGE)


def _vocabulary(texts: DataFrame, seed: int) -> DataFrame:
    """(kind, key, lang, word, other, n), summed over all texts.

    Kind 0: a word's hash, with the first and the last word that has it. Kind 1: a cell of nodes
    with the edges in it. Kind 2: the words of a language.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, cells, total = _Codes(seed), np.zeros(1 << CELL_BITS, np.int64), Counter()
        words: Counter = Counter()

        def rows(kind: int, keys, langs, found, counts) -> pa.RecordBatch:
            n = len(counts)
            return pa.RecordBatch.from_arrays([
                pa.array([kind] * n, pa.int32()), pa.array(keys, pa.int64()), pa.array(langs, pa.string()),
                pa.array(found, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64()),
            ], ["kind", "key", "lang", "word", "n"])

        def told() -> Iterator[pa.RecordBatch]:
            names = list(words)
            keys = np.fromiter((codes[w] for w in names), np.uint64, len(names)).view(np.int64)
            counts = [words[w] for w in names]
            words.clear()
            for low in range(0, len(names), 20_000):
                cut = slice(low, low + 20_000)
                yield rows(0, keys[cut], [None] * len(names[cut]), names[cut], counts[cut])

        for lang, paths in _chunks(batches):
            found, last, weight = _coded(paths, codes)
            total[lang] += int(weight.sum())
            edges = _edges(found, last, weight, None)
            cells += np.bincount((_nodes(edges) >> np.uint64(64 - CELL_BITS)).astype(np.int64), minlength=len(cells))
            for path, n in paths.items():
                for word in path.split():
                    words[word] += n
            if len(words) > HELD_WORDS:
                yield from told()
        yield from told()
        full = np.flatnonzero(cells)
        yield rows(1, full, [None] * len(full), [None] * len(full), cells[full])
        yield rows(2, [0] * len(total), list(total), [None] * len(total), list(total.values()))

    found = texts.mapInArrow(run, "kind int, key bigint, lang string, word string, n bigint")
    return found.groupBy("kind", "key", "lang").agg(
        F.min("word").alias("word"), F.max("word").alias("other"), F.sum("n").alias("n")
    )


def _bits(words: DataFrame, least: int) -> np.ndarray:
    """2**RARE_BITS bits, set for every word that occurs often enough: 65,536 numbers at most."""
    cell = F.shiftrightunsigned("key", 64 - RARE_BITS)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), cell.bitwiseAND(63).cast("int"))
    rows = words.filter(F.col("n") >= least).groupBy(F.shiftright(cell, 6).alias("at")).agg(F.bit_or(bit).alias("bits"))
    out = np.zeros(1 << (RARE_BITS - 6), np.int64)
    for row in rows.collect():
        out[row["at"]] = row["bits"]
    return out.view(np.uint64)


def _divided(groups: DataFrame, crowds: np.ndarray, n_buckets: int, n_now: int) -> DataFrame:
    """Groups of buckets dealt to n_now smaller groups; a stretch of a group is summed on the way."""

    def divide(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(_unpacked(batch.column("edges").to_pylist()))
            size += len(held[-1])
            if size > 2 * BUCKET_EDGES:
                yield from _packed(key[0].as_py(), np.concatenate(held), crowds, n_buckets, n_now)
                held, size = [], 0
        if held:
            yield from _packed(key[0].as_py(), np.concatenate(held), crowds, n_buckets, n_now)

    return groups.groupBy("lang", "bucket").applyInArrow(divide, groups.schema)


def _counted(texts: DataFrame, n_buckets: int, crowds: np.ndarray, bits: np.ndarray, seed: int, least: int) -> DataFrame:
    """(kind, lang, h1, h2, h3, n): edges (3), what nodes (2) and words (1) add up to in each bucket.

    A node whose whole flow leaves by one edge is the inside of an unary path: it is compacted into
    that edge, kind 4, which gives its count too. Edges and whole nodes below `least` are left out;
    nodes of crowded cells and words are parts that the caller adds up.
    """
    n_now = min(n_buckets, FAN)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _Codes(seed)
        for lang, paths in _chunks(batches):
            yield from _packed(lang, _edges(*_coded(paths, codes), bits), crowds, n_buckets, n_now)

    now = texts.mapInArrow(cut, "lang string, bucket bigint, edges binary")
    while n_now < n_buckets:
        n_now = min(n_buckets, n_now * FAN)
        now = _divided(now, crowds, n_buckets, n_now)

    def merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        edges = _summed(_unpacked(table.column("edges").to_pylist()))
        h1, h2, h3, n = (edges[c] for c in _EDGE.names)
        whole = _slices(_nodes(edges), crowds) == 1
        word_at = np.flatnonzero(np.r_[True, h1[1:] != h1[:-1]])
        node_at = np.flatnonzero(np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
        flow = np.add.reduceat(n, node_at)
        single = np.diff(np.append(node_at, len(edges))) == 1
        unary = single & whole[node_at] & (h3[node_at] != 0)
        node = (h2[node_at] != 0) & ~unary & ((flow >= least) | ~whole[node_at])
        inside = np.zeros(len(edges), bool)
        inside[node_at] = unary
        edge = (h3 != 0) & (n >= least)
        kinds = [np.ones(len(word_at), int), np.full(node.sum(), 2), np.where(inside[edge], 4, 3)]
        zero = [np.zeros(len(k), np.uint64) for k in kinds]
        columns = [
            np.concatenate([h1[word_at], h1[node_at][node], h1[edge]]),
            np.concatenate([zero[0], h2[node_at][node], h2[edge]]),
            np.concatenate([zero[0], zero[1], h3[edge]]),
            np.concatenate([np.add.reduceat(n, word_at), flow[node], n[edge]]),
        ]
        kind = np.concatenate(kinds).astype(np.int32)
        return pa.table([
            pa.array(kind), pa.array([key[0].as_py()] * len(kind), pa.string()), *[pa.array(c.view(np.int64)) for c in columns],
        ], names=["kind", "lang", "h1", "h2", "h3", "n"])

    return now.groupBy("lang", "bucket").applyInArrow(
        merge, "kind int, lang string, h1 bigint, h2 bigint, h3 bigint, n bigint"
    )


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)) in whole numbers of 38 digits."""
    big = [f"cast({c} AS decimal(19,0))" for c in (a, left, right)]
    return F.expr(f"({big[0]} * {big[0]} * 1000000) div ({big[1]} * {big[2]})").cast("bigint")


def mine_phrases(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 10, covered: int = 50, top: int = 2000
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the strongest phrases of two and three words of each language.

    Texts are cut at `[.,;:!?]` and line ends into pieces, those at blanks and tabs into words, A-Z in
    lower case. The graph's nodes are word pairs, its edges word triples with their counts; one edge
    starts at every word. A pair's count is the flow out of its node, a word's the flow out of all its
    pairs, both with the ends of pieces counted as edges to nowhere. Candidates occur `least` times;
    the weakest cut gives the score; pairs of which a candidate triple holds `covered` percent
    are dropped, and `top` a language remain, ties in byte order of the phrase.

    Words are told by 64-bit hashes, and the vocabulary proves that no two words share one (else
    all is done again with another seed), so counts are exact. Null languages are `und`; null and empty
    texts hold no words; rows count as often as they stand there; ids are not looked at. Languages
    without candidates have no rows. A piece without any separator is held whole by one task.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text")
    )
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    seed = 0
    while True:
        known = stored(_vocabulary(texts, seed), "phrase_words")
        words = known.filter("kind = 0")
        if not words.filter("word <> other").head(1):
            break
        seed += 1
    crowds = np.zeros(1 << CELL_BITS, np.int64)
    for row in known.filter("kind = 1").select("key", "n").collect():  # one row a cell
        crowds[row["key"]] = row["n"]
    n_buckets = parts_for(size // 6, BUCKET_EDGES)
    grams = stored(_counted(texts, n_buckets, crowds, _bits(words, least), seed, least), "phrase_grams")

    singles = grams.filter("kind = 1").groupBy("lang", "h1").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    pairs = grams.filter("kind = 2 OR kind = 4").groupBy("lang", "h1", "h2").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    singles, pairs = stored(singles, "phrase_singles"), stored(pairs, "phrase_pairs")
    triples = grams.filter("kind >= 3").drop("kind").withColumnRenamed("n", "a")

    def word(at: str, name: str) -> DataFrame:
        return singles.select("lang", F.col("h1").alias(at), F.col("n").alias(name))

    def pair(first: str, second: str, name: str) -> DataFrame:
        return pairs.select("lang", F.col("h1").alias(first), F.col("h2").alias(second), F.col("n").alias(name))

    longer = triples.select("lang", "h1", "h2", "a").unionByName(
        triples.select("lang", F.col("h2").alias("h1"), F.col("h3").alias("h2"), "a")
    ).groupBy("lang", "h1", "h2").agg(F.max("a").alias("longest"))
    two = (
        pairs.withColumnRenamed("n", "a").join(longer, ["lang", "h1", "h2"], "left")
        .filter(F.coalesce(100 * F.col("longest") < covered * F.col("a"), F.lit(True)))
        .join(word("h1", "l"), ["lang", "h1"]).join(word("h2", "r"), ["lang", "h2"])
        .select("lang", "h1", "h2", F.lit(None).cast("bigint").alias("h3"), "a", "l", "r", _score("a", "l", "r").alias("score"))
    )
    three = (
        triples.join(pair("h1", "h2", "l2"), ["lang", "h1", "h2"]).join(pair("h2", "h3", "r1"), ["lang", "h2", "h3"])
        .join(word("h1", "l1"), ["lang", "h1"]).join(word("h3", "r2"), ["lang", "h3"])
        .withColumn("s1", _score("a", "l1", "r1")).withColumn("s2", _score("a", "l2", "r2"))
    )
    late = F.col("s2") < F.col("s1")
    three = three.select(
        "lang", "h1", "h2", "h3", "a", F.when(late, F.col("l2")).otherwise(F.col("l1")).alias("l"),
        F.when(late, F.col("r2")).otherwise(F.col("r1")).alias("r"), F.least("s1", "s2").alias("score"),
    )
    found = two.unionByName(three)
    for i in (1, 2, 3):
        spelled = words.select(F.col("key").alias(f"h{i}"), F.col("word").alias(f"w{i}"))
        found = found.join(spelled, f"h{i}", "left" if i == 3 else "inner")
    found = found.withColumn("phrase", F.concat_ws(" ", "w1", "w2", "w3"))
    place = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    totals = known.filter("kind = 2").select("lang", F.col("n").alias("n"))
    return found.withColumn("rank", place).filter(F.col("rank") <= top).join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
