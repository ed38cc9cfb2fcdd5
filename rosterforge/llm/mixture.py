"""Mixing sources to target weights: raked token weights and sampling by calibrated probabilities."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from warnings import warn
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from rosterforge.config import Config
from rosterforge.llm.common import PIECE, pieces, small_batches
from rosterforge.operators.skew import hot_keys, salted_join
from rosterforge.sources.staging import stored

TOPICS = 8
TOPIC_DIMS = 256
LONG_WORD = 7              # letters of the words that tell a topic
CELL_BITS = 8              # signs by which vectors are summed for the start of the clustering
TOPIC_ROUNDS = 6           # most k-means rounds over all documents
KEEP_SHARE = 0.5           # share of all tokens to sample
TEMPERATURE = 0.5          # default targets: observed shares to this power
DRIVER_CELLS = 50_000      # cells that are raked on the driver and broadcast; more are raked in Spark
OTHER, MISSING = "(other)", "(none)"
ROUNDS, TOLERANCE = 200, 1e-9
DEVIATION = 1e-6           # share by which a marginal may miss its target without a warning
CACHE_WORDS = 300_000
DIMENSIONS = ("source", "lang", "topic")


class _Places(dict):
    """Word -> hashed place, or -1 for a word too short to tell anything."""

    def __missing__(self, word: str) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        self[word] = place = crc32(word.encode("utf-8", "replace")) % TOPIC_DIMS if len(word) >= LONG_WORD else -1
        return place


def read_text(text: str | None, places: _Places) -> tuple[int, np.ndarray]:
    """Number of words, and the unit vector of a whole text's long words (zero without any)."""
    total, counts, text = 0, np.zeros(TOPIC_DIMS + 1), text or ""
    parts = [text] if len(text) <= PIECE else (
        p.decode("utf-8", "replace") for p in pieces(text.encode("utf-8", "replace"))
    )
    for part in parts:
        words = part.lower().split()
        total += len(words)
        if words:
            counts += np.bincount(np.fromiter(map(places.__getitem__, words), np.int64, len(words)) + 1,
                                  minlength=TOPIC_DIMS + 1)
    vector = np.log1p(counts[1:])
    size = np.sqrt(vector @ vector)
    return total, vector / size if size else vector


def stored_vectors(vectors) -> np.ndarray:
    """Rows of a binary column of `texts_read` as numbers of 0 to 255, exact in sums and products."""
    return np.frombuffer(b"".join(vectors), np.uint8).reshape(-1, TOPIC_DIMS).astype(float)


def whole_units(sums: np.ndarray) -> np.ndarray:
    """Rows at unit length, in whole steps of 1 / 32767, so products with stored vectors are exact."""
    return np.rint(32767 * sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12))


def _sums(vectors: DataFrame, places: Callable[[np.ndarray], np.ndarray], n: int) -> np.ndarray:
    """Sums of the vectors by the place (0 to n - 1) each is given; a last column counts them.

    Every task adds up its own rows; at most n * (TOPIC_DIMS + 1) whole numbers a task are
    shuffled and reach the driver, however many rows there are.
    """
    width = TOPIC_DIMS + 1

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n, width))
        for batch in batches:
            x = stored_vectors(batch.column(0).to_pylist())
            x = x[x.any(axis=1)]
            own = (places(x)[None, :] == np.arange(n)[:, None]).astype(float)
            total += own @ np.hstack([x, np.ones((len(x), 1))])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at].astype(np.int64))], ["at", "amount"])

    rows = vectors.mapInArrow(add, "at bigint, amount bigint").groupBy("at").agg(F.sum("amount").alias("amount")).toPandas()
    out = np.zeros(n * width)
    out[rows["at"].to_numpy(np.int64)] = rows["amount"].to_numpy(float)
    return out.reshape(n, width)


def fit_topics(vectors: DataFrame) -> np.ndarray:
    """At most TOPICS centroids of all rows of a stored table with one binary column of vectors.

    The start comes from sums of all vectors by the signs of CELL_BITS fixed projections: k-means
    of those sums, weighed by what they hold. Up to TOPIC_ROUNDS rounds of spherical k-means over all
    vectors follow, fewer where nothing changes. All sums are whole numbers, so neither the order
    nor the partitions of the rows change a centroid.
    """
    planes = np.where(np.random.default_rng(5).random((TOPIC_DIMS, CELL_BITS)) < 0.5, -1.0, 1.0)
    signs = _sums(vectors, lambda x: (x @ planes > 0) @ (1 << np.arange(CELL_BITS)), 1 << CELL_BITS)
    cells = signs[signs[:, -1] > 0][:, :-1]
    if not len(cells):
        return np.zeros((0, TOPIC_DIMS))
    units, centres = whole_units(cells), whole_units(cells[[np.argmax(cells.sum(axis=1))]])
    while len(centres) < min(TOPICS, len(cells)):
        centres = np.vstack([centres, units[[np.argmin((units @ centres.T).max(axis=1))]]])
    for _ in range(TOPIC_ROUNDS):
        own = np.argmax(units @ centres.T, axis=1)
        centres = _moved(centres, np.stack([cells[own == i].sum(axis=0) for i in range(len(centres))]))
    for _ in range(TOPIC_ROUNDS):
        before = centres
        # bound as a default, as the task's copy must not follow the next round
        sums = _sums(vectors, lambda x, c=centres: np.argmax(x @ c.T, axis=1), len(centres))
        centres = _moved(centres, sums[:, :-1])
        if (centres == before).all():
            break
    return centres


def _moved(centres: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Centroids of the sums; one that nothing is near to stays."""
    return np.where(sums.any(axis=1, keepdims=True), whole_units(sums), centres)


def texts_read() -> Column:
    """A column function: text -> (number of words, vector of its long words in 256 steps, one byte a place)."""

    @pandas_udf("tokens bigint, vector binary")
    def read(texts: pd.Series) -> pd.DataFrame:
        places = _Places()
        found = [read_text(t, places) for t in texts]
        vectors = [np.rint(255 * v).astype(np.uint8).tobytes() for _, v in found]
        return pd.DataFrame({"tokens": [n for n, _ in found], "vector": vectors})

    return read


def topic_of(centres: np.ndarray) -> Column:
    """A column function: stored vector -> the nearest topic; -1 without a telling word."""

    @pandas_udf("int")
    def nearest(vectors: pd.Series) -> pd.Series:
        x = stored_vectors(vectors)
        topics = np.argmax(x @ centres.T, axis=1) if len(centres) else np.full(len(x), -1)
        return pd.Series(np.where(x.any(axis=1), topics, -1))

    return nearest


def rake(cells: np.ndarray, mass: np.ndarray, targets: list[np.ndarray]) -> tuple[np.ndarray, float]:
    """Iterative proportional fitting of `mass` over cells [cell, dimension] to marginal shares.

    A target without any mass cannot be met and is left out, the others scaled up. Returns the
    raked mass, with its total unchanged, and the largest deviation left from a target share.
    """
    raked, total = mass.astype(float).copy(), float(mass.sum())
    if total <= 0:
        return raked, 0.0
    goals = []
    for d, target in enumerate(targets):
        there = np.bincount(cells[:, d], mass, len(target)) > 0
        goal = np.where(there, target, 0.0)
        goals.append(total * (goal / goal.sum() if goal.sum() > 0 else there / there.sum()))
    off = 0.0
    for _ in range(ROUNDS):
        for d, goal in enumerate(goals):
            now = np.bincount(cells[:, d], raked, len(goal))
            raked *= np.where(now > 0, goal / np.where(now > 0, now, 1), 0.0)[cells[:, d]]
        off = max(
            float(np.abs(np.bincount(cells[:, d], raked, len(g)) - g).max()) / total for d, g in enumerate(goals)
        )
        if off < TOLERANCE:
            break
    return raked, off


def rake_cells(cells: DataFrame, targets: Mapping[str, Mapping[str, float]] | None) -> tuple[DataFrame, float]:
    """`rake` over a stored table of cells (_in_<dimension>, tokens) of any size, with a column `raked`.

    Each dimension of a round is one sum per category, whose factor is joined back; the result is
    stored before the next, so plans stay small.
    """
    columns = [f"_in_{d}" for d in DIMENSIONS]
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    raked = cells.withColumn("raked", F.col("tokens").cast("double"))
    if total <= 0:
        return raked, 0.0
    goals = {}
    for d, c in zip(DIMENSIONS, columns):
        own = cells.groupBy(c).agg(F.sum("tokens").cast("double").alias("own")).filter("own > 0")
        if targets and d in targets:
            given = cells.sparkSession.createDataFrame(
                [(k, float(v)) for k, v in targets[d].items()], f"{c} string, goal double"
            )
            own = own.join(given, c, "left").fillna(0.0, ["goal"])
        else:
            own = own.withColumn("goal", F.pow("own", F.lit(TEMPERATURE)))
        goals[c] = own = stored(own.select(c, "goal"), "mixture_goals")
        whole, n = own.agg(F.sum("goal"), F.count(F.lit(1))).first()
        goals[c] = own.withColumn("goal", F.col("goal") * (total / whole) if whole > 0 else F.lit(total / n))
    off = 0.0
    for _ in range(ROUNDS):
        for c, goal in goals.items():
            now = raked.groupBy(c).agg(F.sum("raked").alias("now")).join(goal, c, "left")
            factor = F.when(F.col("now") > 0, F.coalesce("goal", F.lit(0.0)) / F.col("now")).otherwise(0.0)
            raked = raked.join(now.select(c, factor.alias("_by")), c).withColumn("raked", F.col("raked") * F.col("_by"))
            raked = stored(raked.select(*columns, "tokens", "raked"), "mixture_raked")
        off = max(
            raked.groupBy(c).agg(F.sum("raked").alias("now")).join(goal, c)
            .agg(F.max(F.abs(F.col("now") - F.col("goal")))).first()[0] / total
            for c, goal in goals.items()
        )
        if off < TOLERANCE:
            break
    return raked, off


def keep_probabilities(mass: np.ndarray, raked: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Per cell: probability of sampling, and the weight a sampled document then carries.

    The wanted rate of a cell is share * raked / mass. A rate above one cannot be sampled: all
    documents are taken and weigh that much, so weighted token sums meet the targets either way.
    """
    rate = share * np.divide(raked, mass, out=np.zeros(len(mass)), where=mass > 0)
    return np.minimum(rate, 1.0), np.maximum(rate, 1.0)


def mix_sources(
    docs: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, share: float = KEEP_SHARE,
    id_col: str = "doc_id", text_col: str = "text", seed: int = 11, carry: Sequence[str] | None = None,
) -> DataFrame:
    """(row, tokens, topic, probability, weight, sampled) for every row of `docs`; `row` holds the
    columns in `carry`, all by default.

    Tokens are white-space words; topics are clusters of hashed long words, fitted on all rows
    and told for every whole text. Tokens are summed per (source, language, topic) over
    all rows, and the sums are raked to the target shares per dimension, on the driver up to
    DRIVER_CELLS of them and in Spark beyond. Without given targets a dimension's shares are
    flattened by TEMPERATURE, every category having a target of its own. Null sources and
    languages are a category of their own; categories without a place in the given targets share
    one. A warning tells where a marginal is left more than DEVIATION off its target. Sampling compares a hash of id and
    text with the probability, so a rerun takes the same rows and equal rows share their fate. A
    text without words weighs nothing and is sampled as its cell is, or not at all in a cell
    without tokens. The texts are read once and not shuffled; TOPIC_DIMS bytes of a text are stored for
    the topics.
    """
    small_batches(docs.sparkSession)
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(MISSING)).alias(f"_{c}")
    text = F.col(text_col).cast("string")
    marked = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry or docs.columns]).alias("row"), F.xxhash64(id_col, F.xxhash64(text)).alias("_draw"),
        name("source"), name("lang"), texts_read()(text).alias("_read"),
    ).withColumns({"tokens": F.col("_read.tokens"), "_vector": F.col("_read.vector")}).drop("_read")
    # texts are read once: the topics, the sums and the sampling all start from this copy
    marked = stored(marked, "mixture_rows")
    topic = topic_of(fit_topics(marked.select("_vector")))
    marked = marked.withColumn("_topic", topic("_vector")).drop("_vector")
    narrow = marked.groupBy("_source", "_lang", "_topic").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("n"))
    sums = stored(narrow, "mixture_cells")

    def folded(d: str) -> Column:
        text = F.col(f"_{d}").cast("string")
        if targets and d in targets:
            text = F.when(text.isin(sorted(targets[d])), text).otherwise(F.lit(OTHER))
        return text.alias(f"_in_{d}")

    columns = [f"_in_{d}" for d in DIMENSIONS]
    rows = sums.select(*[folded(d) for d in DIMENSIONS], "tokens", "n").groupBy(*columns).agg(
        F.sum("tokens").alias("tokens"), F.sum("n").alias("n")
    )
    marked = marked.withColumns({f"_in_{d}": folded(d) for d in DIMENSIONS})
    draw = F.shiftrightunsigned(F.xxhash64("_draw", F.lit(seed)), 11) / float(1 << 53)

    def sampled(joined: DataFrame, off: float) -> DataFrame:
        if off > DEVIATION:
            warn(f"op10_mixture: a marginal is left {off:.2g} off its target share", stacklevel=3)
        return joined.withColumn("sampled", draw < F.col("probability")).select(
            "row", "tokens", F.col("_topic").alias("topic"), "probability", "weight", "sampled"
        )

    if rows.count() > DRIVER_CELLS:
        rows = stored(rows, "mixture_folded")
        raked, off = rake_cells(rows.select(*columns, "tokens"), targets)
        rate = F.when(F.col("tokens") > 0, share * F.col("raked") / F.col("tokens")).otherwise(0.0)
        cells = raked.select(
            *columns, F.least(rate, F.lit(1.0)).alias("probability"), F.greatest(rate, F.lit(1.0)).alias("weight")
        )
        hot = hot_keys(rows, columns, "n", Config())
        spread = marked.withColumn("_nth", F.monotonically_increasing_id())
        return sampled(salted_join(spread, cells, columns, "inner", hot, "_nth"), off)
    table = rows.drop("n").toPandas().sort_values(columns).reset_index(drop=True)
    mass = table["tokens"].to_numpy(float)
    codes, goals = [], []
    for d in DIMENSIONS:
        code, names = pd.factorize(table[f"_in_{d}"], sort=True)
        own = np.bincount(code, mass, len(names))
        if targets and d in targets:
            goal = np.array([targets[d].get(n, 0.0) for n in names])
        else:
            goal = own**TEMPERATURE
        codes.append(code)
        goals.append(goal / goal.sum() if goal.sum() > 0 else goal)
    raked, off = rake(np.stack(codes, axis=1), mass, goals)
    table["probability"], table["weight"] = keep_probabilities(mass, raked, share)
    cells = docs.sparkSession.createDataFrame(
        table.drop(columns="tokens"),
        ", ".join(f"_in_{d} string" for d in DIMENSIONS) + ", probability double, weight double",
    )
    return sampled(marked.join(F.broadcast(cells), columns), off)
