"""Approximate nearest neighbours: a forest of random-projection trees and exact reranking."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rosterforge.llm.common import hash_order
from rosterforge.sources.staging import stored

SMALL_LENGTH = 64          # vectors of one length up to which all are compared, as for the calibration
TREES = 8
LEAF_ROWS = 512            # aim of a leaf
FIT_ROWS = 32_768          # vectors that the split points are taken from; every vector is indexed
MIN_SAMPLE_LEAF = 8        # sampled vectors a leaf must rest on, which bounds the depth
UNIT_ROWS = 65_536         # vectors of neighbouring leaves that are searched by one task
UNIT_QUERIES = 16_384      # queries that meet there
CALIBRATION = 64           # queries answered by brute force to set the leaf budget
RECALL = 0.96              # recall that the budget must reach on them


@dataclass
class Forest:
    """Per tree and level one random direction; per inner node one split point (a heap layout).

    Largest inner product becomes smallest angle by one more coordinate, which lifts every
    vector to the length of the longest; queries have zero there.
    """

    directions: np.ndarray  # tree x level x (dimension + 1)
    splits: np.ndarray      # tree x inner node
    longest: float

    @property
    def depth(self) -> int:
        return self.directions.shape[1]

    def _lift(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.longest**2 - (x**2).sum(axis=1), 0))
        return np.concatenate([x, rest[:, None]], axis=1)

    def route(self, x: np.ndarray) -> np.ndarray:
        """Leaf number of each vector in each tree."""
        lifted = self._lift(x)
        node = np.zeros((len(x), len(self.directions)), np.int64)
        for level in range(self.depth):
            ahead = lifted @ self.directions[:, level].T
            node = 2 * node + 1 + (ahead > np.take_along_axis(self.splits.T, node, axis=0))
        return node - ((1 << self.depth) - 1)

    def visits(self, query: np.ndarray, budget: int | None = None) -> Iterator[tuple[int, int]]:
        """(tree, leaf) in the order of one queue shared by all trees.

        The queue is ordered by how far the query is on the wrong side of the worst split on the
        way to a node, so the next leaf is the most promising of any tree.
        """
        size = math.sqrt(float(query @ query)) or 1.0
        lifted = np.concatenate([query * (self.longest / size), [0.0]])
        ahead = (self.directions @ lifted).tolist()
        splits, inner = self.splits, (1 << self.depth) - 1
        queue = [(-math.inf, tree, 0, 0) for tree in range(len(ahead))]
        found = 0
        while queue and (budget is None or found < budget):
            wrong, tree, node, level = heapq.heappop(queue)
            if node >= inner:
                found += 1
                yield tree, node - inner
                continue
            margin = ahead[tree][level] - splits[tree, node]
            heapq.heappush(queue, (max(wrong, -margin), tree, 2 * node + 2, level + 1))
            heapq.heappush(queue, (max(wrong, margin), tree, 2 * node + 1, level + 1))


def fit_forest(sample: np.ndarray, rows: int, longest: float, seed: int = 7) -> Forest:
    """Random directions, and medians of the sample as split points.

    The depth follows the number of rows to be indexed, as far as the sample supports it.
    """
    wanted = math.ceil(math.log2(max(rows / LEAF_ROWS, 1)))
    depth = max(0, min(wanted, int(math.log2(max(len(sample) / MIN_SAMPLE_LEAF, 1)))))
    rng = np.random.default_rng(seed)
    forest = Forest(rng.normal(size=(TREES, depth, sample.shape[1] + 1)), np.zeros((TREES, (1 << depth) - 1)), longest)
    lifted = forest._lift(sample)
    for tree in range(TREES):
        node = np.zeros(len(sample), np.int64)
        for level in range(depth):
            ahead = lifted @ forest.directions[tree, level]
            order = np.lexsort((ahead, node))
            first = np.searchsorted(node[order], np.arange((1 << level) - 1, (2 << level) - 1))
            last = np.append(first[1:], len(order))
            middle = order[np.minimum((first + last) // 2, len(order) - 1)]
            forest.splits[tree, (1 << level) - 1 : (2 << level) - 1] = np.where(last > first, ahead[middle], 0)
            node = 2 * node + 1 + (ahead > forest.splits[tree, node])
    return forest


def _matrix(column) -> np.ndarray:
    """Rows of equal length as a matrix of doubles."""
    return np.asarray(column.tolist(), float).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vec): one row per id, with finite, non-zero vectors of any length.

    A repeated id keeps the smallest of its vectors.
    """
    vec = F.col("vec")
    finite = ~F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("vec")).filter(
        F.col("vec_id").isNotNull() & vec.isNotNull() & finite & F.exists(vec, lambda x: x != 0)
    )
    return rows.groupBy("vec_id").agg(F.min("vec").alias("vec"))


def _distinct(rows: DataFrame, k: int) -> DataFrame:
    """(vec, first, ids): equal vectors once, with their k + 1 smallest ids.

    More than k + 1 equal vectors can never all be among the k nearest of a query other than
    one of them, so nothing is lost; the limit is applied inside each task before the shuffle.
    """
    by_id = W.partitionBy("vec").orderBy("vec_id")
    few = rows.withColumn("_at", F.row_number().over(by_id)).filter(F.col("_at") <= k + 1)
    return few.groupBy("vec").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).withColumn("first", F.col("ids")[0])


def _brute_force(points: DataFrame, queries: list[tuple[int, np.ndarray]], k: int) -> DataFrame:
    """(query, first, leaves, score): the k nearest distinct vectors of a few queries, by comparing all."""
    ids, q = np.array([i for i, _ in queries]), np.stack([v for _, v in queries])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            scores = _matrix(pdf["vec"]) @ q.T
            for j, query in enumerate(ids):
                own = np.array([len(x) > 1 or x[0] != query for x in pdf["ids"]], bool)
                at = np.flatnonzero(own)
                at = at[np.argsort(-scores[at, j], kind="stable")[:k]]
                yield pd.DataFrame({"query": query, "first": pdf["first"].iloc[at], "leaves": pdf["leaves"].iloc[at],
                                    "score": scores[at, j]})

    near = points.mapInPandas(run, "query bigint, first bigint, leaves array<int>, score double")
    best = W.partitionBy("query").orderBy(F.desc("score"), "first")
    return near.withColumn("_at", F.row_number().over(best)).filter(F.col("_at") <= k).drop("_at")


def leaf_budget(forest: Forest, queries: list[tuple[int, np.ndarray]], true: pd.DataFrame) -> int:
    """Leaves a query must visit so that RECALL of the true neighbours of sampled queries are met."""
    needed: list[int] = []
    by_query = dict(list(true.groupby("query")))
    for query, vector in queries:
        if query not in by_query:
            continue
        turn = {place: i + 1 for i, place in enumerate(forest.visits(vector))}
        for leaves in by_query[query]["leaves"]:
            needed.append(min(turn[(tree, int(leaf))] for tree, leaf in enumerate(leaves)))
    if not needed:
        return TREES
    return int(np.sort(needed)[min(len(needed) - 1, math.ceil(RECALL * len(needed)) - 1)])


def _nearest_exactly(rows: DataFrame, is_query: Column, k: int) -> DataFrame:
    """The neighbours among vectors of lengths so rare that a task can hold all of one length."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x, ids = _matrix(pdf["vec"]), pdf["vec_id"].to_numpy()
        out = [pd.DataFrame({"query_id": ids[:0], "rank": ids[:0], "vec_id": ids[:0], "score": x[:0, 0]})]
        for at in np.flatnonzero(pdf["asked"].to_numpy()):
            score = np.add.reduce(x * x[at], axis=1)
            best = np.lexsort((ids, -score))
            best = best[best != at][:k]
            out.append(pd.DataFrame(
                {"query_id": ids[at], "rank": np.arange(1, len(best) + 1), "vec_id": ids[best], "score": score[best]}
            ))
        return pd.concat(out)

    asked = rows.withColumns({"asked": F.coalesce(is_query, F.lit(False)), "length": F.size("vec")})
    return asked.groupBy("length").applyInPandas(run, "query_id bigint, rank int, vec_id bigint, score double")


def nearest_neighbours(
    vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found by largest inner product.

    `is_query` is a condition on `vec_id`. Null ids take no part; neither do vectors that are
    null, zero, or hold null or non-finite parts. An inner product needs vectors of one length, so each length
    is a search of its own: lengths of up to SMALL_LENGTH vectors are compared in full, a task a
    length, and every longer list gets an index.
    """
    rows = stored(_usable(vectors, id_col, vector_col), "vectors")
    lengths = rows.groupBy(F.size("vec").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    large = [r["length"] for r in lengths.filter(F.col("n") > SMALL_LENGTH).orderBy("length").collect()]
    found = _nearest_exactly(rows.filter(~F.size("vec").isin(large)), is_query, k)
    for length in large:  # each holds more than SMALL_LENGTH vectors
        found = found.unionByName(_nearest_indexed(rows.filter(F.size("vec") == length), is_query, k))
    return found


def _nearest_indexed(rows: DataFrame, is_query: Column, k: int) -> DataFrame:
    """The neighbours among vectors of one length.

    The trees are fitted on a bounded sample and index every vector; the leaf budget is the smallest
    that finds RECALL of the true neighbours of CALIBRATION queries, which are compared with all
    vectors. Leaves with a common beginning form a unit of about UNIT_ROWS vectors; a unit that is
    larger, or that more than UNIT_QUERIES queries visit, is cut by hash. A query goes only to units
    in which it visits a leaf, scores exactly the members of its leaves, and brings back k + 1 of them.
    """
    points = stored(_distinct(rows, k), "points")
    length = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    n, longest = points.agg(F.count(F.lit(1)), F.max(length)).first()
    empty = rows.select(
        F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score")
    ).filter("false")
    if not n:
        return empty
    sample = points.select("vec").orderBy(hash_order("first", seed=3), "first").limit(FIT_ROWS).toPandas()
    forest = fit_forest(_matrix(sample["vec"]), n, longest)
    depth = forest.depth

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves = forest.route(_matrix(batch.column(0).to_numpy(zero_copy_only=False)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(list(leaves.astype(np.int32)), pa.list_(pa.int32()))],
                [*batch.schema.names, "leaves"],
            )

    kind = points.schema["vec"].dataType.simpleString()
    routed = stored(
        points.select("vec", "ids", "first").mapInArrow(
            index, f"vec {kind}, ids array<bigint>, first bigint, leaves array<int>"
        ),
        "routed",
    )
    asked = rows.filter(is_query)
    few = [(r["vec_id"], np.array(r["vec"], float)) for r in asked.orderBy(hash_order("vec_id", seed=4)).limit(CALIBRATION).collect()]
    if not few:
        return empty
    budget = leaf_budget(forest, few, _brute_force(routed, few, k).toPandas())
    bits = min(depth, math.ceil(math.log2(max(n / UNIT_ROWS, 1))))
    low = depth - bits  # a leaf number is its unit's number followed by this many bits

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, units, leaves = [], [], []
            for i, query in enumerate(_matrix(batch.column(1).to_numpy(zero_copy_only=False))):
                own: dict[int, list[int]] = {}
                for tree, leaf in forest.visits(query, budget):
                    own.setdefault(tree << bits | leaf >> low, []).append(leaf)
                at += [i] * len(own)
                units += own.keys()
                leaves += own.values()
            yield pa.RecordBatch.from_arrays(
                [*(c.take(pa.array(at, pa.int64())) for c in batch.columns), pa.array(units, pa.int32()),
                 pa.array(leaves, pa.list_(pa.int32()))],
                ["query_id", "query", "unit", "leaves"],
            )

    visits = stored(
        asked.select(F.col("vec_id").alias("query_id"), F.col("vec").alias("query")).mapInArrow(
            plan, f"query_id bigint, query {kind}, unit int, leaves array<int>"
        ),
        "visits",
    )
    members = routed.select("vec", "ids", "first", F.posexplode("leaves").alias("tree", "leaf")).withColumn(
        "unit", F.shiftleft("tree", bits).bitwiseOR(F.shiftright("leaf", low))
    )
    # at most TREES x n / UNIT_ROWS lines each
    sizes = members.groupBy("unit").agg(F.ceil(F.count(F.lit(1)) / UNIT_ROWS).cast("int").alias("slices"))
    crowds = visits.groupBy("unit").agg(F.ceil(F.count(F.lit(1)) / UNIT_QUERIES).cast("int").alias("blocks"))
    cuts = stored(sizes.join(crowds, "unit"), "unit_cuts")
    spread = lambda n_col: F.explode(F.sequence(F.lit(0), F.col(n_col) - 1))
    held = (
        members.join(cuts, "unit").withColumn("slice", F.pmod(F.xxhash64("first"), F.col("slices")).cast("int"))
        .withColumn("block", spread("blocks")).select("unit", "slice", "block", "vec", "ids", "first", "leaf")
    )
    sent = (
        visits.join(cuts, "unit").withColumn("block", F.pmod(F.xxhash64("query_id"), F.col("blocks")).cast("int"))
        .withColumn("slice", spread("slices")).select("unit", "slice", "block", "query_id", "query", "leaves")
    )
    inside = (1 << low) - 1

    def search(points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        x, leaf = _matrix(points["vec"]), points["leaf"].to_numpy() & inside
        first, ids = points["first"].to_numpy(), points["ids"].to_numpy()
        out = []
        for query_id, query, leaves in zip(queries["query_id"], queries["query"], queries["leaves"]):
            wanted = np.zeros(inside + 1, bool)
            wanted[np.asarray(leaves) & inside] = True
            at = np.flatnonzero(wanted[leaf])
            q = np.asarray(query, float)
            if len(at) > k + 1:
                # no member is left out that rounding may have put below the last one wanted
                rough = x[at] @ q
                slack = 4 * len(q) * np.finfo(float).eps * longest * math.sqrt(float(q @ q))
                at = at[rough >= -np.partition(-rough, k)[k] - slack]
            # one plain sum per pair, so a pair scores alike wherever it is found
            score = np.add.reduce(x[at] * q, axis=1)
            best = np.lexsort((first[at], -score))[: k + 1]
            out.append(pd.DataFrame({"query_id": query_id, "first": first[at[best]], "ids": ids[at[best]], "score": score[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "first": [], "ids": [], "score": []})

    keys = ("unit", "slice", "block")
    found = held.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInPandas(
        search, "query_id bigint, first bigint, ids array<bigint>, score double"
    )
    nearest = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.dropDuplicates(["query_id", "first"])
        .select("query_id", "score", F.explode("ids").alias("vec_id")).filter("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
