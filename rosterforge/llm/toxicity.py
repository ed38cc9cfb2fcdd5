"""Toxicity by weak supervision: voters, a generative label model, and a linear text classifier."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rosterforge.config import Config
from rosterforge.llm.common import hash_order, id_schema, small_batches, smallest_by_hash
from rosterforge.operators.skew import join_many_to_one
from rosterforge.sources.staging import stored

#: Most toxic and clean rows that the lexicon is counted on (in Spark), and most toxic, clean and
#: unlabelled rows that the classifier is fitted on (in the driver). The label model rests on all rows.
FIT_ROWS = 6_000
TRAIN_ROWS = 2_000
SLICES = 8                 # lexicon voters, and as many pattern voters
PREFIXES = (4, 5)          # a pattern is "a longer word that begins with these letters"
MIN_CONTEXTS = 4           # different words before an entry in toxic documents, of 64 hash places,
CONTEXT_SHARE = 0.4        # and as a share of those documents (of 64 where there are more)
MIN_SHARE = 0.985          # share of the entry's documents that must be toxic, classes weighed alike
MIN_EVIDENCE = 20.0        # log-likelihood ratio of the entry against the share of toxic documents
MAX_ENTRIES = 20_000       # lexicon entries kept, most telling first
DENSE = 0.01               # share of a document's words that makes the whole document dense
BITS = 15                  # hashed word features of the classifier: 2 ** BITS
L2_WORDS, L2_VOTERS = 1e-3, 1e-6
PUNCTUATION = ".,;:!?\"'()[]{}<>«»¿¡…-–—*_/\\|"
CACHE_WORDS = 300_000
N_VOTERS = 2 * SLICES + 4
_HASH_MASK = (1 << BITS) - 1


def words_of(text: str | None) -> list[str]:
    """Lower-case words in order; punctuation at the ends is dropped."""
    return [w for w in (raw.strip(PUNCTUATION) for raw in (text or "").lower().split()) if w]


def entries_of(word: str) -> list[str]:
    """The lexicon entries a word can hit: itself, and the patterns of its beginning."""
    return [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) > n)]


class WordTable(dict):
    """Raw word -> hashed feature, lexicon slice and pattern slice in one number; -1 is no word."""

    def __init__(self, entries: frozenset[str]) -> None:
        super().__init__()
        self.words = {e: self.slice_of(e) for e in entries if not e.endswith("*")}
        self.starts = {e[:-1]: self.slice_of(e) for e in entries if e.endswith("*")}

    @staticmethod
    def slice_of(entry: str) -> int:
        return xxhash.xxh32_intdigest(entry, 7) % SLICES + 1

    def __missing__(self, raw: str) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        word = raw.strip(PUNCTUATION)
        code = -1
        if word:
            own, pattern = self.words.get(word, 0), 0
            for n in PREFIXES:
                if len(word) > n:
                    pattern = self.starts.get(word[:n], pattern)
            code = crc32(word.encode("utf-8", "replace")) & _HASH_MASK | (own + (SLICES + 1) * pattern) << BITS
        self[raw] = code
        return code


def read_words(text: str | None, table: WordTable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed word features with their weights (unit length), and the share of words that hit each slice.

    The shares: lexicon slices, pattern slices, any lexicon word, any pattern, distinct hits
    (a number, not a share), and 1 for a text without words.
    """
    counts = Counter((text or "").lower().split())
    codes = np.fromiter(map(table.__getitem__, counts), np.int64, len(counts))
    times = np.fromiter(counts.values(), np.float64, len(counts))
    if len(codes) and codes.min() < 0:
        codes, times = codes[codes >= 0], times[codes >= 0]
    total = times.sum()
    share = np.zeros(N_VOTERS)
    if not total:
        share[-1] = 1
        return codes, times, share
    slices = codes >> BITS
    hit = np.flatnonzero(slices)
    if len(hit):
        own, pattern = slices[hit] % (SLICES + 1), slices[hit] // (SLICES + 1)
        share[:SLICES] = np.bincount(own, times[hit], SLICES + 1)[1:]
        share[SLICES : 2 * SLICES] = np.bincount(pattern, times[hit], SLICES + 1)[1:]
        share[2 * SLICES] = times[hit][own > 0].sum()
        share[2 * SLICES + 1] = times[hit][pattern > 0].sum()
        share /= total
        share[2 * SLICES + 2] = len(hit)
    weight = np.log1p(times)
    return codes & _HASH_MASK, weight / np.sqrt(weight @ weight), share


def votes_of(shares: np.ndarray) -> np.ndarray:
    """+1 toxic, -1 clean, 0 no opinion: one column per voter.

    A slice votes toxic where it is hit, clean where the whole lexicon is silent, and abstains
    where only other slices are hit. Two voters judge lexicon and patterns as a whole, one asks
    for several different hits or a dense document, one knows texts without words.
    """
    slices, totals = shares[:, : 2 * SLICES], shares[:, 2 * SLICES : 2 * SLICES + 2]
    silent = ~(totals > 0).any(axis=1, keepdims=True)
    by_slice = np.where(slices > 0, 1, np.where(silent, -1, 0))
    by_total = np.where(totals > 0, 1, -1)
    dense = (shares[:, [2 * SLICES + 2]] >= 2) | (totals.max(axis=1, keepdims=True) >= DENSE)
    empty = np.where(shares[:, [-1]] > 0, -1, 0)
    return np.hstack([by_slice, by_total, np.where(dense, 1, np.where(silent, -1, 0)), empty]).astype(np.int8)


def label_model(
    votes: np.ndarray, gold: np.ndarray, times: np.ndarray | None = None, rounds: int = 30
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior P(toxic), voter tables P(vote | class) and correlations inside a class.

    Expectation maximisation over all rows, each standing `times` times (once by default). The given
    labels are one more voter that abstains where there is none (`gold` -1) and is nearly always
    right. Each voter has its own table of hit rates per class. Voters that still move together once
    the class is known are correlated; their evidence is divided by the amount they share, so it is
    not counted twice.
    """
    n, m = votes.shape
    times = np.ones(n) if times is None else times.astype(float)
    one_hot = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float)
    known = np.where(gold < 0, 0.0, np.where(gold == 1, 6.0, -6.0))
    prior = np.clip(times[gold == 1].sum() / max(times[gold >= 0].sum(), 1), 0.02, 0.5)
    post = np.where(gold >= 0, gold == 1, 1 / (1 + np.exp(-(votes.sum(axis=1) / 2.0 + np.log(prior / (1 - prior))))))
    tempered, correlation = np.ones(m), np.eye(m)
    free = times * (gold < 0) if (gold < 0).any() else times
    for _ in range(rounds):
        mass = np.stack([1 - post, post], axis=1) * times[:, None]
        tables = (np.einsum("nc,nmv->cmv", mass, one_hot) + 1.0) / (mass.sum(axis=0)[:, None, None] + 3.0)
        spread = np.zeros((m, m))
        for c in (0, 1):
            centred = votes - (tables[c] @ np.array([-1.0, 0.0, 1.0]))
            spread += (centred * mass[:, [c]]).T @ centred
        scale = np.sqrt(np.maximum(np.diag(spread), 1e-9))
        correlation = spread / np.outer(scale, scale)
        strong = np.where(np.abs(correlation) > 0.1, np.abs(correlation), 0)
        tempered = 1 / np.maximum(strong.sum(axis=1), 1)
        prior = np.clip((free * post).sum() / free.sum(), 0.01, 0.6)
        evidence = np.einsum("nmv,mv->nm", one_hot, np.log(tables[1]) - np.log(tables[0])) @ tempered
        logit = evidence + known + np.log(prior / (1 - prior))
        post = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return post, tables, correlation


def voter_features(shares: np.ndarray) -> np.ndarray:
    out = np.log1p(100 * shares)
    out[:, 2 * SLICES + 2] = np.log1p(shares[:, 2 * SLICES + 2]) / 4
    return np.hstack([out, votes_of(shares) == 1])


@dataclass
class LinearModel:
    entries: frozenset[str]
    bias: float
    words: np.ndarray
    voters: np.ndarray
    tables: np.ndarray        # P(vote | class), class x voter x (-1, 0, 1)
    correlation: np.ndarray

    def score(self, texts: list[str | None], table: WordTable) -> np.ndarray:
        logits, shares = np.empty(len(texts)), np.empty((len(texts), N_VOTERS))
        for i, text in enumerate(texts):
            idx, weight, shares[i] = read_words(text, table)
            logits[i] = self.words[idx] @ weight
        logits += self.bias + (voter_features(shares) @ self.voters if len(texts) else 0)
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def fit_linear(
    row: np.ndarray, idx: np.ndarray, val: np.ndarray, shares: np.ndarray, target: np.ndarray, rounds: int = 200
) -> tuple[float, np.ndarray, np.ndarray]:
    """Logistic regression on soft labels by accelerated gradient steps; bias, words, voters.

    Word features come as (row, place, value) lists.
    """
    dense, n, n_words = voter_features(shares), len(target), 1 << BITS
    # classes weigh alike, so a rare class is not swamped
    mass = np.where(target >= 0.5, 0.5 / max((target >= 0.5).sum(), 1), 0.5 / max((target < 0.5).sum(), 1))
    theta = np.zeros(1 + n_words + dense.shape[1])
    decay = np.concatenate([[0.0], np.full(n_words, L2_WORDS), np.full(dense.shape[1], L2_VOTERS)])
    ahead, speed = theta.copy(), 1.0
    step = 4.0 / (2.0 + (dense**2).sum(axis=1).max(initial=0))
    for _ in range(rounds):
        logit = ahead[0] + np.bincount(row, val * ahead[1 + idx], n) + dense @ ahead[1 + n_words :]
        error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - target) * mass
        slope = np.concatenate([[error.sum()], np.bincount(idx, val * error[row], n_words), dense.T @ error])
        new = ahead - step * (slope + decay * ahead)
        next_speed = (1 + np.sqrt(1 + 4 * speed**2)) / 2
        ahead, theta, speed = new + (speed - 1) / next_speed * (new - theta), new, next_speed
    return float(theta[0]), theta[1 : 1 + n_words], theta[1 + n_words :]


def _known(docs: DataFrame, labels: DataFrame, id_col: str) -> DataFrame:
    """(id, gold), the id of the type it has in `docs`: several labels for one id count as the highest."""
    known = labels.filter(F.col("toxic").isNotNull() & F.col(id_col).isNotNull())
    return known.groupBy(F.col(id_col).cast(docs.schema[id_col].dataType).alias("id")).agg(F.max("toxic").cast("int").alias("gold"))


def _fit_sample(docs: DataFrame, known: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, hash, text, gold) of up to FIT_ROWS toxic, clean and unlabelled rows, by hash of id and text.

    Rows, not ids, are chosen, from narrow columns, and brought together by a broadcast of at most
    3 x FIT_ROWS keys; the texts are written once. Rows that repeat id and text count once.
    """
    key = [F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash")]
    ids = docs.filter(F.col(id_col).isNotNull()).select(*key).distinct()
    marked = join_many_to_one(ids, known, ["id"], "left", "hash", Config())
    marked = stored(marked.select("id", "hash", F.coalesce("gold", F.lit(-1)).alias("gold")), "toxicity_keys")
    chosen = smallest_by_hash(marked, FIT_ROWS, hash_order("id", "hash"), "id", "hash", group="gold")
    picked = docs.select(*key, F.col(text_col).cast("string").alias("text")).join(
        F.broadcast(stored(chosen, "toxicity_chosen")), ["id", "hash"]
    )
    # equal rows once; `min` passes over a null text
    return stored(picked.groupBy("id", "hash", "gold").agg(F.min("text").alias("text")), "toxicity_sample")


def vote_code(votes: np.ndarray) -> np.ndarray:
    """Rows of votes as one number each, base three."""
    return (votes.astype(np.int64) + 1) @ 3 ** np.arange(votes.shape[1], dtype=np.int64)


def _votes_of_all(
    docs: DataFrame, known: DataFrame, entries: frozenset[str], id_col: str, text_col: str
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Votes, label (-1 for none) and number of rows of every combination that occurs among all rows.

    Either the whole lexicon is silent or each of 2 * SLICES voters hits or abstains, and the other voters
    follow from that but for one, so fewer than 2 ** (2 * SLICES + 1) + 2 combinations per label can
    exist and reach the driver, however many rows there are.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable(entries)
        for batch in batches:
            shares = np.array([read_words(t, table)[2] for t in batch.column(1).to_pylist()]).reshape(-1, N_VOTERS)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(vote_code(votes_of(shares)))], ["id", "code"])

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    # read once: keys are counted on this copy before they are joined
    coded = stored(picked.mapInArrow(read, id_schema(picked, "id", "code bigint")), "toxicity_votes")
    sizes = coded.groupBy("id", "code").agg(F.count(F.lit(1)).alias("n"))
    marked = join_many_to_one(sizes, known, ["id"], "left", "code", Config())
    found = marked.groupBy("code", F.coalesce("gold", F.lit(-1)).alias("gold")).agg(F.sum("n").alias("n"))
    rows = found.toPandas().sort_values(["code", "gold"])
    code = rows["code"].to_numpy(np.int64)
    votes = (code[:, None] // 3 ** np.arange(N_VOTERS, dtype=np.int64) % 3 - 1).astype(np.int8)
    return votes, rows["gold"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)


def _lexicon(sample: DataFrame) -> frozenset[str]:
    """Words and patterns that are far more common in documents labelled toxic.

    Equal texts count once, and an entry must follow several different words, so the odd words
    of one much-copied document are not taken for a vocabulary.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # entry -> clean documents, toxic documents, places of the words before it in toxic ones
        seen: dict[str, list[int]] = {}
        for batch in batches:
            for text, gold in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                before, held = "", {}
                for word in words_of(text):
                    place = 1 << (crc32(before.encode("utf-8", "replace")) & 63)
                    for entry in entries_of(word):
                        held[entry] = held.get(entry, 0) | place
                    before = word
                for entry, places in held.items():
                    row = seen.setdefault(entry, [0, 0, 0])
                    row[gold] += 1
                    if gold:
                        row[2] |= places
        columns = list(zip(*seen.values())) or [(), (), ()]
        places = np.array(columns[2], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.string()), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
             pa.array(places)],
            ["entry", "clean", "toxic", "places"],
        )

    sizes = {r["gold"]: r["count"] for r in sample.groupBy("gold").count().collect()}
    n_toxic, n_clean = max(sizes.get(1, 0), 1), max(sizes.get(0, 0), 1)
    labelled = sample.filter("gold >= 0").select("text", "gold").dropDuplicates(["text"])
    counted = labelled.mapInArrow(count, "entry string, clean bigint, toxic bigint, places bigint")
    base = n_toxic / (n_toxic + n_clean)
    toxic, clean = F.col("toxic"), F.col("clean")
    share = (toxic / n_toxic) / (toxic / n_toxic + (clean + 0.5) / n_clean)
    seen_share = toxic / (toxic + clean)
    evidence = 2 * (
        toxic * F.log(seen_share / base)
        + F.when(clean > 0, clean * F.log((1 - seen_share) / (1 - base))).otherwise(0.0)
    )
    varied = F.greatest(F.lit(MIN_CONTEXTS), CONTEXT_SHARE * F.least(toxic, F.lit(64)))
    kept = (
        counted.groupBy("entry")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.bit_or("places").alias("places"))
        .filter((toxic > 0) & (F.bit_count("places") >= varied) & (share >= MIN_SHARE))
        .withColumn("evidence", evidence).filter(F.col("evidence") >= MIN_EVIDENCE)
        .orderBy(F.desc("evidence"), "entry").limit(MAX_ENTRIES)
    )
    return frozenset(r["entry"] for r in kept.select("entry").collect())


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LinearModel:
    """Learn voters, label model and classifier from the given documents.

    The lexicon comes from a bounded sample of labelled rows, the label model's accuracies and
    correlations from the votes on all rows, the classifier from a bounded sample with the
    posteriors of the label model. The caller passes only documents it may learn from. Without any
    labelled or any toxic row the lexicon is empty and every score is low. Rows without an id are
    unlabelled.
    """
    small_batches(docs.sparkSession)
    known = stored(_known(docs, labels, id_col), "toxicity_labels")
    sample = _fit_sample(docs, known, id_col, text_col)
    entries = _lexicon(sample)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable(entries)
        for batch in batches:
            found = [read_words(t, table) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.string()), batch.column(2), batch.column(3),
                 pa.array([f[0].astype(np.int32) for f in found], pa.list_(pa.int32())),
                 pa.array([f[1].astype(np.float32) for f in found], pa.list_(pa.float32())),
                 pa.array([f[2] for f in found], pa.list_(pa.float64()))],
                ["id", "gold", "hash", "idx", "weight", "share"],
            )

    schema = "id string, gold int, hash bigint, idx array<int>, weight array<float>, share array<double>"
    by_hash = W.partitionBy("gold").orderBy(hash_order("id", "hash"), "id", "hash")
    fewer = sample.withColumn("_at", F.row_number().over(by_hash)).filter(F.col("_at") <= TRAIN_ROWS)
    picked = fewer.select("id", "text", "gold", "hash")
    rows = picked.mapInArrow(read, schema).toArrow().sort_by([("id", "ascending"), ("hash", "ascending")])
    idx, weight, share = (rows.column(c).combine_chunks() for c in ("idx", "weight", "share"))
    shares, gold = share.flatten().to_numpy().reshape(-1, N_VOTERS), rows.column("gold").to_numpy()
    if not (gold == 1).any():
        tables = np.full((2, N_VOTERS, 3), 1 / 3)
        return LinearModel(entries, -4.0, np.zeros(1 << BITS), np.zeros(2 * N_VOTERS), tables, np.eye(N_VOTERS))
    votes, labelled, times = _votes_of_all(docs, known, entries, id_col, text_col)
    of_all, tables, correlation = label_model(votes, labelled, times)
    place = {key: i for i, key in enumerate(zip(vote_code(votes).tolist(), labelled.tolist()))}
    post = of_all[[place[key] for key in zip(vote_code(votes_of(shares)).tolist(), gold.tolist())]]
    row = np.repeat(np.arange(len(gold)), idx.value_lengths().to_numpy())
    words = row, idx.flatten().to_numpy(), weight.flatten().to_numpy()
    return LinearModel(entries, *fit_linear(*words, shares, post), tables, correlation)


def score_toxicity(docs: DataFrame, model: LinearModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score): P(toxic) of every whole text; empty and null texts get the score of no words.

    The model is a fixed-size object: at most MAX_ENTRIES lexicon entries and 2 ** BITS weights.
    Rows are scored on their own, so repeated ids stay repeated and equal texts score alike.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable(model.entries)
        for batch in batches:
            score = model.score(batch.column(1).to_pylist(), table)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], [id_col, "score"])

    picked = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    return picked.mapInArrow(run, id_schema(docs, id_col, "score double"))
