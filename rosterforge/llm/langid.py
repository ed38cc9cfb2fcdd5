"""Language identification by the nearest of several TF-IDF centroids per language."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rosterforge.llm.common import hash_order, id_schema, small_batches
from rosterforge.sources.staging import stored

DIMS = 1 << 13             # hashed character n-grams
ORDERS = (1, 2, 3)
PIECE = 1 << 20            # characters of a text that are counted at once
FIT_ROWS = 1_500           # most documents per language that the centroids are clustered from
HOT_LANGUAGES = 1_000      # languages with at least 1 / this of all rows are thinned before they are ranked
CENTROIDS = 4              # per language
ROUNDS = 12
REJECT_QUANTILE = 0.001    # share of a centroid's own documents that are farther than its limit
UNKNOWN = "und"
_MULT = (np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917))


def _folded(text: str) -> np.ndarray:
    """Code points in lower case; whatever is no letter becomes one blank per run."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    # letters: a-z and everything beyond the Latin-1 signs, but for the punctuation blocks
    letter = ((points >= 97) & (points <= 122)) | (
        (points >= 0xC0) & (points != 0xD7) & (points != 0xF7) & ((points < 0x2000) | (points >= 0x2C00))
        & ((points < 0x3000) | (points >= 0x3040))
    )
    folded = np.where(letter, points, np.uint32(32))
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first blank of a run stays
    return folded[keep]


def ngram_counts(text: str | None) -> np.ndarray:
    """Hashed counts of all character n-grams of a whole text; all zero without a letter."""
    counts = np.zeros(DIMS, np.int64)
    text = text or ""
    for at in range(0, len(text), PIECE):
        p = _folded(text[at : at + PIECE])
        if not len(p) or (len(p) == 1 and p[0] == 32):
            continue
        p = np.concatenate([[np.uint32(32)], p, [np.uint32(32)]]).astype(np.uint32)
        for order in ORDERS:
            key = np.zeros(len(p) - order + 1, np.uint32)
            for k in range(order):
                key = (key ^ p[k : k + len(key)]) * _MULT[k]
                key ^= key >> np.uint32(15)
            counts += np.bincount(((key ^ np.uint32(order * 0x9E37)) * _MULT[0]) >> np.uint32(19), minlength=DIMS)
    return counts


def vector(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the unit TF-IDF vector."""
    at = np.flatnonzero(counts)
    value = (1 + np.log(counts[at])) * idf[at]
    size = np.sqrt(value @ value)
    return at, value / size if size else value


@dataclass
class CentroidModel:
    languages: list[str]       # one per centroid
    centroids: np.ndarray      # unit rows
    limits: np.ndarray         # least cosine at which a text still belongs to the centroid
    idf: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score in 0..1, and whether the text is farther away than the centroid's own texts."""
        if not self.languages or not any(map(str.isalpha, text or "")):
            return UNKNOWN, 0.0, True
        counts = ngram_counts(text)
        at, value = vector(counts, self.idf)
        cosine = self.centroids[:, at] @ value
        best = int(np.argmax(cosine))
        return self.languages[best], float(np.clip(cosine[best], 0, 1)), bool(cosine[best] < self.limits[best])


def document_frequencies(docs: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """In how many of all the given documents each n-gram bucket occurs, and their number.

    Every task adds up its own documents; at most DIMS numbers per task are shuffled and DIMS
    reach the driver, however large the corpus.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(DIMS + 1, np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts = ngram_counts(text)
                if counts.any():
                    total[:DIMS] += counts > 0
                    n += 1
        total[DIMS] = n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    rows = docs.select(text_col).mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(DIMS + 1, np.int64)
    for r in rows.collect():
        out[r["bucket"]] = r["n"]
    return out[:DIMS], int(out[DIMS])


def cluster(x: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """Spherical k-means with farthest-first seeds; unit centroids, empty ones left out."""
    rng = np.random.default_rng(seed)
    centres = x[[rng.integers(len(x))]]
    while len(centres) < min(k, len(x)):
        centres = np.vstack([centres, x[[np.argmin((x @ centres.T).max(axis=1))]]])
    for _ in range(ROUNDS):
        own = np.argmax(x @ centres.T, axis=1)
        sums = np.stack([x[own == i].sum(axis=0) for i in range(len(centres)) if (own == i).any()])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres


def fit_langid(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> CentroidModel:
    """IDF over all given documents with a language, centroids over a bounded sample of each.

    The sample is the FIT_ROWS rows per language with the smallest hash of id and text; rows, not
    ids, are chosen, from narrow columns, so one id with very many texts brings no more than its
    share, and rows that repeat both count once. Each language is clustered in a task of its own, whose
    input is bounded by FIT_ROWS. Rows without a language, a letter or an id teach nothing.
    """
    known = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).alias("lang")
    ).filter("lang IS NOT NULL AND id IS NOT NULL AND text IS NOT NULL")
    seen, n = document_frequencies(known, "text")
    idf = np.log((1 + n) / (1 + seen)) + 1
    key = ["id", "lang", "hash"]
    known = known.withColumn("hash", F.xxhash64("text"))
    keys = stored(known.select(*key).distinct(), "language_keys")
    # of languages with many rows, hashes above the share of about 2 * FIT_ROWS rows are left out where they
    # lie, before a language meets in its window; at most HOT_LANGUAGES can have that share of all rows
    least = max(4 * FIT_ROWS, keys.count() / HOT_LANGUAGES)
    sizes = keys.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    at = F.shiftrightunsigned(hash_order("id", "hash", seed=1), 11)
    by_hash = W.partitionBy("lang").orderBy("at", "id", "hash")
    chosen = (
        keys.withColumn("at", at).join(F.broadcast(sizes), "lang", "left")
        .filter(F.col("n").isNull() | (F.col("at") / float(1 << 53) * F.col("n") <= 2 * FIT_ROWS + 64))
        .withColumn("nth", F.row_number().over(by_hash)).filter(F.col("nth") <= FIT_ROWS).select(*key)
    )
    texts = known.join(F.broadcast(stored(chosen, "language_chosen")), key)
    sample = stored(texts.groupBy(*key).agg(F.min("text").alias("text")).select("id", "text", "lang"), "language_sample")

    def learn(tables):
        x, lang = [], None
        for t in tables:
            lang = t.column("lang")[0].as_py()
            for text in t.column("text").to_pylist():
                counts = ngram_counts(text)
                if counts.any():
                    at, value = vector(counts, idf)
                    row = np.zeros(DIMS, np.float32)
                    row[at] = value
                    x.append(row)
        if not x:
            return pa.table({"lang": pa.array([], pa.string()), "limit": pa.array([], pa.float64()),
                             "centre": pa.array([], pa.list_(pa.float32()))})
        x = np.array(x)
        centres = cluster(x, CENTROIDS)
        cosine = x @ centres.T
        own = np.argmax(cosine, axis=1)
        best = cosine[np.arange(len(x)), own]
        limits = [float(np.quantile(best[own == i], REJECT_QUANTILE)) if (own == i).any() else 1.0
                  for i in range(len(centres))]
        return pa.table({"lang": [lang] * len(centres), "limit": limits,
                         "centre": pa.array(list(centres.astype(np.float32)), pa.list_(pa.float32()))})

    def learn_sorted(table: pa.Table) -> pa.Table:
        return learn([table.sort_by([("id", "ascending"), ("text", "ascending")])])

    rows = (
        sample.groupBy("lang").applyInArrow(learn_sorted, "lang string, limit double, centre array<float>").toPandas()
    )
    rows = rows.sort_values(["lang", "limit"], kind="stable")
    centres = np.array(rows["centre"].tolist(), float).reshape(-1, DIMS)
    return CentroidModel(rows["lang"].tolist(), centres, rows["limit"].to_numpy(float), idf)


def predict_languages(docs: DataFrame, model: CentroidModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, lang_pred, score, rejected) for every row.

    The score is the cosine to the nearest centroid. A text that is farther from it than nearly
    all texts it was made of is marked rejected; the prediction stays for callers that need one.
    Null texts and texts without a letter are `und` with score 0. Rows are judged on their own.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.bool_())],
                [id_col, "lang_pred", "score", "rejected"],
            )

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(
        run, id_schema(docs, id_col, "lang_pred string, score double, rejected boolean")
    )
