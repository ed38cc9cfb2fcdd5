"""Jaro-Winkler similarity on UTF-8 bytes, and keys that bring similar names together."""

from __future__ import annotations

import math
import sys
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# the functions below travel with the query, so workers need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the Jaro-Winkler definition.
PREFIX_MAX = 4
PREFIX_WEIGHT = 0.1
BOOST_FLOOR = 0.7

CHOICES_MAX = 256   # most choices of matching bytes written out as keys for one length


def _padded(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter((len(v) for v in values), np.int64, len(values))
    width = max(int(lengths.max(initial=0)), 1)
    flat = b"".join(v.ljust(width, b"\0") for v in values)
    return np.frombuffer(flat, np.uint8).reshape(len(values), width), lengths


def jaro_winkler(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """Similarity of each pair, worked out for the whole batch one byte position at a time."""
    n = len(left)
    a, la = _padded(left)
    b, lb = _padded(right)
    window = np.maximum(np.maximum(la, lb) // 2 - 1, 0)
    at = np.arange(a.shape[1])
    a_hit = np.zeros(a.shape, bool)
    b_hit = np.zeros(b.shape, bool)
    rows = np.arange(n)
    for j in range(b.shape[1]):
        free = (
            (a == b[:, j : j + 1])
            & ~a_hit
            & (at >= (j - window)[:, None])
            & (at <= (j + window)[:, None])
            & (at < la[:, None])
            & (j < lb)[:, None]
        )
        found = free.any(axis=1)
        first = free.argmax(axis=1)
        a_hit[rows[found], first[found]] = True
        b_hit[found, j] = True
    m = a_hit.sum(axis=1)
    # the matched bytes of both sides, in order, line up position by position
    a_rank = np.where(a_hit, np.cumsum(a_hit, axis=1) - 1, -1)
    b_rank = np.where(b_hit, np.cumsum(b_hit, axis=1) - 1, -1)
    out_of_place = np.zeros(n, np.int64)
    for k in range(int(m.max(initial=0))):
        used = m > k
        ai = (a_rank == k).argmax(axis=1)
        bi = (b_rank == k).argmax(axis=1)
        out_of_place += used & (a[rows, ai] != b[rows, bi])
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = np.where(m > 0, (m / la + m / lb + (m - out_of_place // 2) / m) / 3.0, 0.0)
    common = np.zeros(n, np.int64)
    still = np.ones(n, bool)
    for k in range(min(PREFIX_MAX, a.shape[1], b.shape[1])):
        still &= (k < la) & (k < lb) & (a[:, k] == b[:, k])
        common += still
    boost = np.flatnonzero((jaro > BOOST_FLOOR) & (common > 0))
    # one rounding for product and sum, so that a pair just at a threshold falls on the right side
    jaro[boost] = [math.fma(PREFIX_WEIGHT * k, 1.0 - v, v) for k, v in zip(common[boost].tolist(), jaro[boost].tolist())]
    return jaro


def _scores(a: pd.Series, b: pd.Series, chunk: int = 4096) -> np.ndarray:
    """NaN where a side is missing. Each distinct pair is compared once per batch.

    Pairs of similar length share a chunk, so that padding stays small.
    """
    pairs = list(zip(a, b))
    distinct = {p for p in pairs if isinstance(p[0], str) and isinstance(p[1], str)}
    known: dict = {}
    ordered = sorted(((x.encode(), y.encode(), (x, y)) for x, y in distinct), key=lambda p: max(len(p[0]), len(p[1])))
    for start in range(0, len(ordered), chunk):
        part = ordered[start : start + chunk]
        values = jaro_winkler([p[0] for p in part], [p[1] for p in part])
        known.update(zip((p[2] for p in part), values))
    return np.array([known.get(p, np.nan) for p in pairs], dtype=float)


@F.pandas_udf(T.DoubleType())
def jaro_winkler_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(_scores(a, b))


def needed_jaro(threshold: float, common: int) -> float:
    """Least Jaro value that can reach the threshold with `common` equal leading bytes."""
    return max((threshold - PREFIX_WEIGHT * common) / (1 - PREFIX_WEIGHT * common), BOOST_FLOOR)


def needed_matches(threshold: float, common: int, x: int, y: int) -> int:
    """Least number of matching bytes for lengths x and y: Jaro <= (m/x + m/y + 1) / 3."""
    per_length = 3 * needed_jaro(threshold, common) - 1
    return max(math.ceil(per_length * x * y / (x + y) - 1e-9), common)


def min_length_ratio(threshold: float) -> float:
    """Shorter length over longer length of any pair that reaches the threshold."""
    return 3 * needed_jaro(threshold, PREFIX_MAX) - 2


def pairing_keys(name: bytes, threshold: float) -> list[str]:
    """Keys of which every pair with similarity >= threshold shares at least one.

    Take a pair with lengths x <= y and exactly p equal leading bytes (at most 4). It needs c
    matching bytes: behind the prefix, the two bags of bytes have c - p bytes in common. So each
    side writes (p, prefix, x, y) with every choice of c - p of its other bytes. Where that is
    too many, the bags are compared in classes instead: they differ in at most d = x + y - 2c
    places, a difference touches one class of byte values, so of d + 1 classes some class holds
    the same bytes on both sides. A name writes one set of keys for every length it could meet.
    """
    n = len(name)
    if n == 0:
        return []
    ratio = min_length_ratio(threshold)
    keys = set()
    for p in range(min(PREFIX_MAX, n) + 1):
        head, rest = name[:p].hex(), sorted(name[p:])
        for other in range(max(math.ceil(n * ratio - 1e-9), p, 1), math.floor(n / ratio + 1e-9) + 1):
            x, y = min(n, other), max(n, other)
            c = needed_matches(threshold, p, x, y)
            if c > x:
                continue
            if math.comb(y - p, c - p) <= CHOICES_MAX:
                keys.update(f"{p}.{head}.{x}.{y}.{bytes(s).hex()}" for s in combinations(rest, c - p))
                continue
            classes = x + y - 2 * c + 1
            split: list[list[int]] = [[] for _ in range(classes)]
            for byte in rest:
                split[byte % classes].append(byte)
            keys.update(f"{p}.{head}.{x}.{y}.{i}.{bytes(s).hex()}" for i, s in enumerate(split))
    return sorted(keys)


def pairing_keys_udf(threshold: float):
    @F.pandas_udf(T.ArrayType(T.StringType()))
    def keys(names: pd.Series) -> pd.Series:
        return names.map(lambda v: pairing_keys(v.encode(), threshold) if isinstance(v, str) else None)

    return keys


def common_prefix(a: Column, b: Column) -> Column:
    """Equal leading bytes of two texts, at most 4."""
    x, y = F.encode(a, "UTF-8"), F.encode(b, "UTF-8")
    length = F.lit(0)
    shorter = F.least(F.octet_length(a), F.octet_length(b))
    for k in range(1, PREFIX_MAX + 1):
        length = F.when((shorter >= k) & (F.substring(x, 1, k) == F.substring(y, 1, k)), k).otherwise(length)
    return length
