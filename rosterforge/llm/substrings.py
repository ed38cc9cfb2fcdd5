"""Removal of repeated byte strings, by hash-compared suffix sorting inside exact candidate groups."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rosterforge.llm.common import parts_for, small_batches
from rosterforge.sources.staging import scratch_path, stored

LENGTH = 100               # bytes of a string that counts as repeated
GRAM = 32                  # bytes of the strings that anchors are chosen by
CHUNK = 256 << 10          # bytes hashed at once
TASK_ROWS = 1 << 18        # anchor rows a task compares among themselves before they are dealt
PART_ROWS = 150_000        # anchor rows settled together
FINE_ROWS = 40_000         # context rows of one task
BUCKET_BYTES = 64 << 20    # most text of one bucket of the working copy, about
BLOCK = 23                 # string starts before an anchor that are compared in one group
HOT_CLASSES = 8            # classes of one anchor hash among TASK_ROWS rows from which they are dealt one by one
KEY_ROWS = 1 << 16         # contexts of a task whose keys are counted together
HOT_CONTEXTS = 32          # contexts of one key among KEY_ROWS from which its strings are dealt one by one
STRING_ROWS = 400_000      # single strings settled together
WINDOW = LENGTH - GRAM + 1
NO_ID = (1 << 63) - 1      # a missing id comes last
SALT_DIGITS = 5            # hexadecimal digits of a text's digest that its rows are dealt by beside the id
RANK_BITS = 11             # texts of one id whose digests begin alike are told apart by this many bits
PLACE_BITS = 32            # bytes of a text are counted below this
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd, so that they can be divided out again


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and its inverse modulo 2 ** 64."""
    inverse = pow(base, -1, 1 << 64)
    out = []
    for b in (base, inverse):
        factors = np.full(n, np.uint64(b), np.uint64)
        factors[0] = 1
        out.append(np.cumprod(factors, dtype=np.uint64))
    return out[0], out[1]


class PrefixHash:
    """Polynomial hashes of all prefixes of a byte string; any substring's hash in constant time."""

    _tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, data: np.ndarray, which: int = 0) -> None:
        n = len(data) + 1
        if which not in self._tables or len(self._tables[which][0]) < n:
            self._tables[which] = _powers(_BASES[which], max(n, CHUNK + 4 * LENGTH))
        power, self.inverse = self._tables[which]
        self.sums = np.zeros(n, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: n - 1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.inverse[start]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _sliding(x: np.ndarray, n: int, pick) -> np.ndarray:
    """pick over every n successive values, by doubling."""
    out, size = x, 1
    while 2 * size <= n:
        out, size = pick(out[:-size], out[size:]), 2 * size
    return pick(out[: len(x) - n + 1], out[n - size : n - size + len(x) - n + 1])


def anchors(data: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, lo, hi): the string starts lo..hi whose anchor is the gram at that place.

    The anchor of a string is its leftmost gram with the smallest hash, so equal strings have
    the same anchor at the same distance from their start, whatever stands around them. `valid`
    marks the starts whose whole string belongs to one text.
    """
    none = np.zeros(0, np.int64)
    starts = np.flatnonzero(valid)
    if not len(starts):
        return np.zeros(0, np.uint64), none, none, none
    prefix = PrefixHash(data, 0)
    at = np.arange(len(data) - GRAM + 1)
    grams = _mixed(prefix.of(at, at + GRAM))
    least = _sliding(grams, WINDOW, np.minimum)
    # the grams that are the least of a valid window
    masked = np.zeros(len(grams) + WINDOW - 1, np.uint64)
    masked[WINDOW - 1 : WINDOW - 1 + len(least)] = np.where(valid[: len(least)], least, 0)
    places = np.flatnonzero(grams == _sliding(masked, WINDOW, np.maximum)[: len(grams)])
    value = least[starts]
    new = np.r_[True, (value[1:] != value[:-1]) | (starts[1:] != starts[:-1] + 1)]
    first = starts[new]
    last = starts[np.r_[new[1:], True]]
    names, code = np.unique(grams[places], return_inverse=True)
    width = len(data) + WINDOW + 1
    order = np.argsort(code, kind="stable")
    key, place = code[order] * width + places[order], places[order]
    own = np.searchsorted(names, value[new]) * width
    a = np.searchsorted(key, own + first)
    many = np.searchsorted(key, own + last + WINDOW) - a
    run = np.repeat(np.arange(len(first)), many)
    nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    found = place[np.repeat(a, many) + nth]
    before = np.where(nth > 0, np.r_[0, found[:-1]] + 1, 0)
    lo, hi = np.maximum(first[run], before), np.minimum(last[run], found)
    keep = lo <= hi
    return grams[found[keep]], found[keep], lo[keep], hi[keep]


def _gather(data: np.ndarray, start: np.ndarray, n: int) -> np.ndarray:
    return data[np.minimum(start[:, None] + np.arange(n), len(data) - 1)]


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the substrings of the given lengths at a and b agree byte by byte."""
    out = np.ones(len(a), bool)
    for at in range(0, len(a), 8192):
        some = slice(at, at + 8192)
        most = int(length[some].max())
        differs = _gather(data, a[some], most) != _gather(data, b[some], most)
        out[some] = ~(differs & (np.arange(most) < length[some, None])).any(axis=1)
    return out


def _chunks(rows: Iterator[tuple[int, int, bytes]]) -> Iterator[list[tuple[int, int, bytes]]]:
    """(doc, base, bytes) pieces of about CHUNK bytes; long texts are cut so that no string start is lost."""
    held, size = [], 0
    for doc, base, data in rows:
        for at in range(0, max(len(data) - LENGTH + 1, 0), CHUNK):
            piece = data[at : at + CHUNK + LENGTH - 1]
            held.append((doc, base + at, piece))
            size += len(piece)
            if size >= CHUNK:
                yield held
                held, size = [], 0
    if held:
        yield held


_ROW = "part int, h bigint, cls bigint, doc bigint, lo bigint, place int, last int, local boolean, many boolean"


def _anchor_rows(pieces: list[tuple[int, int, bytes]]) -> dict[str, np.ndarray]:
    """Anchor rows of a chunk. A row whose whole context stands earlier in the chunk is `local`:
    its bytes were compared here, all its starts are repeated, and it need not meet other rows."""
    data = np.frombuffer(b"".join(p for _, _, p in pieces), np.uint8)
    sizes = np.array([len(p) for _, _, p in pieces])
    offset = np.cumsum(sizes) - sizes
    valid = np.zeros(len(data), bool)
    for s, n in zip(offset.tolist(), sizes.tolist()):
        valid[s : s + n - LENGTH + 1] = True
    h, place, lo, hi = anchors(data, valid)
    piece = np.searchsorted(offset, lo, side="right") - 1
    doc = np.array([d for d, _, _ in pieces])[piece]
    start = np.array([b for _, b, _ in pieces])[piece] + lo - offset[piece]
    shape = ((place - lo).astype(np.uint64) << np.uint64(8)) | (hi - lo).astype(np.uint64)
    cls = _mixed(PrefixHash(data, 1).of(lo, hi + LENGTH) ^ (shape * np.uint64(_BASES[0])))
    order = np.lexsort((start, doc, cls, h))
    # a text that a row repeats under the same id is no earlier text
    by = [x[order] for x in (h, cls, doc, start)]
    order = order[np.r_[True, np.any([x[1:] != x[:-1] for x in by], axis=0)][: len(order)]]
    h, cls, doc, start, place, lo, hi = (x[order] for x in (h, cls, doc, start, place, lo, hi))
    new = np.r_[True, (h[1:] != h[:-1]) | (cls[1:] != cls[:-1])][: len(h)]
    lead = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
    local = ~new
    at = np.flatnonzero(local)
    if len(at):
        same = same_bytes(data, lo[at], lo[lead[at]], hi[at] - lo[at] + LENGTH)
        same &= (hi - lo)[at] == (hi - lo)[lead[at]]
        local[at[~same]] = False
        cls[at[~same]] ^= np.uint64(1)  # a collision: another class, which byte comparison will settle
    return {
        "h": h, "cls": cls, "doc": doc, "lo": start, "place": (place - lo).astype(np.int32),
        "last": (hi - lo).astype(np.int32), "local": local,
    }


def _combine(chunks: list[dict[str, np.ndarray]], n_parts: int) -> dict[str, np.ndarray]:
    """Rows of several chunks of a task, with the later rows of a class marked `local` as well.

    So a line that very many texts share leaves a task as one row per TASK_ROWS, not one per text.
    Where an anchor hash has many classes (a shared line in ever different surroundings), its rows
    are marked `many` and dealt by class instead of by hash, since they need not be told that
    there are others; a row with last = -1 tells the hash's remaining rows.
    """
    rows = {k: np.concatenate([c[k] for c in chunks]) for k in chunks[0]}
    order = np.lexsort((rows["lo"], rows["doc"], rows["cls"], rows["h"], rows["local"]))
    rows = {k: v[order] for k, v in rows.items()}
    same = (rows["h"][1:] == rows["h"][:-1]) & (rows["cls"][1:] == rows["cls"][:-1])
    once = ~((rows["doc"][1:] == rows["doc"][:-1]) & (rows["lo"][1:] == rows["lo"][:-1]))
    lead = np.r_[True, ~same][: len(order)]
    rows["local"] = rows["local"] | (~lead & np.r_[True, once][: len(order)])
    open_ = np.flatnonzero(~rows["local"])
    names, code, count = np.unique(rows["h"][open_], return_inverse=True, return_counts=True)
    rows["many"] = np.zeros(len(order), bool)
    rows["many"][open_] = count[code] >= HOT_CLASSES
    told = names[count >= HOT_CLASSES]
    filler = {"h": told, "last": np.full(len(told), -1, np.int32), "many": np.ones(len(told), bool)}
    rows = {k: np.concatenate([v, filler.get(k, np.zeros(len(told), v.dtype))]) for k, v in rows.items()}
    # rows that meet nobody are dealt anywhere
    anywhere = rows["lo"].astype(np.uint64) * np.uint64(_BASES[0]) ^ rows["doc"].astype(np.uint64)
    by_class = rows["h"] ^ _mixed(rows["cls"])
    meets = np.where(rows["many"] & (rows["last"] >= 0), by_class, rows["h"])
    part = _mixed(np.where(rows["local"], anywhere, meets)) % np.uint64(n_parts)
    return {"part": part.astype(np.int32), **rows, "h": rows["h"].view(np.int64), "cls": rows["cls"].view(np.int64)}


def _settle(rows: pd.DataFrame) -> pd.DataFrame:
    """Repeated stretches of starts (fine = false), and rows that must be compared by their bytes.

    Rows of one anchor hash and one context hash are one class: all but its earliest are
    repeated throughout. Where an anchor hash has several classes, their earliest rows may still
    share strings, and go on to the byte comparison. Rows marked `many` have such neighbours in
    any case, in other parts.
    """
    local, told = rows["local"].to_numpy(), rows["last"].to_numpy() < 0
    done, others = rows[local], rows["h"][told].unique()
    rows = rows[~local & ~told].sort_values(["many", "h", "cls", "doc", "lo"], kind="stable")
    many, h, cls, doc, lo = (rows[c].to_numpy() for c in ("many", "h", "cls", "doc", "lo"))
    new_h = np.r_[True, (many[1:] != many[:-1]) | (h[1:] != h[:-1])][: len(h)]
    new = new_h | np.r_[True, cls[1:] != cls[:-1]][: len(h)]
    again = ~new & np.r_[False, (doc[1:] == doc[:-1]) & (lo[1:] == lo[:-1])][: len(h)]  # the same row read twice
    classes = np.bincount(np.cumsum(new_h) - 1, new, new_h.sum())[np.cumsum(new_h) - 1] if len(h) else np.zeros(0)
    repeated, fine = rows[~new & ~again], rows[new & ((classes > 1) | many | np.isin(h, others))]
    out = pd.concat([done, repeated, fine])
    return pd.DataFrame({
        "doc": out["doc"], "lo": out["lo"], "last": out["last"], "place": out["place"],
        "fine": np.r_[np.zeros(len(done) + len(repeated), bool), np.ones(len(fine), bool)],
    })


class Suffixes:
    """Suffixes of a byte buffer, compared over LENGTH bytes by prefix hashes."""

    def __init__(self, data: np.ndarray) -> None:
        self.data, self.prefix = data, PrefixHash(data, 0)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common beginning, at most LENGTH, by binary search over hash equality."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), LENGTH)
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = self.prefix.of(a, a + middle) == self.prefix.of(b, b + middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def before(self, a: np.ndarray, b: np.ndarray, ties: bool) -> np.ndarray:
        """Whether suffix a comes before suffix b; equal ones do where `ties` is set."""
        n = self.common(a, b)
        whole = n == LENGTH
        end = len(self.data) - 1
        return np.where(whole, ties, self.data[np.minimum(a + n, end)] < self.data[np.minimum(b + n, end)])

    def sort(self, start: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Stable merge sort of the suffixes inside each group (groups are runs); returns the order.

        Runs of doubling width are merged for all groups side by side: every suffix finds its
        place in the neighbouring run by binary search, so a merge is log-many comparisons.
        """
        n = len(start)
        head = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if n else np.zeros(0, int)
        size = np.diff(np.r_[head, n])
        base, limit = np.repeat(head, size), np.repeat(head + size, size)
        order, width = np.arange(n), 1
        while width < (size.max() if n else 0):
            slot = np.arange(n)
            active = np.flatnonzero(limit - base > width)
            s, b, e = slot[active], base[active], limit[active]
            run = (s - b) // width
            left = run % 2 == 0
            other = b + (run + np.where(left, 1, -1)) * width
            low, high = np.minimum(other, e), np.minimum(other + width, e)
            first = low.copy()
            mine = start[order[s]]
            while (open_ := np.flatnonzero(low < high)).size:
                middle = (low[open_] + high[open_]) // 2
                theirs = start[order[middle]]
                # a suffix of the left run goes before its equals on the right, one of the right after them
                less = np.where(
                    left[open_], self.before(theirs, mine[open_], False), self.before(theirs, mine[open_], True)
                )
                low[open_] = np.where(less, middle + 1, low[open_])
                high[open_] = np.where(less, high[open_], middle)
            pair = b + (run - run % 2) * width
            target = pair + (s - (b + run * width)) + (low - first)
            merged = order.copy()
            merged[target] = order[s]
            order, width = merged, 2 * width
        return order


def repeated_starts(key: np.ndarray, doc: np.ndarray, lo: np.ndarray, place: np.ndarray, texts: list[bytes]):
    """(doc, start) of the strings in the given contexts that stand earlier in a context of the same key.

    Strings that start equally far before the anchor are suffixes of the contexts; they are
    sorted, and equal neighbours are verified byte by byte. The sort is stable over (doc, start),
    so the first of equal strings is the earliest.
    """
    order = np.lexsort((lo, doc, key))
    key, doc, lo, place = key[order], doc[order], lo[order], place[order]
    head = np.r_[True, key[1:] != key[:-1]][: len(key)]
    groups = np.cumsum(head) - 1
    several = np.bincount(groups)[groups] > 1
    order, key, doc, lo, place = (x[several] for x in (order, key, doc, lo, place))
    if not len(key):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    data = np.frombuffer(b"".join(texts[i] for i in order), np.uint8)
    sizes = np.array([len(texts[i]) for i in order])
    offset = np.cumsum(sizes) - sizes
    count = sizes - LENGTH + 1
    row = np.repeat(np.arange(len(key)), count)
    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    distance = place[row] - step
    by_group = np.lexsort((lo[row] + step, doc[row], distance, key[row]))
    row, step, distance = row[by_group], step[by_group], distance[by_group]
    start = offset[row] + step
    new_group = np.r_[True, (key[row][1:] != key[row][:-1]) | (distance[1:] != distance[:-1])]
    group = np.cumsum(new_group) - 1
    suffixes = Suffixes(data)
    placed = suffixes.sort(start, group)
    here, group, row, step = start[placed], group[placed], row[placed], step[placed]
    equal = np.r_[False, (group[1:] == group[:-1])]
    at = np.flatnonzero(equal)
    equal[at] = suffixes.common(here[at - 1], here[at]) == LENGTH
    lead = np.maximum.accumulate(np.where(equal, 0, np.arange(len(here))))
    at = np.flatnonzero(equal)
    equal[at] = same_bytes(data, here[lead[at]], here[at], np.full(len(at), LENGTH))
    # the same row read twice is no earlier string
    equal &= ~((doc[row] == doc[row[lead]]) & (lo[row] + step == lo[row[lead]] + step[lead]))
    return doc[row[equal]], lo[row[equal]] + step[equal]


def _contexts(doc: int, base: int, data: bytes, rows: list[tuple[int, int, int]], n_parts: int, out: list) -> None:
    """For each (lo, last, place) the parts of its context, keyed by what all strings of a part share.

    Starts are taken in blocks by their distance from the anchor. All strings of a block have at
    least LENGTH - BLOCK + 1 bytes in common, whose hash is the key: only contexts that agree
    there meet.
    """
    for lo, last, place in rows:
        near, far = place - last, place  # distances of the last and first start from the anchor
        for block in range(near // BLOCK, far // BLOCK + 1):
            a, b = block * BLOCK, block * BLOCK + BLOCK - 1
            anchor = lo - base + place
            key = xxhash.xxh64_intdigest(data[anchor - a : anchor - b + LENGTH], block)
            first, end = anchor - min(b, far), anchor - max(a, near) + LENGTH
            out.append((key % n_parts, (key ^ (1 << 63)) - (1 << 63), doc, base + first, anchor - first, data[first:end]))


def _strings(doc: np.ndarray, lo: np.ndarray, texts: list[bytes]) -> dict[str, np.ndarray]:
    """(s, doc, start, again) of every string in the given contexts, s being a 128-bit cryptographic hash.

    Of equal strings all but the earliest are marked `again` and need not meet others.
    """
    count = np.array([len(text) - LENGTH + 1 for text in texts], np.int64)
    names, place = bytearray(16 * int(count.sum())), 0
    for text, n in zip(texts, count.tolist()):
        for at in range(n):
            names[place : place + 16] = hashlib.blake2b(text[at : at + LENGTH], digest_size=16).digest()
            place += 16
    halves = np.frombuffer(bytes(names), np.int64).reshape(-1, 2)
    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return _earliest(halves[:, 0], halves[:, 1], np.repeat(doc, count), np.repeat(lo, count) + step)


def _earliest(s: np.ndarray, t: np.ndarray, doc: np.ndarray, start: np.ndarray) -> dict[str, np.ndarray]:
    """Rows once each, by string and place, with all but the earliest of a string marked `again`."""
    order = np.lexsort((start, doc, t, s))
    s, t, doc, start = (x[order] for x in (s, t, doc, start))
    again = np.r_[False, (s[1:] == s[:-1]) & (t[1:] == t[:-1])][: len(s)]
    # the same row read twice is no earlier string
    once = ~(again & np.r_[False, (doc[1:] == doc[:-1]) & (start[1:] == start[:-1])][: len(s)])
    return {"s": s[once], "t": t[once], "doc": doc[once], "lo": start[once], "again": again[once]}


def _stretches(doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, lo, last) of runs of successive starts."""
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order]
    new = np.r_[True, (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + 1)][: len(doc)]
    ends = np.r_[new[1:], True][: len(doc)]
    return doc[new], start[new], (start[ends] - start[new]).astype(np.int32)


_CONTEXT = "part int, key bigint, doc bigint, lo bigint, place int, context binary, t bigint, kind int"
_COMPARED = "part int, s bigint, t bigint, doc bigint, lo bigint, last int"
_AS_CONTEXT, _AS_STRING, _AS_REPEAT, _TELL = range(4)


def _deal(rows: list[tuple], n_parts: int) -> Iterator[pa.RecordBatch]:
    """Contexts of a task (part, key, doc, lo, place, bytes) as they are, or as single strings.

    Contexts meet by their key. A key that has HOT_CONTEXTS of the given ones or more leaves the
    task as single strings, each once; a row of kind _TELL makes the few contexts of it that
    other tasks send follow as strings. Strings pass the comparison untouched, so they are dealt
    anywhere.
    """
    key = np.array([r[1] for r in rows], np.int64)
    names, code, count = np.unique(key, return_inverse=True, return_counts=True)
    hot = (count >= HOT_CONTEXTS)[code]
    cold = [(*rows[i], 0, _AS_CONTEXT) for i in np.flatnonzero(~hot)]
    at = np.flatnonzero(hot)
    if len(at):
        cold += [(k % (1 << 64) % n_parts, k, 0, 0, 0, None, 0, _TELL) for k in names[count >= HOT_CONTEXTS].tolist()]
        found = _strings(
            np.array([rows[i][2] for i in at]), np.array([rows[i][3] for i in at]), [rows[i][5] for i in at]
        )
        again = found["again"]
        doc, lo, last = _stretches(found["doc"][again], found["lo"][again])
        s, t, own, start = (found[k][~again] for k in ("s", "t", "doc", "lo"))
        for n, columns in (
            (len(doc), (_mixed(lo.astype(np.uint64) ^ _mixed(doc.astype(np.uint64))), np.zeros(len(doc), np.int64), doc,
                        lo, last, np.zeros(len(doc), np.int64), np.full(len(doc), _AS_REPEAT))),
            (len(s), (t.view(np.uint64), s, own, start, np.zeros(len(s), np.int32), t, np.full(len(s), _AS_STRING))),
        ):
            part, key, doc_, lo_, place, t_, kind = columns
            part = (part % np.uint64(n_parts)).astype(np.int32)
            for a in range(0, n, 1 << 16):
                cut = slice(a, a + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[cut]), pa.array(key[cut]), pa.array(doc_[cut]), pa.array(lo_[cut]),
                     pa.array(place[cut], pa.int32()), pa.nulls(len(part[cut]), pa.binary()), pa.array(t_[cut]),
                     pa.array(kind[cut], pa.int32())],
                    _CONTEXT_NAMES,
                )
    for a in range(0, len(cold), 1 << 14):
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*cold[a : a + (1 << 14)]), _CONTEXT_KINDS)], _CONTEXT_NAMES
        )


_CONTEXT_NAMES = ("part", "key", "doc", "lo", "place", "context", "t", "kind")
_CONTEXT_KINDS = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int32())


def _compare(rows: pd.DataFrame, n_parts: int) -> pd.DataFrame:
    """Repeated stretches (part = -1) among contexts of equal keys, and the strings that must meet others."""
    kind = rows["kind"].to_numpy()
    strings, repeats = rows[kind == _AS_STRING], rows[kind == _AS_REPEAT]
    contexts = rows[kind == _AS_CONTEXT]
    told = contexts["key"].isin(rows["key"][kind == _TELL]).to_numpy()
    hot, contexts = contexts[told], contexts[~told]
    doc, lo, last = _stretches(*repeated_starts(
        contexts["key"].to_numpy(), contexts["doc"].to_numpy(), contexts["lo"].to_numpy(),
        contexts["place"].to_numpy(), contexts["context"].tolist(),
    ))
    more = _strings(hot["doc"].to_numpy(), hot["lo"].to_numpy(), hot["context"].tolist())
    again = more["again"]
    also = _stretches(more["doc"][again], more["lo"][again])
    s = np.concatenate([strings["key"].to_numpy(np.int64), more["s"][~again]])
    t = np.concatenate([strings["t"].to_numpy(np.int64), more["t"][~again]])
    n = len(doc) + len(also[0]) + len(repeats)
    none = np.zeros(n, np.int64)
    return pd.DataFrame({
        "part": np.concatenate([none - 1, (_mixed(s.view(np.uint64)) % np.uint64(n_parts)).astype(np.int64)]).astype(np.int32),
        "s": np.concatenate([none, s]), "t": np.concatenate([none, t]),
        "doc": np.concatenate([doc, also[0], repeats["doc"], strings["doc"], more["doc"][~again]]).astype(np.int64),
        "lo": np.concatenate([lo, also[1], repeats["lo"], strings["lo"], more["lo"][~again]]).astype(np.int64),
        "last": np.concatenate([last, also[2], repeats["place"], np.zeros(len(s), np.int32)]).astype(np.int32),
    })


def _settle_strings(rows: pd.DataFrame) -> pd.DataFrame:
    found = _earliest(*(rows[c].to_numpy() for c in ("s", "t", "doc", "lo")))
    doc, lo, last = _stretches(found["doc"][found["again"]], found["lo"][found["again"]])
    return pd.DataFrame({"doc": doc, "lo": lo, "last": last})


def _merge(starts: list[tuple[int, int]], base: int, n: int) -> list[tuple[int, int]]:
    """Stretches (lo, hi) of repeated starts as maximal removed runs inside a text of n bytes."""
    runs: list[list[int]] = []
    for lo, hi in sorted(starts):
        a, b = max(lo - base, 0), min(hi - base + LENGTH, n)
        if b <= 0 or a >= n:
            continue
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b)
        else:
            runs.append([a, b])
    return [(a, b) for a, b in runs]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_bytes, n_removed, n_spans, kept_sha256, spans) per row, spans as `start:end` joined by commas.

    A byte goes if a LENGTH-byte string that covers it also starts earlier: in a document with a
    smaller id, or before in the same one. Null texts are empty; a null id comes after all
    others; rows that repeat an id with other texts follow each other by digest; of equal texts
    all rows but the first are removed whole.

    Texts are shuffled once, into a working copy bucketed by id and the beginning of the digest, which
    all later joins use without moving them. A place is the text's own number among those of its id
    and the byte in it, so whatever is found in a text meets that text alone, however many texts
    repeat an id or have none; more than about 2 ** 31 different texts of one id stop the query. Every string has an anchor, about one in 35 bytes; anchors, not
    positions, are dealt by hash, after each task has settled the repeats it can see itself, so a
    line that is in a third of all texts leaves a task as a few rows. Contexts that are wholly equal
    are settled by their bytes inside a chunk, and beyond it by two independent 64-bit hashes; all
    others by sorted suffixes and their bytes. A line in very many different surroundings has as
    many contexts as it has places: they are dealt as single strings, each once per KEY_ROWS
    contexts of a task, and settled by a 128-bit cryptographic hash.
    """
    spark = docs.sparkSession
    small_batches(spark)
    data = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    raw = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("doc"), data.alias("data"))
    raw = raw.withColumns({"digest": F.sha2("data", 256), "n": F.octet_length("data").cast("bigint")})
    raw = raw.withColumn("salt", _salt())
    total = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    # with fewer buckets than shuffle partitions Spark would deal the texts anew for each join
    n_buckets = max(parts_for(total, BUCKET_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions")))
    name = f"working_copy_{uuid.uuid4().hex}"
    (
        raw.repartition(n_buckets, "doc", "salt").write.bucketBy(n_buckets, "doc", "salt").sortBy("doc", "salt")
        .option("path", scratch_path(spark, "working_copy")).option("compression", "zstd").saveAsTable(name)
    )
    try:
        return _from_copy(spark.table(name), int(total), n_buckets, id_col, docs.schema[id_col].dataType.simpleString())
    finally:
        spark.sql(f"DROP TABLE {name}")  # the name only; the files stay in the shared folder


def _salt() -> Column:
    return F.conv(F.substring("digest", 1, SALT_DIGITS), 16, 10).cast("int")


def _by_text(rows: DataFrame, n_buckets: int, name: str, *columns: str) -> DataFrame:
    """(found_doc, found_salt, found_base, name): the rows of each text in one list, dealt like the working copy."""
    base = F.expr(f"shiftleft(shiftright(lo, {PLACE_BITS}), {PLACE_BITS})")
    salt = F.shiftright("lo", PLACE_BITS + RANK_BITS).cast("int")
    dealt = rows.select(F.col("doc").alias("found_doc"), salt.alias("found_salt"), base.alias("found_base"), *columns)
    # one exchange serves the lists and the join with the texts
    return (
        dealt.repartition(n_buckets, "found_doc", "found_salt").groupBy("found_doc", "found_salt", "found_base")
        .agg(F.collect_list(F.struct(*columns)).alias(name))
    )


#: Joins of texts with what belongs to them. Only id and salt are join keys, by which the working copy is
#: bucketed; the last comparison is written so that Spark does not take it for a key and move the texts.
_OWN_LEAD = "doc = lead_doc AND salt = lead_salt AND instr(digest, lead_digest) = 1"
_OWN_ROWS = "doc = found_doc AND salt = found_salt AND base - found_base = 0"


def _from_copy(copy: DataFrame, total: int, n_buckets: int, id_col: str, id_kind: str) -> DataFrame:
    narrow = stored(copy.select("doc", "digest", "n"), "texts")
    firsts = narrow.groupBy("digest").agg(F.min("doc").alias("doc")).withColumn("salt", _salt())
    # the texts that come first, each with its number among the texts of its id, in the order of their digests
    rank = F.row_number().over(W.partitionBy("doc", "salt").orderBy("digest")).cast("bigint") - 1
    number = F.when(rank < 1 << RANK_BITS, F.shiftleft(F.col("salt").cast("bigint"), RANK_BITS) + rank).otherwise(
        F.raise_error(F.lit("an id has more texts than can be numbered")).cast("bigint")
    )
    leads = stored(
        firsts.select(
            F.col("doc").alias("lead_doc"), F.col("salt").alias("lead_salt"), F.col("digest").alias("lead_digest"),
            F.shiftleft(number, PLACE_BITS).alias("base"),
        ),
        "leads",
    )
    texts = copy.join(leads, F.expr(_OWN_LEAD)).select("doc", "salt", "data", "base")
    n_parts = parts_for(total // 30, PART_ROWS)

    def batches_of(found: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(found["h"]), 1 << 16):
            yield pa.RecordBatch.from_pydict({k: pa.array(v[at : at + (1 << 16)]) for k, v in found.items()})

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[int, int, bytes]]:
            for batch in batches:
                yield from zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(1).to_pylist())

        held, n = [], 0
        for chunk in _chunks(rows()):
            held.append(_anchor_rows(chunk))
            n += len(held[-1]["h"])
            if n >= TASK_ROWS:
                yield from batches_of(_combine(held, n_parts))
                held, n = [], 0
        if held:
            yield from batches_of(_combine(held, n_parts))

    settled = stored(
        texts.select("doc", "data", "base").mapInArrow(scan, _ROW).groupBy("part").applyInPandas(
            _settle, "doc bigint, lo bigint, last int, place int, fine boolean"
        ),
        "settled",
    )
    per_text = _by_text(settled.filter("fine"), n_buckets, "rows", "lo", "last", "place")
    n_fine = settled.filter("fine").count()
    fine_parts = parts_for(2 * n_fine, FINE_ROWS)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list = []
        for batch in batches:
            for doc, data, base, rows in zip(*(batch.column(i).to_pylist() for i in range(4))):
                inside = [(r["lo"], r["last"], r["place"]) for r in rows]
                for at in range(0, len(inside), 1 << 12):
                    _contexts(doc, base, data, inside[at : at + (1 << 12)], fine_parts, out)
                    if len(out) >= KEY_ROWS:
                        yield from _deal(out, fine_parts)
                        out = []
        if out:
            yield from _deal(out, fine_parts)

    contexts = texts.join(per_text, F.expr(_OWN_ROWS)).select("doc", "data", "base", "rows").mapInArrow(cut, _CONTEXT)
    compared = stored(
        contexts.groupBy("part").applyInPandas(lambda rows: _compare(rows, 1 << 30), _COMPARED), "compared"
    )
    strings = compared.filter("part >= 0")
    string_parts = parts_for(strings.count(), STRING_ROWS)
    single = strings.withColumn("part", F.col("part") % string_parts).groupBy("part").applyInPandas(
        _settle_strings, "doc bigint, lo bigint, last int"
    )
    compared = compared.filter("part < 0").select("doc", "lo", "last").unionByName(single)
    starts = settled.filter("NOT fine").select("doc", "lo", "last").unionByName(compared)
    found = _by_text(starts, n_buckets, "starts", "lo", "last")

    nth = F.row_number().over(W.partitionBy("doc", "salt", "digest").orderBy("digest"))
    every = (
        copy.withColumn("nth", nth).join(leads, F.expr(_OWN_LEAD), "left").join(found, F.expr(_OWN_ROWS), "left")
        .select("doc", "digest", "n", "nth", "base", "starts",
                F.when(F.col("starts").isNotNull(), F.col("data")).alias("data"))
    )
    nothing = hashlib.sha256(b"").hexdigest()

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, digest, n, copy_no, base, starts, data in zip(*(c.to_pylist() for c in batch.columns)):
                if (base is None or copy_no > 1) and n >= LENGTH:
                    out.append((doc, n, n, 1, nothing, f"0:{n}"))
                    continue
                own = base is not None and copy_no == 1 and starts
                runs = _merge([(s["lo"], s["lo"] + s["last"]) for s in starts], base, n) if own else []
                if runs:
                    kept, at = hashlib.sha256(), 0
                    for a, b in [*runs, (n, n)]:
                        kept.update(data[at:a])
                        at = b
                    digest = kept.hexdigest()
                out.append((doc, n, sum(b - a for a, b in runs), len(runs), digest,
                            ",".join(f"{a}:{b}" for a, b in runs)))
            kinds = (*[pa.int64()] * 4, *[pa.string()] * 2)
            names = ("doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)], names)

    result = every.mapInArrow(
        finish, "doc bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans string"
    )
    own_id = F.when(F.col("doc") != NO_ID, F.col("doc")).cast(id_kind).alias(id_col)
    return stored(result.select(own_id, "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"), "repeats")
