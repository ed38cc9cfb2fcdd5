"""Personal data: fixed patterns, and a character BiLSTM-CRF trained on the spans they label."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterforge.llm.common import id_schema, small_batches, smallest_by_hash
from rosterforge.sources.staging import stored

# The base patterns. They start where the written-out patterns can start, so that a
# long run of one character is not tried again from each of its places.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ("email", "ip", "card", "phone")
ALL_KINDS = (*KINDS, *(f"model_{k}" for k in KINDS))
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_NON_DIGIT = re.compile(r"[^0-9]")
_TRIGGER = re.compile(r"[0-9@]")
_TRIGGER_BYTES = re.compile(rb"[0-9@]")

# The network and its training.
FIT_WINDOWS = 1_200        # most labelled windows, about half of them with a span
WINDOW, STRIDE = 64, 32    # characters of a window and between window starts
EMBED, HIDDEN = 10, 14
ROUNDS, LEARNING_RATE, BATCH = 14, 0.02, 48
DECODE_BATCH = 1_024       # windows that are decoded together
REGION_CHARS = 1 << 17     # characters of regions that are scored and decoded together; longer ones in blocks
CONFIDENCE = 0.9           # least mean probability of an added span
N_TAGS = 1 + 2 * len(KINDS)  # outside, and beginning and inside of each kind
_SYMBOLS = " \n@.+-()_%:/,;=#'\""
N_SYMBOLS = 26 + 2 + len(_SYMBOLS) + 2


def _symbol_table() -> np.ndarray:
    table = np.full(128, 0, np.int64)
    for i in range(26):
        table[65 + i] = table[97 + i] = 1 + i
    table[48:58] = 27
    for i, c in enumerate(_SYMBOLS):
        table[ord(c)] = 28 + i
    return table


_TABLE = _symbol_table()
_OTHER = 28 + len(_SYMBOLS)


def symbols(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 128, _TABLE[np.minimum(points, 127)], _OTHER)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, by kind as listed and then start.

    Matches are leftmost and do not overlap inside a kind; a match that fails its test is
    dropped and not tried again from a later place.
    """
    found = [("email", *s) for s in _emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = _NON_DIGIT.sub("", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 9 <= len(_NON_DIGIT.sub("", m[0])) <= 15:
            found.append(("phone", *m.span()))
    return found


def tags_of(length: int, spans: list[tuple[str, int, int]], start: int) -> np.ndarray:
    """Tags of the window that begins at `start`; where spans overlap the first listed wins."""
    tags = np.zeros(length, np.int64)
    for kind, a, b in reversed(spans):
        k = 1 + 2 * KINDS.index(kind)
        tags[max(a - start, 0) : max(b - start, 0)] = k + 1
        if 0 <= a - start < length:
            tags[a - start] = k
    return tags


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class Tagger:
    """Embedding, one LSTM in each direction, and a linear-chain CRF; float32 throughout."""

    p: dict[str, np.ndarray]

    @staticmethod
    def new(seed: int = 3) -> Tagger:
        rng = np.random.default_rng(seed)
        p = {"embed": rng.normal(0, 0.5, (N_SYMBOLS, EMBED))}
        for d in ("f", "b"):
            p[f"x{d}"] = rng.normal(0, 0.3, (EMBED, 4 * HIDDEN))
            p[f"h{d}"] = rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN))
            p[f"c{d}"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
        p["out"] = rng.normal(0, 0.3, (2 * HIDDEN, N_TAGS))
        p["bias"] = np.zeros(N_TAGS)
        p["next"] = np.zeros((N_TAGS, N_TAGS))
        return Tagger({k: v.astype(np.float32) for k, v in p.items()})

    def _lstm(self, x: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        """Hidden states [time, row, unit] in the reading direction of x [time, row, embed]."""
        h = np.zeros((x.shape[1], HIDDEN), np.float32)
        c = np.zeros_like(h)
        inputs = x @ self.p[f"x{d}"] + self.p[f"c{d}"]
        out = np.empty((*x.shape[:2], HIDDEN), np.float32)
        for t in range(len(x)):
            z = inputs[t] + h @ self.p[f"h{d}"]
            gates = _sigmoid(z[:, : 3 * HIDDEN])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            before = c
            c = f * c + i * g
            squashed = np.tanh(c)
            if keep is not None:
                keep.append((h, before, i, f, o, g, squashed))
            h = o * squashed
            out[t] = h
        return out

    def emissions(self, ids: np.ndarray, kept: dict | None = None) -> np.ndarray:
        """Tag scores [row, time, tag] of windows of symbol ids [row, time]."""
        x = self.p["embed"][ids.T]
        keep = {d: [] for d in "fb"} if kept is not None else {"f": None, "b": None}
        both = np.concatenate(
            [self._lstm(x, "f", keep["f"]), self._lstm(x[::-1], "b", keep["b"])[::-1]], axis=2
        )
        if kept is not None:
            kept.update(x=x, both=both, steps=keep)
        return (both @ self.p["out"] + self.p["bias"]).transpose(1, 0, 2)

    def _lstm_back(self, x: np.ndarray, d: str, steps: list, slope: np.ndarray, grad: dict) -> np.ndarray:
        """Gradients of one direction; returns the slope of the inputs."""
        dz_all = np.empty((len(x), x.shape[1], 4 * HIDDEN), np.float32)
        dh_next = np.zeros((x.shape[1], HIDDEN), np.float32)
        dc_next = np.zeros_like(dh_next)
        before = np.stack([s[0] for s in steps])
        for t in reversed(range(len(x))):
            _, c_before, i, f, o, g, squashed = steps[t]
            dh = slope[t] + dh_next
            dc = dc_next + dh * o * (1 - squashed**2)
            dz_all[t] = np.concatenate(
                [dc * g * i * (1 - i), dc * c_before * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g**2)],
                axis=1,
            )
            dh_next = dz_all[t] @ self.p[f"h{d}"].T
            dc_next = dc * f
        flat = dz_all.reshape(-1, 4 * HIDDEN)
        grad[f"x{d}"] = x.reshape(-1, EMBED).T @ flat
        grad[f"h{d}"] = before.reshape(-1, HIDDEN).T @ flat
        grad[f"c{d}"] = flat.sum(axis=0)
        return dz_all @ self.p[f"x{d}"].T

    def loss_and_gradient(self, ids: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the tag sequences under the CRF, and its gradient."""
        kept: dict = {}
        scores = self.emissions(ids, kept).astype(np.float64)
        n, length, _ = scores.shape
        step = self.p["next"].astype(np.float64)
        ahead, back = np.empty_like(scores), np.zeros_like(scores)
        ahead[:, 0] = scores[:, 0]
        for t in range(1, length):
            ahead[:, t] = scores[:, t] + _log_sum(ahead[:, t - 1, :, None] + step, 1)
        for t in reversed(range(length - 1)):
            back[:, t] = _log_sum(step + (scores[:, t + 1] + back[:, t + 1])[:, None, :], 2)
        total = _log_sum(ahead[:, -1], 1)
        row, time = np.arange(n)[:, None], np.arange(length)
        gold = scores[row, time, tags].sum(axis=1) + step[tags[:, :-1], tags[:, 1:]].sum(axis=1)
        slope = np.exp(ahead + back - total[:, None, None])
        slope[row, time, tags] -= 1
        grad = {"next": np.zeros_like(step)}
        for t in range(length - 1):
            joint = ahead[:, t, :, None] + step + (scores[:, t + 1] + back[:, t + 1])[:, None, :] - total[:, None, None]
            grad["next"] += np.exp(joint).sum(axis=0)
        np.add.at(grad["next"], (tags[:, :-1], tags[:, 1:]), -1)
        slope = (slope / n).astype(np.float32).transpose(1, 0, 2)
        grad["next"] /= n
        grad["out"] = np.einsum("tnh,tnk->hk", kept["both"], slope)
        grad["bias"] = slope.sum(axis=(0, 1))
        hidden = slope @ self.p["out"].T
        dx = self._lstm_back(kept["x"], "f", kept["steps"]["f"], hidden[:, :, :HIDDEN], grad)
        dx = dx + self._lstm_back(kept["x"][::-1], "b", kept["steps"]["b"], hidden[::-1, :, HIDDEN:], grad)[::-1]
        grad["embed"] = np.zeros_like(self.p["embed"])
        np.add.at(grad["embed"], ids.T, dx)
        return float((total - gold).mean()), grad

    def train(self, ids: np.ndarray, tags: np.ndarray, rounds: int = ROUNDS, seed: int = 5) -> list[float]:
        """Adam over shuffled batches; returns the mean loss of each round."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        losses, steps = [], 0
        for r in range(rounds):
            order, total = rng.permutation(len(ids)), 0.0
            for at in range(0, len(ids), BATCH):
                some = order[at : at + BATCH]
                loss, grad = self.loss_and_gradient(ids[some], tags[some])
                total += loss * len(some)
                steps += 1
                size = np.sqrt(sum(float((g**2).sum()) for g in grad.values()))
                rate = LEARNING_RATE * (1 - r / (rounds + 1))
                for k, g in grad.items():
                    g = (g * min(1.0, 5.0 / max(size, 1e-9))).astype(np.float32)
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    up = first[k] / (1 - 0.9**steps)
                    self.p[k] -= (rate * up / (np.sqrt(second[k] / (1 - 0.999**steps)) + 1e-8)).astype(np.float32)
            losses.append(total / max(len(ids), 1))
        return losses

    def decode(self, scores: list[np.ndarray]) -> list[np.ndarray]:
        """Best tag sequence of each region of merged scores; regions are decoded side by side."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(scores)
        order = sorted(range(len(scores)), key=lambda i: len(scores[i]))
        step, at = self._allowed(), 0
        while at < len(order):
            # all rows are padded to the longest, the last
            end = at + 1
            while end < len(order) and (end + 1 - at) * len(scores[order[end]]) <= REGION_CHARS:
                end += 1
            some, at = order[at:end], end
            longest = len(scores[some[-1]])
            padded = np.zeros((len(some), longest, N_TAGS), np.float32)
            for r, i in enumerate(some):
                padded[r, : len(scores[i])] = scores[i]
                padded[r, len(scores[i]) :, 1:] = -1e4
            best, came = padded[:, 0].copy(), np.zeros((longest, len(some), N_TAGS), np.int8)
            best[:, 2::2] -= 1e4
            for t in range(1, longest):
                ways = best[:, :, None] + step
                came[t] = ways.argmax(axis=1)
                best = ways.max(axis=1) + padded[:, t]
            path = np.zeros((len(some), longest), np.int64)
            path[:, -1] = best.argmax(axis=1)
            for t in reversed(range(longest - 1)):
                path[:, t] = came[t + 1][np.arange(len(some)), path[:, t + 1]]
            for r, i in enumerate(some):
                out[i] = path[r, : len(scores[i])]
        return out

    def _allowed(self) -> np.ndarray:
        """Transition scores; an inside tag follows only its own kind."""
        step = self.p["next"].copy()
        for k in range(len(KINDS)):
            allowed = [1 + 2 * k, 2 + 2 * k]
            step[[t for t in range(N_TAGS) if t not in allowed], 2 + 2 * k] = -1e4
        return step

    def decode_blocks(self, blocks: Iterator[np.ndarray]) -> np.ndarray:
        """Best tag sequence of one long region, whose merged scores come block by block.

        The best scores are carried from block to block; only back-pointers of a byte are kept.
        """
        step, best, kept = self._allowed(), None, []
        for scores in blocks:
            came = np.zeros((len(scores), N_TAGS), np.int8)
            for t in range(len(scores)):
                if best is None:
                    best = scores[t].copy()
                    best[2::2] -= 1e4
                    continue
                ways = best[:, None] + step
                came[t] = ways.argmax(axis=0)
                best = ways.max(axis=0) + scores[t]
            kept.append(came)
        path = np.zeros(sum(map(len, kept)), np.int8)
        at, tag = len(path), int(best.argmax()) if best is not None else 0
        for came in reversed(kept):
            for t in reversed(range(len(came))):
                at -= 1
                path[at] = tag
                tag = int(came[t, tag])
        return path


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches around digits and @ signs, merged where they meet.

    Every kind of span holds a digit or an @, so text farther than a window from any of them
    cannot hold one; it is never read by the network. Nothing else is left out.
    """
    out: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        a, b = max(0, m.start() - STRIDE), min(len(text), m.start() + STRIDE + 1)
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def model_spans(tagger: Tagger, texts: list[str]) -> list[list[tuple[str, int, int]]]:
    """Spans the network finds in each text, reconciled over overlapping windows.

    Each region is cut into windows that overlap by half. A character's scores are the mean of
    its windows' scores, weighted by its distance from the window's ends, and one Viterbi pass
    over the whole region then decides, so a span may be longer than a window.
    """
    found: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    group: list[tuple[int, int, int]] = []
    size = 0
    for d, text in enumerate(texts):
        for a, b in regions(text):
            if b - a > REGION_CHARS:
                found[d] += _long_region(tagger, text, a, b)
                continue
            if size + b - a > REGION_CHARS:
                _regions_together(tagger, texts, group, found)
                group, size = [], 0
            group.append((d, a, b))
            size += b - a
    _regions_together(tagger, texts, group, found)
    return [sorted(spans, key=lambda s: s[1]) for spans in found]


def _starts(a: int, b: int) -> list[int]:
    """Window starts of a region."""
    starts = list(range(a, max(b - WINDOW, a) + 1, STRIDE))
    if starts[-1] + WINDOW < b:
        starts.append(b - WINDOW)
    return starts


def _merged(
    tagger: Tagger, texts: list[str], places: list[tuple[int, int, int]], jobs: Iterable[tuple[int, int, int]]
) -> list[np.ndarray]:
    """Merged scores of stretches (text, a, b) from windows (stretch, start, end of the region)."""
    weight = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(np.float32)[:, None]
    sums = [np.zeros((b - a, N_TAGS), np.float32) for _, a, b in places]
    mass = [np.zeros((b - a, 1), np.float32) for _, a, b in places]
    jobs = list(jobs)
    for at in range(0, len(jobs), DECODE_BATCH):
        some = jobs[at : at + DECODE_BATCH]
        ids = np.full((len(some), WINDOW), 29, np.int64)  # padded with line ends
        for i, (r, s, limit) in enumerate(some):
            part = symbols(texts[places[r][0]][s : min(s + WINDOW, limit)])
            ids[i, : len(part)] = part
        scores = tagger.emissions(ids)
        for i, (r, s, limit) in enumerate(some):
            _, a, b = places[r]
            low, high = max(s, a), min(s + WINDOW, limit, b)
            sums[r][low - a : high - a] += scores[i, low - s : high - s] * weight[low - s : high - s]
            mass[r][low - a : high - a] += weight[low - s : high - s]
    return [x / np.maximum(w, 1) for x, w in zip(sums, mass)]


def _chance(scores: np.ndarray, tags: np.ndarray) -> np.ndarray:
    chance = np.exp(scores - scores.max(axis=1, keepdims=True))
    return (chance / chance.sum(axis=1, keepdims=True))[np.arange(len(tags)), tags]


def _spans_of(text: str, a: int, tags: np.ndarray, chance: np.ndarray) -> list[tuple[str, int, int]]:
    out, kind = [], (tags + 1) // 2
    for s in np.flatnonzero((tags > 0) & ((tags % 2 == 1) | (np.r_[0, kind[:-1]] != kind))):
        e = s + 1
        while e < len(tags) and tags[e] == 2 * kind[s]:
            e += 1
        if chance[s:e].mean() >= CONFIDENCE and _TRIGGER.search(text, a + int(s), a + int(e)):
            out.append((KINDS[kind[s] - 1], a + int(s), a + int(e)))
    return out


def _regions_together(tagger: Tagger, texts: list[str], places: list[tuple[int, int, int]], found: list[list]) -> None:
    merged = _merged(tagger, texts, places, [(r, s, b) for r, (_, a, b) in enumerate(places) for s in _starts(a, b)])
    for (d, a, _), tags, scores in zip(places, tagger.decode(merged), merged):
        if tags.any():
            found[d] += _spans_of(texts[d], a, tags, _chance(scores, tags))


def _long_region(tagger: Tagger, text: str, a: int, b: int) -> list[tuple[str, int, int]]:
    """Spans of a region that is scored block by block; only tags, back-pointers and chances are held whole."""
    starts = np.array(_starts(a, b))
    blocks = [(low, min(low + REGION_CHARS, b)) for low in range(a, b, REGION_CHARS)]

    def scores(low: int, high: int) -> np.ndarray:
        mine = starts[np.searchsorted(starts, low - WINDOW, "right") : np.searchsorted(starts, high)]
        return _merged(tagger, [text], [(0, low, high)], [(0, int(s), b) for s in mine])[0]

    tags = tagger.decode_blocks(scores(*block) for block in blocks)
    chance = np.zeros(len(tags), np.float32)
    for low, high in blocks:
        own = tags[low - a : high - a]
        if own.any():
            chance[low - a : high - a] = _chance(scores(low, high), own)
    return _spans_of(text, a, tags, chance)


def fit_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Tagger | None:
    """Train the tagger on windows around base spans and around other digits.

    Windows are cut in Spark from every document; the FIT_WINDOWS / 2 of each sort with the
    smallest hash reach the driver. None where no document holds a span.
    """
    small_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[str, list, bool]] = []
            for data in batch.column(0).cast(pa.binary()).to_pylist():
                if not data or not _TRIGGER_BYTES.search(data):
                    continue
                text = data.decode("utf-8", "replace")
                spans, seen = base_spans(text), set()
                places = [(a + b) // 2 for _, a, b in spans]
                for m in _TRIGGER.finditer(text):
                    near = m.start() // WINDOW
                    if near not in seen:
                        seen.add(near)
                        places.append(m.start())
                for p in places:
                    # the place moves inside the window with the text, not with its position
                    start = max(0, p - WINDOW // 4 - hash_place(text[max(0, p - 8) : p + 8]))
                    window = text[start : start + WINDOW].ljust(WINDOW, "\n")
                    tags = tags_of(WINDOW, spans, start)
                    rows.append((window, tags.tolist(), bool(tags.any())))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.list_(pa.int32())),
                 pa.array([r[2] for r in rows], pa.bool_())],
                ["window", "tags", "held"],
            )

    windows = docs.select(F.col(text_col).cast("string")).mapInArrow(
        cut, "window string, tags array<int>, held boolean"
    )
    # equal windows count once
    once = stored(windows.distinct(), "windows")
    by_hash = smallest_by_hash(once, FIT_WINDOWS // 2, F.xxhash64("window"), "window", group="held").collect()
    by_hash = sorted({(r["window"], tuple(r["tags"])) for r in by_hash})
    if not any(any(tags) for _, tags in by_hash):
        return None
    tagger = Tagger.new()
    tagger.train(np.stack([symbols(w) for w, _ in by_hash]), np.array([t for _, t in by_hash]))
    return tagger


def hash_place(around: str) -> int:
    """A shift of 0 to half a window that depends on the characters around a place."""
    return int.from_bytes(hashlib.blake2b(around.encode("utf-8", "replace"), digest_size=2).digest(), "big") % (WINDOW // 2)


def all_spans(texts: list[str], tagger: Tagger | None) -> list[tuple[list, list]]:
    """Base spans, and those of the network that touch none of them, for each text."""
    base = [base_spans(t) if _TRIGGER.search(t) else [] for t in texts]
    extra = model_spans(tagger, texts) if tagger else [[] for _ in texts]
    out = []
    for own, more in zip(base, extra):
        ends = [(a, b) for _, a, b in own]
        new = [(f"model_{k}", a, b) for k, a, b in more if not any(a < e and s < b for s, e in ends)]
        out.append((own, sorted(new, key=lambda s: (ALL_KINDS.index(s[0]), s[1]))))
    return out


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span, or run of overlapping spans, replaced by the name of its first kind."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.removeprefix('model_').upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def find_pii(docs: DataFrame, tagger: Tagger | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_model, redacted) for every row.

    Whole texts are read; a null text has no spans and stays null. Offsets count code points.
    Rows are judged on their own, so repeated ids stay repeated.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(1).cast(pa.binary()).to_pylist()
            # only texts with a digit or an @ are decoded; the others hold nothing
            at = [i for i, data in enumerate(raw) if data and _TRIGGER_BYTES.search(data)]
            texts = [raw[i].decode("utf-8", "replace") for i in at]
            found = dict(zip(at, zip(texts, all_spans(texts, tagger))))
            empty = ("", ([], []))
            rows = [found.get(i, empty) for i in range(len(raw))]
            base = [r[1][0] for r in rows]
            counts = [pa.array([sum(k == kind for k, _, _ in b) for b in base], pa.int64()) for kind in KINDS]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts,
                 pa.array([hashlib.sha256(_joined(b).encode()).hexdigest() for b in base], pa.string()),
                 pa.array([_joined([*b, *m]) for _, (b, m) in rows], pa.string()),
                 pa.array([len(m) for _, (_, m) in rows], pa.int64()),
                 pa.array([redact(t, [*b, *m]).encode() if b or m else raw[i] for i, (t, (b, m)) in enumerate(rows)],
                          pa.binary()).cast(pa.string())],
                [id_col, *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_model", "redacted"],
            )

    counted = ", ".join(f"n_{k} bigint" for k in KINDS)
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(
        run, id_schema(docs, id_col, f"{counted}, base_sha256 string, spans string, n_model bigint, redacted string")
    )
