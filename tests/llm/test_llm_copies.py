"""SimHash, repeated strings and benchmark overlaps against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from llm_cases import docs_of, documents, empty_docs, odd_docs, odd_rows

from conftest import SMALL, rows
from rosterforge.config import Config
from rosterforge.llm import decontaminate as dc
from rosterforge.llm import simhash as sh
from rosterforge.llm import substrings as sb
from rosterforge.llm.components import connected_components
from rosterforge.llm.queries import QUERIES


def plain_fingerprint(text: str | None) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints: list[int], ids: list) -> list:
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 2:
            parent[root(j)] = root(i)
    best: dict = {}
    for i, own in enumerate(ids):
        if own is not None:
            best[root(i)] = min(best.get(root(i), own), own)
    return [best.get(root(i)) for i in range(len(ids))]


def test_simhash_query_equals_brute_force(spark):
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op7_simhash_dedup"](spark, SMALL).collect()}
    given = documents(SMALL)
    prints = [plain_fingerprint(t) for _, t, _ in given]
    parts = plain_components(prints, [i for i, _, _ in given])
    assert got == {i: (f"{p:016x}", c) for (i, _, _), p, c in zip(given, prints, parts)}
    assert len(set(parts)) < len(parts)


def test_simhash_bears_odd_rows(spark, monkeypatch):
    monkeypatch.setattr("rosterforge.llm.common.PIECE", 1000)
    got = sh.simhash_components(odd_docs(spark))
    prints = [plain_fingerprint(r[1]) for r in odd_rows()]
    want = plain_components(prints, [r[0] for r in odd_rows()])
    assert rows(got) == sorted(
        ((r[0], np.uint64(p).astype(np.int64).item(), c) for r, p, c in zip(odd_rows(), prints, want)), key=repr
    )
    assert sh.simhash_components(empty_docs(spark)).count() == 0


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_bit_sliced_links_connect_what_brute_force_connects(spark, monkeypatch, radius):
    """Chains of close fingerprints, one bucket far larger than a block, and fingerprints at random."""
    monkeypatch.setattr(sh, "BLOCK", 40)
    rng = random.Random(radius)
    prints = [rng.getrandbits(64) for _ in range(150)]
    walk = rng.getrandbits(64)
    for _ in range(200):
        walk ^= 1 << rng.randrange(12)
        prints.append(walk ^ (1 << rng.randrange(64) if rng.random() < 0.3 else 0))
    prints = sorted(set(prints))
    frame = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in prints], "fp bigint")
    links = [(r["a"] % 2**64, r["b"] % 2**64) for r in sh.fingerprint_links(frame, radius).collect()]
    assert len(links) < 7 * len(prints)
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a, b in links:
        parent[root(a)] = root(b)
    want = {p: p for p in prints}

    def wanted(p):
        while want[p] != p:
            p = want[p]
        return p

    for a, b in combinations(prints, 2):
        if (a ^ b).bit_count() <= radius:
            want[wanted(a)] = wanted(b)
    assert all((root(a) == root(b)) == (wanted(a) == wanted(b)) for a, b in combinations(prints, 2))


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, 500 + i) for i in range(1, 80)] + [(7, 7), (9, None), (2, 1)]
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in connected_components(frame, "a", "b").collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{500 + i: 500 for i in range(80)}, 1: 1, 2: 1}
    assert connected_components(frame.filter("a < 0"), "a", "b").count() == 0


# repeated strings ----------------------------------------------------------------------------

def plain_repeats(given: list[tuple]) -> list[tuple]:
    """(id, bytes, removed, spans, digest of the rest) by remembering every string."""
    def place(i):
        doc, text = given[i]
        return (doc is None, doc or 0, hashlib.sha256((text or "").encode()).hexdigest(), i)

    seen, out = set(), []
    for i in sorted(range(len(given)), key=place):
        doc, text = given[i]
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - 99):
            if data[p : p + 100] in seen:
                gone[p : p + 100] = True
            seen.add(data[p : p + 100])
        edges = np.diff(np.r_[0, gone.astype(int)])
        kept = hashlib.sha256(bytes(np.frombuffer(data, np.uint8)[~gone])).hexdigest()
        out.append((doc, len(data), int(gone.sum()), int((edges == 1).sum()), kept))
    return sorted(out, key=repr)


def passages(rng: random.Random) -> list[tuple]:
    def words(n):
        return " ".join("".join(rng.choice("abcdeé ") for _ in range(rng.randint(1, 9))) for _ in range(n))

    shared = [words(rng.randint(15, 60)) for _ in range(5)]
    given = []
    for i in range(60):
        text = words(rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            text += rng.choice(shared)[rng.randint(0, 20) :] + words(rng.randint(0, 10))
        given.append((i, text))
    given += [(200, given[3][1]), (201, given[3][1]), (201, given[3][1]), (150, "a" * 500), (151, "ab" * 300)]
    given += [(152, "a" * 99), (153, "a" * 100), (154, None), (155, ""), (None, given[5][1] + "x")]
    given += [(160, given[8][1]), (160, given[8][1][:-3]), (160, "z" * 130 + given[9][1]), (162, ("abc" * 50 + "X") * 5)]
    given += [(161, given[9][1][:130] + "Q" + given[9][1][130:]), (None, given[7][1][50:])]
    return given


def test_rows_of_a_class_leave_a_task_once():
    texts = [b"x" * 3 + b"the same long line in many texts " * 8 + bytes([65 + i]) * 120 for i in range(20)]
    chunks = [sb._anchor_rows([(i, 0, t)]) for i, t in enumerate(texts)]
    rows_ = sb._combine(chunks, 7)
    keys = list(zip(rows_["h"][~rows_["local"]], rows_["cls"][~rows_["local"]]))
    assert len(keys) == len(set(keys)) and rows_["local"].sum() > 50
    assert set(range(1, 20)) <= set(rows_["doc"][rows_["local"]])      # the first text leads


def test_repeats_equal_brute_force(spark):
    given = passages(random.Random(5))
    frame = spark.createDataFrame(given, "doc_id bigint, text string").repartition(3)
    got = [tuple(r)[:5] for r in sb.remove_repeats(frame).collect()]
    assert sorted(got, key=repr) == plain_repeats(given)


def surrounded(rng: random.Random, n: int) -> list[tuple]:
    """One line of 85 bytes and the ends of one long passage, in ever different surroundings."""
    def noise(k):
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(k))

    line, passage = noise(85), noise(400)
    return [(i, noise(150) + line + noise(150) + passage + noise(120)) for i in range(n)]


def test_a_line_in_many_surroundings_is_dealt_to_many_parts():
    texts = [t.encode() for _, t in surrounded(random.Random(3), 300)]
    found = sb._combine([sb._anchor_rows([(i, 0, t)]) for i, t in enumerate(texts)], 40)
    assert np.bincount(found["part"][~found["local"]], minlength=40).max() < 250


def test_no_group_holds_a_context_of_every_text(spark, monkeypatch):
    """The line's contexts leave their tasks as strings; the few that stay contexts follow."""
    for name, value in (("HOT_CLASSES", 4), ("HOT_CONTEXTS", 4), ("KEY_ROWS", 300), ("TASK_ROWS", 2000)):
        monkeypatch.setattr(sb, name, value, raising=False)
    plain = sb.repeated_starts

    def guarded(key, *rest):
        assert not len(key) or np.unique(key, return_counts=True)[1].max() < 150
        return plain(key, *rest)

    monkeypatch.setattr(sb, "repeated_starts", guarded)
    given = surrounded(random.Random(3), 300) + passages(random.Random(6))
    frame = spark.createDataFrame([(i if i is None else i + 7, t) for i, t in given], "doc_id bigint, text string")
    got = [tuple(r)[:5] for r in sb.remove_repeats(frame.repartition(3)).collect()]
    assert sorted(got, key=repr) == plain_repeats([(i if i is None else i + 7, t) for i, t in given])


@pytest.mark.parametrize("digits, bits", [(5, 11), (1, 8)])
def test_a_third_of_the_rows_share_an_id_and_a_third_have_none(spark, monkeypatch, digits, bits):
    """Each text meets its own rows, whether few or many texts of an id are dealt together."""
    monkeypatch.setattr(sb, "SALT_DIGITS", digits)
    monkeypatch.setattr(sb, "RANK_BITS", bits)
    given = passages(random.Random(11)) + passages(random.Random(12)) + surrounded(random.Random(4), 60)
    given = [((None, 7, i)[i % 3], text) for i, (_, text) in enumerate(given)]
    frame = spark.createDataFrame(given, "doc_id bigint, text string").repartition(3)
    assert sorted((tuple(r)[:5] for r in sb.remove_repeats(frame).collect()), key=repr) == plain_repeats(given)


def test_more_texts_of_an_id_than_can_be_numbered_stop_the_query(spark, monkeypatch):
    monkeypatch.setattr(sb, "SALT_DIGITS", 1)
    monkeypatch.setattr(sb, "RANK_BITS", 1)
    frame = spark.createDataFrame([(None, f"text {i}") for i in range(80)], "doc_id bigint, text string")
    with pytest.raises(Exception, match="more texts than can be numbered"):
        sb.remove_repeats(frame).collect()


@pytest.mark.parametrize("hot", [1, 2, 3])
def test_strings_dealt_one_by_one_equal_brute_force(spark, monkeypatch, hot):
    for name, value in (("HOT_CLASSES", hot), ("HOT_CONTEXTS", hot), ("KEY_ROWS", 40), ("TASK_ROWS", 60)):
        monkeypatch.setattr(sb, name, value, raising=False)
    given = passages(random.Random(hot))
    frame = spark.createDataFrame(given, "doc_id bigint, text string").repartition(3)
    assert sorted((tuple(r)[:5] for r in sb.remove_repeats(frame).collect()), key=repr) == plain_repeats(given)


def test_repeats_query_equals_brute_force(spark):
    got = QUERIES["op8_repeated_substrings"](spark, SMALL)
    want = plain_repeats([(i, t) for i, t, _ in documents(SMALL)])
    assert rows(got.drop("spans")) == want and any(r[2] for r in want)


def test_repeats_bear_odd_rows(spark):
    got = sb.remove_repeats(odd_docs(spark))
    assert sorted((tuple(r)[:5] for r in got.collect()), key=repr) == plain_repeats([r[:2] for r in odd_rows()])
    assert sb.remove_repeats(empty_docs(spark)).count() == 0


@pytest.mark.parametrize("chunk", [150, 400, 1 << 20])
def test_every_start_has_one_anchor_whatever_the_chunk(monkeypatch, chunk):
    """Texts that are cut between chunks lose no string start, also in periodic text."""
    monkeypatch.setattr(sb, "CHUNK", chunk)
    rng = random.Random(1)
    texts = [bytes(rng.choice(b"abc ") for _ in range(n)) for n in (0, 99, 100, 700, 1300)] + [b"a" * 900, b"xyz" * 300]
    seen = []
    for pieces in sb._chunks((i, 0, t) for i, t in enumerate(texts)):
        found = sb._anchor_rows(pieces)
        for doc, lo, last in zip(found["doc"], found["lo"], found["last"]):
            seen += [(int(doc), int(s)) for s in range(lo, lo + last + 1)]
    assert sorted(seen) == [(i, s) for i, t in enumerate(texts) for s in range(len(t) - 99)]


def test_suffixes_are_sorted_by_hash_comparison():
    rng = random.Random(2)
    data = np.frombuffer(bytes(rng.choice(b"ab") for _ in range(600)) * 2 + b"ab" * 200, np.uint8)
    start = np.array(rng.sample(range(len(data) - 100), 300))
    group = np.sort(np.array([rng.randrange(4) for _ in start]))
    suffixes = sb.Suffixes(data)
    order = suffixes.sort(start, group)
    for g in range(4):
        mine = np.flatnonzero(group == g)
        want = sorted(mine, key=lambda i: bytes(data[start[i] : start[i] + 100]))
        assert [start[i] for i in order[mine]] == [start[i] for i in want]


# benchmark overlaps --------------------------------------------------------------------------

def test_seed_masks_catch_every_allowed_window():
    for window in range(dc.LEAST_WORDS, dc.WINDOW + 1):
        masks = dc.seed_masks(window)
        for wrong in combinations(range(window), dc.substitutions(window)):
            assert any(
                not {at + i for i in mask} & set(wrong) for mask in masks for at in range(window - mask[-1])
            )


def plain_overlaps(docs, items) -> set:
    def split(text):
        spaced = "".join(f" {c} " if dc.UNSPACED.match(c) else c for c in text or "")
        return [w for w in (raw.strip(dc.PUNCTUATION) for raw in spaced.lower().split()) if w]

    found = set()
    for item_id, item_text in items:
        item = split(item_text)
        n = min(len(item), dc.WINDOW)
        if n < dc.LEAST_WORDS:
            continue
        for doc_id, text in docs:
            words = split(text)
            if any(
                sum(a == b for a, b in zip(item[i : i + n], words[j : j + n])) >= n - dc.substitutions(n)
                for i in range(len(item) - n + 1) for j in range(len(words) - n + 1)
            ):
                found.add((doc_id, item_id))
    return found


@pytest.mark.parametrize("cut", [False, True])
def test_overlaps_equal_brute_force(spark, monkeypatch, cut):
    if cut:  # nearly all bits are set, texts are hashed and verified in many steps, seeds are hot
        monkeypatch.setattr(dc, "LEAST_BITS", 8)
        monkeypatch.setattr(dc, "MOST_BITS", 8)
        monkeypatch.setattr(dc, "SEEDS_AT_ONCE", 7)
        monkeypatch.setattr(dc, "STEP_CANDIDATES", 3)
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(n))) for i, n in enumerate([3, 5, 6, 9, 12, 13, 20, 40])]
    items += [(20, None), (21, ""), (None, items[5][1]), (7, items[7][1])]
    docs = []
    for i in range(80):
        item = rng.choice([t for _, t in items if t]).split()
        part = item[rng.randint(0, 3) : len(item) - rng.randint(0, 3)]
        for _ in range(rng.randint(0, 3)):
            if part:
                part[rng.randrange(len(part))] = "changed"
        around = [rng.choice(vocabulary) for _ in range(rng.randint(0, 30))]
        docs.append((i, " ".join(around + [w.upper() + "," for w in part] + around[::-1])))
    docs += [(100, None), (101, ""), (5, items[6][1]), (None, items[6][1])]
    # unspaced script, an item under two ids, and many copies of one text
    chinese = "机器学习模型在大规模语料上训练时需要去除与测试集重复的段落。"
    items += [(30, chinese), (31, chinese), (32, "ありがとう")]
    docs += [(110, f"前文 {chinese[:20]} 后文"), (111, chinese[5:]), (112, "全然違う文章です、ありがとうございます。")]
    docs += [(200 + i, "copy " + items[4][1]) for i in range(40)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = dc.contaminated(frame, bench, cfg=Config(hot_key_rows=5, salts=3) if cut else None)
    want = plain_overlaps(docs, items)
    got = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    assert got == want and len(want) > 20 and {(110, 30), (111, 31), (112, 32)} < got and any(i is None for _, i in got)
    assert dc.contaminated(frame, bench.filter("item_id < 0")).count() == 0
    assert dc.contaminated(empty_docs(spark), bench).count() == 0


def test_overlaps_query_finds_the_planted_items(spark):
    import duckdb

    items = duckdb.connect().execute(f"select item_id, text from read_parquet('{SMALL}/benchmark.parquet')").fetchall()
    docs = [(i, t) for i, t, _ in documents(SMALL)]
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op9_decontaminate"](spark, SMALL).collect()}
    assert got >= {(d, i) for d, t in docs for i, item in items if item in t} and got
    small = [x for x in items if x[0] < 6]
    assert {x for x in got if x[1] < 6} == plain_overlaps(docs, small)


def test_a_window_across_two_pieces_is_found(spark, monkeypatch):
    item = " ".join(f"word{i}" for i in range(20))
    words = dc.WordHashes()
    assert dc.overlap(words.read(item), words.read("other " * 50 + item), 50) == (13, 20, 13)
    long = "other words here " * 300_000 + item + " other words" * 10
    assert len(long) > 4 << 20
    found = dc.contaminated(docs_of(spark, [long]), spark.createDataFrame([(1, item)], "item_id bigint, text string"))
    assert [tuple(r)[:2] for r in found.collect()] == [(0, 1)]
