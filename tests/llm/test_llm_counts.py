"""MinHash links, phrase counts and filter audits against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import combinations, permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import docs_of, documents, empty_docs, odd_docs, odd_rows

from conftest import SMALL, rows
from rosterforge.config import Config
from rosterforge.llm import minhash, phrases, survival
from rosterforge.llm.queries import QUERIES

ODD_LABELS = [(1, 1, 0), (1, 0, 1), (4, 0, 1), (5, None, 1), (None, 1, 1), (77, 1, 1), (7, 1, None)]


# filter audit --------------------------------------------------------------------------------

def plain_failures(given: list[tuple]) -> list[set[str]]:
    """What each (id, text) fails."""
    firsts: dict = {}
    for i, text in given:
        if i is not None:
            firsts[text or ""] = min(firsts.get(text or "", i), i)
    out = []
    for i, text in given:
        text = text or ""
        words = [w for w in "".join(" " if c in " \t\n\v\f\r" else c for c in text).split(" ") if w]
        upper = sum("A" <= c <= "Z" for c in text)
        late = i is not None and i > firsts[text]
        tests = (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * upper > 3 * len(text),
            any(c in "#$%&*|" for c in text), late,
        )
        out.append({f for f, failed in zip("ABCDE", tests) if failed})
    return out


def plain_audit(given: list[tuple], labels: list[tuple]) -> set[tuple]:
    """All 120 orders applied one after the other; given: (id, text, part)."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    fails = plain_failures([(i, t) for i, t, _ in given])
    out, shapley = [], {}
    for part in {p or "" for _, _, p in given}:
        mine = [(i, f) for (i, _, p), f in zip(given, fails) if (p or "") == part]
        for order in permutations("ABCDE"):
            left = mine
            for step, name in enumerate(order, 1):
                gone = [x for x in left if name in x[1]]
                left = [x for x in left if name not in x[1]]
                failing = sum(name in f for _, f in mine)
                shapley[part, name] = shapley.get((part, name), 0) + len(gone)
                out.append((
                    part, "".join(order), step, len(left), len(gone), failing - len(gone),
                    sum(f == {name} for _, f in mine), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone),
                ))
    return {(*r, shapley[r[0], r[1][r[2] - 1]]) for r in out}


def audit(spark, given, labels, **more):
    docs = spark.createDataFrame(given, "doc_id bigint, text string, lang string").repartition(3)
    return survival.filter_audit(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), **more)


def test_audit_bears_odd_rows(spark):
    labels = spark.createDataFrame(ODD_LABELS, "doc_id bigint, quality int, toxic int")
    got = survival.filter_audit(odd_docs(spark), labels.withColumn("part", labels["toxic"]))
    given = [(r[0], r[1], r[2]) for r in odd_rows()]
    assert {tuple(r) for r in got.collect()} == plain_audit(given, ODD_LABELS)
    assert got.count() == 600 * len({p or "" for _, _, p in given})
    assert survival.filter_audit(empty_docs(spark), labels).count() == 0
    none = survival.filter_audit(odd_docs(spark), labels.limit(0))
    assert none.agg({"good_lost": "sum", "toxic_lost": "sum"}).first()[:] == (0, 0)


def test_audit_with_hot_texts_and_hot_ids(spark, monkeypatch):
    """A third of the rows are one text, a third have no id or one id; more parts than a task holds."""
    monkeypatch.setattr(survival, "HELD_PARTS", 3)
    monkeypatch.setattr(survival, "PENDING", 20)
    given = [(i, "One text for many", "en") for i in range(60)]
    given += [(None if i % 2 else 7, f"text {i} " * (1 + i * 9), f"l{i % 9}") for i in range(60)]
    given += [(1000 + i, "word " * (i * 4) + "#" * (i % 2), None) for i in range(60)]
    labels = [(i, i % 2, i % 3 == 0) for i in range(70)]
    labels = [(i, q, int(t)) for i, q, t in labels]
    cfg = Config(hot_key_rows=10, salts=4)
    assert {tuple(r) for r in audit(spark, given, labels, cfg=cfg).collect()} == plain_audit(given, labels)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=300), st.integers(1, 40))
def test_carry_save_counts_equal_plain_counts(words, size):
    counter = survival.BitCounter()
    for low in range(0, len(words), size):
        counter.add(np.array(words[low : low + size], np.uint32))
        if low % 3 == 0:
            counter._press()
    assert counter.counts().tolist() == [sum(w >> b & 1 for w in words) for b in range(32)]


def test_words_hold_the_surviving_subsets():
    words = survival.survival_words()
    assert all((int(words[f]) >> s & 1) == (not f & s) for f in range(32) for s in range(32))


# shingle sets --------------------------------------------------------------------------------

def lowered(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def plain_shingles(text: str | None) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text or ""))
    return frozenset(zip(words, words[1:])) if len(words) > 1 else frozenset([tuple(words)] if words else [])


def plain_links(given: list[tuple], percent: int = 80) -> list[tuple]:
    """(id, shingles, component, kept) by comparing all pairs."""
    sets = [plain_shingles(t) for _, t in given]
    parent = list(range(len(given)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(given)), 2):
        if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            parent[root(j)] = root(i)
    least: dict = {}
    for i, (own, _) in enumerate(given):
        if own is not None:
            least[root(i)] = min(least.get(root(i), own), own)
    found = [least.get(root(i)) if sets[i] else given[i][0] for i in range(len(given))]
    return [(given[i][0], len(sets[i]), found[i], given[i][0] == found[i]) for i in range(len(given))]


def edited(rng: random.Random, words: list[str], n: int) -> str:
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def test_minhash_query_equals_brute_force(spark):
    got = [tuple(r) for r in QUERIES["op11_minhash_dedup"](spark, SMALL).collect()]
    want = plain_links([(i, t) for i, t, _ in documents(SMALL)])
    assert sorted(got) == sorted(want) and not all(r[3] for r in want)


def test_minhash_bears_odd_rows(spark, monkeypatch):
    monkeypatch.setattr("rosterforge.llm.common.PIECE", 1000)
    got = minhash.minhash_components(odd_docs(spark))
    assert rows(got) == sorted(plain_links([(r[0], r[1]) for r in odd_rows()]), key=repr)
    assert minhash.minhash_components(empty_docs(spark)).count() == 0
    with pytest.raises(ValueError):
        minhash.minhash_components(odd_docs(spark), percent=70)


@pytest.mark.parametrize("cut", ["", "long", "sliced"])
def test_minhash_links_of_chains_and_crowds(spark, monkeypatch, cut):
    """Chains of edits, a star whose copies are far from each other, one very large group, strangers, ties."""
    if cut == "sliced":  # every cell is crowded, every list is cut
        monkeypatch.setattr(minhash, "SLICE_ROWS", 7)
    if cut:  # every unit is small
        monkeypatch.setattr(minhash, "BLOCK", 16)
        monkeypatch.setattr(minhash, "UNIT_ROWS", 100)
        monkeypatch.setattr(minhash, "PAIRS", 50)
    rng = random.Random(3)
    common = [f"c{i}" for i in range(30)]
    texts = []
    for _ in range(12):
        words = [rng.choice(common) if rng.random() < 0.5 else f"x{rng.randrange(10**6)}" for _ in range(120)]
        now = " ".join(words)
        for _ in range(rng.randrange(1, 12)):
            texts.append(now)
            now = edited(rng, now.split(), rng.randrange(2, 9))
        texts += [edited(rng, words, 6) for _ in range(8)]
    base = [f"b{i}" for i in range(100)]
    texts += [edited(rng, base, rng.randrange(0, 6)) for _ in range(120)]
    texts += ["one", "One", "two words", "two  Words", "a b c d e", "a b c d e f"] + [edited(rng, common * 4, 60) for _ in range(40)]
    rng.shuffle(texts)
    given = list(enumerate(texts, 50))
    got = minhash.minhash_components(docs_of(spark, texts, 50).repartition(5))
    want = plain_links(given)
    assert rows(got) == sorted(want, key=repr)
    assert 20 < sum(r[3] for r in want) < len(want)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 64), st.integers(0, 10**6))
def test_sets_that_agree_share_a_prefix(same, seed):
    """Two signatures with AGREE equal coordinates meet under a posting of both, whatever the crowds."""
    rng = np.random.default_rng(seed)
    sigs = rng.integers(0, 2**32, (2, 64), dtype=np.uint64).astype(np.uint32)
    at = rng.permutation(64)[:same]
    sigs[1, at] = sigs[0, at]
    tokens = minhash._tokens(sigs)
    crowd = rng.integers(0, 5, 1 << minhash.CROWD_BITS)[minhash._cells(tokens)]
    first = np.lexsort((tokens, crowd), axis=1)[:, : minhash.PREFIX]
    shared = set(tokens[0, first[0]].tolist()) & set(tokens[1, first[1]].tolist())
    low = minhash._lows(sigs)
    counted = minhash._agreements(low[:1], low[1:])[0]
    assert (counted >= same) if same >= minhash.AGREE else (counted == 0 or counted >= minhash.AGREE)
    assert shared or same < minhash.AGREE


# phrases -------------------------------------------------------------------------------------

def plain_phrases(given: list[tuple], least: int, covered: int = 50, top: int = 2000) -> list[tuple]:
    counts: dict[str, Counter] = {}
    n: Counter = Counter()
    for text, lang in given:
        own = counts.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in (1, 2, 3):
                own.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = []
        long = {p: a for p, a in f.items() if len(p) == 3 and a >= least}
        most: dict = {}
        for p, a in long.items():
            for part in (p[:2], p[1:]):
                most[part] = max(most.get(part, 0), a)
        for p, a in f.items():
            if len(p) < 2 or a < least or len(p) == 2 and p in most and 100 * most[p] >= covered * a:
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return out


def test_phrases_bear_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(phrases, "PIECE", 1000)
    given = [(r[1], r[2]) for r in odd_rows()]
    for least in (1, 2, 10):
        got = phrases.mine_phrases(odd_docs(spark).withColumn("h1", phrases.F.lit(1)), least=least)
        assert rows(got) == sorted(plain_phrases(given, least), key=repr)
    assert phrases.mine_phrases(empty_docs(spark)).count() == 0


def made_texts(n: int) -> list[tuple]:
    rng = random.Random(9)
    words = [f"w{i}" for i in range(40)] + ["Ünder", "straße", "\x01", "日本"]
    out = []
    for i in range(n):
        text = "".join(rng.choice(words).title() + rng.choice([" ", " ", "\t", "  ", ". ", "\n", "?"]) for _ in range(rng.randrange(1, 90)))
        out.append((text + " the very same line" * (i % 3) + rng.choice(["", " hot pair"] * 2), rng.choice(["en", "de", None])))
    return out + out[: n // 3] * 2


@pytest.mark.parametrize("cut", [False, True])
def test_phrases_equal_brute_force(spark, monkeypatch, cut):
    if cut:  # many chunks, crowded nodes, buckets divided twice
        monkeypatch.setattr(phrases, "CHUNK_BYTES", 4000)
        monkeypatch.setattr(phrases, "HELD_WORDS", 20)
        monkeypatch.setattr(phrases, "SLICE_EDGES", 10)
        monkeypatch.setattr(phrases, "BUCKET_EDGES", 300)
        monkeypatch.setattr(phrases, "FAN", 3)
    given = made_texts(150)
    docs = spark.createDataFrame(given, "text string, lang string").repartition(5)
    got = phrases.mine_phrases(docs, least=5, top=60)
    assert rows(got) == sorted(plain_phrases(given, 5, top=60), key=repr)


def test_phrases_start_again_where_words_share_a_hash(spark, monkeypatch):
    plain = phrases.xxhash.xxh64_intdigest
    calls = []

    class Poor:
        @staticmethod
        def xxh64_intdigest(word, seed):
            return plain(word, seed) % (50 if seed < 2 else 2**64)

    real = phrases._vocabulary
    monkeypatch.setattr(phrases, "xxhash", Poor)
    monkeypatch.setattr(phrases, "_vocabulary", lambda texts, seed: calls.append(seed) or real(texts, seed))
    given = made_texts(40)
    got = phrases.mine_phrases(spark.createDataFrame(given, "text string, lang string"), least=3)
    assert rows(got) == sorted(plain_phrases(given, 3), key=repr) and calls == [0, 1, 2]


def test_counts_of_a_triple_follow_from_edges():
    codes = phrases._Codes(0)
    paths = Counter({b"a b c a b": 2, b"a b": 3, b"c": 1, b"": 4})
    edges = phrases._summed(phrases._edges(*phrases._coded(paths, codes), None))
    a, b, c = (codes[w] for w in (b"a", b"b", b"c"))
    assert {tuple(int(x) for x in e) for e in edges} == {
        (a, b, c, 2), (b, c, a, 2), (c, a, b, 2), (a, b, 0, 5), (b, 0, 0, 5), (c, 0, 0, 1)
    }
