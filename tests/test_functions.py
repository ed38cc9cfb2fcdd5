from __future__ import annotations

import math
import random
import uuid

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rosterforge.config import Config
from rosterforge.functions import ids, numbers, text
from rosterforge.functions import similarity as sim
from rosterforge.operators.scoring import tier


def apply(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_round1_scales_before_rounding(spark):
    values = [61.949999999999996, 0.44999999999999996, 1.8499999999999999, 0.25, 0.049999999999999996]
    assert apply(spark, values, numbers.round1, "double") == [62.0, 0.5, 1.9, 0.3, 0.0]


@pytest.mark.parametrize("border,label,below", [(62.0, "A", "B"), (50.0, "B", "C")])
def test_tier_at_the_border(spark, border, label, below):
    edge = border - 0.05
    values = [math.nextafter(edge, 0) - 1e-6, math.nextafter(edge, 100)]
    assert apply(spark, values, lambda v: tier(numbers.round1(v), Config()), "double") == [below, label]


def test_text_to_int(spark):
    values = ["2.5", "3.5", "4.5", "-2.5", "3.7", "1e3", " 7 ", "1,000", "abc", "1e10", "5d", "NaN", "", None]
    expected = [2, 4, 4, -2, 4, 1000, 7, None, None, None, None, None, None, None]
    assert apply(spark, values, numbers.int_via_double) == expected
    values = ["2.5", "3.7", "-2.5", "+5", " 12 ", "", "1e3"]
    assert apply(spark, values, numbers.int_from_text) == [3, 4, -3, 5, 12, None, 1000]


def test_size_band(spark):
    bands = ["1,001-5,000 employees", "10,001+ employees", "unknown", None]
    assert apply(spark, bands, numbers.size_band_low) == [1001, 10001, None, None]
    assert apply(spark, bands, numbers.size_band_high) == [5000, None, None, None]


def test_percentage_of_nothing_is_unknown(spark):
    assert apply(spark, [0, 4], lambda v: numbers.pct(F.lit(1), v), "int") == [None, 25.0]


def test_email_validity(spark):
    emails = ["a.b@c.test", "ab.test", "a@@c.test", "a@c", "a b@c.test", "a.@c.test", "a@c.test\n", "A@c.test", None]
    assert apply(spark, emails, text.is_valid_email) == [True] + [False] * 7 + [None]


def test_domains(spark):
    raw = ["https://www.Stripe.com/", "  snowflake.com ", "  ", "HTTP://x.io//", None, "https://"]
    assert apply(spark, raw, lambda c: text.normalize_domain(c, "loader")) == [
        "stripe.com", "snowflake.com", None, "x.io", None, ""
    ]
    assert apply(spark, raw[:2] + raw[3:4], lambda c: text.normalize_domain(c, "staging")) == [
        "stripe.com/", "snowflake.com", "http://x.io//"
    ]
    assert apply(spark, raw[:1], lambda c: text.normalize_domain(c, "match")) == ["https://www.stripe.com/"]


TITLES = [
    ("  Data Engineer ", "Data Engineer", "IC", "Data"),
    ("VP, Revenue Operations", "VP of Revenue Operations", "VP", "RevOps"),
    ("Dir. Data", "Director of Data", "Director", "Data"),
    ("Sr. Software Engineer", "Senior Software Engineer", "IC", "Engineering"),
    ("head of revops", "Head of RevOps", "Director", "RevOps"),
    ("Chief Operating Officer", "Chief Operating Officer", "C-level", "Operations"),
    ("Finance  Manager", "Finance Manager", "Manager", "Finance"),
    ("vp, data", "Vp, Data", "VP", "Data"),
    ("Vice President Sales", "Vice President Sales", "VP", "Sales"),
    ("Janitor", "Janitor", "IC", None),
    ("", None, None, None),
    (None, None, None, None),
]


def test_titles(spark):
    raw = [t[0] for t in TITLES]
    low = lambda c: F.lower(text.expand_title(c))
    assert apply(spark, raw, lambda c: text.title_case(low(c))) == [t[1] for t in TITLES]
    assert apply(spark, raw, lambda c: text.seniority(low(c))) == [t[2] for t in TITLES]
    assert apply(spark, raw, lambda c: text.department(low(c))) == [t[3] for t in TITLES]


def test_rewrite_email(spark):
    emails = ["jane.doe@acme.test", "real@company.com", "a@b.test.org"]
    assert apply(spark, emails, text.rewrite_email) == ["jane.doe+acme@example.com", "real@company.com", "a@b.test.org"]
    assert apply(spark, emails, lambda c: text.rewrite_email(c, "as_is")) == emails


def test_uuid5_is_the_standard_one(spark):
    names = ["p|x", "", "/objects/companies/records|ACC-00001", "é"]
    assert apply(spark, names, ids.uuid5) == [str(uuid.uuid5(uuid.NAMESPACE_URL, n)) for n in names]


GOLDEN = [
    ("martha", "marhta", 0.9611111111111111), ("steven", "steve", 0.9666666666666667),
    ("michael", "micheal", 0.9714285714285714), ("jon", "john", 0.9333333333333333),
    ("ann", "anna", 0.9416666666666667), ("sarah", "sara", 0.96), ("brian", "bryan", 0.8933333333333333),
    ("dwayne", "duane", 0.8400000000000001), ("josé", "josè", 0.92), ("abcdefghij", "abcdefghik", 0.96),
    ("abcdefgh", "abxyzuvw", 0.5), ("ab", "ba", 0.0), ("", "", 0.0),
]


def test_jaro_winkler_golden(spark):
    df = spark.createDataFrame([(a, b, v) for a, b, v in GOLDEN] + [(None, "a", None)], "a string, b string, v double")
    for r in df.withColumn("got", sim.jaro_winkler_similarity("a", "b")).collect():
        assert r["got"] == (pytest.approx(r["v"], abs=1e-15) if r["v"] is not None else None), r


def random_names(rng, n, alphabet, longest):
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, longest))) for _ in range(n)]


@pytest.mark.parametrize("alphabet,longest", [("ab", 6), ("abcd", 9), ("aeinrst", 14), ("aé漢", 5)])
def test_jaro_winkler_equals_the_second_engine(alphabet, longest):
    rng = random.Random(7)
    left, right = random_names(rng, 4000, alphabet, longest), random_names(rng, 4000, alphabet, longest)
    con = duckdb.connect()
    con.execute("create table t(i int, a varchar, b varchar)")
    con.executemany("insert into t values (?, ?, ?)", [(i, a, b) for i, (a, b) in enumerate(zip(left, right))][:1500])
    want = [r[0] for r in con.execute("select jaro_winkler_similarity(a, b) from t order by i").fetchall()]
    got = sim.jaro_winkler([a.encode() for a in left[:1500]], [b.encode() for b in right[:1500]])
    assert np.array_equal(np.array(want), got)


def share_a_key(a: str, b: str, threshold: float) -> bool:
    x, y = a.encode(), b.encode()
    common = 0
    while common < min(len(x), len(y), 4) and x[common] == y[common]:
        common += 1
    shared = set(sim.pairing_keys(x, threshold)) & set(sim.pairing_keys(y, threshold))
    return any(k.split(".")[0] == str(common) for k in shared)


@settings(max_examples=1500, deadline=None)
@given(st.text("abc", min_size=1, max_size=12), st.text("abc", min_size=1, max_size=12), st.sampled_from([0.9, 0.8, 0.95]))
def test_similar_names_always_share_a_key(a, b, threshold):
    if sim.jaro_winkler([a.encode()], [b.encode()])[0] >= threshold:
        assert share_a_key(a, b, threshold)


def test_edited_names_always_share_a_key():
    rng = random.Random(3)
    checked = 0
    for _ in range(4000):
        a = "".join(rng.choice("aeinrstlmo") for _ in range(rng.randint(2, 16)))
        b = list(a)
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(b))
            move = rng.randrange(3)
            if move == 0:
                b[at] = rng.choice("aeinrstlmo")
            elif move == 1 and len(b) > 1:
                del b[at]
            else:
                b.insert(at, rng.choice("aeinrstlmo"))
        b = "".join(b)
        if sim.jaro_winkler([a.encode()], [b.encode()])[0] >= 0.9:
            checked += 1
            assert share_a_key(a, b, 0.9), (a, b)
    assert checked > 1000


def test_config_rejects_bad_values():
    from decimal import Decimal

    for bad in ({"w_fit": Decimal("0.5")}, {"tier_b_min": 70}, {"fuzzy_threshold": 0.5}, {"email_rewrite": "x"}, {"salts": 0}):
        with pytest.raises(ValueError):
            Config(**bad)
