import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from casegrain.llm import canonical as C

word = st.text(alphabet="abcd", max_size=7)


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i] + [0] * len(b) if False else _next(row, i, x, b)
    return row[-1]


def _next(row, i, x, b):
    new = [i]
    for j, y in enumerate(b, 1):
        new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
    return new


@settings(max_examples=400)
@given(word, word)
def test_levenshtein(a, b):
    assert C.levenshtein(a, b) == lev(a, b)


@settings(max_examples=300)
@given(word, word, word)
def test_damerau_is_a_metric_within_twice(a, b, c):
    d = C.damerau
    assert d(a, b) == d(b, a) and (d(a, b) == 0) == (a == b)
    assert d(a, c) <= d(a, b) + d(b, c)
    assert d(a, b) <= lev(a, b) <= 2 * d(a, b)


def plain_damerau(a, b):
    """By the definition, without any shortcut."""
    last, inf = {}, len(a) + len(b)
    h = {(-1, -1): inf}
    for i in range(len(a) + 1):
        h[i, -1], h[i, 0] = inf, i
    for j in range(len(b) + 1):
        h[-1, j], h[0, j] = inf, j
    for i, x in enumerate(a, 1):
        seen = 0
        for j, y in enumerate(b, 1):
            k, m = last.get(y, 0), seen
            seen = j if x == y else seen
            h[i, j] = min(h[i - 1, j - 1] + (x != y), h[i, j - 1] + 1, h[i - 1, j] + 1, h[k - 1, m - 1] + i - k - 1 + 1 + j - m - 1)
        last[x] = i
    return h[len(a), len(b)]


@settings(max_examples=500)
@given(word, word)
def test_damerau(a, b):
    assert C.damerau(a, b) == plain_damerau(a, b)


def test_transposition_costs_one():
    assert C.damerau("mganetic", "magnetic") == 1 and C.damerau("ca", "abc") == 2


@settings(max_examples=100)
@given(st.lists(word.filter(bool), min_size=1, max_size=30), word, st.integers(0, 3))
def test_tree_returns_every_name_in_the_radius(names, q, r):
    want = sorted((n, plain_damerau(n, q)) for n in set(names) if plain_damerau(n, q) <= r)
    assert sorted(C.BKTree(names).search(q, r)) == want == sorted(C.Forest(sorted(set(names))).search(q, r))


def test_a_search_visits_few_of_many_names():
    r = random.Random(5)
    syllables = [a + b + c for a in "bcdfglmnprstv" for b in "aeiou" for c in ("", "n", "r", "s", "l")]
    names = sorted({" ".join("".join(r.choice(syllables) for _ in range(r.randint(2, 4))) for _ in range(r.randint(1, 3))) for _ in range(50_000)})
    forest, seen = C.Forest(names), []
    long = [n for n in names if len(n) >= 18][:20]
    for n in long:
        assert (n, 0) in forest.search(n, 3, seen)
    assert len(seen) < 0.1 * len(long) * len(names)


NAMES = [("m", n, i) for i, ns in {1: "computed tomography|CT|CAT scan", 2: "magnetic resonance imaging|MRI", 3: "positron emission tomography|PET", 4: "optic neuritis|ON", 5: "lupus nephritis|LN, lupus", 6: "thyroid gland|thyroid"}.items() for n in ns.split("|")] + [("a", "liver", 9), ("a", "urinary bladder", 10), ("a", "Liver", 11)]
VALUES = {
    "Computed  Tomography": 1, "tomography, computed": 1, "computed_tomography": 1, "computed/tomography": 1, "repeat CT at 6 weeks": 1, "cat scan (initial)": 1, "computde tomograpy": 1, "ＣＴ": 1, "СТ": 1, "mganetic resonance imaging": 2,
    "magnetic resonance imagings": 2, "post-contrast mri": 2, "post-contrast MRI": 2, "contrast ct of head": 1, "pet scan": 3, "result of on site reading": -1, "imaging of the resonance magnetic": -1, "neuritis of the optic": 4, "early nephritis of the lupus, mild": 5, "imgaing, magnetic resonance": 2, "gland of thyriod": 6, "note on file": -1, "ON": 4, "on": 4, "LN, lupus": 5, "lupus nephritis in remission": 5, "thyroid glannd": 6, "thermography": -1, "see legend": -1, "?": -1, "x" * 5000: -1,
}


def test_values(spark):
    v = spark.createDataFrame([("m", k) for k in VALUES] + [("m", None), ("m", "  "), ("m", "　​"), ("z", "liver"), ("a", "LIVER"), ("a", "bladder, urinary (left)"), ("a", "lvier")], "field string, value string")
    ref = spark.createDataFrame(NAMES, "field string, name string, entry long")
    got = {(r["field"], r["value"]): r["entry"] for r in C.map_values(v, ref).collect()}
    want = {("m", k): e for k, e in VALUES.items()} | {("z", "liver"): -1, ("a", "LIVER"): 9, ("a", "bladder, urinary (left)"): 10, ("a", "lvier"): 9}
    assert got == want
    sharded = {(r["field"], r["value"]): r["entry"] for r in C.map_values(v, ref, broadcast_entries=0, shard_entries=3).collect()}
    assert sharded == want
    assert {r["entry"] for r in C.map_values(v, ref.limit(0)).collect()} == {-1}
    assert C.map_values(v.limit(0), ref).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_near_against_brute_force(seed):
    r = random.Random(seed)
    names = ["".join(r.choice("abcdef") for _ in range(r.randint(3, 20))) for _ in range(150)]
    n = C.Names([(x, i) for i, x in enumerate(names)])
    for _ in range(100):
        q = list(r.choice(names))
        for _ in range(r.randint(0, 3)):
            q[r.randrange(len(q))] = r.choice("abcdef")
        q = "".join(q)
        want = sorted((k, x) for x in set(names) if (k := C.damerau(q, x)) <= C.slips(min(len(x), len(q) + 1)))
        assert list(n.near(q)) == want
