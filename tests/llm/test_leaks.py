import random

import numpy as np
import pytest

from casegrain.llm import leaks as L

r0 = random.Random(3)
VOCAB = ["".join(r0.choice("abcdefghijklmnoprstuvw") for _ in range(r0.randint(2, 9))) for _ in range(3000)]
ITEM = [VOCAB[i] for i in range(60)]
NOISE = [VOCAB[i] for i in range(500, 900)]
STOCK = "all procedures followed the rules of the local review board and its later amendments"


def leak(words, items=None):
    items = items or [(1, " ".join(ITEM)), (2, " ".join(VOCAB[100:112]))]
    return [i for i, *_ in L._find_in(L.hash_words(L.words(words)), L.Items(items), L.GRAM, L.WINDOW, L.LEAST_WORDS)]


def around(words):
    return " ".join(NOISE[:80] + list(words) + NOISE[80:150])


def changed(ws, every, how):
    out = []
    for i, w in enumerate(ws):
        if i % every == every - 1:
            out += [] if how == "drop" else ["zzz"] if how == "change" else [w, "yyy"]
        else:
            out.append(w)
    return out


@pytest.mark.parametrize(
    ("text", "found"),
    [
        (around(ITEM), True), (around(ITEM[10:35]), True), (around(ITEM[10:34]), False), (around(ITEM[:12]) + " " + " ".join(ITEM[30:42]), False), (" ".join(ITEM).upper(), True), ("\n".join(ITEM), True),
        (" ".join(f"{w} [{i}]," for i, w in enumerate(ITEM)), True), (around(changed(ITEM, 6, "change")), True), (around(changed(ITEM, 6, "drop")), True), (around(changed(ITEM, 6, "add")), True),
        (" ".join(ITEM[:20] + ["(", *NOISE[:20], ")"] + ITEM[20:45]), True), (around(sorted(ITEM)), False), (around(ITEM[20:40] + ITEM[:20]), False), (" ".join(ITEM).replace("a", "а").replace("e", "е"), True),
        (" ".join("".join(chr(ord(c) + 0xFEE0) for c in w) for w in ITEM), True), ("​".join(" ".join(ITEM)), True), ("", False), ("one", False), (around(VOCAB[100:112]), False),
    ],
)
def test_passages(text, found):
    assert (1 in leak(text)) is found


def test_short_items_and_stock():
    assert leak(around(VOCAB[100:112])) == [2]  # an item of fewer words leaks as a whole
    assert leak(around(VOCAB[100:110])) == []
    assert leak(f"x {STOCK} y", [(1, " ".join(ITEM) + ". " + STOCK)]) == []
    assert leak("before alpha beta after", [(5, "alpha beta")]) == [5]


def test_like_items_are_told_apart():
    other = list(ITEM)
    for i in range(4, 60, 5):
        other[i] = f"other{i}"
    assert leak(around(ITEM), [(1, " ".join(ITEM)), (2, " ".join(other))]) == [1]
    assert sorted(leak(around(ITEM), [(1, " ".join(ITEM)), (2, " ".join(ITEM))])) == [1, 2]


@pytest.mark.parametrize("seed", range(5))
def test_winnowing_guarantee(seed):
    r = random.Random(seed)
    a, b = ([r.choice(VOCAB) for _ in range(80)] for _ in range(2))
    n = L.GRAM + L.WINDOW - 1
    i, j = r.randint(0, 70), r.randint(0, 70)
    b[j : j + n] = a[i : i + n]
    fp = []
    for ws in (a, b):
        g = L.grams(L.hash_words(ws), L.GRAM)
        kept = L.winnow(g, L.WINDOW)
        assert all(kept[x + 1] - kept[x] <= L.WINDOW for x in range(len(kept) - 1))
        fp.append(set(g[kept].tolist()))
    if len(b) >= j + n and len(a) >= i + n:
        assert fp[0] & fp[1]


@pytest.mark.parametrize("seed", range(4))
def test_runs_against_brute_force(seed):
    r = random.Random(seed)
    item, doc = ([r.choice(VOCAB[:6]) for _ in range(40)] for _ in range(2))
    it = L.Items([(1, " ".join(item))])
    got = sorted(x for v in L.runs(L.hash_words(doc), it).values() for x in v)
    want = []
    for i in range(40):
        for j in range(40):
            if doc[i] == item[j] and not (i and j and doc[i - 1] == item[j - 1]):
                n = 0
                while i + n < 40 and j + n < 40 and doc[i + n] == item[j + n]:
                    n += 1
                if n >= 3:
                    want.append((i, j, n))
    assert got == sorted(want) or (not got and sum(x[2] for x in want) < 0.75 * 25)


def test_in_spark_both_ways(spark):
    docs = [(i, around(ITEM[i % 30 : i % 30 + 27])) for i in range(12)] + [(100, None), (101, ""), (102, " ".join(NOISE) * 40), (0, around(ITEM[:27])), (103, " ".join(NOISE[:300]) + " " + around(ITEM))]
    d = spark.createDataFrame([(*x, "clash") for x in docs], "doc_id long, text string, item_id string")
    t = spark.createDataFrame([(1, " ".join(ITEM), "s"), (2, " ".join(ITEM), "s"), (3, None, "s"), (4, "", "s")], "item_id long, text string, suite string")
    got = {(r["doc_id"], r["item_id"]) for r in L.find_leaks(d, t).collect()}
    assert got == {(i, k) for i in [*range(12), 103] for k in (1, 2)}
    joined = {(r["doc_id"], r["item_id"]) for r in L.find_leaks(d, t, broadcast_fingerprints=0).collect()}
    assert joined == got
    assert L.find_leaks(d, t.limit(0)).count() == 0 and L.find_leaks(d.limit(0), t).count() == 0


def test_items_of_few_words_leak_as_a_whole():
    for n in range(1, 8):
        for at in range(20):
            assert leak(" ".join(NOISE[:at] + VOCAB[100 : 100 + n] + NOISE[at:60]), [(1, " ".join(ITEM)), (7, " ".join(VOCAB[100 : 100 + n]))]) == [7]


def test_both_ways_agree_on_like_and_short_items(spark):
    other = [f"other{i}" if i % 5 == 4 else w for i, w in enumerate(ITEM)]
    fourth = [f"fourth{i}" if i % 4 == 3 else w for i, w in enumerate(VOCAB[200:260])]
    texts = [ITEM, other, *(VOCAB[100 : 100 + n] for n in range(1, 8)), fourth]
    docs = [around(ITEM), around(other), around(ITEM[:30] + NOISE[200:220] + other[30:]), around([*ITEM, *VOCAB[200:260]]), " ".join(NOISE)]
    docs += [" ".join(w for i in range(0, 60, 4) for w in [*VOCAB[200 + i : 203 + i], f"x{i}"])]  # runs of three words: no fingerprint
    docs += [" ".join(NOISE[:k] + VOCAB[100 : 100 + n] + NOISE[k:60]) for n in range(1, 8) for k in (3, 4, 5)]
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    for first in (0, 2, 4):  # with and without items of one or two words
        t = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts) if i < 2 or i >= 2 + first], "item_id long, text string")
        got = {tuple(r) for r in L.find_leaks(d, t).collect()}
        assert {tuple(r) for r in L.find_leaks(d, t, broadcast_fingerprints=0).collect()} == got
        pairs = {x[:2] for x in got}
        assert (0, 0) in pairs and (0, 1) not in pairs and (1, 1) in pairs and (1, 0) not in pairs and (3, 9) in pairs
        assert all((6 + 3 * (n - 1) + k, 1 + n) in pairs for n in range(1 + first, 8) for k in range(3))


def test_hash_is_stable():
    assert L.hash_words(["abc"])[0] == np.uint64(L.xxhash.xxh64_intdigest("abc"))


def test_fewer_least_words_both_ways(spark):
    d = spark.createDataFrame([(0, around(ITEM[20:32])), (1, around(ITEM[20:31])), (2, around(ITEM))], "doc_id long, text string")
    t = spark.createDataFrame([(1, " ".join(ITEM))], "item_id long, text string")
    for most in (L.BROADCAST_FINGERPRINTS, 0):
        got = {r["doc_id"]: r["spanned_words"] for r in L.find_leaks(d, t, least_words=12, broadcast_fingerprints=most).collect()}
        assert got == {0: 12, 2: 60}


def test_a_stock_sentence_in_a_third_of_the_documents(spark):
    docs = [around([*NOISE[i % 50 : i % 50 + 30], *(STOCK.split() if i % 3 == 0 else []), *(ITEM if i == 7 else [])]) for i in range(600)]
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    t = spark.createDataFrame([(i, " ".join([*(ITEM if i == 1 else VOCAB[1000 + 40 * i : 1040 + 40 * i]), *STOCK.split()])) for i in range(40)], "item_id long, text string")
    for most in (L.BROADCAST_FINGERPRINTS, 0):
        assert [tuple(r)[:2] for r in L.find_leaks(d, t, broadcast_fingerprints=most).collect()] == [(7, 1)]
