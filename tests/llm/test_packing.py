import itertools
import random

import pytest

from casegrain.llm import packing as P


def best(sizes, c):
    """The fewest containers, by trying all assignments."""
    def go(i, bins):
        if i == len(sizes):
            return len(bins)
        found = go(i + 1, [*bins, sizes[i]])
        for j in range(len(bins)):
            if bins[j] + sizes[i] <= c:
                found = min(found, go(i + 1, [*bins[:j], bins[j] + sizes[i], *bins[j + 1 :]]))
        return found
    return go(0, [])


@pytest.mark.parametrize("seed", range(12))
def test_small_sets_are_near_the_optimum(seed):
    r = random.Random(seed)
    sizes = [r.randint(1, 10) for _ in range(8)]
    windows = P.pack(sizes, 10)
    assert sorted(itertools.chain(*windows)) == list(range(8))
    assert all(sum(sizes[i] for i in w) <= 10 for w in windows)
    assert best(sizes, 10) <= len(windows) <= best(sizes, 10) + 1


def test_differencing_balances():
    assert sorted(sum([8, 7, 6, 5, 4][i] for i in w) for w in P.differencing([8, 7, 6, 5, 4], 2)) in ([14, 16], [15, 15])
    r = random.Random(1)
    sizes = [r.randint(10, 100) for _ in range(300)]
    sums = [sum(sizes[i] for i in w) for w in P.differencing(sizes, 20)]
    assert len(sums) == 20 and max(sums) - min(sums) <= 3


def test_edges():
    assert P.pack([], 5) == [] and P.pack([0, 0], 5) == [[0, 1]]
    assert P.pack([5, 5, 5], 5) == [[0], [1], [2]] or len(P.pack([5, 5, 5], 5)) == 3
    assert len(P.pack([3] * 50, 5)) == 50


C = "capacity_id long, purpose string, capacity_tokens long"
D = "doc_id long, text string, capacity_id string"


def test_documents(spark):
    rows = [(i, "word " * n, "clash") for i, n in enumerate([1, 5, 30, 64, 65, 200, 0, 3, 3, 3])] + [(50, None, None), (51, "", None), (52, "á" * 300, None)]
    docs = spark.createDataFrame(rows, D)
    caps = spark.createDataFrame([(1, "a", 64), (2, "b", 512), (3, "c", None), (4, "d", 0), (1, "a", 64)], C)
    out = P.pack_documents(docs, caps).collect()
    tokens = {r["doc_id"]: r["tokens"] for r in P.token_counts(docs).collect()}
    enc = P.encoding(P.TOKENIZER)
    assert tokens == {i: len(enc.encode_ordinary(t)) for i, t, _ in rows if t is not None}
    for cap, size in ((1, 64), (2, 512)):
        mine = [r for r in out if r["capacity_id"] == cap]
        by = {}
        for r in mine:
            by.setdefault(r["doc_id"], []).append((r["token_start"], r["token_end"]))
        for d, n in tokens.items():
            spans = sorted(by[d])
            assert spans[0][0] == 0 and spans[-1][1] == n and all(a[1] == b[0] for a, b in itertools.pairwise(spans))
            assert len(spans) == 1 or n > size
        fill = {}
        for r in mine:
            fill[r["container"]] = fill.get(r["container"], 0) + r["token_end"] - r["token_start"]
        assert max(fill.values()) <= size
        assert len(fill) <= -(-sum(tokens.values()) // size) + 2
    assert {r["capacity_id"] for r in out} == {1, 2}
    assert P.pack_documents(docs, caps.limit(0)).count() == 0
    assert P.pack_documents(docs.limit(0), caps).count() == 0
