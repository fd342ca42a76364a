import random

import pytest

from casegrain.llm.components import connected_components


def brute(links):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        for x in (a, b):
            if x is not None:
                find(x)
        if a is not None and b is not None:
            a, b = sorted((find(a), find(b)))
            up[b] = a
    return {x: find(x) for x in up}


def run(spark, links, **kw):
    df = spark.createDataFrame([(a, b, "extra") for a, b in links], "a string, b string, member string")
    rows = connected_components(df, **kw).collect()
    assert len(rows) == len({r["member"] for r in rows})
    return {r["member"]: r["group_id"] for r in rows}


@pytest.mark.parametrize(
    "links",
    [
        [], [("a", None), (None, "b"), (None, None)], [("a", "a")], [("b", "a"), ("a", "b"), ("b", "a")], [(str(i), str(i + 1)) for i in range(60)], [(f"{i:03d}", f"{i + 1:03d}") for i in range(60, 0, -1)], [("", "x"), ("é", "z"), ("z", "x")],
    ],
)
def test_small(spark, links):
    assert run(spark, links) == brute(links)


@pytest.mark.parametrize("seed", [1, 2])
def test_random(spark, seed):
    r = random.Random(seed)
    links = [(f"n{r.randint(0, 400)}", f"n{r.randint(0, 400)}") for _ in range(260)] + [(f"n{r.randint(0, 400)}", None)]
    assert run(spark, links) == brute(links)


def test_hub_with_a_third_of_all_rows(spark, monkeypatch):
    from casegrain.llm import components

    monkeypatch.setattr(components, "FEWEST", 16)
    r = random.Random(5)
    links = [("hub", f"x{i}") for i in range(300)] + [(f"y{r.randint(0, 500)}", f"y{r.randint(0, 500)}") for _ in range(400)] + [("x7", "y3"), ("a", "hub")]
    assert run(spark, links, heavy_share=0.05) == brute(links)
