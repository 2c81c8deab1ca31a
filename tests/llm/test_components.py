"""Connected components against union-find, and the edges that each round reads again."""

import random

import pytest

from gridloom.llm import components as module
from gridloom.llm.shared import workspace


def brute(edges):
    label = {n: n for e in edges if e[0] != e[1] for n in e}

    def top(n):
        while label[n] != n:
            n = label[n]
        return n

    for a, b in edges:
        if a != b:
            low, high = sorted((top(a), top(b)))
            label[high] = low
    return {n: top(n) for n in label}


RNG = random.Random(1)
GRAPHS = {
    "none": [],
    "loops": [(3, 3), (4, 5), (5, 4), (5, 4)],
    "rising chain": [(i, i + 1) for i in range(-20, 60)],
    "mixed chain": [(i * 37 % 101, (i + 1) * 37 % 101) for i in range(100)],
    "hub": [(500, i) for i in range(1000) if i != 500],
    "many": [(RNG.randrange(300), RNG.randrange(300)) for _ in range(170)],
}


@pytest.mark.parametrize("name", GRAPHS)
def test_components_equal_union_find(spark, name):
    df = spark.createDataFrame(GRAPHS[name], "a long, b long")
    got = {r.node: r.label for r in module.components(df, workspace(spark, "c")).collect()}
    assert got == brute(GRAPHS[name])


def test_edges_within_a_label_are_not_read_again(spark, monkeypatch):
    """A large group with many links for each member: the first round joins nearly all, and their edges go."""
    rng = random.Random(2)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(4000)]
    rows, stage = {}, module.stage

    def counted(df, path):
        out = stage(df, path)
        rows[path.rpartition("/")[2]] = out.count()
        return out

    monkeypatch.setattr(module, "stage", counted)
    got = module.components(spark.createDataFrame(edges, "a long, b long"), workspace(spark, "c"))
    assert {r.node: r.label for r in got.collect()} == brute(edges)
    again = [n for name, n in rows.items() if name.startswith("edges-") and name != "edges-0"]
    assert rows["edges-0"] > 3000
    assert again and sum(again) < 300
