"""Connected components against union-find, and how often their links are written."""

import random

import pytest

from featuremart.llm import components


def smallest(edges):
    parent = {x: x for e in edges if None not in e and e[0] != e[1] for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a in parent and b in parent and a != b:
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    return {x: find(x) for x in parent}


def shuffled(edges, seed):
    """The edges with other node numbers, repeated and turned round."""
    rng = random.Random(seed)
    nodes = sorted({x for e in edges for x in e})
    number = dict(zip(nodes, rng.sample(range(-1_000, 1_000), len(nodes)), strict=True))
    return [(number[a], number[b])[::rng.choice((1, -1))] for a, b in edges for _ in range(rng.choice((1, 2)))]


CHAIN = [(i, i + 1) for i in range(150)]
STAR = [(0, i) for i in range(1, 150)]
LOOSE = [(random.Random(5).randrange(200) if i % 3 else i, random.Random(i).randrange(200)) for i in range(150)]


@pytest.mark.parametrize("edges", [shuffled(CHAIN, 1), shuffled(STAR, 2), LOOSE + [(7, 7), (300, 300)],
                                   shuffled(CHAIN + [(200 + a, 200 + b) for a, b in STAR], 3)])
def test_roots_are_those_of_union_find(spark, edges):
    found = components.connected_components(spark.createDataFrame([*edges, (None, 3), (4, None)], "a long, b long")).collect()
    assert sorted(map(tuple, found)) == sorted(smallest(edges).items())


def written_links(spark, monkeypatch, edges):
    names, write = [], components.written
    monkeypatch.setattr(components, "written", lambda df, name: names.append(name) or write(df, name))
    found = dict(map(tuple, components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == smallest(edges)
    return len(names)


def test_links_that_are_stars_need_no_round(spark, monkeypatch):
    assert written_links(spark, monkeypatch, [(0, i) for i in range(1, 40)] + [(50, 51), (50, 51)]) == 1


def test_no_round_only_confirms_the_one_before(spark, monkeypatch):
    assert written_links(spark, monkeypatch, [(0, 1), (1, 2)]) == 2  # one round makes it a star
