"""Components against a plain union of sets."""

from __future__ import annotations

import random

import pytest

from vitaelake.llm.components import components


def _expected(pairs):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {x: root(x) for x in list(parent)}


def _cases():
    rng = random.Random(5)
    chain = list(range(40))
    rng.shuffle(chain)
    yield []
    yield [(1, 1), (None, 2), (3, None), (None, None)]
    yield [(5, 4), (4, 5), (5, 4), (9, 9), (4, 3)]
    yield list(zip(chain[:-1], chain[1:]))
    yield [(0, i) for i in range(1, 60)] + [(i, i + 100) for i in range(1, 60)]
    yield [(rng.randrange(120), rng.randrange(120)) for _ in range(90)]


@pytest.mark.parametrize("pairs", _cases())
def test_components_equal_a_union_of_sets(spark, pairs):
    rows = components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()
    assert len(rows) == len({r.node for r in rows})
    assert {r.node: r.component for r in rows} == _expected(pairs)
