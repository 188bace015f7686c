import random

import pytest

from cartlake.llm.components import components


def by_hand(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


@pytest.mark.parametrize(
    "links",
    [
        [(i, i + 1) for i in range(60)],
        [(0, i) for i in range(1, 80)] + [(i, 200) for i in range(100, 120)],
        [(random.Random(7).randrange(150), x) for x in range(150)],
        [(a, b) for a in range(12) for b in range(12)] + [(-5, 3), (50, -9)],
    ],
)
def test_against_union_find(spark, links):
    found = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    want = by_hand([(a, b) for a, b in links if a != b])
    assert len(found) == len(want) and {r.node: r.component for r in found} == want


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
    odd = spark.createDataFrame([(1, 1), (None, 2), (3, None)], "a bigint, b bigint")
    assert components(odd).count() == 0
