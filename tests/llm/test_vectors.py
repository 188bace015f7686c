import random

import numpy as np
import pytest
from conftest import rows

from cartlake.llm.hnsw import Graph
from cartlake.llm.vector_dedup import audited, near_vectors, neighbours, unit

SCHEMA = "vec_id bigint, embedding array<float>, label int, node int, vector string"


def brute_force(data, least=0.93):
    n = len(data)
    sound = [
        label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, label in data
    ]
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * n
    for i in range(n):
        for j in range(i):
            if not (sound[i] and sound[j]) or data[i][2] != data[j][2] or len(data[i][1]) != len(data[j][1]):
                continue
            a, b = (np.array(np.float32(data[k][1]), float) for k in (i, j))
            if a @ b / np.sqrt((a @ a) * (b @ b)) >= least:
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    names = {}
    for i in range(n):
        if data[i][0] is not None:
            names[find(i)] = min(names.get(find(i), data[i][0]), data[i][0])
    return sorted(((data[i][0], links[i], names.get(find(i)) if sound[i] else data[i][0]) for i in range(n)), key=repr)


def clustered(n, dim, seed):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(max(2, n // 12), dim))
    spread = rnd.choice([0.02, 0.2, 0.6], size=n)[:, None]
    return (centres[rnd.integers(0, len(centres), n)] + spread * rnd.normal(size=(n, dim))).astype(np.float32)


@pytest.mark.parametrize("shard_rows", [4096, 40])
def test_against_brute_force(spark, shard_rows):
    rnd = random.Random(1)
    vectors = clustered(260, 16, 3)
    data = [(i, v.tolist(), rnd.choice([0, 0, 1, 2])) for i, v in enumerate(vectors)]
    data += [(1000 + i, data[5][1], data[5][2]) for i in range(20)]
    df = spark.createDataFrame([(*d, 1, "x") for d in data], SCHEMA)
    found = near_vectors(df, shard_rows=shard_rows)
    assert rows(found, "id", "n_links", "component_id") == brute_force(data)
    assert found.where("kept <> (id = component_id)").count() == 0


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    data = [
        (1, [1.0, 0.0], 1),
        (2, [2.0, 0.0], 1),
        (2, [2.0, 0.0], 1),
        (3, [1.0, 0.0], None),
        (4, None, 1),
        (5, [0.0, 0.0], 1),
        (6, [nan, 1.0], 1),
        (7, [inf, 1.0], 1),
        (8, [None, 1.0], 1),
        (9, [], 1),
        (10, [1.0, 0.0, 0.0], 1),
        (11, [1e30, 1e25], 1),
        (12, [1e-40, 0.0], 1),
        (None, [3.0, 0.1], 1),
        (None, None, None),
        (13, [-1.0, 0.0], 1),
        (14, [1.0, 0.0], 2),
    ]
    df = spark.createDataFrame([(*d, 1, "x") for d in data], SCHEMA)
    assert rows(near_vectors(df), "id", "n_links", "component_id") == brute_force(data)
    assert near_vectors(df.where("false")).count() == 0


def test_recall_of_the_graph():
    """At least 0.9 of the pairs that comparing with all finds; wide beams for dense clusters."""
    v = unit(clustered(3000, 32, 9))
    graph = Graph.build(v)
    found = neighbours(graph, v, v, 0.93)
    truth = [np.flatnonzero(v @ q >= 0.93) for q in v]
    hits = sum(len(np.intersect1d(a, b)) for a, b in zip(found, truth))
    assert hits >= 0.95 * sum(map(len, truth))
    assert all((v[f] @ q >= 0.93).all() for f, q in zip(found, v))
    again = Graph.load(v, graph.blob())
    assert again.within(v[7].astype(np.float32), 0.93, 32) == graph.within(v[7].astype(np.float32), 0.93, 32)


def test_graph_of_one_and_of_equal_vectors():
    one = unit(np.ones((1, 4)))
    assert [f.tolist() for f in neighbours(Graph.build(one), one, one, 0.9)] == [[0]]
    many = unit(np.ones((300, 4)))
    assert all(len(f) == 300 for f in neighbours(Graph.build(many), many, many[:3], 0.9))


def test_audit_sees_rare_partners_and_leaves_rows_themselves_out():
    rng = np.random.default_rng(4)
    shard = unit(rng.normal(size=(4000, 32)))
    # One row in fifty has a copy that is a little off.
    for i in range(0, 2000, 50):
        shard[i + 2000] = unit(shard[i : i + 1] + rng.normal(size=(1, 32)) * 0.01)[0]
    seen = audited(shard, shard, np.arange(4000), 0.93)
    assert seen and all(i not in partners for i, partners in seen)
    for i, partners in seen:
        near = np.flatnonzero(shard @ shard[i] >= 0.93)
        assert partners.tolist() == [j for j in near if j != i]
    # Rows of another shard have no place in this one.
    assert [i for i, _ in audited(shard, shard[:100], np.full(100, -1), 0.93)] == list(range(100))
    lonely = unit(rng.normal(size=(300, 32)))
    assert audited(lonely, lonely, np.arange(300), 0.93) == []


def test_a_graph_that_loses_rare_links_is_asked_with_wider_beams():
    rng = np.random.default_rng(5)
    # A crowd of copies, and pairs that only the audit by query notices.
    crowd = unit(np.ones((1, 16)) + rng.normal(size=(300, 16)) * 0.01)
    pairs = unit(rng.normal(size=(100, 16)))
    shard = np.concatenate([crowd, pairs, unit(pairs + rng.normal(size=pairs.shape) * 0.01)])

    class Partial:
        """Finds the crowd at any beam, and others from 128 on."""

        def within(self, query, least, width):
            found = np.flatnonzero(shard @ query >= least)
            return found if width >= 128 else found[found < 300]

    found = neighbours(Partial(), shard, shard, 0.93, np.arange(len(shard)))
    for i, partners in enumerate(found):
        assert sorted(partners) == np.flatnonzero(shard @ shard[i].astype(np.float32) >= 0.93).tolist()
