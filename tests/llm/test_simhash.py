import random
import re

import numpy as np
import pytest
import xxhash
from conftest import rows
from pyspark.sql import functions as F
from texts import EDGES, edges, empty, frame

from cartlake.llm.simhash import (
    _Forest,
    _blocks,
    _permuted,
    fingerprint,
    near_duplicates,
    one_per_class,
    restored,
    similar_pairs,
)


def print_by_hand(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, budget=4):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= budget:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("text", [r[1] for r in EDGES] + ["one", "A b C", "a b c d", "a b c d e\vf É"])
def test_fingerprint(text):
    assert fingerprint(text or "") == print_by_hand(text)


def test_permutations_are_undone():
    keys = np.random.default_rng(1).integers(0, 2**64, 100, dtype=np.uint64)
    for lead in ((0, 1), (2, 5), (1, 4)):
        assert (restored(_permuted(keys, lead, _blocks(4)), lead, _blocks(4)) == keys).all()


def test_forest_connects_with_few_links():
    rnd = np.random.default_rng(2)
    forest = _Forest(200)
    links = []
    for _ in range(20):
        links += forest.add(rnd.integers(0, 200, 30), rnd.integers(0, 200, 30))
    other = _Forest(200)
    other.add(*np.array(links).T)
    assert len(links) < 200 and (other.root == forest.root).all()


def _flip(x, rnd, most):
    for b in rnd.sample(range(64), rnd.randrange(most + 1)):
        x ^= 1 << b
    return x


@pytest.mark.parametrize("node_rows, step", [(32768, 4), (5, 4), (3, 20), (2, 64)])
def test_links_connect_what_brute_force_does(spark, node_rows, step):
    """Clusters around few centres, chains, both ends of the number range; large nodes are split."""
    rnd = random.Random(node_rows)
    centres = [0, 2**64 - 1, *(rnd.getrandbits(64) for _ in range(30))]
    prints = {_flip(c, rnd, 5) for c in centres for _ in range(14)} | {1 << i for i in range(64)}
    prints = sorted(prints)
    signed = [(p - 2**64 if p >= 2**63 else p,) for p in prints]
    found = similar_pairs(spark.createDataFrame(signed, "fp bigint"), node_rows=node_rows, step=step).collect()
    at = {s[0]: i for i, s in enumerate(signed)}
    forest = _Forest(len(prints))
    for r in found:
        assert ((r.a ^ r.b) & (2**64 - 1)).bit_count() <= 4
        forest.add(np.array([at[r.a]]), np.array([at[r.b]]))
    assert forest.root.tolist() == classes(prints)


def test_edges(spark):
    found = near_duplicates(edges(spark))
    prints = [print_by_hand(r[1]) for r in EDGES]
    names = {}
    for r, c in zip(EDGES, classes(prints)):
        if r[0] is not None:
            names[c] = min(names.get(c, r[0]), r[0])
    want = sorted(
        ((r[0], p - 2**64 if p >= 2**63 else p, names.get(c)) for r, p, c in zip(EDGES, prints, classes(prints))),
        key=repr,
    )
    assert rows(found, "id", "fp", "component_id") == want
    assert near_duplicates(empty(spark)).count() == 0
    clash = edges(spark).withColumns({"fp": F.lit("x"), "component": F.lit(1), "node": F.lit(2)})
    assert rows(near_duplicates(clash), "id", "fp", "component_id") == want


def test_near_copies_leave_one(spark):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    base = [rnd.choice(words) for _ in range(2000)]
    data = [(10, " ".join(base), "a"), (11, " ".join(base[:-1]), "a"), (12, " ".join([*base, "more"]), "b")]
    data += [(i, " ".join(rnd.choice(words) for _ in range(200)), "c") for i in range(20, 30)]
    kept = one_per_class(frame(spark, data))
    assert rows(kept, "doc_id") == [(i,) for i in (10, *range(20, 30))]


def test_rows_of_one_id_and_rows_without(spark):
    """Each class keeps one row, whatever ids its rows have."""
    kept = one_per_class(edges(spark))
    prints = [print_by_hand(r[1]) for r in EDGES]
    assert kept.columns == edges(spark).columns
    assert sorted(print_by_hand(r.text) for r in kept.collect()) == sorted({prints[c] for c in classes(prints)})
    assert kept.where("text = 'the same text'").first().doc_id == 1
