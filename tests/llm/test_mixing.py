import hashlib
import math
import random
from collections import Counter, defaultdict

import pytest
from conftest import rows
from texts import EDGES, SCHEMA, edges, empty, frame

from cartlake.llm.mixing import mix, repeat_documents, source_targets


def targets(sizes, weights=(5, 2, 1), share=1.5, epochs=2):
    """Excess above a limit goes to the others by weight, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    fixed = {}
    while True:
        open_ = [s for s in names if s not in fixed]
        left = share * sum(sizes.values()) - sum(fixed.values())
        now = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if now[s] > epochs * sizes[s]]
        if not over:
            return {**fixed, **now}
        fixed |= {s: float(epochs * sizes[s]) for s in over}


def by_hand(data):
    docs = []
    for i, text, source in data:
        text = text or ""
        size = len([w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w])
        md5 = hashlib.md5(text.encode()).hexdigest()
        name = md5 if i is None else f"{i}:{md5}"
        u = (int(hashlib.md5(name.encode()).hexdigest()[:13], 16) + 1) / 2**52
        weight = 1 / (1 + abs((len(text) - size) / max(size, 1) - 5) / 5)
        docs.append((source, -math.log(u) / weight, i is not None, i or 0, md5, i, size))
    sizes = defaultdict(int)
    for d in docs:
        sizes[d[0]] += d[-1]
    goal = targets(sizes)
    out = []
    for source in sizes:
        whole = math.floor(goal[source] / sizes[source]) if sizes[source] else 0
        rest, before = goal[source] - whole * sizes[source], 0
        for d in sorted(x for x in docs if x[0] == source) if source is not None else sorted(
            (x for x in docs if x[0] is None), key=lambda x: x[1:]
        ):
            size = d[-1]
            times = whole + (size > 0 and before + size / 2 <= rest)
            out.append((d[-2], size, sizes[source], size * times))
            before += size
    return out, goal


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    sources = ["b", "a", None, "ä", "Z", "long"]
    data = [
        (i, " ".join("w" * rnd.randrange(1, 12) for _ in range(rnd.randrange(40))), rnd.choice(sources[: 2 + seed]))
        for i in range(150)
    ]
    data += [(500 + i, "word " * 30, "long") for i in range(100 * (seed == 2))]
    found = mix(frame(spark, data), ranges=16)
    want, goal = by_hand(data)
    assert rows(found, "id", "size", "source_size", "taken") == sorted(want, key=repr)
    got = {r.source: r.target for r in found.collect()}
    assert all(math.isclose(got[s], goal[s], rel_tol=1e-12) for s in goal)
    assert rows(mix(frame(spark, data).repartition(5), ranges=4096), "id", "taken") == rows(found, "id", "taken")


def test_targets_stop_at_two_epochs(spark):
    sizes = {"a": 10, "b": 1000, "c": 50, None: 3, "d": 0}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in source_targets(df).collect()}
    want = targets(sizes)
    assert got.keys() == want.keys() and all(math.isclose(got[s], want[s]) for s in want)
    none = df.selectExpr("source", "cast(0 AS bigint) AS source_size")
    assert {r.target for r in source_targets(none).collect()} == {0.0}


def test_edges(spark):
    found = mix(edges(spark))
    want, _ = by_hand([(r[0], r[1], r[3]) for r in EDGES])
    assert rows(found, "id", "size", "source_size", "taken") == sorted(want, key=repr)
    assert mix(empty(spark)).count() == 0


def test_documents_are_repeated(spark):
    docs = edges(spark)
    times = Counter()
    for r in mix(docs).collect():
        times[r.id] += r.times if r["size"] else 0
    mixed = repeat_documents(docs)
    assert mixed.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    assert Counter(r.doc_id for r in mixed.collect()) == +times
