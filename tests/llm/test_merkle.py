import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from texts import EDGES, SCHEMA, edges, empty

from cartlake.llm import merkle

COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(digests, fanout):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + fanout])) for i in range(0, len(out[-1]), fanout)])
    return out


def beside(tree, i, fanout):
    """Digests left and right of the way up from leaf ``i``."""
    frames = []
    for level in tree[:-1]:
        first = i // fanout * fanout
        frames.append(("".join(level[first:i]), "".join(level[i + 1 : first + fanout])))
        i //= fanout
    return frames


def plainly(rows, fanout):
    """``id, leaf, subroot, root, frames`` of rows ``(doc_id, source, lang, n_chars, text)``."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append((r[0] is not None, r[0] or 0, leaf(r), r[0]))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x[2] for x in sorted(groups[s], key=lambda x: x[:3])], fanout) for s in order}
    top = levels([trees[s][-1][0] for s in order], fanout)
    for k, s in enumerate(order):
        ids = [x[3] for x in sorted(groups[s], key=lambda x: x[:3])]
        for i, id_ in enumerate(ids):
            frames = beside(trees[s], i, fanout) + beside(top, k, fanout)
            yield id_, trees[s][0][i], trees[s][-1][0], top[-1][0], tuple(frames)


def found(manifest, fanout):
    proved = merkle.proofs(manifest, fanout=fanout)
    folded = proved.withColumn("folded", merkle.fold(F.col("leaf"))).withColumn("proof", merkle.proof_digest()).collect()
    for r in folded:
        assert r.folded == r.root and r.proof == sha("".join(a + b for a, b in r.path))
    return Counter((r.id, r.leaf, r.subroot, r.root, tuple(map(tuple, r.path))) for r in folded)


SHORT = "doc_id bigint, source string, lang string, n_chars bigint, text string"


@pytest.mark.parametrize("fanout, sizes", [(16, [1, 16, 17, 300]), (2, [1, 2, 3, 33]), (3, [1]), (16, [1] * 40)])
def test_against_plain_trees(spark, fanout, sizes):
    rnd = random.Random(len(sizes))
    rows = [
        (rnd.randrange(10**9), f"s{k}" if k else None, rnd.choice(["en", None]), n, f"text {rnd.random()}")
        for k, size in enumerate(sizes)
        for n in range(size)
    ]
    docs = spark.createDataFrame(rows, SHORT).repartition(7)
    manifest = merkle.build(docs, fanout=fanout)
    assert found(manifest, fanout) == Counter(plainly(rows, fanout))
    for r in merkle.nodes(manifest).collect():
        assert 0 < r.hi - r.lo <= fanout**r.level and r.lo % fanout**r.level == 0


def test_edges(spark):
    rows = [tuple(r[COLUMNS.index(c)] for c in merkle.LEAF_COLUMNS) for r in EDGES]
    assert found(merkle.build(edges(spark)), 16) == Counter(plainly(rows, 16))
    manifest = merkle.build(empty(spark))
    assert merkle.proofs(manifest).count() == 0 and merkle.nodes(manifest).count() == 0
    with pytest.raises(ValueError):
        merkle.build(edges(spark), fanout=1)


def test_equal_rows(spark):
    rows = [(5, "a", None, 1, "x")] * 50 + [(None, "a", None, 1, "x")] * 3
    assert found(merkle.build(spark.createDataFrame(rows, SHORT)), 16) == Counter(plainly(rows, 16))


def test_a_changed_leaf_gives_another_root(spark):
    rows = [(i, "a", "en", i, f"Text {i}" if i % 3 else f"text {i}") for i in range(40)]
    docs = spark.createDataFrame(rows, SHORT)
    lower = merkle.leaf_digest(text=merkle.lower_ascii(F.col("text")))
    proved = merkle.proofs(merkle.build(docs, carry={"lower": lower}), ("lower",))
    same = {r.id: r.f == r.root for r in proved.select("id", "root", merkle.fold(F.col("lower")).alias("f")).collect()}
    assert same == {i: i % 3 == 0 for i in range(40)}
