import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cartlake.llm import conversation_trie as ct
from cartlake.sources.scratch import materialize

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def rebuilt(rows):
    by = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            by[c].append((t is not None, t or 0, digest(role, text), role, text))
    by = {c: [x[3:] for x in sorted(v)] for c, v in by.items()}
    out = {}
    for c, own in by.items():
        h = zlib.crc32(str(c).encode()) % ct.HEADS
        # Remainders have the sign of the id.
        base = int(c / ct.BLOCK) * ct.BLOCK
        out[c] = by.get(base, [])[:h] + own[h:]
    return out


def plainly(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids, leaves, saved = Counter(p[:-1] for p in members if p), Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p))
        above = min(members[p[:-1]]) if p else None
        end = hashlib.sha256(ends.encode()).hexdigest()
        yield len(p), min(m), above, len(m), kids[p], leaves[p], saved[p], end


def found(spark, rows, shard=ct.SHARD, segment=ct.SEGMENT):
    turns, convs = ct.rebuild(ct.order_turns(spark.createDataFrame(rows, SCHEMA)))
    nodes, _ = ct.trie(turns, materialize(convs, "convs")[0], shard, segment)
    return Counter(map(tuple, nodes.drop("k1", "k2").collect()))


def random_rows(seed, convs, length, texts, step=1):
    rnd = random.Random(seed)
    return [
        (c * step, t, rnd.choice(["user", "bot"]), rnd.choice(texts))
        for c in range(convs)
        for t in range(rnd.choice([1, 2, length]))
    ]


@pytest.mark.parametrize("shard, segment", [(2048, 64), (7, 4), (1, 1), (50, 2)])
def test_against_a_plain_trie(spark, shard, segment):
    rows = random_rows(shard, 230, 9, ["a", "b", "", "häß🎉"], 3)
    assert found(spark, rows, shard, segment) == Counter(plainly(rebuilt(rows)))


def test_long_conversations_and_many_copies(spark):
    long = [(c, t, "user", f"{t % 7}") for c in (0, 1, 2, 150) for t in range(300 - c)]
    copies = [(c, t, "user", "same") for c in range(1000, 1300) for t in range(3)]
    rows = long + copies
    want = Counter(plainly(rebuilt(rows)))
    assert found(spark, rows, 64, 16) == want and max(w[3] for w in want) == 304


def test_edges(spark):
    rows = [
        (0, 1, None, "x"),
        (0, None, "user", None),
        (0, None, "user", None),
        (0, 1, None, "x"),
        (0, 0, "", ""),
        (None, 0, "user", "belongs to none"),
        (None, None, None, None),
        (-5, 0, "user", "long " * 50_000),
        (-105, 3, "user", "x"),
        (205, 0, "user", "its block has no first conversation"),
        (2**62, 0, "a", "b"),
    ]
    assert found(spark, rows) == Counter(plainly(rebuilt(rows)))
    assert not found(spark, rows[:0]) and not found(spark, rows[5:7])
    assert found(spark, rows[-1:]) == Counter(plainly(rebuilt(rows[-1:])))


def test_end_lists(spark):
    rows = [(c, 0, "u", "x") for c in range(300)]
    ordered = ct.order_turns(spark.createDataFrame(rows, SCHEMA).withColumn("n", F.lit("old")))
    turns = ordered.select("conv_id", F.col("rank").alias("pos"), "digest", "chars")
    _, ends = ct.trie(turns, ordered.select("conv_id", "n"), shard=100)
    listed = [r.ends for r in ends.orderBy("shard").collect()]
    assert ",".join(listed) == ",".join(map(str, range(300))) and len(listed) == 3
    with pytest.raises(ValueError):
        ct.trie(turns, ordered.select("conv_id", "n"), shard=0)
