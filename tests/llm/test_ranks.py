import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cartlake.llm.ranks import with_ranks


@pytest.mark.parametrize("hot", [0, 700])
def test_against_sorting(spark, hot):
    rnd = random.Random(hot)
    rows = [("hot", rnd.randrange(10**6), i) for i in range(hot)]
    rows += [(rnd.choice("abc"), rnd.choice([None, *range(40)]), 10_000 + i) for i in range(300)]
    found = with_ranks(spark.createDataFrame(rows, "g string, x int, copy int").repartition(5), ["g"], ["x", "copy"])
    want = defaultdict(list)
    for g, x, c in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2])):
        want[g].append((x, c))
    for r in found.collect():
        assert want[r.g][r.rank] == (r.x, r.copy) and r.n == len(want[r.g])


def test_whole_table_and_ties(spark):
    df = spark.range(100).withColumn("same", F.lit(1))
    assert sorted(r["rank"] for r in with_ranks(df, [], ["same"]).collect()) == list(range(100))
    assert with_ranks(df.where("id < 0"), [], ["id"]).count() == 0


def test_a_hot_group_is_spread(spark):
    df = spark.range(4000).withColumn("g", F.lit("x"))
    ranked = with_ranks(df, ["g"], ["id"])
    held = [spark.read.parquet(f).count() for f in set(ranked.inputFiles())]
    assert len(held) == 4 and max(held) < 2000 and sum(held) == 4000
