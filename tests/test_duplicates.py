import random
from collections import Counter

import pytest
from conftest import final_plan, rows
from pyspark.sql import functions as F

from cartlake.operators import duplicates, joins
from cartlake.operators.duplicates import profile_keys, split_duplicates, survivors
from cartlake.specs import INGESTED_AT

EDGE = [("A", 100), ("A", 101), ("A", 101), ("B", 200), (None, 1), (None, 2)]


def brute_force(data, n_keys=1):
    """First row per key under the total order, and the bag of all other rows."""
    groups = {}
    for row in data:
        groups.setdefault(row[:n_keys], []).append(row)

    def order(row):
        return [(v is not None, v if v is not None else 0) for v in row[n_keys:]]

    kept = [min(g, key=order) for g in groups.values()]
    rejects = Counter(data) - Counter(kept)
    return sorted(kept, key=repr), sorted(rejects.elements(), key=repr)


@pytest.mark.parametrize("profiled", [False, True])
def test_edge_rows(spark, profiled):
    df = spark.createDataFrame(EDGE, "k string, v int")
    profile = profile_keys(df, ["k"]) if profiled else None
    valid, rejects = split_duplicates(df, ["k"], profile=profile)
    assert rows(valid) == [("A", 100), ("B", 200), (None, 1)]
    assert rows(rejects) == [("A", 101), ("A", 101), (None, 2)]


def test_one_reject_per_surplus_copy(spark):
    df = spark.createDataFrame([("A", 100), ("A", 100), ("B", 200)], "order_id string, price bigint")
    valid, rejects = split_duplicates(df, ["order_id"])
    assert (valid.count(), rejects.count()) == (2, 1)


def test_set_mode_is_except_distinct(spark):
    df = spark.createDataFrame(EDGE + [("B", 200)], "k string, v int")
    valid, rejects = split_duplicates(df, ["k"], rejects="set")
    assert rows(rejects) == rows(df.subtract(valid)) == [("A", 101), (None, 2)]


def test_no_keys_and_bad_arguments(spark):
    df = spark.createDataFrame(EDGE, "k string, v int")
    valid, rejects = split_duplicates(df, [])
    assert valid.count() == 6 and rejects.count() == 0 and rejects.schema == df.schema
    with pytest.raises(ValueError, match="no column x"):
        split_duplicates(df, ["x"])
    with pytest.raises(ValueError, match="copies"):
        split_duplicates(df, ["k"], rejects="some")


def test_all_columns_are_keys(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (3, 4)], "a int, b int")
    valid, rejects = split_duplicates(df, ["a", "b"])
    assert rows(valid) == [(1, 2), (3, 4)] and rows(rejects) == [(1, 2)]


def test_newest_load_wins(spark):
    data = [("A", 1, "2024-01-01"), ("A", 9, "2024-01-02"), ("B", 5, "2024-01-01")]
    df = spark.createDataFrame(data, f"k string, v int, {INGESTED_AT} string").withColumn(
        INGESTED_AT, F.to_timestamp(INGESTED_AT)
    )
    valid, rejects = split_duplicates(df, ["k"])
    assert rows(valid, "k", "v") == [("A", 9), ("B", 5)]
    assert rows(rejects, "k", "v") == [("A", 1)]


def test_map_columns(spark):
    df = spark.sql("SELECT * FROM VALUES (1, map('a', 1)), (1, map('b', 1)), (1, map('b', 1)) AS t(k, m)")
    valid, rejects = split_duplicates(df, ["k"])
    assert [r.m for r in valid.collect()] == [{"a": 1}]
    assert [r.m for r in rejects.collect()] == [{"b": 1}, {"b": 1}]


def _random_rows(n, seed):
    rnd = random.Random(seed)
    # A third of the rows share one key, and a third of those are the same row.
    return [
        (
            rnd.choice([7, 7, 7, *range(20), None]),
            rnd.choice([None, 1, 2]),
            rnd.choice([0, 0, 0, 1, 2, None]),
            rnd.choice(["x", "y", None]),
        )
        for _ in range(n)
    ]


@pytest.mark.parametrize("partitions", ["1", "4", "32"])
@pytest.mark.parametrize("profiled", [False, True])
def test_random_rows_against_brute_force(spark, conf, partitions, profiled):
    conf("spark.sql.shuffle.partitions", partitions)
    data = _random_rows(600, seed=1)
    kept, rejected = brute_force([(a, b, c, d) for a, b, c, d in data], n_keys=2)
    random.Random(int(partitions)).shuffle(data)
    df = spark.createDataFrame(data, "a int, b int, c int, d string").repartition(5)
    profile = profile_keys(df, ["a", "b"]) if profiled else None
    valid, rejects = split_duplicates(df, ["a", "b"], profile=profile)
    assert rows(valid) == kept
    assert rows(rejects) == rejected


def test_profiled_split_of_few_repeated_keys(spark):
    """Most rows pass through; heavy repeated keys are cut into slices."""
    data = [(i, 0) for i in range(1000)] + [(3, v) for v in range(120)] + [(4, 1)]
    kept, rejected = brute_force(data)
    df = spark.createDataFrame(data, "k int, v int").repartition(4)
    profile = profile_keys(df, ["k"], slice_rows=10)
    assert (profile.rows, profile.n_repeated, profile.surplus) == (1121, 2, 121)
    assert rows(profile.heavy, "__slices") == [(13,)]
    valid, rejects = split_duplicates(df, ["k"], profile=profile)
    assert rows(valid) == kept and rows(rejects) == rejected


def test_maps_within_lists_and_structs(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, array(map('b', 1))), (1, array(map('a', 1), NULL)), (1, NULL), (2, array()) AS t(k, m)"
    ).withColumn("s", F.struct(F.col("m"), F.map_from_arrays(F.array(F.lit("x")), F.array("m")).alias("n")))
    valid, rejects = split_duplicates(df, ["k"])
    assert [(r.k, r.m) for r in valid.orderBy("k").collect()] == [(1, None), (2, [])]
    assert sorted(str(r.m) for r in rejects.collect()) == ["[{'a': 1}, None]", "[{'b': 1}]"]


def test_scans_of_one_load(spark, tmp_path):
    """Repeated and NULL keys: profile, touched and untouched rows are one scan each."""
    path = str(tmp_path / "t")
    data = [(i, 0) for i in range(100)] + [(3, 1), (4, 1), (None, 1), (None, 2)]
    spark.createDataFrame(data, "k int, v int").write.parquet(path)
    df = spark.read.parquet(path)
    valid, rejects = split_duplicates(df, ["k"], profile=profile_keys(df, ["k"]))
    kept, rejected = brute_force(data)
    assert (rows(valid), rows(rejects)) == (kept, rejected)
    assert final_plan(valid).count(path) == 1
    assert path not in final_plan(rejects)


def test_rows_with_very_many_copies_are_written_in_portions(spark, monkeypatch):
    monkeypatch.setattr(duplicates, "COPIES_PER_TASK", 10)
    data = [("A", 1)] * 97 + [("B", 1)] * 11 + [("C", 1)] * 10
    df = spark.createDataFrame(data, "k string, v int")
    rejects = split_duplicates(df, ["k"])[1]
    assert Counter(r.k for r in rejects.collect()) == {"A": 96, "B": 10, "C": 9}
    sizes = rejects.groupBy(F.spark_partition_id()).count()
    assert sizes.agg(F.max("count")).first()[0] < 97


def test_clean_table_is_not_shuffled(spark):
    df = spark.range(100).withColumn("v", F.lit(1))
    valid, rejects = split_duplicates(df, ["id"], profile=profile_keys(df, ["id"]))
    assert "Exchange" not in final_plan(valid)
    assert rejects.count() == 0


def test_hot_key_shrinks_before_the_shuffle(spark):
    plan = survivors(spark.range(100).selectExpr("id % 3 AS k", "id"), ["k"])._jdf.queryExecution().toString()
    physical = plan.split("== Physical Plan ==")[1]
    assert "row_number(), 1, Partial" in physical


def test_profile_counts_null_keys(spark):
    df = spark.createDataFrame(EDGE, "k string, v int")
    p = profile_keys(df, ["k"])
    assert (p.rows, p.null_key_rows, p.n_repeated, p.surplus) == (6, 2, 2, 3)
    assert p.duplicate_ratio == 0.5
    assert rows(p.repeated) == [("A", 3), (None, 2)]
    single = profile_keys(df.where("v = 1"), ["k"])
    assert (single.n_repeated, rows(single.touched)) == (0, [(None, 1)])
    empty = profile_keys(df.where("false"), ["k"])
    assert (empty.rows, empty.n_repeated, empty.duplicate_ratio) == (0, 0, 0.0)


@pytest.mark.parametrize("many", [0, 100])
def test_profiled_split_ranks_rows_in_bounded_tasks(spark, monkeypatch, many):
    """One shuffle deals all rows of the table, or of few repeated keys; heavy keys go their own way."""
    monkeypatch.setattr(duplicates, "MANY_KEYS", many)
    monkeypatch.setattr(joins, "TASK_ROWS", 50)
    data = [(i % 400, i) for i in range(900)] + [(7, 1)] * 60 + [(None, v) for v in range(4)]
    kept, rejected = brute_force(data)
    df = spark.createDataFrame(data, "k int, v int").repartition(5)
    profile = profile_keys(df, ["k"], slice_rows=50)
    assert profile.n_touched == 401 and rows(profile.heavy, "__slices") == [(2,)]
    valid, rejects = split_duplicates(df, ["k"], profile=profile)
    assert rows(valid) == kept and rows(rejects) == rejected
    plain = profile_keys(df.where("k <> 7"), ["k"])
    valid, rejects = split_duplicates(df.where("k <> 7"), ["k"], profile=plain)
    assert "Exchange" not in final_plan(rejects)
    dealt = joins.dealt(df, ["k"], 964)
    assert dealt.rdd.getNumPartitions() == 20
    assert joins.dealt(df, ["k"], 50).rdd.getNumPartitions() == 5


def test_heavy_rows_are_split_off(spark):
    df = spark.createDataFrame([(1, 1)] * 30 + [(None, 2)] * 25 + [(2, 3)] * 5, "k int, v int")
    hot, light = joins.split_heavy(df, ["k"], profile_keys(df, ["k"], slice_rows=20).heavy)
    assert (rows(hot.distinct()), hot.count()) == ([(1, 1), (None, 2)], 55)
    assert (rows(light.distinct()), light.count()) == ([(2, 3)], 5)
    assert joins.split_heavy(df, ["k"], None) == (None, df)
