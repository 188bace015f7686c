import pytest
from conftest import final_plan, rows
from pyspark.sql import functions as F

from cartlake.operators import joins
from cartlake.operators.joins import heavy_keys, spread_join


@pytest.fixture
def sides(spark):
    """A third of the left rows hold key 7, some hold NULL; the right side has one row per key."""
    left = spark.range(900, numPartitions=6).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 = 1 THEN NULL ELSE id % 40 END AS k", "id AS v"
    )
    right = spark.range(30).selectExpr("id AS k", "id * 10 AS w").unionByName(
        spark.sql("SELECT cast(NULL AS bigint) AS k, cast(-1 AS bigint) AS w")
    )
    return left, right


def test_heavy_keys_are_found(sides):
    left, _ = sides
    hot = left.where("k = 7").select(F.xxhash64("k")).first()[0]
    n = left.where("k = 7").count()
    assert rows(heavy_keys(left, ["k"], slice_rows=100)) == [(hot, -(-n // 100))]
    assert heavy_keys(left, ["k"]) is None
    assert heavy_keys(left.where("false"), ["k"], slice_rows=1) is None


@pytest.mark.parametrize("keys, each, rest", [(400, 5, 98_000), (1500, 3, 0)])
def test_all_heavy_keys_are_found_and_spread(spark, keys, each, rest):
    """400 keys of 1/20,000 of the rows each among single ones, and 1,500 heavy keys."""
    hot = spark.range(keys * each).selectExpr(f"id % {keys} AS k", "id AS v")
    left = hot.unionByName(spark.range(rest).selectExpr(f"id + {keys} AS k", "id AS v")).repartition(4)
    heavy = heavy_keys(left, ["k"], slice_rows=each - 1)
    assert heavy.count() == keys and rows(heavy.select("__slices").distinct()) == [(2,)]
    right = spark.range(keys + rest).selectExpr("id AS k", "-id AS w")
    assert spread_join(left, right, ["k"], "inner", heavy).where("k = -w").count() == keys * each + rest


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_same_rows_as_a_plain_join(sides, how, null_safe):
    left, right = sides
    heavy = heavy_keys(left, ["k"], slice_rows=15)
    assert heavy.count() > 1
    on = left["k"].eqNullSafe(right["k"]) if null_safe else left["k"] == right["k"]
    plain = left.join(right, on, how).select(left["k"], "v", *(["w"] if how in ("inner", "left") else []))
    for found in (heavy, None):
        spread = spread_join(left, right, ["k"], how, found, null_safe)
        assert spread.columns == plain.columns
        assert rows(spread) == rows(plain)


def test_hot_key_is_spread_over_partitions(spark, conf, sides):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.shuffle.partitions", "16")
    left, right = sides

    def largest(heavy):
        joined = spread_join(left, right, ["k"], "inner", heavy)
        return joined.where("k = 7").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

    assert largest(None) == left.where("k = 7").count() > 300
    assert largest(heavy_keys(left, ["k"], slice_rows=20)) < 100


def test_identical_rows_of_a_hot_key_are_spread(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    left = spark.range(800, numPartitions=8).selectExpr("1 AS k", "2 AS v")
    right = spark.sql("SELECT 1 AS k, 3 AS w")
    joined = spread_join(left, right, ["k"], "inner", heavy_keys(left, ["k"], slice_rows=50))
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 800 and len(sizes) > 1


def test_only_supported_joins(sides):
    with pytest.raises(ValueError, match="full"):
        spread_join(*sides, ["k"], "full")


def test_plain_plan_without_heavy_keys(sides):
    left, right = sides
    plan = final_plan(spread_join(left, right, ["k"]))
    assert "__slice" not in plan and plan.count("Join") == 1


def test_map_columns_are_carried_along(spark):
    left = spark.range(100, numPartitions=4).selectExpr("1 AS k", "map('id', id) AS m")
    right = spark.sql("SELECT 1 AS k, 2 AS w")
    joined = spread_join(left, right, ["k"], "inner", heavy_keys(left, ["k"], slice_rows=9))
    assert sorted(r.m["id"] for r in joined.collect()) == list(range(100))


def test_tasks_of_a_join_get_a_bounded_share(spark, conf, monkeypatch):
    """However few the session's tasks are, and however small the rows when they are shuffled."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(joins, "TASK_ROWS", 100)
    left = spark.range(2000).selectExpr("id div 2 AS k", "id AS v")
    right = spark.range(900).selectExpr("id AS k", "-id AS w")
    heavy, n = joins.key_load(left, ["k"])
    assert (heavy, n) == (None, 2000)
    joined = spread_join(left, right, ["k"], "inner", heavy, rows=n)
    sizes = joined.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
    assert sizes[0] < 200 and sizes[1] == 1800


def test_key_load_moves_keys_and_not_their_hashes(spark, conf):
    """Keys that follow each other take less room in a shuffle than hashes, and one hash is one entry."""
    seen = []
    real = joins.materialize

    def watched(df, *args, **kwargs):
        seen.append(df)
        return real(df, *args, **kwargs)

    joins.materialize = watched
    try:
        left = spark.range(2000).selectExpr("id div 2 AS k", "CASE WHEN id % 2 = 0 THEN id END AS v")
        heavy, n = joins.key_load(left, ["k", "v"], slice_rows=0)
    finally:
        joins.materialize = real
    assert n == 2000 and heavy.count() == 2000
    assert seen[0].columns == ["k", "v", "n"]
