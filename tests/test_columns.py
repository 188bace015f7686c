import datetime as dt
import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cartlake.functions.exact import exact_mean, exact_sum, merge_parts, sum_parts, total
from cartlake.functions.names import clean_name
from cartlake.operators.columns import (
    between_dates,
    cast_timestamp,
    empty_like,
    require_columns,
    sanitize_columns,
    split_bad_timestamps,
    stamp_ingested,
    stamp_updated,
    with_partition_columns,
)
from cartlake.operators.nulls import split_nulls


@pytest.mark.parametrize(
    "name, clean",
    [("Order ID", "order_id"), (" A--b! ", "a_b"), ("Şehir", "ehir"), ("__x__", "x"), ("a1B2", "a1b2"), ("***", "")],
)
def test_clean_name(name, clean):
    assert clean_name(name) == clean


def test_sanitize_columns(spark):
    df = spark.range(1).select(F.lit(1).alias("Order ID"), F.lit(2).alias(" A--b! "), F.lit(3).alias("a.c"))
    assert rows(sanitize_columns(df), "order_id", "a_b", "a_c") == [(1, 2, 3)]


def test_sanitize_refuses_collisions_and_empty_names(spark):
    one = F.lit(1)
    with pytest.raises(ValueError, match="collide.*order_id"):
        sanitize_columns(spark.range(1).select(one.alias("Order ID"), one.alias("order_id")))
    with pytest.raises(ValueError, match="no letters"):
        sanitize_columns(spark.range(1).select(one.alias("***")))


def test_stamps_are_added_or_replaced(spark):
    df = stamp_updated(stamp_ingested(spark.range(2)))
    assert df.columns == ["id", "_ingested_at", "_updated_at"]
    assert stamp_updated(df).columns == df.columns
    assert df.where("_ingested_at IS NULL OR _updated_at IS NULL").count() == 0


def test_cast_timestamp(spark):
    df = spark.createDataFrame([("2017-10-02 10:56:33",), ("bad",), ("",), (None,)], "ts string")
    stamp = dt.datetime(2017, 10, 2, 10, 56, 33)
    assert sorted(r.ts == stamp for r in cast_timestamp(df, "ts").collect()) == [False, False, False, True]
    good, bad = split_bad_timestamps(df, "ts")
    assert rows(bad) == [("",), ("bad",)]
    assert good.count() == 2
    with pytest.raises(ValueError, match="no column when"):
        cast_timestamp(df, "when")


def test_partition_columns_of_null_are_null(spark):
    df = spark.sql("SELECT * FROM VALUES (timestamp_ntz '2018-02-03 00:00:00'), (NULL) AS t(ts)")
    assert rows(with_partition_columns(df, "ts"), "year", "month") == [(2018, 2), (None, None)]
    assert with_partition_columns(df, "ts", ["year"]).columns == ["ts", "year"]


def test_between_dates_is_the_timestamp_range(spark):
    days = spark.sql(
        "SELECT explode(sequence(date'2015-11-01', date'2018-03-01', interval 1 day)) AS d"
    ).selectExpr("cast(d AS timestamp_ntz) + interval 23 hours AS ts")
    df = with_partition_columns(days, "ts")
    for first, last in [
        (dt.date(2016, 2, 10), dt.date(2016, 2, 20)),
        (dt.date(2015, 12, 31), dt.date(2016, 1, 1)),
        (dt.date(2016, 11, 5), dt.date(2018, 2, 28)),
    ]:
        assert between_dates(df, first, last, "ts").count() == (last - first).days + 1
    with pytest.raises(ValueError):
        between_dates(df, dt.date(2016, 2, 2), dt.date(2016, 2, 1), "ts")


def test_empty_like_and_require(spark):
    df = spark.range(3)
    assert empty_like(df).count() == 0 and empty_like(df).schema == df.schema
    with pytest.raises(ValueError, match="input has no column a, b; it has id"):
        require_columns(df, ["a", "b", "id"])


def test_null_split(spark):
    df = spark.createDataFrame([("C1", "x"), (None, "y"), ("C3", "z")], "customer_id string, city string")
    valid, rejects = split_nulls(df, ["customer_id"])
    assert (valid.count(), rows(rejects)) == (2, [(None, "y")])


def test_null_split_on_any_of_two_keys(spark):
    data = [("a", 1), (None, 1), ("a", None), (None, None)]
    valid, rejects = split_nulls(spark.createDataFrame(data, "k string, n int"), ["k", "n"])
    assert rows(valid) == [("a", 1)] and rejects.count() == 3


def test_null_split_without_keys(spark):
    valid, rejects = split_nulls(spark.range(3), [])
    assert valid.count() == 3 and rejects.count() == 0


def test_exact_sums_do_not_depend_on_order(spark):
    values = [0.1, 0.2, 0.3, 1e9, -1e9, 0.7] * 50
    df = spark.createDataFrame([(v,) for v in values], "x double")

    def totals(df):
        return tuple(df.agg(exact_sum(df, "x"), exact_mean(df, "x")).first())

    assert {totals(df.repartition(n)) for n in (1, 3, 7)} == {(65.0, 65.0 / 300)}


@pytest.mark.parametrize("kind, mean", [("int", 1.5), ("decimal(18,2)", 1.5), ("double", 1.5), ("string", 1.5)])
def test_exact_mean_of_each_type(spark, kind, mean):
    df = spark.sql("SELECT * FROM VALUES ('1'), ('2'), (NULL) AS t(x)").select(F.col("x").cast(kind))
    assert df.agg(exact_mean(df, "x")).first()[0] == mean
    empty = df.where("x IS NULL")
    assert empty.agg(exact_mean(empty, "x")).first()[0] is None


def test_text_that_is_no_number_has_no_part(spark):
    text = spark.sql("SELECT * FROM VALUES ('1'), ('?'), ('2.125') AS t(x)")
    assert text.agg(exact_sum(text, "x"), exact_mean(text, "x")).first()[:] == (3.125, 3.125 / 2)


@pytest.mark.parametrize("odd", [1e19, 1.5e-12, float("inf"), 1 / 3])
def test_doubles_that_no_decimal_holds_are_summed_plainly(spark, odd):
    df = spark.createDataFrame([(1, 1.0), (1, odd), (2, 0.1), (2, 0.2)], "k int, x double")
    assert rows(df.groupBy("k").agg(exact_sum(df, "x"))) == [(1, 1.0 + odd), (2, 0.3)]
    parts = df.groupBy("k").agg(*sum_parts(df, "x", "s"))
    assert rows(parts.select("k", total("s"))) == [(1, 1.0 + odd), (2, 0.3)]
    merged = parts.agg(*merge_parts("s")).select(total("s")).first()[0]
    assert merged == df.agg(F.sum("x")).first()[0] or abs(merged - (1.3 + odd)) < 1e-9


def test_nan_shows_in_sums(spark):
    df = spark.createDataFrame([(1.0,), (1e19,), (float("nan"),)], "x double")
    assert math.isnan(df.agg(exact_sum(df, "x")).first()[0])
    assert math.isnan(df.agg(exact_mean(df, "x")).first()[0])
