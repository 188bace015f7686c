"""The nine retail tables, derived from the given test tables.

``SQL`` in ``checks.oracles`` states the same mapping for the oracle.
"""

from __future__ import annotations

import datetime as dt
from functools import cache, cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartlake.operators.columns import with_partition_columns
from cartlake.operators.joins import key_load
from cartlake.plans import gold
from cartlake.sources.scratch import materialize

# Covers all order dates of the test tables.
FIRST_DATE = dt.date(1995, 1, 1)
LAST_DATE = dt.date(2001, 12, 31)

_ZIP = "lpad(cast({} as string), 5, '0')"


@cache
def _schema(spark: SparkSession, path: str) -> StructType:
    return spark.read.parquet(path).schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_schema(spark, path)).parquet(path)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders; the delivery date is the last ship date and the promise is 60 days."""
    delivered = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.max("l_shipdate").alias("delivered"))
    )
    return (
        table(spark, sf_dir, "orders")
        .join(delivered, "o_orderkey", "left")
        .selectExpr(
            "o_orderkey AS order_id",
            "o_custkey AS customer_id",
            "o_orderstatus AS order_status",
            "o_orderdate AS order_purchase_timestamp",
            "o_orderdate AS order_approved_at",
            "delivered AS order_delivered_customer_date",
            "o_orderdate + interval 60 days AS order_estimated_delivery_date",
        )
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items; lineitem repeats (order, line) keys, so there are duplicates to find."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS order_id",
        "l_linenumber AS order_item_id",
        "l_partkey AS product_id",
        "l_suppkey AS seller_id",
        "cast(l_extendedprice AS decimal(18,2)) AS price",
        "cast(l_quantity AS decimal(18,2)) AS freight_value",
    )


def order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id div 3 AS order_id",
        "cast(event_id % 3 + 1 AS int) AS payment_sequential",
        "event_type AS payment_type",
        "cast(get_json_object(props, '$.k') AS int) AS payment_installments",
        "cast(value AS decimal(18,2)) AS payment_value",
    )


def order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS review_id",
        "event_id div 3 AS order_id",
        "cast(floor(value) AS int) % 5 + 1 AS review_score",
        "ts AS review_creation_date",
    )


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region")
    nation = table(spark, sf_dir, "nation")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "customer").join(
        _nations(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    return joined.selectExpr(
        "c_custkey AS customer_id",
        "c_custkey div 2 AS customer_unique_id",
        f"{_ZIP.format('c_nationkey')} AS customer_zip_code_prefix",
        "n_name AS customer_city",
        "r_name AS customer_state",
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "supplier").join(
        _nations(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"), "left"
    )
    return joined.selectExpr(
        "s_suppkey AS seller_id",
        f"{_ZIP.format('s_nationkey')} AS seller_zip_code_prefix",
        "n_name AS seller_city",
        "r_name AS seller_state",
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS product_id",
        "p_brand || ' ' || p_type AS product_category_name",
        "length(p_name) AS product_name_lenght",
        "length(p_brand) AS product_description_lenght",
        "p_size AS product_photos_qty",
        "p_retailprice AS product_weight_g",
        "cast(p_size AS double) AS product_length_cm",
        "p_size * 2.0D AS product_height_cm",
        "p_size / 2 AS product_width_cm",
    )


def category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lower-cased names of all categories but the PROMO ones, which stay untranslated."""
    return (
        products(spark, sf_dir)
        .select("product_category_name")
        .distinct()
        .where("product_category_name NOT LIKE '%PROMO'")
        .withColumn("product_category_name_english", F.lower("product_category_name"))
    )


def geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as places: many per zip prefix, with several spellings of the city."""
    joined = table(spark, sf_dir, "customer").join(
        _nations(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    return joined.selectExpr(
        f"{_ZIP.format('c_nationkey')} AS geolocation_zip_code_prefix",
        "c_acctbal AS geolocation_lat",
        "cast(c_custkey AS double) AS geolocation_lng",
        "c_mktsegment AS geolocation_city",
        "r_name AS geolocation_state",
    )


TABLES = {
    "customers": customers,
    "orders": orders,
    "order_items": order_items,
    "order_payments": order_payments,
    "order_reviews": order_reviews,
    "products": products,
    "sellers": sellers,
    "geolocation": geolocation,
    "category_translation": category_translation,
}


def dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_partition_columns(orders(spark, sf_dir), "order_purchase_timestamp")


@cache
def written_star(spark: SparkSession, sf_dir: str) -> gold.Star:
    """The star schema over the test tables, written once for all queries that read it."""
    star = StandInStar(spark, sf_dir)
    return gold.Star(*(materialize(getattr(star, name), name)[0] for name in gold.Star._fields))


class StandInStar:
    """The star schema over the test tables; a table is built when it is asked for.

    ``items`` replace the raw order items; they must be some of them.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, items: DataFrame | None = None):
        self._args = (spark, sf_dir)
        self._items = items

    def _t(self, name: str) -> DataFrame:
        return TABLES[name](*self._args)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return gold.dim_customers(self._t("customers"))

    @cached_property
    def dim_sellers(self) -> DataFrame:
        return gold.dim_sellers(self._t("sellers"))

    @cached_property
    def dim_products(self) -> DataFrame:
        return gold.dim_products(self._t("products"), self._t("category_translation"))

    @cached_property
    def dim_geolocation(self) -> DataFrame:
        return gold.dim_geolocation(self._t("geolocation"))

    @cached_property
    def dim_dates(self) -> DataFrame:
        return gold.dim_dates(self._args[0], FIRST_DATE, LAST_DATE)

    @cached_property
    def fact_order_payments(self) -> DataFrame:
        payments = self._t("order_payments")
        return gold.fact_order_payments(dated_orders(*self._args), payments, *key_load(payments, ["order_id"]))

    @cached_property
    def fact_order_sales(self) -> DataFrame:
        raw = self._t("order_items")
        items = raw if self._items is None else self._items
        load = key_load(raw, ["order_id"])
        return gold.fact_order_sales(items, dated_orders(*self._args), self._t("order_reviews"), *load)
