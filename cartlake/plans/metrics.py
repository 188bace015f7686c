"""Dashboard metrics.

They give the numbers of the same aggregates over the wide sales view, but join only the
dimension they need, and only after the fact is summed up per dimension key. A product
with a third of all sales is then one row per task before anything is shuffled. That
rests on dimension keys being unique, which the silver layer sees to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlake.functions.dates import is_weekend, month_start
from cartlake.functions.exact import exact_sum, merge_parts, part_names, sum_parts, total
from cartlake.plans.gold import Star


def _top(df: DataFrame, metric: str, key: str, n: int) -> DataFrame:
    return df.orderBy(F.desc(metric), F.asc_nulls_first(key)).limit(n)


def _revenue_by(sales: DataFrame, dimension: DataFrame, key: str, group: str) -> DataFrame:
    per_key = sales.groupBy(key).agg(*sum_parts(sales, "price", "revenue"))
    return (
        per_key.join(dimension.select(key, group), key, "left")
        .groupBy(group)
        .agg(*merge_parts("revenue"))
        .select(group, total("revenue").alias("revenue"))
    )


def kpi_revenue(star: Star) -> DataFrame:
    sales = star.fact_order_sales
    return sales.agg(exact_sum(sales, "price").alias("revenue"))


def kpi_orders(star: Star) -> DataFrame:
    return star.fact_order_sales.agg(F.countDistinct("order_id").alias("orders"))


def kpi_customers(star: Star) -> DataFrame:
    people = star.dim_customers.select("customer_id", "customer_unique_id")
    return (
        star.fact_order_sales.select("customer_id")
        .distinct()
        .join(people, "customer_id")
        .agg(F.countDistinct("customer_unique_id").alias("customers"))
    )


def top_categories(star: Star, n: int = 10) -> DataFrame:
    revenue = _revenue_by(star.fact_order_sales, star.dim_products, "product_id", "product_category_name")
    return _top(revenue, "revenue", "product_category_name", n)


def top_seller_cities(star: Star, n: int = 10) -> DataFrame:
    revenue = _revenue_by(star.fact_order_sales, star.dim_sellers, "seller_id", "seller_city")
    return _top(revenue, "revenue", "seller_city", n)


def freight_by_state(star: Star, n: int = 15) -> DataFrame:
    """Mean freight per item, by state of the customer."""
    sales = star.fact_order_sales
    per_customer = sales.groupBy("customer_id").agg(
        *sum_parts(sales, "freight_value", "freight"), F.count("freight_value").alias("items")
    )
    mean = total("freight") / F.nullif("items", F.lit(0))
    by_state = (
        per_customer.join(star.dim_customers.select("customer_id", "customer_state"), "customer_id", "left")
        .groupBy("customer_state")
        .agg(*merge_parts("freight"), F.sum("items").alias("items"))
        .select("customer_state", mean.alias("avg_freight"))
    )
    return _top(by_state, "avg_freight", "customer_state", n)


def monthly_revenue(star: Star) -> DataFrame:
    sales = star.fact_order_sales
    month = month_start("order_purchase_timestamp").alias("month_start")
    revenue = exact_sum(sales, "price").alias("revenue")
    return sales.groupBy(month).agg(revenue).orderBy("month_start")


def order_status_share(star: Star) -> DataFrame:
    return star.fact_order_sales.groupBy("order_status").agg(F.countDistinct("order_id").alias("orders"))


def payment_types(star: Star) -> DataFrame:
    return star.fact_order_payments.groupBy("payment_type").agg(F.count("order_id").alias("payments"))


def installment_histogram(star: Star) -> DataFrame:
    return star.fact_order_payments.groupBy("payment_installments").agg(F.count("order_id").alias("payments"))


def delivery_performance(star: Star) -> DataFrame:
    """Delivered orders, late ones and the share on time, by month of purchase."""
    delivered, estimated = F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
    orders = (
        star.fact_order_sales.where(delivered.isNotNull() & estimated.isNotNull())
        .select(
            "order_id",
            month_start("order_purchase_timestamp").alias("month_start"),
            (delivered <= estimated).alias("on_time"),
        )
        .distinct()
    )
    return (
        orders.groupBy("month_start")
        .agg(
            F.count(F.lit(1)).alias("delivered_orders"),
            F.count_if(~F.col("on_time")).alias("late_orders"),
            F.avg(F.col("on_time").cast("double")).alias("on_time_share"),
        )
        .orderBy("month_start")
    )


def _by_calendar(fact: DataFrame, days: DataFrame, amount: str, alias: str, rows: str) -> DataFrame:
    """Amount and rows by year, quarter and weekend. Every row of the fact counts: a day that the
    date dimension lacks gets its parts from the date, and rows without a date are a group."""
    per_day = fact.groupBy(F.to_date("order_purchase_timestamp").alias("date_sk")).agg(
        *sum_parts(fact, amount, alias), F.count(F.lit(1)).alias(rows)
    )
    parts = {"year": F.year("date_sk"), "quarter": F.quarter("date_sk"), "is_weekend": is_weekend("date_sk")}
    known = days.select("date_sk", *(F.col(p).alias(f"known_{p}") for p in parts))
    return (
        per_day.join(known, "date_sk", "left")
        .select(
            *(F.coalesce(f"known_{p}", own).alias(p) for p, own in parts.items()), *part_names(alias), rows
        )
        .groupBy(*parts)
        .agg(*merge_parts(alias), F.sum(rows).alias(rows))
        .select(*parts, total(alias).alias(alias), rows)
    )


def sales_by_calendar(star: Star) -> DataFrame:
    """Revenue and items by year, quarter and weekend."""
    return _by_calendar(star.fact_order_sales, star.dim_dates, "price", "revenue", "items")


def payments_by_calendar(star: Star) -> DataFrame:
    """Paid amount and payments by year, quarter and weekend of the purchase."""
    return _by_calendar(star.fact_order_payments, star.dim_dates, "payment_value", "paid", "payments")


def payments_by_customer_state(star: Star) -> DataFrame:
    """Paid amount and payments by state of the customer."""
    paid = star.fact_order_payments
    per_customer = paid.groupBy("customer_id").agg(
        *sum_parts(paid, "payment_value", "paid"), F.count(F.lit(1)).alias("payments")
    )
    return (
        per_customer.join(star.dim_customers.select("customer_id", "customer_state"), "customer_id", "left")
        .groupBy("customer_state")
        .agg(*merge_parts("paid"), F.sum("payments").alias("payments"))
        .select("customer_state", total("paid").alias("paid"), "payments")
    )
