"""Registered queries: each takes ``(spark, sf_dir)`` and reads whole test tables.

Results leave out load times and turn money into doubles, so they compare with SQL.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlake.functions.exact import exact_sum
from cartlake.operators.columns import (
    between_dates,
    cast_timestamp,
    empty_like,
    require_columns,
    sanitize_columns,
    stamp_ingested,
    stamp_updated,
    with_partition_columns,
)
from cartlake.operators.duplicates import profile_keys, split_duplicates
from cartlake.operators.joins import key_load
from cartlake.operators.nulls import split_nulls
from cartlake.operators.quality import duplicate_ratio, null_ratios, quality_gate
from cartlake.plans import bronze, gold, medallion, metrics, silver, views
from cartlake.sources.audit import latest_runs, load_runs
from cartlake.sources.csv import raw_line_audit, read_csv_inferred, read_csv_typed, split_corrupt
from cartlake.sources.scratch import scratch_path, scratch_root
from cartlake.sources.tables import dlq_records, ensure_namespace, write_dlq, write_table
from cartlake.specs import (
    CORRUPT_RECORD,
    DLQ_REASON,
    DLQ_TIMESTAMP,
    INGESTED_AT,
    LOAD_ID,
    MONEY,
    NULL_KEY,
    UPDATED_AT,
    Layers,
    QualityThresholds,
    TableSpec,
    retail_specs,
)
from checks import standin

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ITEM_KEYS = ("order_id", "order_item_id")
# Rows of one raw file.
RAW_ROWS = 500_000


def _register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def _plain(df: DataFrame) -> DataFrame:
    """Without load times, money as double, timestamps without zone."""
    df = df.drop(INGESTED_AT, UPDATED_AT, DLQ_TIMESTAMP)
    casts = {T.DecimalType: "double", T.TimestampType: "timestamp_ntz"}
    return df.select(
        *(
            F.col(f.name).cast(casts[type(f.dataType)]).alias(f.name) if type(f.dataType) in casts else F.col(f.name)
            for f in df.schema.fields
        )
    )


def _layers(spark: SparkSession) -> Layers:
    """Fresh namespaces below the shared working folder."""
    return Layers.prefixed(f"check_{uuid.uuid4().hex[:12]}", f"{scratch_root(spark)}/cartlake")


def _fresh_table(spark: SparkSession) -> str:
    layers = _layers(spark)
    ensure_namespace(spark, layers.silver, layers.location)
    return f"{layers.silver}.t"


# --- sources and sinks -------------------------------------------------------


@_register
def inferred_type_drift(spark, sf_dir):
    """Three loads of a table with guessed types, whose cells fit the guesses of earlier loads less and less."""
    root, layers = scratch_path(spark, "drift"), _layers(spark)
    spec = TableSpec("customers", "customers.csv")
    source = standin.table(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string")
    zips = (key, F.concat(F.lit("A"), key), F.lpad(key, 9, "0"))
    limits = (key, F.concat(key, F.lit(".5")), F.lit(None).cast("string"))
    since = (F.lit("2020-01-02"), F.lit("2020-01-02 03:04:05"), F.lit("2020-01-03"))
    for turn, (zip_code, limit, day) in enumerate(zip(zips, limits, since)):
        rows = source.where(F.col("c_custkey") % 3 == turn).select(
            "c_custkey", zip_code.alias("zip"), limit.alias("limit"), day.alias("since")
        )
        rows.write.mode("append").csv(f"{root}/customers.csv", header=True)
        medallion.run_bronze(spark, root, [spec], layers, skip_loaded=True, by_load=True)
    landed = spark.table(f"{layers.bronze}.customers")
    notes = load_runs(spark, medallion.audit_table(layers)).select(
        F.array_join(F.sort_array(F.collect_list("message")), " | ").alias("widened")
    )
    # One row of run records, of which the driver made three.
    landed = landed.withColumn("widened", F.lit(notes.first().widened))
    return landed.select(
        F.col("c_custkey").cast("bigint"), "zip", "limit", F.col("since").cast("timestamp_ntz"), "widened"
    )


@_register
def csv_source_typed(spark, sf_dir):
    source = standin.table(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders-csv")
    source.write.csv(path, header=True, escape='"')
    types = {f.name: f.dataType for f in source.schema.fields}
    return split_corrupt(read_csv_typed(spark, path, types))[0]


@_register
def csv_source_inferred(spark, sf_dir):
    path = scratch_path(spark, "orders-csv")
    standin.table(spark, sf_dir, "orders").write.csv(path, header=True, escape='"')
    df = read_csv_inferred(spark, path)
    return _plain(df.withColumns({c: F.col(c).cast("bigint") for c in ("o_orderkey", "o_custkey")}))


@_register
def csv_corrupt_rows(spark, sf_dir):
    """Pending orders get a customer that is no number."""
    path = scratch_path(spark, "orders-csv")
    standin.table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE cast(o_custkey AS string) END AS o_custkey",
        "o_orderpriority",
    ).write.csv(path, header=True, escape='"')
    types = {"o_orderkey": T.LongType(), "o_custkey": T.LongType(), "o_orderpriority": T.StringType()}
    corrupt = split_corrupt(read_csv_typed(spark, path, types))[1]
    return corrupt.select("o_orderkey", F.col(CORRUPT_RECORD).alias("record"))


@_register
def raw_line_audit_report(spark, sf_dir):
    """Customers match, orders are said to have one line more, suppliers have no file.

    The folder has a blank in its name, and a file that nobody asks for.
    """
    root = scratch_path(spark, "raw files")
    expected = {}
    for name, extra in (("customer", 0), ("orders", 1), ("supplier", 0), ("part", 0)):
        df = standin.table(spark, sf_dir, name)
        if name != "supplier":
            df.write.csv(f"{root}/{name}.csv", escape='"')
        if name != "part":
            expected[f"{name}.csv"] = df.count() + extra
    return raw_line_audit(spark, root, expected)


@_register
def csv_column_orders(spark, sf_dir):
    """Two files with the same columns in another order, read by name."""
    root = scratch_path(spark, "orders-csv")
    orders = standin.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    even = F.col("o_orderkey") % 2 == 0
    orders.where(even).write.csv(f"{root}/a", header=True)
    orders.where(~even).select("o_orderstatus", "o_custkey", "o_orderkey").write.csv(f"{root}/b", header=True)
    types = {"o_orderkey": T.LongType(), "o_custkey": T.LongType(), "o_orderstatus": T.StringType()}
    df = read_csv_typed(spark, [f"{root}/a", f"{root}/b"], types, mixed_headers=True)
    return split_corrupt(df)[0]


@_register
def csv_decimal_places(spark, sf_dir):
    """Prices of pending orders have a third place, which money cannot hold."""
    path = scratch_path(spark, "orders-csv")
    standin.table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "CASE WHEN o_orderstatus = 'P' THEN '1.005' ELSE '2.50' END AS price"
    ).write.csv(path, header=True)
    df = read_csv_typed(spark, path, {"o_orderkey": T.LongType(), "price": MONEY})
    return df.select("o_orderkey", F.col("price").cast("double").alias("price"), F.col(CORRUPT_RECORD).alias("record"))


@_register
def bronze_keeps_bad_timestamps(spark, sf_dir):
    """Orders with a malformed purchase or approval time reach silver, with NULL in its place."""
    root, layers = scratch_path(spark, "raw"), _layers(spark)
    standin.orders(spark, sf_dir).selectExpr(
        "order_id",
        "CASE WHEN order_status = 'P' THEN 'then' ELSE cast(order_purchase_timestamp AS string) END"
        " AS order_purchase_timestamp",
        "CASE WHEN order_status = 'F' THEN 'now?' ELSE cast(order_approved_at AS string) END AS order_approved_at",
    ).write.csv(f"{root}/orders.csv", header=True)
    at = {n: T.TimestampNTZType() for n in ("order_purchase_timestamp", "order_approved_at")}
    spec = TableSpec(
        "orders", "orders.csv", ("order_id",), "order_purchase_timestamp", types={"order_id": T.LongType(), **at}
    )
    bronze.load(spark, spec, root, layers)
    silver.load(spark, spec, layers)
    return _plain(spark.table(f"{layers.silver}.orders"))


@_register
def bronze_append(spark, sf_dir):
    """Two loads of the same raw files: every row twice."""
    spec, root, layers = _raw_customers(spark, sf_dir)
    bronze.load(spark, spec, root, layers)
    bronze.load(spark, spec, root, layers)
    return _plain(spark.table(f"{layers.bronze}.customers"))


@_register
def bronze_skip_loaded(spark, sf_dir):
    """The second load finds no new files."""
    spec, root, layers = _raw_customers(spark, sf_dir)
    bronze.load(spark, spec, root, layers, skip_loaded=True)
    bronze.load(spark, spec, root, layers, skip_loaded=True)
    return _plain(spark.table(f"{layers.bronze}.customers"))


def _raw_customers(spark, sf_dir):
    root = scratch_path(spark, "raw")
    df = standin.customers(spark, sf_dir)
    df.write.csv(f"{root}/customers.csv", header=True, escape='"')
    types = {f.name: f.dataType for f in df.schema.fields}
    return TableSpec("customers", "customers.csv", ("customer_id",), types=types), root, _layers(spark)


@_register
def overwrite_table(spark, sf_dir):
    """A second full write replaces the first."""
    name = _fresh_table(spark)
    orders = standin.table(spark, sf_dir, "orders")
    write_table(orders.withColumn("o_totalprice", -F.col("o_totalprice")), name)
    write_table(orders, name)
    return spark.table(name)


def _partitioned_orders(spark, sf_dir) -> str:
    name = _fresh_table(spark)
    orders = with_partition_columns(standin.table(spark, sf_dir, "orders"), "o_orderdate")
    write_table(orders, name, partition_by=("year", "month"), sort_by=("o_orderdate",))
    return name


@_register
def partitioned_overwrite(spark, sf_dir):
    return spark.table(_partitioned_orders(spark, sf_dir))


@_register
def partition_pruned_range(spark, sf_dir):
    df = spark.table(_partitioned_orders(spark, sf_dir))
    return between_dates(df, dt.date(1996, 3, 15), dt.date(1997, 2, 10), "o_orderdate")


@_register
def partition_range_of_another_zone(spark, sf_dir):
    """Partitions made from instants of another time zone; the range is that of the session."""
    name = _fresh_table(spark)
    orders = standin.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    at = F.to_utc_timestamp("o_orderdate", "UTC")
    away = F.from_utc_timestamp(at, "America/Sao_Paulo")
    parts = {"year": F.year(away), "month": F.month(away)}
    write_table(orders.withColumns(parts), name, partition_by=("year", "month"))
    found = between_dates(spark.table(name), dt.date(1997, 3, 1), dt.date(1997, 4, 30), "o_orderdate")
    return found.select("o_orderkey", "o_orderdate")


@_register
def dynamic_partition_overwrite(spark, sf_dir):
    """The partitions of 1996 are replaced, the other years stay."""
    name = _partitioned_orders(spark, sf_dir)
    orders = with_partition_columns(standin.table(spark, sf_dir, "orders"), "o_orderdate")
    changed = orders.where("year = 1996").withColumn("o_orderstatus", F.lit("Z"))
    write_table(changed, name, mode="partitions", partition_by=("year", "month"))
    return spark.table(name)


# --- columns -----------------------------------------------------------------


@_register
def sanitize_column_names(spark, sf_dir):
    odd = {
        "l_orderkey": "Order-ID",
        "l_linenumber": "__Line   Number__",
        "l_extendedprice": "Price (USD)",
        "l_returnflag": "Şreturn%%flag!",
    }
    df = standin.table(spark, sf_dir, "lineitem").select(*odd)
    return sanitize_columns(df.withColumnsRenamed(odd))


@_register
def cast_timestamp_text(spark, sf_dir):
    """Text timestamps; those of pending orders are malformed and become NULL."""
    text = standin.table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "CASE WHEN o_orderstatus = 'P' THEN 'not a date' ELSE cast(o_orderdate AS string) END AS o_orderdate",
    )
    return _plain(cast_timestamp(text, "o_orderdate"))


@_register
def partition_columns(spark, sf_dir):
    orders = standin.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return with_partition_columns(orders, "o_orderdate")


# --- quality -----------------------------------------------------------------


def _items_with_null_keys(spark, sf_dir) -> DataFrame:
    items = standin.order_items(spark, sf_dir)
    return items.withColumns(
        {"product_id": F.nullif("product_id", F.lit(7)), "seller_id": F.nullif("seller_id", F.lit(3))}
    )


def _items_without_line(spark, sf_dir) -> DataFrame:
    """Seventh lines lose their number, so some keys are NULL and many of them repeat."""
    items = standin.order_items(spark, sf_dir)
    return items.withColumn("order_item_id", F.nullif("order_item_id", F.lit(7)))


def _items_twice(spark, sf_dir) -> DataFrame:
    items = standin.order_items(spark, sf_dir)
    return items.unionByName(items)


@_register
def dedup_valid(spark, sf_dir):
    return _plain(split_duplicates(standin.order_items(spark, sf_dir), ITEM_KEYS)[0])


@_register
def dedup_rejects(spark, sf_dir):
    """Every surplus row, exact copies included."""
    return _plain(split_duplicates(_items_twice(spark, sf_dir), ITEM_KEYS)[1])


@_register
def except_distinct_rejects(spark, sf_dir):
    return _plain(split_duplicates(_items_twice(spark, sf_dir), ITEM_KEYS, rejects="set")[1])


@_register
def null_valid(spark, sf_dir):
    return _plain(split_nulls(_items_with_null_keys(spark, sf_dir), ("product_id", "seller_id"))[0])


@_register
def null_rejects(spark, sf_dir):
    return _plain(split_nulls(_items_with_null_keys(spark, sf_dir), ("product_id", "seller_id"))[1])


@_register
def dlq_reasons(spark, sf_dir):
    rejects = split_nulls(_items_with_null_keys(spark, sf_dir), ("product_id", "seller_id"))[1]
    return _plain(dlq_records(rejects, NULL_KEY))


@_register
def dlq_append(spark, sf_dir):
    """Two appends; the second brings a column that the first did not have."""
    name = _fresh_table(spark)
    rejects = split_nulls(_items_with_null_keys(spark, sf_dir), ("product_id", "seller_id"))[1]
    write_dlq(rejects, name, "first")
    write_dlq(rejects.withColumn("note", F.lit("seen before")), name, "second")
    return _plain(spark.table(name))


@_register
def profile_nulls(spark, sf_dir):
    return null_ratios(_items_with_null_keys(spark, sf_dir))


@_register
def profile_duplicates(spark, sf_dir):
    return duplicate_ratio(standin.order_items(spark, sf_dir), ITEM_KEYS)


@_register
def quality_gate_report(spark, sf_dir):
    return quality_gate(_items_with_null_keys(spark, sf_dir), ITEM_KEYS, QualityThresholds())


# --- silver ------------------------------------------------------------------

_ITEMS = TableSpec("order_items", "order_items.csv", ITEM_KEYS, types={"price": MONEY})
_ORDERS = TableSpec(
    "orders",
    "orders.csv",
    ("order_id",),
    timestamp_column="order_purchase_timestamp",
    partition_by=("year", "month"),
    bad_timestamps="reject",
)


@_register
def silver_items(spark, sf_dir):
    df = _items_without_line(spark, sf_dir)
    return _plain(silver.cleanse(df, _ITEMS, profile_keys(df, ITEM_KEYS)).valid)


@_register
def silver_rejects(spark, sf_dir):
    df = _items_without_line(spark, sf_dir)
    return _plain(silver.cleanse(df, _ITEMS, profile_keys(df, ITEM_KEYS)).rejects)


def _orders_as_text(spark, sf_dir) -> DataFrame:
    malformed = "CASE WHEN order_status = 'P' THEN '?' ELSE cast(order_purchase_timestamp AS string) END"
    return standin.orders(spark, sf_dir).selectExpr(
        "order_id", "customer_id", "order_status", f"{malformed} AS order_purchase_timestamp"
    )


@_register
def silver_orders(spark, sf_dir):
    """No key repeats, so the rows pass through without a wide shuffle."""
    df = _orders_as_text(spark, sf_dir)
    return _plain(silver.cleanse(df, _ORDERS, profile_keys(df, ("order_id",))).valid)


@_register
def silver_bad_timestamps(spark, sf_dir):
    df = _orders_as_text(spark, sf_dir)
    return _plain(silver.cleanse(df, _ORDERS, profile_keys(df, ("order_id",))).rejects)


def _bronze_orders(spark, layers: Layers, df: DataFrame) -> TableSpec:
    ensure_namespace(spark, layers.bronze, layers.location)
    write_table(df, f"{layers.bronze}.orders")
    return TableSpec("orders", "", ("order_id",), "order_purchase_timestamp", ("year", "month"))


@_register
def silver_partition_refresh(spark, sf_dir):
    """Orders of 1996 come again with another status; the other partitions stay."""
    layers = _layers(spark)
    orders = standin.orders(spark, sf_dir).select("order_id", "order_status", "order_purchase_timestamp")
    silver.load(spark, _bronze_orders(spark, layers, orders), layers)
    again = orders.where("year(order_purchase_timestamp) = 1996").withColumn("order_status", F.lit("Z"))
    silver.load(spark, _bronze_orders(spark, layers, again), layers, mode="partitions")
    return _plain(spark.table(f"{layers.silver}.orders"))


def _loaded(df: DataFrame, name: str, load: str, at: str) -> None:
    """Append a load to a bronze table that is kept by load."""
    stamped = df.withColumns({INGESTED_AT: F.lit(at).cast("timestamp"), LOAD_ID: F.lit(load)})
    write_table(stamped, name, "append", (LOAD_ID,), gather=False)


@_register
def silver_upsert(spark, sf_dir):
    """A second load moves some orders to another month, changes the status of others, and has one order twice.

    Rows of silver and dead letters, told apart by ``reason``.
    """
    layers = _layers(spark)
    ensure_namespace(spark, layers.bronze, layers.location)
    name = f"{layers.bronze}.orders"
    spec = TableSpec("orders", "", ("order_id",), "order_purchase_timestamp", ("year", "month"))
    orders = standin.orders(spark, sf_dir).select("order_id", "order_status", "order_purchase_timestamp")
    _loaded(orders, name, "1", "2024-01-01")
    silver.load(spark, spec, layers, mode="incremental")
    moved = orders.where("order_id % 10 = 0").withColumns(
        {
            "order_status": F.lit("M"),
            "order_purchase_timestamp": F.expr("order_purchase_timestamp + interval 40 days"),
        }
    )
    paid = orders.where("order_id % 10 = 1").withColumn("order_status", F.lit("S"))
    _loaded(moved.unionByName(paid).unionByName(paid.where("order_id % 100 = 1")), name, "2", "2024-01-02")
    silver.load(spark, spec, layers, mode="incremental")
    kept = spark.table(f"{layers.silver}.orders").withColumn("reason", F.lit("kept"))
    lost = spark.table(f"{layers.dlq}.orders_rejected").withColumnRenamed(DLQ_REASON, "reason")
    names = ("order_id", "order_status", "order_purchase_timestamp", "reason")
    return _plain(kept.select(*names, "year", "month").unionByName(lost.select(*names), allowMissingColumns=True))


@_register
def silver_repeated_rejects(spark, sf_dir):
    """Orders without a key come three times, with a map; a refresh of 1996 has each of them once more."""
    layers = _layers(spark)
    orders = standin.orders(spark, sf_dir).selectExpr(
        "CASE WHEN order_id % 5 > 0 THEN order_id END AS order_id",
        "map(order_status, customer_id) AS tags",
        "order_purchase_timestamp",
    )
    lost = orders.where("order_id IS NULL")
    whole = orders.unionByName(lost).unionByName(lost)
    silver.load(spark, _bronze_orders(spark, layers, whole), layers)
    again = orders.where("year(order_purchase_timestamp) = 1996 OR order_id IS NULL")
    silver.load(spark, _bronze_orders(spark, layers, again), layers, mode="partitions")
    found = spark.table(f"{layers.dlq}.orders_rejected").withColumn("year", F.year("order_purchase_timestamp"))
    return found.groupBy("year").agg(F.count(F.lit(1)).alias("rejects"))


@_register
def silver_loads_reject_once(spark, sf_dir):
    """Three loads of one bronze table leave its rejects once."""
    layers = _layers(spark)
    ensure_namespace(spark, layers.bronze, layers.location)
    write_table(_items_without_line(spark, sf_dir), f"{layers.bronze}.order_items")
    for _ in range(3):
        silver.load(spark, _ITEMS, layers)
    rejected = spark.table(f"{layers.dlq}.order_items_rejected")
    return rejected.groupBy(DLQ_REASON).agg(F.count(F.lit(1)).alias("rejects"))


@_register
def stamps_and_guards(spark, sf_dir):
    """Stamps are set in every row, an empty frame keeps the columns, a missing one raises."""
    orders = standin.table(spark, sf_dir, "orders")
    stamped = stamp_updated(stamp_ingested(orders))
    try:
        require_columns(orders, ["no_such_column"])
        guarded = "no"
    except ValueError:
        guarded = "yes"
    # Rows of the empty frame would count as rows without stamps.
    every = stamped.withColumn("real", F.lit(True)).unionByName(empty_like(orders), allowMissingColumns=True)
    found = every.agg(
        F.count(INGESTED_AT).alias("ingested"),
        F.count(UPDATED_AT).alias("updated"),
        F.count("real").alias("n"),
        F.count_if(F.col("real").isNull()).alias("empty"),
    )
    same = F.lit(empty_like(orders).schema == orders.schema).alias("same_columns")
    return found.select("*", same, F.lit(guarded).alias("guarded"))


# --- gold --------------------------------------------------------------------


@_register
def dim_customers(spark, sf_dir):
    return _plain(gold.dim_customers(standin.customers(spark, sf_dir)))


@_register
def dim_sellers(spark, sf_dir):
    return _plain(gold.dim_sellers(standin.sellers(spark, sf_dir)))


@_register
def dim_products(spark, sf_dir):
    products, names = standin.products(spark, sf_dir), standin.category_translation(spark, sf_dir)
    return _plain(gold.dim_products(products, names))


@_register
def dim_geolocation(spark, sf_dir):
    return _plain(gold.dim_geolocation(standin.geolocation(spark, sf_dir)))


@_register
def dim_dates(spark, sf_dir):
    """The days between the first and the last order."""
    orders = standin.table(spark, sf_dir, "orders")
    first, last = orders.agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    return _plain(gold.dim_dates(spark, first.date(), last.date()))


@_register
def review_avg(spark, sf_dir):
    return gold.review_scores(standin.order_reviews(spark, sf_dir))


@_register
def fact_order_payments(spark, sf_dir):
    payments = standin.order_payments(spark, sf_dir)
    orders = standin.dated_orders(spark, sf_dir)
    return _plain(gold.fact_order_payments(orders, payments, *key_load(payments, ["order_id"])))


@_register
def fact_order_sales(spark, sf_dir):
    items = standin.order_items(spark, sf_dir)
    orders, reviews = standin.dated_orders(spark, sf_dir), standin.order_reviews(spark, sf_dir)
    return _plain(gold.fact_order_sales(items, orders, reviews, *key_load(items, ["order_id"])))


# --- views and metrics -------------------------------------------------------


@_register
def master_sales(spark, sf_dir):
    return _plain(views.master_sales(standin.StandInStar(spark, sf_dir)))


@_register
def master_payments(spark, sf_dir):
    return _plain(views.master_payments(standin.StandInStar(spark, sf_dir)))


@_register
def seller_geo(spark, sf_dir):
    star = standin.StandInStar(spark, sf_dir)
    return views.seller_geo(star.dim_sellers, star.dim_geolocation)


def _metric(metric: Callable) -> None:
    QUERIES[metric.__name__] = lambda spark, sf_dir: metric(standin.written_star(spark, sf_dir))


for _m in (
    metrics.kpi_revenue,
    metrics.kpi_orders,
    metrics.kpi_customers,
    metrics.top_categories,
    metrics.freight_by_state,
    metrics.monthly_revenue,
    metrics.order_status_share,
    metrics.top_seller_cities,
    metrics.payment_types,
    metrics.installment_histogram,
    metrics.delivery_performance,
    metrics.payments_by_customer_state,
):
    _metric(_m)


# Shorter than the range of the orders.
CALENDAR = (dt.date(1996, 1, 1), dt.date(1997, 6, 30))


class _ShortCalendar(standin.StandInStar):
    """Pending orders have no purchase time, and the calendar ends before the orders do."""

    @property
    def dim_dates(self) -> DataFrame:
        days = gold.dim_dates(self._args[0], *CALENDAR)
        # A calendar of its own kind: quarters start one month later.
        return days.withColumn("quarter", F.expr("cast(ceil((pmod(month - 2, 12) + 1) / 3) AS int)"))

    def _undated(self, fact: DataFrame) -> DataFrame:
        at = F.expr("CASE WHEN order_status <> 'P' THEN order_purchase_timestamp END")
        return fact.withColumn("order_purchase_timestamp", at)

    @property
    def fact_order_sales(self) -> DataFrame:
        return self._undated(super().fact_order_sales)

    @property
    def fact_order_payments(self) -> DataFrame:
        return self._undated(super().fact_order_payments)


@_register
def sales_by_calendar(spark, sf_dir):
    return metrics.sales_by_calendar(_ShortCalendar(spark, sf_dir))


@_register
def payments_by_calendar(spark, sf_dir):
    return metrics.payments_by_calendar(_ShortCalendar(spark, sf_dir))


@_register
def sums_of_any_double(spark, sf_dir):
    """Sums of doubles: plain ones, with a NaN, and with a number that no decimal holds."""
    prices = standin.table(spark, sf_dir, "lineitem").selectExpr(
        "l_returnflag",
        "CASE WHEN l_returnflag = 'A' AND l_linenumber = 1 THEN double('NaN')"
        " WHEN l_returnflag = 'R' AND l_orderkey = 1 THEN 1e19 ELSE l_extendedprice END AS price",
    )
    total = exact_sum(prices, "price")
    size = F.when(F.isnan(total), "no number").when(total >= 1e19, "large").otherwise("plain")
    small = F.when(total < 1e19, F.round(total, 2))
    return prices.groupBy("l_returnflag").agg(size.alias("size"), F.when(~F.isnan(total), small).alias("total"))


@_register
def top_categories_deduplicated(spark, sf_dir):
    """From raw items to the dashboard: duplicates out, fact, product names, ten best."""
    items = split_duplicates(standin.order_items(spark, sf_dir), ITEM_KEYS)[0]
    return metrics.top_categories(standin.StandInStar(spark, sf_dir, items))


# --- runs --------------------------------------------------------------------


@_register
def run_audit_latest(spark, sf_dir):
    """Events as run records: the last one of each layer and table."""
    name = _fresh_table(spark)
    standin.table(spark, sf_dir, "events").selectExpr(
        "event_type AS layer",
        "'t' || user_id AS `table`",
        "cast(ts AS timestamp) AS last_run",
        "event_id AS rows_processed",
        "CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status",
        "cast(0 AS bigint) AS rows_rejected",
        "cast(NULL AS string) AS message",
    ).write.mode("append").saveAsTable(name)
    latest = latest_runs(load_runs(spark, name))
    return _plain(latest.select("layer", "table", "last_run", "rows_processed", "status"))


def _raw_files(spark, sf_dir) -> str:
    root = scratch_path(spark, "raw")
    # Side by side: the smaller tables do not keep all cores busy.
    with ThreadPoolExecutor(max_workers=4) as pool:
        made = [pool.submit(lambda n, make: _write_raw(make(spark, sf_dir), f"{root}/{n}.csv"), *t) for t in standin.TABLES.items()]
        for table in made:
            table.result()
    return root


def _write_raw(rows, path) -> None:
    """Packed files can't be split, so none has more rows than a task should read."""
    # The least effort takes a tenth more room than the usual one and a third of its time.
    writer = rows.write.mode("append").option("maxRecordsPerFile", RAW_ROWS).option("zlib.compress.level", "BEST_SPEED")
    writer.csv(path, header=True, escape='"', compression="gzip")


def _whole_run(spark, sf_dir) -> Layers:
    """Raw CSV files of all nine tables through all layers."""
    root, layers = _raw_files(spark, sf_dir), _layers(spark)
    # The stand-in's reviews have no cells with line breaks.
    specs = retail_specs(multi_line=False)
    medallion.run(spark, root, specs, layers, first=standin.FIRST_DATE, last=standin.LAST_DATE)
    return layers


@_register
def incremental_run(spark, sf_dir):
    """Two runs over growing folders of raw files: what the second one makes of both facts.

    New files move orders to another month, and bring prices, payments and late reviews of old orders.
    """
    root, layers = _raw_files(spark, sf_dir), _layers(spark)
    specs = retail_specs(multi_line=False)
    days = {"first": standin.FIRST_DATE, "last": standin.LAST_DATE}
    medallion.run(spark, root, specs, layers, **days, mode="incremental")
    later = {
        "orders": standin.orders(spark, sf_dir)
        .where("order_id % 10 = 0")
        .withColumns(
            {
                "order_status": F.lit("M"),
                "order_purchase_timestamp": F.expr("order_purchase_timestamp + interval 40 days"),
            }
        ),
        "order_items": standin.order_items(spark, sf_dir)
        .where("order_id % 7 = 0")
        .withColumn("price", F.expr("cast(price + 1 AS decimal(18,2))")),
        "order_payments": standin.order_payments(spark, sf_dir)
        .where("order_id % 11 = 0")
        .withColumn("payment_value", F.expr("cast(payment_value + 1 AS decimal(18,2))")),
        "order_reviews": standin.order_reviews(spark, sf_dir)
        .where("review_id % 15 = 0")
        .withColumns({"review_id": F.expr("'late-' || review_id"), "review_score": F.lit(1)}),
    }
    for name, rows in later.items():
        _write_raw(rows, f"{root}/{name}.csv")
    medallion.run(spark, root, specs, layers, **days, mode="incremental")
    star = gold.read_star(spark, layers)
    sales = star.fact_order_sales.selectExpr(
        "'sale' AS kind", "order_id", "order_item_id AS line", "price AS amount", "order_status", "year", "month",
        "avg_review_score",
    )
    paid = star.fact_order_payments.selectExpr(
        "'payment' AS kind", "order_id", "payment_sequential AS line", "payment_value AS amount", "order_status",
        "year", "month", "cast(NULL AS double) AS avg_review_score",
    )
    return _plain(sales.unionByName(paid).withColumn("order_id", F.col("order_id").cast("bigint")))


@_register
def medallion_audit(spark, sf_dir):
    """The run records of each table of a whole run."""
    layers = _whole_run(spark, sf_dir)
    runs = latest_runs(load_runs(spark, medallion.audit_table(layers)))
    return runs.select("layer", "table", "rows_processed", "status", "rows_rejected")


@_register
def published_master_sales(spark, sf_dir):
    """The wide view as a whole run publishes it, from CSV to the catalog."""
    layers = _whole_run(spark, sf_dir)
    wide = spark.table(f"{layers.bi}.{views.MASTER_SALES}")
    numbers = ("order_id", "customer_id", "customer_unique_id")
    at = [c for c, kind in wide.dtypes if kind == "timestamp"]
    wide = wide.withColumns({c: F.col(c).cast("bigint") for c in numbers})
    return _plain(wide.withColumns({c: F.col(c).cast("timestamp_ntz") for c in at}))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_categories_deduplicated(spark, sf_dir)
