"""Gold: a star schema of five dimensions and two facts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor, as_completed
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlake.functions.dates import is_weekend
from cartlake.functions.exact import exact_mean, merge_parts, sum_parts, total
from cartlake.operators.columns import stamp_updated
from cartlake.operators.joins import dealt, key_load, spread_join
from cartlake.sources.batches import BUILT, REPLACED, Batch, State, log_batches, read_state
from cartlake.sources.scratch import delete_path, released
from cartlake.sources.tables import ensure_namespace, partition_filter, partitions_of, replace_partitions, write_table
from cartlake.specs import Layers

# The least range of the date dimension.
FIRST_DATE = dt.date(2016, 1, 1)
LAST_DATE = dt.date(2019, 12, 31)

FACT_PARTITIONS = ("year", "month")

# Columns taken over into the dimensions, and from orders into the facts.
CUSTOMER_COLUMNS = (
    "customer_id",
    "customer_unique_id",
    "customer_zip_code_prefix",
    "customer_city",
    "customer_state",
)
SELLER_COLUMNS = ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state")
PRODUCT_MEASURES = (
    "product_name_lenght",
    "product_description_lenght",
    "product_photos_qty",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
)
PAID_ORDER_COLUMNS = ("order_id", "customer_id", "order_status", "order_purchase_timestamp", "year", "month")
SOLD_ORDER_COLUMNS = (
    "order_id",
    "customer_id",
    "order_status",
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
    "year",
    "month",
)


class GoldFailed(RuntimeError):
    """Some gold tables could not be built; the others were."""


class Star(NamedTuple):
    dim_customers: DataFrame
    dim_sellers: DataFrame
    dim_products: DataFrame
    dim_geolocation: DataFrame
    dim_dates: DataFrame
    fact_order_payments: DataFrame
    fact_order_sales: DataFrame


def dim_customers(customers: DataFrame) -> DataFrame:
    return stamp_updated(customers.select(*CUSTOMER_COLUMNS))


def dim_sellers(sellers: DataFrame) -> DataFrame:
    return stamp_updated(sellers.select(*SELLER_COLUMNS))


def dim_products(products: DataFrame, translation: DataFrame, coalesce_untranslated: bool = False) -> DataFrame:
    """Products under the English category name.

    A category without translation is NULL, or keeps its name with ``coalesce_untranslated``.
    """
    english: Column = F.col("product_category_name_english")
    if coalesce_untranslated:
        english = F.coalesce(english, F.col("product_category_name"))
    names = translation.select("product_category_name", "product_category_name_english")
    named = products.join(names, "product_category_name", "left")
    return stamp_updated(named.select("product_id", english.alias("product_category_name"), *PRODUCT_MEASURES))


def dim_geolocation(geolocation: DataFrame) -> DataFrame:
    """Mean coordinates and the most frequent city and state of each zip prefix.

    Of equally frequent names the lowest wins. Names are counted per value before they
    are compared, so no task holds all the rows of a prefix.
    """
    zip_, city, state = F.col("geolocation_zip_code_prefix"), F.col("geolocation_city"), F.col("geolocation_state")
    # Fifteen places hold all the digits of a coordinate. Rows are summed up by their names
    # first, so what is expanded for the three groupings is small.
    sums = [part for axis in ("lat", "lng") for part in sum_parts(geolocation, f"geolocation_{axis}", axis, 15)]
    places = geolocation.groupBy(zip_.alias("zip"), city.alias("city"), state.alias("state")).agg(
        F.count(F.lit(1)).alias("n"),
        *sums,
        F.count("geolocation_lat").alias("lat_n"),
        F.count("geolocation_lng").alias("lng_n"),
    )
    counts = places.groupingSets([("zip",), ("zip", "city"), ("zip", "state")], "zip", "city", "state").agg(
        F.grouping_id().alias("level"),
        F.sum("n").alias("n"),
        *merge_parts("lat"),
        *merge_parts("lng"),
        F.sum("lat_n").alias("lat_n"),
        F.sum("lng_n").alias("lng_n"),
    )
    # Bits of the grouping id, high to low: zip, city, state; 1 means grouped away.
    whole, by_city, by_state = (F.col("level") == b for b in (0b011, 0b001, 0b010))

    def mean(axis: str) -> Column:
        return total(axis) / F.nullif(F.col(f"{axis}_n"), F.lit(0))

    def commonest(name: str, level: Column) -> Column:
        ranked = F.struct((-F.col("n")).alias("n"), F.col(name).alias("name"))
        return F.min(F.when(level & F.col(name).isNotNull(), ranked))["name"]

    return stamp_updated(
        counts.groupBy("zip")
        .agg(
            *merge_parts("lat", whole),
            *merge_parts("lng", whole),
            F.sum(F.when(whole, F.col("lat_n"))).alias("lat_n"),
            F.sum(F.when(whole, F.col("lng_n"))).alias("lng_n"),
            commonest("city", by_city).alias("city"),
            commonest("state", by_state).alias("state"),
        )
        .select(
            F.col("zip").alias("geolocation_zip_code_prefix"),
            mean("lat").alias("avg_latitude"),
            mean("lng").alias("avg_longitude"),
            "city",
            "state",
        )
    )


def dim_dates(spark: SparkSession, first: dt.date = FIRST_DATE, last: dt.date = LAST_DATE) -> DataFrame:
    """One row per day from ``first`` to ``last``, both included."""
    days = (last - first).days + 1
    if days < 1:
        raise ValueError(f"{first} is after {last}")
    # A generated range: its size is known to the planner, so joins can broadcast it.
    day = F.date_add(F.lit(first), F.col("id").cast("int"))
    return stamp_updated(
        spark.range(0, days, 1, 1)
        .select(day.alias("date_sk"))
        .select(
            "date_sk",
            F.col("date_sk").alias("full_date"),
            F.year("date_sk").alias("year"),
            F.month("date_sk").alias("month"),
            F.day("date_sk").alias("day"),
            F.quarter("date_sk").alias("quarter"),
            F.dayofweek("date_sk").alias("day_of_week"),
            is_weekend("date_sk").alias("is_weekend"),
        )
    )


def date_range(orders: DataFrame) -> tuple[dt.date, dt.date]:
    """From the first purchase to the last one, and the fixed least range at any rate."""
    day = F.to_date("order_purchase_timestamp")
    first, last = orders.agg(F.min(day), F.max(day)).first()
    return min(first or FIRST_DATE, FIRST_DATE), max(last or LAST_DATE, LAST_DATE)


def review_scores(reviews: DataFrame) -> DataFrame:
    """Mean review score per order, so that joining it does not multiply rows."""
    return reviews.groupBy("order_id").agg(exact_mean(reviews, "review_score").alias("avg_review_score"))


def fact_order_payments(
    orders: DataFrame, payments: DataFrame, heavy: DataFrame | None = None, rows: int = 0
) -> DataFrame:
    """One row per payment of a known order; ``heavy`` and ``rows`` are the ``key_load`` of the payments."""
    order = orders.select(*PAID_ORDER_COLUMNS)
    rest = [c for c in payments.columns if c != "order_id"]
    joined = spread_join(payments, order, ["order_id"], "inner", heavy, rows=rows)
    return stamp_updated(joined.select(*order.columns, *rest))


def fact_order_sales(
    items: DataFrame,
    orders: DataFrame,
    reviews: DataFrame,
    heavy: DataFrame | None = None,
    rows: int = 0,
) -> DataFrame:
    """One row per item of a known order; ``heavy`` and ``rows`` are the ``key_load`` of the items.

    Orders take their review score first: both sides have one row per order, and the items
    are then shuffled once, for a single join.
    """
    sold, scores = (dealt(df, ["order_id"], rows) for df in (orders.select(*SOLD_ORDER_COLUMNS), review_scores(reviews)))
    order = sold.join(scores, "order_id", "left")
    return stamp_updated(spread_join(items, order, ["order_id"], "inner", heavy, rows=rows))


# Silver tables the star is built from.
SILVER_INPUTS = (
    "customers",
    "sellers",
    "products",
    "category_translation",
    "geolocation",
    "orders",
    "order_payments",
    "order_items",
    "order_reviews",
)


def build(
    spark: SparkSession,
    layers: Layers = Layers(),
    names: dict[str, str] | None = None,
    first: dt.date | None = None,
    last: dt.date | None = None,
    on_written: Callable[[str, int], None] = lambda name, rows: None,
    workers: int = 4,
    mode: str = "overwrite",
) -> dict[str, int]:
    """Build and replace all gold tables, several at a time; rows written by table name.

    ``names`` maps the inputs above to silver tables of other names. All silver tables
    must exist before anything is written. If a table fails the others are finished first, and
    the error names all that failed. The date dimension goes from ``first`` to ``last``, or as
    far as the orders do. ``mode="partitions"`` replaces only those partitions of the facts that
    have rows now; dimensions are replaced whole.
    """
    states = read_state(spark, layers, [(names or {}).get(n, n) for n in SILVER_INPUTS])
    with released(spark):
        rows = _build(spark, layers, names, first, last, on_written, workers, mode)
    _log_built(spark, layers, states)
    return rows


# What each gold table is made of.
INPUTS_OF = {
    "dim_customers": ("customers",),
    "dim_sellers": ("sellers",),
    "dim_products": ("products", "category_translation"),
    "dim_geolocation": ("geolocation",),
    "dim_dates": ("orders",),
    "fact_order_payments": ("orders", "order_payments"),
    "fact_order_sales": ("orders", "order_items", "order_reviews"),
}


def refresh(
    spark: SparkSession,
    layers: Layers = Layers(),
    names: dict[str, str] | None = None,
    first: dt.date | None = None,
    last: dt.date | None = None,
    on_written: Callable[[str, int], None] = lambda name, rows: None,
    workers: int = 4,
) -> dict[str, int]:
    """Bring the star up to the batches that silver loads applied since it was built; rows written by table name.

    Dimensions are replaced if an input changed. Of a fact only the partitions are computed and
    written that have an order with a change: of the order itself, before or after it, or of one
    of its payments, items or reviews. Orders are read from these partitions alone. Where an
    input was replaced as a whole, or is not known to the log, all is built anew. If it fails, the next
    run does the same again.
    """
    names = {n: n for n in SILVER_INPUTS} | (names or {})
    states = read_state(spark, layers, names.values())
    whole = any(s.loads is None or any(b.event == REPLACED for b in s.pending) for s in states.values())
    if whole or not all(spark.catalog.tableExists(f"{layers.gold}.{t}") for t in Star._fields):
        return build(spark, layers, names, first, last, on_written, workers)
    changed = {n: _changes(spark, states[names[n]]) for n in SILVER_INPUTS if states[names[n]].pending}
    with released(spark):
        t = {n: spark.table(f"{layers.silver}.{names[n]}") for n in SILVER_INPUTS}
        tasks = {}
        for name in reversed(Star._fields):
            if not changed.keys() & set(INPUTS_OF[name]):
                continue
            if name.startswith("fact_"):
                some = {n: changed[n] for n in INPUTS_OF[name] if n in changed}
                tasks[name] = lambda name=name, some=some: _refresh_fact(spark, layers, name, t, some)
            else:
                frame = _dimension(spark, name, t, first, last)
                tasks[name] = lambda name=name, frame=frame: write_table(
                    frame, f"{layers.gold}.{name}", file_format=layers.file_format
                )
        rows = _run_all(tasks, on_written, workers)
    _log_built(spark, layers, states)
    return rows


def _changes(spark: SparkSession, state: State) -> DataFrame:
    """Rows that entered or left a silver table since gold was built."""
    paths = [f"{b.path}/{part}" for b in state.pending for part in ("valid", "displaced")]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(spark.read.parquet, paths))


def _log_built(spark: SparkSession, layers: Layers, states: dict[str, State]) -> None:
    done = [b for s in states.values() for b in s.pending]
    if done:
        log_batches(spark, layers, [Batch(b.table, b.batch, BUILT) for b in done])
    for b in done:
        if b.path:
            delete_path(spark, b.path)


def touched_partitions(orders: DataFrame, changed: dict[str, DataFrame]) -> set[tuple]:
    """Partitions of the orders that ``changed`` rows of the inputs belong to, now or before."""
    out: set[tuple] = set()
    if "orders" in changed:
        out |= partitions_of(changed["orders"], FACT_PARTITIONS)
    ids = [df.select("order_id") for n, df in changed.items() if n != "orders"]
    if ids:
        ids = reduce(DataFrame.unionByName, ids).distinct()
        out |= partitions_of(orders.join(ids, "order_id", "left_semi"), FACT_PARTITIONS)
    return out


def _refresh_fact(
    spark: SparkSession, layers: Layers, name: str, t: dict[str, DataFrame], changed: dict[str, DataFrame]
) -> int:
    touched = touched_partitions(t["orders"], changed)
    if not touched:
        return 0
    orders = t["orders"].where(partition_filter(touched, FACT_PARTITIONS))
    many = "order_payments" if name == "fact_order_payments" else "order_items"
    rows = t[many]
    # Where no order is left out, the fact's own join sees to rows without one.
    if partitions_of(t["orders"], FACT_PARTITIONS) - touched:
        rows = rows.join(orders.select("order_id"), "order_id", "left_semi")
    load = key_load(rows, ["order_id"])
    if name == "fact_order_payments":
        fact = fact_order_payments(orders, rows, *load)
    else:
        fact = fact_order_sales(rows, orders, t["order_reviews"], *load)
    target = f"{layers.gold}.{name}"
    fact = fact.select(*spark.table(target).columns)
    return replace_partitions(fact, target, FACT_PARTITIONS, touched, layers.file_format)


def _build(spark, layers, names, first, last, on_written, workers, mode) -> dict[str, int]:
    names = {n: n for n in SILVER_INPUTS} | (names or {})
    t = {n: spark.table(f"{layers.silver}.{names[n]}") for n in SILVER_INPUTS}
    ensure_namespace(spark, layers.gold, layers.location)
    star = Star(
        *(_dimension(spark, name, t, first, last) for name in Star._fields if name.startswith("dim_")),
        fact_order_payments(t["orders"], t["order_payments"], *key_load(t["order_payments"], ["order_id"])),
        fact_order_sales(
            t["order_items"], t["orders"], t["order_reviews"], *key_load(t["order_items"], ["order_id"])
        ),
    )

    def write(name: str) -> int:
        fact = name.startswith("fact_")
        return write_table(
            getattr(star, name),
            f"{layers.gold}.{name}",
            mode if fact else "overwrite",
            FACT_PARTITIONS if fact else (),
            file_format=layers.file_format,
        )

    # The facts take longest, so they start first.
    return _run_all({name: lambda name=name: write(name) for name in reversed(Star._fields)}, on_written, workers)


def _dimension(
    spark: SparkSession, name: str, t: dict[str, DataFrame], first: dt.date | None, last: dt.date | None
) -> DataFrame:
    if name == "dim_dates":
        if first is None or last is None:
            found = date_range(t["orders"])
            first, last = first or found[0], last or found[1]
        return dim_dates(spark, first, last)
    make = {
        "dim_customers": dim_customers,
        "dim_sellers": dim_sellers,
        "dim_products": dim_products,
        "dim_geolocation": dim_geolocation,
    }
    return make[name](*(t[n] for n in INPUTS_OF[name]))


def _run_all(
    work: dict[str, Callable[[], int]], on_written: Callable[[str, int], None], workers: int
) -> dict[str, int]:
    rows: dict[str, int] = {}
    failures: dict[str, BaseException] = {}
    with ThreadPoolExecutor(max_workers=workers) as pool:
        tasks = {pool.submit(write): name for name, write in work.items()}
        for task in as_completed(tasks):
            name = tasks[task]
            if error := task.exception():
                failures[name] = error
                continue
            rows[name] = task.result()
            on_written(name, rows[name])
    if failures:
        raise GoldFailed("; ".join(f"{n}: {e}" for n, e in sorted(failures.items()))) from failures[min(failures)]
    return rows


def read_star(spark: SparkSession, layers: Layers = Layers()) -> Star:
    return Star(*(spark.table(f"{layers.gold}.{name}") for name in Star._fields))
