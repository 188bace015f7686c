"""Wide views for dashboards, as DataFrames and as catalog views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartlake.plans.gold import Star
from cartlake.sources.tables import ensure_namespace
from cartlake.specs import Layers

# Columns of the wide sales view, in order.
MASTER_SALES_COLUMNS = (
    "order_id",
    "customer_id",
    "customer_unique_id",
    "order_status",
    "order_purchase_timestamp",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
    "price",
    "freight_value",
    "avg_review_score",
    "customer_city",
    "customer_state",
    "product_category_name",
    "seller_city",
    "seller_state",
    "customer_lat",
    "customer_lon",
)

# Names of the wide views in the catalog.
MASTER_SALES = "Master_Sales_Auto"
MASTER_PAYMENTS = "Master_Payments_Auto"


# The wide sales view, by the names of its inputs. Customers meet their coordinates before they
# meet the fact, so the fact takes part in three joins, not four.
_MASTER_SALES_SQL = f"""
    WITH places AS (
        SELECT customer_id, customer_unique_id, customer_city, customer_state,
               avg_latitude AS customer_lat, avg_longitude AS customer_lon
        FROM {{dim_customers}}
        LEFT JOIN {{dim_geolocation}} ON geolocation_zip_code_prefix = customer_zip_code_prefix
    )
    SELECT {", ".join(MASTER_SALES_COLUMNS)}
    FROM {{fact_order_sales}}
    LEFT JOIN places USING (customer_id)
    LEFT JOIN (SELECT product_id, product_category_name FROM {{dim_products}}) USING (product_id)
    LEFT JOIN (SELECT seller_id, seller_city, seller_state FROM {{dim_sellers}}) USING (seller_id)
"""
_MASTER_SALES_INPUTS = ("dim_customers", "dim_geolocation", "fact_order_sales", "dim_products", "dim_sellers")


def seller_geo(sellers: DataFrame, geolocation: DataFrame) -> DataFrame:
    """Sellers with the coordinates of their zip prefix."""
    geo = geolocation.selectExpr(
        "geolocation_zip_code_prefix AS seller_zip_code_prefix",
        "avg_latitude AS seller_lat",
        "avg_longitude AS seller_lon",
    )
    return sellers.join(geo, "seller_zip_code_prefix", "left").select(
        "seller_id", "seller_zip_code_prefix", "seller_city", "seller_state", "seller_lat", "seller_lon"
    )


def master_sales(star: Star) -> DataFrame:
    """Every sales row with its customer, product, seller and customer coordinates.

    Each of the fact's joins shuffles both sides on a key of its own unless the dimension is
    small, which lets adaptive execution split a hot customer or product.
    """
    inputs = {name: getattr(star, name) for name in _MASTER_SALES_INPUTS}
    return star.fact_order_sales.sparkSession.sql(_MASTER_SALES_SQL, **inputs)


def master_payments(star: Star) -> DataFrame:
    return star.fact_order_payments


def publish_views(spark: SparkSession, layers: Layers = Layers()) -> list[str]:
    """Create or replace one view per gold table and the two wide views; their full names."""
    ensure_namespace(spark, layers.bi, layers.location)
    gold = layers.gold
    bodies = {name: f"SELECT * FROM {gold}.{name}" for name in Star._fields}
    bodies[MASTER_PAYMENTS] = f"SELECT * FROM {gold}.fact_order_payments"
    bodies[MASTER_SALES] = _MASTER_SALES_SQL.format(**{name: f"{gold}.{name}" for name in _MASTER_SALES_INPUTS})
    for name, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE VIEW {layers.bi}.{name} AS {body}")
    return [f"{layers.bi}.{name}" for name in bodies]
