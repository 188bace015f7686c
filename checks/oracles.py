"""The registered queries as SQL over the same tables, for an independent engine."""

from __future__ import annotations

ZIP = "lpad(cast({} AS varchar), 5, '0')"

# The retail tables of checks.standin, as common table expressions.
CTES = {
    "delivered": "SELECT l_orderkey, max(l_shipdate) AS delivered FROM lineitem GROUP BY l_orderkey",
    "r_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
               o_orderdate AS order_purchase_timestamp, o_orderdate AS order_approved_at,
               delivered AS order_delivered_customer_date,
               o_orderdate + INTERVAL 60 DAY AS order_estimated_delivery_date,
               cast(year(o_orderdate) AS integer) AS "year", cast(month(o_orderdate) AS integer) AS "month"
        FROM orders LEFT JOIN delivered ON l_orderkey = o_orderkey""",
    "items": """
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
               l_suppkey AS seller_id, cast(l_extendedprice AS decimal(18,2)) AS price,
               cast(l_quantity AS decimal(18,2)) AS freight_value
        FROM lineitem""",
    "payments": """
        SELECT event_id // 3 AS order_id, cast(event_id % 3 + 1 AS integer) AS payment_sequential,
               event_type AS payment_type, cast(json_extract_string(props, '$.k') AS integer) AS payment_installments,
               cast(value AS decimal(18,2)) AS payment_value
        FROM events""",
    "reviews": """
        SELECT event_id // 3 AS order_id, cast(floor(value) AS integer) % 5 + 1 AS review_score FROM events""",
    "nations": "SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey",
    "customers": f"""
        SELECT c_custkey AS customer_id, c_custkey // 2 AS customer_unique_id,
               {ZIP.format("c_nationkey")} AS customer_zip_code_prefix, n_name AS customer_city,
               r_name AS customer_state
        FROM customer LEFT JOIN nations ON c_nationkey = n_nationkey""",
    "sellers": f"""
        SELECT s_suppkey AS seller_id, {ZIP.format("s_nationkey")} AS seller_zip_code_prefix,
               n_name AS seller_city, r_name AS seller_state
        FROM supplier LEFT JOIN nations ON s_nationkey = n_nationkey""",
    "products": """
        SELECT p_partkey AS product_id,
               CASE WHEN p_type <> 'PROMO' THEN lower(p_brand || ' ' || p_type) END AS product_category_name,
               cast(length(p_name) AS integer) AS product_name_lenght,
               cast(length(p_brand) AS integer) AS product_description_lenght,
               p_size AS product_photos_qty, p_retailprice AS product_weight_g,
               cast(p_size AS double) AS product_length_cm, cast(p_size * 2 AS double) AS product_height_cm,
               cast(p_size AS double) / 2 AS product_width_cm
        FROM part""",
    "places": f"""
        SELECT {ZIP.format("c_nationkey")} AS zip, cast(c_acctbal AS decimal(18,2)) AS lat, c_custkey AS lng,
               c_mktsegment AS city, r_name AS state
        FROM customer LEFT JOIN nations ON c_nationkey = n_nationkey""",
    "cities": """
        SELECT zip, city FROM (
            SELECT zip, city, row_number() OVER (PARTITION BY zip ORDER BY count(*) DESC, city) AS rn
            FROM places GROUP BY zip, city) WHERE rn = 1""",
    "states": """
        SELECT zip, state FROM (
            SELECT zip, state, row_number() OVER (PARTITION BY zip ORDER BY count(*) DESC, state) AS rn
            FROM places GROUP BY zip, state) WHERE rn = 1""",
    "geo": """
        SELECT zip AS geolocation_zip_code_prefix,
               cast(sum(lat) AS double) / count(lat) AS avg_latitude,
               cast(sum(lng) AS double) / count(lng) AS avg_longitude,
               any_value(cities.city) AS city, any_value(states.state) AS state
        FROM places JOIN cities USING (zip) JOIN states USING (zip) GROUP BY zip""",
    "scores": """
        SELECT order_id, cast(sum(review_score) AS double) / count(review_score) AS avg_review_score
        FROM reviews GROUP BY order_id""",
    "sales": """
        SELECT items.*, customer_id, order_status, order_purchase_timestamp, order_approved_at,
               order_delivered_customer_date, order_estimated_delivery_date, "year", "month", avg_review_score
        FROM items JOIN r_orders USING (order_id) LEFT JOIN scores USING (order_id)""",
    "wide": """
        SELECT order_id, customer_id, customer_unique_id, order_status, order_purchase_timestamp,
               order_delivered_customer_date, order_estimated_delivery_date, price, freight_value,
               avg_review_score, customer_city, customer_state, product_category_name, seller_city,
               seller_state, avg_latitude AS customer_lat, avg_longitude AS customer_lon
        FROM sales LEFT JOIN customers USING (customer_id) LEFT JOIN products USING (product_id)
             LEFT JOIN sellers USING (seller_id)
             LEFT JOIN geo ON geolocation_zip_code_prefix = customer_zip_code_prefix""",
    "paid": """
        SELECT order_id, customer_id, order_status, order_purchase_timestamp, "year", "month",
               payment_sequential, payment_type, payment_installments, payment_value
        FROM r_orders JOIN payments USING (order_id)""",
}


def _with(body: str, **more: str) -> str:
    ctes = {**CTES, **more}
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in ctes.items()) + "\n" + body


def _doubles(columns: str) -> str:
    """Select list with the money columns as doubles."""
    money = ("price", "freight_value", "payment_value")
    names = [c.strip() for c in columns.split(",")]
    return ", ".join(f"cast({c} AS double) AS {c}" if c in money else c for c in names)


ITEM = "order_id, order_item_id, product_id, seller_id, price, freight_value"
# The total order behind the surviving row of a key.
RANK = """row_number() OVER (PARTITION BY order_id, order_item_id
    ORDER BY product_id NULLS FIRST, seller_id NULLS FIRST, price NULLS FIRST, freight_value NULLS FIRST)"""
# The same where identifiers are text.
TEXT_RANK = RANK.replace("product_id", "cast(product_id AS varchar)").replace("seller_id", "cast(seller_id AS varchar)")
NULL_KEYED = """SELECT order_id, order_item_id, nullif(product_id, 7) AS product_id,
    nullif(seller_id, 3) AS seller_id, price, freight_value FROM items"""
NO_LINE = """SELECT order_id, nullif(order_item_id, 7) AS order_item_id, product_id, seller_id,
    price, freight_value FROM items"""
TWICE = "SELECT * FROM items UNION ALL SELECT * FROM items"
ORDER_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
ORDER_PARTS = 'cast(year(o_orderdate) AS integer) AS "year", cast(month(o_orderdate) AS integer) AS "month"'


def _null_profile(source: str) -> str:
    columns = [c.strip() for c in ITEM.split(",")]
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS null_rows, count(*) AS total_rows, "
        f"(count(*) - count({c})) / cast(count(*) AS double) AS null_ratio FROM {source}"
        for c in columns
    )


def _counts(layer: str, rows: dict[str, str], rejected: dict[str, str] | None = None) -> str:
    rejected = rejected or {}
    return " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{t}' AS \"table\", cast(({n}) AS bigint) AS rows_processed, "
        f"'SUCCESS' AS status, cast(({rejected.get(t, 'SELECT 0')}) AS bigint) AS rows_rejected"
        for t, n in rows.items()
    )


def _count(source: str) -> str:
    return f"SELECT count(*) FROM {source}"


RAW = {
    "customers": _count("customers"),
    "orders": _count("r_orders"),
    "order_items": _count("items"),
    "order_payments": _count("payments"),
    "order_reviews": _count("reviews"),
    "products": _count("products"),
    "sellers": _count("sellers"),
    "geolocation": _count("places"),
    "category_translation": "SELECT count(DISTINCT product_category_name) FROM products",
}
UNIQUE_ITEMS = "(SELECT DISTINCT order_id, order_item_id FROM items)"
GOLD = {
    "dim_customers": RAW["customers"],
    "dim_sellers": RAW["sellers"],
    "dim_products": RAW["products"],
    "dim_geolocation": _count("geo"),
    "dim_dates": "SELECT date_diff('day', DATE '1995-01-01', DATE '2001-12-31') + 1",
    "fact_order_payments": _count("paid"),
    "fact_order_sales": f"SELECT count(*) FROM {UNIQUE_ITEMS} JOIN r_orders USING (order_id)",
}

# The calendar of ``checks.queries``: some of the days, with quarters that start a month later.
CALENDAR = """
    SELECT cast(d AS date) AS d, year(d) AS y, ceil(((month(d) + 10) % 12 + 1) / 3) AS q,
           dayofweek(d) IN (0, 6) AS w
    FROM unnest(generate_series(DATE '1996-01-01', DATE '1997-06-30', INTERVAL 1 DAY)) AS t(d)"""


def _by_calendar(fact: str, amount: str, total: str, rows: str) -> str:
    return f"""
        SELECT cast(coalesce(y, year(day)) AS integer) AS "year",
               cast(coalesce(q, quarter(day)) AS integer) AS "quarter",
               coalesce(w, dayofweek(day) IN (0, 6)) AS is_weekend,
               cast(sum({amount}) AS double) AS {total}, count(*) AS {rows}
        FROM (SELECT *, CASE WHEN order_status <> 'P' THEN cast(order_purchase_timestamp AS date) END AS day
              FROM {fact})
             LEFT JOIN calendar ON d = day
        GROUP BY 1, 2, 3"""


ORACLES: dict[str, str] = {
    # sources and sinks
    "csv_source_typed": f"SELECT {ORDER_COLUMNS} FROM orders",
    "inferred_type_drift": """
        SELECT cast(c_custkey AS bigint) AS c_custkey,
               CASE c_custkey % 3 WHEN 0 THEN cast(c_custkey AS varchar) WHEN 1 THEN 'A' || c_custkey
                    ELSE lpad(cast(c_custkey AS varchar), 9, '0') END AS zip,
               CASE c_custkey % 3 WHEN 0 THEN cast(c_custkey AS double) WHEN 1 THEN c_custkey + cast(0.5 AS double) END
                   AS "limit",
               CASE c_custkey % 3 WHEN 0 THEN TIMESTAMP '2020-01-02 00:00:00' WHEN 1 THEN TIMESTAMP '2020-01-02 03:04:05'
                    ELSE TIMESTAMP '2020-01-03 00:00:00' END AS since,
               'widened zip: int to string; widened limit: int to double; widened since: date to timestamp' AS widened
        FROM customer""",
    "csv_source_inferred": f"SELECT {ORDER_COLUMNS} FROM orders",
    "csv_corrupt_rows": """
        SELECT o_orderkey, o_orderkey || ',n/a,' || o_orderpriority AS record FROM orders WHERE o_orderstatus = 'P'""",
    "raw_line_audit_report": """
        SELECT 'customer.csv' AS source, count(*) AS expected_lines, count(*) AS actual_lines, 'OK' AS status
        FROM customer
        UNION ALL SELECT 'orders.csv', count(*) + 1, count(*), 'MISMATCH' FROM orders
        UNION ALL SELECT 'supplier.csv', count(*), NULL, 'MISSING' FROM supplier""",
    "csv_column_orders": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders",
    "csv_decimal_places": """
        SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN 2.5::DOUBLE END AS price,
               CASE WHEN o_orderstatus = 'P' THEN o_orderkey || ',1.005' END AS record
        FROM orders""",
    "bronze_keeps_bad_timestamps": _with("""
        SELECT order_id,
               CASE WHEN order_status <> 'P' THEN order_purchase_timestamp END AS order_purchase_timestamp,
               CASE WHEN order_status <> 'F' THEN order_approved_at END AS order_approved_at
        FROM r_orders"""),
    "partition_range_of_another_zone": """
        SELECT o_orderkey, o_orderdate FROM orders
        WHERE o_orderdate >= DATE '1997-03-01' AND o_orderdate < DATE '1997-05-01'""",
    "silver_partition_refresh": _with("""
        SELECT order_id, CASE WHEN "year" = 1996 THEN 'Z' ELSE order_status END AS order_status,
               order_purchase_timestamp, "year", "month"
        FROM r_orders"""),
    "silver_upsert": _with("""
        SELECT order_id,
               CASE order_id % 10 WHEN 0 THEN 'M' WHEN 1 THEN 'S' ELSE order_status END AS order_status,
               order_purchase_timestamp + to_days(CASE WHEN order_id % 10 = 0 THEN 40 ELSE 0 END)
                   AS order_purchase_timestamp,
               'kept' AS reason,
               cast(year(order_purchase_timestamp + to_days(CASE WHEN order_id % 10 = 0 THEN 40 ELSE 0 END)) AS integer)
                   AS "year",
               cast(month(order_purchase_timestamp + to_days(CASE WHEN order_id % 10 = 0 THEN 40 ELSE 0 END)) AS integer)
                   AS "month"
        FROM r_orders
        UNION ALL
        SELECT order_id, order_status, order_purchase_timestamp, 'Duplicate Primary Key', NULL, NULL
        FROM r_orders WHERE order_id % 10 < 2
        UNION ALL
        SELECT order_id, 'S', order_purchase_timestamp, 'Duplicate Primary Key', NULL, NULL
        FROM r_orders WHERE order_id % 100 = 1"""),
    "silver_repeated_rejects": _with("""
        SELECT "year", CASE WHEN "year" = 1996 THEN count(*) ELSE 3 * count(*) END AS rejects
        FROM r_orders WHERE order_id % 5 = 0 GROUP BY "year" """),
    "silver_loads_reject_once": _with(
        f"""SELECT CASE WHEN rn > 1 THEN 'Duplicate Primary Key' ELSE 'Null Primary Key' END AS _dlq_reason,
                   count(*) AS rejects
            FROM (SELECT *, {RANK} AS rn FROM keyed) WHERE rn > 1 OR order_item_id IS NULL GROUP BY 1""",
        keyed=NO_LINE,
    ),
    "stamps_and_guards": """
        SELECT count(*) AS ingested, count(*) AS updated, count(*) AS n, 0 AS empty, true AS same_columns,
               'yes' AS guarded
        FROM orders""",
    "bronze_append": _with("SELECT * FROM customers UNION ALL SELECT * FROM customers"),
    "bronze_skip_loaded": _with("SELECT * FROM customers"),
    "overwrite_table": f"SELECT {ORDER_COLUMNS} FROM orders",
    "partitioned_overwrite": f"SELECT {ORDER_COLUMNS}, {ORDER_PARTS} FROM orders",
    "partition_pruned_range": f"""
        SELECT {ORDER_COLUMNS}, {ORDER_PARTS} FROM orders
        WHERE o_orderdate >= DATE '1996-03-15' AND o_orderdate < DATE '1997-02-11'""",
    "dynamic_partition_overwrite": f"""
        SELECT o_orderkey, o_custkey,
               CASE WHEN year(o_orderdate) = 1996 THEN 'Z' ELSE o_orderstatus END AS o_orderstatus,
               o_totalprice, o_orderdate, o_orderpriority, {ORDER_PARTS}
        FROM orders""",
    # columns
    "sanitize_column_names": """
        SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_extendedprice AS price_usd,
               l_returnflag AS return_flag
        FROM lineitem""",
    "cast_timestamp_text": """
        SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS o_orderdate FROM orders""",
    "partition_columns": f"SELECT o_orderkey, o_orderdate, {ORDER_PARTS} FROM orders",
    # quality
    "dedup_valid": _with(f"SELECT {_doubles(ITEM)} FROM (SELECT *, {RANK} AS rn FROM items) WHERE rn = 1"),
    "dedup_rejects": _with(
        f"SELECT {_doubles(ITEM)} FROM (SELECT *, {RANK} AS rn FROM twice) WHERE rn > 1", twice=TWICE
    ),
    "except_distinct_rejects": _with(
        f"""SELECT {_doubles(ITEM)} FROM (
            SELECT {ITEM} FROM twice EXCEPT SELECT {ITEM} FROM (SELECT *, {RANK} AS rn FROM twice) WHERE rn = 1)""",
        twice=TWICE,
    ),
    "null_valid": _with(
        f"SELECT {_doubles(ITEM)} FROM keyed WHERE product_id IS NOT NULL AND seller_id IS NOT NULL",
        keyed=NULL_KEYED,
    ),
    "null_rejects": _with(
        f"SELECT {_doubles(ITEM)} FROM keyed WHERE product_id IS NULL OR seller_id IS NULL", keyed=NULL_KEYED
    ),
    "dlq_reasons": _with(
        f"""SELECT {_doubles(ITEM)}, 'Null Primary Key' AS _dlq_reason
            FROM keyed WHERE product_id IS NULL OR seller_id IS NULL""",
        keyed=NULL_KEYED,
    ),
    "dlq_append": _with(
        f"""SELECT {_doubles(ITEM)}, 'first' AS _dlq_reason, NULL AS note FROM bad
            UNION ALL SELECT {_doubles(ITEM)}, 'second', 'seen before' FROM bad""",
        keyed=NULL_KEYED,
        bad="SELECT * FROM keyed WHERE product_id IS NULL OR seller_id IS NULL",
    ),
    "profile_nulls": _with(_null_profile("keyed"), keyed=NULL_KEYED),
    "profile_duplicates": _with(f"""
        SELECT count(*) AS total_rows, count(*) - (SELECT count(*) FROM {UNIQUE_ITEMS}) AS duplicate_rows,
               (count(*) - (SELECT count(*) FROM {UNIQUE_ITEMS})) / cast(count(*) AS double) AS duplicate_ratio
        FROM items"""),
    "quality_gate_report": _with(
        f"""SELECT *, ratio <= max_ratio AS passed FROM (
            SELECT 'null_ratio' AS "check", "column", null_ratio AS ratio, cast(0.05 AS double) AS max_ratio
            FROM ({_null_profile("keyed")})
            UNION ALL
            SELECT 'duplicate_ratio', 'order_id,order_item_id',
                   (count(*) - (SELECT count(*) FROM {UNIQUE_ITEMS})) / cast(count(*) AS double),
                   cast(0.01 AS double)
            FROM items)""",
        keyed=NULL_KEYED,
    ),
    # silver
    "silver_items": _with(
        f"""SELECT {_doubles(ITEM)} FROM (SELECT *, {RANK} AS rn FROM keyed)
            WHERE rn = 1 AND order_item_id IS NOT NULL""",
        keyed=NO_LINE,
    ),
    "silver_rejects": _with(
        f"""SELECT {_doubles(ITEM)},
                   CASE WHEN rn > 1 THEN 'Duplicate Primary Key' ELSE 'Null Primary Key' END AS _dlq_reason
            FROM (SELECT *, {RANK} AS rn FROM keyed) WHERE rn > 1 OR order_item_id IS NULL""",
        keyed=NO_LINE,
    ),
    "silver_orders": _with("""
        SELECT order_id, customer_id, order_status, order_purchase_timestamp, "year", "month"
        FROM r_orders WHERE order_status <> 'P'"""),
    "silver_bad_timestamps": _with("""
        SELECT order_id, customer_id, order_status, '?' AS order_purchase_timestamp,
               'Invalid Timestamp' AS _dlq_reason
        FROM r_orders WHERE order_status = 'P'"""),
    # gold
    "dim_customers": _with("SELECT * FROM customers"),
    "dim_sellers": _with("SELECT * FROM sellers"),
    "dim_products": _with("SELECT * FROM products"),
    "dim_geolocation": _with("SELECT * FROM geo"),
    "dim_dates": """
        SELECT d AS date_sk, d AS full_date, cast(year(d) AS integer) AS "year", cast(month(d) AS integer) AS "month",
               cast(day(d) AS integer) AS "day", cast(quarter(d) AS integer) AS "quarter",
               cast(dayofweek(d) + 1 AS integer) AS day_of_week, dayofweek(d) IN (0, 6) AS is_weekend
        FROM (SELECT cast(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS date) AS d
              FROM orders)""",
    "review_avg": _with("SELECT * FROM scores"),
    "fact_order_payments": _with(
        'SELECT order_id, customer_id, order_status, order_purchase_timestamp, "year", "month", payment_sequential, '
        "payment_type, payment_installments, cast(payment_value AS double) AS payment_value FROM paid"
    ),
    "fact_order_sales": _with(
        "SELECT * REPLACE (cast(price AS double) AS price, cast(freight_value AS double) AS freight_value) FROM sales"
    ),
    # views and metrics
    "master_sales": _with(
        "SELECT * REPLACE (cast(price AS double) AS price, cast(freight_value AS double) AS freight_value) FROM wide"
    ),
    "master_payments": _with("SELECT * REPLACE (cast(payment_value AS double) AS payment_value) FROM paid"),
    "seller_geo": _with("""
        SELECT seller_id, seller_zip_code_prefix, seller_city, seller_state, avg_latitude AS seller_lat,
               avg_longitude AS seller_lon
        FROM sellers LEFT JOIN geo ON geolocation_zip_code_prefix = seller_zip_code_prefix"""),
    "kpi_revenue": _with("SELECT cast(sum(price) AS double) AS revenue FROM wide"),
    "kpi_orders": _with("SELECT count(DISTINCT order_id) AS orders FROM wide"),
    "kpi_customers": _with("SELECT count(DISTINCT customer_unique_id) AS customers FROM wide"),
    "top_categories": _with("""
        SELECT product_category_name, cast(sum(price) AS double) AS revenue FROM wide
        GROUP BY product_category_name ORDER BY revenue DESC, product_category_name NULLS FIRST LIMIT 10"""),
    "freight_by_state": _with("""
        SELECT customer_state, cast(sum(freight_value) AS double) / count(freight_value) AS avg_freight FROM wide
        GROUP BY customer_state ORDER BY avg_freight DESC, customer_state NULLS FIRST LIMIT 15"""),
    "monthly_revenue": _with("""
        SELECT cast(date_trunc('month', order_purchase_timestamp) AS timestamp) AS month_start,
               cast(sum(price) AS double) AS revenue
        FROM wide GROUP BY 1 ORDER BY 1"""),
    "order_status_share": _with(
        "SELECT order_status, count(DISTINCT order_id) AS orders FROM wide GROUP BY order_status"
    ),
    "top_seller_cities": _with("""
        SELECT seller_city, cast(sum(price) AS double) AS revenue FROM wide
        GROUP BY seller_city ORDER BY revenue DESC, seller_city NULLS FIRST LIMIT 10"""),
    "payment_types": _with("SELECT payment_type, count(order_id) AS payments FROM paid GROUP BY payment_type"),
    "installment_histogram": _with(
        "SELECT payment_installments, count(order_id) AS payments FROM paid GROUP BY payment_installments"
    ),
    "delivery_performance": _with("""
        SELECT month_start, count(*) AS delivered_orders, count(*) FILTER (WHERE NOT on_time) AS late_orders,
               count(*) FILTER (WHERE on_time) / cast(count(*) AS double) AS on_time_share
        FROM (SELECT DISTINCT order_id,
                     cast(date_trunc('month', order_purchase_timestamp) AS timestamp) AS month_start,
                     order_delivered_customer_date <= order_estimated_delivery_date AS on_time
              FROM sales WHERE order_delivered_customer_date IS NOT NULL)
        GROUP BY month_start ORDER BY month_start"""),
    "payments_by_customer_state": _with("""
        SELECT customer_state, cast(sum(payment_value) AS double) AS paid, count(*) AS payments
        FROM paid LEFT JOIN customers USING (customer_id) GROUP BY customer_state"""),
    "sales_by_calendar": _with(
        _by_calendar("sales", "price", "revenue", "items"), calendar=CALENDAR
    ),
    "payments_by_calendar": _with(
        _by_calendar("paid", "payment_value", "paid", "payments"), calendar=CALENDAR
    ),
    "sums_of_any_double": """
        SELECT l_returnflag, CASE l_returnflag WHEN 'A' THEN 'no number' WHEN 'R' THEN 'large' ELSE 'plain' END
                   AS size,
               CASE WHEN l_returnflag NOT IN ('A', 'R')
                   THEN round(cast(sum(cast(l_extendedprice AS decimal(18, 2))) AS double), 2) END AS total
        FROM lineitem GROUP BY l_returnflag""",
    "top_categories_deduplicated": _with(
        """SELECT product_category_name, cast(sum(price) AS double) AS revenue
           FROM kept JOIN orders ON o_orderkey = order_id LEFT JOIN products USING (product_id)
           GROUP BY product_category_name ORDER BY revenue DESC, product_category_name NULLS FIRST LIMIT 10""",
        kept=f"SELECT {ITEM} FROM (SELECT *, {RANK} AS rn FROM items) WHERE rn = 1",
    ),
    # runs
    "run_audit_latest": """
        SELECT event_type AS layer, 't' || user_id AS "table", max(ts) AS last_run,
               arg_max(event_id, ts) AS rows_processed,
               CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status
        FROM events GROUP BY event_type, user_id""",
    "published_master_sales": _with(
        "SELECT * REPLACE (cast(price AS double) AS price, cast(freight_value AS double) AS freight_value) FROM wide",
        sales=f"""
            SELECT kept.*, customer_id, order_status, order_purchase_timestamp, order_approved_at,
                   order_delivered_customer_date, order_estimated_delivery_date, "year", "month", avg_review_score
            FROM (SELECT {ITEM} FROM (SELECT *, {TEXT_RANK} AS rn FROM items) WHERE rn = 1) AS kept
                 JOIN r_orders USING (order_id) LEFT JOIN scores USING (order_id)""",
    ),
    "incremental_run": _with(
        f"""
        SELECT 'sale' AS kind, order_id, order_item_id AS line,
               cast(price + CASE WHEN order_id % 7 = 0 THEN 1 ELSE 0 END AS double) AS amount, order_status, "year",
               "month", avg_review_score
        FROM (SELECT {ITEM} FROM (SELECT *, {TEXT_RANK} AS rn FROM items) WHERE rn = 1)
             JOIN late_orders USING (order_id) LEFT JOIN late_scores USING (order_id)
        UNION ALL
        SELECT 'payment', order_id, payment_sequential,
               cast(payment_value + CASE WHEN order_id % 11 = 0 THEN 1 ELSE 0 END AS double), order_status, "year",
               "month", NULL
        FROM late_orders JOIN payments USING (order_id)""",
        late_orders="""
            SELECT order_id, CASE WHEN order_id % 10 = 0 THEN 'M' ELSE order_status END AS order_status,
                   cast(year(bought) AS integer) AS "year", cast(month(bought) AS integer) AS "month"
            FROM (SELECT *, order_purchase_timestamp + to_days(CASE WHEN order_id % 10 = 0 THEN 40 ELSE 0 END) AS bought
                  FROM r_orders)""",
        late_scores="""
            SELECT order_id, cast(sum(review_score) AS double) / count(review_score) AS avg_review_score
            FROM (SELECT * FROM reviews UNION ALL
                  SELECT event_id // 3, 1 FROM events WHERE event_id % 15 = 0) GROUP BY order_id""",
    ),
    "medallion_audit": _with(
        " UNION ALL ".join(
            [
                _counts("bronze", RAW),
                _counts(
                    "silver",
                    {**RAW, "order_items": _count(UNIQUE_ITEMS)},
                    {"order_items": f"SELECT count(*) - (SELECT count(*) FROM {UNIQUE_ITEMS}) FROM items"},
                ),
                _counts("gold", GOLD),
            ]
        )
    ),
}
