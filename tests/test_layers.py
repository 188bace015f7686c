"""Bronze, silver and gold jobs on small raw files."""

import datetime as dt

import pytest
from conftest import final_plan, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlake import __main__ as command
from cartlake.operators.duplicates import profile_keys
from cartlake.operators.quality import QualityError
from cartlake.plans import bronze, gold, medallion, metrics, silver, views
from cartlake.sources.audit import latest_runs, load_runs
from cartlake.sources.csv import RawFilesError
from cartlake.specs import QualityThresholds, TableSpec, retail_specs

ORDERS = TableSpec(
    "orders",
    "orders.csv",
    ("order_id",),
    timestamp_column="bought",
    partition_by=("year", "month"),
    types={"order_id": T.StringType(), "n": T.IntegerType()},
)

RAW = {
    "customers": """customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state
c1,u1,01037,sao paulo,SP
c2,u1,01037,sao paulo,SP
c3,u2,99999,nowhere,XX
""",
    "orders": """order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_customer_date,order_estimated_delivery_date
o1,c1,delivered,2017-10-02 10:56:33,2017-10-02 11:00:00,2017-10-10 00:00:00,2017-10-20 00:00:00
o2,c2,delivered,2018-01-06 10:00:00,,2018-03-01 00:00:00,2018-02-01 00:00:00
o3,c3,canceled,2018-01-07 10:00:00,,,2018-02-01 00:00:00
o1,c1,delivered,2017-10-02 10:56:33,2017-10-02 11:00:00,2017-10-10 00:00:00,2017-10-20 00:00:00
""",
    "order_items": """order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value
o1,1,p1,s1,2017-10-05 00:00:00,10.10,1.00
o1,2,p2,s1,2017-10-05 00:00:00,20.20,2.00
o2,1,p1,s2,2018-01-09 00:00:00,30.30,3.00
o9,1,p1,s2,2018-01-09 00:00:00,99.00,3.00
o2,,p1,s2,2018-01-09 00:00:00,5.00,3.00
o3,one,p3,s2,2018-01-09 00:00:00,40.40,4.00
o3,1,p3,s2,2018-01-09 00:00:00,40.40,4.00
""",
    "order_payments": """order_id,payment_sequential,payment_type,payment_installments,payment_value
o1,1,credit_card,3,20.00
o1,2,voucher,1,13.30
o2,1,boleto,1,33.30
""",
    "order_reviews": """review_id,order_id,review_score,review_comment_message,review_creation_date
r1,o1,5,"very
good",2017-10-11 00:00:00
r2,o1,2,"so ""so"", really",2017-10-12 00:00:00
r3,o3,1,,2018-01-08 00:00:00
""",
    "products": """product_id,product_category_name,product_name_lenght,product_description_lenght,product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm
p1,beleza_saude,40,100,1,225,16,10,14
p2,sem_traducao,44,276,1,1000,30,18,20
p3,,46,250,1,154,18,9,15
""",
    "sellers": """seller_id,seller_zip_code_prefix,seller_city,seller_state
s1,01037,sao paulo,SP
s2,20000,rio,RJ
""",
    "geolocation": """geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state
01037,-23.5,-46.5,sao paulo,SP
01037,-23.7,-46.7,são paulo,SP
01037,-23.9,-46.9,sao paulo,SP
20000,-22.0,-43.0,rio,RJ
""",
    "category_translation": """product_category_name,product_category_name_english
beleza_saude,health_beauty
""",
}


@pytest.fixture
def raw(tmp_path):
    for name, text in RAW.items():
        (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8")
    return str(tmp_path)


def put_orders(tmp_path, text, name="orders.csv"):
    (tmp_path / name).write_text(text, encoding="utf-8")
    return str(tmp_path)


def test_bronze_keeps_cells_and_sends_corrupt_records_to_the_dlq(spark, layers, tmp_path):
    root = put_orders(tmp_path, "Order ID,N,Bought\n01,1,x\n02,two,y\n")
    assert bronze.load(spark, ORDERS, root, layers) == (1, 1)
    table = spark.table(f"{layers.bronze}.orders")
    assert table.columns == ["order_id", "n", "bought", "_ingested_at"]
    assert rows(table, "order_id", "n", "bought") == [("01", 1, "x")]
    dlq = spark.table(f"{layers.dlq}.orders_rejected")
    assert rows(dlq, "order_id", "_corrupt_record", "_dlq_reason") == [("02", "02,two,y", "Malformed Record")]


def test_bronze_with_inferred_types(spark, layers, tmp_path):
    root = put_orders(tmp_path, "order_id,n\n01,1\n")
    assert bronze.load(spark, TableSpec("orders", "orders.csv"), root, layers) == (1, 0)
    assert rows(spark.table(f"{layers.bronze}.orders"), "order_id", "n") == [(1, 1)]


def test_bronze_appends_again_or_skips_loaded_files(spark, layers, tmp_path):
    root = put_orders(tmp_path, "order_id,n,bought\n01,1,x\n")
    spec = TableSpec("orders", "orders*.csv", types=ORDERS.types)
    assert bronze.load(spark, spec, root, layers, skip_loaded=True).rows == 1
    assert bronze.load(spark, spec, root, layers, skip_loaded=True).rows == 0
    put_orders(tmp_path, "order_id,n,bought\n02,1,x\n", "orders2.csv")
    assert bronze.load(spark, spec, root, layers, skip_loaded=True).rows == 1
    assert bronze.load(spark, spec, root, layers).rows == 2
    assert spark.table(f"{layers.bronze}.orders").count() == 4


def _cleanse(spark, data, profiled, **options):
    df = spark.createDataFrame(data, "order_id string, n int, bought string")
    spec = TableSpec("orders", "", ("order_id",), timestamp_column="bought", partition_by=("year", "month"), **options)
    return silver.cleanse(df, spec, profile_keys(df, spec.keys) if profiled else None)


DIRTY = [
    ("A", 1, "2018-02-03 00:00:00"),
    ("A", 2, "2018-02-03 00:00:00"),
    (None, 1, "2018-02-03 00:00:00"),
    (None, 2, "2018-02-03 00:00:00"),
    (None, 3, "2018-02-03 00:00:00"),
    ("B", 1, "garbage"),
    ("C", 1, None),
]


@pytest.mark.parametrize("profiled", [False, True])
def test_cleanse_labels_duplicates_before_null_keys(spark, profiled):
    valid, rejects = _cleanse(spark, DIRTY, profiled)
    assert rows(valid, "order_id", "n", "year", "month") == [
        ("A", 1, 2018, 2),
        ("B", 1, None, None),
        ("C", 1, None, None),
    ]
    assert rows(rejects, "order_id", "n", "_dlq_reason") == [
        ("A", 2, "Duplicate Primary Key"),
        (None, 1, "Null Primary Key"),
        (None, 2, "Duplicate Primary Key"),
        (None, 3, "Duplicate Primary Key"),
    ]
    assert valid.count() + rejects.count() == len(DIRTY)
    assert valid.where("order_id IS NULL").count() == 0


@pytest.mark.parametrize("profiled", [False, True])
def test_cleanse_options(spark, profiled):
    valid, rejects = _cleanse(spark, DIRTY, profiled, null_keys_first=True, bad_timestamps="reject")
    assert rows(valid, "order_id", "n") == [("A", 1), ("C", 1)]
    assert rows(rejects, "order_id", "n", "_dlq_reason") == [
        ("A", 2, "Duplicate Primary Key"),
        ("B", 1, "Invalid Timestamp"),
        (None, 1, "Null Primary Key"),
        (None, 2, "Null Primary Key"),
        (None, 3, "Null Primary Key"),
    ]


def test_cleanse_needs_its_columns(spark):
    with pytest.raises(ValueError, match="no column missing"):
        silver.cleanse(spark.range(1), TableSpec("t", "", ("missing",)))
    with pytest.raises(ValueError, match="no column at"):
        silver.cleanse(spark.range(1), TableSpec("t", "", ("id",), timestamp_column="at"))


def test_silver_skips_a_missing_table_and_gates(spark, layers, tmp_path):
    assert silver.load(spark, ORDERS, layers) is None
    root = put_orders(tmp_path, "order_id,n,bought\n1,1,2018-01-01\n1,1,2018-01-01\n2,,2018-01-01\n")
    bronze.load(spark, ORDERS, root, layers)
    loaded = silver.load(spark, ORDERS, layers, QualityThresholds())
    assert (loaded.rows, loaded.rejected, len(loaded.breaches)) == (2, 1, 2)
    with pytest.raises(QualityError):
        silver.load(spark, ORDERS, layers, QualityThresholds(fail_on_quality_error=True))


def test_second_load_of_the_same_files(spark, layers, tmp_path):
    """The newest load wins; the rows of the older one become rejects."""
    root = put_orders(tmp_path, "order_id,n,bought\n1,1,2018-01-01\n2,2,2018-01-01\n")
    for _ in range(2):
        bronze.load(spark, ORDERS, root, layers)
    newest = spark.table(f"{layers.bronze}.orders").agg(F.max("_ingested_at")).first()[0]
    assert silver.load(spark, ORDERS, layers)[:2] == (2, 2)
    kept = spark.table(f"{layers.silver}.orders").select("_ingested_at").distinct().collect()
    assert [r[0] for r in kept] == [newest]


def test_whole_run(spark, layers, raw):
    written = medallion.run(spark, raw, retail_specs(), layers)
    assert written == {
        "dim_customers": 3,
        "dim_sellers": 2,
        "dim_products": 3,
        "dim_geolocation": 2,
        "dim_dates": 1461,
        "fact_order_payments": 3,
        "fact_order_sales": 4,
    }
    dlq = spark.table(f"{layers.dlq}.order_items_rejected")
    assert rows(dlq, "order_id", "_dlq_reason") == [("o2", "Null Primary Key"), ("o3", "Malformed Record")]
    assert spark.table(f"{layers.dlq}.orders_rejected").count() == 1
    runs = latest_runs(load_runs(spark, medallion.audit_table(layers)))
    assert runs.where("status = 'SUCCESS'").count() == 25
    assert rows(runs.where("rows_rejected > 0"), "layer", "table", "rows_processed", "rows_rejected") == [
        ("bronze", "order_items", 6, 1),
        ("silver", "order_items", 5, 1),
        ("silver", "orders", 3, 1),
    ]

    sales = spark.table(f"{layers.bi}.Master_Sales_Auto")
    assert tuple(sales.columns) == views.MASTER_SALES_COLUMNS
    star = gold.read_star(spark, layers)
    assert rows(sales) == rows(views.master_sales(star))
    picked = sales.select(
        "order_id", "price", "avg_review_score", "product_category_name", "seller_city", "customer_lat"
    )
    assert rows(picked.withColumn("price", F.col("price").cast("double"))) == [
        ("o1", 10.1, 3.5, "health_beauty", "sao paulo", -23.7),
        ("o1", 20.2, 3.5, None, "sao paulo", -23.7),
        ("o2", 30.3, None, "health_beauty", "rio", -23.7),
        ("o3", 40.4, 1.0, None, "rio", None),
    ]
    assert spark.table(f"{layers.bi}.Master_Payments_Auto").count() == 3
    assert spark.table(f"{layers.bi}.dim_dates").count() == 1461
    assert rows(metrics.top_categories(star)) == [("health_beauty", 40.4), (None, 60.6)]
    assert rows(metrics.kpi_customers(star)) == [(2,)]
    assert rows(metrics.delivery_performance(star)) == [
        (dt.datetime(2017, 10, 1), 1, 0, 1.0),
        (dt.datetime(2018, 1, 1), 1, 1, 0.0),
    ]
    weekend = metrics.sales_by_calendar(star).where("is_weekend")
    assert rows(weekend, "year", "revenue") == [(2018, 70.7)]
    places = views.seller_geo(star.dim_sellers, star.dim_geolocation)
    assert rows(places, "seller_id", "seller_lat") == [("s1", -23.7), ("s2", -22.0)]


def test_command_line(spark, raw, monkeypatch, tmp_path):
    """The steps are called with what the command line says."""
    calls = []
    for step in ("run_bronze", "run_silver", "run_gold"):
        monkeypatch.setattr(medallion, step, lambda *a, _s=step, **k: calls.append((_s, a[1:], k)))
    monkeypatch.setattr(command, "publish_views", lambda s: calls.append(("publish_views", (), {})))
    command.main(["all", raw, "--skip-loaded", "--input", "orders=o"])
    assert [c[0] for c in calls] == ["run_bronze", "run_silver", "run_gold", "publish_views"]
    assert calls[0][1][0] == raw and calls[0][2]["skip_loaded"] and calls[2][2]["names"] == {"orders": "o"}
    with pytest.raises(RawFilesError, match="customers.csv: MISMATCH, 4 of 99442 lines"):
        command.main(["verify", raw])
    with pytest.raises(SystemExit):
        command.main(["bronze"])


def test_a_failed_table_fails_the_run_after_the_others(spark, layers, raw):
    specs = retail_specs({"customers": "absent.csv"})
    with pytest.raises(medallion.RunFailed, match="bronze: customers"):
        medallion.run(spark, raw, specs, layers)
    runs = load_runs(spark, medallion.audit_table(layers))
    assert rows(runs.groupBy("layer", "status").count()) == [("bronze", "FAILED", 1), ("bronze", "SUCCESS", 8)]
    failed = runs.where("status = 'FAILED'").first()
    assert (failed["table"], failed.rows_processed) == ("customers", 0) and "absent.csv" in failed.message


def test_a_failed_gold_table_does_not_stop_the_others(spark, layers, raw, monkeypatch):
    specs = retail_specs()
    medallion.run_bronze(spark, raw, specs, layers)
    medallion.run_silver(spark, specs, layers)
    write = gold.write_table

    def broken(df, name, *args, **options):
        if name.endswith((".dim_sellers", ".dim_dates")):
            raise OSError("disk full")
        return write(df, name, *args, **options)

    monkeypatch.setattr(gold, "write_table", broken)
    with pytest.raises(gold.GoldFailed, match="dim_dates: disk full; dim_sellers: disk full"):
        medallion.run_gold(spark, layers)
    runs = load_runs(spark, medallion.audit_table(layers)).where("layer = 'gold'")
    assert rows(runs.groupBy("status").count()) == [("FAILED", 1), ("SUCCESS", 5)]


def test_gold_without_silver_is_recorded_as_failed(spark, layers):
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        medallion.run_gold(spark, layers)
    runs = load_runs(spark, medallion.audit_table(layers))
    assert rows(runs, "layer", "table", "status") == [("gold", "gold_layer_batch", "FAILED")]


def test_silver_records_partial_on_breach(spark, layers, raw):
    specs = [s for s in retail_specs() if s.name == "orders"]
    medallion.run_bronze(spark, raw, specs, layers)
    medallion.run_silver(spark, specs, layers, QualityThresholds())
    run = load_runs(spark, medallion.audit_table(layers)).where("layer = 'silver'").first()
    assert run.status == "PARTIAL" and "duplicate_ratio of order_id is 0.2500" in run.message


def test_products_may_keep_untranslated_names(spark):
    products = spark.createDataFrame(
        [("p1", "a"), ("p2", "b"), ("p3", None)], "product_id string, product_category_name string"
    ).withColumns(
        {
            c: F.lit(1)
            for c in (
                "product_name_lenght",
                "product_description_lenght",
                "product_photos_qty",
                "product_weight_g",
                "product_length_cm",
                "product_height_cm",
                "product_width_cm",
            )
        }
    )
    names = spark.createDataFrame([("a", "A")], "product_category_name string, product_category_name_english string")
    columns = ("product_id", "product_category_name")
    assert rows(gold.dim_products(products, names), *columns) == [("p1", "A"), ("p2", None), ("p3", None)]
    kept = gold.dim_products(products, names, coalesce_untranslated=True)
    assert rows(kept, *columns) == [("p1", "A"), ("p2", "b"), ("p3", None)]


def test_geolocation_names_ignore_nulls_and_break_ties(spark):
    geo = spark.createDataFrame(
        [
            ("z", 1.0, 2.0, "b", None),
            ("z", 2.0, 2.0, "a", "S"),
            ("z", None, 2.0, None, None),
            ("y", None, 1.0, None, None),
        ],
        "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, "
        "geolocation_city string, geolocation_state string",
    )
    assert rows(gold.dim_geolocation(geo).drop("_updated_at")) == [
        ("y", None, 1.0, None, None),
        ("z", 1.5, 2.0, "a", "S"),
    ]


def test_date_dimension(spark):
    dates = gold.dim_dates(spark)
    assert dates.count() == 1461 and dates.where("is_weekend").count() == 418
    assert rows(dates.where("date_sk = '2016-01-03'").drop("_updated_at")) == [
        (dt.date(2016, 1, 3), dt.date(2016, 1, 3), 2016, 1, 3, 1, 1, True)
    ]
    with pytest.raises(ValueError):
        gold.dim_dates(spark, dt.date(2016, 1, 2), dt.date(2016, 1, 1))


def _skewed_star(spark):
    """Two thirds of the sales are of one product."""
    sales = spark.range(600_000, numPartitions=8).selectExpr(
        "id AS order_id",
        "CASE WHEN id % 3 > 0 THEN 1 ELSE id % 500 END AS product_id",
        "id % 700 AS customer_id",
        "id % 90 AS seller_id",
        "'x' AS order_status",
        "timestamp_ntz '2018-01-01' AS order_purchase_timestamp",
        "timestamp_ntz '2018-01-02' AS order_delivered_customer_date",
        "timestamp_ntz '2018-01-03' AS order_estimated_delivery_date",
        "cast(1 AS decimal(18,2)) AS price",
        "cast(1 AS decimal(18,2)) AS freight_value",
        "1.0D AS avg_review_score",
        "sha2(cast(id AS string), 512) AS pad",
    )
    return gold.Star(
        spark.range(700).selectExpr(
            "id AS customer_id",
            "id AS customer_unique_id",
            "'z' AS customer_zip_code_prefix",
            "'c' AS customer_city",
            "'s' AS customer_state",
        ),
        spark.range(90).selectExpr("id AS seller_id", "'c' AS seller_city", "'s' AS seller_state"),
        spark.range(500).selectExpr("id AS product_id", "'n' AS product_category_name"),
        spark.sql("SELECT 'z' AS geolocation_zip_code_prefix, 1.0D AS avg_latitude, 2.0D AS avg_longitude"),
        gold.dim_dates(spark),
        sales,
        sales,
    )


def test_wide_view_splits_a_hot_product(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "200000")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200000")
    conf("spark.sql.shuffle.partitions", "16")
    wide = views.master_sales(_skewed_star(spark))
    assert "skew=true" in final_plan(wide)
    assert wide.count() == 600_000


def test_metrics_sum_before_they_shuffle_and_join(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = final_plan(metrics.top_categories(_skewed_star(spark)))
    assert plan.count("Join") == 1
    # Below the join the sales are summed up, and partly so before they are shuffled.
    sales_side = plan[plan.index("Join") :]
    assert sales_side.index("functions=[sum(") < sales_side.index("Exchange") < sales_side.index("partial_sum(")


def test_metrics_without_dimensions_join_none(spark):
    star = _skewed_star(spark)
    for metric in (metrics.kpi_revenue, metrics.kpi_orders, metrics.monthly_revenue, metrics.order_status_share):
        assert "Join" not in final_plan(metric(star))
