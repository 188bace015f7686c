import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlake.functions.kinds import wider
from cartlake.plans import bronze, medallion, silver
from cartlake.sources.audit import load_runs
from cartlake.sources.tables import widen_table, write_dlq, write_table
from cartlake.specs import LOAD_ID, TableSpec

BIG, INT, TEXT, REAL = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType()


@pytest.mark.parametrize(
    "a, b, both",
    [
        (INT, INT, INT),
        (INT, BIG, BIG),
        (INT, REAL, REAL),
        (BIG, REAL, TEXT),
        (T.FloatType(), INT, REAL),
        (INT, T.DecimalType(5, 2), T.DecimalType(12, 2)),
        (T.DecimalType(20, 0), BIG, T.DecimalType(20, 0)),
        (T.DecimalType(38, 0), T.DecimalType(10, 4), TEXT),
        (T.DateType(), T.TimestampType(), T.TimestampType()),
        (T.TimestampType(), T.TimestampNTZType(), TEXT),
        (T.BooleanType(), INT, TEXT),
        (T.DateType(), INT, TEXT),
        (T.NullType(), INT, INT),
    ],
)
def test_wider_holds_both(a, b, both):
    assert wider(a, b) == wider(b, a) == both


def test_nested_types_do_not_widen():
    with pytest.raises(ValueError, match="no common type"):
        wider(T.ArrayType(INT), TEXT)
    assert wider(T.ArrayType(INT), T.ArrayType(INT)) == T.ArrayType(INT)


def test_a_table_is_rewritten_only_for_a_wider_type(spark, layers):
    name = f"{layers.silver}.t"
    write_table(spark.createDataFrame([(1, 2, 7)], "a int, b int, p int"), name, partition_by=["p"])
    files = spark.table(name).inputFiles()
    assert widen_table(spark, name, {"a": INT, "b": T.ShortType(), "p": TEXT, "other": TEXT}) == []
    assert spark.table(name).inputFiles() == files
    assert widen_table(spark, name, {"a": TEXT, "p": TEXT}) == ["a: int to string"]
    table = spark.table(name)
    assert table.dtypes == [("a", "string"), ("b", "int"), ("p", "int")] and rows(table) == [("1", 2, 7)]
    write_table(spark.createDataFrame([("x", 3, 8)], "a string, b int, p int"), name, "partitions", ["p"])
    assert rows(spark.table(name)) == [("1", 2, 7), ("x", 3, 8)]


def _put(folder, cells, name):
    (folder / f"{name}.csv").write_text("id,zip,n,day,bought\n" + "".join(",".join(c) + "\n" for c in cells))


LOADS = [
    [("1", "123", "5", "2020-01-02", "2018-01-01 00:00:00"), ("1", "123", "5", "2020-01-02", "2018-01-01 00:00:00")],
    [("2", "A12", "", "2020-01-02 03:04:05", "2018-02-01 00:00:00"), ("3", "0456", "", "", "2018-01-05 00:00:00")],
    [("4", "0456", "2.5", "2020-01-03", "2018-03-01 00:00:00"), ("4", "0456", "2.5", "2020-01-03", "2018-03-01 00:00:00")],
]


@pytest.mark.parametrize("by_load", [False, True])
def test_loads_keep_their_cells(spark, layers, tmp_path, by_load):
    spec = TableSpec("t", "t*.csv")
    for i, cells in enumerate(LOADS):
        _put(tmp_path, cells, f"t{i}")
        medallion.run_bronze(spark, str(tmp_path), [spec], layers, skip_loaded=True, by_load=by_load)
    table = spark.table(f"{layers.bronze}.t")
    assert dict(table.dtypes) | {"_ingested_at": 0, LOAD_ID: 0} == {
        "id": "int", "zip": "string", "n": "double", "day": "timestamp", "bought": "timestamp", "_ingested_at": 0, LOAD_ID: 0
    }
    got = rows(table.selectExpr("id", "zip", "n", "cast(day AS string) AS day"))
    assert got == sorted(
        [
            (1, "123", 5.0, "2020-01-02 00:00:00"),
            (1, "123", 5.0, "2020-01-02 00:00:00"),
            (2, "A12", None, "2020-01-02 03:04:05"),
            (3, "0456", None, None),
            (4, "0456", 2.5, "2020-01-03 00:00:00"),
            (4, "0456", 2.5, "2020-01-03 00:00:00"),
        ],
        key=repr,
    )
    notes = load_runs(spark, medallion.audit_table(layers)).orderBy("last_run").collect()
    assert [(r.message, r.status, r.rows_processed) for r in notes] == [
        (None, "SUCCESS", 2),
        ("widened zip: int to string; widened day: date to timestamp", "SUCCESS", 2),
        ("widened n: int to double", "SUCCESS", 2),
    ]
    assert not by_load or table.select(LOAD_ID).distinct().count() == 3


@pytest.mark.parametrize("mode", ["overwrite", "partitions", "incremental"])
def test_silver_follows(spark, layers, tmp_path, mode):
    """Silver rows and dead letters take wider columns, however silver is brought up to date."""
    spec = TableSpec(
        "t", "t*.csv", keys=("id",), timestamp_column="bought", partition_by=("year", "month")
    )
    for i, cells in enumerate(LOADS):
        _put(tmp_path, cells, f"t{i}")
        bronze.load(spark, spec, str(tmp_path), layers, skip_loaded=True, by_load=True)
        silver.load(spark, spec, layers, mode=mode)
    table = spark.table(f"{layers.silver}.t")
    assert dict(table.dtypes)["zip"] == "string"
    assert rows(table, "id", "zip", "n", "month") == [
        (1, "123", 5.0, 1), (2, "A12", None, 2), (3, "0456", None, 1), (4, "0456", 2.5, 3)
    ]
    dead = spark.table(f"{layers.dlq}.t_rejected")
    assert rows(dead, "id", "zip") == [(1, "123"), (4, "0456")]


def test_key_that_becomes_text(spark, layers, tmp_path):
    spec = TableSpec("t", "t*.csv", keys=("id",), timestamp_column="bought", partition_by=("year", "month"))
    for i, key in enumerate(("1", "B1")):
        _put(tmp_path, [(key, "1", "1", "", f"2018-0{i + 1}-01 00:00:00")], f"t{i}")
        bronze.load(spark, spec, str(tmp_path), layers, skip_loaded=True, by_load=True)
        silver.load(spark, spec, layers, mode="partitions")
    assert rows(spark.table(f"{layers.silver}.t"), "id") == [("1",), ("B1",)]


def test_dead_letters_widen(spark, layers):
    name = f"{layers.dlq}.t"
    write_dlq(spark.createDataFrame([(1,)], "a int"), name, "r")
    write_dlq(spark.createDataFrame([("x",)], "a string"), name, "r")
    write_dlq(spark.createDataFrame([(2,)], "a int"), name, "s")
    assert rows(spark.table(name), "a", "_dlq_reason") == [("1", "r"), ("2", "s"), ("x", "r")]
    emptied = spark.table(name).where(F.lit(False)).select("a")
    assert write_dlq(emptied, name, "r") == 0
