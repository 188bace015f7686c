"""Work that an incremental run need not do."""

import datetime as dt
import os
import threading

from conftest import rows
from pyspark.sql import functions as F

from cartlake.plans import bronze, medallion, upsert
from cartlake.sources import tables
from cartlake.specs import INGESTED_AT, UPDATED_AT, TableSpec


def test_bronze_loads_run_side_by_side(spark, layers, monkeypatch):
    """Also where they write to one log of files."""
    both = threading.Barrier(2, timeout=60)

    def load(spark, spec, *args):
        both.wait()
        return bronze.Loaded(1, 0)

    monkeypatch.setattr(bronze, "load", load)
    medallion.run_bronze(spark, "none", [TableSpec("a", "a.csv"), TableSpec("b", "b.csv")], layers, skip_loaded=True)


def test_files_of_loads_side_by_side_are_all_logged(spark, layers, tmp_path):
    specs = []
    for i in range(4):
        (tmp_path / f"t{i}.csv").write_text("k,v\n1,2\n3,4\n")
        specs.append(TableSpec(f"t{i}", f"t{i}.csv"))
    for want in (2, 2):
        medallion.run_bronze(spark, f"file://{tmp_path}", specs, layers, skip_loaded=True)
        assert [spark.table(f"{layers.bronze}.t{i}").count() for i in range(4)] == [want] * 4


def test_replaced_partitions_are_seen_by_the_write(spark, layers, monkeypatch):
    """A frame is not run once more to learn which partitions have rows; those without any are dropped."""
    name = f"{layers.gold}.fact"
    first = spark.createDataFrame([(1, 2016, 1), (2, 2016, 2), (3, None, None), (4, 2017, 1)], "k int, year int, month int")
    tables.write_table(first, name, partition_by=("year", "month"))
    seen = []
    real = tables.partitions_of
    monkeypatch.setattr(tables, "partitions_of", lambda df, by: seen.append(df) or real(df, by))
    new = spark.createDataFrame([(5, 2016, 1), (6, 2016, 1)], first.schema)
    touched = {(2016, 1), (2016, 2), (None, None), (2018, 1)}
    assert tables.replace_partitions(new, name, ("year", "month"), touched) == 2
    assert all(df is not new for df in seen)
    assert rows(spark.table(name), "k", "year", "month") == [(4, 2017, 1), (5, 2016, 1), (6, 2016, 1)]


def test_partitions_of_other_types(spark, layers):
    name = f"{layers.gold}.fact"
    tables.write_table(spark.createDataFrame([(1, "a/"), (2, "b")], "k int, p string"), name, partition_by=("p",))
    new = spark.createDataFrame([(3, "b")], "k int, p string")
    tables.replace_partitions(new, name, ("p",), {("a/",), ("b",)})
    assert rows(spark.table(name), "k", "p") == [(3, "b")]


def _prepared(spark, layers, had, new):
    spec = TableSpec("t", "t.csv", keys=("k",))
    kinds = f"k int, v int, {INGESTED_AT} timestamp"
    silver = spark.createDataFrame(had, kinds).withColumn(UPDATED_AT, F.current_timestamp())
    tables.write_table(silver, f"{layers.silver}.t")
    valid = spark.createDataFrame(new, kinds)
    batch = upsert.prepare(
        spark, spec, layers, valid.withColumn(UPDATED_AT, F.current_timestamp()), None, valid, ["x"]
    )
    upsert.apply(spark, spec, layers, batch)
    return os.listdir(batch.path.removeprefix("file:")), rows(spark.table(f"{layers.silver}.t"), "k", "v")


def test_no_late_rows_are_looked_for_where_all_are_newer(spark, layers):
    old, now = dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 2)
    made, found = _prepared(spark, layers, [(1, 1, old), (2, 2, None)], [(1, 5, now), (2, 6, None), (3, 7, now)])
    assert "late" not in made
    assert found == [(1, 5), (2, 6), (3, 7)]


def test_late_rows_stay_behind(spark, layers, monkeypatch):
    """Dealt by their number too."""
    monkeypatch.setattr(upsert, "TASK_ROWS", 0)
    old, now = dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 2)
    made, found = _prepared(spark, layers, [(1, 1, now), (2, 2, old)], [(1, 5, old), (2, 6, now), (3, 7, old)])
    assert "late" in made
    assert found == [(1, 1), (2, 6), (3, 7)]
