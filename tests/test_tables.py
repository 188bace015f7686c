import datetime as dt
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from conftest import final_plan, rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from cartlake.operators.columns import between_dates, with_partition_columns
from cartlake.sources import scratch, tables
from cartlake.sources.audit import FAILED, PARTIAL, latest_runs, load_runs, record_run
from cartlake.sources.scratch import materialize, released, scratch_root
from cartlake.sources.tables import dlq_records, ensure_namespace, read_table, write_dlq, write_table
from cartlake.specs import DLQ_REASON, DLQ_TIMESTAMP


@pytest.fixture
def name(layers):
    return f"{layers.silver}.t"


def days(spark, first="2016-01-01", last="2017-12-31"):
    df = spark.sql(
        f"SELECT explode(sequence(date'{first}', date'{last}', interval 1 day)) AS d"
    ).select(F.col("d").cast("timestamp_ntz").alias("ts"), F.lit("old").alias("v"))
    return with_partition_columns(df, "ts")


def test_namespace_twice(spark, layers):
    ensure_namespace(spark, layers.bi, layers.location)
    ensure_namespace(spark, layers.bi, layers.location)
    assert spark.catalog.databaseExists(layers.bi)


def test_missing_table_is_none(spark, name):
    assert read_table(spark, name) is None


def test_append_and_overwrite_count_their_rows(spark, name):
    assert write_table(spark.range(5), name, mode="append") == 5
    assert write_table(spark.range(3), name, mode="append") == 3
    assert spark.table(name).count() == 8
    assert write_table(spark.range(2).withColumn("x", F.lit(1)), name) == 2
    assert spark.table(name).columns == ["id", "x"]
    assert write_table(spark.range(0), name) == 0
    with pytest.raises(ValueError, match="mode"):
        write_table(spark.range(1), name, mode="merge")


def test_full_and_partition_overwrite(spark, name):
    parts = ("year", "month")
    assert write_table(days(spark), name, partition_by=parts) == 731
    new = days(spark, "2017-12-01", "2018-01-31").withColumn("v", F.lit("new"))
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    assert write_table(new, name, mode="partitions", partition_by=parts) == 62
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
    assert rows(spark.table(name).groupBy("v").count()) == [("new", 62), ("old", 700)]
    write_table(new, name, partition_by=parts)
    assert spark.table(name).count() == 62


def test_partition_mode_makes_a_new_table(spark, name):
    assert write_table(days(spark), name, mode="partitions", partition_by=("year",)) == 731


def test_partitions_hold_few_files(spark, name):
    """Rows of a partition are gathered before the write."""
    write_table(days(spark).repartition(16), name, partition_by=("year", "month"))
    files = spark.table(name).select("_metadata.file_path").distinct().count()
    assert files == 24


def test_large_partitions_are_split(spark, conf, name):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4096")
    wide = days(spark).withColumn("id", F.explode(F.sequence(F.lit(1), F.lit(40)))).repartition(8)
    write_table(wide.withColumn("pad", F.sha2(F.col("id").cast("string"), 256)), name, partition_by=("year",))
    assert spark.table(name).select("_metadata.file_path").distinct().count() > 2


def test_other_file_formats(spark, name):
    write_table(days(spark), name, partition_by=("year",), file_format="orc")
    assert write_table(days(spark), name, mode="append", partition_by=("year",), file_format="orc") == 731
    assert spark.table(name).count() == 1462


def test_rows_are_sorted_within_their_files(spark, name):
    write_table(days(spark).repartition(9), name, partition_by=("year",), sort_by=("ts",))
    files = spark.table(name).select("_metadata.file_path", "_metadata.row_index", "ts").collect()
    by_file = {}
    for path, index, ts in sorted(files):
        by_file.setdefault(path, []).append(ts)
    assert all(found == sorted(found) for found in by_file.values())


def test_null_partition_reads_back(spark, name):
    df = with_partition_columns(spark.sql("SELECT cast(NULL AS timestamp_ntz) AS ts, 1 AS v"), "ts")
    write_table(df, name, partition_by=("year", "month"))
    assert rows(spark.table(name), "ts", "v", "year", "month") == [(None, 1, None, None)]


def test_date_range_prunes_partitions(spark, name):
    write_table(days(spark), name, partition_by=("year", "month"))
    found = between_dates(spark.table(name), dt.date(2016, 12, 15), dt.date(2017, 1, 5), "ts")
    assert found.count() == 22
    plan = final_plan(found)
    assert "PartitionFilters: [isnotnull(year" in plan


def test_dlq_records(spark):
    df = dlq_records(spark.range(2), "why")
    assert df.columns == ["id", "_dlq_reason", "_dlq_timestamp"]
    assert rows(df, "_dlq_reason") == [("why",), ("why",)]
    with pytest.raises(ValueError, match="_dlq_reason"):
        dlq_records(spark.range(2))


def test_dlq_without_rejects_makes_no_table(spark, name):
    assert write_dlq(spark.range(0), name, "why") == 0
    assert read_table(spark, name) is None


def test_dlq_widens(spark, name):
    assert write_dlq(spark.range(2), name, "a") == 2
    assert write_dlq(spark.range(2).select(F.lit("x").alias("note"), F.col("id")), name, "b") == 2
    assert write_dlq(spark.sql("SELECT 'y' AS note"), name, "c") == 1
    assert write_dlq(spark.range(0), name, "d") == 0
    assert rows(spark.table(name), "id", "note", "_dlq_reason") == [
        (0, "x", "b"),
        (0, None, "a"),
        (1, "x", "b"),
        (1, None, "a"),
        (None, "y", "c"),
    ]


def test_dlq_failure_raises(spark):
    with pytest.raises(AnalysisException):
        write_dlq(spark.range(1), "no_such_namespace.t", "why")


def test_run_records(spark, name):
    assert load_runs(spark, name).count() == 0
    record_run(spark, name, "bronze", "orders", 5)
    record_run(spark, name, "bronze", "orders", 0, FAILED, message="it broke")
    record_run(spark, name, "silver", "orders", 4, PARTIAL, rejected=1)
    assert load_runs(spark, name).count() == 3
    latest = latest_runs(load_runs(spark, name))
    assert rows(latest, "layer", "table", "rows_processed", "status", "rows_rejected", "message") == [
        ("bronze", "orders", 0, "FAILED", 0, "it broke"),
        ("silver", "orders", 4, "PARTIAL", 1, None),
    ]
    with pytest.raises(ValueError):
        record_run(spark, name, "bronze", "orders", 5, "DONE")


def test_materialize_observes_all_rows_and_keeps_some(spark):
    df, seen = materialize(spark.range(10), "t", {"n": F.count(F.lit(1))}, keep=F.col("id") > 6)
    assert seen == {"n": 10}
    assert rows(df) == [(7,), (8,), (9,)]


class _Session:
    def __init__(self, **options):
        self.conf = self
        self.options = options

    def get(self, key, default=None):
        return self.options.get(key, default)


def test_scratch_folder_comes_from_the_session(monkeypatch, spark):
    assert scratch_root(_Session(**{"spark.checkpoint.dir": "hdfs://x/y/"})) == "hdfs://x/y"
    assert scratch_root(_Session(**{"spark.master": "local[2]"})) == scratch._local_folder()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(_Session(**{"spark.master": "yarn"}))


def _failing(df):
    return df.withColumn("bad", F.raise_error(F.lit("no more")))


def test_failed_replacement_keeps_the_old_rows(spark, name):
    write_table(days(spark), name, partition_by=("year",))
    before = spark.table(name).count()
    with pytest.raises(Exception, match="no more"):
        write_table(_failing(days(spark)), name, partition_by=("year",))
    assert spark.table(name).count() == before
    space, _, short = name.rpartition(".")
    assert [t.name for t in spark.catalog.listTables(space) if t.name.startswith(short)] == [short]


def test_a_table_can_be_replaced_from_itself(spark, name):
    write_table(spark.range(5), name)
    assert write_table(spark.table(name).where("id > 1"), name) == 3
    assert rows(spark.table(name)) == [(2,), (3,), (4,)]


def test_two_partition_writers_at_once(spark, layers):
    ensure_namespace(spark, layers.silver, layers.location)
    names = [f"{layers.silver}.t{i}" for i in range(4)]
    df = spark.range(100).selectExpr("id", "id % 4 AS part")
    for n in names:
        write_table(df, n, partition_by=("part",))
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda n: write_table(df.where("part = 1"), n, "partitions", ("part",)), names * 2))
    assert [spark.table(n).count() for n in names] == [100] * 4
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_replaced_dead_letters(spark, name):
    def reject(ids, reason):
        return spark.createDataFrame([(i, reason) for i in ids], "id bigint, _dlq_reason string")

    write_dlq(reject([1, 2], "a").unionByName(reject([3], "b")), name, replace=("a", "b"))
    write_dlq(reject([9], "kept"), name)
    write_dlq(reject([1, 2, 4], "a").unionByName(reject([3], "b")), name, replace=("a", "b"))
    assert rows(spark.table(name), "id", "_dlq_reason") == [(1, "a"), (2, "a"), (3, "b"), (4, "a"), (9, "kept")]
    write_dlq(reject([5], "a"), name, replace=("a", "b"))
    assert rows(spark.table(name), "id", "_dlq_reason") == [(5, "a"), (9, "kept")]


def test_scratch_is_released(spark):
    with released(spark):
        kept, _ = materialize(spark.range(3), "for-a-while")
        path = kept.inputFiles()[0].removeprefix("file:").removeprefix("//")
        assert kept.count() == 3 and os.path.exists(path)
    assert not os.path.exists(path)


def test_rejects_are_dealt_to_tasks_by_their_number(spark, layers, monkeypatch):
    """Copies shuffle to few bytes, which put all of them into one task."""
    monkeypatch.setattr(tables, "TASK_ROWS", 1000)
    name = f"{layers.dlq}.t_rejected"
    copies = spark.range(6000, numPartitions=3).select(F.lit(1).alias("k"), (F.col("id") % 40).alias("v"))
    assert write_dlq(copies, name, "a", rows=6000) == 6000
    each = spark.table(name).groupBy(F.input_file_name()).count().agg(F.max("count"), F.count("count")).first()
    assert each[0] < 3000 and each[1] >= 3
    kept = copies.withColumns({DLQ_REASON: F.lit("a"), DLQ_TIMESTAMP: F.current_timestamp()})
    assert write_dlq(copies.limit(10), name, "a", replace=("a",), keep=kept, rows=10) == 10
    assert spark.table(name).count() == 6010
    assert spark.table(name).select(F.input_file_name()).distinct().count() >= 3


def test_layer_tables_are_packed_in_all_modes(spark, layers):
    name = f"{layers.silver}.packed"
    for mode, first in (("overwrite", 0), ("append", 10), ("partitions", 20)):
        rows = spark.range(first, first + 10).selectExpr("id", "id div 10 AS part")
        write_table(rows, name, mode, ("part",))
    files = spark.table(name).inputFiles()
    assert len({f.rsplit("/", 2)[-2] for f in files}) == 3
    assert all(f.endswith(".zstd.parquet") for f in files)
