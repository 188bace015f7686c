"""Layer tables: namespaces, scans, append and replace writes, dead letters."""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlake.functions.kinds import wider
from cartlake.operators.columns import require_columns
from cartlake.operators.joins import TASK_ROWS, hashable
from cartlake.sources.scratch import PACKED, PACKING
from cartlake.specs import DLQ_REASON, DLQ_TIMESTAMP

MODES = ("append", "overwrite", "partitions")

# The scope of an overwrite is a setting of the session, which writers in other threads share.
_SCOPE = threading.Lock()

# End of the name of a table that is written to take the place of another.
_NEW = "__new"


def ensure_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}/{namespace}'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}{where}")


def read_table(spark: SparkSession, name: str) -> DataFrame | None:
    """The table, or None if there is none of that name."""
    return spark.table(name) if spark.catalog.tableExists(name) else None


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    file_format: str = "parquet",
    gather: bool = True,
    rows: int | None = None,
) -> int:
    """Write ``df`` to the table ``name`` and return the number of rows written.

    The rows are counted by the write itself, in its last stage, where a re-run task does
    not count twice. ``overwrite`` replaces the table: the rows go to a table of another name,
    which takes the place of the old one once it is complete, so a failed write leaves the old
    rows. A driver that is lost in between leaves both, and the next write of the table first
    brings one of them into its place (``recover_table``). A table has one writer at a time. ``append`` adds to the table, ``partitions`` replaces only the partitions present
    in ``df`` and adds new ones; a column that is too narrow for ``df`` is widened first.

    A partitioned write gathers the rows of a partition first, so tasks do not each open a
    file in every partition; the rebalance cuts large partitions into several tasks. Without
    ``gather``, for rows that all go to one partition, they are written where they are. The rebalance
    goes by shuffled bytes, which say little of copies; where ``rows`` tells how many there are at
    most, and it is more than a task may sort, they are dealt to tasks by their number.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    spark = df.sparkSession
    if partition_by:
        require_columns(df, partition_by)
    if partition_by and gather:
        by = [F.col(c) for c in partition_by]
        if rows is not None and rows > TASK_ROWS:
            # The partition id tells identical rows of different tasks apart, and is the same in a re-run.
            place = F.xxhash64(F.spark_partition_id(), *hashable(df))
            df = df.withColumn("__place", place).repartition(-(-rows // TASK_ROWS), *by, "__place").drop("__place")
        else:
            df = df.hint("rebalance", *by)
    written = Observation()
    df = df.observe(written, F.count(F.lit(1)).alias("rows"))
    if partition_by or sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    recover_table(spark, name)
    if mode == "partitions" and spark.catalog.tableExists(name):
        widen_table(spark, name, kinds_of(df), file_format)
        with _dynamic_overwrite(spark):
            # insertInto matches columns by position.
            df.select(spark.table(name).columns).write.insertInto(name, overwrite=True)
    else:
        replace = mode != "append" and spark.catalog.tableExists(name)
        target = f"{name}__{uuid.uuid4().hex}{_NEW}" if replace else name
        writer = df.write.format(file_format).mode("append" if mode == "append" else "errorifexists")
        if file_format == "parquet":
            # Kept with the table, so later inserts take it too.
            writer = writer.option("compression", PACKED).options(**PACKING)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        try:
            writer.saveAsTable(target)
        except Exception:
            if replace:
                spark.sql(f"DROP TABLE IF EXISTS {target}")
            raise
        if replace:
            _swap(spark, target, name)
    return written.get["rows"]


def kinds_of(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


def widen_table(
    spark: SparkSession, name: str, kinds: Mapping[str, T.DataType], file_format: str = "parquet"
) -> list[str]:
    """Make the columns of a table wide enough for values of ``kinds`` too; what changed, as
    ``column: old to new``.

    Files keep the type they were written with, so a change costs one rewrite of the table, which
    replaces it once it is complete. Without a change nothing is read. Partition columns stay.
    """
    table = spark.table(name)
    by = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    changed = {}
    for f in table.schema.fields:
        kind = f.dataType if f.name in by else wider(f.dataType, kinds.get(f.name, f.dataType))
        if kind != f.dataType:
            changed[f.name] = (f.dataType, kind)
    if changed:
        wide = table.withColumns({n: F.col(f"`{n}`").cast(to) for n, (_, to) in changed.items()})
        write_table(wide, name, "overwrite", by, file_format=file_format)
    return [f"{n}: {old.simpleString()} to {to.simpleString()}" for n, (old, to) in changed.items()]


def partition_filter(partitions: Iterable[Sequence], by: Sequence[str]) -> Column:
    """Whether a row is in one of ``partitions``, values in the order of ``by``; prunes folders."""
    hits = (
        reduce(Column.__and__, (F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(by, values, strict=True)))
        for values in partitions
    )
    return reduce(Column.__or__, hits, F.lit(False))


def partitions_of(df: DataFrame, by: Sequence[str]) -> set[tuple]:
    """The different partition values of ``df``. As many as there are folders, which the driver lists anyway."""
    return {tuple(r) for r in df.select(*by).distinct().collect()}


def replace_partitions(
    df: DataFrame, name: str, by: Sequence[str], partitions: Iterable[tuple], file_format: str = "parquet"
) -> int:
    """Make ``df`` the content of ``partitions`` of a table; those without a row now are dropped.

    Doing it again gives the same. ``df`` must not read the table.
    """
    if all(isinstance(df.schema[c].dataType, T.IntegralType) for c in by):
        # Seen by the write itself: to look for them would run all of ``df`` once more.
        there = Observation()
        parts = [F.concat(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("/")) for c in by]
        seen = df.observe(there, F.collect_set(F.concat(*parts)).alias("partitions"))
        rows = write_table(seen, name, "partitions", by, file_format=file_format)
        found = set(there.get["partitions"])
        gone = {p for p in partitions if "".join("/" if v is None else f"{v}/" for v in p) not in found}
    else:
        gone = set(partitions) - partitions_of(df, by)
        rows = write_table(df, name, "partitions", by, file_format=file_format)
    have = partitions_of(df.sparkSession.table(name), by) if gone else set()
    for values in gone & have:
        named = ", ".join(f"`{c}` = {'null' if v is None else repr(v)}" for c, v in zip(by, values, strict=True))
        df.sparkSession.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({named})")
    return rows


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def swap_tables(spark: SparkSession, new: str, name: str) -> None:
    """Put the table ``new`` in the place of ``name``, at whatever step an earlier attempt was lost.

    Without a table ``new`` the swap is over but for the old table, which may be left.
    """
    old = f"{new}__old"
    exists = spark.catalog.tableExists
    if exists(new):
        if exists(name):
            drop_table(spark, old)
            spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
        if exists(old):
            # Its partitions may still have the places that those of the new table are about to take.
            _repair(spark, old, "DROP")
        spark.sql(f"ALTER TABLE {new} RENAME TO {name}")
    _repair(spark, name, "SYNC")
    drop_table(spark, old)


def recover_table(spark: SparkSession, name: str) -> None:
    """Finish or undo a replacement of ``name`` whose writer was lost.

    A table that stood ready when the old one had been moved away takes its place; one that may be
    incomplete is dropped. Only the writer of a table may call this, before it looks at the table.
    """
    space, _, base = name.rpartition(".")
    if space and not spark.catalog.databaseExists(space):
        return
    mine = re.compile(re.escape(base) + rf"__[0-9a-f]{{32}}{_NEW}(__old)?", re.IGNORECASE)
    within = f" IN {space}" if space else ""
    shown = spark.sql(f"SHOW TABLES{within} LIKE '{base}__*{_NEW}*'").collect()
    left = {r.tableName for r in shown if mine.fullmatch(r.tableName)}
    for new in sorted({t.removesuffix("__old") for t in left}):
        full = f"{space}.{new}" if space else new
        if f"{new}__old" in left:
            _finish(spark, full, name)
        else:
            drop_table(spark, full)


def _finish(spark: SparkSession, new: str, name: str) -> None:
    """The table ``name`` again, after a swap that has already moved the old one away."""
    if not spark.catalog.tableExists(name) and not spark.catalog.tableExists(new):
        spark.sql(f"ALTER TABLE {new}__old RENAME TO {name}")
    swap_tables(spark, new, name)


def _swap(spark: SparkSession, new: str, name: str) -> None:
    """Put the table ``new`` in the place of ``name``; after an error the old one is there again."""
    try:
        swap_tables(spark, new, name)
    except Exception:
        old = f"{new}__old"
        if spark.catalog.tableExists(old) and not spark.catalog.tableExists(name):
            spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
            _repair(spark, name, "SYNC")
        raise


def _repair(spark: SparkSession, name: str, what: str) -> None:
    """Not every catalog moves the places of partitions along with their table."""
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.sql(f"MSCK REPAIR TABLE {name} {what} PARTITIONS")


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    # insertInto takes the overwrite scope from the session, not from writer options. One writer
    # at a time may change it, from setting it to the end of its insert.
    key = "spark.sql.sources.partitionOverwriteMode"
    with _SCOPE:
        before = spark.conf.get(key)
        spark.conf.set(key, "dynamic")
        try:
            yield
        finally:
            spark.conf.set(key, before)


def dlq_records(rejects: DataFrame, reason: str | None = None, stamp: bool = True) -> DataFrame:
    """Rejected rows with the reason and the time of rejection, unless they have it already."""
    if reason is not None:
        rejects = rejects.withColumn(DLQ_REASON, F.lit(reason))
    require_columns(rejects, [DLQ_REASON], "rejected rows without a given reason")
    return rejects.withColumn(DLQ_TIMESTAMP, F.current_timestamp()) if stamp else rejects


def write_dlq(
    rejects: DataFrame,
    table: str,
    reason: str | None = None,
    some: bool = False,
    file_format: str = "parquet",
    replace: Sequence[str] = (),
    keep: DataFrame | None = None,
    stamp: bool = True,
    rows: int | None = None,
) -> int:
    """Append rejected rows to the dead-letter table and return their number.

    The table is partitioned by reason. For the reasons in ``replace`` the rows take the place
    of all earlier ones, also if there are none now: a rebuild from the same rows gives the
    same dead letters again, not more of them. The rows of ``keep``, earlier dead letters read from
    elsewhere than the table, stay with them as they are; they are not in the number returned.

    Columns the table does not have yet are added to it, those that are too narrow are widened;
    columns the rows lack are NULL.
    A failure raises: rejects are not lost silently. Without rejects no table is made;
    ``some`` says that there are rejects, which saves looking for a first one; ``rows``, how many at most.
    """
    spark = rejects.sparkSession
    records = dlq_records(rejects, reason, stamp)
    recover_table(spark, table)
    if not spark.catalog.tableExists(table):
        if not some and rejects.isEmpty():
            return 0
        return write_table(records, table, "append", (DLQ_REASON,), file_format=file_format, rows=rows)
    widen_table(spark, table, kinds_of(records), file_format)
    have = spark.table(table).schema
    new = [f for f in records.schema.fields if f.name not in have.names]
    if new:
        added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added})")
    aligned = [
        F.col(f"`{f.name}`") if f.name in records.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in spark.table(table).schema.fields
    ]
    records = records.select(*aligned)
    if not replace:
        return write_table(records, table, "append", (DLQ_REASON,), file_format=file_format, rows=rows)
    fresh, seen = Observation(), Observation()
    records = records.observe(fresh, F.count(F.lit(1)).alias("rows"))
    if keep is not None:
        records = records.unionByName(keep, allowMissingColumns=True)
        if rows is not None:
            rows += keep.count()
    records = records.observe(seen, F.collect_set(DLQ_REASON).alias("reasons"))
    write_table(records, table, "partitions", (DLQ_REASON,), file_format=file_format, rows=rows)
    # Reasons that no row has any more. One row per reason meets the driver.
    known = {r[0] for r in spark.table(table).select(DLQ_REASON).distinct().collect()}
    stale = (known & set(replace)) - set(seen.get["reasons"])
    if stale:
        rest = spark.table(table).where(~F.col(DLQ_REASON).isin(*stale))
        write_table(rest, table, "overwrite", (DLQ_REASON,), file_format=file_format)
    return fresh.get["rows"]
