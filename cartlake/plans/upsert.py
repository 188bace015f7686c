"""Keyed upsert of new bronze loads into a silver table.

Only the new loads and the silver table are read. The newest row of a key wins, wherever its older
row lives, and the older one becomes a dead letter. A batch is worked out first and its results are
written to a folder; then it is logged as prepared, applied, and logged as applied. Applying it
again changes nothing, so a run that is lost in between is taken up by the next one.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlake.operators.joins import TASK_ROWS, dealt, shuffle_partitions
from cartlake.sources.batches import APPLIED, PREPARED, Batch, log_batches
from cartlake.sources.scratch import PACKED, PACKING, delete_path, scratch_path
from cartlake.sources.tables import (
    drop_table,
    ensure_namespace,
    partition_filter,
    partitions_of,
    read_table,
    replace_partitions,
    swap_tables,
    write_dlq,
    write_table,
)
from cartlake.specs import (
    BAD_TIMESTAMP,
    DLQ_REASON,
    DLQ_TIMESTAMP,
    DUPLICATE_KEY,
    INGESTED_AT,
    UPDATED_AT,
    Layers,
    TableSpec,
)

_AT = "__at"


def _same_keys(keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, (F.col(f"`{k}`") == F.col(f"`__{k}`") for k in keys))


def _stage(df: DataFrame, path: str) -> DataFrame:
    df.write.options(**PACKING).parquet(path, compression=PACKED)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _dealt(df: DataFrame, on: Sequence[str], rows: int) -> DataFrame:
    """``df`` dealt by ``on`` if ``rows`` are more than the usual number of tasks should sort."""
    return dealt(df, on, rows) if rows > TASK_ROWS * shuffle_partitions(df) else df


def _any_newer(silver: DataFrame, keys: DataFrame) -> bool:
    """Whether a row of the silver table came after one of ``keys``; reads one column of it."""
    have = silver.select(F.col(INGESTED_AT).alias("have"), F.lit(None).cast(keys.schema[_AT].dataType).alias("new"))
    new = keys.select(F.lit(None).cast(silver.schema[INGESTED_AT].dataType).alias("have"), F.col(_AT).alias("new"))
    return bool(have.unionByName(new).agg(F.max("have") > F.min("new")).first()[0])


def prepare(
    spark: SparkSession,
    spec: TableSpec,
    layers: Layers,
    valid: DataFrame,
    rejects: DataFrame | None,
    bronze: DataFrame,
    loads: Sequence[str],
) -> Batch:
    """Work out what ``valid`` and ``rejects`` of new loads change in the silver table, and log it.

    The folder of the batch has ``valid`` (rows that enter), ``displaced`` (rows that leave), ``rejects``, and
    for a partitioned table ``contents``, all rows of its touched partitions. Without partitions
    the new table is written under another name.
    """
    name = f"{layers.silver}.{spec.name}"
    _drop_leftovers(spark, spec, layers)
    silver = spark.table(name)
    batch = uuid.uuid4().hex
    # Outlives the run, until gold has seen the batch.
    path = scratch_path(spark, "batch", keep=True)
    valid = _stage(valid, f"{path}/incoming")
    columns = [*spec.keys, INGESTED_AT]
    keys = valid.select(*columns)
    if rejects is not None:
        rejects = _stage(rejects, f"{path}/split")
        # The newest row of a key counts, even if its time cannot be read.
        keys = keys.unionByName(rejects.where(F.col(DLQ_REASON) == BAD_TIMESTAMP).select(*columns))
    if not spec.keys:
        keys = keys.where(F.lit(False))
    keys = _stage(keys.toDF(*(f"__{k}" for k in spec.keys), _AT), f"{path}/keys")
    newer = F.coalesce(F.col(_AT) >= F.col(INGESTED_AT), F.lit(True))
    displaced = silver.where(F.lit(False))
    entering, behind = valid, valid.where(F.lit(False))
    rows = silver.count() if spec.keys else 0
    if spec.keys:
        names = [f"__{k}" for k in spec.keys]
        met = _dealt(silver, spec.keys, rows).join(_dealt(keys, names, rows), _same_keys(spec.keys))
        displaced = _stage(met.where(newer).select(*silver.columns), f"{path}/displaced")
        # Loads that ran side by side: what is there already may be newer.
        if _any_newer(silver, keys):
            late = _stage(met.where(~newer).select(*keys.columns), f"{path}/late")
            behind = valid.join(late, _same_keys(spec.keys), "left_semi")
            entering = valid.join(late, _same_keys(spec.keys), "left_anti")
    else:
        _stage(displaced, f"{path}/displaced")
    entering = _stage(entering, f"{path}/valid")
    # Rows of the silver table go to the dead letters as they are there, in the types of bronze.
    leaving = displaced.unionByName(behind).drop(UPDATED_AT)
    kinds = {f.name: f.dataType for f in bronze.schema.fields}
    leaving = leaving.select(*(F.col(f"`{c}`").cast(kinds[c]).alias(c) for c in bronze.columns))
    leaving = leaving.withColumn(DLQ_REASON, F.lit(DUPLICATE_KEY))
    all_rejects = leaving if rejects is None else rejects.unionByName(leaving)
    # The stamp tells the dead letters of this batch apart.
    _stage(all_rejects.withColumn(DLQ_TIMESTAMP, F.current_timestamp()), f"{path}/rejects")
    gone = displaced.select(*spec.keys).toDF(*(f"__{k}" for k in spec.keys)) if spec.keys else None
    if spec.partition_by:
        touched = partitions_of(entering, spec.partition_by) | partitions_of(displaced, spec.partition_by)
        rest = silver.where(partition_filter(touched, spec.partition_by))
    else:
        rest = silver
    if gone is not None:
        names = [f"__{k}" for k in spec.keys]
        rest, gone = _dealt(rest, spec.keys, rows), _dealt(gone, names, rows)
        rest = rest.join(gone, _same_keys(spec.keys), "left_anti")
    contents = rest.unionByName(entering)
    if spec.partition_by:
        _stage(contents, f"{path}/contents")
    else:
        write_table(contents, f"{name}__{batch}", file_format=layers.file_format)
    prepared = Batch(spec.name, batch, PREPARED, path, tuple(loads))
    log_batches(spark, layers, [prepared])
    return prepared


def _drop_leftovers(spark: SparkSession, spec: TableSpec, layers: Layers) -> None:
    """Tables that a lost run wrote to take the place of the silver table."""
    mine = re.compile(re.escape(spec.name) + r"__[0-9a-f]{32}(__old)?", re.IGNORECASE)
    for r in spark.sql(f"SHOW TABLES IN {layers.silver} LIKE '{spec.name}__*'").collect():
        if mine.fullmatch(r.tableName):
            drop_table(spark, f"{layers.silver}.{r.tableName}")


def apply(spark: SparkSession, spec: TableSpec, layers: Layers, batch: Batch) -> tuple[int, int]:
    """Bring a prepared batch into silver and dead letters; rows that entered and rows rejected."""
    name, path = f"{layers.silver}.{spec.name}", batch.path
    valid, displaced = (spark.read.parquet(f"{path}/{part}") for part in ("valid", "displaced"))
    rejected = _apply_rejects(spark, spec, layers, spark.read.parquet(f"{path}/rejects"))
    if spec.partition_by:
        touched = partitions_of(valid, spec.partition_by) | partitions_of(displaced, spec.partition_by)
        if touched:
            contents = spark.read.parquet(f"{path}/contents").select(*spark.table(name).columns)
            replace_partitions(contents, name, spec.partition_by, touched, layers.file_format)
    else:
        swap_tables(spark, f"{name}__{batch.batch}", name)
    rows = valid.count()
    log_batches(spark, layers, [batch._replace(event=APPLIED)])
    return rows, rejected


def discard(spark: SparkSession, spec: TableSpec, layers: Layers, batch: Batch) -> None:
    """Give up a prepared batch whose table is replaced as a whole."""
    drop_table(spark, f"{layers.silver}.{spec.name}__{batch.batch}")
    delete_path(spark, batch.path)


def _apply_rejects(spark: SparkSession, spec: TableSpec, layers: Layers, rejects: DataFrame) -> int:
    """Append the dead letters of a batch, unless they are there; what an attempt left half done goes first."""
    stamps = rejects.agg(F.max(DLQ_TIMESTAMP), F.count(F.lit(1))).first()
    if not stamps[1]:
        return 0
    dlq = f"{layers.dlq}.{spec.name}_rejected"
    ensure_namespace(spark, layers.dlq, layers.location)
    have = read_table(spark, dlq)
    if have is not None:
        mine = F.col(DLQ_TIMESTAMP).eqNullSafe(F.lit(stamps[0]))
        there = have.where(mine).count()
        if there == stamps[1]:
            return there
        if there:
            write_table(have.where(~mine), dlq, partition_by=(DLQ_REASON,), file_format=layers.file_format)
    return write_dlq(rejects, dlq, some=True, file_format=layers.file_format, stamp=False, rows=stamps[1])
