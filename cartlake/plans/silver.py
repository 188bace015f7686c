"""Silver: one row per key, no NULL keys, parsed timestamps, partition columns."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlake.functions.dates import parse_timestamp
from cartlake.operators.columns import (
    cast_timestamp,
    require_columns,
    split_bad_timestamps,
    stamp_updated,
    with_partition_columns,
)
from cartlake.operators.duplicates import (
    KeyProfile,
    pick_touched,
    profile_keys,
    ranked_split,
    remaining_rows,
    split_duplicates,
)
from cartlake.operators.nulls import split_nulls
from cartlake.operators.quality import enforce_gate, quality_gate
from cartlake.plans import upsert
from cartlake.sources.batches import REPLACED, Batch, log_batches, read_state
from cartlake.sources.scratch import materialize, released
from cartlake.sources.tables import (
    ensure_namespace,
    kinds_of,
    partition_filter,
    partitions_of,
    read_table,
    recover_table,
    replace_partitions,
    widen_table,
    write_dlq,
    write_table,
)
from cartlake.specs import (
    BAD_TIMESTAMP,
    DLQ_REASON,
    DLQ_TIMESTAMP,
    DUPLICATE_KEY,
    INGESTED_AT,
    LOAD_ID,
    NULL_KEY,
    UPDATED_AT,
    Layers,
    QualityThresholds,
    TableSpec,
)


class Cleansed(NamedTuple):
    valid: DataFrame
    # Input columns and ``_dlq_reason``; None if the key profile rules rejects out.
    rejects: DataFrame | None


class Loaded(NamedTuple):
    rows: int
    rejected: int
    # Quality limits that the bronze table passed.
    breaches: tuple[str, ...] = ()


def cleanse(df: DataFrame, spec: TableSpec, profile: KeyProfile | None = None) -> Cleansed:
    """Split ``df`` into silver rows and rejects; together they are all of its rows.

    Duplicates are taken out before NULL keys, and NULL keys count as equal, so of several
    rows with the same NULL key one is a NULL key and the others are duplicates.
    ``null_keys_first`` labels all of them as NULL keys.
    """
    require_columns(df, spec.keys, spec.name)
    rejects: list[DataFrame] = []
    valid = df
    if spec.keys and (profile is None or profile.n_repeated or profile.null_key_rows):
        touched, untouched = (df, None) if profile is None else pick_touched(df, spec.keys, profile)
        if spec.null_keys_first:
            whole, nulls = split_nulls(touched, spec.keys)
            valid, copies = _split(whole, spec.keys, profile)
        else:
            kept, copies = _split(touched, spec.keys, profile)
            valid, nulls = split_nulls(kept, spec.keys)
        if profile is None or profile.n_repeated:
            rejects.append(copies.withColumn(DLQ_REASON, F.lit(DUPLICATE_KEY)))
        if profile is None or profile.null_key_rows:
            rejects.append(nulls.withColumn(DLQ_REASON, F.lit(NULL_KEY)))
        if untouched is not None:
            valid = untouched.unionByName(valid)
    if spec.timestamp_column:
        require_columns(df, [spec.timestamp_column], spec.name)
        if spec.bad_timestamps == "reject":
            valid, bad = split_bad_timestamps(valid, spec.timestamp_column)
            rejects.append(bad.withColumn(DLQ_REASON, F.lit(BAD_TIMESTAMP)))
        valid = cast_timestamp(valid, spec.timestamp_column)
        if spec.partition_by:
            valid = with_partition_columns(valid, spec.timestamp_column, spec.partition_by)
    return Cleansed(stamp_updated(valid), reduce(DataFrame.unionByName, rejects) if rejects else None)


def _split(df: DataFrame, keys: Sequence[str], profile: KeyProfile | None) -> tuple[DataFrame, DataFrame]:
    return split_duplicates(df, keys) if profile is None else ranked_split(df, keys, profile.rows, profile.heavy)


def _untouched_rejects(
    earlier: DataFrame, touched: set[tuple], rejects: DataFrame, spec: TableSpec
) -> DataFrame:
    """Earlier dead letters of partitions other than ``touched``, but for those that ``rejects`` has again, copy
    by copy. Rows without a timestamp are a partition too. The result is written out."""
    placed = earlier.select(F.struct("*").alias("row"), parse_timestamp(spec.timestamp_column).alias("at"))
    placed = with_partition_columns(placed, "at", spec.partition_by)
    kept = placed.where(~partition_filter(touched, spec.partition_by)).select("row.*")
    return materialize(remaining_rows(kept, rejects, DLQ_TIMESTAMP), "kept-rejects")[0]


def _moved_away(valid: DataFrame, target: DataFrame, touched: set[tuple], spec: TableSpec) -> tuple[set, DataFrame]:
    """Partitions outside ``touched`` where keys of ``valid`` live now, and their rows without these keys."""
    keys = valid.select(*(F.col(f"`{k}`").alias(f"__{k}") for k in spec.keys))
    same = reduce(Column.__and__, (F.col(f"`{k}`") == F.col(f"__{k}") for k in spec.keys))
    others = target.where(~partition_filter(touched, spec.partition_by))
    left = partitions_of(others.join(keys, same, "left_semi"), spec.partition_by)
    rest = target.where(partition_filter(left, spec.partition_by)).join(keys, same, "left_anti")
    return left, materialize(rest, "moved-away")[0]


def _loads(bronze: DataFrame) -> list[str]:
    """The loads that a bronze table has; its partitions, which the driver lists anyway."""
    return sorted(r[0] for r in bronze.select(LOAD_ID).distinct().collect())


def load(
    spark: SparkSession,
    spec: TableSpec,
    layers: Layers = Layers(),
    limits: QualityThresholds | None = None,
    mode: str = "overwrite",
) -> Loaded | None:
    """Bring a silver table up to its bronze table; None if there is no bronze table.

    One pass over the key columns comes first. It tells whether there is anything to
    reject, so a clean table is neither written twice nor compared. With ``limits`` the quality
    gate runs before anything is written.

    ``overwrite`` rebuilds the table. ``partitions`` replaces the partitions of a partitioned table that have
    rows now, and takes keys that come there out of all others. ``incremental`` reads only
    bronze loads that are not in silver yet and merges them by key (``upsert``); it goes on with a
    batch that an earlier run did not finish, and rebuilds the table where it does not know what is
    in it, where columns changed, or where bronze is not kept by load. The quality gate then judges the new loads.

    Rejects are those of the whole bronze table and take the place of those of earlier loads; with
    ``partitions`` only of those in replaced partitions, and of equal ones, copy by copy. They are worked out
    before the silver rows are replaced. ``incremental`` adds those of the new loads, and the older
    rows of their keys: a row that was in silver goes there as silver had it. What was written meanwhile is deleted.
    """
    if mode not in ("overwrite", "partitions", "incremental"):
        raise ValueError(f"mode must be overwrite, partitions or incremental, not {mode!r}")
    bronze = read_table(spark, f"{layers.bronze}.{spec.name}")
    if bronze is None:
        return None
    require_columns(bronze, spec.keys, spec.name)
    for lost in (f"{layers.silver}.{spec.name}", f"{layers.dlq}.{spec.name}_rejected"):
        recover_table(spark, lost)
    loads: list[str] = []
    prepared = None
    if LOAD_ID in bronze.columns:
        loads = _loads(bronze)
        if mode == "incremental":
            state = read_state(spark, layers, [spec.name])[spec.name]
            prepared = state.prepared
            target = read_table(spark, f"{layers.silver}.{spec.name}")
            if prepared is not None and state.loads is not None:
                upsert.apply(spark, spec, layers, prepared)
                state, prepared = read_state(spark, layers, [spec.name])[spec.name], None
                target = read_table(spark, f"{layers.silver}.{spec.name}")
            if target is not None and state.loads is not None and _same_columns(bronze, target, spec):
                return _load_new(spark, spec, layers, limits, bronze, sorted(set(loads) - state.loads))
        # Loads that arrive meanwhile wait for the next run.
        bronze = bronze.where(F.col(LOAD_ID).isin(*loads))
        bronze = bronze.drop(LOAD_ID)
    with released(spark):
        done = _replace(spark, spec, layers, limits, "overwrite" if mode == "incremental" else mode, bronze)
    if loads or read_state(spark, layers, [spec.name])[spec.name].loads is not None:
        log_batches(spark, layers, [Batch(spec.name, uuid.uuid4().hex, REPLACED, loads=tuple(loads))])
    if prepared is not None:
        upsert.discard(spark, spec, layers, prepared)
    return done


def _same_columns(bronze: DataFrame, target: DataFrame, spec: TableSpec) -> bool:
    made = {*bronze.columns, *spec.partition_by, UPDATED_AT} - {LOAD_ID}
    kinds = {f.name: f.dataType for f in bronze.schema.fields}
    return INGESTED_AT in made and made == set(target.columns) and all(
        f.dataType == kinds.get(f.name, f.dataType) for f in target.schema.fields if f.name != spec.timestamp_column
    )


def _load_new(
    spark: SparkSession,
    spec: TableSpec,
    layers: Layers,
    limits: QualityThresholds | None,
    bronze: DataFrame,
    loads: list[str],
) -> Loaded:
    if not loads:
        return Loaded(0, 0)
    with released(spark):
        new = bronze.where(F.col(LOAD_ID).isin(*loads)).drop(LOAD_ID)
        profile = profile_keys(new, spec.keys) if spec.keys else None
        breaches: list[str] = []
        if limits is not None:
            breaches = enforce_gate(quality_gate(new, spec.keys, limits, profile), limits)
        valid, rejects = cleanse(new, spec, profile)
        batch = upsert.prepare(spark, spec, layers, valid, rejects, new, loads)
    rows, rejected = upsert.apply(spark, spec, layers, batch)
    return Loaded(rows, rejected, tuple(breaches))


def _replace(
    spark: SparkSession,
    spec: TableSpec,
    layers: Layers,
    limits: QualityThresholds | None,
    mode: str,
    bronze: DataFrame,
) -> Loaded:
    profile = profile_keys(bronze, spec.keys) if spec.keys else None
    breaches: list[str] = []
    if limits is not None:
        breaches = enforce_gate(quality_gate(bronze, spec.keys, limits, profile), limits)
    valid, rejects = cleanse(bronze, spec, profile)
    ensure_namespace(spark, layers.silver, layers.location)
    name = f"{layers.silver}.{spec.name}"
    dlq = f"{layers.dlq}.{spec.name}_rejected"
    target = read_table(spark, name)
    earlier = read_table(spark, dlq)
    if rejects is None and earlier is not None:
        rejects = bronze.where(F.lit(False)).withColumn(DLQ_REASON, F.lit(DUPLICATE_KEY))
    reasons = (DUPLICATE_KEY, NULL_KEY, BAD_TIMESTAMP)
    by, keep = spec.partition_by, None
    if mode == "partitions" and by and target is not None:
        if widen_table(spark, name, kinds_of(valid), layers.file_format):
            target = spark.table(name)
        valid = materialize(valid, "valid")[0].select(*target.columns)
        touched = partitions_of(valid, by)
        if earlier is not None:
            rejects = materialize(rejects, "rejects")[0]
            keep = _untouched_rejects(earlier.where(F.col(DLQ_REASON).isin(*reasons)), touched, rejects, spec)
        left: set[tuple] = set()
        contents = valid
        if spec.keys:
            left, rest = _moved_away(valid, target, touched, spec)
            contents = valid.unionByName(rest)
        rows = replace_partitions(contents, name, by, left, layers.file_format) if touched else 0
        rows -= rest.count() if left else 0
    else:
        rows = write_table(valid, name, "overwrite", by, file_format=layers.file_format)
    rejected = 0
    if rejects is not None:
        ensure_namespace(spark, layers.dlq, layers.location)
        some = profile is not None and bool(profile.n_repeated or profile.null_key_rows)
        most = None
        if profile is not None:
            most = profile.rows if spec.bad_timestamps == "reject" else profile.surplus + profile.null_key_rows
        rejected = write_dlq(
            rejects, dlq, some=some, file_format=layers.file_format, replace=reasons, keep=keep, rows=most
        )
    return Loaded(rows, rejected, tuple(breaches))
