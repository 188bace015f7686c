"""Bronze: raw CSV appended as it is, with clean names and an ingest time."""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from collections.abc import Callable, Iterable, Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlake.functions.names import clean_names
from cartlake.operators.columns import sanitize_columns, stamp_ingested
from cartlake.sources.csv import read_csv_inferred, read_csv_typed, split_corrupt
from cartlake.sources.scratch import materialize
from cartlake.sources.tables import (
    ensure_namespace,
    kinds_of,
    read_table,
    recover_table,
    widen_table,
    write_dlq,
    write_table,
)
from cartlake.specs import CORRUPT_RECORD, LOAD_ID, MALFORMED_RECORD, Layers, TableSpec


# Loads of several tables run side by side and append to one log.
_ONE_WRITER = threading.Lock()


class Loaded(NamedTuple):
    rows: int
    rejected: int


def read_raw(
    spark: SparkSession,
    spec: TableSpec,
    path: str | list[str],
    known: Mapping[str, T.DataType] | None = None,
) -> DataFrame:
    """Raw rows; with declared types unreadable records carry ``_corrupt_record``.

    The timestamp column lands as text: the silver layer parses it, by the rule of the spec. Types
    that are not declared are guessed, and no narrower than the ``known`` ones.
    """
    if spec.types is None:
        return read_csv_inferred(spark, path, spec.multi_line, known)
    types = dict(spec.types)
    if spec.timestamp_column in types:
        types[spec.timestamp_column] = T.StringType()
    return read_csv_typed(spark, path, types, spec.multi_line, spec.mixed_headers)


def load(
    spark: SparkSession,
    spec: TableSpec,
    raw_root: str,
    layers: Layers = Layers(),
    skip_loaded: bool = False,
    by_load: bool = False,
    on_widened: Callable[[Iterable[str]], object] | None = None,
) -> Loaded:
    """Append the raw files of ``spec`` to its bronze table; unreadable records go to the DLQ.

    Running it again appends every row again. With ``skip_loaded`` files that were loaded
    before, by path and modification time, are left out; a load that fails between its
    rows and the file log is repeated by the next run.

    With ``by_load`` the table is made with a partition per load, ``_load_id``, so that what is new can
    be read alone. A table that exists is appended to as it was made.

    Guessed types belong to the table, not to the load: a load is read with the types that the
    table has, and a column whose new cells do not fit them is widened first, at last to text. That
    rewrites the table, but no column can widen more than a few times. ``on_widened`` is told which.
    """
    ensure_namespace(spark, layers.bronze, layers.location)
    recover_table(spark, f"{layers.bronze}.{spec.name}")
    path: str | list[str] = f"{raw_root.rstrip('/')}/{spec.source}"
    files = None
    if skip_loaded:
        files = new_files(spark, spec, raw_root, layers)
        # Spark keeps the paths of a scan on the driver in any case.
        path = [r.path for r in files.select("path").collect()]
        if not path:
            return Loaded(0, 0)
    target = f"{layers.bronze}.{spec.name}"
    have = read_table(spark, target) if spec.types is None else None
    raw = read_raw(spark, spec, path, None if have is None else kinds_of(have))
    rejected = 0
    if spec.types is None:
        landed = stamp_ingested(sanitize_columns(raw))
        if have is not None:
            widened = widen_table(spark, target, kinds_of(landed), layers.file_format)
            if widened and on_widened is not None:
                on_widened(widened)
        rows = _append(landed, target, layers, by_load)
    else:
        seen = Observation()
        counted = raw.observe(seen, F.count(CORRUPT_RECORD).alias("corrupt"))
        good = sanitize_columns(split_corrupt(counted)[0])
        rows = _append(stamp_ingested(good), target, layers, by_load)
        if seen.get["corrupt"]:
            ensure_namespace(spark, layers.dlq, layers.location)
            # Cells as far as they could be read, next to the raw text.
            bad = split_corrupt(raw)[1]
            bad = bad.toDF(*clean_names(bad.columns[:-1]), CORRUPT_RECORD)
            dlq = f"{layers.dlq}.{spec.name}_rejected"
            rejected = write_dlq(
                bad, dlq, MALFORMED_RECORD, some=True, file_format=layers.file_format, rows=seen.get["corrupt"]
            )
    if files is not None:
        with _ONE_WRITER:
            files.write.mode("append").saveAsTable(_file_log(layers))
    return Loaded(rows, rejected)


def _append(rows: DataFrame, target: str, layers: Layers, by_load: bool) -> int:
    have = read_table(rows.sparkSession, target)
    if not (by_load if have is None else LOAD_ID in have.columns):
        return write_table(rows, target, mode="append", file_format=layers.file_format)
    load = f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    rows = rows.withColumn(LOAD_ID, F.lit(load))
    return write_table(rows, target, "append", (LOAD_ID,), file_format=layers.file_format, gather=False)


def _file_log(layers: Layers) -> str:
    return f"{layers.ops}.loaded_files"


def new_files(spark: SparkSession, spec: TableSpec, raw_root: str, layers: Layers) -> DataFrame:
    """``(table, path, modified)`` of raw files that the file log does not have."""
    ensure_namespace(spark, layers.ops, layers.location)
    found = (
        spark.read.format("binaryFile")
        .load(f"{raw_root.rstrip('/')}/{spec.source}")
        .selectExpr(f"'{spec.name}' AS `table`", "path", "modificationTime AS modified")
    )
    log = read_table(spark, _file_log(layers))
    # The list is fixed before the load, so files that arrive meanwhile wait for the next run.
    known = found if log is None else found.join(log, ["table", "path", "modified"], "left_anti")
    return materialize(known, "new-files")[0]
