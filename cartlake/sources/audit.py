"""Run records: one row per table load, appended by layer, and the latest state per table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlake.sources.tables import read_table

SUCCESS, FAILED, PARTIAL = "SUCCESS", "FAILED", "PARTIAL"

SCHEMA = (
    "`layer` string, `table` string, last_run timestamp, rows_processed bigint, "
    "status string, rows_rejected bigint, message string"
)


class Run(NamedTuple):
    """What is recorded of one table load."""

    layer: str
    table: str
    rows: int
    status: str = SUCCESS
    rejected: int = 0
    message: str | None = None


def record_runs(spark: SparkSession, audit_table: str, runs: Sequence[Run]) -> None:
    """Append the records of several loads at once, all with the present time."""
    unknown = {r.status for r in runs} - {SUCCESS, FAILED, PARTIAL}
    if unknown:
        raise ValueError(f"unknown status {', '.join(sorted(unknown))}")
    if not runs:
        return
    now = dt.datetime.now(dt.timezone.utc)
    rows = [(r.layer, r.table, now, r.rows, r.status, r.rejected, r.message) for r in runs]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").saveAsTable(audit_table)


def record_run(spark: SparkSession, audit_table: str, *run, **more) -> None:
    """Append the record of one load; the arguments are those of ``Run``."""
    record_runs(spark, audit_table, [Run(*run, **more)])


def load_runs(spark: SparkSession, audit_table: str) -> DataFrame:
    """All run records; empty if there are none yet."""
    found = read_table(spark, audit_table)
    return spark.createDataFrame([], SCHEMA) if found is None else found


def latest_runs(runs: DataFrame) -> DataFrame:
    """The last record of each ``layer`` and ``table``."""
    rest = [c for c in runs.columns if c not in ("layer", "table")]
    # The remaining columns decide between records of the same instant.
    newest = F.max(F.struct("last_run", *(c for c in rest if c != "last_run")))
    return runs.groupBy("layer", "table").agg(newest.alias("r")).select("layer", "table", *(f"r.{c}" for c in rest))
