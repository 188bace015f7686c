"""Log of what was loaded into silver tables: which bronze loads, and which batches gold has not seen.

A batch is prepared (its results lie in a folder), applied to its table, and built into gold.
A crash leaves it in one of these states, from which the next run goes on.
"""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cartlake.sources.tables import ensure_namespace, read_table
from cartlake.specs import Layers

PREPARED, APPLIED, BUILT = "prepared", "applied", "built"
# The table was replaced as a whole; its bronze loads so far are in it.
REPLACED = "replaced"

_SCHEMA = "`table` string, batch string, event string, path string, loads array<string>, at timestamp"

# Loads of several tables run side by side and append to one log.
_ONE_WRITER = threading.Lock()


class Batch(NamedTuple):
    """One event of a batch. ``path`` is the folder of its results, ``loads`` are the bronze loads in it."""

    table: str
    batch: str
    event: str
    path: str | None = None
    loads: tuple[str, ...] = ()


class State(NamedTuple):
    """What the log says of a table."""

    # Bronze loads that are in the silver table; None if it was never logged.
    loads: frozenset[str] | None
    prepared: Batch | None
    # Applied since gold was built, in order; one of them may be a replacement.
    pending: tuple[Batch, ...]


def batch_log(layers: Layers) -> str:
    return f"{layers.ops}.batches"


def log_batches(spark: SparkSession, layers: Layers, batches: Sequence[Batch]) -> None:
    now = dt.datetime.now(dt.timezone.utc)
    rows = [(*b[:4], list(b.loads), now) for b in batches]
    with _ONE_WRITER:
        ensure_namespace(spark, layers.ops, layers.location)
        spark.createDataFrame(rows, _SCHEMA).coalesce(1).write.mode("append").saveAsTable(batch_log(layers))


def read_state(spark: SparkSession, layers: Layers, tables: Iterable[str]) -> dict[str, State]:
    """The state of each table, from the events since the last replacement that gold has seen.

    A few rows per run and table meet the driver.
    """
    with _ONE_WRITER:
        log = read_table(spark, batch_log(layers))
        found = [] if log is None else log.where(F.col("table").isin(*tables)).orderBy("at").collect()
    out = {}
    for table in tables:
        loads, prepared, pending = None, None, []
        for r in (r for r in found if r["table"] == table):
            b = Batch(table, r.batch, r.event, r.path, tuple(r.loads or ()))
            if b.event == REPLACED:
                loads, prepared, pending = frozenset(b.loads), None, [*pending, b]
            elif b.event == PREPARED:
                prepared = b
            elif b.event == APPLIED:
                loads = (loads or frozenset()) | set(b.loads)
                prepared = None if prepared and prepared.batch == b.batch else prepared
                pending.append(b)
            elif b.event == BUILT:
                pending = [p for p in pending if p.batch != b.batch]
        out[table] = State(loads, prepared, tuple(pending))
    return out
