"""The whole run: raw files to bronze, silver, gold and views, with a record per table."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor, as_completed
from functools import partial
from typing import NamedTuple

from pyspark.sql import SparkSession

from cartlake.plans import bronze, gold, silver
from cartlake.plans.views import publish_views
from cartlake.sources.audit import FAILED, PARTIAL, SUCCESS, Run, record_runs
from cartlake.sources.tables import ensure_namespace
from cartlake.specs import RETAIL_TABLES, Layers, QualityThresholds, TableSpec

log = logging.getLogger(__name__)

# Fixed value: the name under which a failed gold build is recorded.
GOLD_BATCH = "gold_layer_batch"


class RunFailed(RuntimeError):
    """Some tables of a layer failed; the others were finished and recorded."""


class _Landed(NamedTuple):
    rows: int
    rejected: int
    widened: tuple[str, ...]


def audit_table(layers: Layers) -> str:
    return f"{layers.ops}.run_audit"


def _run_layer(
    spark: SparkSession,
    layer: str,
    specs: Sequence[TableSpec],
    layers: Layers,
    load: Callable[[TableSpec], object],
    workers: int,
) -> None:
    """Load the tables of a layer side by side, record all of them, raise at the end if any failed."""
    failed = []
    runs: list[Run] = []
    with ThreadPoolExecutor(max_workers=workers) as pool:
        tasks = {pool.submit(load, s): s.name for s in specs}
        for task in as_completed(tasks):
            name = tasks[task]
            try:
                done = task.result()
            except Exception as error:
                log.exception("%s.%s failed", layer, name)
                failed.append(name)
                runs.append(Run(layer, name, 0, FAILED, message=str(error)))
                continue
            if done is None:
                log.warning("%s.%s skipped: its input table does not exist", layer, name)
                continue
            breaches = getattr(done, "breaches", ())
            status = PARTIAL if breaches else SUCCESS
            notes = [*breaches, *(f"widened {w}" for w in getattr(done, "widened", ()))]
            runs.append(Run(layer, name, done.rows, status, done.rejected, "; ".join(notes) or None))
    record_runs(spark, audit_table(layers), runs)
    if failed:
        raise RunFailed(f"{layer}: {', '.join(sorted(failed))}")


def run_bronze(
    spark: SparkSession,
    raw_root: str,
    specs: Sequence[TableSpec] = RETAIL_TABLES,
    layers: Layers = Layers(),
    skip_loaded: bool = False,
    workers: int = 4,
    by_load: bool = False,
) -> None:
    ensure_namespace(spark, layers.ops, layers.location)

    def load(spec: TableSpec):
        widened: list[str] = []
        done = bronze.load(spark, spec, raw_root, layers, skip_loaded, by_load, widened.extend)
        return _Landed(*done, tuple(widened))

    _run_layer(spark, "bronze", specs, layers, load, workers)


def run_silver(
    spark: SparkSession,
    specs: Sequence[TableSpec] = RETAIL_TABLES,
    layers: Layers = Layers(),
    limits: QualityThresholds | None = None,
    workers: int = 4,
    mode: str = "overwrite",
) -> None:
    ensure_namespace(spark, layers.ops, layers.location)
    _run_layer(spark, "silver", specs, layers, lambda spec: silver.load(spark, spec, layers, limits, mode), workers)


def run_gold(
    spark: SparkSession,
    layers: Layers = Layers(),
    names: dict[str, str] | None = None,
    first: dt.date | None = None,
    last: dt.date | None = None,
    workers: int = 4,
    mode: str = "overwrite",
) -> dict[str, int]:
    ensure_namespace(spark, layers.ops, layers.location)
    runs: list[Run] = []
    try:
        make = gold.refresh if mode == "incremental" else partial(gold.build, mode=mode)
        return make(
            spark,
            layers,
            names,
            first,
            last,
            on_written=lambda name, rows: runs.append(Run("gold", name, rows)),
            workers=workers,
        )
    except Exception as error:
        runs.append(Run("gold", GOLD_BATCH, 0, FAILED, message=str(error)))
        raise
    finally:
        record_runs(spark, audit_table(layers), runs)


def run(
    spark: SparkSession,
    raw_root: str,
    specs: Sequence[TableSpec] = RETAIL_TABLES,
    layers: Layers = Layers(),
    limits: QualityThresholds | None = None,
    names: dict[str, str] | None = None,
    first: dt.date | None = None,
    last: dt.date | None = None,
    skip_loaded: bool = False,
    workers: int = 4,
    mode: str = "overwrite",
) -> dict[str, int]:
    """Raw files to published views; rows of the gold tables by name.

    ``mode="partitions"`` replaces only those partitions of partitioned tables that have rows now.
    ``mode="incremental"`` loads new raw files only, merges them into silver by key, and computes the
    gold partitions that they touch; the first such run is a whole one.

    A layer starts only after the one before it is complete. A failed table does not keep
    the others of its layer from finishing, but it fails the run.
    """
    new = mode == "incremental"
    run_bronze(spark, raw_root, specs, layers, skip_loaded or new, workers, new)
    run_silver(spark, specs, layers, limits, workers, mode)
    rows = run_gold(spark, layers, names, first, last, workers, mode)
    publish_views(spark, layers)
    return rows
