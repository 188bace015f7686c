"""Working folder shared by the driver and all executors."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import Column, DataFrame, Observation, SparkSession


# Fixed value: the compression of layer tables, which takes less room than Spark's own choice.
PACKED = "zstd"
# Fixed value: its least effort, which takes as much room for these tables as the usual one, and a tenth less time.
PACKING = {"parquet.compression.codec.zstd.level": "1"}

# Whether the shuffle files of a statement are deleted at its end, not when the driver collects its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Paths made below the innermost ``released`` block of this thread.
_made: ContextVar[list[str] | None] = ContextVar("cartlake_scratch", default=None)


@cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="cartlake-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a temporary folder; a cluster session is an
    error, since a folder of one machine is not visible to the others.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if spark.conf.get("spark.master", "local").startswith("local"):
        return _local_folder()
    raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")


def scratch_path(spark: SparkSession, purpose: str, keep: bool = False) -> str:
    """A new path of the shared folder. With ``keep`` a ``released`` block around leaves it there."""
    path = f"{scratch_root(spark)}/cartlake/{purpose}-{uuid.uuid4().hex}"
    if not keep and (made := _made.get()) is not None:
        made.append(path)
    return path


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch paths made in the block at its end, also if it fails.

    For work that is complete by then: a frame that still reads such a path cannot be used after.
    """
    made: list[str] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        for path in made:
            delete_path(spark, path)


def delete_path(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def materialize(
    df: DataFrame,
    purpose: str,
    observed: Mapping[str, Column] | None = None,
    keep: Column | None = None,
    small: bool = False,
) -> tuple[DataFrame, dict]:
    """Write ``df`` to the shared folder and read it back, cutting its lineage.

    ``observed`` aggregates are taken over all of ``df`` in the same pass; only rows
    matching ``keep`` are written. ``small`` packs them as layer tables are, for somewhat more time.
    """
    path = scratch_path(df.sparkSession, purpose)
    watch = Observation()
    if observed:
        df = df.observe(watch, *(c.alias(n) for n, c in observed.items()))
    if keep is not None:
        df = df.where(keep)
    df.write.options(**PACKING if small else {}).parquet(path, compression=PACKED if small else None)
    return df.sparkSession.read.schema(df.schema).parquet(path), watch.get if observed else {}


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as ``materialize`` gives it; what was shuffled for it is deleted when it is written."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        return materialize(df, purpose)[0]
    finally:
        conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)
