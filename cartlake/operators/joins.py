"""Equi-join that stays balanced when one key holds a large share of the left side.

Adaptive execution splits a skewed partition only when both inputs of the join
come straight from a shuffle and nothing above the join relies on its
partitioning. Joins of two large tables on the same key as their neighbours do
not meet that, so their heavy keys are found first and spread over slices here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlake.sources.scratch import materialize

# Rows of one key that a single task may take.
SLICE_ROWS = 1_000_000
# Rows that a task sorts, where their number is known.
TASK_ROWS = 500_000

KEY_HASH, _SLICE, _SLICES = "__key_hash", "__slice", "__slices"


def slices_of(rows: str, slice_rows: int) -> Column:
    return F.ceil(F.col(rows) / slice_rows).cast("int").alias(_SLICES)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def dealt(df: DataFrame, on: Sequence[str], rows: int) -> DataFrame:
    """``df`` dealt by ``on`` for an operation that needs it so, if ``rows`` are more than a task may sort.

    Adaptive execution goes by shuffled bytes, which say little of rows, and never beyond the usual number of
    tasks. What a task sorts stays the same here however large the table is, and is not spilled.
    """
    tasks = -(-rows // TASK_ROWS)
    return df.repartition(max(tasks, shuffle_partitions(df)), *on) if tasks > 1 else df


def split_heavy(
    df: DataFrame, on: Sequence[str], heavy: DataFrame | None
) -> tuple[DataFrame | None, DataFrame]:
    """``(hot, light)``: rows of ``heavy`` keys, None without such keys, and the others."""
    if heavy is None:
        return None, df
    hashed = df.withColumn(KEY_HASH, F.xxhash64(*on))
    hot, light = (hashed.join(heavy.select(KEY_HASH), KEY_HASH, how) for how in ("left_semi", "left_anti"))
    return hot.drop(KEY_HASH), light.drop(KEY_HASH)


def heavy_keys(df: DataFrame, on: Sequence[str], slice_rows: int = SLICE_ROWS) -> DataFrame | None:
    """All keys of ``df`` with more than ``slice_rows`` rows, by hash, with their number of slices."""
    return key_load(df, on, slice_rows)[0]


def key_load(
    df: DataFrame, on: Sequence[str], slice_rows: int = SLICE_ROWS
) -> tuple[DataFrame | None, int]:
    """``heavy_keys``, and the number of all rows.

    One pass over the key columns counts the rows of each key exactly, summed up before they are
    shuffled: the keys themselves, as hashes of them cannot be compressed. The list is written out and
    never meets the driver; None if there are none.
    """
    counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("n"))
    many = F.col("n") > slice_rows
    found, seen = materialize(counts, "heavy-keys", {"n": F.count_if(many), "rows": F.sum("n")}, keep=many)
    # Keys of one hash are one entry, so that no row meets two.
    heavy = found.groupBy(F.xxhash64(*on).alias(KEY_HASH)).agg(F.sum("n").alias("n"))
    return heavy.select(KEY_HASH, slices_of("n", slice_rows)) if seen["n"] else None, seen["rows"] or 0


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    heavy: DataFrame | None = None,
    null_safe: bool = False,
    rows: int = 0,
) -> DataFrame:
    """``left.join(right, on, how)`` with the rows of ``heavy`` left keys cut into slices.

    Of ``rows`` left rows, if that is known, a task gets a bounded share.

    ``how`` is inner, left, left_semi or left_anti. A left row goes to one slice of its
    key, a right row to all of them; ``right`` should hold few rows per key. The list of heavy
    keys is a written table, so a re-run task places every row as before; Spark broadcasts
    it if it is small, and joins it like any table otherwise.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot spread a {how} join")
    on = list(on)
    extra: list[str] = []
    if heavy is not None:
        left, right = _sliced(left, right, on, heavy)
        extra = [_SLICE]
    # Both sides: a side that another join has dealt would pull the other one to its number of tasks.
    left, right = (dealt(side, on + extra, rows) for side in (left, right))
    if not null_safe:
        return left.join(right, on + extra, how).drop(*extra)
    renamed = right.withColumnsRenamed({c: f"__r_{c}" for c in on + extra})
    cond: Column = F.lit(True)
    for c in on + extra:
        cond &= F.col(c).eqNullSafe(F.col(f"__r_{c}"))
    return left.join(renamed, cond, how).drop(*extra, *(f"__r_{c}" for c in on + extra))


def _sliced(left: DataFrame, right: DataFrame, on: list[str], heavy: DataFrame):
    # The partition id tells identical rows of different input splits apart and is the
    # same when a lost task runs again. Only rows of heavy keys are hashed.
    place = F.pmod(F.xxhash64(F.spark_partition_id(), *hashable(left)), F.col(_SLICES)).cast("int")
    left = (
        left.withColumn(KEY_HASH, F.xxhash64(*on))
        .join(heavy, KEY_HASH, "left")
        .withColumn(_SLICE, F.when(F.col(_SLICES).isNotNull(), place).otherwise(0))
        .drop(KEY_HASH, _SLICES)
    )
    right = (
        right.withColumn(KEY_HASH, F.xxhash64(*on))
        .join(heavy, KEY_HASH, "left")
        .withColumn(_SLICE, F.explode(F.sequence(F.lit(0), F.coalesce(_SLICES, F.lit(1)) - 1)))
        .drop(KEY_HASH, _SLICES)
    )
    return left, right


def hashable(df: DataFrame) -> list[Column]:
    """Columns that can be hashed: maps cannot, wherever they are in a type."""
    return [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
