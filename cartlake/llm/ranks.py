"""Ranks within groups, however large a group is."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartlake.llm.common import shuffle_partitions
from cartlake.sources.scratch import materialize

# Rows of a task have consecutive numbers from its own multiple of this.
_TASK_BITS = 33


def with_ranks(df: DataFrame, groups: Sequence[str], order: Sequence[str], purpose: str = "ranks") -> DataFrame:
    """``df`` with ``rank``, from 0 in each group in ascending ``order``, NULLs first, and the group's size ``n``.

    The rows are sorted over the cluster by range and written, numbered as they lie there; what
    comes before a task's first row of a group is added from a table with one row per group and
    task. So a group may be spread over any number of tasks. ``groups`` must not be NULL. Rows that
    agree in all of ``order`` are ranked by chance; many of them should differ in a last column.
    """
    if not groups:
        df, groups = df.withColumn("__all", F.lit(0)), ["__all"]
    by = [F.col(f"`{c}`").asc_nulls_first() for c in (*groups, *order)]
    dealt = df.repartitionByRange(shuffle_partitions(df), *by).sortWithinPartitions(*by)
    placed, _ = materialize(dealt.withColumn("__at", F.monotonically_increasing_id()), purpose)
    placed = placed.withColumn("__task", F.shiftright("__at", _TASK_BITS))
    held = placed.groupBy(*groups, "__task").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__held"))
    whole = Window.partitionBy(*groups)
    before = whole.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    bases = held.select(
        *groups,
        "__task",
        (F.coalesce(F.sum("__held").over(before), F.lit(0)) - F.col("__first")).alias("__base"),
        F.sum("__held").over(whole).alias("n"),
    )
    ranked = placed.join(bases, [*groups, "__task"]).withColumn("rank", F.col("__at") + F.col("__base"))
    return ranked.select(*(c for c in df.columns if c != "__all"), "rank", "n")
