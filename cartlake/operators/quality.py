"""Null and duplicate ratios, and the gate that compares them with limits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlake.operators.duplicates import KeyProfile
from cartlake.specs import QualityThresholds


class QualityError(RuntimeError):
    """A quality limit was passed and the run asks to stop on that."""


def null_ratios(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, null_rows, total_rows, null_ratio)``, from one pass over the data."""
    columns = list(columns or df.columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *(F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(columns)),
    )
    each = F.array(
        *(F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("null_rows")) for i, c in enumerate(columns))
    )
    ratio = F.col("null_rows") / F.nullif(F.col("total_rows"), F.lit(0))
    return counts.select("total_rows", F.inline(each)).select(
        "column", "null_rows", "total_rows", F.coalesce(ratio, F.lit(0.0)).alias("null_ratio")
    )


def duplicate_ratio(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(total_rows, duplicate_rows, duplicate_ratio)``: rows beyond the first of their key."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"),
    )
    ratio = F.col("duplicate_rows") / F.nullif(F.col("total_rows"), F.lit(0))
    return totals.withColumn("duplicate_ratio", F.coalesce(ratio, F.lit(0.0)))


def quality_gate(
    df: DataFrame,
    keys: Sequence[str],
    limits: QualityThresholds = QualityThresholds(),
    profile: KeyProfile | None = None,
) -> DataFrame:
    """``(check, column, ratio, max_ratio, passed)``: one row per column, one for the keys.

    A ``profile`` of the keys saves counting them once more.
    """
    report = null_ratios(df).select(
        F.lit("null_ratio").alias("check"),
        "column",
        F.col("null_ratio").alias("ratio"),
        F.lit(limits.max_null_ratio).alias("max_ratio"),
    )
    if keys:
        duplicates = (
            duplicate_ratio(df, keys)
            if profile is None
            else df.sparkSession.range(1).select(F.lit(profile.duplicate_ratio).alias("duplicate_ratio"))
        )
        report = report.unionByName(
            duplicates.select(
                F.lit("duplicate_ratio").alias("check"),
                F.lit(",".join(keys)).alias("column"),
                F.col("duplicate_ratio").alias("ratio"),
                F.lit(limits.max_duplicate_ratio).alias("max_ratio"),
            )
        )
    return report.withColumn("passed", F.col("ratio") <= F.col("max_ratio"))


def failed_checks(report: DataFrame) -> list[str]:
    """The failed checks in words; a report has one row per column."""
    failed = report.where(~F.col("passed")).orderBy("check", "column").collect()
    return [f"{r['check']} of {r['column']} is {r.ratio:.4f}, limit {r.max_ratio}" for r in failed]


def enforce_gate(report: DataFrame, limits: QualityThresholds) -> list[str]:
    """Return the failed checks, or raise them if the limits ask for that."""
    failed = failed_checks(report)
    if failed and limits.fail_on_quality_error:
        raise QualityError("; ".join(failed))
    return failed
