"""Cross-site boilerplate lines, by the number of sites that a line is spread over.

Per line hash a HyperLogLog sketch of the sites is merged by aggregation: a row per line and
task is shuffled, however often the line occurs. Lines whose estimate is near the threshold get
an exact distinct count; only the others are decided by the sketch. All operations are built-in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlake.llm.common import located, text_of
from cartlake.sources.scratch import materialize

MIN_SITES = 5
LOG_K = 12
# The sketch's standard error is about 0.8 / sqrt(2^LOG_K). Ten of them on both sides are near.
MARGIN = 10 * 0.8 / 2 ** (LOG_K / 2)


def line_hash(line: Column) -> Column:
    """The trimmed line's MD5 as text, NULL for blank lines, which are never boilerplate."""
    trimmed = F.trim(line)
    return F.when(trimmed != "", F.md5(F.encode(trimmed, "UTF-8")))


def boilerplate_lines(lines: DataFrame, min_sites: int = MIN_SITES, log_k: int = LOG_K) -> DataFrame:
    """``hash`` of the lines on ``min_sites`` different sites or more, from ``hash, site`` rows.

    A NULL site is no site. The estimate decides only where it is far from ``min_sites``.
    """
    spread = lines.where("hash IS NOT NULL AND site IS NOT NULL")
    # A line of one site only needs no sketch to be known as such.
    sketched = spread.groupBy("hash").agg(
        F.hll_sketch_agg("site", log_k).alias("sketch"),
        F.min("site").alias("least"),
        F.max("site").alias("most"),
    )
    estimate = F.when(F.col("least") == F.col("most"), 1).otherwise(F.hll_sketch_estimate("sketch"))
    estimates, _ = materialize(
        sketched.select("hash", estimate.alias("sites")),
        "line-spread",
        keep=F.col("sites") >= min_sites * (1 - MARGIN) - 1,
    )
    sure = F.col("sites") > min_sites * (1 + MARGIN) + 1
    near = spread.join(estimates.where(~sure).select("hash"), "hash", "left_semi")
    exact = near.select("hash", "site").distinct().groupBy("hash").agg(F.count(F.lit(1)).alias("sites"))
    return estimates.where(sure).select("hash").unionByName(exact.where(f"sites >= {min_sites}").select("hash"))


def remove_boilerplate(
    docs: DataFrame,
    min_sites: int = MIN_SITES,
    text_col: str = "text",
    site_col: str = "source",
) -> DataFrame:
    """``docs`` with ``clean_text``, ``n_lines`` and ``n_removed``, one row per row.

    Lines end at line feeds; the lines that stay are joined by them again. A line is compared
    without the blanks at its ends. Blank lines stay. NULL text counts as empty: one blank line.
    Lines of documents without a site are removed like any other, but do not add to the
    spread. Columns of ``docs`` with these names are replaced. Empty tables give no rows.
    """
    rows = located(docs.drop("clean_text", "n_lines", "n_removed"))
    split = F.split(text_of(text_col), "\n", -1)
    place = ("__file", "__row")
    hashes = F.transform(split, line_hash)
    distinct = F.explode(F.array_distinct(hashes)).alias("hash")
    lines = rows.select(*place, F.col(f"`{site_col}`").cast("string").alias("site"), distinct)
    common, _ = materialize(boilerplate_lines(lines.select("hash", "site"), min_sites), "boilerplate")
    found = (
        lines.where("hash IS NOT NULL")
        .select(*place, "hash")
        .join(common, "hash")
        .groupBy(*place)
        .agg(F.collect_set("hash").alias("__bad"))
    )
    joined = rows.join(found, list(place), "left")
    bad = F.coalesce(F.col("__bad"), F.array().cast("array<string>"))
    stays = F.filter(split, lambda x: ~F.coalesce(F.array_contains(bad, line_hash(x)), F.lit(False)))
    out = joined.withColumn("__lines", split)
    kept = F.when(F.col("__bad").isNull(), F.col("__lines")).otherwise(stays)
    return (
        out.withColumn("__kept", kept)
        .withColumn("clean_text", F.array_join("__kept", "\n"))
        .withColumn("n_lines", F.size("__lines").cast("bigint"))
        .withColumn("n_removed", (F.size("__lines") - F.size("__kept")).cast("bigint"))
        .drop(*place, "__bad", "__lines", "__kept")
    )
