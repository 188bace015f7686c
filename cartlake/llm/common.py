"""What several operators of this package share."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import cartlake
from cartlake.sources.scratch import materialize

# A word is a run of characters other than the blank and the five ASCII control blanks.
WORD = r"[^\x20\x09-\x0D]+"


def text_of(name: str = "text") -> Column:
    """The text, NULL read as empty."""
    return F.coalesce(F.col(f"`{name}`"), F.lit(""))


def word_count(name: str = "text") -> Column:
    return F.regexp_count(text_of(name), F.lit(WORD)).cast("bigint")


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def located(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__file`` and ``__row``: the place of each row in its Parquet file.

    The place tells rows apart that agree in all columns and is the same in every re-run.
    Rows that do not come straight from files are written to the shared folder first.
    """
    try:
        meta = docs.metadataColumn("_metadata")
        return docs.select("*", meta.file_path.alias("__file"), meta.row_index.alias("__row"))
    except Exception as error:
        if type(error).__name__ != "AnalysisException":
            raise
    return located(materialize(docs, "located")[0])


def ship(spark: SparkSession) -> None:
    """Hand this library to the executors, for sessions whose workers do not find it installed."""
    context = spark.sparkContext
    name = f"cartlake-{context.applicationId}.zip"
    if any(f.endswith(name) for f in context.listFiles):
        return
    folder = os.path.dirname(os.path.abspath(cartlake.__file__))
    made = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="cartlake-"), name[:-4]),
        "zip",
        os.path.dirname(folder),
        os.path.basename(folder),
    )
    context.addPyFile(made)
