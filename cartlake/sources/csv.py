"""Raw CSV tables, and the audit of raw files."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlake.functions.kinds import wider
from cartlake.functions.names import clean_name
from cartlake.specs import CORRUPT_RECORD


# Places that a decimal cell is read with before it is compared with its declared type.
_WIDE = T.DecimalType(38, 18)


def _reader(spark: SparkSession, multi_line: bool) -> DataFrameReader:
    # Doubled quotes inside quoted cells. A file read with multiLine cannot be split, so
    # that is an option for tables whose cells hold line breaks. The header of each file is
    # compared with the columns, and a file with others raises.
    return (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("enforceSchema", False)
    )


def read_csv_inferred(
    spark: SparkSession,
    path: str | Sequence[str],
    multi_line: bool = False,
    known: Mapping[str, T.DataType] | None = None,
) -> DataFrame:
    """Headered CSV with types guessed from the cells, at the price of one more pass.

    ``known`` has the types, by cleaned column name, of a table that the rows are to join. A
    column is then read with the wider of the known type and the guess, straight from its
    cells: under a known text column ``0456`` keeps its zero. A column without any value takes
    the known type; to find that out costs a pass over columns that were guessed as text
    and are not known as such.
    """
    guessed = _reader(spark, multi_line).csv(path, inferSchema=True)
    if not known:
        return guessed
    text = T.StringType()
    before = {f.name: known.get(clean_name(f.name), f.dataType) for f in guessed.schema.fields}
    guess = {f.name: f.dataType for f in guessed.schema.fields}
    unsure = [n for n in guess if guess[n] == text and before[n] != text]
    if unsure:
        some = guessed.agg(*(F.max(F.col(f"`{n}`").isNotNull()) for n in unsure)).first()
        guess |= {n: T.NullType() for n, any_value in zip(unsure, some) if not any_value}
    kinds = T.StructType([T.StructField(n, wider(before[n], guess[n])) for n in guess])
    if kinds == guessed.schema:
        return guessed
    return _reader(spark, multi_line).schema(kinds).csv(path)


def files_by_header(spark: SparkSession, path: str | Sequence[str]) -> list[tuple[str, list[str]]]:
    """Header lines of the files at ``path``, each with its files; one pass over their lines.

    As many rows as there are files meet the driver, which keeps the paths of a scan anyway.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.struct("_metadata.file_block_start", F.monotonically_increasing_id()).alias("place"),
    )
    per_file = lines.where("place.file_block_start = 0").groupBy("path").agg(F.min_by("value", "place").alias("header"))
    found = per_file.groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    return [(r.header, r.paths) for r in found.orderBy("header").collect()]


def read_csv_typed(
    spark: SparkSession,
    path: str | Sequence[str],
    types: Mapping[str, T.DataType],
    multi_line: bool = False,
    mixed_headers: bool = False,
) -> DataFrame:
    """Headered CSV with declared types, and the text of unreadable records.

    Types are declared by cleaned column name, in any order; other columns are strings.
    A record with a cell that does not fit its type, or with missing or extra cells, has
    its text in ``_corrupt_record`` and NULL in the cells that do not fit. A decimal with more
    places than declared does not fit. A malformed timestamp is NULL and its record readable.

    All files must have the same columns in the same order, or the read fails. With
    ``mixed_headers`` files are read by the order that each has, and united by name; a column that
    a file lacks is NULL. That takes one more pass over the lines.
    """
    if mixed_headers:
        parts = [
            read_csv_typed(spark, paths, {n: t for n, t in types.items() if clean_name(n) in _named(header)}, multi_line)
            for header, paths in files_by_header(spark, path)
        ]
        known = {clean_name(c) for part in parts for c in part.columns}
        _require({clean_name(n) for n in types}, known, path)
        united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        return united.select(*(c for c in united.columns if c != CORRUPT_RECORD), CORRUPT_RECORD)
    # Only the header line is read here: without inference all columns are strings.
    header = _reader(spark, multi_line).csv(path).columns
    declared = {clean_name(n): t for n, t in types.items()}
    _require(set(declared), {clean_name(n) for n in header}, path)
    text = T.StructType([T.StructField(n, T.StringType()) for n in [*header, CORRUPT_RECORD]])
    raw = (
        _reader(spark, multi_line)
        .schema(text)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_RECORD)
        # Cells are counted whatever columns a query uses.
        .option("columnPruning", False)
        .csv(path)
    )
    # The reader would convert, and so check, only the columns that a query uses. Casting
    # here makes the split the same for every query.
    cells = {n: F.col(f"`{n}`") for n in header}
    kinds = {n: declared.get(clean_name(n), T.StringType()) for n in header}
    typed = {n: c if isinstance(kinds[n], T.StringType) else c.try_cast(kinds[n]) for n, c in cells.items()}
    # Never true. The reader refuses queries of the corrupt records alone, so a cell takes part.
    misfit = F.length(cells[header[0]]) < 0
    for n, kind in kinds.items():
        if isinstance(kind, (T.StringType, T.TimestampType, T.TimestampNTZType)):
            continue
        misfit |= cells[n].isNotNull() & typed[n].isNull()
        if isinstance(kind, T.DecimalType):
            # The cast rounds; what it changes does not fit.
            misfit |= F.coalesce(cells[n].try_cast(_WIDE) != typed[n], F.lit(False))
    typed = {
        n: F.when(cells[n].try_cast(_WIDE) == c, c) if isinstance(kinds[n], T.DecimalType) else c
        for n, c in typed.items()
    }
    corrupt = F.coalesce(F.col(CORRUPT_RECORD), F.when(misfit, F.to_csv(F.struct(*cells.values()))))
    return raw.select(*(c.alias(n) for n, c in typed.items()), corrupt.alias(CORRUPT_RECORD))


def _named(header: str) -> set[str]:
    """Cleaned column names of a header line; quoted names may hold commas and doubled quotes."""
    names = next(csv.reader([header], skipinitialspace=True), [])
    return {clean_name(n.strip()) for n in names}


def _require(declared: set[str], present: set[str], path: object) -> None:
    absent = sorted(declared - present)
    if absent:
        raise ValueError(f"{path} has no column {', '.join(absent)}")


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(readable, corrupt)``; the readable rows lose the ``_corrupt_record`` column."""
    bad = F.col(CORRUPT_RECORD).isNotNull()
    return df.where(~bad).drop(CORRUPT_RECORD), df.where(bad)


def raw_line_audit(spark: SparkSession, root: str, expected: Mapping[str, int]) -> DataFrame:
    """Compare physical line counts below ``root`` with the ``expected`` ones of each source.

    A source is a file or folder directly below ``root``; a folder counts all its part
    files. Only these are read. ``status`` is OK, MISMATCH or MISSING.
    """
    counted = []
    for source, lines in expected.items():
        path = f"{root.rstrip('/')}/{source}"
        if _exists(spark, path):
            actual = spark.read.option("recursiveFileLookup", True).text(path).agg(F.count(F.lit(1)).alias("n"))
        else:
            actual = spark.range(1).select(F.lit(None).cast("bigint").alias("n"))
        counted.append(
            actual.select(
                F.lit(source).alias("source"),
                F.lit(lines).cast("bigint").alias("expected_lines"),
                F.col("n").alias("actual_lines"),
            )
        )
    if not counted:
        return spark.createDataFrame([], "source string, expected_lines bigint, actual_lines bigint, status string")
    status = (
        F.when(F.col("actual_lines").isNull(), "MISSING")
        .when(F.col("actual_lines") == F.col("expected_lines"), "OK")
        .otherwise("MISMATCH")
    )
    return reduce(DataFrame.unionByName, counted).withColumn("status", status)


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


class RawFilesError(RuntimeError):
    """Raw files are missing or do not have the expected number of lines."""


def verify_raw_files(spark: SparkSession, root: str, expected: Mapping[str, int]) -> DataFrame:
    """Audit the files of ``expected`` and raise if any does not match, or if there are none."""
    if not expected:
        raise ValueError("no file has an expected number of lines, so there is nothing to verify")
    report = raw_line_audit(spark, root, expected)
    # One row per expected file.
    wrong = report.where("status <> 'OK'").orderBy("source").collect()
    if wrong:
        raise RawFilesError(
            "; ".join(f"{r.source}: {r.status}, {r.actual_lines} of {r.expected_lines} lines" for r in wrong)
        )
    return report
