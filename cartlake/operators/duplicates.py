"""Duplicate split: one surviving row per key, and every other row as a reject.

The survivor is the first row of its key under a total order over all other columns, so
it is the same under any partitioning and in any re-run. Rows that tie are identical, so
the survivors and the rejects can be computed by separate plans and still add up.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlake.operators.columns import empty_like, require_columns
from cartlake.operators.joins import (
    KEY_HASH,
    SLICE_ROWS,
    dealt,
    hashable,
    shuffle_partitions,
    slices_of,
    split_heavy,
    spread_join,
)
from cartlake.operators.nulls import any_null
from cartlake.sources.scratch import materialize
from cartlake.specs import INGESTED_AT

# Copies of one row written by a single task.
COPIES_PER_TASK = 100_000
# Keys to pick, from which on all rows are ranked instead: the list is too large for a broadcast.
MANY_KEYS = 200_000
_N, _KEPT, _RANK = "__n", "__kept", "__rank"


def _order(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Newest load first, then all other columns ascending, NULLs first."""
    newest = [F.col(INGESTED_AT).desc_nulls_last()] if INGESTED_AT in df.columns else []
    rest = [f for f in df.schema.fields if f.name not in keys and f.name != INGESTED_AT]
    return newest + [_sortable(f).asc_nulls_first() for f in rest]


def _sortable(f: T.StructField) -> Column:
    return _ordered(F.col(f"`{f.name}`"), f.dataType)


def _ordered(col: Column, kind: T.DataType) -> Column:
    """The column as a type that has an order: maps, at any depth, as sorted lists of entries."""
    if "map<" not in kind.simpleString():
        return col
    if isinstance(kind, T.ArrayType):
        return F.transform(col, lambda x: _ordered(x, kind.elementType))
    if isinstance(kind, T.MapType):
        entries = F.transform(
            F.map_entries(col),
            lambda e: F.struct(
                _ordered(e["key"], kind.keyType).alias("key"), _ordered(e["value"], kind.valueType).alias("value")
            ),
        )
        return F.array_sort(entries)
    parts = (_ordered(col[f.name], f.dataType).alias(f.name) for f in kind.fields)
    return F.when(col.isNotNull(), F.struct(*parts))


def survivors(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First row of each key. NULL keys count as equal.

    ``rank = 1`` lets Spark keep one row per key and task before the shuffle, so a
    key with very many rows costs one row per input split.
    """
    return df.withColumn(_RANK, _rank(df, keys)).where(F.col(_RANK) == 1).drop(_RANK)


def _rank(df: DataFrame, keys: Sequence[str]) -> Column:
    # With no column besides the keys all rows of a key are the same.
    order = _order(df, keys) or [F.lit(0).asc()]
    return F.row_number().over(Window.partitionBy(*keys).orderBy(*order))


def ranked_split(
    df: DataFrame, keys: Sequence[str], rows: int, heavy: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)``: the first row of each key, and every other one, by a single shuffle of ``df``.

    ``rows`` says how many there are at most, so that a task gets a bounded share of them. A key's rows are
    in one task; those of ``heavy`` keys are split by ``survivors`` and ``surplus_rows`` instead.
    """
    hot, light = split_heavy(df, keys, heavy)
    ranked = dealt(light, keys, rows).withColumn(_RANK, _rank(df, keys))
    ranked, _ = materialize(ranked, "ranked-rows", small=True)
    first = F.col(_RANK) == 1
    valid, rejected = ranked.where(first).drop(_RANK), ranked.where(~first).drop(_RANK)
    if hot is not None:
        kept, surplus = split_duplicates(hot, keys)
        valid, rejected = valid.unionByName(kept), rejected.unionByName(surplus)
    return valid, rejected


def surplus_rows(df: DataFrame, kept: DataFrame, distinct: bool = False) -> DataFrame:
    """Rows of ``df`` without one copy of each row of ``kept``.

    Rows are grouped on all their columns, so a hot key spreads over the cluster and
    identical copies are counted before the shuffle instead of being moved. With
    ``distinct`` the result is ``df EXCEPT kept``: each differing row once.
    """
    cols = df.columns
    counted = (
        df.withColumn(_N, F.lit(1).cast("bigint"))
        .unionByName(kept.withColumn(_N, F.lit(-1).cast("bigint")))
        .groupBy(*cols)
        .agg(F.sum(_N).alias(_N), F.min(_N).alias(_KEPT))
    )
    if distinct:
        return counted.where(F.col(_KEPT) > 0).select(*cols)
    return repeat_rows(counted.where(F.col(_N) > 0).drop(_KEPT)).select(*cols)


def remaining_rows(df: DataFrame, taken: DataFrame, stamp: str) -> DataFrame:
    """Rows of ``df`` less as many copies of each as ``taken`` has, compared on the columns of ``taken``.

    What is left of rows that are equal on these has the other columns of the one with the least ``stamp``.
    """
    same = [c for c in taken.columns if c in df.columns]
    rest = [c for c in df.columns if c not in same]
    one = F.lit(1).cast("bigint")
    theirs = taken.select(*same).withColumn(_N, -one)
    # Equal rows are counted before the least stamp is looked for, which no hash aggregate does.
    counted = (
        df.withColumn(_N, one)
        .unionByName(theirs, allowMissingColumns=True)
        .groupBy(*same, *rest)
        .agg(F.sum(_N).alias(_N))
        .groupBy(*same)
        .agg(F.sum(_N).alias(_N), F.min_by(F.struct(*rest), stamp).alias("__rest"))
    )
    left = counted.where(F.col(_N) > 0).select(*same, "__rest.*", _N)
    return repeat_rows(left).select(*df.columns)


def repeat_rows(counted: DataFrame) -> DataFrame:
    """Each row as often as its ``__n`` says.

    Copies are written out in portions, spread over the tasks, so a row with very many copies is
    not the work of one.
    """
    cols = [c for c in counted.columns if c != _N]
    surplus = counted
    # A fixed partition count keeps the portions apart.
    portion = F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"({_N} - 1) div {COPIES_PER_TASK}")))
    portions = (
        surplus.withColumn("__portion", portion)
        .withColumn(_N, F.least(F.lit(COPIES_PER_TASK), F.col(_N) - F.col("__portion") * COPIES_PER_TASK))
        .repartition(shuffle_partitions(counted), "__portion", *hashable(counted.drop(_N)))
        .drop("__portion")
    )
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(_N)))
    return portions.withColumn(_N, copies).select(*cols)


@dataclass(frozen=True)
class KeyProfile:
    """What one pass over the key columns says about a table."""

    rows: int
    null_key_rows: int
    # Materialised keys with ``n_rows``: those that repeat and those with a NULL; NULL keys compare equal.
    touched: DataFrame
    n_repeated: int
    # Rows beyond the first of their key.
    surplus: int
    # Keys with more rows than a task may take, for ``spread_join``; None without any.
    heavy: DataFrame | None = None
    n_touched: int = 0

    @property
    def repeated(self) -> DataFrame:
        return self.touched.where("n_rows > 1")

    @property
    def duplicate_ratio(self) -> float:
        return self.surplus / self.rows if self.rows else 0.0


def profile_keys(df: DataFrame, keys: Sequence[str], slice_rows: int = SLICE_ROWS) -> KeyProfile:
    """Count rows per key once, reading only the key columns, and keep the keys that need work.

    The kept keys are written out: later plans then know their true size, and a small set is
    broadcast on Spark's own size check.
    """
    require_columns(df, keys)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    seen = {
        "rows": F.sum("n_rows"),
        "null_key_rows": F.sum(F.when(any_null(keys), F.col("n_rows"))),
        "n_repeated": F.count_if(F.col("n_rows") > 1),
        "surplus": F.sum(F.col("n_rows") - 1),
        "n_heavy": F.count_if(F.col("n_rows") > slice_rows),
    }
    keep = (F.col("n_rows") > 1) | any_null(keys)
    seen["n_touched"] = F.count_if(keep)
    touched, stats = materialize(counts, "repeated-keys", seen, keep=keep)
    heavy = None
    if stats["n_heavy"]:
        heavy = touched.where(F.col("n_rows") > slice_rows).select(
            F.xxhash64(*keys).alias(KEY_HASH), slices_of("n_rows", slice_rows)
        )
    return KeyProfile(
        stats["rows"] or 0,
        stats["null_key_rows"] or 0,
        touched,
        stats["n_repeated"] or 0,
        stats["surplus"] or 0,
        heavy,
        stats["n_touched"] or 0,
    )


def pick_touched(
    df: DataFrame, keys: Sequence[str], profile: KeyProfile
) -> tuple[DataFrame, DataFrame | None]:
    """``(touched, untouched)``: rows of keys that repeat or have a NULL, written out, and the others.

    That is one scan for either part, however the touched rows are split afterwards. Where the keys are
    many, picking them would shuffle all rows twice: then all rows are touched.
    """
    if profile.n_touched > MANY_KEYS:
        return df, None
    marks = profile.touched.select(*keys)
    touched = spread_join(df, marks, keys, "left_semi", profile.heavy, null_safe=True)
    untouched = spread_join(df, marks, keys, "left_anti", profile.heavy, null_safe=True)
    return materialize(touched, "repeated-rows")[0], untouched


def split_duplicates(
    df: DataFrame,
    keys: Sequence[str],
    rejects: str = "copies",
    profile: KeyProfile | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)``: one row per key, and the rest.

    ``rejects="copies"`` rejects every surplus row, so the two counts add up to the
    input. ``rejects="set"`` rejects the distinct rows that differ from the survivors. The
    survivors are written out once and serve both results.

    With a ``profile`` of the same rows only those of repeated keys are compared: a table
    without repeated keys passes through as it is, without any wide shuffle.
    """
    if rejects not in ("copies", "set"):
        raise ValueError(f"rejects must be 'copies' or 'set', not {rejects!r}")
    if not keys:
        return df, empty_like(df)
    require_columns(df, keys)
    if profile is not None:
        if not profile.n_repeated:
            return df, empty_like(df)
        touched, untouched = pick_touched(df, keys, profile)
        if rejects == "copies":
            valid, rejected = ranked_split(touched, keys, profile.rows, profile.heavy)
        else:
            valid, rejected = split_duplicates(touched, keys, rejects)
        return valid if untouched is None else untouched.unionByName(valid), rejected
    kept, _ = materialize(survivors(df, keys), "survivors")
    return kept, surplus_rows(df, kept, rejects == "set")
