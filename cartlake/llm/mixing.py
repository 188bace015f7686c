"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document draws an exponential key whose rate is its quality weight. Within a source the
documents are taken by ascending key until the source's budget of words is used up, so better
documents come sooner. Whole epochs come first; only what is left of a budget is selected.

The order within a source is found in two levels, since a source can hold a third of all rows:
keys fall into ranges, the sizes of the ranges are summed up first, and rows are ordered within
their range only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartlake.llm.common import located, text_of, word_count
from cartlake.sources.scratch import materialize

RANGES = 4096
WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2


def quality_weight(size: Column, text: Column) -> Column:
    """Between 0 and 1, largest where words have five letters on average."""
    mean = (F.length(text) - size) / F.greatest(size, F.lit(1))
    return 1 / (1 + F.abs(mean - 5) / 5)


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS
) -> DataFrame:
    """``source, source_size, target`` from one row ``source, source_size`` per source.

    Sources by code point, NULL last, weigh ``weights`` in turn and share ``share`` of all
    words. No target is above ``epochs`` times its source's size; what is above goes to the
    others by weight. The sources that stop are those with the least size per weight: going up
    in that order, a source stops if its limit is at most its share of what is still left.
    """
    alone = Window.partitionBy()
    turn = F.row_number().over(alone.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), F.pmod(turn, F.lit(len(weights))) + 1)
    ranked = sizes.withColumn("turn", turn).withColumn("w", weight.cast("bigint"))
    ranked = ranked.withColumn("most", F.col("source_size") * epochs)
    up = alone.orderBy(F.col("most") / F.col("w"), "turn")
    before = F.coalesce(F.sum("most").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    level = (F.lit(share) * F.sum("source_size").over(alone) - before) / F.sum("w").over(
        up.rowsBetween(0, Window.unboundedFollowing)
    )
    levels = ranked.withColumn("level", level).withColumn("stops", F.expr("most <= level * w"))
    final = F.first(F.expr("if(stops, NULL, level)"), ignorenulls=True).over(
        up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    target = F.when(F.col("stops"), F.col("most").cast("double")).otherwise(final * F.col("w"))
    return levels.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    epochs: int = EPOCHS,
    ranges: int = RANGES,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    carry: Sequence[str] = (),
) -> DataFrame:
    """``id, size, source, source_size, target, times, taken, text_md5``, one row per row of ``docs``.

    ``times`` is how often the mix has the document: the whole epochs of its source, and once
    more if the selection takes it. ``taken = size * times``. A document at the edge of a budget
    is taken if at least half of it fits. NULL sources are one source; NULL texts have no words
    and cost nothing. Keys come from id and text, so re-runs agree; documents of the same id
    and text tie, and it does not matter which of them is taken. Empty tables give no rows. The
    columns named by ``carry`` come along.
    """
    text = text_of(text_col)
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{source_col}`").alias("source"),
        F.coalesce(F.col(f"`{source_col}`"), F.lit("")).alias("s"),
        F.col(f"`{source_col}`").isNull().alias("none"),
        word_count(text_col).alias("size"),
        F.md5(F.encode(text, "UTF-8")).alias("text_md5"),
        text.alias("text"),
        *carry,
    )
    digest = F.md5(F.concat_ws(":", F.col("id").cast("string"), F.col("text_md5")).cast("binary"))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") + 1) / F.lit(float(1 << 52))
    rows = rows.withColumn("key", -F.ln(u) / quality_weight(F.col("size"), F.col("text")))
    # Increasing in the key, and even over the ranges where weights are alike.
    rows = rows.withColumn("range", F.floor((1 - F.exp(-F.col("key"))) * ranges)).drop("text")
    rows, _ = materialize(rows, "mix-keys")
    per_range = rows.groupBy("s", "none", "range").agg(F.sum("size").alias("in_range"))
    sizes = per_range.groupBy("s", "none").agg(F.sum("in_range").alias("source_size"))
    named = sizes.select("s", "none", F.expr("if(none, NULL, s)").alias("source"), "source_size")
    targets = named.drop("source").join(
        source_targets(named.select("source", "source_size"), weights, share, epochs).select(
            F.coalesce("source", F.lit("")).alias("s"), F.col("source").isNull().alias("none"), "target"
        ),
        ["s", "none"],
    )
    up = Window.partitionBy("s", "none").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    plan = per_range.withColumn("base", F.coalesce(F.sum("in_range").over(up), F.lit(0)))
    plan = plan.join(targets, ["s", "none"]).drop("in_range")
    plan = plan.withColumn(
        "whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    ).withColumn("rest", F.expr("target - whole * source_size"))
    within = (
        Window.partitionBy("s", "none", "range")
        .orderBy("key", "id", "text_md5")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    joined = rows.join(plan, ["s", "none", "range"])
    before = F.col("base") + F.coalesce(F.sum("size").over(within), F.lit(0))
    chosen = (before + F.col("size") / 2 <= F.col("rest")) & (F.col("size") > 0)
    times = (F.col("whole") + F.when(chosen, 1).otherwise(0)).cast("bigint")
    return joined.withColumn("times", times).select(
        "id",
        "size",
        "source",
        "source_size",
        "target",
        "times",
        (F.col("size") * F.col("times")).alias("taken"),
        "text_md5",
        *carry,
    )


def repeat_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix has it, with all their columns.

    Documents that the mix leaves out are gone, and so are texts without a word, which no target
    asks for. Rows are found again by their place in the files, so repeated rows count apart.
    """
    placed = located(docs)
    mixed = mix(placed, id_col=id_col, text_col=text_col, carry=("__file", "__row"), **options)
    times = mixed.where("times > 0 AND size > 0").select("__file", "__row", "times")
    joined = placed.join(times.withColumnRenamed("times", "__times"), ["__file", "__row"])
    copy = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__times"))).alias("__copy")
    return joined.select(*docs.columns, copy).drop("__copy")
