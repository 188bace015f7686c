"""Connected components by alternating large-star and small-star steps.

Each step maps every link to the least neighbour of one of its ends, so the links turn into
stars around the least node of each component. Links stay in tables: a step is an
aggregation with map-side combine and a join, and its result is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlake.sources.scratch import materialize

def _seen() -> dict:
    return {"n": F.count(F.lit(1)), "sum": F.bit_xor(F.xxhash64("u", "v"))}


def _least(pairs: DataFrame) -> DataFrame:
    """Least neighbour of each ``u``, written out: a later join then shuffles both of its
    sides, and a node with very many links can be split."""
    return materialize(pairs.groupBy("u").agg(F.min("v").alias("m")), "least")[0]


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for each node of ``links`` (columns ``a`` and ``b``, bigint).

    The component is the least node that can be reached. Links to oneself and links with a
    NULL end say nothing and are left out; no links give an empty result.
    """
    clean = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    pairs, seen = materialize(clean.distinct(), "links", _seen())
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both)
        larger = both.where("v > u").join(least, "u")
        # The least node of all its neighbours is itself a candidate.
        large = larger.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        large, _ = materialize(large, "large-star")
        least = _least(large)
        moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        before = seen
        pairs, seen = materialize(small, "small-star", _seen())
        if seen == before:
            break
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
