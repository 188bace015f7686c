"""Merkle manifest of a dataset, its nodes labelled with the leaf ranks that they cover.

A node of level ``l`` has the interval ``[lo, hi)`` of leaf ranks in its tree, so an ancestor is
a node of a higher level whose interval holds ``lo``. All intervals of a level start at multiples of
``fanout ** l``: this containment join is an equality of buckets. The siblings of a node are what
its parent's interval has besides its own. There is one tree per group (source) and one over
the roots of the groups. Only built-in functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlake.llm.common import located
from cartlake.llm.ranks import with_ranks
from cartlake.sources.scratch import materialize

FANOUT = 16

# The columns of a document that its leaf covers, in this order.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Tree(NamedTuple):
    """The trees of all groups: ``families[l]`` has ``g, bucket, lo, hi, n, kids, digest``, one row per node
    of level ``l + 1``, ``kids`` being its children as ``(lo, hi, digest, ...)``. A group of one
    leaf has no family; its leaf is in ``alone``. ``roots`` has ``g, digest, n``."""

    families: list[DataFrame]
    alone: DataFrame
    roots: DataFrame


class Manifest(NamedTuple):
    # Trees over the leaves of each group, and the tree over their roots.
    groups: Tree
    top: Tree


def _field(name: str, value: Column | None = None) -> Column:
    text = (F.col(f"`{name}`") if value is None else value).cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(columns: Sequence[str] = LEAF_COLUMNS, **changed: Column) -> Column:
    """SHA-256 of the columns, each as ``-`` if NULL, else its length in bytes, a colon and its value.

    ``changed`` gives columns another value."""
    return F.sha2(F.concat(*(_field(c, changed.get(c)) for c in columns)), 256)


def lower_ascii(col: Column) -> Column:
    return F.translate(col, _UPPER, _LOWER)


def group_key(name: str) -> Column:
    """The group as a text that is not NULL; NULL comes first, the rest by UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{name}`").cast("string")), F.lit("-"))


def _trees(leaves: DataFrame, fanout: int, carry: Sequence[str] = ()) -> Tree:
    """Trees over ``g, rank, n, digest``; ``carry`` are columns that stay with the leaves."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    alone = leaves.where("n = 1").select("g", "digest", *carry)
    roots = [alone.select("g", "digest", F.lit(1).cast("bigint").alias("n"))]
    nodes = leaves.select("g", "n", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "digest", *carry)
    families: list[DataFrame] = []
    width = 1
    while width < most:
        # Groups that have more than one node on this level.
        kids = F.sort_array(F.collect_list(F.struct("lo", "hi", "digest", *(carry if width == 1 else ()))))
        bucket = F.expr(f"lo div {width * fanout}").alias("bucket")
        made = (
            nodes.where(F.col("n") > width)
            .groupBy("g", bucket)
            .agg(kids.alias("kids"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.first("n").alias("n"))
            .withColumn("digest", F.sha2(F.array_join("kids.digest", ""), 256))
        )
        family, _ = materialize(made, "merkle-level")
        families.append(family)
        nodes = family.select("g", "n", "lo", "hi", "digest")
        roots.append(family.where("hi - lo = n").select("g", "digest", "n"))
        width *= fanout
    return Tree(families, alone, reduce(DataFrame.unionByName, roots))


def build(
    docs: DataFrame,
    group_col: str = "source",
    id_col: str = "doc_id",
    columns: Sequence[str] = LEAF_COLUMNS,
    fanout: int = FANOUT,
    carry: dict[str, Column] | None = None,
) -> Manifest:
    """The manifest of ``docs``: leaves of a group ascend by id, groups by key, NULLs first.

    Rows of one id, or without one, are ordered by their leaf's digest; equal rows are several
    equal leaves. ``carry`` are further columns to keep with each leaf. NULLs and empty texts have leaves
    of their own kind. An empty table has no node.
    """
    if fanout < 2:
        raise ValueError("a run needs two nodes at least")
    extra = carry or {}
    rows = located(docs).select(
        group_key(group_col).alias("g"),
        F.col(f"`{id_col}`").alias("id"),
        leaf_digest(columns).alias("digest"),
        *(c.alias(n) for n, c in extra.items()),
        F.xxhash64("__file", "__row").alias("__copy"),
    )
    # Texts are read once; sampling for the ranges then reads narrow rows.
    rows, _ = materialize(rows, "merkle-leaves")
    ranked = with_ranks(rows, ["g"], ["id", "digest", "__copy"], "merkle-ranks")
    groups = _trees(ranked, fanout, ("id", *extra))
    subroots, _ = materialize(groups.roots.select("g", "digest"), "merkle-subroots")
    top = with_ranks(subroots.select(F.lit("").alias("g"), F.col("g").alias("group"), "digest"), ["g"], ["group"])
    return Manifest(groups, _trees(top, fanout, ("group",)))


def _paths(tree: Tree, above: DataFrame, carry: Sequence[str], fanout: int) -> DataFrame:
    """``g, digest, path`` and ``carry`` of the leaves; ``above`` has the ``path`` of each root as ``g, path``.

    A path has one frame per level, from the leaf up: the digests of siblings to the left and to the right.
    """
    found = tree.alone.join(above, "g").select("g", "digest", "path", *carry)
    below: DataFrame | None = None
    for level in reversed(range(len(tree.families))):
        family = tree.families[level].select("g", "bucket", "lo", "hi", "n", "kids")
        ends = family.where("hi - lo = n").join(above, "g")
        if below is not None:
            ends = ends.unionByName(family.where("hi - lo < n").join(below, ["g", "bucket"]))
        each = ends.select("g", "kids", "path", F.explode("kids").alias("kid"))
        left = F.filter("kids", lambda k: k["hi"] <= F.col("kid.lo"))["digest"]
        right = F.filter("kids", lambda k: k["lo"] >= F.col("kid.hi"))["digest"]
        frame = F.struct(F.array_join(left, "").alias("left"), F.array_join(right, "").alias("right"))
        path = F.concat(F.array(frame), F.col("path")).alias("path")
        if level == 0:
            return found.unionByName(each.select("g", "kid.digest", path, *(f"kid.{c}" for c in carry)))
        step = each.select("g", F.expr(f"kid.lo div {fanout**level}").alias("bucket"), path)
        below, _ = materialize(step, "merkle-paths")
    return found


def proofs(manifest: Manifest, carry: Sequence[str] = (), fanout: int = FANOUT) -> DataFrame:
    """``id, g, leaf, subroot, root, path`` and ``carry`` for each leaf.

    ``path`` are the digests beside the way from the leaf through its group's root to the root. It is
    put together from the top: a node hands its path to its children, so what is joined to the
    leaves has one row per run of them.
    """
    none = F.expr("cast(array() AS array<struct<left:string,right:string>>)")
    roots = manifest.top.roots.select("g", F.col("digest").alias("root"))
    top = _paths(manifest.top, roots.select("g", none.alias("path")), ("group",), fanout)
    # One root: its single row is joined by its key.
    top = top.join(roots, "g").select(F.col("group").alias("g"), F.col("digest").alias("subroot"), "root", "path")
    top, _ = materialize(top, "merkle-top")
    leaves = _paths(manifest.groups, top.select("g", "path"), ("id", *carry), fanout)
    return leaves.join(top.drop("path"), "g").withColumnRenamed("digest", "leaf")


def nodes(manifest: Manifest) -> DataFrame:
    """``g, level, lo, hi, digest`` of all nodes above the leaves; ``g`` is empty in the tree of the groups."""
    every = [
        family.select("g", F.lit(level).alias("level"), "lo", "hi", "digest")
        for tree in manifest
        for level, family in enumerate(tree.families, 1)
    ]
    if not every:
        return manifest.top.roots.where("false").select(
            "g", F.lit(0).alias("level"), *(F.lit(0).cast("bigint").alias(c) for c in ("lo", "hi")), "digest"
        )
    return reduce(DataFrame.unionByName, every)


def fold(leaf: Column, path: str = "path") -> Column:
    """The root that a leaf and the digests beside its way give."""
    return F.aggregate(path, leaf, lambda at, f: F.sha2(F.concat(f["left"], at, f["right"]), 256))


def proof_digest(path: str = "path") -> Column:
    """SHA-256 of the digests of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda f: F.concat(f["left"], f["right"])), ""), 256)
