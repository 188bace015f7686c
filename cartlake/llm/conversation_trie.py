"""Prefix trie of conversations by vertical bitmaps.

Conversations are numbered by id; a shard has 2,048 consecutive ones, each a bit. A posting is the
bitset of the conversations that have a given turn at a given depth. A node's children come from
its own bitset: its lowest conversation names a turn, the posting of that turn cuts the child's
bitset out, and so on with what is left. Popcounts and end lists of the shards are then added up
by node, a node being known by the 128-bit sum of its turns' digests.

Long conversations are cut into segments of depths, each of which starts at the nodes where the
one before it ends, so a task holds at most a shard's turns of one segment.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartlake.llm.common import located, shuffle_partitions
from cartlake.llm.ranks import with_ranks
from cartlake.sources.scratch import materialize

SHARD = 2048
SEGMENT = 64

# Fixed values of the rebuilt conversations: those of a block start with turns of its first one.
BLOCK, HEADS = 100, 6

NODE = ["depth", "k1", "k2"]
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()

# Kinds of rows of a cell: a turn (the root is one), the node before a segment, the saving of a node, a
# leaf's mark, and what a conversation saves beyond the segment.
TURN, START, SAVING, LEAF, BEYOND = range(5)


def order_turns(
    turns: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``conv_id, digest, chars, rank, n``: turns in order, NULL first, with the number of turns of each conversation.

    NULL roles and texts are empty. Turns of the same number are ordered by the digest of role and
    text; repeated rows are several turns. Rows without a conversation are left out.
    """
    role, text = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (role_col, text_col))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = (
        located(turns)
        .where(F.col(f"`{id_col}`").isNotNull())
        .select(
            F.col(f"`{id_col}`").alias("conv_id"),
            F.col(f"`{turn_col}`").alias("turn"),
            F.sha2(whole, 256).alias("digest"),
            F.length(text).cast("bigint").alias("chars"),
            F.xxhash64("__file", "__row").alias("__copy"),
        )
    )
    rows, _ = materialize(rows, "turns")
    return with_ranks(rows, ["conv_id"], ["turn", "digest", "__copy"], "turn-ranks").drop("turn", "__copy")


def rebuild(ordered: DataFrame, block: int = BLOCK, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """``(turns, conversations)`` as ``conv_id, pos, digest, chars`` and ``conv_id, n``.

    The first ``crc32(conv_id) % heads`` turns of each conversation are replaced by as many, or as
    there are, of the first conversation of its ``block``; without that one they are dropped.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("bigint")
    first = F.col("conv_id") - F.col("conv_id") % block
    sizes, _ = materialize(ordered.where("rank = 0").select("conv_id", "n"), "conversation-sizes")
    bases = sizes.where(F.col("conv_id") % block == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = sizes.select("conv_id", "n", h.alias("h"), first.alias("base")).join(bases, "base", "left")
    convs = convs.withColumn("head", F.least("h", F.coalesce("n_base", F.lit(0))))
    own = (
        ordered.where(F.col("rank") >= h)
        .select("conv_id", "rank", "digest", "chars")
        .join(convs.select("conv_id", "h", "head"), "conv_id")
        .select("conv_id", F.expr("rank - h + head").alias("pos"), "digest", "chars")
    )
    starts = ordered.where((F.col("conv_id") % block == 0) & (F.col("rank") < heads - 1))
    starts = starts.select(F.col("conv_id").alias("base"), F.col("rank").alias("pos"), "digest", "chars")
    given = starts.join(convs.where("h > 0").select("conv_id", "base", "h"), "base").where("pos < h")
    length = F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    return own.unionByName(given.drop("base", "h")), convs.select("conv_id", length.alias("n"))


_CELL = ["shard", "segment"]
_ROW = [*_CELL, "kind", "bit", "conv_id", "depth", "k1", "k2", "value", "last"]


def _rows(df: DataFrame, kind: int, **columns) -> DataFrame:
    """Rows of a cell, with what a kind does not have as NULL."""
    types = {"conv_id": "bigint", "depth": "bigint", "k1": "bigint", "k2": "bigint", "value": "bigint", "last": "boolean"}
    have = {"kind": F.lit(kind), **columns}
    return df.select(
        *(
            have[c].alias(c) if c in have else F.col(c) if c in df.columns else F.lit(None).cast(types[c]).alias(c)
            for c in _ROW
        )
    )


def cells(turns: DataFrame, convs: DataFrame, shard: int = SHARD, segment: int = SEGMENT) -> tuple[DataFrame, DataFrame]:
    """``(rows, places)``: the turns by shard and segment, and ``conv_id, n, shard, bit`` of each conversation."""
    ranked = with_ranks(convs.select("conv_id"), [], ["conv_id"], "conversations").drop("n")
    places = ranked.join(convs, "conv_id").select(
        "conv_id", "n", F.expr(f"rank div {shard}").alias("shard"), F.expr(f"cast(rank % {shard} AS int)").alias("bit")
    )
    places, _ = materialize(places, "conversation-places")
    depth = F.col("pos") + 1
    # Two halves of a digest of depth and turn.
    keyed = turns.join(places, "conv_id").select(
        *places.columns,
        depth.alias("depth"),
        F.xxhash64(depth, "digest").alias("k1"),
        F.xxhash64(F.concat("digest", depth.cast("string")), F.lit(1)).alias("k2"),
        F.col("chars").alias("value"),
    )
    zero = F.lit(0).cast("bigint")
    root = places.select("*", *(zero.alias(c) for c in ("depth", "k1", "k2", "value")))
    at = F.expr(f"depth div {segment}").alias("segment")
    every = _rows(
        keyed.unionByName(root).select("*", at, (F.col("depth") == F.col("n")).alias("last")).drop("n"), TURN
    )
    every, _ = materialize(every, "trie-turns")
    # Segments after the first start at the sum of all turns before.
    long = every.join(places.where(F.col("n") >= segment).select("conv_id"), "conv_id", "left_semi")
    sums = long.groupBy("shard", "bit", "conv_id", "segment").agg(F.bit_xor("k1").alias("k1"), F.bit_xor("k2").alias("k2"))
    up = Window.partitionBy("shard", "bit", "conv_id").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(
        "shard", "bit", "conv_id", "segment", F.bit_xor("k1").over(up).alias("k1"), F.bit_xor("k2").over(up).alias("k2")
    ).where("segment > 0")
    starts = _rows(before.withColumn("depth", F.col("segment") * segment - 1), START)
    rows, _ = materialize(every.unionByName(starts), "trie-cells")
    return rows, places


class _Cell:
    """Bitsets of one cell, and a walk over its nodes."""

    def __init__(self, table: pa.Table):
        column = {c: table.column(c).to_pylist() for c in ("kind", "bit", "conv_id", "depth", "k1", "k2", "value", "last")}
        self.ids: dict[int, int] = {}
        self.turns: dict[int, dict[int, tuple[int, int]]] = defaultdict(dict)
        self.values: dict[tuple[int, int], int] = {}
        self.postings: dict[tuple[int, int, int], int] = defaultdict(int)
        self.ends: dict[int, int] = defaultdict(int)
        self.present: dict[int, int] = defaultdict(int)
        self.savings: dict[tuple[int, int], int] = {}
        self.beyond: dict[int, int] = {}
        self.leaves = 0
        # The nodes that the cell starts from, by depth and key.
        self.starts: dict[tuple[int, int, int], int] = defaultdict(int)
        self.shown: int = 0
        for kind, bit, conv, depth, k1, k2, value, last in zip(*column.values(), strict=True):
            if kind == SAVING:
                self.savings[bit, depth] = value
            elif kind == LEAF:
                self.leaves |= 1 << bit
            elif kind == BEYOND:
                self.beyond[bit] = value
            else:
                self.ids[bit] = conv
                if kind == START or depth == 0:
                    self.starts[depth, k1, k2] |= 1 << bit
                    # The node before a segment belongs to the cells of the segment before.
                    self.shown = depth + (kind == START)
                else:
                    self.turns[bit][depth] = (k1, k2)
                    self.postings[depth, k1, k2] |= 1 << bit
                    self.present[depth] |= 1 << bit
                if kind == TURN:
                    self.values[bit, depth] = value
                    if last:
                        self.ends[depth] |= 1 << bit

    def children(self, depth: int, bits: int) -> Iterator[tuple[tuple[int, int], int]]:
        rest = bits & self.present.get(depth + 1, 0)
        while rest:
            turn = self.turns[_lowest(rest)][depth + 1]
            child = rest & self.postings[(depth + 1, *turn)]
            rest ^= child
            yield turn, child

    def walk(self) -> Iterator[tuple[int, int, int, int, int, int]]:
        """``depth, k1, k2, parent's k1, parent's k2, bits`` of each node, parents before children."""
        stack = [(d, a, b, 0, 0, bits) for (d, a, b), bits in self.starts.items()]
        while stack:
            node = stack.pop()
            yield node
            depth, a, b, _, _, bits = node
            stack.extend((depth + 1, a ^ x, b ^ y, a, b, child) for (x, y), child in self.children(depth, bits))


def _lowest(bits: int) -> int:
    return (bits & -bits).bit_length() - 1


def _members(bits: int) -> Iterator[int]:
    while bits:
        yield _lowest(bits)
        bits &= bits - 1


_PARTIAL = "depth bigint, k1 bigint, k2 bigint, p1 bigint, p2 bigint, conv_id bigint, n bigint, chars bigint, shard bigint, ends string"
_TOTAL = "depth bigint, k1 bigint, k2 bigint, n_leaves bigint, saved bigint"


def _table(schema: str, rows: list[tuple]) -> pa.Table:
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    fields = [part.split() for part in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.table({n: pa.array(c, kinds[k]) for (n, k), c in zip(fields, columns, strict=True)})


def _count(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """The nodes of a cell with their members, and the conversations that end there."""
    cell, shard = _Cell(table), key[0].as_py()
    out = []
    for depth, k1, k2, p1, p2, bits in cell.walk():
        if depth < cell.shown:
            continue
        low = _lowest(bits)
        ended = bits & cell.ends.get(depth, 0)
        ends = ",".join(str(cell.ids[i]) for i in _members(ended)) if ended else None
        out.append((depth, k1, k2, p1, p2, cell.ids[low], bits.bit_count(), cell.values[low, depth], shard, ends))
    return _table(_PARTIAL, out)


def _sum_up(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """What lies below the nodes of a cell: leaves, and savings, each counted at its least conversation."""
    cell = _Cell(table)
    found = list(cell.walk())
    below: dict[tuple[int, int, int], int] = defaultdict(int)
    out = []
    # Children come after their parents in the walk.
    for depth, k1, k2, p1, p2, bits in reversed(found):
        saved = below.pop((depth, k1, k2), 0) + cell.savings.get((_lowest(bits), depth), 0)
        if cell.beyond:
            here = bits & ~cell.present.get(depth + 1, 0)
            saved += sum(cell.beyond.get(i, 0) for i in _members(here))
        if depth > 0:
            below[depth - 1, p1, p2] += saved
        if depth >= cell.shown:
            out.append((depth, k1, k2, (bits & cell.leaves).bit_count(), saved))
    return _table(_TOTAL, out)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the end lists of each node, whose pieces come one after the other."""
    at, digest = None, hashlib.sha256()
    names = ("depth", "k1", "k2", "ends_sha256")
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    for part in batches:
        done = []
        for *node, ends in zip(*(part.column(c).to_pylist() for c in (*NODE, "ends")), strict=True):
            if node != at:
                if at is not None:
                    done.append((*at, digest.hexdigest()))
                at, digest = node, hashlib.sha256(ends.encode())
            else:
                digest.update(b"," + ends.encode())
        yield batch(done)
    if at is not None:
        yield batch([(*at, digest.hexdigest())])


def trie(turns: DataFrame, convs: DataFrame, shard: int = SHARD, segment: int = SEGMENT) -> tuple[DataFrame, DataFrame]:
    """``(nodes, ends)`` of the prefix trie of ``turns``, as ``rebuild`` gives them.

    ``nodes`` has one row per different sequence of first turns, the empty one included: ``depth, k1,
    k2, conv_id, parent_conv_id, n_convs, n_children, n_leaves, saved_chars, ends_sha256``. ``conv_id`` is the
    smallest member, so its first ``depth`` turns are the node's. ``ends`` has the end lists as ``depth, k1, k2,
    shard, ends``, ascending by shard and within. Conversations without turns end at the root; without any
    conversation there is no node.
    """
    if shard < 1 or segment < 1:
        raise ValueError("a shard needs a conversation, a segment a turn")
    rows, places = cells(turns, convs, shard, segment)
    partial, _ = materialize(rows.groupBy(*_CELL).applyInArrow(_count, _PARTIAL), "trie-partials")
    nodes = partial.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.sum("n").alias("n_convs"),
        # The same in all shards, but for nodes that a cell starts with.
        F.max_by("p1", "shard").alias("p1"),
        F.max_by("p2", "shard").alias("p2"),
        F.max("chars").alias("chars"),
    )
    nodes, _ = materialize(nodes, "trie-nodes")
    children = (
        nodes.where("depth > 0")
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    nodes = nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes, _ = materialize(nodes, "trie-children")
    marked = rows.unionByName(_marks(nodes, places, segment))
    below = marked.groupBy(*_CELL).applyInArrow(_sum_up, _TOTAL).groupBy(*NODE).agg(
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved_chars")
    )
    ends = partial.where("ends IS NOT NULL").select(*NODE, "shard", "ends")
    listed = ends.repartition(shuffle_partitions(ends), *NODE).sortWithinPartitions(*NODE, "shard")
    digests = listed.mapInArrow(_digests, "depth bigint, k1 bigint, k2 bigint, ends_sha256 string")
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"),
        F.col("k1").alias("p1"),
        F.col("k2").alias("p2"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    whole = nodes.join(below, NODE).join(digests, NODE, "left").join(parents, ["depth", "p1", "p2"], "left")
    return (
        whole.select(
            *NODE,
            "conv_id",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_chars",
            F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
        ),
        ends,
    )


def _marks(nodes: DataFrame, places: DataFrame, segment: int) -> DataFrame:
    """Rows of cells that tell, at a node's least conversation, what the node saves and whether it is a leaf."""
    at = F.expr(f"depth div {segment}")
    saving = nodes.where("n_convs > 1 AND chars > 0").select("conv_id", "depth", F.expr("(n_convs - 1) * chars AS value"))
    saving = saving.join(places, "conv_id").withColumn("segment", at)
    leaves = nodes.where("n_children = 0").select("conv_id").join(places, "conv_id")
    segments = F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"n div {segment}"))).alias("segment")
    sums = saving.groupBy("shard", "bit", "segment").agg(F.sum("value").alias("value"))
    on = ["shard", "bit", "segment"]
    down = Window.partitionBy("shard", "bit").orderBy("segment").rowsBetween(1, Window.unboundedFollowing)
    beyond = places.where(F.col("n") >= segment).select("shard", "bit", segments).join(sums, on, "left")
    beyond = beyond.select(*on, F.sum("value").over(down).alias("value")).where("value > 0")
    return (
        _rows(saving.drop("n"), SAVING)
        .unionByName(_rows(leaves.select("*", segments).drop("n"), LEAF))
        .unionByName(_rows(beyond, BEYOND))
    )
