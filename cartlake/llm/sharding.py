"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

The ring is cut into a fixed number of cells. A row hashes to a cell and belongs to the next
virtual node clockwise. A shard that is full takes no more, and what is left of a cell goes on
clockwise to the next shard with room. Only row counts per cell meet the driver, so what is
decided there has the size of the ring, not of the table.
"""

from __future__ import annotations

import bisect

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from cartlake.llm.common import shuffle_partitions, text_of
from cartlake.sources.scratch import materialize

# Bounds what the driver sees: one count per cell.
CELLS = 1 << 15
VIRTUAL_NODES = 128
COPIES_PER_TASK = 100_000


def ring(shards: int, virtual_nodes: int = VIRTUAL_NODES, cells: int = CELLS) -> list[tuple[int, int]]:
    """``(cell, shard)`` of each virtual node, clockwise. A node's place depends on its shard
    and number alone, so one more shard leaves the others where they are."""
    nodes = []
    for shard in range(shards):
        for number in range(virtual_nodes):
            h = xxhash.xxh64_intdigest(f"{shard}/{number}")
            nodes.append((h % cells, h, shard))
    return [(cell, shard) for cell, _, shard in sorted(nodes)]


def capacities(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """Rows that each shard may hold. Without slack they add up to ``rows`` exactly and differ
    by one at most; with slack each is the mean times ``1 + slack``, rounded up."""
    if slack > 0:
        return [-int(-rows * (1 + slack) // shards)] * shards
    return [rows // shards + (shard < rows % shards) for shard in range(shards)]


def place_cells(counts: dict[int, int], nodes: list[tuple[int, int]], room: list[int]) -> list[tuple]:
    """Pieces ``(cell, first, last, shard, slot)``: the rows ``first <= rank < last`` of a cell
    go to ``shard``, to slots from ``slot`` on.

    In turn ``t`` what is left of each cell asks the ``t``-th different shard clockwise. Cells
    nearer to the asked virtual node go first, so a row moves on only if its shard was filled
    by rows that hash closer to it.
    """
    starts = [cell for cell, _ in nodes]
    n = len(nodes)
    shards = len(room)
    left, used = list(room), [0] * shards
    waiting = []
    for cell, count in counts.items():
        at = bisect.bisect_left(starts, cell) % n
        waiting.append((cell, 0, count, at, frozenset([nodes[at][1]])))
    cells = max([CELLS, *(c + 1 for c in starts), *(c + 1 for c in counts)])
    pieces = []
    while waiting:
        waiting.sort(key=lambda w: ((nodes[w[3]][0] - w[0]) % cells, w[0]))
        rest = []
        for cell, first, last, at, asked in waiting:
            shard = nodes[at][1]
            taken = min(left[shard], last - first)
            if taken:
                pieces.append((cell, first, first + taken, shard, used[shard]))
                left[shard] -= taken
                used[shard] += taken
            if first + taken < last:
                rest.append((cell, first + taken, last, at, asked))
        # On to the next virtual node of a shard that was not asked yet.
        waiting = []
        for cell, first, last, at, asked in rest:
            while nodes[at][1] in asked:
                at = (at + 1) % n
            waiting.append((cell, first, last, at, asked | {nodes[at][1]}))
    return pieces


_PIECE = T.StructType(
    [T.StructField(c, T.LongType(), False) for c in ("cell", "first", "last")]
    + [T.StructField("shard", T.IntegerType(), False), T.StructField("slot0", T.LongType(), False)]
)


def assign_shards(
    docs: DataFrame,
    shards: int,
    slack: float = 0.0,
    virtual_nodes: int = VIRTUAL_NODES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id, size, text_crc32, shard, slot``, one row per row of ``docs``.

    The key of a row is its id, the CRC-32 of its text and its size; NULL ids are a key like any
    other and NULL texts are empty. Equal rows are told apart by a running number, so they
    spread over the ring and none is lost. ``size`` is the text's bytes plus 8. Slots of a shard
    are gapless from 0. Shard loads are those of ``capacities``. An empty table gives no rows.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    size = (F.octet_length(text_of(text_col)) + F.lit(8)).cast("bigint")
    rows = docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"),
        size.alias("size"),
        F.crc32(F.encode(text_of(text_col), "UTF-8")).alias("text_crc32"),
    )
    key = ("id", "size", "text_crc32")
    # Equal rows are counted before they move and written out again in portions.
    counted = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    portions = F.sequence(F.lit(0).cast("bigint"), F.expr(f"(n - 1) div {COPIES_PER_TASK}"))
    apart = counted.withColumn("portion", F.explode(portions)).repartition(
        shuffle_partitions(docs), *key, "portion"
    )
    first = F.col("portion") * COPIES_PER_TASK
    last = F.least(first + F.lit(COPIES_PER_TASK), F.col("n")) - 1
    one_by_one = apart.withColumn("copy", F.explode(F.sequence(first, last)))
    h = F.xxhash64(*key, "copy")
    keyed, _ = materialize(
        one_by_one.select(*key, "copy", h.alias("h"), F.pmod(h, F.lit(CELLS)).alias("cell")), "ring-keys"
    )
    counts = {r.cell: r.n for r in keyed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    room = capacities(sum(counts.values()), shards, slack)
    pieces = place_cells(counts, ring(shards, virtual_nodes), room)
    # At most one piece more per shard than there are cells, whatever the size of the table.
    plan = docs.sparkSession.createDataFrame(pieces, _PIECE)
    rank = F.row_number().over(Window.partitionBy("cell").orderBy("h", *key, "copy")) - 1
    ranked = keyed.withColumn("rank", rank)
    placed = ranked.join(F.broadcast(plan), "cell").where("rank >= first AND rank < last")
    return placed.select(*key, "shard", (F.col("slot0") + F.col("rank") - F.col("first")).alias("slot"))
