"""SimHash near-duplicates by a self-join of binary tries.

Fingerprints are bit strings, and a sorted list of them is a binary trie: a node is the range of
those with a common prefix. The join starts at pairs of equal nodes, goes down both sides
together, adds up the bits in which the sides differ and drops a pair as soon as they are more
than the budget. To spread the work, the bits are cut into ``budget + 2`` blocks. Two
fingerprints within the budget agree in two blocks at least, so one trie per choice of two blocks,
which then lead the bit string, finds every pair below a node that both share from the start.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlake.llm.common import located, shuffle_partitions, text_of
from cartlake.llm.components import components
from cartlake.sources.scratch import materialize

BITS = 64
BUDGET = 4
SHINGLE = 4
SEED = 42
# Fingerprints below one leading node that a single task joins; larger nodes are split first.
NODE_ROWS = 32_768
# Bits that a split of a large node goes down at once.
STEP = 4
# Pairs of trie nodes that a task holds at once.
FRONTIER = 1 << 18
_HASHES = 1 << 16
_SIGN = np.uint64(1 << 63)


def fingerprint(text: str, words: int = SHINGLE) -> int:
    """The SimHash of a text: a bit is set if it is set in over half the shingles' XXH64.

    A-Z is lower-cased, words end at ASCII blanks, shingles are ``words`` words joined by blanks,
    repeats included. Fewer words are one shingle; without a word it is 0.
    """
    parts = text.encode("utf-8", "replace").lower().split()
    n = len(parts)
    if not n:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, n) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    m = max(1, n - words + 1)
    first, last = starts[:m].tolist(), ends[min(words, n) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(BITS, np.int64)
    for at in range(0, m, _HASHES):
        block = zip(first[at : at + _HASHES], last[at : at + _HASHES])
        h = np.array([digest(joined[a:b], SEED) for a, b in block], "<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * votes > m, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()
) -> DataFrame:
    """``id, fp`` of whole texts, and the columns of ``carry``; ``fp`` holds the 64 bits as bigint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py()) for t in batch.column(1)], np.uint64)
            columns = [batch.column(0), pa.array(found.view(np.int64)), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, ["id", "fp", *carry])

    rows = docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"), text_of(text_col).alias("text"), *carry
    )
    carried = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return rows.mapInArrow(run, f"id bigint, fp bigint{carried}")


def _blocks(budget: int) -> list[tuple[int, int]]:
    """``(shift, width)`` of ``budget + 2`` blocks that cover the bits."""
    edges = [round(i * BITS / (budget + 2)) for i in range(budget + 3)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _lead_bits(budget: int) -> int:
    return 2 * min(w for _, w in _blocks(budget))


def _permuted(fp: np.ndarray, lead: tuple[int, int], blocks: list[tuple[int, int]]) -> np.ndarray:
    """The bits with two blocks moved to the front."""
    order = [*lead, *(i for i in range(len(blocks)) if i not in lead)]
    out = np.zeros_like(fp)
    for i in order:
        shift, width = blocks[i]
        part = (fp >> np.uint64(shift)) & np.uint64((1 << width) - 1)
        out = (out << np.uint64(width)) | part
    return out


def restored(keys: np.ndarray, lead: tuple[int, int], blocks: list[tuple[int, int]]) -> np.ndarray:
    """Inverse of ``_permuted``."""
    order = [*lead, *(i for i in range(len(blocks)) if i not in lead)]
    out, rest = np.zeros_like(keys), keys.copy()
    for i in reversed(order):
        shift, width = blocks[i]
        out |= (rest & np.uint64((1 << width) - 1)) << np.uint64(shift)
        rest = rest >> np.uint64(width)
    return out


class _Forest:
    """Union of found pairs; gives back one link per union, so links are fewer than nodes."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
        links = []
        root = self.root
        apart = root[a] != root[b]
        while apart.any():
            a, b = a[apart], b[apart]
            # One union per pair of trees at a time; the others are looked at again.
            x, y = root[a], root[b]
            low, high = np.minimum(x, y), np.maximum(x, y)
            _, first = np.unique(high, return_index=True)
            links += list(zip(a[first].tolist(), b[first].tolist()))
            hook = np.arange(len(root))
            hook[high[first]] = low[first]
            while (hook[hook] != hook).any():
                hook = hook[hook]
            root[:] = hook[root]
            apart = root[a] != root[b]
        return links


def join_tries(keys: np.ndarray, pairs: np.ndarray, depth: int, budget: int) -> list[tuple[int, int]]:
    """Links among sorted different ``keys`` (uint64) that connect all pairs within ``budget``.

    ``pairs`` has rows ``a_low, a_high, b_low, b_high, differing`` of node pairs at ``depth``; a
    node paired with itself stands for all pairs below it. Pairs are worked off in portions of
    bounded size, deepest first.
    """
    n = len(keys)
    forest = _Forest(n)
    links: list[tuple[int, int]] = []
    ones: dict[int, np.ndarray] = {}
    stack = [(depth, pairs.astype(np.int64))]
    while stack:
        depth, front = stack.pop()
        if len(front) > FRONTIER:
            stack.append((depth, front[FRONTIER:]))
            front = front[:FRONTIER]
        al, ah, bl, bh, diff = front.T
        # Two single keys are compared at once.
        single = (ah - al == 1) & (bh - bl == 1) & (al != bl)
        if single.any():
            a, b = al[single], bl[single]
            near = np.bitwise_count(keys[a] ^ keys[b]) <= budget
            links += forest.add(a[near], b[near])
        # What is joined already, all of it, cannot give a new link.
        al, ah, bl, bh, diff = (c[~single] for c in (al, ah, bl, bh, diff))
        alone = (al == bl) & (ah - al < 2)
        al, ah, bl, bh, diff = (c[~alone] for c in (al, ah, bl, bh, diff))
        if not len(al):
            continue
        if depth not in ones:
            bit = (keys >> np.uint64(63 - depth)) & np.uint64(1)
            ones[depth] = np.r_[0, np.cumsum(bit.astype(np.int64))]
        count = ones[depth]
        am, bm = ah - (count[ah] - count[al]), bh - (count[bh] - count[bl])
        own = al == bl
        cross = ~own
        kids = [
            (al[own], am[own], al[own], am[own], diff[own]),
            (am[own], ah[own], am[own], ah[own], diff[own]),
            (al[own], am[own], am[own], ah[own], diff[own] + 1),
            (al[cross], am[cross], bl[cross], bm[cross], diff[cross]),
            (am[cross], ah[cross], bm[cross], bh[cross], diff[cross]),
            (al[cross], am[cross], bm[cross], bh[cross], diff[cross] + 1),
            (am[cross], ah[cross], bl[cross], bm[cross], diff[cross] + 1),
        ]
        down = np.concatenate([np.stack(k, axis=1) for k in kids])
        alive = (down[:, 0] < down[:, 1]) & (down[:, 2] < down[:, 3]) & (down[:, 4] <= budget)
        down = down[alive]
        if len(down):
            stack.append((depth + 1, down))
    return links


def _tasks(budget: int):
    """Arrow function over rows sorted by ``task, key``: links between fingerprints."""
    blocks = _blocks(budget)
    leads = list(combinations(range(len(blocks)), 2))

    def work(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        task, key, perm, side, depth, diff = columns
        key = key.view(np.uint64) ^ _SIGN
        edges = np.r_[0, np.flatnonzero(np.diff(task)) + 1, len(task)]
        found_a, found_b = [], []
        low, high = edges[:-1], edges[1:]
        where = np.r_[0, np.cumsum(side)]
        # Within a task the rows of side 0 come first.
        mid = high - (where[high] - where[low])
        for d in np.unique(depth[low]):
            here = depth[low] == d
            lo, hi, mi, df = low[here], high[here], mid[here], diff[low[here]]
            own = mi == hi
            start = np.stack([lo, mi, np.where(own, lo, mi), np.where(own, mi, hi), df], axis=1)
            big = own & (hi - lo > 1) | ~own
            links = join_tries(key, start[big], int(d), budget)
            if links:
                a, b = np.array(links).T
                found_a.append(a)
                found_b.append(b)
        if not found_a:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        a, b = np.concatenate(found_a), np.concatenate(found_b)
        fa, fb = np.zeros(len(a), np.uint64), np.zeros(len(a), np.uint64)
        for p in np.unique(perm[a]):
            at = perm[a] == p
            fa[at], fb[at] = restored(key[a[at]], leads[p], blocks), restored(key[b[at]], leads[p], blocks)
        return fa.view(np.int64), fb.view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if not len(columns[0]):
                continue
            # Up to the last task that is surely whole; a task's rows are bounded.
            cut = int(np.searchsorted(columns[0], columns[0][-1]))
            if cut:
                a, b = work([np.concatenate([*(h[i] for h in held), columns[i][:cut]]) for i in range(6)])
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
                held = []
            held.append([c[cut:] for c in columns])
        if held:
            a, b = work([np.concatenate([h[i] for h in held]) for i in range(6)])
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return run


def _prefix(bits: int):
    """The first ``bits`` bits of ``key``, whose order is that of unsigned numbers."""
    return F.shiftright("key", 64 - bits) if bits < 64 else F.col("key")


def similar_pairs(
    distinct: DataFrame, budget: int = BUDGET, node_rows: int = NODE_ROWS, step: int = STEP
) -> DataFrame:
    """``a, b``: links between different fingerprints (column ``fp``) at ``budget`` differing bits or
    fewer. Each such pair is connected by links, though not each pair is a row of its own."""
    blocks = _blocks(budget)
    leads = list(combinations(range(len(blocks)), 2))
    lead = _lead_bits(budget)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for p, chosen in enumerate(leads):
                key = (_permuted(fp, chosen, blocks) ^ _SIGN).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(fp), p, np.int32)), pa.array(key)], ["perm", "key"]
                )

    n = shuffle_partitions(distinct)
    keys = distinct.select("fp").mapInArrow(spread, "perm int, key bigint")
    keys = keys.withColumn("node", _prefix(lead))
    sizes = keys.groupBy("perm", "node").agg(F.count(F.lit(1)).alias("n"))
    heavy, seen = materialize(
        sizes, "heavy-nodes", {"heavy": F.count_if(F.col("n") > node_rows)}, keep=F.col("n") > node_rows
    )
    light = keys
    if seen["heavy"]:
        light = keys.join(heavy, ["perm", "node"], "left_anti")
    fixed = (F.lit(0).alias("side"), F.lit(lead).alias("depth"), F.lit(0).alias("diff"))
    rows = light.select(F.xxhash64("perm", "node").alias("task"), "key", "perm", *fixed)
    if seen["heavy"]:
        rows = rows.unionByName(_split(keys, heavy, lead, budget, node_rows, step))
    dealt = rows.repartition(n, "task").sortWithinPartitions("task", "side", "key")
    return dealt.mapInArrow(_tasks(budget), "a bigint, b bigint")


def _split(keys: DataFrame, heavy: DataFrame, lead: int, budget: int, node_rows: int, step: int) -> DataFrame:
    """Rows of tasks below the heavy nodes: pairs of nodes go down ``step`` bits at a time until both
    sides together are no more than ``node_rows``."""
    inside, _ = materialize(keys.join(heavy, ["perm", "node"], "left_semi").drop("node"), "heavy-keys")
    pairs = heavy.select("perm", F.col("node").alias("a"), F.col("node").alias("b"), F.lit(0).alias("diff"))
    depth, out = lead, None
    while True:
        below = min(depth + step, 64)
        children = inside.groupBy("perm", _prefix(depth).alias("up"), _prefix(below).alias("node")).agg(
            F.count(F.lit(1)).alias("n")
        )
        children, _ = materialize(children, "trie-nodes")
        left = children.select("perm", F.col("up").alias("a"), F.col("node").alias("a2"), F.col("n").alias("na"))
        right = children.select("perm", F.col("up").alias("b"), F.col("node").alias("b2"), F.col("n").alias("nb"))
        # Prefixes hold all bits from the top on, so this counts every differing bit so far.
        diff = F.bit_count(F.col("a2").bitwiseXOR(F.col("b2")))
        down = (
            pairs.join(left, ["perm", "a"])
            .join(right, ["perm", "b"])
            .where("a <> b OR a2 <= b2")
            .withColumn("diff", diff)
            .where(F.col("diff") <= budget)
            .select("perm", F.col("a2").alias("a"), F.col("b2").alias("b"), "diff", "na", "nb")
        )
        small = (F.col("na") + F.col("nb") <= node_rows) | F.lit(below == 64)
        down, seen = materialize(down.withColumn("small", small), "trie-pairs", {"rest": F.count_if(~F.col("small"))})
        tasks = down.where("small").select(
            F.xxhash64("perm", "a", "b", F.lit(below)).alias("task"), "perm", "a", "b", "diff"
        )
        at = inside.withColumn("node", _prefix(below))
        for side, end in ((0, "a"), (1, "b")):
            part = tasks if side == 0 else tasks.where("a <> b")
            mine = at.join(part.select("task", "perm", F.col(end).alias("node"), "diff"), ["perm", "node"])
            mine = mine.select(
                "task", "key", "perm", F.lit(side).alias("side"), F.lit(below).alias("depth"), "diff"
            )
            out = mine if out is None else out.unionByName(mine)
        if below == 64 or not seen["rest"]:
            return out
        pairs, depth = down.where(~F.col("small")).select("perm", "a", "b", "diff"), below


def near_duplicates(
    docs: DataFrame,
    budget: int = BUDGET,
    id_col: str = "doc_id",
    text_col: str = "text",
    node_rows: int = NODE_ROWS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``id, fp, class_fp, component_id``, one row per row of ``docs``.

    Texts whose fingerprints differ in ``budget`` bits or fewer are linked; the component is the
    smallest id that can be reached, the own one included. Copies share a fingerprint and are
    joined once. NULL texts and texts without a word have fingerprint 0, which links like any
    other. NULL ids take part, but name a component only if it has no other id.
    ``class_fp`` is one fingerprint of the component, the same for all its rows. Repeated rows
    stay. Other columns are not read, those of ``carry`` come along. An empty table gives no rows.
    """
    prints, _ = materialize(fingerprints(docs, id_col, text_col, carry), "fingerprints")
    distinct, _ = materialize(prints.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints")
    found = components(similar_pairs(distinct, budget, node_rows))
    linked = distinct.join(found.withColumnRenamed("node", "fp"), "fp")
    names = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    named = linked.join(names, "component").select("fp", F.col("component").alias("class_fp"), "component_id")
    whole = distinct.join(named, "fp", "left").select(
        "fp",
        F.coalesce("class_fp", "fp").alias("class_fp"),
        # A class without any id has no name.
        F.when(F.col("class_fp").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"),
    )
    whole, _ = materialize(whole, "classes")
    return prints.join(whole, "fp").select("id", "fp", "class_fp", "component_id", *carry)


def one_per_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stand for their class: of each class the one with the smallest id,
    NULL ids last, and of rows with the same id the first by file and place."""
    placed = located(docs)
    found = near_duplicates(placed, id_col=id_col, text_col=text_col, carry=("__file", "__row"), **options)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "__file", "__row"))
    stay = found.groupBy("class_fp").agg(first.alias("first")).select("first.__file", "first.__row")
    return placed.join(stay, ["__file", "__row"], "left_semi").select(*docs.columns)
