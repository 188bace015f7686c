"""Near-duplicate vectors by graphs per shard.

The vectors of a label are dealt into shards, and each shard gets a navigable small-world graph.
Every block of vectors queries every shard of its label. A sample of each block's queries is
also answered by comparing with the whole shard; until the graph finds enough of what that
finds, the beam is widened and the block asks again. What the graph finds is verified in
double precision, and linked vectors are united to components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlake.llm.common import shuffle_partitions
from cartlake.llm.components import components
from cartlake.llm.hnsw import Graph
from cartlake.llm.simhash import _Forest
from cartlake.sources.scratch import materialize

MIN_COSINE = 0.93
SHARD_ROWS = 4096
BEAM = 32
# Queries with partners, per block and shard, that are answered exactly as well; the portions of about
# as many queries that are looked through for them; and what the graph must find, on average by query.
AUDIT_QUERIES = 64
AUDIT_PORTIONS = 8
MIN_RECALL = 0.98
# The graph compares in single precision; what is this close below the limit is verified too.
_SLACK = 1e-5


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision. Large and tiny components keep their ratio."""
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def audited(shard: np.ndarray, block: np.ndarray, own: np.ndarray, least: float) -> list[tuple[int, np.ndarray]]:
    """Rows of ``block`` that have partners in ``shard``, with these, found by comparing with all of it.

    ``own`` is the place of each row in the shard, -1 without one; nobody is a partner of
    its own. Rows are taken at even distances, until enough with partners were seen.
    """
    step = max(1, len(block) // AUDIT_QUERIES)
    seen: list[tuple[int, np.ndarray]] = []
    for first in range(min(step, AUDIT_PORTIONS)):
        rows = np.arange(first, len(block), step)
        near = block[rows] @ shard.T >= least
        inside = np.flatnonzero(own[rows] >= 0)
        near[inside, own[rows[inside]]] = False
        seen += [(int(i), np.flatnonzero(hit)) for i, hit in zip(rows, near) if hit.any()]
        if len(seen) >= AUDIT_QUERIES:
            break
    return seen


def neighbours(
    graph: Graph, shard: np.ndarray, block: np.ndarray, least: float, own: np.ndarray | None = None
) -> list[np.ndarray]:
    """For each row of ``block`` the rows of ``shard`` with a cosine of ``least`` or more, as the
    graph finds them. ``shard`` and ``block`` hold unit vectors in double precision, ``own`` the
    place of each row of ``block`` in ``shard``, -1 without one."""
    n = len(shard)
    queries = block.astype(np.float32)
    truth = audited(shard, block, np.full(len(block), -1) if own is None else own, least)
    width = BEAM

    def verified(i: int) -> np.ndarray:
        found = np.array(graph.within(queries[i], least - _SLACK, width), np.int64)
        return found[shard[found] @ block[i] >= least] if len(found) else found

    while width < n:
        # By query, so that many links of a few rows do not hide what others lose.
        recall = [len(np.intersect1d(verified(i), partners)) / len(partners) for i, partners in truth]
        if not recall or np.mean(recall) >= MIN_RECALL:
            return [verified(i) for i in range(len(block))]
        width *= 2
    # A beam as wide as the shard compares with all of it.
    return [np.flatnonzero(shard @ q >= least) for q in block]


def _build(key, pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("node")
    vectors = np.stack([np.asarray(x, np.float64) for x in pdf["vector"]])
    graph = Graph.build(unit(vectors))
    return pd.DataFrame(
        {
            "label": [key[0]],
            "dim": [key[1]],
            "shard": [key[2]],
            "shards": [key[3]],
            "nodes": [pdf["node"].to_numpy(np.int64).tobytes()],
            "copies": [pdf["copies"].to_numpy(np.int64).tobytes()],
            "vectors": [vectors.tobytes()],
            "graph": [graph.blob()],
        }
    )


def _ask(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}
                dim = row["dim"]
                shard = unit(np.frombuffer(row["vectors"]).reshape(-1, dim))
                block = unit(np.frombuffer(row["q_vectors"]).reshape(-1, dim))
                nodes, copies = np.frombuffer(row["nodes"], np.int64), np.frombuffer(row["copies"], np.int64)
                asked = np.frombuffer(row["q_nodes"], np.int64)
                # The nodes of a shard ascend.
                place = np.minimum(np.searchsorted(nodes, asked), len(nodes) - 1)
                own = np.where(nodes[place] == asked, place, -1)
                found = neighbours(Graph.load(shard, row["graph"]), shard, block, least, own)
                found = [f[nodes[f] != q] for f, q in zip(found, asked)]
                counts = np.array([copies[f].sum() for f in found], np.int64)
                kind = [np.zeros(len(asked), np.int32)]
                a, b = [asked], [counts]
                # One link per union keeps the links fewer than the vectors.
                ids, at = np.unique(np.concatenate([nodes, asked]), return_inverse=True)
                forest = _Forest(len(ids))
                of_shard, of_block = at[: len(nodes)], at[len(nodes) :]
                for j, f in enumerate(found):
                    if len(f):
                        links = forest.add(np.full(len(f), of_block[j]), of_shard[f])
                        if links:
                            x, y = np.array(links).T
                            kind.append(np.ones(len(x), np.int32))
                            a.append(ids[x])
                            b.append(ids[y])
                out = [pa.array(np.concatenate(c)) for c in (kind, a, b)]
                yield pa.RecordBatch.from_arrays(out, ["kind", "a", "b"])

    return run


def near_vectors(
    table: DataFrame,
    min_cosine: float = MIN_COSINE,
    shard_rows: int = SHARD_ROWS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``id, n_links, component_id, kept``, one row per row of ``table``.

    Vectors of equal labels are linked where the cosine is ``min_cosine`` or more. Vectors without
    a label, NULL and zero vectors, and those with NULL or non-finite components link with
    nothing; vectors of different lengths do not link either. Equal vectors are joined once and
    count as many links as there are copies. NULL ids take part, but name a component only if
    it has no other id. Repeated rows stay. An empty table gives no rows.
    """
    v = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = v.isNotNull() & F.col(f"`{label_col}`").isNotNull() & finite & F.exists(v, lambda x: x != 0)
    rows = table.select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"),
        F.col(f"`{label_col}`").cast("string").alias("label"),
        v.alias("vector"),
        F.coalesce(sound, F.lit(False)).alias("sound"),
    )
    sound_rows = rows.where("sound")
    once = sound_rows.groupBy("label", "vector").agg(
        F.min("id").alias("least"), F.count(F.lit(1)).alias("copies")
    )
    # The number is fixed by writing it out.
    once = once.withColumn("node", F.monotonically_increasing_id()).withColumn("dim", F.size("vector"))
    once, _ = materialize(once, "vectors")
    sizes = once.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / shard_rows).cast("int").alias("shards"))
    dealt = once.join(sizes, ["label", "dim"]).withColumn("shard", F.expr("cast(pmod(xxhash64(node), shards) as int)"))
    blob = "label string, dim int, shard int, shards int, nodes binary, copies binary, vectors binary, graph binary"
    graphs, _ = materialize(
        dealt.select("label", "dim", "shard", "shards", "node", "copies", "vector")
        .groupBy("label", "dim", "shard", "shards")
        .applyInPandas(_build, blob),
        "graphs",
    )
    # Every block of queries against every shard of its label.
    blocks = graphs.select(
        "label",
        "dim",
        F.col("shard").alias("block"),
        F.col("nodes").alias("q_nodes"),
        F.col("vectors").alias("q_vectors"),
    )
    pairs = graphs.withColumn("block", F.explode(F.expr("sequence(0, shards - 1)"))).join(
        blocks, ["label", "dim", "block"]
    )
    # A row is a whole shard and a whole block, so the rows are dealt out one by one.
    pairs = pairs.repartition(shuffle_partitions(table), "label", "dim", "shard", "block")
    found, _ = materialize(pairs.mapInArrow(_ask(min_cosine), "kind int, a bigint, b bigint"), "vector-links")
    counts = found.where("kind = 0").groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("others"))
    classes = components(found.where("kind = 1").select("a", "b"))
    known = once.select("node", "label", "vector", "least", "copies")
    named = known.select("node", "least").join(classes, "node")
    names = named.groupBy("component").agg(F.min("least").alias("name"))
    named = named.join(names, "component").select("node", "name")
    judged = (
        known.join(counts, "node", "left")
        .join(named, "node", "left")
        .select(
            "label",
            "vector",
            (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("name", "least").alias("component_id"),
        )
    )
    judged, _ = materialize(judged, "judged-vectors")
    linked = sound_rows.join(judged, ["label", "vector"]).select("id", "n_links", "component_id")
    alone = rows.where("NOT sound").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.expr("id <=> component_id"))
