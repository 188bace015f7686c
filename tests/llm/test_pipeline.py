from collections import Counter

import duckdb
import numpy as np
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F
from test_bpe import PATH
from test_mixing import by_hand as mix_by_hand
from test_wide_simhash import classes
from tokenizers import Tokenizer

import corpus_pipeline
from cartlake.llm import quality
from cartlake.llm.queries import ORACLES, QUERIES


def test_stages_against_brute_force(spark):
    """Each stage on the rows that the stage before it left."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept, _ = corpus_pipeline.materialize(stage(spark, frames[-1], SF_DIR), "test")
        frames.append(kept)
        assert kept.columns == columns or name == "bpe"
    start, good, unlike, distinct, mixed, coded = ([tuple(r) for r in f.collect()] for f in frames)

    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = quality.fit_quality(docs, labels)
    features = quality.Features(model.bits)
    for row in start:
        slots, values = features(row[1] or "")
        score = np.array([float(np.dot(model.weights[slots].astype(float), values))])
        tail = model.tails(score)[0, -1] if len(slots) else 0.0
        assert (row in good) == (tail >= quality.MIN_TAIL)
    rated = frames[1].join(labels, "doc_id")
    # Only some 90 documents have labels here.
    assert rated.where("quality = 0 OR toxic = 1").count() < 0.2 * rated.count()
    clean = docs.join(labels.where("quality = 1 AND toxic = 0"), "doc_id")
    assert rated.where("quality = 1 AND toxic = 0").count() >= 0.9 * clean.count()

    last = {}
    for row in good:
        last[row[1] or ""] = max(last.get(row[1] or "", -1), row[0])
    assert Counter(unlike) == Counter(r for r in good if last[r[1] or ""] == r[0])

    unlike.sort()
    found = classes([r[1] for r in unlike])
    assert sorted(distinct) == [r for i, r in enumerate(unlike) if found[i] == i]

    taken, _ = mix_by_hand([(r[0], r[1], r[3]) for r in distinct])
    times = {i: t // s for i, s, _, t in taken if t}
    assert Counter(r[0] for r in mixed) == times

    tokenizer = Tokenizer.from_file(PATH)
    want = Counter()
    for r in mixed:
        ids = tokenizer.encode(r[1] or "", add_special_tokens=False).ids
        want[r[0], len(ids), np.array(ids, "<u4").tobytes(), r[1] or ""] += 1
    assert Counter((i, n, bytes(ids), t) for i, n, ids, t in coded) == want
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name", ORACLES)
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations", "pages", "labels", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    found = QUERIES[name](spark, SF_DIR)
    assert sorted(names) == sorted(found.columns)
    assert Counter(map(tuple, found.select(names).collect())) == Counter(cursor.fetchall())


def test_thirteen_operators_and_the_contract_of_their_columns(spark):
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    sharded = QUERIES["op4_sharding"](spark, SF_DIR)
    assert sharded.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    sizes = [r.n for r in sharded.groupBy("shard").agg(F.count("*").alias("n")).collect()]
    assert max(sizes) - min(sizes) <= 1
