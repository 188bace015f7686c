import hashlib
from collections import Counter, defaultdict

from conftest import rows
from pyspark.sql import functions as F
from texts import EDGES, edges, empty

from cartlake.llm import exact_dedup
from cartlake.llm.exact_dedup import digest_state, drop_exact_duplicates, exact_duplicates, sha256


def by_hand(data):
    groups = defaultdict(list)
    for r in data:
        groups[r[1] or ""].append(r[0])
    out = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            out[(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest())] += 1
    return out, len(groups)


def judged(df):
    return df.select("id", "keep_id", "group_size", F.lower(F.hex("digest")).alias("h"))


def test_edges(spark):
    found = exact_duplicates(edges(spark))
    want, groups = by_hand(EDGES)
    assert Counter(tuple(r) for r in judged(found).collect()) == want
    assert found.where("kept").count() == groups
    assert found.where("kept AND NOT id <=> keep_id").count() == 0
    assert exact_duplicates(empty(spark)).count() == 0


def test_rows_that_stay(spark):
    kept = drop_exact_duplicates(edges(spark))
    assert kept.columns == edges(spark).columns
    assert sorted((t or "")[:20] for (t,) in rows(kept, "text")) == sorted({(r[1] or "")[:20] for r in EDGES})


def test_texts_that_share_a_digest(spark):
    data = [(i, t) for i, t in enumerate(["ab", "ab", "ax", "b", "ax", "az", "c", None, ""])]
    df = spark.createDataFrame(data, "doc_id bigint, text string")
    found = exact_duplicates(df, digest=lambda text: F.encode(F.substring(text, 1, 1), "UTF-8"))
    assert rows(found, "id", "keep_id", "group_size", "kept") == [
        (0, 1, 2, False),
        (1, 1, 2, True),
        (2, 4, 2, False),
        (3, 3, 1, True),
        (4, 4, 2, True),
        (5, 5, 1, True),
        (6, 6, 1, True),
        (7, 8, 2, False),
        (8, 8, 2, True),
    ]


def test_state_goes_on_over_batches_and_runs(spark, tmp_path):
    digests, state = str(tmp_path / "d"), str(tmp_path / "s")

    def add(ids, n):
        df = spark.range(n).select(
            sha256(F.col("id").cast("string")).alias("digest"),
            F.lit(ids).cast("bigint").alias("id"),
            F.lit("f").alias("file"),
            F.col("id").alias("row"),
        )
        df.coalesce(2).write.mode("append").parquet(digests)

    add(1, 10)
    assert {(r.keep.id, r.n) for r in digest_state(spark, digests, state, 1).collect()} == {(1, 1)}
    add(7, 4)
    later = digest_state(spark, digests, state, 1).collect()
    assert Counter((r.keep.id, r.n) for r in later) == {(7, 2): 4, (1, 1): 6}


def test_no_python_on_the_main_path(spark):
    plan = exact_duplicates(edges(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert exact_dedup.ROCKSDB.endswith("RocksDBStateStoreProvider")
