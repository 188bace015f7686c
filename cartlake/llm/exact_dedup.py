"""Exact deduplication by a stream with keyed state.

The stream reads digests, identifiers and places of texts and keeps, per digest and without
expiry, how often it came and which row stays. The state lives in RocksDB, on the disks of the
executors, with its checkpoints in the shared folder: memory does not bound the number of
digests, and a lost executor's state is loaded again. All operations are built-in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlake.llm.common import located, text_of
from cartlake.sources.scratch import materialize, scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Bytes of digests that one batch of the stream takes.
BATCH_BYTES = 64 << 30
STATE = "digest binary, keep struct<id: bigint, file: string, row: bigint>, n bigint"


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(F.encode(text, "UTF-8"), 256))


def digest_state(spark: SparkSession, digests: str, state_dir: str, max_bytes: int) -> DataFrame:
    """Run the stream over the files of ``digests`` and give its state: ``digest, keep, n``.

    With the ``state_dir`` of an earlier run only new files are read, and the state goes on.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    # Many small stores would otherwise reserve disk space that they never fill.
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    changes = f"{state_dir}/changes"
    own.createDataFrame([], STATE).write.mode("overwrite").parquet(f"{changes}/batch=-1")

    def save(batch: DataFrame, batch_id: int) -> None:
        # A batch that runs again replaces what it wrote before.
        batch.write.mode("overwrite").parquet(f"{changes}/batch={batch_id}")

    rows = own.readStream.schema(spark.read.parquet(digests).schema)
    rows = rows.option("maxBytesPerTrigger", max_bytes).parquet(digests)
    state = rows.groupBy("digest").agg(
        F.max(F.struct("id", "file", "row")).alias("keep"), F.count(F.lit(1)).alias("n")
    )
    query = (
        state.writeStream.outputMode("update")
        .foreachBatch(save)
        .option("checkpointLocation", f"{state_dir}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    # Both only grow from batch to batch, so the largest are the newest.
    seen = spark.read.schema(STATE).parquet(changes)
    return seen.groupBy("digest").agg(F.max("keep").alias("keep"), F.max("n").alias("n"))


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest=sha256,
    max_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: ``id, keep_id, group_size, kept, digest, file, row``.

    Of equal texts the row with the largest id stays. NULL texts are empty texts, and empty
    texts equal each other. NULL ids are below all others; among rows of the same id the last
    by file and place stays, so exactly one row of each group is kept, repeated rows included.
    An empty table gives no rows. Other columns are not read.

    Rows that share a digest are compared byte by byte. Should two texts share one, its rows
    are grouped by the texts themselves. ``digest`` can be replaced to test that.
    """
    spark = docs.sparkSession
    placed = docs if "__file" in docs.columns else located(docs)
    rows = placed.select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"),
        text_of(text_col).alias("text"),
        F.col("__file").alias("file"),
        F.col("__row").alias("row"),
    )
    rows = rows.withColumn("digest", digest(F.col("text")))
    spool = scratch_path(spark, "digests")
    rows.drop("text").write.parquet(spool)
    state, _ = materialize(
        digest_state(spark, spool, scratch_path(spark, "digest-state"), max_bytes), "digest-groups"
    )
    # Full bytes of every hit against those of the row that stays.
    hits, _ = materialize(rows.join(state.where("n > 1"), "digest"), "digest-hits")
    stays = F.expr("file = keep.file AND row = keep.row")
    keepers = hits.where(stays).select("digest", F.col("text").alias("kept_text"))
    differ = hits.join(keepers, "digest").where("text <> kept_text").select("digest")
    clash, found = materialize(differ.distinct(), "digest-clashes", {"n": F.count(F.lit(1))})
    narrow = spark.read.schema(rows.drop("text").schema).parquet(spool)
    decided = narrow.join(state, "digest")
    if found["n"]:
        texts = hits.drop("keep", "n").join(clash, "digest", "left_semi")
        groups = texts.groupBy("digest", "text").agg(
            F.max(F.struct("id", "file", "row")).alias("keep"), F.count(F.lit(1)).alias("n")
        )
        apart = texts.join(groups, ["digest", "text"]).select(*decided.columns)
        decided = decided.join(clash, "digest", "left_anti").unionByName(apart)
    return decided.select(
        "id",
        F.col("keep.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        stays.alias("kept"),
        "digest",
        "file",
        "row",
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    placed = located(docs)
    kept = exact_duplicates(placed, id_col, text_col).where("kept")
    places = kept.select(F.col("file").alias("__file"), F.col("row").alias("__row"))
    return placed.join(places, ["__file", "__row"], "left_semi").drop("__file", "__row")
