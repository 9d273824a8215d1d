"""Exact dedup as a stateful stream.

Rows come as a stream of (digest, identifier, locator). The state, kept on disk by RocksDB below the shared folder and never
expired, holds for each digest the row that stays (largest identifier, then locator) and how many rows have come. Partial
sums are made before rows move, so a text that a third of all rows share costs each task one row. Where a digest has been
hit, the full bytes are compared: rows are grouped by digest and whole text; texts that differ behind one digest part again.

Null texts count as empty, and empty texts are equal. Texts are equal when identical after lower-casing A-Z. Null identifiers
count as smallest; of rows with equal text and identifier the last by locator stays. An empty table gives no rows.

Each call has a state of its own, unless it names a ``folder``: calls with the same folder continue one state, and the folder keeps
the arrivals with their texts. A call must not be repeated with rows that have come already, as they would count twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import ascii_lower, keyed, located, original, shared_dir, small_side, stored

STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",  # a task's store gives its memory back when the task has ended
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # else each partition's store takes some MB of disk however few rows it holds
}


def row_order(key: str = "key") -> Column:
    return F.struct(F.col(key).alias("key"), "file", "row")


def run_stream(arrivals: DataFrame, files_per_batch: int | None = None, folder: str | None = None) -> DataFrame:
    """digest, keep (key, file, row) and n, from the state after all arrivals have come through."""
    spark = arrivals.sparkSession
    source, checkpoint = (f"{folder}/arrivals", f"{folder}/state") if folder else (shared_dir(spark, "dedup-arrivals"), shared_dir(spark, "dedup-state"))
    arrivals.write.mode("append" if folder else "error").parquet(source)
    before = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        reader = spark.readStream.schema(arrivals.schema)
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        state = reader.parquet(source).groupBy("digest").agg(F.max(row_order()).alias("keep"), F.count(F.lit(1)).alias("n"))
        query = state.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        if query.exception():
            raise query.exception()
        if not query.recentProgress and not query.lastProgress:
            return spark.createDataFrame([], "digest binary, keep struct<key: long, file: string, row: long>, n long")
        held = spark.read.format("statestore").load(checkpoint)
        keep, n = (F.col(f"value.`{f.name}`") for f in held.schema["value"].dataType.fields[-2:])
        return stored(held.select(F.col("key.digest").alias("digest"), keep.alias("keep"), n.alias("n")), "dedup-groups")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def groups(docs: DataFrame, text: str = "text", key: str = "doc_id", files_per_batch: int | None = None, folder: str | None = None) -> DataFrame:
    """One row per row of ``docs``: key, file, row, digest, keep (key, file, row of the row that stays) and n (rows of equal text).

    With a ``folder``, keep and n are over all rows that have come to it.
    """
    return grouped(keyed(located(docs), key, text), files_per_batch, folder)


def grouped(docs: DataFrame, files_per_batch: int | None = None, folder: str | None = None) -> DataFrame:
    rows = docs.select("key", "file", "row", ascii_lower(F.col("text")).alias("same"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("same", 256)))
    arrivals = stored(rows.select("key", "file", "row", "digest"), "dedup-rows")
    held = run_stream(arrivals, files_per_batch, folder)
    everything = rows
    if folder:
        rows.write.mode("append").parquet(f"{folder}/texts")
        everything = rows.sparkSession.read.schema(rows.schema).parquet(f"{folder}/texts")
    hit = small_side(held.filter("n > 1").select("digest"))
    exact = everything.join(hit, "digest", "left_semi").groupBy("digest", "same").agg(F.max(row_order()).alias("keep"), F.count(F.lit(1)).alias("n"))
    parted = stored(exact.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("digest"), "dedup-collisions")
    # A text that came once is its own keep; only hits are joined.
    kept_of = small_side(held.filter("n > 1").select("digest", F.col("keep").alias("held"), F.col("n").alias("times")))
    by_digest = arrivals.join(kept_of, "digest", "left").select("digest", "key", "file", "row", F.coalesce("held", row_order()).alias("keep"), F.coalesce("times", F.lit(1).cast("long")).alias("n"))
    if parted.isEmpty():
        return by_digest
    apart = rows.join(parted, "digest", "left_semi").join(exact, ["digest", "same"]).select(by_digest.columns)
    return by_digest.join(parted, "digest", "left_anti").unionByName(apart)


def kept() -> Column:
    return row_order().eqNullSafe(F.col("keep"))


def deduplicated(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay, with its own columns."""
    source = located(docs)
    gone = stored(grouped(keyed(source, key, text)).filter(~kept()).select("file", "row"), "dedup-gone")
    return original(source.join(small_side(gone), ["file", "row"], "left_anti"))
