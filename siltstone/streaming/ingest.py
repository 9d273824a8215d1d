"""Resumable ingest: completed logs become checkpoints, appended rows carry their batch, failures their latest status."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siltstone.sources.shared import checkpointing

#: Statuses after which a page isn't fetched again.
TERMINAL = ("ok", "no_preloaded_state", "drug_not_found", "no_drug_info", "no_sku", "parse_error")


def pending(requests: DataFrame, log: DataFrame, key: str, status: str = "status") -> DataFrame:
    """Requests without a terminal entry in the log."""
    return requests.join(log.filter(F.col(status).isin(*TERMINAL)).select(key).distinct(), key, "left_anti")


def latest(log: DataFrame, key: str, at: str) -> DataFrame:
    """Each key's last entry."""
    rest = [c for c in log.columns if c != key]
    return log.groupBy(key).agg(F.max_by(F.struct(*rest), at).alias("e")).select(key, "e.*")


def retryable(log: DataFrame, key: str, at: str, statuses: tuple[str, ...] = ("fetch_error",)) -> DataFrame:
    """Keys whose last entry failed in a way that may pass."""
    return latest(log, key, at).filter(F.col("status").isin(*statuses)).select(key)


def by_report(report: DataFrame, statuses: list[str], link: str = "link", key: str = "normalized_url") -> DataFrame:
    """Links of a coverage report to fetch again, each key once, in the report's order (its ``ord``)."""
    rows = report.filter(F.col("coverage_status").isin(statuses))
    w = Window.partitionBy(key).orderBy("ord")
    return rows.withColumn("__n", F.row_number().over(w)).filter("__n = 1").select(key, link, "ord")


def append_batches(stream: DataFrame, work: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Runs ``work`` over a stream's new files and appends its rows; a batch that runs again replaces its own folder, so rows come once."""

    def write(batch: DataFrame, n: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{out}/batch={n}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def file_stream(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(path)


def labelled(df: DataFrame, label: str, path: str) -> None:
    """A run's rows under its label, beside other runs."""
    df.write.mode("overwrite").parquet(f"{path}/run_label={label}")


def crawl(links: DataFrame, start: list[str], most_pages: int | None = None, keep: Column | None = None) -> DataFrame:
    """url and hop of the pages that links (src, dst) reach, round by round until one adds nothing; visited pages are never visited again.

    Where ``most_pages`` is given, at most so many are visited: nearest first, those of one hop by url. Each round's frontier is
    written to the checkpoint folder, and now and then the visited pages as a whole, so that plans don't grow with rounds.
    """
    spark = checkpointing(links.sparkSession)
    edges = links.select("src", "dst").distinct() if keep is None else links.filter(keep).select("src", "dst").distinct()
    frontier = spark.createDataFrame([(u, 0) for u in sorted(set(start))[:most_pages]], "url string, hop int")
    visited, size, hop = frontier, frontier.count(), 0
    while True:
        hop += 1
        new = frontier.join(edges, frontier.url == edges.src).select(F.col("dst").alias("url")).distinct().join(visited.select("url"), "url", "left_anti")
        if most_pages is not None:
            new = new.orderBy("url").limit(most_pages - size)
        frontier = new.withColumn("hop", F.lit(hop)).checkpoint()
        added = frontier.count()
        if not added:
            return visited
        visited, size = visited.unionByName(frontier), size + added
        if hop % 16 == 0:
            visited = visited.checkpoint()


def until_stagnant(rounds: DataFrame, run: str, order: str, known: str, acted: str | None = None, most: int = 4) -> DataFrame:
    """The rounds of each run up to the ``most``-th in a row that knew no more than the one before (and in which nothing was ``acted`` on)."""
    w = Window.partitionBy(run).orderBy(order)
    idle = F.coalesce(F.col(known) == F.lag(known, 1, 0).over(w), F.lit(False))
    idle = idle if acted is None else idle & ~F.coalesce(F.col(acted), F.lit(False))
    marked = rounds.withColumn("__idle", idle.cast("int"))
    last = marked.withColumn("__row", F.sum("__idle").over(w.rowsBetween(1 - most, 0)))
    ended = last.withColumn("__over", F.coalesce(F.max((F.col("__row") == most).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return ended.filter("__over = 0").drop("__idle", "__row", "__over")


def windowed_counts(events: DataFrame, at: str, kind: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums by time window and kind, on a stream or a table. An extension: the scripts this replaces had no windows."""
    own = events.schema[at].dataType
    timed = events.withColumn(at, F.col(at).cast("timestamp"))  # watermarks want a time with zone; the result has the column's own type
    base = timed.withWatermark(at, late) if events.isStreaming else timed
    return base.groupBy(F.window(at, width).alias("w"), kind).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").cast(own).alias("window_start"), kind, "n", "total")
