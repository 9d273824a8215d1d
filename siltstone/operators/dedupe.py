"""Order-aware dedup, ordinals and gaps: windows over an order that is always explicit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.sources.shared import checkpointing

Cols = list[str]


def keep_first(df: DataFrame, keys: Cols, order: list[Column | str]) -> DataFrame:
    """The first row of each key in an order; nulls are one key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def keep_last(df: DataFrame, keys: Cols, order: list[str]) -> DataFrame:
    """The last row of each key in an order."""
    return keep_first(df, keys, [F.desc(c) for c in order])


def first_value_by(df: DataFrame, keys: Cols, order: str, last: bool = False) -> DataFrame:
    """As ``keep_first`` (or last) of each key, by an aggregate that tasks start on before rows move; ``order`` is unique within a key."""
    pick = F.max_by if last else F.min_by
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(pick(F.struct(*rest), F.col(order)).alias("__row")).select(*keys, "__row.*")


def keep_first_pages(df: DataFrame, key: str, order: Cols, most: int | None = None) -> DataFrame:
    """The first row of each key over pages and filters, and of those at most ``most``, in order."""
    first = keep_first(df, [key], order)
    return first.orderBy(*order).limit(most) if most else first


def upsert(current: DataFrame, new: DataFrame, keys: Cols) -> DataFrame:
    """``new`` rows, and those of ``current`` whose key they have not."""
    return current.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def append_unseen(master: DataFrame, new: DataFrame, keys: Cols) -> DataFrame:
    """``master``, and the ``new`` rows whose key it has not."""
    return master.unionByName(new.join(master.select(*keys).distinct(), keys, "left_anti"))


def page_index(partition: Cols, offset: str) -> Column:
    """Which page an offset stands on, from 1."""
    return F.dense_rank().over(Window.partitionBy(*partition).orderBy(offset))


def dense_offsets(offsets: Column, pages: Column, step: int = 10) -> Column:
    """The offsets found and those that the number of pages calls for, sorted."""
    wanted = F.when(pages > 0, F.sequence(F.lit(0), (pages - 1) * step, F.lit(step))).otherwise(F.array(F.lit(0)))
    return F.array_sort(F.array_union(offsets, wanted))


def contiguity(df: DataFrame, group: Cols, position: str, examples: int = 10) -> DataFrame:
    """Per group whether its positions are 0 to n - 1, each once, and if not the first positions."""
    found = df.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.countDistinct(position).alias("different"), F.min(position).alias("least"), F.max(position).alias("most"))
    return found.withColumn("contiguous", (F.col("least") == 0) & (F.col("most") == F.col("n") - 1) & (F.col("different") == F.col("n")))


def running_new(df: DataFrame, key: str, job: str) -> DataFrame:
    """Per job: its different keys, those no earlier job had, and how many are known by then."""
    pairs = df.select(job, key).distinct()
    first = pairs.groupBy(key).agg(F.min(job).alias(job)).groupBy(job).agg(F.count(F.lit(1)).alias("new"))
    per_job = pairs.groupBy(job).agg(F.count(F.lit(1)).alias("on_page")).join(first, job, "left").select(job, "on_page", F.coalesce("new", F.lit(0)).alias("new_vs_prior"))
    # A row a job: the running sum is over as many rows as there are jobs.
    return per_job.withColumn("total_so_far", F.sum("new_vs_prior").over(Window.orderBy(job).rowsBetween(Window.unboundedPreceding, 0)))


def row_index(df: DataFrame, order: Cols, column: str = "idx") -> DataFrame:
    """Row numbers from 0 over the whole table: sorted in parallel, counted by partition, then numbered.

    The ranges are checkpointed: they are cut by samples, so that a second reading could cut them elsewhere.
    """
    ready = checkpointing(df.sparkSession)
    ranged = df.repartitionByRange(int(ready.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id()).checkpoint()
    sizes = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__from"))
    before = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))  # a row a partition
    return ranged.join(F.broadcast(before), "__part").withColumn(column, F.col("__at") - F.col("__from") + F.col("__before")).drop("__part", "__at", "__n", "__from", "__before")


def until_repeat(df: DataFrame, group: Cols, page: str, key: str) -> DataFrame:
    """The pages before the first one whose keys are those of the page before it."""
    pages = df.groupBy(*group, page).agg(F.array_sort(F.collect_set(key)).alias("__keys"))
    w = Window.partitionBy(*group).orderBy(page)
    again = F.coalesce((F.col("__keys") == F.lag("__keys").over(w)).cast("int"), F.lit(0))
    kept = pages.withColumn("__same", again).withColumn("__again", F.max("__same").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return df.join(kept.filter("__again = 0").select(*group, page), [*group, page], "left_semi")
