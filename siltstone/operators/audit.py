"""Reconciliation audits: each gives name, passed, checked, failed and some examples, as one row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.dates import well_formed
from siltstone.operators.dedupe import contiguity

Cols = list[str]


def metric(name: str, rows: DataFrame, bad: Column, example: Column, most: int = 10, informational: bool = False) -> DataFrame:
    """One row: how many rows were checked and failed, with the first failing examples in order."""
    found = rows.select(bad.alias("bad"), example.cast("string").alias("example"))
    totals = found.agg(F.count(F.lit(1)).alias("checked"), F.count_if("bad").alias("failed"))
    first = found.filter("bad").select("example").distinct().orderBy("example").limit(most).agg(F.array_sort(F.collect_list("example")).alias("examples"))
    return totals.join(F.broadcast(first)).select(F.lit(name).alias("name"), (F.lit(informational) | (F.col("failed") == 0)).alias("passed"), "checked", "failed", "examples")


def topic_counts(topics: DataFrame, posts: DataFrame, failed: DataFrame, topic: str = "topic_id", replies: str = "replies") -> DataFrame:
    """Topics whose posts are not replies + 1; failed topics and those without replies are left out."""
    known = topics.filter(F.col(replies).isNotNull()).join(failed.select(topic).distinct(), topic, "left_anti")
    found = posts.groupBy(topic).agg(F.count(F.lit(1)).alias("found"))
    return known.join(found, topic, "left").select(topic, (F.col(replies) + 1).alias("expected"), F.coalesce("found", F.lit(0)).alias("found")).withColumn("delta", F.col("found") - F.col("expected"))


def unique_ids(posts: DataFrame, keys: Cols) -> DataFrame:
    """Keys that stand more than once, with how often."""
    return posts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def coverage(topics: DataFrame, completed: DataFrame, failed: DataFrame, key: str = "topic_id") -> DataFrame:
    """Keys that are in one of the two only: 'unaccounted' topics, and 'extra' completed ones."""
    have, done = topics.select(key).distinct(), completed.select(key).distinct()
    accounted = done.unionByName(failed.select(key)).distinct()
    return have.join(accounted, key, "left_anti").withColumn("what", F.lit("unaccounted")).unionByName(done.join(have, key, "left_anti").withColumn("what", F.lit("extra")))


def positions(posts: DataFrame, topic: str, position: str) -> DataFrame:
    return contiguity(posts, [topic], position)


def empty_bodies(posts: DataFrame, body: str) -> DataFrame:
    blank = F.trim(F.coalesce(F.col(body), F.lit(""))) == ""
    return posts.agg(F.count(F.lit(1)).alias("checked"), F.count_if(blank).alias("empty"), F.round(100 * F.count_if(blank) / F.greatest(F.count(F.lit(1)), F.lit(1)), 3).alias("empty_percent"))


def bad_dates(posts: DataFrame, posted: str) -> DataFrame:
    return posts.filter(~well_formed(F.col(posted)))


def count_deltas(topics: DataFrame, delta: str = "count_delta") -> DataFrame:
    return topics.agg(F.count_if(F.col(delta) < 0).alias("fewer"), F.count_if(F.col(delta) > 0).alias("more"), F.count_if(F.col(delta) == 0).alias("equal"))


def declared_shortfall(declared: Column, collected: Column) -> Column:
    """Whether less was collected than a page declares."""
    return F.coalesce(collected < declared, F.lit(False))


def forum_report(topics: DataFrame, posts: DataFrame, completed: DataFrame, failed: DataFrame, topic: str = "topic_id", post: str = "post_id", position: str = "position_in_topic", body: str = "body_text", posted: str = "posted_at") -> DataFrame:
    """All audits of a forum, a row each."""
    per_topic = topic_counts(topics, posts, failed, topic)
    per_id = posts.filter(F.col(post).isNotNull()).groupBy(post).agg(F.count(F.lit(1)).alias("n"))
    per_pair = posts.filter(F.col(post).isNotNull()).groupBy(topic, post).agg(F.count(F.lit(1)).alias("n"))
    accounted = completed.select(topic).unionByName(failed.select(topic)).distinct().withColumn("__in", F.lit(True))
    have = topics.select(topic).distinct().join(accounted, topic, "left")
    blank = F.trim(F.coalesce(F.col(body), F.lit(""))) == ""
    rows = [
        metric("per_topic_counts", per_topic, F.col("delta") != 0, F.col(topic)),
        metric("global_id_uniqueness", per_id, F.col("n") > 1, F.col(post), 20),
        metric("per_topic_id_uniqueness", per_pair, F.col("n") > 1, F.concat_ws(":", topic, post)),
        metric("coverage", have, F.col("__in").isNull(), F.col(topic)),
        metric("position_contiguity", positions(posts, topic, position), ~F.col("contiguous"), F.col(topic)),
        metric("empty_bodies", posts, blank, F.col(post), informational=True),
        metric("date_parseability", posts, ~well_formed(F.col(posted)), F.col(posted)),
    ]
    return reduce(lambda a, b: a.unionByName(b), rows)


def exit_code(report: DataFrame) -> int:
    """How many checks failed."""
    return report.filter("not passed").count()


def lines(report: DataFrame) -> list[str]:
    """A line a check, as a console shows them."""
    return [f"[{'PASS' if r.passed and not r.failed else 'INFO' if r.passed else 'FAIL'}] {r['name']}: {r.failed} of {r.checked}" for r in report.orderBy("name").collect()]
