"""Joins: validated look-ups, overrides, prioritised candidates and fuzzy slugs."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.text import slug_score, tokens

Cols = list[str]


class NotUnique(ValueError):
    """A look-up table has a key twice."""


def both(left: DataFrame, right: DataFrame, keys: Cols) -> Column:
    """Keys equal, null to null."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def check_unique(df: DataFrame, keys: Cols) -> DataFrame:
    twice = df.groupBy(*keys).count().filter("count > 1").limit(3).collect()
    if twice:
        raise NotUnique(f"{keys}: {[tuple(r)[:-1] for r in twice]} stand more than once")
    return df


def many_to_one(left: DataFrame, right: DataFrame, keys: Cols, indicator: str = "matched") -> DataFrame:
    """Left join to a table whose keys are unique (else ``NotUnique``); ``indicator`` says whether a row found one. Null keys meet null keys."""
    marked = check_unique(right, keys).withColumnsRenamed({k: f"__{k}" for k in keys}).withColumn("__there", F.lit(True))
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return left.join(marked, on, "left").withColumn(indicator, F.col("__there").isNotNull()).drop("__there", *[f"__{k}" for k in keys])


def unmatched(joined: DataFrame, indicator: str = "matched") -> int:
    return joined.filter(~F.col(indicator)).count()


def lookup_count(df: DataFrame, facts: DataFrame, key: str, fact_key: str, column: str) -> DataFrame:
    """How many facts each row has; 0 where none."""
    counts = facts.filter(F.col(fact_key).isNotNull()).groupBy(F.col(fact_key).alias(key)).agg(F.count(F.lit(1)).alias(column))
    return df.join(counts, key, "left").withColumn(column, F.coalesce(column, F.lit(0)))


def override(base: DataFrame, newer: DataFrame, key: str) -> DataFrame:
    """``newer`` rows, and those of ``base`` whose key is not among them. Blank keys never match; rows that repeat within one side stay."""
    trimmed = F.trim(F.col(key))
    keys = newer.select(trimmed.alias("__key")).filter("__key is not null and __key <> ''").distinct()
    return base.join(keys, trimmed == F.col("__key"), "left_anti").unionByName(newer)


def not_in(df: DataFrame, log: DataFrame, keys: Cols) -> DataFrame:
    return df.join(log.select(*keys).distinct(), keys, "left_anti")


def only_in(df: DataFrame, log: DataFrame, keys: Cols) -> DataFrame:
    return df.join(log.select(*keys).distinct(), keys, "left_semi")


def with_flag(df: DataFrame, log: DataFrame, key: str, column: str, yes: object = True, no: object = False) -> DataFrame:
    """Whether a row's key is in the log, as ``yes`` or ``no``."""
    there = log.select(key).distinct().withColumn("__in", F.lit(True))
    return df.join(there, key, "left").withColumn(column, F.when(F.col("__in"), F.lit(yes)).otherwise(F.lit(no))).drop("__in")


def by_priority(df: DataFrame, key: str, candidates: str, files: DataFrame, name: str, file: str) -> DataFrame:
    """Each row's file by its first candidate that is a file's ``name``; of several such files the first in order. Null without one."""
    options = df.select(key, F.posexplode(candidates).alias("__rank", name))
    hits = options.join(files.select(name, file), name).groupBy(key).agg(F.min_by(file, F.struct("__rank", file)).alias(file))
    return df.join(hits, key, "left")


def fuzzy_slugs(df: DataFrame, key: str, slug: str, files: DataFrame, file: str, file_slug: str, threshold: float = 0.55, gram: int = 3) -> DataFrame:
    """The file of best slug score (ties: the first in order) for each row, if it reaches the threshold; key, file, score.

    Pairs come from rare parts, so that a common word makes no pair of all slugs that have it. Slugs of enough equal tokens share one
    among their rarest: of n tokens the first n - ceil(threshold n) + 1. A slug that stands within another is found by its rarest run
    of ``gram`` characters (or by itself, if it is shorter). Slugs are compared once each, however many rows have them.
    """
    left, right = df.select(F.col(slug).alias("a")).filter("a <> ''").distinct(), files.select(F.col(file_slug).alias("b")).filter("b <> ''").distinct()
    both_sides = left.select(F.col("a").alias("s")).unionByName(right.select(F.col("b").alias("s"))).distinct()

    def rarest(of: DataFrame, s: str, parts: Callable[[Column], Column], most: Callable[[Column], Column], among: DataFrame) -> DataFrame:
        """``s`` and its first parts by how many slugs of ``among`` have them."""
        seen = among.select(F.explode(F.array_distinct(parts(F.col("s")))).alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("seen"))
        each = of.select(s, F.explode(parts(F.col(s))).alias("t"), F.size(parts(F.col(s))).alias("n")).join(seen, "t")
        listed = each.groupBy(s).agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("seen", "t"))).alias("parts"))  # as many as a slug has parts
        return listed.select(s, F.explode(F.slice("parts", F.lit(1), most(F.col("n")))).alias("p")).select(s, F.col("p.t").alias("t"))

    enough = lambda n: (n - F.ceil(F.lit(threshold) * n - F.lit(1e-9)) + 1).cast("int")
    one = lambda n: F.lit(1)
    own_runs = lambda c: F.when(F.length(c) < gram, F.array(c)).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - gram + 1, F.lit(1))), lambda k: F.substr(c, k, F.lit(gram)))))
    runs = lambda c: F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), F.lit(gram)), lambda n: F.when(F.length(c) >= n, F.transform(F.sequence(F.lit(1), F.length(c) - n + 1), lambda k: F.substr(c, k, n))).otherwise(F.array().cast("array<string>")))))
    shared = rarest(left, "a", tokens, enough, both_sides).join(rarest(right, "b", tokens, enough, both_sides), "t").select("a", "b")
    inside = rarest(left, "a", own_runs, one, both_sides).join(right.select("b", F.explode(runs(F.col("b"))).alias("t")), "t").filter(F.col("b").contains(F.col("a"))).select("a", "b")
    around = left.select("a", F.explode(runs(F.col("a"))).alias("t")).join(rarest(right, "b", own_runs, one, both_sides), "t").filter(F.col("a").contains(F.col("b"))).select("a", "b")
    pairs = shared.unionByName(inside).unionByName(around).distinct().withColumn("score", slug_score(F.col("a"), F.col("b"))).filter(F.col("score") >= threshold)
    firsts = files.groupBy(F.col(file_slug).alias("b")).agg(F.min(file).alias(file))
    best = pairs.join(firsts, "b").groupBy("a").agg(F.min(F.struct((-F.col("score")).alias("far"), F.col(file).alias("file"))).alias("best"))
    return df.select(key, F.col(slug).alias("a")).join(best, "a").select(key, F.col("best.file").alias(file), (-F.col("best.far")).alias("score"))


def with_defaults(df: DataFrame, lookup: DataFrame, key: str, defaults: dict[str, object]) -> DataFrame:
    """The look-up's columns for each row, or their defaults. The look-up's keys are unique (else ``NotUnique``)."""
    there = check_unique(lookup.select(key, *defaults), [key])
    return df.join(there, key, "left").withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def compare_runs(before: DataFrame, after: DataFrame, keys: Cols, value: str) -> DataFrame:
    """Both runs' values by key, 0 where one lacks it, and the difference."""
    a, b = before.select(*keys, F.col(value).alias("before")), after.select(*keys, F.col(value).alias("after"))
    joined = a.join(b, keys, "full_outer").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("before", "after")})
    return joined.withColumn("delta", F.col("after") - F.col("before"))


def jobs(*lists: DataFrame) -> DataFrame:
    """Every combination of a few short lists (such as hubs and sort orders)."""
    return reduce(lambda a, b: a.crossJoin(F.broadcast(b)), lists)
