"""Counts, histograms, top lists and bounded examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Cols = list[str]
#: Prices in dollars of a million tokens, and the corpus that costs are carried on to.
PRICE_IN, PRICE_OUT, CORPUS_REVIEWS = 0.10, 0.40, 2_955_778


def counts(df: DataFrame, keys: Cols, column: str = "n") -> DataFrame:
    """Rows a key; null keys are left out."""
    return df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias(column))


def repeated(df: DataFrame, keys: Cols, column: str = "n") -> DataFrame:
    return counts(df, keys, column).filter(F.col(column) > 1)


def value_counts(df: DataFrame, key: str) -> DataFrame:
    return counts(df, [key]).orderBy(F.desc("n"), key)


def profile(df: DataFrame, columns: Cols) -> DataFrame:
    """Per column: filled values and different values."""
    wide = df.agg(*[F.count(c).alias(f"{c}__n") for c in columns], *[F.countDistinct(c).alias(f"{c}__d") for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}__n").alias("filled"), F.col(f"{c}__d").alias("different")) for c in columns])
    return wide.select(F.inline(rows))


def token_cost(tokens_in: Column, tokens_out: Column) -> Column:
    return tokens_in / 1e6 * PRICE_IN + tokens_out / 1e6 * PRICE_OUT


def cost_projection(per_review: Column, reviews: int = CORPUS_REVIEWS) -> list[Column]:
    """For the whole corpus: one by one, in batches, in batches with a cached prompt."""
    return [F.round(per_review * reviews * share, 2).alias(name) for name, share in (("sync", 1.0), ("batch", 0.5), ("batch_cached", 0.25))]


def histogram(df: DataFrame, kind: Column, key: str) -> DataFrame:
    """Rows and different keys by class."""
    return df.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct(key).alias("different"))


def duplicates(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"), F.countDistinct(key).alias("different"), (F.count(F.lit(1)) - F.countDistinct(key)).alias("repeats"))


def item_histogram(df: DataFrame, items: str) -> DataFrame:
    """How often each item of an array column stands in all rows."""
    return df.select(F.explode(items).alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("n"))


def two_level(df: DataFrame, field: str, value: str, most: int = 8) -> DataFrame:
    """Per field its total and its commonest values, at most ``most``."""
    per = df.groupBy(field, value).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(field)
    return per.withColumn("total", F.sum("n").over(w)).withColumn("rank", F.row_number().over(w.orderBy(F.desc("n"), value))).filter(F.col("rank") <= most)


def examples(df: DataFrame, group: Cols, value: str, most: int) -> DataFrame:
    """The first ``most`` different values of each group, sorted. Ranks cut the rows before a list is made."""
    w = Window.partitionBy(*group).orderBy(value)
    return df.select(*group, value).distinct().withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= most).groupBy(*group).agg(F.array_sort(F.collect_list(value)).alias("examples"))


def top_and_rest(df: DataFrame, key: str, n: int = 15, rest: str = "(rest)") -> DataFrame:
    """The ``n`` commonest keys and the sum of all others."""
    per = counts(df, [key])
    named = per.orderBy(F.desc("n"), key).limit(n).select(key, F.lit(True).alias("__top"))
    return per.join(F.broadcast(named), key, "left").groupBy(F.when(F.col("__top"), F.col(key)).otherwise(rest).alias(key)).agg(F.sum("n").alias("n"))


def page_of(df: DataFrame, order: list[Column | str], offset: int = 0, limit: int | None = None) -> DataFrame:
    out = df.orderBy(*order).offset(offset)
    return out if limit is None else out.limit(limit)


def bar_scale(df: DataFrame, value: Column) -> Column:
    """A bar's length in percent of the table's longest, which a subquery finds."""
    return F.round(100 * value / F.greatest(df.agg(F.max(value)).scalar(), F.lit(1)), 1)


def evidence(df: DataFrame, group: Cols, field: str, value: str, at: str | None = None, half_life_days: float = 365.0) -> DataFrame:
    """Per group and field: value distribution, mode, carriers, and a confidence from their number and age.

    The confidence is ours: 1 - exp(-weight / 10), where each carrier weighs half as much for every ``half_life_days`` of age.
    """
    weight = F.lit(1.0) if at is None else F.pow(F.lit(0.5), F.datediff(F.current_date(), F.col(at)) / half_life_days)
    per = df.filter(F.col(value).isNotNull()).groupBy(*group, field, value).agg(F.count(F.lit(1)).alias("n"), F.sum(weight).alias("w"))
    listed = F.map_from_entries(F.array_sort(F.collect_list(F.struct(value, "n")))).alias("distribution")
    return per.groupBy(*group, field).agg(listed, F.max_by(value, F.struct("n", value)).alias("mode"), F.sum("n").alias("evidence_n"), (1 - F.exp(-F.sum("w") / 10)).alias("confidence"))


def ordinal_stats(df: DataFrame, group: Cols, field: str, value: Column) -> DataFrame:
    """Mean and variance of values coded as numbers."""
    return df.groupBy(*group, field).agg(F.avg(value).alias("mean"), F.var_pop(value).alias("variance"), F.count(value).alias("evidence_n"))


def split_by(df: DataFrame, group: Cols, bucket: Column, value: Column) -> DataFrame:
    """Counts and means by a further bucket: a time's month, or the company of a visit."""
    return df.groupBy(*group, bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"))


def wide(df: DataFrame, group: Cols, field: str, value: str, fields: list) -> DataFrame:
    """A column a field."""
    return df.groupBy(*group).pivot(field, fields).agg(F.first(value))


def capped(df: DataFrame, group: Cols, order: list[Column | str], most: int) -> DataFrame:
    """At most ``most`` rows a group, the first in order."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col("__n") <= most).drop("__n")
