"""Projections, schema rules and set operations."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class SchemaMismatch(ValueError):
    """Columns are missing or not expected."""


def ordered(df: DataFrame, order: Iterable[str]) -> DataFrame:
    """The named columns first, in that order, where there are; the others after them."""
    first = [c for c in order if c in df.columns]
    return df.select(*first, *[c for c in df.columns if c not in first])


def exactly(df: DataFrame, order: Iterable[str]) -> DataFrame:
    """The named columns in that order; ``SchemaMismatch`` if one is missing or one too many."""
    order = list(order)
    missing, extra = [c for c in order if c not in df.columns], [c for c in df.columns if c not in order]
    if missing or extra:
        raise SchemaMismatch(f"missing: {missing}, not expected: {extra}")
    return df.select(*order)


def coerced(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """The schema's columns alone; those the table lacks are null."""
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(kind).alias(c) for c, kind in schema.items()])


def prefixed(df: DataFrame, prefix: str, keep: Iterable[str] = (), renames: dict[str, str] | None = None) -> DataFrame:
    renames = renames or {}
    return df.withColumnsRenamed({c: renames.get(c, f"{prefix}{c}") for c in df.columns if c not in set(keep)})


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """All rows by column name; a column that a table lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def tagged_union(frames: dict[str, DataFrame], column: str) -> DataFrame:
    """All rows, with the name of the table each came from."""
    return union_all(f.withColumn(column, F.lit(name)) for name, f in frames.items())


def key_union(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def key_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` that ``b`` has not; nulls equal each other."""
    return a.select(b.columns).subtract(b)


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of one side, with ``side`` 'left' or 'right'."""
    return key_difference(a, b).withColumn("side", F.lit("left")).unionByName(key_difference(b, a.select(b.columns)).withColumn("side", F.lit("right")))


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def in_list(column: Column, listed: str) -> Column:
    """Whether an id is in a text list such as 't1,2;3'."""
    ids = [int(x.strip().lower().removeprefix("t")) for x in listed.replace(";", ",").split(",") if x.strip()]
    return column.isin(ids)


def one_of(value: str, choices: Iterable[str], what: str) -> str:
    if value not in set(choices):
        raise ValueError(f"{what}: {value!r} is none of {sorted(choices)}")
    return value


def browse(df: DataFrame, rating: Column, source: Column, has_extraction: Column, has_warnings: Column, haystack: Column, *, bucket: str | None = None, origin: str | None = None, content: str | None = None, search: str | None = None) -> DataFrame:
    """Rows that a report's filters leave: rating bucket, source, content ('with_extraction', 'empty', 'with_warnings') and a search in any case."""
    from siltstone.functions.classify import rating_bucket

    tests = {"with_extraction": has_extraction, "empty": ~has_extraction, "with_warnings": has_warnings}
    if bucket:
        df = df.filter(rating_bucket(rating) == bucket)
    if origin:
        df = df.filter(source == origin)
    if content:
        df = df.filter(tests[one_of(content, tests, "content")])
    return df.filter(F.lower(haystack).contains(search.lower())) if search else df


def browse_counts(df: DataFrame, rating: Column, has_extraction: Column, has_warnings: Column) -> DataFrame:
    """The numbers beside a report's filters, in one pass."""
    from siltstone.functions.classify import rating_bucket

    bucket = rating_bucket(rating)
    return df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(bucket == b).alias(f"rating_{b}") for b in "12345"], F.count_if(has_extraction).alias("with_extraction"), F.count_if(has_warnings).alias("with_warnings"))
