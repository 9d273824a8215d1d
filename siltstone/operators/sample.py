"""Reproducible samples: rows are ordered by a hash of seed and key, so that any engine draws the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Share and least size of each stratum of a sample.
BUDGETS = {"rated": (0.50, 9), "long": (0.15, 3), "short": (0.15, 3), "empty": (0.10, 2), "rescrape": (0.10, 2)}
RATINGS = (1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 4.5, 5.0)


def hash_order(key: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def budgets(n: int) -> dict[str, int]:
    return {name: max(int(n * share), least) for name, (share, least) in BUDGETS.items()}


def stratified(df: DataFrame, n: int, key: str, rating: str, text: str, source: str, seed: int = 42) -> DataFrame:
    """At most ``n`` rows: some of each rating, of the longest 5 %, of short, of nearly empty and of rescraped ones; each key once.

    Strata may overlap; a row counts for its first. Columns are those of ``df`` and ``stratum``.
    """
    sizes = budgets(n)
    length = F.length(F.coalesce(F.col(text), F.lit("")))
    long_from = df.agg(F.percentile(length, F.lit(0.95)).alias("q")).first()["q"]
    per_rating = max(1, sizes["rated"] // len(RATINGS))
    strata = [(k, (F.col(rating) == r) & (length >= 30), per_rating) for k, r in enumerate(RATINGS)]
    strata += [(9, length >= F.lit(long_from), sizes["long"]), (10, (length >= 15) & (length < 50), sizes["short"]), (11, length < 15, sizes["empty"]), (12, F.col(source) == "rescrape", sizes["rescrape"])]
    order = hash_order(F.col(key), seed)
    inside = F.array_compact(F.array(*[F.when(test, F.struct(F.lit(k).alias("stratum"), F.lit(take).alias("take"))) for k, test, take in strata]))
    rows = df.withColumn("__in", F.explode(inside)).withColumns({"stratum": F.col("__in.stratum"), "__take": F.col("__in.take")}).drop("__in")
    # The literal bound lets each task keep so many rows a stratum before the shuffle.
    most = max(take for _, _, take in strata)
    drawn = rows.withColumn("__n", F.row_number().over(Window.partitionBy("stratum").orderBy(order, key))).filter(f"__n <= {most}").filter("__n <= __take")
    once = drawn.withColumn("__first", F.row_number().over(Window.partitionBy(key).orderBy("stratum"))).filter("__first = 1").drop("__n", "__take", "__first")
    return once.orderBy(order, key).limit(n)


def showcase(df: DataFrame, key: str, order: list[str], labels: dict[str, Column]) -> list[dict]:
    """For each label the first row, in order, that its test holds for and no earlier label took; null tests don't hold.

    A few rows: one for each label, found by one ordered search each.
    """
    chosen: list[dict] = []
    for label, test in labels.items():
        left = df.filter(F.coalesce(test, F.lit(False)))
        used = [c[key] for c in chosen]
        if used:
            left = left.filter(~F.col(key).isin(used))
        chosen += [{**r.asDict(), "showcase_label": label} for r in left.orderBy(*order).limit(1).collect()]
    return chosen
