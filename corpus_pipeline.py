"""The corpus pipeline: five operators in a row, from documents to packed training sequences.

Each stage works on what its predecessor kept. All but the last return the columns of documents: the classifier drops texts that
it takes for junk, the dedup keeps one row of equal texts, the join keeps one row of each group of near copies, the scan replaces
secrets in the texts by marks (and sets n_chars, where there is one, to the new length). The last packs what is left.
Nulls and empty tables pass through every stage as the operators' docstrings say.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import jaccard, nbsvm, packing, secrets, stream_dedup
from siltstone.llm.common import collect_garbage, stored, table
from siltstone.llm.queries import tokenizer_path

LEAST_QUALITY = 0.3

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def from_rest(stage: Stage) -> Stage:
    """``stage``, begun with small heaps: what the stages before it left there doesn't add to its own memory."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        collect_garbage(spark)
        return stage(spark, docs, sf_dir)

    return run


@from_rest
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = nbsvm.train(docs, table(spark, sf_dir, "labels"))
    score = "quality_score" + "_" * max((len(c) for c in docs.columns), default=0)  # no column of the table has so long a name
    return nbsvm.scored(docs, model, out=score).filter(F.col(score) >= LEAST_QUALITY).drop(score)


@from_rest
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return stream_dedup.deduplicated(docs)


@from_rest
def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs)


@from_rest
def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.redact(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return clean


@from_rest
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    packed = packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), most_words=1 << 17)  # workers hold earlier stages' libraries too
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", jaccard_join),
    ("secret scans", secret_scan),
    ("packing", pack),
]

#: SQL has no fitted classifier and no tokenizer; tests compare the stages with plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
