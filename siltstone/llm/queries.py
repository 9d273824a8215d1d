"""The operators as registered queries: production parameters, whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import ann, chat, html, jaccard, nbsvm, packing, sampling, secrets, stream_dedup, token_counts
from siltstone.llm.common import table


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sentencepiece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two distinct segmentations of every document."""
    return sampling.sampled(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"), k=2)


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_pages(table(spark, sf_dir, "pages"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one whose texts look like a template's own marks."""
    hard = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(hard)
    return chat.digests(chat.format_chats(rows))


def op4_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stream_dedup.groups(table(spark, sf_dir, "documents"))
    return rows.select(F.col("key").alias("doc_id"), F.col("keep.key").alias("keep_id"), F.col("n").alias("group_size"), stream_dedup.kept().alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_spans(table(spark, sf_dir, "documents"))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")
    of = lambda *kinds: F.filter("spans", lambda s: s.kind.isin(*kinds))
    return found.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in secrets.KINDS],
        F.sha2(joined(of("assign", "access", "hex")), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op6_pow2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("key", "doc_id")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = nbsvm.train(docs, table(spark, sf_dir, "labels"))
    return nbsvm.scored(docs, model).select("doc_id", nbsvm.in_fold(F.col("doc_id")).alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= 0.3).cast("int").alias("predicted"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op10_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


#: SQL for the queries that it can express; the others are tested against plain versions.
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL = {
    "op3_chat_formatting": r"""
        WITH t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
                   UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
             f AS (SELECT *, 24 + length(role) + length(text) + length(text) - length(replace(text, '\', ''))
                          + len(regexp_extract_all(text, '<\||</?s>|<</?SYS>>|\[/?INST\]')) AS chars FROM t)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(chars)::BIGINT AS formatted_chars, 0::BIGINT AS n_rewrites
        FROM f GROUP BY conv_id""",
    "op4_stream_dedup": f"""
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, sha256(same) AS text_sha256
        FROM (SELECT doc_id, {LOWER} AS same FROM documents) WINDOW g AS (PARTITION BY same)""",
    "op7_jaccard_join": rf"""
        WITH RECURSIVE d AS (SELECT doc_id, [w for w in string_split_regex({LOWER}, '[\x20\x09-\x0D]+') if w <> ''] AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
        p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
        l AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 80 * (x.n + y.n - c)),
        e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
        r AS (SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node)
        SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.root) AS component_id
        FROM d LEFT JOIN n ON d.doc_id = n.doc_id JOIN r ON d.doc_id = r.node GROUP BY 1""",
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
