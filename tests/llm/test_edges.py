"""Empty tables, very long texts and clashing column names; registered queries that SQL can't say, against plain versions of whole results."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import corpus_pipeline
from siltstone.llm import chat, jaccard, nbsvm, packing, queries, secrets, stream_dedup, token_counts
from tests.llm.brute import near

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_empty_tables(spark, sf_dir):
    none = spark.createDataFrame([], DOCS)
    assert packing.pack(none, PATH).count() == token_counts.token_counts(none, PATH).count() == 0
    for of in (secrets.redact, jaccard.one_of_each, stream_dedup.deduplicated):
        got = of(none)
        assert got.columns == none.columns and got.count() == 0
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, sf_dir).count() == 0, name


def test_very_long_texts(spark, tokenizer):
    """Three million characters are handled whole: what stands at their ends is found."""
    body = "plain words of a long text " * 110_000
    rows = [(1, body + "password=hunter2222", "en", "s", 1), (2, body + "password=HUNTER2222", "en", "s", 1), (3, body + "x", "en", "s", 1)]
    df = spark.createDataFrame(rows, DOCS)
    spans = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in secrets.secret_spans(df).collect()}
    assert spans == {1: [("assign", len(body), len(body) + 19)], 2: [("assign", len(body), len(body) + 19)], 3: []}
    assert {r.key: (r.keep.key, r.n) for r in stream_dedup.groups(df).collect()} == {1: (2, 2), 2: (2, 2), 3: (3, 1)}
    talk = spark.createDataFrame([(1, 0, "user", rows[0][1]), (1, 1, "assistant", rows[2][1])], "conv_id long, turn long, role string, text string")
    got = chat.digests(chat.format_chats(talk)).collect()
    assert [(r.n_turns, r.loss_chars, r.loss_sha256) for r in got] == [(2, len(rows[2][1]), hashlib.sha256(rows[2][1].encode()).hexdigest())]
    assert {r.doc_id: r.n_tokens for r in token_counts.token_counts(df.filter("doc_id = 3"), PATH).collect()} == {3: len(tokenizer.encode(rows[2][1], add_special_tokens=False).ids)}


@pytest.mark.parametrize("text", ["слово ещё одно\nдругое 1 " * 300, "今天天气很好。我们去公园！好吗？" * 200, "كلمة أخرى هنا " * 300, "a  b\n\n c\x1c \x85 d e " * 200, "it's 'quoted' x's " * 200])
def test_splits_of_all_scripts(text, tokenizer):
    counter = token_counts.Counter.at(PATH)
    for most in (10, 97, 1000):
        parts = token_counts.cut(text, most, counter.safe, counter.drop_space)
        assert len(parts) > 1 and "".join(parts) == text and sum(counter.lengths(parts)) == len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_clashing_names(spark):
    """Columns that are named as an operator's own pass by, or are left out where only the key is read."""
    names = ["doc_id", "text", "spans", "kind", "start", "__text", "key", "file", "row", "all", "owner", "digest", "keep", "n", "places", "label"]
    df = spark.createDataFrame([(k, f"some text {k // 2} token=abcdefg", *[f"{c}{k}" for c in names[2:]]) for k in range(4)], ", ".join(f"`{c}` {'long' if c == 'doc_id' else 'string'}" for c in names))
    assert {r.doc_id: (r.spans, r.kind) for r in secrets.redact(df).collect()} == {k: (f"spans{k}", f"kind{k}") for k in range(4)}
    assert all(len(r.spans) == 1 for r in secrets.secret_spans(df).collect())
    for of in (jaccard.one_of_each, stream_dedup.deduplicated):
        got = of(df)
        assert got.columns == names and got.count() == 2 and all(r.owner == f"owner{r.doc_id}" for r in got.collect())
    marks = spark.createDataFrame([(k, k % 2) for k in range(4)], "doc_id long, quality int")
    scored = nbsvm.scored(df, nbsvm.train(df, marks))
    assert scored.columns == [*names, "quality_score"] and scored.count() == 4
    assert packing.pack(df, PATH).count() > 0 and token_counts.token_counts(df, PATH).count() == 4


def test_op1(spark, sf_dir):
    """Each document has two distinct segmentations (one without pieces if it is empty), each of which decodes to its text."""
    docs = {r.doc_id: r.text or "" for r in queries.table(spark, sf_dir, "documents").collect()}
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    found = {}
    for r in queries.op1_sentencepiece_sampling(spark, sf_dir).collect():
        found.setdefault(r.doc_id, []).append(r)
    assert found.keys() == docs.keys()
    for key, rows in found.items():
        assert sorted(r["sample"] for r in rows) == list(range(1, len(rows) + 1)) and len({tuple(r.ids) for r in rows}) == len(rows) == (2 if docs[key].strip() else 1)
        assert all(model.decode(list(r.ids)) == docs[key].replace("▁", " ") and r.log_inclusion <= 0 for r in rows)


def test_op9(spark, sf_dir, tokenizer):
    docs = {r.doc_id: r.text or "" for r in queries.table(spark, sf_dir, "documents").collect()}
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in queries.op9_token_counts(spark, sf_dir).collect()}
    sizes = {k: len(tokenizer.encode(t, add_special_tokens=False).ids) for k, t in docs.items()}
    assert got == {k: (len(t.encode()), sizes[k], sizes[k] > 512) for k, t in docs.items()}


def test_op6_covers_each_id_once(spark, sf_dir, tokenizer):
    docs = {r.doc_id: r.text or "" for r in queries.table(spark, sf_dir, "documents").collect()}
    check_pieces(queries.op6_pow2_packing(spark, sf_dir).collect(), docs, tokenizer)


def check_pieces(rows, docs, tokenizer):
    """Each id of each document lies in one piece; sequences are gapless and of a power of two."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert by_doc.keys() == docs.keys()
    for key, text in docs.items():
        ids, at = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4"), 0
        for r in sorted(by_doc[key], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at : at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        assert len(pieces) == 1 and pieces[0][0] == 0 and pieces[0][1] in {1 << k for k in range(11)}


def test_pipeline(spark, sf_dir, tokenizer):
    """The registered query against plain stages: scores from the classifier's own test, all else by loops."""
    rows = [(r.doc_id, r.text or "") for r in queries.table(spark, sf_dir, "documents").collect()]
    good = {r.doc_id for r in queries.op8_quality_classifier(spark, sf_dir).filter("score >= 0.3").collect()}
    best = {}
    for key, text in rows:
        if key in good and key >= best.get(text.translate(LOWER), (-1,))[0]:
            best[text.translate(LOWER)] = (key, text)
    left = sorted(best.values())
    roots, kept = near(left, roots=True), {}
    for (key, text), root in zip(left, roots, strict=True):
        kept.setdefault(("alone", key) if root is None else root, (key, text))

    def clean(text):
        out, at = [], 0
        for kind, start, end in secrets.scan(text):
            if start >= at:
                out += [text[at:start], f"[{kind} removed]"]
            at = max(at, end)
        return "".join(out) + text[at:]

    check_pieces(corpus_pipeline.run(spark, sf_dir).collect(), {key: clean(text) for key, text in kept.values()}, tokenizer)
