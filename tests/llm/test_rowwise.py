"""Operators that work row by row, against plain loops over the same rows."""

import hashlib
import random
import re
import string
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from siltstone.llm import chat, packing, queries, secrets, token_counts

HARD = [None, "", " ", "a", "<|endoftext|>", "x <|endoftext|>y", "two  spaces\n\n\tand tabs ", "naïve café 漢字 🦄   \x1c ​", "it's they'll 1234 ....", "a b " * 40000, "word" * 5000, "é́ ﬁ"]
DOCS = "doc_id long, text string, score double, keep_id long"


@pytest.fixture(scope="module")
def hard(spark):
    return spark.createDataFrame([(k if k != 3 else None, t, 0.5, 1) for k, t in enumerate(HARD)] * 2, DOCS)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_token_counts(hard, tokenizer):
    got = token_counts.token_counts(hard, public_tokenizers.path("byte_bpe_50k.json"), split_chars=100).collect()
    want = [((t or ""), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for t in HARD] * 2
    assert sorted((r.n_bytes, r.n_tokens, r.over_limit) for r in got) == sorted((len(t.encode()), n, n > 512) for t, n in want)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_token_counts_split(name):
    counter = token_counts.Counter(public_tokenizers.path(name))
    for t in HARD:
        assert counter.count([t or ""], 50) == counter.lengths([t or ""]), t[:30]


def test_packing(hard, tokenizer):
    got = packing.pack(hard, public_tokenizers.path("byte_bpe_50k.json"), longest=64).collect()
    assert len({r.sequence_id for r in got}) == len(got) and all(r.offset == 0 and r.length & (r.length - 1) == 0 and len(r.ids) == 4 * r.length for r in got)
    for key, t in enumerate(HARD):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        own = sorted((r for r in got if r.doc_id == (key if key != 3 else None)), key=lambda r: (r.start, r.sequence_id))
        assert all(r.doc_tokens == len(ids) for r in own)
        for copy in (own[::2], own[1::2]):
            assert list(np.frombuffer(b"".join(bytes(r.ids) for r in copy), "<u4")) == ids
            assert [r.start for r in copy] == list(np.cumsum([0] + [r.length for r in copy])[:-1])


def test_op6(spark, sf_dir, tokenizer):
    docs = {r.doc_id: r.text for r in queries.table(spark, sf_dir, "documents").collect()}
    for r in queries.op6_pow2_packing(spark, sf_dir).collect():
        ids = [*tokenizer.encode(docs[r.doc_id], add_special_tokens=False).ids, 0]
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())


def base_spans(text):
    """The contract's patterns, read literally."""
    found = [("assign", *m.span()) for m in re.finditer(r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.ASCII) if len(m[1]) >= 6]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


def test_op5(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in queries.table(spark, sf_dir, "documents").collect()}
    got = queries.op5_secret_scan(spark, sf_dir).collect()
    assert len(got) == len(docs) and sum(r.n_assign + r.n_access + r.n_hex for r in got) > 0
    for r in got:
        base = base_spans(docs[r.doc_id])
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[0] == k for s in base) for k in secrets.KINDS[:3])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(r.spans.split(","))


@pytest.mark.parametrize(
    "text, kinds",
    [
        ("secret=token:abcdef", []),  # the first match is too short and takes the second's word
        ("PaSSword: 'hunter22'", ["assign"]),
        ("paſſword=abcdef12", []),
        ("xAKIA" + "A1" * 8, ["access"]),
        ("deadbeef" * 3, ["hex"]),
        ("the bearer credential is q7Zp0LmX2vTb9KdR4sWy here", ["novel"]),
        ("the bearer credential is client_secret_public_key1 here", []),
        ("nothing near q7Zp0LmX2vTb9KdR4sWy here", []),
    ],
)
def test_secret_kinds(text, kinds):
    assert [s[0] for s in secrets.scan(text)] == kinds


@pytest.mark.parametrize("letters", ["0123456789abcdef", "0123456789ABCDEF", "0123456789", string.ascii_letters, string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/"])
@pytest.mark.parametrize("size", [16, 20, 24, 64, 128, 1000])
def test_random_keys(letters, size):
    """Random strings in sensitive context are reported at any length and from any alphabet."""
    rng = random.Random(size)
    for _ in range(50):
        key = "".join(rng.choice(letters) for _ in range(size))
        assert secrets.scan(f"the bearer credential is {key} here") in ([("novel", 25, 25 + size)], [("hex", 25, 25 + size)]), key


@pytest.mark.parametrize("word", ["AuthenticationManagerFactory", "internationalization", "password_reset_token_expiry", "user-authentication-failed", "org/springframework/security/web", "----------------", "-=-=-=-=-=-=-=-=", "0000000000000000", "ACKNOWLEDGEMENTS"])
def test_words_are_no_keys(word):
    assert secrets.scan(f"the bearer credential is {word} here") == []


def test_secret_redaction(spark):
    df = spark.createDataFrame([(1, "a token=abcdefg b"), (2, None), (3, "")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in secrets.redact(df).collect()} == {1: "a [assign removed] b", 2: None, 3: ""}
    assert secrets.secret_spans(df.filter("false")).count() == 0


def test_op3(spark, sf_dir):
    rows = [(r.conv_id, r.turn, r.role, r.text or "") for r in queries.table(spark, sf_dir, "conversations").collect()]
    rows += [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    convs = {}
    for c, _, role, text in sorted(rows):
        convs.setdefault(c, []).append((role, text))
    got = {r.conv_id: r for r in queries.op3_chat_formatting(spark, sf_dir).collect()}
    assert got.keys() == convs.keys()
    for c, turns in convs.items():
        learnt = "".join(t for role, t in turns if role == "assistant")
        assert (got[c].n_turns, got[c].loss_chars, got[c].n_rewrites, got[c].formatted_chars) == (len(turns), len(learnt), 0, len(chat.turn_template(turns)))
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(learnt.encode()).hexdigest()


@pytest.mark.parametrize("text", ["", "\\", "\\\\<|end|>", "<|text|>\\", "</s><s>[INST][/INST]<<SYS>>", "<\\|end|>", "a\nb"])
def test_escape(text):
    assert chat.unescape(chat.escape(text)) == text
    assert not any(mark in chat.escape(text) for mark in (chat.END, chat.MIDDLE, "</s>", "[INST]"))
    assert chat.read_span(chat.turn_template([("a\nb%", text)])) == ("a\nb%", text)


def test_chat_rewriting(spark):
    def forgets(turns):  # drops the thoughts of all turns but the last
        return "".join(f"[{r}]{t if k == len(turns) - 1 else re.sub('<think>.*</think>', '', t)}" for k, (r, t) in enumerate(turns))

    turns = [("user", "q"), ("assistant", "<think>x</think> y"), ("user", "z")]
    assert [w for _, w in chat.spans(forgets, turns)] == [False, False, True]
    counted = lambda turns: f"{len(turns)}" + "".join(t for _, t in turns)
    assert chat.is_local(chat.turn_template, 1) and not chat.is_local(counted, 2)
    rows = chat.format_chats(spark.createDataFrame([(1, k, "user", "a") for k in range(3)], "conv_id long, turn long, role string, text string"), render=counted).collect()
    assert [(r.rewrites, r.span_start, r.span) for r in rows] == [(False, 0, "1a"), (True, 0, "2aa"), (True, 0, "3aaa")]


@pytest.mark.parametrize("whole", [0, 1 << 20])
def test_whole_prefixes(spark, monkeypatch, whole):
    """Long conversations (all are, with ``whole`` 0) give what whole prefixes give; an old tool turn that is blanked late is reported."""

    def blanks(turns):
        return "".join(f"[{r}]{'' if r == 'tool' and len(turns) - k > 5 else t}" for k, (r, t) in enumerate(turns))

    monkeypatch.setattr(chat, "WHOLE", whole)
    talk = [("tool", "facts"), *[("user", str(k)) for k in range(6)]]
    assert [w for _, w in chat.checked_spans(blanks, talk, 2)] == [False] * 5 + [True, False]
    for talk in ([("user", "a" * 50), ("assistant", "b|<s>")] * 40, [("user", "")], []):
        want = list(chat.spans(chat.turn_template, talk))
        assert list(chat.streamed_spans(chat.turn_template, iter(talk), 2)) == want == list(chat.checked_spans(chat.turn_template, talk, 2))
        assert "".join(s for s, _ in want) == chat.turn_template(talk)


def test_rewriting_templates_are_reported(spark):
    """Rewrites and offsets come from whole prefixes, whether or not the template passes the probes."""

    def forgets(turns):
        return "".join(f"[{r}]{t if k == len(turns) - 1 else re.sub('<think>.*</think>', '', t)}" for k, (r, t) in enumerate(turns))

    def late(turns):  # drops what tools said once more than five turns have come
        return "".join(f"[{r}]{'' if r == 'tool' and len(turns) - k > 5 else t}" for k, (r, t) in enumerate(turns))

    talks = {1: [("user", "q"), ("assistant", "<think>x</think> y"), ("user", "z"), ("assistant", "w")], 2: [("tool", "facts"), *[("user", str(k)) for k in range(9)]], 3: [("user", "a"), ("user", "b")]}
    df = spark.createDataFrame([(c, k, r, t) for c, turns in talks.items() for k, (r, t) in enumerate(turns)], "conv_id long, turn long, role string, text string")
    for render, rewriting in ((forgets, {(1, 2)}), (late, {(2, 5)})):
        rows = chat.format_chats(df, render=render, loss=lambda span: (span.index("]") + 1, len(span))).collect()
        assert len(rows) == 16 and {(r.conv_id, r.turn) for r in rows if r.rewrites} == rewriting
        for r in rows:
            output = render(talks[r.conv_id][: r.turn + 1])
            assert r.span_end == len(output) and output[r.span_start :] == r.span
            if r.loss_start is not None:
                assert output[r.loss_start : r.loss_end] == talks[r.conv_id][r.turn][1]


def test_chat_edges(spark):
    schema = "conv_id long, turn long, role string, text string, span string"
    rows = [(1, 0, "user", None, "x"), (1, 1, None, "b", "x"), (1, 1, None, "b", "x"), (None, 0, "assistant", "c", "x")]
    got = {r.conv_id: r for r in chat.digests(chat.format_chats(spark.createDataFrame(rows, schema))).collect()}
    assert got[1].n_turns == 3 and got[None].loss_chars == 1
    assert chat.digests(chat.format_chats(spark.createDataFrame([], schema))).count() == 0
