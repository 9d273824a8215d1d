import itertools
import math
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from siltstone.llm import sampling

PATH = public_tokenizers.path("piece_bpe_32k.model")
TOY = sampling.Model({p: (k, s) for k, (p, s) in enumerate({"▁": -1.5, "a": -2.0, "b": -2.2, "▁a": -1.2, "ab": -1.1, "ba": -1.4, "aba": -2.1, "▁▁": -2.5}.items())}, {}, 99)


def segmentations(text, model=TOY):
    """{ids: probability} of all paths, listed one by one."""
    names = {p: (int(model.piece[v]), float(model.score[v])) for p, v in walk(model).items() if model.piece[v] >= 0}
    out = {}

    def go(at, ids, score):
        if at == len(text):
            out[tuple(ids)] = score
        for end in range(at + 1, len(text) + 1):
            if text[at:end] in names:
                k, s = names[text[at:end]]
                go(end, [*ids, k], score + s)
        if text[at : at + 1] and text[at] not in names:
            go(at + 1, [*ids, model.unknown], score + model.unknown_score)

    go(0, [], 0.0)
    total = math.log(sum(map(math.exp, out.values())))
    return {k: s - total for k, s in out.items()}


def walk(model):
    found, states = {}, {0: ""}
    used = [(int(k), int(t)) for k, t in zip(model.keys, model.targets, strict=True) if k >= 0]
    while states:
        states = {t: states[k >> 21] + chr(k & 0x1FFFFF) for k, t in used if k >> 21 in states}
        found |= {p: s for s, p in states.items()}
    return found


@pytest.mark.parametrize("text", ["ab", "aba b", "a  ab", " b", "abcab", "baba"])
def test_all_paths(text):
    """With k beyond their number all segmentations come, each once, with inclusion 1 and their probabilities."""
    want = segmentations("▁" + text.replace(" ", "▁"))
    got = sampling.sample(TOY, [text], [7], 10_000)[0]
    assert {tuple(ids): pytest.approx(lp) for ids, lp, _, _ in got} == want and len(got) == len(want)
    assert all(q == 0 for *_, q in got) and [g for *_, g, _ in got] == sorted((g for *_, g, _ in got), reverse=True)


def test_distribution():
    """First draws follow the probabilities, pairs those of draws without replacement, weights 1 / inclusion make sums unbiased."""
    text, n = "abab a", 6000
    want = {k: math.exp(s) for k, s in segmentations("▁abab▁a").items()}
    drawn = sampling.sample(TOY, [text] * n, list(range(n)), 3)
    first = Counter(tuple(d[0][0]) for d in drawn)
    pairs = Counter((tuple(d[0][0]), tuple(d[1][0])) for d in drawn)
    assert all(len({tuple(x[0]) for x in d}) == 3 for d in drawn)
    close = lambda seen, p: abs(seen / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 4 / n
    assert all(close(first[k], p) for k, p in want.items())
    assert all(close(pairs[a, b], want[a] * want[b] / (1 - want[a])) for a, b in itertools.permutations(want, 2))
    total = np.mean([sum(math.exp(lp - q) for _, lp, _, q in d) for d in drawn])
    assert abs(total - 1) < 0.03


def test_independent_of_batches():
    texts = ["ab a", "baba", "", "abc\n", "a b a b"]
    whole = sampling.sample(TOY, texts, [1, 2, 3, 4, 5], 2)
    for t, k, w in zip(texts, [1, 2, 3, 4, 5], whole, strict=True):
        for a, b in zip(sampling.sample(TOY, [t], [k], 2)[0], w, strict=True):
            assert list(a[0]) == list(b[0]) and a[1:] == pytest.approx(b[1:])


def test_round_trip(spark, sf_dir):
    """Every sampled segmentation of every document decodes to its text; hard texts too."""
    hard = [None, "", "  two  spaces ", "tab\t\nline", "漢字🦄é́", "▁", "x" * 3000, "word " * 3000, "ab", "ab"]
    rows = [(k, t, 1, "s") for k, t in enumerate(hard)] + [(r.doc_id + 100, r.text, 1, "s") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    df = spark.createDataFrame([*rows, (None, "ab", 1, "s")], "doc_id long, text string, sample int, ids string")
    got = sampling.decoded(sampling.sampled(df, PATH, k=2), PATH, out="back").collect()
    texts = {r[0]: (r[1] or "").replace("▁", " ") for r in rows} | {None: "ab"}
    assert all(r.back == texts[r.doc_id] and r.n_pieces == len(r.ids) for r in got)
    assert {r.doc_id for r in got} == {*texts} and len({(r.doc_id, r.sample, tuple(r.ids)) for r in got}) == len(got)
    assert sampling.sampled(df.filter("false"), PATH).count() == 0


def test_scores_against_library():
    """On a chain model no piece crosses words, and the library's own encoding is one of the lattice's paths."""
    p = sentencepiece.SentencePieceProcessor(model_file=PATH)
    model = sampling.Model.at(PATH, 1.0)
    assert model.chain
    text = "hello wide  world\n"
    all_ids = {tuple(map(int, ids)) for ids, *_ in sampling.sample(model, ["hello"], [0], 500)[0]}
    assert tuple(p.encode("hello")) in all_ids
    for ids, *_ in sampling.sample(model, [text], [0], 5)[0]:
        assert p.decode([int(k) for k in ids]) == text
