"""The classifier against plain solvers, and the registered query against a plain version of the whole method."""

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.llm import nbsvm, queries


def plain_dual(x, y, costs, rounds=60_000):
    """The hinge loss's dual by projected gradient steps on the whole matrix; the bias is one more feature."""
    z = np.c_[x, np.ones(len(x))] * y[:, None]
    gram = z @ z.T
    step, alpha = 1 / np.linalg.eigvalsh(gram).max(), np.zeros(len(x))
    for _ in range(rounds):
        alpha = np.clip(alpha + step * (1 - gram @ alpha), 0, costs)
    w = z.T @ alpha
    return w[:-1], w[-1]


def plain_logistic(margins, y, rounds=20_000):
    """Slope and shift by plain gradient descent on the smoothed targets."""
    up, down = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    a, b, scale = 0.0, 0.0, max(1.0, float((margins**2).mean()))
    for _ in range(rounds):
        gap = 1 / (1 + np.exp(-(a * margins + b))) - target
        a, b = a - (gap * margins).mean() / scale, b - gap.mean() / scale
    return a, b




def indicators(text):
    """The named n-grams of words and shapes that the docstring lists."""
    own = text.split()
    low = [w.lower() for w in own]
    shapes = [(nbsvm.shape(w), k > 0 and low[k - 1] == low[k]) for k, w in enumerate(own)]
    grams = lambda of, n: {(n, *of[k : k + n]) for k in range(len(of) - n + 1)}
    return {("w", g) for n in (1, 2) for g in grams(low, n)} | {("s", g) for n in (1, 2, 3) for g in grams(shapes, n)}


@pytest.mark.parametrize("seed", range(4))
def test_dual_descent(seed):
    rng = np.random.default_rng(seed)
    ratios, y = rng.standard_normal(30), np.where(rng.random(40) < (0.5, 0.2)[seed % 2], -1, 1)
    rows = [np.flatnonzero(rng.random(30) < 0.3) for _ in y]
    rows[3] = np.zeros(0, int)
    x = np.zeros((len(y), 30))
    for k, r in enumerate(rows):
        x[k, r] = ratios[r] / max(np.sqrt((ratios[r] ** 2).sum()), 1e-12)
    costs = np.where(y > 0, 1.0, min(10.0, max(1.0, (y > 0).sum() / (y < 0).sum())))
    w, bias = nbsvm.dual_descent(rows, y, ratios, 1.0, 5000, seed)
    plain, plain_bias = plain_dual(x, y, costs)
    assert np.allclose(w, plain, atol=5e-3) and bias == pytest.approx(plain_bias, abs=5e-3)


def test_logistic():
    rng = np.random.default_rng(0)
    margins = rng.standard_normal(300) * 2
    y = np.where(margins + rng.standard_normal(300) > 0.3, 1, -1)
    assert nbsvm.logistic(margins, y) == pytest.approx(plain_logistic(margins, y), abs=0.01)


@pytest.mark.parametrize("text", ["", "one", "One two  TWO two 3.14!!! a1b2", "naïve — Été 漢字 漢字 漢字 ...", "\tx\ny\x1cz "])
def test_features(text):
    """As many places as there are different named n-grams, and the same for the same text only."""
    assert len(nbsvm.features(text, 1 << 31)) == len(indicators(text))


def test_op8(spark, sf_dir):
    """The query's scores against log-count ratios, projected gradient and logistic descent on whole matrices."""
    rows = {r.doc_id: r.text or "" for r in queries.table(spark, sf_dir, "documents").collect()}
    labels = queries.table(spark, sf_dir, "labels").filter("quality is not null").select("doc_id", "quality").orderBy(F.xxhash64("doc_id")).collect()
    fold = lambda key: zlib.crc32(str(key).encode()) % 5 == 0
    train = [(rows[r.doc_id], r.quality) for r in labels if r.doc_id in rows and not fold(r.doc_id)]
    texts, y = [t for t, _ in train], np.where(np.array([q for _, q in train]) > 0, 1, -1)
    named = [indicators(t) for t in texts]
    at = {n: k for k, n in enumerate(sorted(set().union(*named), key=str))}
    seen = np.zeros((len(texts), len(at)))
    for k, own in enumerate(named):
        seen[k, [at[n] for n in own]] = 1
    up, down = seen[y > 0].sum(0) + 1, seen[y < 0].sum(0) + 1
    # Smoothing also counts the empty places of the operator's table.
    ratios = np.log(up / (up.sum() + (1 << 18) - len(at))) - np.log(down / (down.sum() + (1 << 18) - len(at)))
    ratios[up + down < 5] = 0
    scaled = lambda m: m * ratios / np.maximum(np.sqrt((m * ratios**2).sum(1, keepdims=True)), 1e-12)
    costs = np.where(y > 0, 1.0, min(10.0, max(1.0, (y > 0).sum() / (y < 0).sum())))
    back = np.arange(len(y)) % 5 == 4
    part, bias = plain_dual(scaled(seen[~back]), y[~back], costs_of(y[~back]), 5000)
    slope, shift = plain_logistic(scaled(seen[back]) @ part + bias, y[back])
    w, bias = plain_dual(scaled(seen), y, costs, 5000)
    got = queries.op8_quality_classifier(spark, sf_dir).collect()
    assert len(got) == len(rows)
    gaps = []
    for r in got:
        own = np.zeros((1, len(at)))
        own[0, [at[n] for n in indicators(rows[r.doc_id]) if n in at]] = 1
        want = 1 / (1 + np.exp(-(slope * float(scaled(own)[0] @ w + bias) + shift)))
        gaps.append(abs(r.score - want))
        assert r.held_out == fold(r.doc_id) and r.predicted == (r.score >= 0.3)
    # Places are shared by some n-grams, which the named features are not.
    assert np.mean(gaps) < 0.03 and np.quantile(gaps, 0.95) < 0.1


def costs_of(y):
    return np.where(y > 0, 1.0, min(10.0, max(1.0, (y > 0).sum() / max(1, (y < 0).sum()))))


def test_bounds(spark):
    """Labels without a document don't use up the sample; places are bounded; hard tables train and score."""
    docs = [(k, ("good words here " if k % 2 else "bad bad 777 !!! ") * (1 + k % 3), 0.5) for k in range(60)]
    labels = [(k, k % 2) for k in range(60)] + [(k, 1) for k in range(1000, 3000)] + [(None, 1), (5, None)]
    frame = spark.createDataFrame(docs + [(None, "x", 0.1), (7, None, 0.1), (61, "word " * 50_000, 0.1)], "doc_id long, text string, quality_score double")
    marked = spark.createDataFrame(labels, "doc_id long, quality int")
    for limits in ({"most_rows": 45}, {"most_rows": 10}, {"most_places": 200}):
        model = nbsvm.train(frame, marked, **limits)
        got = nbsvm.scored(frame, model)
        assert got.columns == frame.columns and got.count() == 63
        known = {r.doc_id: r.quality_score for r in got.filter("text is not null and doc_id < 60").collect()}
        assert "most_rows" not in limits or all((s >= 0.5) == bool(k % 2) for k, s in known.items())
    assert nbsvm.train(frame, marked, most_places=0).bias == 0.0
    assert re.match("xx*", nbsvm.shape("abc"))
