"""Quality classifier: naive Bayes support vectors.

A text's features are indicators of its word 1- and 2-grams and of the 1- to 3-grams of its word shapes (letters, case, digits
and signs; whether a word repeats the one before), hashed to ``buckets`` places. Indicators are scaled by the log ratio of the
two classes' smoothed counts; a linear model with hinge loss is fitted to them by dual coordinate descent, and a logistic curve
on held-back training rows turns its margins into probabilities. The model is fitted on at most ``most_rows`` labelled rows, the
first by a hash of their key, and on no more of them than name ``most_places`` places, so that very long texts don't fill the driver; its
size is fixed by ``buckets``, so it is broadcast. Scoring reads every row's whole text, in memory of its length.

Null or empty texts have no feature and get the model's base rate. Rows without label, with null label or null key don't train, nor do
labels without a document. Without rows of both classes, as of empty tables, every score is the mean label (0.5 without any).
Repeated rows get equal scores. Other columns pass by, whatever their names, but for a column named as the score, which is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from siltstone.llm.common import bounded_batches, scratch, slices, stored, text_of
from siltstone.llm.words import PLACES, WordHashes, grams, hold, mixed


def shape(word: str) -> str:
    """``word`` with runs of letters as x (X when all are capitals, Xx when the first is), digits as 9, repeated signs twice."""
    s = re.sub(r"[^\W\d_]+", lambda m: "X" if m[0].isupper() and len(m[0]) > 1 else "Xx" if m[0][0].isupper() else "x", word)
    return re.sub(r"([^\w\s])\1+", r"\1\1", re.sub(r"\d+", "9", s))


class Words(WordHashes):
    """Hashes whose low 16 bits are the shape's, so that one look-up gives both."""

    def __missing__(self, word: str) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word.lower()) & ~0xFFFF | xxhash.xxh3_64_intdigest(shape(word)) & 0xFFFF
        return value


WORDS = Words()


def features(text: str, buckets: int) -> np.ndarray:
    """The places of the text's indicators, sorted, each once."""
    both = WORDS.of(text.split())
    if not len(both):
        return np.zeros(0, np.uint32)
    words, shapes = both & ~np.uint64(0xFFFF), both & np.uint64(0xFFFF)
    repeats = np.zeros(len(both), np.uint64)
    repeats[1:] = words[1:] == words[:-1]
    shapes = shapes | repeats << np.uint64(16)
    found = [mixed(words * PLACES[5]), mixed(shapes * PLACES[6])]
    if len(both) > 1:
        found += [grams(words, 2), grams(shapes, 2) ^ PLACES[7]]
    if len(both) > 2:
        found.append(grams(shapes, 3) ^ PLACES[8])
    return np.unique((np.concatenate(found) & np.uint64(buckets - 1)).astype(np.uint32))


@dataclass
class Model:
    weights: np.ndarray  # of indicators, the class ratios within
    ratios: np.ndarray
    bias: float
    slope: float
    shift: float
    buckets: int

    def margin(self, places: np.ndarray) -> float:
        if not len(places):
            return self.bias
        return float(self.weights[places].sum(dtype=np.float64) / max(np.sqrt((self.ratios[places] ** 2).sum(dtype=np.float64)), 1e-12)) + self.bias

    def score(self, places: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(places) + self.shift, -500, 500))))


def logistic(margins: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of the logistic curve through (margin, label), by Newton's method with smoothed targets."""
    up, down = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, float(np.log((up + 1) / (down + 1)))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -500, 500)))
        g, w = p - target, p * (1 - p) + 1e-9
        h = np.array([[(w * margins**2).sum() + 1e-6, (w * margins).sum()], [(w * margins).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, [(g * margins).sum(), g.sum()])
        a, b = a - np.clip(step[0], -2, 2), b - np.clip(step[1], -2, 2)
    return max(float(a), 1e-6), float(b)


def dual_descent(rows: list[np.ndarray], y: np.ndarray, ratios: np.ndarray, cost: float, epochs: int, seed: int) -> tuple[np.ndarray, float]:
    """Weights (on scaled, normed indicators) and bias of the hinge-loss model, one dual variable for each row."""
    norms = np.array([max(np.sqrt((ratios[r] ** 2).sum()), 1e-12) for r in rows])
    w, bias, alpha, rng = np.zeros(len(ratios)), 0.0, np.zeros(len(rows)), np.random.default_rng(seed)
    costs = np.where(y > 0, cost, cost * min(10.0, max(1.0, (y > 0).sum() / max(1, (y <= 0).sum()))))
    for _ in range(epochs):
        most = 0.0
        for i in rng.permutation(len(rows)):
            r = rows[i]
            x = ratios[r] / norms[i]
            gradient = y[i] * (w[r] @ x + bias) - 1
            new = min(max(alpha[i] - gradient / ((1.0 if len(r) else 0.0) + 1.0), 0.0), costs[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[r] += step * x
                bias += step
                alpha[i] = new
                most = max(most, abs(step))
        if most < 1e-4:
            break
    return w, bias


def fit(rows: list[np.ndarray], labels: list[int], buckets: int, cost: float = 1.0, epochs: int = 20, smooth: float = 1.0, seed: int = 0) -> Model:
    y = np.where(np.array(labels, int) > 0, 1, -1)
    zeros = np.zeros(buckets, np.float32)
    if not len(rows) or abs(y.sum()) == len(y):
        mean = min(max((y > 0).mean() if len(y) else 0.5, 1e-6), 1 - 1e-6)
        return Model(zeros, zeros, 0.0, 1.0, float(np.log(mean / (1 - mean))), buckets)
    counts = {k: np.full(buckets, smooth) for k in (1, -1)}
    for r, t in zip(rows, y, strict=True):
        counts[t][r] += 1  # a row names each place once
    ratios = np.log(counts[1] / counts[1].sum()) - np.log(counts[-1] / counts[-1].sum())
    ratios[(counts[1] + counts[-1]) < 2 * smooth + 3] = 0  # seen fewer than three times: says nothing
    back = np.arange(len(rows)) % 5 == 4
    if len({*y[back]}) < 2 or len({*y[~back]}) < 2:
        back[:] = False

    def model(chosen: np.ndarray) -> Model:
        w, bias = dual_descent([rows[i] for i in np.flatnonzero(chosen)], y[chosen], ratios, cost, epochs, seed)
        return Model((w * ratios).astype(np.float32), ratios.astype(np.float32), float(bias), 1.0, 0.0, buckets)

    part = model(~back)
    judged = back if back.any() else ~back
    slope, shift = logistic(np.array([part.margin(rows[i]) for i in np.flatnonzero(judged)]), y[judged])
    whole = model(np.ones(len(rows), bool)) if back.any() else part
    whole.slope, whole.shift = slope, shift
    return whole


def in_fold(key: Column, folds: int = 5) -> Column:
    """Whether a row is held out: crc32 of its key as text leaves no rest. Null keys are not."""
    return F.coalesce(F.crc32(key.cast("string")) % folds == 0, F.lit(False))


def first_labels(docs: DataFrame, chosen: DataFrame, most_rows: int) -> DataFrame:
    """The first ``most_rows`` rows of ``chosen`` (key, label) whose key some document has, by a hash of the key."""
    order = F.xxhash64("key"), F.col("key")
    keys = docs.select("key").filter("key is not null")
    some = chosen.orderBy(*order).limit(4 * most_rows)
    found = stored(keys.join(F.broadcast(some), "key", "left_semi").distinct(), "label-keys")  # at most 4 * most_rows keys
    if found.limit(most_rows).count() < most_rows and chosen.limit(4 * most_rows + 1).count() > 4 * most_rows:
        found = keys.join(chosen.select("key"), "key", "left_semi").distinct()
    return chosen.join(found, "key", "left_semi").orderBy(*order).limit(most_rows)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", key: str = "doc_id", most_rows: int = 8000, most_places: int = 16_000_000, buckets: int = 1 << 18) -> Model:
    """A model from at most ``most_rows`` labelled rows outside the held-out fold, as many as name ``most_places`` places (4 bytes each) at most."""
    chosen = labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").cast("int").alias("label")).filter(F.col("key").isNotNull() & F.col("label").isNotNull() & ~in_fold(F.col("key")))
    chosen = chosen.groupBy("key").agg(F.min("label").alias("label"))
    texts = docs.select(F.col(f"`{key}`").alias("key"), text_of(text).alias("text"))

    def indicators(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold(WORDS)
        for part, own in slices(batches, 1):
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array([features(t, buckets).tobytes() for t in own], pa.binary())], names=["key", "label", "places"])

    with scratch(docs.sparkSession):
        rows = texts.join(F.broadcast(first_labels(texts, chosen, most_rows)), "key").select("key", "text", "label")
        found = stored(bounded_batches(rows).mapInArrow(indicators, f"key {texts.schema[0].dataType.simpleString()}, label int, places binary"), "indicators")
        place = F.struct(F.xxhash64("key"), F.xxhash64("places"))
        sizes = found.select(place.alias("place"), F.octet_length("places").alias("size")).orderBy("place").limit(most_rows).collect()
        last = [r.place for r, total in zip(sizes, accumulate(r["size"] for r in sizes), strict=True) if total <= 4 * most_places][-1:]
        got = found.filter(place <= F.struct(*map(F.lit, last[0]))).orderBy(place).limit(most_rows).select("places", "label").toArrow().to_pydict() if last else {"places": [], "label": []}
    return fit([np.frombuffer(p, np.uint32) for p in got["places"]], got["label"], buckets)


def scored(docs: DataFrame, model: Model, text: str = "text", out: str = "quality_score") -> DataFrame:
    """``docs`` with the column ``out`` (0 to 1, higher: label 1 likelier); a column of that name is replaced."""
    docs = bounded_batches(docs).drop(out)
    held = docs.sparkSession.sparkContext.broadcast(model)
    place = len(docs.columns)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        hold(WORDS)
        for part, texts in slices(batches, place):
            scores = pa.array([own.score(features(t, own.buckets)) for t in texts], pa.float64())
            yield pa.RecordBatch.from_arrays([*part.columns[:place], scores], names=[*part.schema.names[:place], out])

    return docs.select("*", text_of(text).alias("its text")).mapInArrow(judged, StructType([*docs.schema, StructField(out, DoubleType())]))
