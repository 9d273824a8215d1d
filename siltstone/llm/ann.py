"""Approximate nearest neighbours by learned partitions.

On a bounded sample (``most_rows`` vectors, the first by a hash of their id) a graph of nearest neighbours is cut into parts of
about equal size so that few edges cross. A small network learns the parts of a vector's neighbours from the vector. It places
every row of the table in its likeliest part and routes a query to its several likeliest parts, as many as the sample needs for
the wanted recall. Candidates there are ranked again by the exact cosine, in double precision on the original vectors.

Rows with equal vectors are indexed once with their k + 1 smallest ids, which is all that an answer can hold of them. A part of
many rows or queries is dealt in blocks, so that no task gets more than ``block`` of either.

Null ids, null or zero vectors, vectors with null or non-finite components and vectors of another length than most take no part.
Ties go to smaller ids; rows with a query's id count as the query's own. Empty tables give no rows. Of other columns none is read, so they
may have any names; vectors may be long, a row at a time is decoded.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from siltstone.llm.common import stored


@dataclass
class Router:
    """A network of one hidden layer; scores of the parts for unit vectors."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int

    @property
    def parts(self) -> int:
        return len(self.b2)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2


def unit(x: np.ndarray) -> np.ndarray:
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def nearest(x: np.ndarray, k: int, block: int = 512) -> np.ndarray:
    """The k nearest other rows of each row, unordered."""
    k = min(k, len(x) - 1)
    out = np.zeros((len(x), k), np.int64)
    for a in range(0, len(x), block):
        s = x[a : a + block] @ x.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        out[a : a + block] = np.argpartition(-s, k - 1, axis=1)[:, :k] if k < s.shape[1] else np.arange(s.shape[1])
    return out


def fill(gain: np.ndarray, capacity: int) -> np.ndarray:
    """A part for each row by falling gain, none above ``capacity``."""
    n, parts = gain.shape
    label, room = np.full(n, -1), np.full(parts, capacity)
    choices = np.argsort(-gain, axis=1)
    for depth in range(parts):
        left = np.flatnonzero(label < 0)
        if not len(left):
            break
        wish = choices[left, depth]
        order = np.lexsort((-gain[left, wish], wish))
        left, wish = left[order], wish[order]
        rank = np.arange(len(left)) - np.searchsorted(wish, wish)
        good = rank < room[wish]
        label[left[good]] = wish[good]
        room -= np.bincount(wish[good], minlength=parts)
    return label


def cut_graph(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12, slack: float = 1.1, seed: int = 0) -> np.ndarray:
    """Balanced parts of the graph: a start by balanced centres, then moves to where most neighbours are."""
    rng = np.random.default_rng(seed)
    capacity = int(np.ceil(slack * len(x) / parts))
    centres = x[rng.choice(len(x), parts, replace=False)]
    for _ in range(8):
        label = fill(x @ centres.T, capacity)
        sums = np.zeros((parts, x.shape[1]), np.float32)
        np.add.at(sums, label, x)
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    for _ in range(rounds):
        counts = np.zeros((len(x), parts), np.float32)
        np.add.at(counts, (np.repeat(np.arange(len(x)), graph.shape[1]), label[graph].ravel()), 1)
        counts[np.arange(len(x)), label] += 0.5  # a tie stays where it is
        moved = fill(counts + 0.01 * (x @ centres.T), capacity)
        if (moved == label).all():
            break
        label = moved
    return label


def learn(x: np.ndarray, target: np.ndarray, hidden: int = 128, epochs: int = 40, batch: int = 256, rate: float = 2e-3, seed: int = 0) -> Router:
    """Fits the network to the targets' distributions by Adam on the cross entropy."""
    rng = np.random.default_rng(seed)
    shapes = [(x.shape[1], hidden), (hidden,), (hidden, target.shape[1]), (target.shape[1],)]
    w = [(rng.standard_normal(s) * np.sqrt(2 / s[0]) if len(s) == 2 else np.zeros(s)).astype(np.float32) for s in shapes]
    w[0] *= np.sqrt(x.shape[1]).astype(np.float32)
    m, v, step = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for a in range(0, len(x), batch):
            own = order[a : a + batch]
            h = np.maximum(x[own] @ w[0] + w[1], 0)
            z = h @ w[2] + w[3]
            p = np.exp(z - z.max(1, keepdims=True))
            d = (p / p.sum(1, keepdims=True) - target[own]) / len(own)
            back = (d @ w[2].T) * (h > 0)
            step += 1
            for k, g in enumerate((x[own].T @ back, back.sum(0), h.T @ d, d.sum(0))):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                w[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return Router(*w, probes=1)


def fit(sample: np.ndarray, parts: int, k: int = 5, neighbours: int = 10, recall: float = 0.98, asked: int = 1 << 30, seed: int = 0) -> Router:
    """A router of ``parts`` parts, with as many probes as held-back sample rows need for the recall.

    Room is left for chance (one case in a hundred) in these rows and in the ``asked`` queries; neighbours of one row count as half as many.
    """
    if parts < 2 or len(sample) < 4 * parts:
        return Router(np.zeros((sample.shape[1], 1), np.float32), np.zeros(1, np.float32), np.zeros((1, 1), np.float32), np.zeros(1, np.float32), 1)
    x = unit(sample)
    graph = nearest(x, neighbours)
    label = cut_graph(x, graph, parts, seed=seed)
    target = np.zeros((len(x), parts), np.float32)
    np.add.at(target, (np.repeat(np.arange(len(x)), graph.shape[1]), label[graph].ravel()), 1)
    target[np.arange(len(x)), label] += 1
    target /= target.sum(1, keepdims=True)
    back = np.arange(len(x)) % 10 == 0  # not trained on: their routing says how many parts a new query needs
    router = learn(x[~back], target[~back], seed=seed)
    placed = router.scores(x).argmax(1)
    true = nearest(x, k)[back]
    rank = np.argsort(np.argsort(-router.scores(x[back]), axis=1), axis=1)
    needs = np.take_along_axis(rank, placed[true], axis=1)
    shares = [(needs < p).mean() for p in range(1, parts + 1)]
    room = 2.33 * np.sqrt(2 / needs.size + 2 / (k * max(1, asked)))
    router.probes = next(p for p, s in enumerate(shares, 1) if s - room * np.sqrt(s * (1 - s)) >= recall or p == parts)
    return router


def vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """id, vec (little-endian doubles, binary) and length of the rows that take part."""

    def valid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vecs, sizes = [], [], []
            for key_, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if key_ is None or not x.is_valid or x.values.null_count or not len(x.values):
                    continue
                v = np.asarray(x.values, np.float64)
                if np.isfinite(v).all() and v.any():
                    ids.append(key_)
                    vecs.append(v.tobytes())
                    sizes.append(len(v))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(vecs, pa.binary()), pa.array(sizes, pa.int32())], names=["id", "vec", "length"])

    return df.select(F.col(f"`{key}`").cast("long"), F.col(f"`{vector}`")).mapInArrow(valid, "id long, vec binary, length int")


def classes(rows: DataFrame, keep: int) -> DataFrame:
    """vec and its ``keep`` smallest ids, for each different vector. Tasks send only so many ids of a vector on."""

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[bytes, list[int]] = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(own.keys(), pa.binary()), pa.array(own.values(), pa.list_(pa.int64()))], names=["vec", "ids"])

        for batch in batches:
            for key, vec in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = own.setdefault(vec, [])
                if key not in ids:
                    ids.append(key)
                    if len(ids) > keep:
                        ids.remove(max(ids))
            if len(own) > 1 << 17:
                yield out()
                own.clear()
        yield out()

    some = rows.select("id", "vec").mapInArrow(least, "vec binary, ids array<long>")
    return some.groupBy("vec").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep).alias("ids"))


def routed(rows: DataFrame, router: Router, probes: int) -> DataFrame:
    """``rows`` (vec first) with part: one row for each of the ``probes`` likeliest parts."""
    held = rows.sparkSession.sparkContext.broadcast(router)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = unit(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.float64).reshape(batch.num_rows, -1))
            best = np.argsort(-held.value.scores(x), axis=1, kind="stable")[:, :probes]
            again = batch.take(pa.array(np.repeat(np.arange(len(x)), best.shape[1])))
            yield pa.RecordBatch.from_arrays([*again.columns, pa.array(best.ravel().astype(np.int32))], names=[*again.schema.names, "part"])

    return rows.mapInArrow(place, StructType([*rows.schema, StructField("part", IntegerType())]))


def rerank(k: int):
    """Of a block of candidates and one of queries, each query's best k by the exact cosine."""

    def ranked(index: pa.Table, wanted: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if index.num_rows and wanted.num_rows:
            x, q = (np.frombuffer(b"".join(t.column("vec").to_pylist()), np.float64).reshape(t.num_rows, -1) for t in (index, wanted))
            nx, nq = np.sqrt((x * x).sum(1)), np.sqrt((q * q).sum(1))
            ids, keys = index.column("ids").to_pylist(), wanted.column("vec").to_pylist()
            first = np.array([i[0] for i in ids])
            some = min(k + 8, len(x))
            for a in range(0, len(q), 256):
                s = (q[a : a + 256] / nq[a : a + 256, None]) @ (x / nx[:, None]).T
                best = np.argpartition(-s, some - 1, axis=1)[:, :some] if some < len(x) else np.tile(np.arange(len(x)), (len(s), 1))
                for j, own in enumerate(best, a):
                    exact = (x[own] * q[j]).sum(1) / (nx[own] * nq[j])
                    for c in np.lexsort((first[own], -exact))[:k]:
                        out[0].append(keys[j])
                        out[1].append(float(exact[c]))
                        out[2].append(ids[own[c]])
        return pa.table([pa.array(out[0], pa.binary()), pa.array(out[1], pa.float64()), pa.array(out[2], pa.list_(pa.int64()))], names=["query", "score", "ids"])

    return ranked


def search(df: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 50, k: int = 5, most_rows: int = 12000, rows_a_part: int = 512, most_parts: int = 256, block: int = 4096, recall: float = 0.9) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row whose id is divisible by ``every``."""
    spark = df.sparkSession
    rows = stored(vectors(df, key, vector), "vectors")
    lengths = rows.groupBy("length").count().orderBy(F.desc("count"), "length").limit(1).collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if not lengths:
        return spark.createDataFrame([], schema)
    rows = rows.filter(F.col("length") == lengths[0]["length"])
    index = stored(classes(rows, k + 1), "vector-classes")
    sample = index.orderBy(F.xxhash64("vec"), "vec").limit(most_rows).select("vec").collect()
    x = np.frombuffer(b"".join(bytes(r.vec) for r in sample), np.float64).reshape(len(sample), -1)
    parts = min(most_parts, max(16, round(index.count() / rows_a_part))) if len(x) >= 200 else 1
    wanted = rows.filter(F.col("id") % every == 0).select("vec").distinct()
    router = fit(x, parts, k, recall=recall, asked=wanted.count())
    placed = routed(index, router, 1)
    asked = routed(wanted, router, router.probes)
    sizes = spark.createDataFrame(placed.groupBy("part").count().collect(), "part int, rows long").join(spark.createDataFrame(asked.groupBy("part").count().collect(), "part int, queries long"), "part", "left")
    blocks = F.broadcast(sizes.select("part", F.ceil(F.col("rows") / block).cast("int").alias("rb"), F.greatest(F.ceil(F.coalesce("queries", F.lit(0)) / block), F.lit(1)).cast("int").alias("qb")))  # a row a part

    def dealt_out(of: DataFrame, own: str, other: str) -> DataFrame:
        """Each row in one block of its own side, and once for each block of the other."""
        dealt = of.join(blocks, "part").withColumn(own[0], F.pmod(F.xxhash64("vec"), F.col(own)).cast("int"))
        return dealt.withColumn(other[0], F.explode(F.sequence(F.lit(0), F.col(other) - 1))).drop("rb", "qb")

    left, right = dealt_out(placed, "rb", "qb"), dealt_out(asked, "qb", "rb")
    found = left.groupBy("part", "r", "q").cogroup(right.groupBy("part", "r", "q")).applyInArrow(rerank(k + 1), "query binary, score double, ids array<long>")
    # Of each query's vector the best k + 1 classes of equal vectors, as one short list.
    best = found.groupBy("query").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("far"), "ids"))), 1, k + 1).alias("best"))
    asking = rows.filter(F.col("id") % every == 0).select(F.col("id").alias("query_id"), F.col("vec").alias("query")).distinct()
    answers = F.transform(F.col("best"), lambda b: F.transform(b.ids, lambda i: F.struct(b.far.alias("far"), i.alias("vec_id"))))
    top = F.slice(F.array_sort(F.filter(F.flatten(answers), lambda a: a.vec_id != F.col("query_id"))), 1, k)
    listed = asking.join(best, "query").select("query_id", F.posexplode(top).alias("at", "hit"))
    return listed.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.far")).alias("score"))
