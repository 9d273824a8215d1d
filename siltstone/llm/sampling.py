"""SentencePiece decoding, and encoding by Gumbel top-k sampling without replacement.

A text's segmentations are the paths of a lattice of pieces. Each path has a Gumbel-perturbed log probability; the k largest
are k distinct segmentations drawn without replacement. They are found by an A-star search over sets of paths: the best path
of a set is drawn by walking the lattice with exact suffix sums, the rest of the set is split at each node of that path, and
each part gets the largest perturbed value of its paths, truncated at the set's own. The search's bounds are exact, so the k
first paths taken from the queue are the answer, and the next bound is the threshold that gives inclusion probabilities. With
-log(time) for a Gumbel value, a part of mass m adds an exponential waiting time of rate m; that is how it is coded.

No piece crosses a word's beginning, so the lattice is a chain of word lattices: those are built once for each different
word of a batch, all words at a time. Random numbers are hashes of (row key, path, place): they depend on the row alone, not
on batches, tasks or retries. Rows with equal key and text draw the same segmentations.

Scores: a unigram model's own. A BPE model has merge ranks instead; they count as Zipf frequencies, p ~ 1 / (rank + 2.7).
Characters outside the vocabulary become byte pieces (or the unknown piece) at the least score less 10.

Null or empty texts have one segmentation, without pieces. A text of fewer than k segmentations gives them all, with inclusion 1.
An empty table gives no rows. A very long text is sampled whole, in memory of its length and that of its different words' lattices.
Of other columns only the key is read, so they may have any names.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import bounded_batches, slices, text_of
from siltstone.llm.words import PLACES, mixed

SPACE = "▁"
LONG = 48
STEPS = np.arange(4096, dtype=np.uint64)


class Model:
    """Pieces, their log probabilities and a trie over them."""

    _made: dict[tuple[str, float], Model] = {}

    @classmethod
    def at(cls, path: str, alpha: float) -> Model:
        if (path, alpha) not in cls._made:
            import sentencepiece

            p = sentencepiece.SentencePieceProcessor(model_file=path)
            n = p.get_piece_size()
            normal = [k for k in range(n) if not (p.is_control(k) or p.is_unknown(k) or p.is_unused(k) or p.is_byte(k))]
            bytes_ = {int(p.id_to_piece(k)[1:-1], 16): k for k in range(n) if p.is_byte(k)}
            cls._made[path, alpha] = cls({p.id_to_piece(k): (k, p.get_score(k)) for k in normal}, bytes_, p.unk_id(), alpha)
        return cls._made[path, alpha]

    def __init__(self, pieces: dict[str, tuple[int, float]], bytes_: dict[int, int], unknown: int, alpha: float = 1.0) -> None:
        self.bytes, self.unknown = bytes_, unknown
        scores = np.array([s for _, s in pieces.values()])
        if (scores == np.round(scores)).all() and len(scores) > 1:  # merge ranks
            rank = np.empty(len(scores))
            rank[np.argsort(-scores, kind="stable")] = np.arange(len(scores))
            scores = -np.log(rank + 2.7) + np.log((1 / (np.arange(len(scores)) + 2.7)).sum())
        self.unknown_score = alpha * (scores.min() - 10)
        ids = {p: k for k, p in enumerate([""])}
        for piece in pieces:
            for k in range(1, len(piece) + 1):
                ids.setdefault(piece[:k], len(ids))
        self.shift = 48 - max(10, (2 * len(ids)).bit_length())  # at most half of the slots are taken
        self.keys, self.targets = np.full(1 << 48 - self.shift, -1, np.int64), np.zeros(1 << 48 - self.shift, np.int64)
        for p, v in ids.items():
            if p:
                key = ids[p[:-1]] << 21 | ord(p[-1])
                at = self.slot(key)
                while self.keys[at] >= 0:
                    at = at + 1 & len(self.keys) - 1
                self.keys[at], self.targets[at] = key, v
        self.piece, self.score = np.full(len(ids), -1, np.int32), np.zeros(len(ids))
        for (p, (k, _)), s in zip(pieces.items(), scores, strict=True):
            self.piece[ids[p]], self.score[ids[p]] = k, alpha * s
        #: The id of a lost character, if one piece says it: by code, 128 for all others.
        self.lost = np.array([*(bytes_.get(c, -1) for c in range(128)), -1] if bytes_ else [unknown] * 129, np.int32)
        self.longest = max(map(len, pieces))
        self.inside = {a + b for p in pieces for a, b in zip(p, p[1:], strict=False)}
        self.chain = not any(SPACE in p.lstrip(SPACE) for p in pieces)

    def slot(self, key):
        """Where the table of transitions has a key, or the first place to look."""
        return (key * 0x9E3779B1 & 0xFFFFFFFFFFFF) >> self.shift

    def step(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the keys (state, character) the trie has, and the states they lead to."""
        at = self.slot(key)
        there = self.keys[at]
        odd = np.flatnonzero((there != key) & (there >= 0))
        while len(odd):
            at[odd] = at[odd] + 1 & len(self.keys) - 1
            there[odd] = self.keys[at[odd]]
            odd = odd[(there[odd] != key[odd]) & (there[odd] >= 0)]
        good = np.flatnonzero(there == key)
        return good, self.targets[at[good]]

    def words(self, text: str) -> list[str]:
        """The text, spaces as SPACE and one before it, in parts that no piece crosses."""
        if not self.chain:
            return [SPACE + text.replace(" ", SPACE)]
        parts = [SPACE + w for w in text.split(" ")] if "  " not in text and text[:1] != " " and SPACE not in text else re.findall(f"{SPACE}+[^{SPACE}]*", SPACE + text.replace(" ", SPACE))
        if max(map(len, parts)) <= LONG:
            return parts
        out = []
        for part in parts:
            if len(part) <= LONG:
                out.append(part)
                continue
            begin = 0
            for k in range(1, len(part)):
                if part[k - 1 : k + 1] not in self.inside:
                    out.append(part[begin:k])
                    begin = k
            out.append(part[begin:])
        return out


class Lattice:
    """The lattices of many words side by side. A word of n characters has n + 1 nodes; a node's edges stand together."""

    def __init__(self, model: Model, words: list[str]) -> None:
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        begins = np.cumsum(sizes) - sizes
        word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        self.first = begins + np.arange(len(words))  # node of each word's beginning
        self.last = self.first + sizes
        far = (begins + sizes)[word] - np.arange(len(codes))  # from a place to its word's end
        level = []
        at, state, count = np.arange(len(codes)), np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64)
        for length in range(1, model.longest + 1):
            good = far[at] >= length
            at, state = at[good], state[good]
            good, state = model.step(state << 21 | codes[at + length - 1])
            at = at[good]
            own = model.piece[state]
            good = np.flatnonzero(own >= 0)
            level.append((length, at[good], own[good], model.score[state[good]]))
            if length == 1:  # characters without a piece of their own
                alone = np.ones(len(codes), bool)
                alone[level[0][1]] = False
                lost = np.flatnonzero(alone)
                level.append((1, lost, model.lost[np.minimum(codes[lost], 128)], np.full(len(lost), model.unknown_score)))
            for _, src, *_ in level[-2:] if length == 1 else level[-1:]:
                count[src] += 1
            if not len(at):
                break
        # Places by their distance from the word's end; a place's edges stand together, shortest first.
        order = np.argsort(far.astype(np.uint16) if len(far) and far.max() < 1 << 16 else far, kind="stable")
        after = np.cumsum(count[order])
        slot = np.empty(len(codes), np.int64)
        slot[order] = after - count[order]
        total = int(after[-1]) if len(after) else 0
        own_place, own_count = order[count[order] > 0], count[order][count[order] > 0]
        node, away = (np.repeat(x[own_place].astype(np.int32), own_count) for x in (np.arange(len(codes)) + word, far))
        size, self.piece, logw, self.char = np.empty(total, np.int32), np.empty(total, np.int32), np.empty(total), np.zeros(total, np.int32)
        for k, (length, src, own, score) in enumerate(level):
            to = slot[src]
            slot[src] += 1
            size[to], self.piece[to], logw[to] = length, own, score
            if k == 1:
                self.char[to] = codes[src]
        self.dst = node + size
        del level, order, after, slot, count
        starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
        own = node[starts]
        self.begin = np.zeros(len(codes) + len(words), np.int64)
        self.end = np.zeros_like(self.begin)
        self.begin[own], self.end[own] = starts, np.r_[starts[1:], len(node)]
        beta = np.zeros(len(self.begin))
        levels = np.r_[np.flatnonzero(np.r_[True, away[1:] != away[:-1]]), len(away)]
        edge_start = np.searchsorted(starts, levels)
        for k in range(len(levels) - 1):  # by distance from the word's end
            a, b = levels[k], levels[k + 1]
            cut = starts[edge_start[k] : edge_start[k + 1]] - a
            x = logw[a:b] + beta[self.dst[a:b]]
            top = np.maximum.reduceat(x, cut)
            counts = np.diff(np.r_[cut, b - a])
            beta[own[edge_start[k] : edge_start[k + 1]]] = top + np.log(np.add.reduceat(np.exp(x - np.repeat(top, counts)), cut))
        self.logq = logw + beta[self.dst] - beta[node]  # of an edge, given its node
        self.q = np.exp(self.logq)
        self.source = node
        self.rest = np.where((self.end - self.begin)[node] > 1, np.maximum(1 - self.q, 0), 0.0)  # chance to take another edge
        self.ends = away[: len(node)] == size  # edges to a word's end
        # A node's likeliest edge is tried first; the others stand in one running sum.
        counts = np.diff(np.r_[starts, len(node)])
        top = np.maximum.reduceat(self.q, starts) if len(node) else np.zeros(0)
        self.best, self.best_q = np.zeros(len(self.begin), np.int64), np.zeros(len(self.begin))
        likeliest = np.flatnonzero(self.q == np.repeat(top, counts))[::-1]
        self.best[node[likeliest]], self.best_q[own] = likeliest, top  # of equals the first, which is written last
        others = self.q.copy()
        others[self.best[own]] = 0
        self.sums = np.r_[0.0, np.cumsum(others)]

    def choose(self, node: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An edge of each node, by the uniform numbers."""
        edge, q = self.best[node], self.best_q[node]
        left = np.flatnonzero(u > q)
        if len(left):
            node, u, q = node[left], u[left], q[left]
            begin, end = self.begin[node], self.end[node]
            base = self.sums[begin]
            span = self.sums[end] - base
            at = np.clip(np.searchsorted(self.sums, base + (u - q) / (1 - q) * span, "right") - 1, begin, end - 1)
            edge[left] = np.where(span > 0, at, edge[left])
        return edge


def uniform(seed: np.ndarray | int, path: int, place: np.ndarray | int, use: int = 0) -> np.ndarray:
    """Numbers in (0, 1) that hang on their arguments alone."""
    salt = np.uint64((path << 8 | use) * int(PLACES[9]) & 0xFFFFFFFFFFFFFFFF)
    place = place.astype(np.uint64, copy=False) if isinstance(place, np.ndarray) else np.array([place], np.uint64)
    x = mixed((seed ^ salt) + place * PLACES[10]) >> np.uint64(12)
    return (x + 0.5) * 2.0**-52


class Batch:
    """Texts, their words' lattice and k independent walks through each."""

    def __init__(self, model: Model, texts: list[str], seeds: list[int], k: int) -> None:
        self.seeds = np.array(seeds, np.uint64)
        parts = [model.words(t) for t in texts]
        every = [w for p in parts for w in p]
        word, own = pd.factorize(np.array(every, object))
        self.lattice = lattice = Lattice(model, list(own))
        self.first_word = np.r_[0, np.cumsum([len(p) for p in parts])]
        doc = np.repeat(np.arange(len(texts)), np.diff(self.first_word))
        ends = np.cumsum(lattice.last[word] - lattice.first[word])
        begin_of_doc = np.r_[0, ends][self.first_word[:-1]]
        self.place = np.r_[0, ends[:-1]] - begin_of_doc[doc] - lattice.first[word]  # add a node: its place in the text
        self.word = word
        self.walks = [self.walk(word, self.place, self.seeds[doc], path) for path in range(k)]

    def walk(self, word: np.ndarray, place: np.ndarray, seed: np.ndarray, path: int) -> tuple[np.ndarray, np.ndarray]:
        """(edges, where each word's edges begin) of one draw for all words."""
        lattice = self.lattice
        left, node, last = np.arange(len(word)), lattice.first[word], lattice.last[word]
        steps, count = [], np.zeros(len(word) + 1, np.int64)
        while len(left):
            edge = lattice.choose(node, uniform(seed[left], path, place[left] + node))
            steps.append((left, edge))
            count[left + 1] += 1
            node = lattice.dst[edge]
            go = node < last[left]
            left, node = left[go], node[go]
        begins = np.cumsum(count)
        edges = np.empty(begins[-1], np.int64)
        for n, (own, edge) in enumerate(steps):
            edges[begins[own] + n] = edge
        return edges, begins

    def drawn(self, doc: int, path: int, word: int | None = None) -> np.ndarray:
        """The edges of a walk from a word (counted in the batch) to the text's end."""
        edges, begins = self.walks[path]
        return edges[begins[self.first_word[doc] if word is None else word] : begins[self.first_word[doc + 1]]]

    def top(self, doc: int, k: int) -> tuple[list[tuple[np.ndarray, float, float]], float]:
        """(edges, log probability, arrival time) of the k first paths, and the time of the next (infinite if there is none)."""
        lattice, seed = self.lattice, self.seeds[doc]
        queue: list[tuple] = []
        found: list[tuple[np.ndarray, float, float]] = []
        begins = self.first_word[doc]

        def split(edges: np.ndarray, logq: np.ndarray, depth: int, time: float, before: float, taken: tuple[int, ...]) -> None:
            """Queues the paths that leave ``edges`` at ``depth`` (by other edges than ``taken`` and its own) or later."""
            path = len(found) - 1
            reach = np.empty(len(edges) - depth)
            reach[0] = before
            np.cumsum(logq[depth:-1], out=reach[1:])
            reach[1:] += before
            # Where the walk so far has a chance below e^-100, waiting times exceed any that a head of all mass can give at 52 random bits.
            some = len(reach) if reach[-1] > -100 else int(np.searchsorted(-reach, 100))
            rest = lattice.rest[edges[depth : depth + some]]
            if taken:
                node = lattice.source[edges[depth]]
                rest[0] = max(rest[0] - lattice.q[list(taken)].sum(), 0) if lattice.end[node] - lattice.begin[node] > 1 + len(taken) else 0
            wait = -np.log(uniform(seed, path, STEPS[depth : depth + some] if depth + some <= len(STEPS) else np.arange(depth, depth + some, dtype=np.uint64), 1)) / (np.exp(reach[:some]) * rest)
            for j in np.argsort(wait)[: k + 1 - len(found)]:
                if np.isfinite(wait[j]):
                    heapq.heappush(queue, (time + wait[j], path, depth + int(j), float(reach[j]), (*taken, int(edges[depth])) if j == 0 else (int(edges[depth + j]),)))

        time = float(-np.log(uniform(seed, 0, 0, 2))[0])
        edges = self.drawn(doc, 0)
        logq = lattice.logq[edges]
        found.append((edges, float(logq.sum()), time))
        split(edges, logq, 0, time, 0.0, ())
        while queue and len(found) < k:
            time, parent, depth, before, taken = heapq.heappop(queue)
            path = len(found)
            edges = found[parent][0]
            node = int(lattice.source[edges[depth]])
            open_ = np.array([e for e in range(lattice.begin[node], lattice.end[node]) if e not in taken])
            sums = np.cumsum(lattice.q[open_])
            edge = int(open_[min(np.searchsorted(sums, uniform(seed, path, depth, 3)[0] * sums[-1], "right"), len(open_) - 1)])
            new = [edge]
            word = begins + int(lattice.ends[edges[:depth]].sum())
            last = lattice.last[self.word[word]]
            while lattice.dst[new[-1]] < last:
                at = lattice.dst[new[-1:]]
                new.append(int(lattice.choose(at, uniform(seed, path, self.place[word] + at, 4))[0]))
            own = np.concatenate([edges[:depth], new, self.drawn(doc, path, word + 1)]).astype(np.int64)
            logq = lattice.logq[own]
            found.append((own, float(logq.sum()), time))
            split(own, logq, depth, time, before, taken)
        return found, queue[0][0] if queue else float("inf")


def ids_of(model: Model, lattice: Lattice, edges: np.ndarray) -> np.ndarray:
    """Piece ids of a path; characters without a piece become their bytes' pieces."""
    ids = lattice.piece[edges]
    lost = np.flatnonzero(ids < 0)
    if not len(lost):
        return ids
    out, begin = [], 0
    for k in lost:
        out.append(ids[begin:k])
        raw = chr(lattice.char[edges[k]]).encode("utf-8", "surrogatepass")
        out.append(np.array([model.bytes[b] for b in raw] if model.bytes else [model.unknown], np.int32))
        begin = k + 1
    return np.concatenate([*out, ids[begin:]]).astype(np.int32)


def seed_of(key: object) -> int:
    return xxhash.xxh3_64_intdigest(repr(key))


def sample(model: Model, texts: list[str], keys: list[object], k: int) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """For each text its drawn segmentations: (ids, log probability, Gumbel value, log inclusion probability)."""
    some = [n for n, t in enumerate(texts) if t]
    out = [[(np.zeros(0, np.int32), 0.0, float("inf"), 0.0)] for _ in texts]
    if not some:
        return out
    with np.errstate(divide="ignore", over="ignore"):  # a path without other edges is never left
        batch = Batch(model, [texts[n] for n in some], [seed_of(keys[n]) for n in some], k)
        for at, n in enumerate(some):
            found, threshold = batch.top(at, k)
            out[n] = []
            for edges, logp, time in found:
                rate = logp + math.log(threshold)
                inclusion = 0.0 if math.isinf(threshold) else rate if rate < -30 else math.log(-math.expm1(-math.exp(rate)))
                out[n].append((ids_of(model, batch.lattice, edges), logp, -math.log(time), inclusion))
    return out


def sampled(df: DataFrame, model_path: str, k: int = 2, alpha: float = 1.0, text: str = "text", key: str = "doc_id", batch_bytes: int = 1 << 20) -> DataFrame:
    """key, sample (from 1), log_prob, gumbel, log_inclusion, n_pieces and ids: ``k`` distinct segmentations of each row's whole text."""
    names = [key, "sample", "log_prob", "gumbel", "log_inclusion", "n_pieces", "ids"]

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model.at(model_path, alpha)
        for part, texts in slices(batches, 1, batch_bytes):
            drawn = sample(model, texts, part.column(0).to_pylist(), k)
            rows = [(n, j, *d) for n, own in enumerate(drawn) for j, d in enumerate(own, 1)]
            sizes = [len(r[2]) for r in rows]
            ids = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.array(np.concatenate([r[2] for r in rows]).astype(np.int32)))
            values = [pa.array([r[c] for r in rows], t) for c, t in ((1, pa.int32()), (3, pa.float64()), (4, pa.float64()), (5, pa.float64()))]
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array([r[0] for r in rows])), *values, pa.array(sizes, pa.int32()), ids], names=names)

    rows = df.select(F.col(f"`{key}`"), text_of(text).alias("__text"))
    return bounded_batches(rows).mapInArrow(draw, f"`{key}` {rows.schema[0].dataType.simpleString()}, sample int, log_prob double, gumbel double, log_inclusion double, n_pieces int, ids array<int>")


def decoded(df: DataFrame, model_path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """``df`` with the text of each row's ids by the library; null ids give an empty text."""

    @F.pandas_udf("string")
    def decode(column):
        import sentencepiece

        if model_path not in _decoders:
            _decoders[model_path] = sentencepiece.SentencePieceProcessor(model_file=model_path)
        return column.map(lambda x: _decoders[model_path].decode([int(k) for k in x]) if x is not None else "")

    return df.withColumn(out, decode(F.col(f"`{ids}`")))


_decoders: dict[str, object] = {}
