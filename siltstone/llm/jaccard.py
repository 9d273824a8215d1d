"""N-gram Jaccard self-join with adaptive multi-match prefixes, down to connected components.

A document's set holds the hashes of its distinct ``width``-word shingles. Documents of equal sets are one class; one row a
class goes on. If two sets of sizes m and n have a Jaccard similarity of t or more, then in any common order of all shingles
their first n - ceil(t n) + l shingles (and m likewise) share at least l. That is used twice:

1. In hash order, with l a tenth of the set: each class sends these prefixes, packed by hash range, and learns how many of its
   prefix shingles another class has too. Classes with fewer than l have no partner; on prose they are nearly all.
2. Of the rest, whole sets are counted and ordered rarest first. Each class picks its own l: a longer prefix costs longer
   lists, but asks for more matches and so verifies fewer candidates. Two classes are candidates if they share at least the
   smaller of their l prefix shingles.

Candidates are verified on whole sets. Each shingle's list is first compared with its most central class only (a star); components
found thereby are taken as done, and only pairs from different components are enumerated, until nothing is left: a group of
near copies costs a link for each member, not for each pair, and no link between components is lost. Members that link to neither centre nor
each other but come near it are compared pair by pair, each pair once.

Null and blank texts have no set, link with nothing and are their own component. Texts of fewer words than ``width`` are one
shingle. Repeated rows share a class. A component's id is its smallest non-null key. Sets are compared by 64-bit hashes. An empty table gives
no rows. A very long text is one set, held in memory by the task that reads it. Rows travel in a struct, so columns of any names pass by.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import bounded_batches, keyed, located, original, scratch, slices, small_side, stored
from siltstone.llm.words import WordHashes, grams, hold

WORDS = WordHashes()
U = np.uint64
#: 64-bit words of a set's sketch.
SKETCH = 16
#: Shingles before a shared one among which an earlier shared one is looked for.
EARLIER = 4


def shingles(text: str, width: int = 5) -> np.ndarray:
    """Hashes of the distinct shingles, sorted. Bytes split and fold just as the contract's words do."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, U)
    hashes = WORDS.of(words)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(hashes.tobytes(), seed=len(words))], U)
    return np.unique(grams(hashes, width))


def needed(n: int, percent: int) -> int:
    """Shingles that a set of n shares at least with any partner: ceil(percent n / 100)."""
    return -(-percent * n // 100)


def first_length(n: int, percent: int) -> tuple[int, int]:
    """(l, prefix length) of the first step."""
    matches = max(1, n // 10)
    return matches, min(n, n - needed(n, percent) + matches)


def choose(listed: np.ndarray, n: int, percent: int, most: int = 32, verify: float = 0.2) -> int:
    """The l of least estimated cost, from the list lengths of a set's shingles, rarest first (those of one class count 1)."""
    base = n - needed(n, percent)
    most = min(most, needed(n, percent))
    totals = np.cumsum(listed.astype(np.float64))
    ls = np.arange(1, most + 1)
    read = totals[base + ls - 1] - (base + ls)
    return int(ls[np.argmin(read + read / ls * verify * n)])


# ---- packed rows: shingles of many classes by hash range ----


def by_range(rows: list[tuple[int, int, np.ndarray]], ranges: int) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """(range, owners, how many shingles each has, shingles) for (owner, n, shingles) rows; empty ranges are left out."""
    if not rows:
        return
    tokens = np.concatenate([r[2] for r in rows])
    owners = np.repeat(np.array([r[0] for r in rows], np.int64), [len(r[2]) for r in rows])
    place = (tokens >> U(40)) % U(ranges)
    order = np.argsort(place, kind="stable")
    tokens, owners, place = tokens[order], owners[order], place[order]
    cuts = np.flatnonzero(np.diff(place)) + 1
    for own_tokens, own_owners, at in zip(np.split(tokens, cuts), np.split(owners, cuts), place[np.r_[0, cuts]], strict=True) if len(tokens) else ():
        starts = np.flatnonzero(np.r_[True, own_owners[1:] != own_owners[:-1]])
        yield int(at), own_owners[starts].tobytes(), np.diff(np.r_[starts, len(own_owners)]).astype(np.uint32).tobytes(), own_tokens.tobytes()


PACKED = "range int, owners binary, counts binary, tokens binary"


def packed_batch(rows: list[tuple[int, int, np.ndarray]], ranges: int) -> pa.RecordBatch:
    columns = list(zip(*by_range(rows, ranges), strict=True)) or [(), (), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])], names=["range", "owners", "counts", "tokens"])


def unpacked(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    """All (token, owner) of a partition, sorted by both, each once."""
    tokens, owners = [np.zeros(0, U)], [np.zeros(0, np.int64)]
    for batch in batches:
        for o, c, t in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
            tokens.append(np.frombuffer(t, U))
            owners.append(np.repeat(np.frombuffer(o, np.int64), np.frombuffer(c, np.uint32)))
    tokens, owners = np.concatenate(tokens), np.concatenate(owners)
    order = np.lexsort((owners, tokens))
    tokens, owners = tokens[order], owners[order]
    new = np.r_[True, (tokens[1:] != tokens[:-1]) | (owners[1:] != owners[:-1])][: len(tokens)]
    return tokens[new], owners[new]


def list_lengths(tokens: np.ndarray) -> np.ndarray:
    """For each place of sorted ``tokens``, how often its token stands there."""
    starts = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]]) if len(tokens) else np.zeros(0, int)
    sizes = np.diff(np.r_[starts, len(tokens)])
    return np.repeat(sizes, sizes)


# ---- steps ----


def signatures(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """key, file, row, n (set size), owner (hash of the set; null without one), prefix (step 1's shingles)."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold(WORDS)
        for part, texts in slices(batches, 3):
            n, owner, prefix = [], [], []
            for t in texts:
                own = shingles(t, width)
                n.append(len(own))
                owner.append(xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63) if len(own) else None)
                prefix.append(own[: first_length(len(own), percent)[1]].tobytes() if len(own) else None)
            yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(n, pa.int64()), pa.array(owner, pa.int64()), pa.array(prefix, pa.binary())], names=["key", "file", "row", "n", "owner", "prefix"])

    rows = docs.select("key", "file", "row", "text")
    return bounded_batches(rows).mapInArrow(signed, f"key {rows.schema[0].dataType.simpleString()}, file string, row long, n long, owner long, prefix binary")


def packed(rows: DataFrame, column: str, ranges: int, pieces: int = 2048) -> DataFrame:
    """``column`` of (owner, column) rows, by hash range. An owner that comes again within a task is sent once."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        waiting, size = [], 0
        for batch in batches:
            for owner, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if owner in sent:
                    continue
                if len(sent) < 1 << 17:
                    sent.add(owner)
                waiting.append((owner, 0, np.frombuffer(data, U)))
                size += len(data)
                if size > 2 << 20:
                    yield packed_batch(waiting, ranges)
                    waiting, size = [], 0
        yield packed_batch(waiting, ranges)

    return rows.select("owner", column).filter("owner is not null").mapInArrow(pack, PACKED).repartition(ranges, "range")


def shared_counts(lists: DataFrame, ranges: int) -> DataFrame:
    """owner, shared: how many of its sent shingles another owner has too."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, owners = unpacked(batches)
        found, times = np.unique(owners[list_lengths(tokens) > 1], return_counts=True)
        place = found.view(U) % U(ranges)
        order = np.argsort(place, kind="stable")
        cuts = np.flatnonzero(np.diff(place[order])) + 1
        parts = [x for x in np.split(order, cuts) if len(x)]  # one row for each range of owners
        columns = [pa.array([int(place[x[0]]) for x in parts], pa.int32()), *(pa.array([v[x].astype(np.int64).tobytes() for x in parts], pa.binary()) for v in (found, times))]
        yield pa.RecordBatch.from_arrays(columns, names=["range", "owners", "shared"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owners, shared = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for batch in batches:
            for o, s in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                owners.append(np.frombuffer(o, np.int64))
                shared.append(np.frombuffer(s, np.int64))
        who, back = np.unique(np.concatenate(owners), return_inverse=True)
        total = np.bincount(back, np.concatenate(shared), len(who)).astype(np.int64)
        for k in range(0, max(1, len(who)), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(who[k : k + (1 << 16)]), pa.array(total[k : k + (1 << 16)])], names=["owner", "shared"])

    return lists.mapInArrow(count, "range int, owners binary, shared binary").repartition(ranges, "range").mapInArrow(add, "owner long, shared long")


def survivors(signed: DataFrame, percent: int, ranges: int) -> DataFrame:
    """owner and key (of one row) of the classes that step 1 leaves."""
    classes = signed.filter("owner is not null").groupBy("owner").agg(F.min("key").alias("key"), F.min("n").alias("n"))
    least = F.greatest(F.lit(1), F.floor(F.col("n") / 10))
    return classes.join(shared_counts(packed(signed, "prefix", ranges), ranges), "owner").filter(F.col("shared") >= least).select("owner", "key")


def whole_sets(docs: DataFrame, chosen: DataFrame, width: int) -> DataFrame:
    """owner, set (sorted shingles) of the chosen classes, from one of their rows each."""
    left = docs.select("key", "text").join(small_side(chosen.select(F.col("key").alias("wanted"), "owner")), F.col("key").eqNullSafe(F.col("wanted")))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold(WORDS)
        sent: set[int] = set()
        for part, texts in slices(batches, 1):
            owners, data = [], []
            for owner, t in zip(part.column(0).to_pylist(), texts, strict=True):
                if owner not in sent:
                    own = shingles(t, width)
                    if len(own) and xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63) == owner:  # keys may repeat with other texts
                        sent.add(owner)
                        owners.append(owner)
                        data.append(own.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(owners, pa.int64()), pa.array(data, pa.binary())], names=["owner", "set"])

    return left.select("owner", "text").mapInArrow(sets, "owner long, set binary")


def prefixes(sets: DataFrame, percent: int, ranges: int) -> DataFrame:
    """owner, n, l, m (shingles that other classes have too), c (mean list length), tokens (the class's shared prefix shingles of step 2, ascending)."""

    def packed_lists(out: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), *(pa.array(x, pa.binary()) for x in out[1:])], names=["range", "owners", "shared", "total", "tokens", "lengths"])

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, owners = unpacked(batches)
        lengths = list_lengths(tokens).astype(np.int64)
        place = owners.view(U) % U(ranges)
        order = np.lexsort((owners, place))
        tokens, owners, lengths, place = tokens[order], owners[order], lengths[order], place[order]
        cuts = np.r_[0, np.flatnonzero(np.diff(place)) + 1, len(place)] if len(place) else [0]
        out: list[list] = [[], [], [], [], [], []]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):  # one row for each range of owners, however many they are
            some = lengths[a:b] > 1
            who, start = np.unique(owners[a:b], return_index=True)
            shared = np.add.reduceat(some, start).astype(np.uint32)
            total = np.diff(np.r_[start, b - a]).astype(np.uint32)
            if sum(map(len, out[4])) > 2 << 20:
                yield packed_lists(out)
                out = [[], [], [], [], [], []]
            for column, value in zip(out, (int(place[a]), who.tobytes(), shared.tobytes(), total.tobytes(), tokens[a:b][some].tobytes(), lengths[a:b][some].tobytes()), strict=True):
                column.append(value)
        yield packed_lists(out)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owners, sizes, token_owner, tokens, lengths = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, U)], [np.zeros(0, np.int64)]
        for batch in batches:
            for o, shared, total, t, k in zip(*(batch.column(c).to_pylist() for c in range(1, 6)), strict=True):
                owners.append(np.frombuffer(o, np.int64))
                sizes.append(np.frombuffer(total, np.uint32).astype(np.int64))
                token_owner.append(np.repeat(owners[-1], np.frombuffer(shared, np.uint32)))
                tokens.append(np.frombuffer(t, U))
                lengths.append(np.frombuffer(k, np.int64))
        who, back = np.unique(np.concatenate(owners), return_inverse=True)
        n = np.bincount(back, np.concatenate(sizes), len(who)).astype(np.int64)
        token_owner, tokens, lengths = np.concatenate(token_owner), np.concatenate(tokens), np.concatenate(lengths)
        order = np.lexsort((tokens, lengths, token_owner))
        token_owner, tokens, lengths = token_owner[order], tokens[order], lengths[order]
        starts, ends = np.searchsorted(token_owner, who, "left"), np.searchsorted(token_owner, who, "right")
        rows: list[tuple] = []
        for key, size, a, b in zip(who.tolist(), n.tolist(), starts, ends, strict=True):
            alone = size - (b - a)
            if b - a < needed(size, percent):
                continue
            own = lengths[a:b]
            best = choose(np.r_[np.ones(alone, np.int64), own], size, percent)
            taken = np.sort(tokens[a:b][: size - needed(size, percent) + best - alone].view(np.int64))
            rows.append((key, size, best, b - a, (own.sum() + alone) / size, taken))
            if len(rows) == 1000:
                yield class_rows(rows)
                rows = []
        yield class_rows(rows)

    def class_rows(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows, strict=True)) or [()] * 6, kinds, strict=True)], names=["owner", "n", "l", "m", "c", "tokens"])

    listed = packed(sets, "set", ranges).mapInArrow(lists, "range int, owners binary, shared binary, total binary, tokens binary, lengths binary")
    return listed.repartition(ranges, "range").mapInArrow(pick, "owner long, n long, l int, m long, c double, tokens array<long>")


def verified(pairs: DataFrame, sets: DataFrame, prefix: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that share enough prefix shingles and whose whole sets are similar enough."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            tokens_a, tokens_b = (batch.column(batch.schema.get_field_index(f"tokens_{x}")) for x in "ab")
            least = np.minimum(*(batch.column(batch.schema.get_field_index(f"l_{x}")).to_numpy() for x in "ab"))
            sets_a, sets_b = (batch.column(batch.schema.get_field_index(f"set_{x}")).to_pylist() for x in "ab")
            for k, (x, y) in enumerate(zip(sets_a, sets_b, strict=True)):
                if len(np.intersect1d(tokens_a[k].values.to_numpy(), tokens_b[k].values.to_numpy(), assume_unique=True)) < least[k]:
                    continue
                x, y = np.frombuffer(x, U), np.frombuffer(y, U)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    good.append(k)
            good = pa.array(good, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(x)).take(good) for x in "ab"], names=["a", "b"])

    own = sets.join(prefix.select("owner", "l", "tokens"), "owner")
    for x in "ba":
        pairs = pairs.join(own.select(F.col("owner").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("set", "l", "tokens")]), x)
    return pairs.mapInArrow(judge, "a long, b long")


def are_stars(edges: DataFrame) -> bool:
    """Whether each u of the edges (u, v) has one v, which is no other edge's u."""
    ends = edges.groupBy("u").agg(F.count(F.lit(1)).alias("k")).unionByName(edges.select(F.col("v").alias("u")).distinct().withColumn("k", F.lit(1).cast("long")))
    return ends.groupBy("u").agg(F.sum("k").alias("k")).filter("k > 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """node, root (its component's smallest node) for the nodes of links (a, b), by alternating large and small stars.

    Links to a node's smallest neighbour replace its links until all are stars. Each round's links are written to the shared
    folder; only whether one is left to do comes to the driver.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "links")
    while not are_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.filter("m < u").select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        edges = stored(small, "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def rooted(prefix: DataFrame, roots: DataFrame) -> DataFrame:
    return prefix.join(roots.withColumnRenamed("node", "owner"), "owner", "left").withColumn("root", F.coalesce("root", "owner"))


def enough(both: Column, percent: int) -> Column:
    """Whether sets of n and n2 shingles that share ``both`` are similar enough."""
    return (100 + percent) * both >= percent * (F.col("n") + F.col("n2"))


def may_link(percent: int) -> Column:
    """Whether two classes can be similar enough if they share all shingles that any others share with them."""
    return enough(F.col("m"), percent) & enough(F.col("m2"), percent)


def star_pairs(classes: DataFrame, percent: int, sets: DataFrame) -> DataFrame:
    """Each shingle's classes against the list's most central one, where their components differ.

    Most central is the class whose shingles most others have: the text that copies were made from.
    """
    rows = classes.select(F.explode("tokens").alias("token"), "owner", "root", "n", "m", "c")
    first = rows.groupBy("token").agg(F.min(F.struct((-F.col("c")).alias("c"), "owner", "root", "n", "m")).alias("first"))
    first = stored(first.select("token", F.col("first.owner").alias("a"), F.col("first.root").alias("root2"), F.col("first.n").alias("n2"), F.col("first.m").alias("m2")), "centres")
    return rows.join(first, "token").filter((F.col("root") != F.col("root2")) & may_link(percent)).select("a", F.col("owner").alias("b")).distinct()


def sketches(sets: DataFrame) -> DataFrame:
    """owner and SKETCH words of 64 bits: a bit is set where a shingle of the set falls."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.zeros((batch.num_rows, 64 * SKETCH), np.uint8)
            for k, data in enumerate(batch.column(1).to_pylist()):
                marks[k, np.frombuffer(data, U) % U(64 * SKETCH)] = 1
            words = np.packbits(marks, axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(words[:, k]) for k in range(SKETCH))], names=["owner", *(f"bits{k}_" for k in range(SKETCH))])

    return sets.select("owner", "set").mapInArrow(mark, "owner long, " + ", ".join(f"bits{k}_ long" for k in range(SKETCH)))


def sketches_allow(percent: int) -> Column:
    """A bit that one sketch alone has stands for a shingle at least that the other set lacks, which bounds what both share."""
    first, second = (sum((F.bit_count(F.col(f"bits{k}_{x}").bitwiseAND(F.bitwise_not(F.col(f"bits{k}_{y}")))) for k in range(SKETCH)), F.lit(0)) for x, y in (("", "2"), ("2", "")))
    return enough(F.col("n") - first, percent) & enough(F.col("n2") - second, percent)


def other_pairs(classes: DataFrame, percent: int, sets: DataFrame) -> DataFrame:
    """All pairs of classes from different components that share a prefix shingle: those outside the central class's component with all.

    Bounds from list lengths and from the sets' sketches are held against each pair before it leaves the join. So is the order
    of shingles: a pair is left to an earlier shingle if the last few before this one hold one that both have. So a pair leaves the
    join about once, however many shingles it shares.
    """
    rows = classes.select(F.explode("tokens").alias("token"), "owner", "root", "c")
    lists = rows.groupBy("token").agg(F.min(F.struct((-F.col("c")).alias("c"), "owner", "root")).alias("first"), F.min("root").alias("lo"), F.max("root").alias("hi"))
    lists = stored(lists.filter("lo < hi").select("token", F.col("first.root").alias("main")), "lists")
    some = rows.join(lists, "token", "left_semi").select("owner").distinct()
    marked = classes.join(some, "owner", "left_semi").join(sketches(sets), "owner").select("*", F.posexplode("tokens").alias("at", "token"))
    earlier = [f"earlier{k}_" for k in range(EARLIER)]
    known = marked.select("token", "owner", "root", "n", "m", *[f"bits{k}_" for k in range(SKETCH)], *[F.get("tokens", F.col("at") - 1 - k).alias(c) for k, c in enumerate(earlier)]).join(lists, "token")
    known = stored(known, "contested")  # so that both sides of the join are dealt for it alone, and a frequent shingle's rows can be split
    left = known.filter("root <> main")
    right = known.select([F.col(c).alias(f"{c}2") for c in known.columns])
    once = (F.col("root2") == F.col("main2")) | (F.col("owner") < F.col("owner2"))
    met = F.coalesce(reduce(Column.__or__, [F.col(x) == F.col(f"{y}2") for x in earlier for y in earlier]), F.lit(False))
    joined = left.join(right, (F.col("token") == F.col("token2")) & (F.col("root") != F.col("root2")) & once & may_link(percent) & sketches_allow(percent) & ~met)
    return joined.select(F.least("owner", "owner2").alias("a"), F.greatest("owner", "owner2").alias("b")).distinct()


def enough_ranges(spark: SparkSession, shingles: float, most: int = 2_000_000) -> int:
    """Hash ranges of about ``most`` shingles, which a task sorts in memory; not fewer than the session's partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -int(-shingles // most))


def found(docs: DataFrame, width: int, percent: int, star_rounds: int) -> tuple[DataFrame, DataFrame]:
    """Each row of ``docs`` (key, text, file, row) as key, file, row, n, owner (null without a set), and the first row of each owner's component.

    The second holds owners of several rows or with links alone, so that rows that have no copy need not move.
    """
    spark = docs.sparkSession
    signed = stored(signatures(docs, width, percent), "signatures", keep=True)
    sizes = signed.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    left = stored(survivors(signed, percent, enough_ranges(spark, 0.3 * sizes)), "survivors")
    sets = stored(whole_sets(docs, left, width), "sets")
    prefix = stored(prefixes(sets, percent, enough_ranges(spark, sets.agg(F.coalesce(F.sum(F.length("set")) / 8, F.lit(0))).first()[0])), "prefixes")
    roots = spark.createDataFrame([], "node long, root long")
    links = spark.createDataFrame([], "a long, b long")
    for find in [star_pairs] * star_rounds + [other_pairs]:
        pairs = stored(find(rooted(prefix, roots), percent, sets), "pairs")
        if pairs.isEmpty():
            continue
        links = links.unionByName(stored(verified(pairs, sets, prefix, percent), "verified"))
        roots = stored(components(links), "roots")
    rows = signed.select("key", "file", "row", "n", "owner")
    return rows, firsts(rows, roots)


def row_order() -> Column:
    """Smallest key first, nulls last, then by locator."""
    return F.struct(F.col("key").isNull().alias("without"), F.col("key").alias("key"), "file", "row")


def firsts(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """owner, first (by ``row_order``, of the owner's component), for owners of several rows or with links."""
    classes = rows.filter("owner is not null").groupBy("owner").agg(F.min(row_order()).alias("own"), F.count(F.lit(1)).alias("k"))
    several = stored(classes.join(small_side(roots.withColumnRenamed("node", "owner")), "owner", "left").filter("root is not null or k > 1").select("owner", "root", "own"), "classes")
    whole = several.filter("root is not null").groupBy("root").agg(F.min("own").alias("whole"))
    return stored(several.join(small_side(stored(whole, "named")), "root", "left").select("owner", F.coalesce("whole", "own").alias("first")), "firsts", keep=True)


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = 5, percent: int = 80, star_rounds: int = 1) -> DataFrame:
    """key, n_shingles, component_id of every row."""
    source = keyed(located(docs), key, text)
    with scratch(docs.sparkSession):
        rows, first = found(source, width, percent, star_rounds)
    return rows.join(small_side(first), "owner", "left").select("key", F.col("n").alias("n_shingles"), F.coalesce("first.key", "key").alias("component_id"))


def one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = 5, percent: int = 80, star_rounds: int = 1) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one of smallest key (nulls last), then locator. Rows without a set stay."""
    source = located(docs)
    with scratch(docs.sparkSession):
        rows, first = found(keyed(source, key, text), width, percent, star_rounds)
    gone = stored(rows.join(small_side(first), "owner").filter(~row_order().eqNullSafe(F.col("first"))).select("file", "row"), "near-gone")
    return original(source.join(small_side(gone), ["file", "row"], "left_anti"))
