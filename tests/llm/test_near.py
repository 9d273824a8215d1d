import random

import pytest

from siltstone.llm import jaccard, queries, stream_dedup
from tests.llm.brute import near

WORDS = [f"w{k}" for k in range(400)]
SCHEMA = "doc_id long, text string, owner string, key string"


def corpus(seed, n=150):
    """Copies with few and many edits, chains of edits, a shared passage, short and empty texts, ties and repeated rows."""
    rng = random.Random(seed)
    prose = lambda k: [rng.choice(WORDS) for _ in range(k)]
    base, passage, rows = prose(120), prose(60), []
    chain = prose(100)
    for k in range(n):
        kind = k % 10
        if kind < 3:
            words = list(base)
            for _ in range(rng.randrange(6)):
                words[rng.randrange(len(words))] = rng.choice(WORDS)
        elif kind < 5:
            chain = list(chain)
            chain[rng.randrange(100)] = rng.choice(WORDS)
            words = chain
        elif kind < 7:
            words = prose(rng.randrange(40, 80)) + passage
        elif kind == 7:
            words = prose(rng.randrange(6))
        else:
            words = prose(rng.randrange(3, 90))
        rows.append((k, "  ".join(words)))
    rows += [(n, None), (n + 1, ""), (n + 2, " \t\n"), (5, rows[9][1]), (None, rows[9][1].upper()), (n + 3, rows[3][1]), (n + 3, rows[3][1]), (None, None), (n + 4, "a b c"), (n + 5, "A\x0bB\x0cc"), (n + 6, "x y\x1cz a b"), (n + 7, "x y\x1cz a b")]
    return [(a, b, "o", "k") for a, b in rows]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("stars", [0, 1])
def test_near_duplicates(spark, seed, stars):
    rows = corpus(seed)
    got = jaccard.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3), star_rounds=stars).collect()
    want = [(r[0], *x) for r, x in zip(rows, near([r[:2] for r in rows]), strict=True)]
    order = lambda rows: sorted(rows, key=str)
    assert order(tuple(r) for r in got) == order(want)


@pytest.mark.parametrize("stars", [0, 1])
def test_large_group_far_from_its_centre(spark, stars):
    """Most members of a group don't link to its centre, some link to each other: no link is lost, and pairs leave the join about once."""
    rng = random.Random(5)
    base = [rng.choice(WORDS) for _ in range(150)]
    rows = [(0, " ".join(base), "o", "k")]
    for k in range(1, 90):
        words = list(base)
        for _ in range(2 if k % 9 == 0 else 5):
            words[rng.randrange(150)] = rng.choice(WORDS)
        rows.append((2 * k, " ".join(words), "o", "k"))
        if k % 4 == 0:
            words[rng.randrange(150)] = rng.choice(WORDS)
            rows.append((2 * k + 1, " ".join(words), "o", "k"))
    got = {r.key: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3), star_rounds=stars).collect()}
    want = near([r[:2] for r in rows])
    assert got == {r[0]: x for r, x in zip(rows, want, strict=True)}
    assert 20 < len({c for _, c in want}) < 90


def test_very_long_texts(spark):
    """Texts of a million characters are whole sets: a change at the end counts as one at the beginning."""
    words = [f"v{k * 7919 % 1_000_003}" for k in range(150_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:-9000])), (3, " ".join(words[40_000:])), (4, " ".join(words[:-1] + ["w"]))]
    got = {r.key: r.component_id for r in jaccard.near_duplicates(spark.createDataFrame([(a, b, "", "") for a, b in rows], SCHEMA)).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 1}


def test_one_of_each(spark):
    rows = corpus(1, 60)
    got = jaccard.one_of_each(spark.createDataFrame(rows, SCHEMA)).collect()
    roots = near([r[:2] for r in rows], roots=True)
    assert len(got) == len({*roots} - {None}) + roots.count(None) and got[0].asDict().keys() == {"doc_id", "text", "owner", "key"}


def test_empty(spark):
    assert jaccard.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_op7(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in queries.table(spark, sf_dir, "documents").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op7_jaccard_join(spark, sf_dir).collect()}
    assert got == {r[0]: x for r, x in zip(rows, near(rows), strict=True)}


def test_later_batches_continue_the_state(spark, tmp_path):
    batches = [[(1, "A b"), (2, "c")], [(5, "a B"), (3, "c"), (4, "d")], [(0, "D")]]
    want = [{1: (1, 1), 2: (2, 1)}, {5: (5, 2), 3: (3, 2), 4: (4, 1)}, {0: (4, 2)}]
    for rows, expected in zip(batches, want, strict=True):
        got = stream_dedup.groups(spark.createDataFrame(rows, "doc_id long, text string"), folder=str(tmp_path / "state")).collect()
        assert {r.key: (r.keep.key, r.n) for r in got} == expected
