"""The pipeline's stages against plain versions, on a table with planted cases."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType
from tokenizers import Tokenizer

import corpus_pipeline
from siltstone.llm import nbsvm, secrets, stream_dedup
from tests.llm.brute import near

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """sf0.001's documents, with an extra column, nulls, copies and a secret, and what each stage makes of them."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) + (0.5,) for r in docs.collect()]
    base = rows[1]
    rows += [(1001, base[1].upper(), "en", None, 3, None), (1002, base[1] + " more", "en", "s", 3, 0.1), (1003, None, None, None, None, None), (1004, "", "en", "s", 0, 0.1), (None, base[1] + " key password=hunter2222", "en", "s", 9, 0.1), (1005, base[1] * 20, "en", "s", 9, 0.1)]
    frame = spark.createDataFrame(rows, StructType([*docs.schema, StructField("quality_score", DoubleType())]))
    out = [frame]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "out")
        stage(spark, out[-1], sf).write.parquet(path)
        out.append(spark.read.parquet(path))
    return [sorted(map(tuple, d.collect()), key=str) for d in out], [d.columns for d in out]


def test_columns(stages):
    assert all(c == stages[1][0] for c in stages[1][:-1]) and all(len(r) for r in stages[0])


def test_stages_begin_with_small_heaps(spark):
    collectors = spark.sparkContext._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    full = lambda: sum(c.getCollectionCount() for c in collectors if "Old" in c.getName() or "MarkSweep" in c.getName())
    docs = spark.createDataFrame([], "doc_id long, text string")
    for _, stage in corpus_pipeline.STAGES[3:]:
        before = full()
        stage(spark, docs, "")
        assert full() > before


def test_dedup_stage(stages):
    before, after = stages[0][1:3]
    best = {}
    for r in before:
        best[(r[1] or "").translate(LOWER)] = max(best.get((r[1] or "").translate(LOWER), -1), -1 if r[0] is None else r[0])
    assert {(r[1] or "").translate(LOWER): -1 if r[0] is None else r[0] for r in after} == best and len(after) == len(best)


def test_join_stage(stages):
    before, after = stages[0][2:4]
    roots = near([(r[0], r[1]) for r in before], roots=True)
    assert len(after) == len({*roots} - {None}) + roots.count(None) and {*after} <= {*before}


def test_secret_stage(stages):
    before, after = ({r[0]: r for r in rows} for rows in stages[0][3:5])
    assert before.keys() == after.keys()
    for key, r in after.items():
        assert (r[1] is None) == (before[key][1] is None) and not (r[1] and secrets.scan(r[1])) and (r[1] is None or r[4] == len(r[1]))


def test_packing_stage(stages):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sizes = {r[0]: len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in stages[0][4]}
    got = {}
    for r in stages[0][5]:
        got[r[0]] = got.get(r[0], 0) + r[2]
        assert r[4] == sizes[r[0]]
    assert got == sizes


def test_quality(spark):
    """Held-out accuracy on sf0.01, and that hard rows get scores."""
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = nbsvm.train(docs, labels)
    rows = nbsvm.scored(docs, model).join(labels, "doc_id").filter(nbsvm.in_fold(F.col("doc_id"))).collect()
    right = sum((r.quality_score >= 0.3) == bool(r.quality) for r in rows)
    assert right >= 0.98 * len(rows) and all(0 <= r.quality_score <= 1 for r in rows)
    hard = spark.createDataFrame([(1, None), (None, ""), (2, "x " * 50_000), (2, "x")], "doc_id long, text string")
    assert nbsvm.scored(hard, model).count() == 4 and nbsvm.scored(hard.filter("false"), model).count() == 0
    none = nbsvm.train(docs, labels.filter("false"))
    assert {round(r.quality_score, 6) for r in nbsvm.scored(hard, none).collect()} == {0.5}


@pytest.mark.parametrize("files", [None, 1])
def test_dedup(spark, files):
    """Also with several batches, so that later rows hit the state on disk."""
    rows = [(k % 50, f"Text {k % 17}", "d", 1) for k in range(200)] + [(None, "text 3", "d", 1), (None, None, "d", 1), (None, "", "d", 1), (900, "ÀB", "d", 1), (901, "àb", "d", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, digest string, n int").repartition(4)
    got = stream_dedup.groups(df, files_per_batch=files).withColumn("stays", stream_dedup.kept()).collect()
    assert len(got) == len(rows)
    groups = {}
    for key, text, *_ in rows:
        groups.setdefault((text or "").translate(LOWER), []).append(key)
    want = sorted(((max((k for k in g if k is not None), default=None), len(g)) for g in groups.values()), key=str)
    assert sorted(((r.keep.key, r.n) for r in got if r.stays), key=str) == want
    assert stream_dedup.deduplicated(df).columns == df.columns
    assert stream_dedup.groups(df.filter("false")).count() == 0


def test_dedup_collision(spark, monkeypatch):
    """Texts that differ behind one digest are told apart by their bytes."""
    monkeypatch.setattr(stream_dedup.F, "sha2", lambda column, bits: stream_dedup.F.lit("ab"))
    rows = [(1, "a"), (2, "A"), (3, "b"), (4, "c"), (5, "c")]
    got = stream_dedup.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.key, r.keep.key, r.n) for r in got} == {(1, 2, 2), (2, 2, 2), (3, 3, 1), (4, 5, 2), (5, 5, 2)}
