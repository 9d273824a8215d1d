"""What the operators share: the folder all executors see, text batches, column picks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession, what: str) -> str:
    """A new folder below ``spark.checkpoint.dir``. Where that is unset, local mode takes a temporary folder; a cluster, whose machines don't share one, is refused."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="siltstone-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{what}-{uuid.uuid4().hex}"


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(df: DataFrame, most: int = 1 << 20) -> DataFrame:
    """``df``, once its session hands rows to Python in batches of at most about ``most`` bytes (a smaller setting stays): texts may be long.

    The setting stays in the session, as Spark reads it when the plan runs.
    """
    conf = df.sparkSession.conf
    now = conf.get(BATCH_BYTES, None)
    if not (now or "").isdigit() or int(now) > most:
        conf.set(BATCH_BYTES, str(most))
    return df


_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables ``stored`` within are deleted at the end, but for those to ``keep``."""
    paths: list[str] = []
    token = _scratch.set(paths)
    try:
        yield
    finally:
        _scratch.reset(token)
        for path in paths:
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def stored(df: DataFrame, what: str, keep: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage is cut and any executor can read it."""
    path = shared_dir(df.sparkSession, what)
    paths = _scratch.get()
    if paths is not None and not keep:
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def located(docs: DataFrame) -> DataFrame:
    """all (a struct of the row's columns, whatever their names), file and row: where each row's content stands.

    Rows that don't come straight from files are stored in the shared folder first.
    """
    packed = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("all")
    place = F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    if from_files(docs):
        return docs.select(packed, *place)
    return stored(docs.select(packed), "content").select("all", *place)


def from_files(docs: DataFrame) -> bool:
    """Whether the rows are those of files as they stand, so that their places are known."""
    if "_metadata" in docs.columns or docs._jdf.queryExecution().analyzed().nodeName() != "LogicalRelation":
        return False
    try:
        docs.select("_metadata.row_index").schema  # noqa: B018
    except AnalysisException:
        return False
    return True


def keyed(source: DataFrame, key: str, text: str) -> DataFrame:
    """key, text (never null), file and row of located rows."""
    return source.select(F.col("all").getField(key).alias("key"), F.coalesce(F.col("all").getField(text).cast("string"), F.lit("")).alias("text"), "file", "row")


def original(source: DataFrame) -> DataFrame:
    """The located rows as they were."""
    return source.select("all.*")


def text_of(name: str = "text") -> Column:
    """A text column; null counts as empty."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower case for A-Z only, as the contracts ask."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slices(batches: Iterator[pa.RecordBatch], column: int, most_bytes: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of the batches whose texts (in ``column``) come to about ``most_bytes``, with those texts; a longer text stands alone."""
    for batch in batches:
        texts = batch.column(column)
        begin = size = 0
        lengths = pa.compute.binary_length(texts).to_pylist()
        for k, n in enumerate(lengths):
            if k > begin and size + (n or 0) > most_bytes:
                yield batch.slice(begin, k - begin), texts.slice(begin, k - begin).to_pylist()
                begin, size = k, 0
            size += n or 0
        if begin < batch.num_rows:
            yield batch.slice(begin), texts.slice(begin).to_pylist()


def small_side(df: DataFrame, most: int = 100_000) -> DataFrame:
    """``df`` (cheap to count) marked for a join: broadcast if it has at most ``most`` rows, else the side that a shuffled join hashes."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df.hint("shuffle_hash")


def collect_garbage(spark: SparkSession) -> None:
    """Executors collect their garbage and give the heap they don't need back to the system, one short task a core. Else their heaps stay at the
    largest size of all that has run, beside what Python workers and native libraries hold."""
    cores = spark.sparkContext.defaultParallelism
    spark.range(0, cores, 1, cores).select(F.reflect(F.lit("java.lang.System"), F.lit("gc"))).collect()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
