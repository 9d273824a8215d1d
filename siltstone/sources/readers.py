"""Sources: CSV folders, logs, line files, JSON documents, sitemaps, page caches. Schemas are declared, never inferred."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

#: Texts that count as missing in CSV files.
NA = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
#: Reports that stand among the review files.
NOT_REVIEWS = ("reviews_coverage_report.csv", "rescrape_summary.csv", "reviews_summary.csv")
REVIEW_FILE = "`Author` string, `Review URL` string, `Description` string, `Rating` string"


def csv(spark: SparkSession, path: str, schema: str, na: tuple[str, ...] = NA) -> DataFrame:
    """A CSV file or folder: header, quoted cells over several lines, quotes doubled; missing texts are null, bad bytes replaced, empty files empty."""
    df = spark.read.schema(schema).options(header=True, multiLine=True, quote='"', escape='"', encoding="UTF-8", mode="PERMISSIVE", enforceSchema=False).csv(path)
    texts = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
    return df.withColumns({c: F.when(~F.col(f"`{c}`").isin(*na), F.col(f"`{c}`")) for c in texts})


def review_folder(spark: SparkSession, path: str, source: str, skip: tuple[str, ...] = NOT_REVIEWS) -> DataFrame:
    """Review files, one a restaurant: the expected columns, the restaurant by the file's name, and the source."""
    files = spark.read.schema(REVIEW_FILE).options(header=True, multiLine=True, quote='"', escape='"', pathGlobFilter="*.csv").csv(path)
    name = F.url_decode(F.regexp_replace("_metadata.file_name", r"\+", "%2B"))
    rows = files.select("*", name.alias("__file")).filter(~F.col("__file").isin(*skip) & ~F.col("__file").startswith("."))
    return rows.select("Author", "Review URL", "Description", F.col("Rating").try_cast("double").alias("Rating"), F.regexp_replace("__file", r"\.csv$", "").alias("restaurant"), F.lit(source).alias("source"))


def forums(spark: SparkSession, root: str, slugs: list[str], table: str) -> DataFrame:
    """A table of several forums, with ``forum_slug``; a forum whose files are missing is an error."""
    from siltstone.operators.project import tagged_union

    return tagged_union({slug: spark.read.parquet(f"{root}/{slug}/{table}.parquet") for slug in slugs}, "forum_slug")


def line_set(spark: SparkSession, path: str, column: str = "line") -> DataFrame:
    """The different lines of a file that aren't blank."""
    return spark.read.text(path).select(F.trim("value").alias(column)).filter(F.col(column) != "").distinct()


def id_log(spark: SparkSession, path: str, column: str = "topic_id") -> DataFrame:
    return line_set(spark, path).filter(F.col("line").rlike(r"^\d+$")).select(F.col("line").cast("bigint").alias(column))


def failure_log(spark: SparkSession, path: str) -> DataFrame:
    """id, error, url lines, tab-separated; of an id the last line counts. Other lines are left out."""
    parts = F.split("value", "\t", 3)
    rows = spark.read.text(path).select("value", F.struct(F.col("_metadata.file_name"), F.monotonically_increasing_id()).alias("at"))
    named = rows.select("at", F.trim(F.get(parts, F.lit(0))).alias("id"), F.get(parts, F.lit(1)).alias("error"), F.get(parts, F.lit(2)).alias("url")).filter(F.col("id").rlike(r"^\d+$"))
    return named.groupBy(F.col("id").cast("bigint").alias("topic_id")).agg(F.max_by("error", "at").alias("error"), F.max_by("url", "at").alias("url"))


def url_list(spark: SparkSession, path: str, prefix: str, limit: int | None = None) -> DataFrame:
    """Lines that begin with ``prefix``, in the file's order."""
    rows = spark.read.text(path).select(F.trim("value").alias("url"), F.struct(F.col("_metadata.file_path"), F.monotonically_increasing_id()).alias("at")).filter(F.col("url").startswith(prefix))
    return (rows.orderBy("at").limit(limit) if limit else rows).select("url")


def json_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A file that is one JSON array of records; declare nested documents as string to keep their text."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def sitemap(spark: SparkSession, path: str) -> DataFrame:
    """kind ('url' or 'sitemap') and loc of sitemap files. A file without either tag is read as lines that begin with http."""
    text = spark.read.text(path, wholetext=True).select("value")
    tag = lambda name: F.regexp_extract_all("value", F.lit(rf"(?is)<{name}\b[^>]*>.*?<loc>\s*(?:<!\[CDATA\[)?\s*([^<\]]+?)\s*(?:\]\]>)?\s*</loc>"), F.lit(1))
    plain = F.regexp_extract_all("value", F.lit(r"(?m)^\s*(https?://\S+)"), F.lit(1))
    marked = F.col("value").rlike("(?i)<(?:url|sitemap)[\\s>]")
    entry = lambda kind: lambda loc: F.struct(F.lit(kind).alias("kind"), F.replace(loc, F.lit("&amp;"), F.lit("&")).alias("loc"))
    entries = F.when(marked, F.concat(F.transform(tag("sitemap"), entry("sitemap")), F.transform(tag("url"), entry("url")))).otherwise(F.transform(plain, entry("url")))
    return text.select(F.inline(entries)).distinct()


def sitemap_urls(spark: SparkSession, start: str, locate=lambda loc: loc) -> DataFrame:
    """All addresses below a sitemap: indexes are followed round by round, each once, until none is new. ``locate`` gives the path of a sitemap's file."""
    from functools import reduce

    waiting, seen, found = [start], set(), []
    while paths := [p for p in dict.fromkeys(map(locate, waiting)) if p not in seen]:
        seen.update(paths)
        rows = reduce(lambda a, b: a.unionByName(b), [sitemap(spark, p) for p in paths])
        found.append(rows.filter("kind = 'url'").select("loc"))
        waiting = [r.loc for r in rows.filter("kind = 'sitemap'").distinct().collect()]  # index files: few by the format's own rule
    return reduce(lambda a, b: a.unionByName(b), found).distinct()


def page_cache(spark: SparkSession, root: str) -> DataFrame:
    """topic_id, post_offset and html of cached pages at ``root``/<topic>/<offset>.html. A task lists the folders of many topics."""
    tasks = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(tasks, None)
    spark.conf.set(tasks, str(min(int(before or 10_000), 16 * spark.sparkContext.defaultParallelism)))  # else some thousands, most of one folder
    try:
        rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.html").load(root)
    finally:
        spark.conf.unset(tasks) if before is None else spark.conf.set(tasks, before)
    place = lambda n: F.regexp_extract("path", r"/(\d+)/(\d+)\.html$", n).try_cast("bigint")
    return rows.select(place(1).alias("topic_id"), place(2).alias("post_offset"), F.decode("content", "UTF-8").alias("html"))


def fetched(requests: DataFrame, pages: DataFrame, key: str = "url") -> DataFrame:
    """Requests with the pages that are stored for them: status 200 and html, or an error. Live fetching happens elsewhere."""
    there = pages.select(key, "html").withColumn("__there", F.lit(True))
    joined = requests.join(there, key, "left")
    return joined.select(*[c for c in requests.columns], F.when(F.col("__there"), 200).alias("status"), "html", F.when(F.col("__there").isNull(), "not stored").alias("error"))


def urlopen_page(url: str, timeout: float = 30.0) -> tuple[int, str]:
    """Status and text of an address, by the standard library."""
    from urllib.error import HTTPError
    from urllib.request import urlopen

    try:
        with urlopen(url, timeout=timeout) as answer:
            return answer.status, answer.read().decode(answer.headers.get_content_charset() or "utf-8", "replace")
    except HTTPError as e:
        return e.code, ""


def http_pages(requests: DataFrame, key: str = "url", get: Callable[[str], tuple[int, str]] = urlopen_page, tries: int = 3, wait: float = 1.0, pause: float = 0.0) -> DataFrame:
    """Requests with status, html and error, fetched by their tasks. After a status of 500 or more or an exception a task waits ``wait`` times the
    attempt's number and tries again, ``tries`` times at most; the last failure stands. ``pause`` seconds lie between a task's requests."""

    def fetch(url: str) -> tuple[int | None, str | None, str | None]:
        status, error = None, "no address"
        for attempt in range(1, tries + 1) if url else ():
            try:
                status, page = get(url)
                if status < 500:
                    return status, page, None if status < 400 else f"status {status}"
                error = f"status {status}"
            except Exception as e:  # whatever the address does is that row's error
                status, error = None, f"{type(e).__name__}: {e}"
            if attempt < tries:
                time.sleep(wait * attempt)
        return status, None, error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                row = batch.slice(n, 1)
                status, html, error = fetch(row.column(place)[0].as_py())
                yield pa.RecordBatch.from_arrays([*row.columns, pa.array([status], pa.int32()), pa.array([html], pa.string()), pa.array([error], pa.string())], names=[*row.schema.names, "status", "html", "error"])
                time.sleep(pause)

    place = requests.columns.index(key)
    return requests.mapInArrow(run, StructType([*requests.schema, StructField("status", IntegerType()), StructField("html", StringType()), StructField("error", StringType())]))


def extracted(df: DataFrame, prompt: Column, recorded: DataFrame, key: str) -> DataFrame:
    """A model's answers from a recorded table (key, answer); answers that are no JSON object become a parse error, whole."""
    answers = df.withColumn("prompt", prompt).join(recorded.select(key, "answer"), key, "left")
    good = F.json_object_keys(F.trim("answer")).isNotNull()
    failure = F.to_json(F.struct(F.when(F.col("answer").isNull(), "no answer").alias("_error"), F.col("answer").alias("_parse_error")))
    return answers.withColumn("extracted", F.when(good, F.trim("answer")).otherwise(failure)).drop("answer")
