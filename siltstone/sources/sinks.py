"""Sinks. Folders of part files are the rule; one file only where a reader elsewhere needs it, for tables that are known to be small."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.text import escape_html, escape_template, sanitize_file_name


def parquet(df: DataFrame, path: str, compression: str = "zstd", by: list[str] | None = None, mode: str = "overwrite") -> None:
    """zstd for cleaned tables, snappy for combined ones."""
    writer = df.write.mode(mode).option("compression", compression)
    (writer.partitionBy(*by) if by else writer).parquet(path)


def csv(df: DataFrame, path: str, mode: str = "overwrite", one_file: bool = False) -> None:
    """Null as '', nested cells as JSON text."""
    flat = df.select(*[F.coalesce(F.to_json(f.name), F.lit("")).alias(f.name) if f.dataType.typeName() in ("array", "map", "struct") else F.col(f"`{f.name}`") for f in df.schema])
    (flat.coalesce(1) if one_file else flat).write.mode(mode).options(header=True, quote='"', escape='"', nullValue="", emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def csv_by_key(df: DataFrame, path: str, key: str) -> None:
    """A folder for each key, its name fit for files."""
    df.withColumn("file", sanitize_file_name(F.col(key))).write.mode("overwrite").partitionBy("file").option("header", True).csv(path)


def renamed(spark: SparkSession, path: str, key: str, ending: str) -> None:
    """The single part file of each folder ``key``=name below ``path`` becomes name + ``ending``; '/' in names makes folders. One rename a file, by the driver."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path
    files = at(path).getFileSystem(conf)
    for found in files.globStatus(at(f"{path}/{key}=*/part-*")):
        folder = found.getPath().getParent()
        goal = at(f"{path}/{unquote(folder.getName().removeprefix(f'{key}='))}{ending}")
        files.mkdirs(goal.getParent())
        files.rename(found.getPath(), goal)
        files.delete(folder, True)


def csv_files(df: DataFrame, path: str, key: str) -> None:
    """One CSV file a key, named by it (made fit for files); the rows of a key are one task's."""
    named = df.withColumn(key, sanitize_file_name(F.col(key)))
    named.repartition(key).write.mode("overwrite").partitionBy(key).options(header=True, quote='"', escape='"', nullValue="", emptyValue="").csv(path)
    renamed(df.sparkSession, path, key, ".csv")


def text_files(df: DataFrame, path: str, name: str, body: str) -> None:
    """One file a record, under ``name``: ``body`` and a line end. '/' in names makes folders; records of one name share its file.

    On a file system that is mounted everywhere the tasks write each file under its own name; elsewhere Spark does, and the driver renames.
    """
    rows = df.select(F.col(name).alias("name"), F.coalesce(F.col(body), F.lit("")).alias("value"))
    root = mounted(df.sparkSession, path)
    if root is None:
        rows.write.mode("overwrite").partitionBy("name").text(path)
        return renamed(df.sparkSession, path, "name", "")
    if not rows.groupBy("name").count().filter("count > 1").isEmpty():
        rows = rows.repartition("name").sortWithinPartitions("name")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draft, goal, file = f".{uuid.uuid4().hex}", None, None  # files appear whole, also if a task is repeated
        for batch in batches:
            for own, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                place = os.path.join(root, own.lstrip("/"))
                if place != goal:
                    if file:
                        file.close()
                        os.replace(file.name, goal)
                    goal = place
                    os.makedirs(os.path.dirname(goal), exist_ok=True)
                    file = open(os.path.join(os.path.dirname(goal), draft), "wb")
                file.write(text.as_buffer())
                file.write(b"\n")
        if file:
            file.close()
            os.replace(file.name, goal)
        yield from ()

    unnamed = F.lit("__HIVE_DEFAULT_PARTITION__")  # as Spark's writer calls it
    conf, most = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    before = conf.get(most, None)
    conf.set(most, str(4 << 20))
    try:
        named = rows.select(F.coalesce(F.nullif("name", F.lit("")), unnamed).alias("name"), F.col("value").cast("binary").alias("value"))
        named.mapInArrow(write, "done int").write.format("noop").mode("overwrite").save()
    finally:
        conf.unset(most) if before is None else conf.set(most, before)


def mounted(spark: SparkSession, path: str) -> str | None:
    """The folder ``path``, made anew, as the operating system calls it; None (and nothing is made) if it lies in another file system."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(conf)
    if files.getUri().getScheme() != "file":
        return None
    files.delete(at, True)
    files.mkdirs(at)
    return files.makeQualified(at).toUri().getPath()


def sorted_lines(df: DataFrame, column: str, path: str, one_file: bool = False) -> None:
    """The different texts of a column, sorted."""
    lines = df.select(F.col(column).cast("string").alias("value")).filter("value is not null").distinct().orderBy("value")
    (lines.coalesce(1) if one_file else lines).write.mode("overwrite").text(path)


def ndjson(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def json_report(df: DataFrame, path: str) -> None:
    """One JSON array in one file, written by Spark; for reports of a few rows."""
    whole = df.agg(F.to_json(F.collect_list(F.struct(*df.columns)), {"ignoreNullFields": "false"}).alias("value"))
    whole.coalesce(1).write.mode("overwrite").text(path)


def html_report(title: str, summary: DataFrame, rows: DataFrame) -> str:
    """A static page of a summary and every row, in the tables' order, all text escaped. The page stands in the driver's memory."""
    cell = lambda c: escape_html(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")))
    line = lambda df, tag: F.concat(F.lit("<tr>"), *[F.concat(F.lit(f"<{tag}>"), cell(c), F.lit(f"</{tag}>")) for c in df.columns], F.lit("</tr>"))
    head = lambda df: "<tr>" + "".join(f"<th>{c}</th>" for c in df.columns) + "</tr>"
    tables = []
    for df in (summary, rows):
        body = "".join(r[0] for r in df.select(line(df, "td")).toLocalIterator())
        tables.append(f"<table>{head(df)}{body}</table>")
    return f"<!DOCTYPE html><html><head><meta charset='utf-8'><title>{title}</title></head><body><h1>{title}</h1>{''.join(tables)}</body></html>"


def canvas(rows: DataFrame) -> str:
    """A script module that holds every row, in the table's order, as a template literal of JSON. It stands in the driver's memory."""
    data = [r.asDict(recursive=True) for r in rows.toLocalIterator()]
    return f"export const rows = JSON.parse(`{escape_template(json.dumps(data, ensure_ascii=False, default=str))}`);\n"
