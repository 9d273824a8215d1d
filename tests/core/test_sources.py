"""Sources, sinks, streams and plans on small files."""

import json
import re

import pytest
from pyspark.sql import functions as F

from siltstone.operators import aggregate, audit, dedupe, joins, pages, project, sample
from siltstone.plans import pipelines
from siltstone.sources import readers, sinks
from siltstone.streaming import ingest


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'topic_id,body\n1,"two\nlines ""q"""\n2,N/A\n3,bad \xff byte\n')
    rows = readers.csv(spark, str(tmp_path / "a.csv"), "topic_id bigint, body string").orderBy("topic_id").collect()
    assert rows[0].body == 'two\nlines "q"' and rows[1].body is None and rows[2].body.startswith("bad ") and rows[2].body.endswith(" byte")


def test_review_folder(spark, tmp_path):
    (tmp_path / "A Place+1.csv").write_text('Author,Review URL,Description,Rating\nx,u1,"a\nb",4.5\ny,,c,oops\n')
    (tmp_path / "reviews_coverage_report.csv").write_text("Author,Review URL,Description,Rating\nz,z,z,1\n")
    (tmp_path / ".hidden.csv").write_text("Author,Review URL,Description,Rating\nz,z,z,1\n")
    (tmp_path / "Empty.csv").write_text("")
    rows = readers.review_folder(spark, str(tmp_path), "reviews").orderBy("Author").collect()
    assert [(r.restaurant, r.Rating, r.source) for r in rows] == [("A Place+1", 4.5, "reviews"), ("A Place+1", None, "reviews")]


def test_logs_and_lists(spark, tmp_path):
    (tmp_path / "failed.log").write_text("7\tfirst\tu\nx\ty\tz\n7\tsecond\tv\tw\n8\n")
    got = {r.topic_id: (r.error, r.url) for r in readers.failure_log(spark, str(tmp_path / "failed.log")).collect()}
    assert got == {7: ("second", "v\tw"), 8: (None, None)}
    (tmp_path / "done.log").write_text("1\n\n 2 \n2\nx\n")
    assert sorted(r.topic_id for r in readers.id_log(spark, str(tmp_path / "done.log")).collect()) == [1, 2]
    (tmp_path / "urls.txt").write_text("https://h/b\nftp://x\nhttps://h/a\nhttps://h/c\n")
    assert [r.url for r in readers.url_list(spark, str(tmp_path / "urls.txt"), "https://h", 2).collect()] == ["https://h/b", "https://h/a"]


def test_sitemaps(spark, tmp_path):
    (tmp_path / "index.xml").write_text("<sitemapindex><sitemap><loc>one.xml</loc></sitemap><sitemap><loc>two.xml</loc></sitemap></sitemapindex>")
    (tmp_path / "one.xml").write_text("<urlset><url>\n<loc> https://h/drugs/a?x=1&amp;y=2 </loc></url><url><loc><![CDATA[https://h/cart]]></loc></url></urlset>")
    (tmp_path / "two.xml").write_text("https://h/otc/b 0.5\nnot one\nhttps://x/otc/c")
    found = readers.sitemap_urls(spark, str(tmp_path / "index.xml"), lambda loc: loc if "/" in loc else str(tmp_path / loc))
    assert sorted(r.loc for r in found.collect()) == ["https://h/cart", "https://h/drugs/a?x=1&y=2", "https://h/otc/b", "https://x/otc/c"]
    kept = pipelines.catalogue_urls(found, "h")
    assert [r.url for r in kept.collect()] == ["https://h/drugs/a", "https://h/otc/b"]
    assert {r.kind: r.n for r in pipelines.catalogue_profile(kept).collect()} == {"drug_page": 1, "otc_page": 1}


def test_page_cache_and_forum(spark, tmp_path):
    from tests.core.test_functions import TOPIC

    (tmp_path / "1002").mkdir()
    (tmp_path / "1002" / "0.html").write_text(TOPIC)
    (tmp_path / "1002" / "10.html").write_text(TOPIC)
    posts = pipelines.forum(readers.page_cache(spark, str(tmp_path)), "https://h.org/forum/")
    rows = posts.orderBy("position_in_topic").collect()
    assert [(r.page_index, r.position_in_topic, r.post_id) for r in rows] == [(1, 0, 4785), (1, 1, 4790), (2, 10, 4785), (2, 11, 4790)]
    clean = pipelines.clean_posts(posts)
    first, second = clean.orderBy("post_id").collect()
    assert clean.columns[:8] == pipelines.POST_COLUMNS[:8] and (first.post_offset, first.is_first_post, first.author_name_meta, first.author_age_at_dx, first.posted_month) == (0, True, "Ann", 56, "2012-04")
    assert second.posted_at_iso is None and second.body_word_count == 2
    stored = spark.createDataFrame([("u", "<p>x")], "url string, html string")
    asked = spark.createDataFrame([("u",), ("v",)], "url string")
    assert {r.url: (r.status, r.error) for r in readers.fetched(asked, stored).collect()} == {"u": (200, None), "v": (None, "not stored")}


def test_text_files(spark, tmp_path, monkeypatch):
    """One file a record, written by the tasks: the driver renames none. Names that come again lose no record, old files go."""
    monkeypatch.setattr(sinks, "renamed", lambda *a: pytest.fail("the driver renames"))
    df = spark.createDataFrame([(f"{k}/0.html", f"é\n{k}") for k in range(300)] + [("7/10.html", None), ("a b%/c.html", "x"), ("8/0.html", "again"), (None, "n")], "name string, html string").repartition(3)
    for rows, most in ((df, 303), (df.filter("html <> 'again'"), 302), (df.filter("name like '1/%'"), 1)):
        sinks.text_files(rows, f"file://{tmp_path}/cache", "name", "html")
        got = {str(p.relative_to(tmp_path / "cache")): p.read_text() for p in (tmp_path / "cache").rglob("*") if p.is_file()}
        want = {}
        for r in rows.collect():
            want.setdefault(r.name or "__HIVE_DEFAULT_PARTITION__", []).append((r.html or "") + "\n")
        assert got.keys() == want.keys() and len(got) == most
        assert all(got[k] in ("".join(v), "".join(v[::-1])) for k, v in want.items())
    pages = readers.page_cache(spark, str(tmp_path / "cache"))
    assert [tuple(r) for r in pages.collect()] == [(1, 0, "é\n1\n")]


def test_model_answers(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, text string")
    recorded = spark.createDataFrame([(1, ' {"x": 1} '), (2, "sorry")], "id int, answer string")
    got = {r.id: json.loads(r.extracted) for r in readers.extracted(df, F.col("text"), recorded, "id").collect()}
    assert got == {1: {"x": 1}, 2: {"_parse_error": "sorry"}, 3: {"_error": "no answer"}}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "b", ["x"], None), (2, "a/b", [], 'q"\n')], "id int, name string, l array<string>, t string")
    sinks.parquet(df, str(tmp_path / "p"), "snappy", by=["id"])
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2
    sinks.csv(df, str(tmp_path / "c"), one_file=True)
    back = readers.csv(spark, str(tmp_path / "c"), "id int, name string, l string, t string").orderBy("id").collect()
    assert [tuple(r) for r in back] == [(1, "b", '["x"]', None), (2, "a/b", "[]", 'q"\n')]
    sinks.csv_by_key(df.select("id", "name"), str(tmp_path / "k"), "name")
    assert sorted(p.name for p in (tmp_path / "k").glob("file=*")) == ["file=ab", "file=b"]
    sinks.sorted_lines(df, "name", str(tmp_path / "s"), one_file=True)
    assert [r.value for r in spark.read.text(str(tmp_path / "s")).collect()] == ["a/b", "b"]
    sinks.ndjson(df, str(tmp_path / "n"))
    assert '"t":null' in spark.read.text(str(tmp_path / "n")).filter("value like '%\"id\":1,%'").first().value
    sinks.json_report(df.select("id", "t").orderBy("id"), str(tmp_path / "j"))
    assert sorted(x["id"] for x in json.loads(spark.read.text(str(tmp_path / "j")).first().value)) == [1, 2]
    page = sinks.html_report("T", df.agg(F.count(F.lit(1)).alias("n")), spark.createDataFrame([("<b>",)], "x string"))
    assert "<td>&lt;b&gt;</td>" in page and "<td>2</td>" in page
    assert "JSON.parse(`" in sinks.canvas(df)


def test_schema_rules(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(project.SchemaMismatch):
        project.exactly(df, ["a"])
    assert project.coerced(df, {"b": "string", "c": "double"}).dtypes == [("b", "string"), ("c", "double")]
    assert project.union_all([df, df.drop("b")]).collect()[1].b is None
    with pytest.raises(ValueError):
        project.one_of("x", ["y"], "hub")
    counts = project.browse_counts(df, F.col("b"), F.lit(True), F.lit(False)).first()
    assert (counts.n, counts.rating_2, counts.with_extraction, counts.with_warnings) == (1, 1, 1, 0)


def test_joins(spark):
    left = spark.createDataFrame([(1, "x"), (None, "y"), (3, "z")], "k int, v string")
    right = spark.createDataFrame([(1, "a"), (None, "b")], "k int, w string")
    got = joins.many_to_one(left, right, ["k"])
    assert sorted((r.v, r.w, r.matched) for r in got.collect()) == [("x", "a", True), ("y", "b", True), ("z", None, False)] and joins.unmatched(got) == 1
    with pytest.raises(joins.NotUnique):
        joins.many_to_one(left, right.union(right), ["k"])
    base = spark.createDataFrame([("u1", "b"), ("u2", "b"), ("u2", "b"), ("", "b")], ["Review URL", "s"])
    newer = spark.createDataFrame([("u2", "n"), ("", "n")], ["Review URL", "s"])
    assert sorted(map(tuple, pipelines.canonical_reviews(base, newer).collect())) == [("", "b"), ("", "n"), ("u1", "b"), ("u2", "n")]


def test_samples(spark):
    rows = [(k, float(k % 9) / 2 + 1, "x" * (k % 300), "rescrape" if k % 10 == 0 else "reviews") for k in range(900)]
    df = spark.createDataFrame(rows, "id int, rating double, text string, source string")
    one, two = (sample.stratified(d, 50, "id", "rating", "text", "source").collect() for d in (df, df.repartition(5)))
    assert {r.id for r in one} == {r.id for r in two} and len({r.id for r in one}) == len(one) <= 50
    assert sample.budgets(10) == {"rated": 9, "long": 3, "short": 3, "empty": 2, "rescrape": 2}
    shown = sample.showcase(df, "id", ["id"], {"good": F.col("rating") >= 4.5, "any": F.lit(True), "none": F.lit(None).cast("boolean")})
    assert [(r["showcase_label"], r["id"]) for r in shown] == [("good", 7), ("any", 0)]


def test_audit(spark):
    topics = spark.createDataFrame([(1, 2), (2, 0), (3, 5)], "topic_id int, replies int")
    posts = spark.createDataFrame([(1, 10, 0, "a", "Thu Apr 19, 2012 2:19 pm"), (1, 11, 1, "", "x"), (2, 10, 3, "b", None)], "topic_id int, post_id int, position_in_topic int, body_text string, posted_at string")
    ids = lambda *k: spark.createDataFrame([(x,) for x in k], "topic_id int")
    report = audit.forum_report(topics, posts, ids(1, 9), ids(3))
    got = {r["name"]: (r.passed, r.checked, r.failed, r.examples) for r in report.collect()}
    assert got["per_topic_counts"] == (False, 2, 1, ["1"]) and got["global_id_uniqueness"] == (False, 2, 1, ["10"]) and got["per_topic_id_uniqueness"][0]
    assert got["coverage"] == (False, 3, 1, ["2"]) and got["position_contiguity"] == (False, 2, 1, ["2"]) and got["empty_bodies"][:3] == (True, 3, 1) and got["date_parseability"][2] == 2
    assert audit.exit_code(report) == 5 and audit.lines(report)[1].startswith("[FAIL] date_parseability")
    assert {(r.topic_id, r.what) for r in audit.coverage(topics, ids(1, 9), ids(3)).collect()} == {(2, "unaccounted"), (9, "extra")}


def test_streams(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    frame = lambda *k: spark.createDataFrame([(x, f"t{x}") for x in k], "id int, text string").coalesce(1)
    frame(1, 2).write.mode("append").parquet(src)
    stream = lambda: ingest.file_stream(spark, src, frame(1).schema, 1)
    work = lambda batch: batch.withColumn("n", F.length("text"))
    ingest.append_batches(stream(), work, out, ckpt).awaitTermination()
    frame(3).write.mode("append").parquet(src)
    for _ in range(2):  # a second start finds nothing new
        ingest.append_batches(stream(), work, out, ckpt).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2, 3]
    log = spark.createDataFrame([(1, "ok", 1), (2, "fetch_error", 1), (3, "fetch_error", 1), (3, "parse_error", 2)], "id int, status string, at int")
    assert [r.id for r in ingest.retryable(log, "id", "at").collect()] == [2]
    assert sorted(r.id for r in ingest.pending(frame(1, 2, 3, 4), log, "id").collect()) == [2, 4]
    report = spark.createDataFrame([("a", "x", 1, "no_dining_reviews"), ("a", "y", 2, "no_dining_reviews"), ("b", "z", 3, "has_reviews")], "normalized_url string, link string, ord int, coverage_status string")
    assert [r.link for r in ingest.by_report(report, ["no_dining_reviews"]).collect()] == ["x"]


def test_crawl(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("b", "skip"), ("x", "y")], "src string, dst string")
    got = {r.url: r.hop for r in ingest.crawl(links, ["a"], 10, F.col("dst") != "skip").collect()}
    assert got == {"a": 0, "b": 1, "c": 2}
    assert ingest.crawl(links, ["a"], 2).count() == 2


def test_failed_answers_stay_whole(spark):
    answer = "no object " * 300
    df = spark.createDataFrame([(1, "t"), (2, "u")], "id int, text string")
    recorded = spark.createDataFrame([(1, answer)], "id int, answer string")
    got = {r.id: json.loads(r.extracted) for r in readers.extracted(df, F.col("text"), recorded, "id").collect()}
    assert got == {1: {"_parse_error": answer}, 2: {"_error": "no answer"}}


def test_reports_hold_every_row(spark):
    rows = spark.range(2500).repartition(3).orderBy("id")
    page = sinks.html_report("T", rows.agg(F.count(F.lit(1)).alias("n")), rows)
    assert re.findall(r"<tr><td>(\d+)</td></tr>", page) == ["2500", *map(str, range(2500))]
    assert re.findall(r'"id": (\d+)', sinks.canvas(rows)) == [str(k) for k in range(2500)]


def test_long_chains(spark, tmp_path):
    """Neither a chain of more than 50 pages nor one of more than 20 sitemaps is left before its end; circles end."""
    links = spark.createDataFrame([(str(k), str((k + 1) % 60)) for k in range(60)], "src string, dst string").coalesce(1)
    assert {r.url: r.hop for r in ingest.crawl(links, ["0"]).collect()} == {str(k): k for k in range(60)}
    for k in range(23):
        (tmp_path / f"{k}.xml").write_text(f"<sitemapindex><sitemap><loc>{(k + 1) % 23}</loc></sitemap><url><loc>https://h/{k}</loc></url></sitemapindex>")
    found = readers.sitemap_urls(spark, "0", lambda loc: str(tmp_path / f"{loc}.xml"))
    assert {r.loc for r in found.collect()} == {f"https://h/{k}" for k in range(23)}


def test_windows_on_a_stream(spark, sf_dir):
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    counts = ingest.windowed_counts(spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir), "ts", "event_type")
    query = counts.writeStream.outputMode("complete").format("memory").queryName("windows").trigger(availableNow=True).start()
    query.awaitTermination()
    batch = ingest.windowed_counts(spark.read.parquet(f"{sf_dir}/events.parquet"), "ts", "event_type")
    pick = lambda d: sorted((r.window_start, r.event_type, r.n) for r in d.collect())
    assert pick(spark.table("windows")) == pick(batch)


def test_evidence(spark):
    df = spark.createDataFrame([("g", "noise", "loud"), ("g", "noise", "loud"), ("g", "noise", "low"), ("g", "noise", None)], "g string, f string, v string")
    r = aggregate.evidence(df, ["g"], "f", "v").first()
    assert r.distribution == {"loud": 2, "low": 1} and r["mode"] == "loud" and r.evidence_n == 3 and 0 < r.confidence < 1
    assert dedupe.row_index(df.filter("v is not null").withColumn("k", F.monotonically_increasing_id()), ["k"]).count() == 3
    assert pages.page_title(F.lit("x")) is not None


def test_http_pages(spark):
    """Failures are tried again, three times at most; the last one stands."""
    from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
    from threading import Thread

    asked = []

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            asked.append(self.path)
            status = {"/ok": 200, "/gone": 404, "/down": 503}.get(self.path, 200 if asked.count(self.path) > 1 else 500)
            self.send_response(status)
            self.end_headers()
            self.wfile.write(b"caf\xc3\xa9")

        def log_message(self, *args):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    requests = spark.createDataFrame([(f"{base}{p}", p) for p in ("/ok", "/gone", "/down", "/late")] + [(None, "none"), ("http://127.0.0.1:1/x", "refused")], "url string, path string")
    got = {r.path: r for r in readers.http_pages(requests, wait=0.01).collect()}
    server.shutdown()
    assert (got["/ok"].status, got["/ok"].html, got["/ok"].error) == (200, "café", None) and got["/late"].status == 200
    assert got["/gone"].status == 404 and got["/down"].error == "status 503" and got["none"].error == "no address" and "URLError" in got["refused"].error
    assert asked.count("/down") == 3 and asked.count("/gone") == 1 and asked.count("/late") == 2


def test_pages_that_raise(spark):
    """A page that can't be read is a row with its keys and the error; the others' rows stay."""

    def read(page):
        if page == "bad":
            raise ValueError("no page")
        return [{"topic_id": int(page)}] * 2

    df = spark.createDataFrame([(1, "5"), (2, "bad"), (3, None), (4, "7")], "k int, html string")
    got = pages.rows_of(df.filter("html is not null"), ["k"], "html", read, "topic_id bigint", most_bytes=0).collect()
    assert sorted((r.k, r.topic_id, r.error) for r in got if r.topic_id) == [(1, 5, None), (1, 5, None), (4, 7, None), (4, 7, None)]
    assert [(r.k, r.error) for r in got if r.error] == [(2, "ValueError: no page")]


def test_schema_rules():
    from siltstone.operators import nested

    schema = {"$defs": {"A": {"type": "object", "properties": {"next": {"$ref": "#/$defs/A"}, "kind": {"const": "x"}}}}, "type": "object", "required": ["a"], "properties": {"a": {"allOf": [{"$ref": "#/$defs/A"}]}, "n": {"type": ["integer", "null"]}, "gone": {"$ref": "#/$defs/B"}}}
    rules = nested.schema_rules(schema)
    assert ("a", "required", None) in rules and ("a.kind", "enum", "x") in rules and ("n", "type", "null") in rules and ("a.next", "field", None) in rules
    assert nested.legal_fields(rules) == {"a": ["kind", "next"]}
    assert nested.legal_fields(nested.schema_rules(schema, legal_scalars=True)) == {"a": ["kind", "next"], "gone": [], "n": []}


def test_normalised_dish_function():
    from siltstone.operators import nested

    assert nested.normalised({"dishes": [{"name": "a", "dish_function": ""}, {"dish_function": "main"}, {"dish_function": None}]}, []) == {"dishes": [{"name": "a"}, {"dish_function": "main"}, {}]}
