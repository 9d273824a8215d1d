"""The library's operators as registered queries over the driver's tables, each with its SQL where SQL can say it.

Names begin with the operator's mark in the survey (f1, j7, w1...). Tables stand in for others: conversations for posts, documents
for reviews, orders and lineitem for topics and posts, pages for address lists, events for logs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import classify, dates, jsons, text, urls
from siltstone.operators import aggregate, audit, dedupe, joins, nested, pages, project, sample
from siltstone.plans import pipelines
from siltstone.sources import readers, sinks
from siltstone.sources.shared import shared_folder
from siltstone.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


class Tables:
    """A folder's tables by name."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def c(name: str):
    return F.col(name)


def counted(*columns):
    return F.count(F.lit(1)).alias("n")


def say(*parts):
    """Texts and columns, one after the other."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def varied(forms: tuple[str | None, ...], which, value):
    """The ``which``-th of some texts, '{k}' in it replaced by ``value``."""
    return F.replace(F.get(F.array(*[F.lit(f) for f in forms]), F.pmod(which, F.lit(len(forms))).cast("int")), F.lit("{k}"), value.cast("string"))


def sql_varied(forms: tuple[str | None, ...], which: str, value: str) -> str:
    """``varied`` in SQL."""
    texts = ", ".join("NULL" if f is None else "'" + f.replace("'", "''") + "'" for f in forms)
    return f"replace(list_extract([{texts}], (({which}) % {len(forms)} + 1)::INT), '{{k}}', ({value})::VARCHAR)"


#: SQL for text functions that several queries use.
WORDS = r"len([w for w in string_split_regex(coalesce(text, ''), '\s+') if w <> ''])"
SLUG = "regexp_replace(regexp_replace(lower({0}), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"
PATH = r"regexp_extract(url, '^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)', 3)"
HOST = r"lower(regexp_extract(url, '^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)', 2))"


# ---- projections ----


@query(f"SELECT conv_id, turn, turn = 0 AS is_first, length(coalesce(text, '')) AS chars, {WORDS} AS words FROM conversations")
def p1_derived_columns(spark, sf):
    return Tables(spark, sf).conversations.select("conv_id", "turn", (c("turn") == 0).alias("is_first"), text.char_count(c("text")).cast("long").alias("chars"), text.word_count(c("text")).cast("long").alias("words"))


@query("SELECT n_name, n_nationkey, n_regionkey FROM nation")
def p2_ordered_columns(spark, sf):
    return project.ordered(Tables(spark, sf).nation.select("n_nationkey", "n_regionkey", "n_name"), ["n_name", "absent"])


@query("SELECT n_nationkey, n_name AS nation_n_name, n_regionkey AS nation_n_regionkey FROM nation")
def p4_prefixed_columns(spark, sf):
    df = Tables(spark, sf).nation
    return project.prefixed(project.exactly(df.select("n_nationkey", "n_name", "n_regionkey"), ["n_nationkey", "n_name", "n_regionkey"]), "nation_", ["n_nationkey"])


@query(f"SELECT page_id, lower(trim(url)) LIKE '%example.com%' AS mentioned, {HOST} AS host, {HOST} = 'ththan.example.com' AS own, {PATH} LIKE '/en/%' OR {PATH} LIKE '/fr/%' AS allowed FROM pages")
def p5_p7_p8_url_predicates(spark, sf):
    df = Tables(spark, sf).pages
    return df.select("page_id", urls.mentions(c("url"), "example.com").alias("mentioned"), urls.host(c("url")).alias("host"), urls.on_host(c("url"), "ththan.example.com").alias("own"), urls.allowed(c("url"), ("/en/", "/fr/"), ("/de/",)).alias("allowed"))


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'P')")
def p6_status_filter(spark, sf):
    return Tables(spark, sf).orders.filter(c("o_orderstatus").isin("F", "P")).select("o_orderkey", "o_orderstatus")


@query("SELECT doc_id, CASE WHEN n_chars >= 400 THEN 'long' WHEN n_chars >= 30 THEN 'text' ELSE 'short' END AS size FROM documents WHERE n_chars BETWEEN 15 AND 5000")
def p9_ranges(spark, sf):
    return Tables(spark, sf).documents.filter(c("n_chars").between(15, 5000)).select("doc_id", F.when(c("n_chars") >= 400, "long").when(c("n_chars") >= 30, "text").otherwise("short").alias("size"))


@query("SELECT p_partkey, p_size FROM part WHERE CASE WHEN p_size / 10.0 <= 1.5 THEN '1' WHEN p_size / 10.0 <= 2.5 THEN '2' WHEN p_size / 10.0 <= 3.5 THEN '3' WHEN p_size / 10.0 <= 4.5 THEN '4' ELSE '5' END = '2' AND lower(p_name || ' ' || p_type) LIKE '%a%' AND p_brand IS NOT NULL")
def p10_browse(spark, sf):
    df = Tables(spark, sf).part
    return project.browse(df, c("p_size") / 10.0, c("p_brand"), c("p_brand").isNotNull(), F.lit(False), F.concat_ws(" ", "p_name", "p_type"), bucket="2", content="with_extraction", search="A").select("p_partkey", "p_size")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey IN (1, 2, 3, 40)")
def p11_id_list(spark, sf):
    return Tables(spark, sf).orders.filter(project.in_list(c("o_orderkey"), "t1, 2;3,40")).select("o_orderkey")


# ---- joins ----


@query("SELECT l_orderkey, l_linenumber, p_name AS part_p_name, p_partkey IS NOT NULL AS matched FROM lineitem LEFT JOIN part ON l_partkey = p_partkey * 2")
def j1_many_to_one(spark, sf):
    """Odd keys find no part."""
    t = Tables(spark, sf)
    right = project.prefixed(t.part.select((c("p_partkey") * 2).alias("l_partkey"), "p_name"), "part_", ["l_partkey"])
    return joins.many_to_one(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), right, ["l_partkey"]).drop("l_partkey")


@query("SELECT c_custkey, coalesce(n, 0) AS orders FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON c_custkey = o_custkey")
def j2_lookup_count(spark, sf):
    t = Tables(spark, sf)
    return joins.lookup_count(t.customer.select("c_custkey"), t.orders, "c_custkey", "o_custkey", "orders")


@query("WITH e AS (SELECT CASE WHEN user_id % 7 = 0 THEN ' ' ELSE user_id::VARCHAR END AS k, event_id, event_type FROM events), n AS (SELECT * FROM e WHERE event_type = 'purchase') SELECT k, event_id, event_type FROM n UNION ALL SELECT k, event_id, event_type FROM e WHERE event_type <> 'purchase' AND trim(k) NOT IN (SELECT trim(k) FROM n WHERE trim(k) <> '')")
def j3_override(spark, sf):
    e = Tables(spark, sf).events.select(F.when(c("user_id") % 7 == 0, " ").otherwise(c("user_id").cast("string")).alias("k"), "event_id", "event_type")
    return joins.override(e.filter("event_type <> 'purchase'"), e.filter("event_type = 'purchase'"), "k")


@query("SELECT c_custkey, 'absent' AS what FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) UNION ALL SELECT c_custkey, 'present' FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def j4_anti_and_semi(spark, sf):
    t = Tables(spark, sf)
    have, log = t.customer.select("c_custkey"), t.orders.select(c("o_custkey").alias("c_custkey"))
    return joins.not_in(have, log, ["c_custkey"]).withColumn("what", F.lit("absent")).unionByName(joins.only_in(have, log, ["c_custkey"]).withColumn("what", F.lit("present")))


@query("SELECT p_partkey, CASE WHEN p_partkey IN (SELECT l_partkey * 3 FROM lineitem) THEN 'yes' ELSE 'no' END AS sold FROM part")
def j5_flag(spark, sf):
    t = Tables(spark, sf)
    return joins.with_flag(t.part.select("p_partkey"), t.lineitem.select((c("l_partkey") * 3).alias("p_partkey")), "p_partkey", "sold", "yes", "no")


@query(f"""WITH f AS (SELECT {SLUG.format("c_name")} AS name, min(c_name) AS file FROM customer GROUP BY 1)
    SELECT s_suppkey, coalesce(a.file, b.file) AS file FROM supplier
    LEFT JOIN f a ON a.name = 'customer-' || lpad((s_suppkey * 3)::VARCHAR, 9, '0') LEFT JOIN f b ON b.name = 'customer-' || lpad(s_suppkey::VARCHAR, 9, '0')""")
def j6_priority_candidates(spark, sf):
    t = Tables(spark, sf)
    name = lambda n: F.concat(F.lit("customer-"), F.lpad(n.cast("string"), 9, "0"))
    rows = t.supplier.select("s_suppkey", F.array(name(c("s_suppkey") * 3), name(c("s_suppkey"))).alias("candidates"))
    files = t.customer.select(text.slugify(c("c_name")).alias("name"), c("c_name").alias("file"))
    return joins.by_priority(rows, "s_suppkey", "candidates", files, "name", "file").select("s_suppkey", "file")


@query(f"""WITH a AS (SELECT DISTINCT {SLUG.format("p_name")} AS a FROM part), b AS (SELECT {SLUG.format("p_name || ' ' || p_brand")} AS b, min(p_name || ' ' || p_brand) AS file FROM part GROUP BY 1),
    t AS (SELECT a, b, file, [x for x in list_distinct(string_split(a, '-')) if length(x) > 2] AS x, [y for y in list_distinct(string_split(b, '-')) if length(y) > 2] AS y FROM a, b),
    s AS (SELECT a, file, CASE WHEN a = b THEN 1.0 WHEN contains(a, b) OR contains(b, a) THEN 0.92 WHEN len(x) = 0 OR len(y) = 0 THEN 0.0 ELSE len(list_intersect(x, y))::DOUBLE / len(list_distinct(x || y)) END AS score FROM t),
    m AS (SELECT a, file, score, row_number() OVER (PARTITION BY a ORDER BY score DESC, file) AS r FROM s WHERE score >= 0.3)
    SELECT a AS slug, file, score::DOUBLE AS score FROM m WHERE r = 1""")
def j7_fuzzy_slugs(spark, sf):
    part = Tables(spark, sf).part
    rows = part.select(text.slugify(c("p_name")).alias("slug")).distinct()
    files = part.select(F.concat_ws(" ", "p_name", "p_brand").alias("file")).distinct().withColumn("b", text.slugify(c("file")))
    return joins.fuzzy_slugs(rows, "slug", "slug", files, "file", "b", 0.3)


@query("SELECT coalesce(a.k, b.k) AS k, coalesce(a.n, 0) AS before, coalesce(b.n, 0) AS after, coalesce(b.n, 0) - coalesce(a.n, 0) AS delta FROM (SELECT user_id AS k, count(*) AS n FROM events WHERE event_type = 'click' GROUP BY 1) a FULL JOIN (SELECT user_id AS k, count(*) AS n FROM events WHERE value > 50 GROUP BY 1) b ON a.k = b.k")
def j9_compare_runs(spark, sf):
    e = Tables(spark, sf).events
    runs = [aggregate.counts(e.filter(f).withColumnRenamed("user_id", "k"), ["k"]) for f in ("event_type = 'click'", "value > 50")]
    return joins.compare_runs(*runs, ["k"], "n")


@query("SELECT r_name, o_orderpriority FROM region, (SELECT DISTINCT o_orderpriority FROM orders)")
def j10_jobs(spark, sf):
    t = Tables(spark, sf)
    return joins.jobs(t.region.select("r_name"), t.orders.select("o_orderpriority").distinct())


# ---- sets ----


@query("SELECT c_name AS name, c_nationkey AS nation, 'customer' AS source FROM customer UNION ALL SELECT s_name, s_nationkey, 'supplier' FROM supplier")
def u1_s7_tagged_union(spark, sf):
    t = Tables(spark, sf)
    return project.tagged_union({"customer": t.customer.select(c("c_name").alias("name"), c("c_nationkey").alias("nation")), "supplier": t.supplier.select(c("s_name").alias("name"), c("s_nationkey").alias("nation"))}, "source")


@query("SELECT o_custkey AS k FROM orders UNION SELECT user_id FROM events")
def u2_key_union(spark, sf):
    t = Tables(spark, sf)
    return project.key_union(t.orders.select(c("o_custkey").alias("k")), t.events.select(c("user_id").alias("k")))


@query("SELECT k, 'left' AS side FROM (SELECT o_custkey AS k FROM orders EXCEPT SELECT user_id FROM events) UNION ALL SELECT k, 'right' FROM (SELECT user_id AS k FROM events EXCEPT SELECT o_custkey FROM orders)")
def u3_difference(spark, sf):
    t = Tables(spark, sf)
    return project.symmetric_difference(t.orders.select(c("o_custkey").alias("k")), t.events.select(c("user_id").alias("k")))


@query("SELECT DISTINCT url FROM pages ORDER BY url")
def u4_k6_distinct_sorted(spark, sf):
    return project.distinct_sorted(Tables(spark, sf).pages, "url")


# ---- order-aware ----


@query("SELECT l_orderkey, l_partkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey % 3 ORDER BY l_linenumber, l_partkey) AS n FROM lineitem) WHERE n = 1")
def w1_keep_first(spark, sf):
    df = Tables(spark, sf).lineitem.withColumn("k", c("l_partkey") % 3)
    return dedupe.keep_first(df, ["l_orderkey", "k"], ["l_linenumber", "l_partkey"]).select("l_orderkey", "l_partkey", "l_linenumber")


@query(f"SELECT {HOST} AS host, min(page_id) AS page_id, arg_min(url, page_id) AS url FROM pages GROUP BY 1")
def w2_first_by_key(spark, sf):
    df = Tables(spark, sf).pages.select(urls.host(c("url")).alias("host"), "page_id", "url")
    return dedupe.first_value_by(df.withColumn("ord", c("page_id")), ["host"], "ord").select("host", "page_id", "url")


@query("SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_type, event_id) AS n FROM events) WHERE n = 1 ORDER BY event_type, event_id LIMIT 100")
def w3_first_over_pages(spark, sf):
    return dedupe.keep_first_pages(Tables(spark, sf).events.select("user_id", "event_type", "event_id"), "user_id", ["event_type", "event_id"], 100)


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events) WHERE n = 1")
def w4_keep_last(spark, sf):
    return dedupe.keep_last(Tables(spark, sf).events.select("user_id", "event_id", "event_type"), ["user_id"], ["event_id"])


@query("SELECT o_custkey, o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'P' UNION ALL SELECT o_custkey, o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P' AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def w5_append_unseen(spark, sf):
    o = Tables(spark, sf).orders.select("o_custkey", "o_orderkey", "o_orderstatus")
    return dedupe.append_unseen(o.filter("o_orderstatus = 'P'"), o.filter("o_orderstatus <> 'P'"), ["o_custkey"])


@query("SELECT o_custkey, arg_max(o_orderkey, o_orderkey) AS o_orderkey, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY 1")
def w6_last_wins(spark, sf):
    o = Tables(spark, sf).orders.select("o_custkey", "o_orderkey", "o_orderstatus").withColumn("ord", c("o_orderkey"))
    return dedupe.first_value_by(o, ["o_custkey"], "ord", last=True).drop("ord")


@query("SELECT o_custkey, o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'P' UNION ALL SELECT o_custkey, o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P' AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def w7_upsert(spark, sf):
    o = Tables(spark, sf).orders.select("o_custkey", "o_orderkey", "o_orderstatus")
    return dedupe.upsert(o.filter("o_orderstatus <> 'P'"), o.filter("o_orderstatus = 'P'"), ["o_custkey"])


@query("SELECT l_orderkey, l_linenumber, dense_rank() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber // 2) AS page FROM lineitem")
def w9_page_index(spark, sf):
    df = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", F.floor(c("l_linenumber") / 2).alias("o"))
    return df.select("l_orderkey", "l_linenumber", dedupe.page_index(["l_orderkey"], "o").cast("long").alias("page"))


@query("SELECT o_orderkey, array_to_string(list_sort(list_distinct([o_orderkey % 50] || range(0, (1 + o_orderkey % 4) * 10, 10))), ',') AS offsets FROM orders")
def w10_dense_offsets(spark, sf):
    o = Tables(spark, sf).orders
    own = dedupe.dense_offsets(F.array(c("o_orderkey") % 50), 1 + c("o_orderkey") % 4)
    return o.select("o_orderkey", F.array_join(own.cast("array<string>"), ",").alias("offsets"))


@query("SELECT l_orderkey, count(*) AS n, min(p) = 0 AND max(p) = count(*) - 1 AND count(DISTINCT p) = count(*) AS contiguous FROM (SELECT l_orderkey, l_linenumber - 1 + CASE WHEN l_orderkey % 3 = 0 AND l_linenumber > 2 THEN l_orderkey % 2 ELSE 0 END AS p FROM lineitem) GROUP BY 1")
def w12_q5_contiguity(spark, sf):
    """Positions of some orders leave one out."""
    p = c("l_linenumber") - 1 + F.when((c("l_orderkey") % 3 == 0) & (c("l_linenumber") > 2), c("l_orderkey") % 2).otherwise(0)
    return dedupe.contiguity(Tables(spark, sf).lineitem.withColumn("p", p), ["l_orderkey"], "p").select("l_orderkey", "n", "contiguous")


@query("WITH p AS (SELECT DISTINCT o_orderpriority AS job, o_custkey AS k FROM orders), f AS (SELECT k, min(job) AS job FROM p GROUP BY 1), n AS (SELECT job, count(*) AS new FROM f GROUP BY 1), o AS (SELECT job, count(*) AS on_page FROM p GROUP BY 1) SELECT o.job, on_page, coalesce(new, 0) AS new_vs_prior, sum(coalesce(new, 0)) OVER (ORDER BY o.job)::BIGINT AS total_so_far FROM o LEFT JOIN n ON o.job = n.job")
def w13_running_new(spark, sf):
    return dedupe.running_new(Tables(spark, sf).orders.select(c("o_orderpriority").alias("job"), c("o_custkey").alias("k")), "k", "job")


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS idx FROM orders")
def w14_row_index(spark, sf):
    return dedupe.row_index(Tables(spark, sf).orders.select("o_orderdate", "o_orderkey"), ["o_orderdate", "o_orderkey"]).select("o_orderkey", "idx")


@query("WITH p AS (SELECT l_orderkey, l_linenumber AS page, array_to_string(list_sort(list(DISTINCT l_returnflag)), ',') AS k FROM lineitem GROUP BY 1, 2), s AS (SELECT *, coalesce((k = lag(k) OVER (PARTITION BY l_orderkey ORDER BY page))::INT, 0) AS same FROM p), g AS (SELECT *, max(same) OVER (PARTITION BY l_orderkey ORDER BY page) AS again FROM s) SELECT l_orderkey, page FROM g WHERE again = 0")
def u6_until_repeat(spark, sf):
    df = Tables(spark, sf).lineitem.select("l_orderkey", c("l_linenumber").alias("page"), "l_returnflag")
    return dedupe.until_repeat(df, ["l_orderkey"], "page", "l_returnflag").select("l_orderkey", "page").distinct()


# ---- aggregates ----


@query("SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY 1")
def a1_counts(spark, sf):
    return aggregate.counts(Tables(spark, sf).documents, ["lang"])


@query("SELECT text, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def a2_repeated(spark, sf):
    return aggregate.repeated(Tables(spark, sf).documents, ["text"])


@query("SELECT 'lang' AS \"column\", count(lang) AS filled, count(DISTINCT lang) AS different FROM documents UNION ALL SELECT 'source', count(source), count(DISTINCT source) FROM documents")
def a3_a4_profile(spark, sf):
    return aggregate.profile(Tables(spark, sf).documents, ["lang", "source"])


@query("SELECT source, count(*) FILTER (n_chars >= 1000) AS long, count(*) FILTER (lang = 'en') AS en, round(100 * count(*) FILTER (lang = 'en') / greatest(count(*), 1), 1) AS en_percent FROM documents GROUP BY 1")
def a5_a7_conditional(spark, sf):
    en = F.count_if(c("lang") == "en")
    return Tables(spark, sf).documents.groupBy("source").agg(F.count_if(c("n_chars") >= 1000).alias("long"), en.alias("en"), text.percentage(en, F.count(F.lit(1))).alias("en_percent"))


@query("SELECT round(sum(n_chars) / 1e6 * 0.10 + count(*) / 1e6 * 0.40, 6) AS cost, round(sum(n_chars) / 1e6 * 0.10 / count(*) * 2955778 * 0.5, 2) AS batch FROM documents")
def a6_a14_cost(spark, sf):
    total, n = F.sum("n_chars"), F.count(F.lit(1))
    return Tables(spark, sf).documents.agg(F.round(aggregate.token_cost(total, n), 6).alias("cost"), aggregate.cost_projection(total / 1e6 * aggregate.PRICE_IN / n)[1].alias("batch"))


@query("SELECT quantile_cont(n_chars, 0.95) AS q95 FROM documents")
def a8_quantile(spark, sf):
    return Tables(spark, sf).documents.agg(F.percentile("n_chars", F.lit(0.95)).alias("q95"))


@query(f"SELECT string_split({PATH}, '/')[2] AS kind, count(*) AS n, count(DISTINCT url) AS different FROM pages GROUP BY 1")
def a9_histogram(spark, sf):
    return aggregate.histogram(Tables(spark, sf).pages, F.get(urls.path_parts(c("url")), F.lit(0)), "url")


@query("SELECT count(*) AS total, count(DISTINCT url) AS different, count(*) - count(DISTINCT url) AS repeats FROM pages")
def a9_duplicates(spark, sf):
    return aggregate.duplicates(Tables(spark, sf).pages, "url")


@query(r"SELECT item, count(*) AS n FROM (SELECT unnest([w for w in string_split_regex(text, '\s+') if w <> '']) AS item FROM benchmark) GROUP BY 1")
def a10_item_histogram(spark, sf):
    return aggregate.item_histogram(Tables(spark, sf).benchmark.select(text.word_list(c("text")).alias("w")), "w")


@query("WITH p AS (SELECT o_orderpriority AS field, o_custkey AS value, count(*) AS n FROM orders GROUP BY 1, 2), r AS (SELECT *, sum(n) OVER (PARTITION BY field)::BIGINT AS total, row_number() OVER (PARTITION BY field ORDER BY n DESC, value) AS rank FROM p) SELECT * FROM r WHERE rank <= 8")
def a11_two_level(spark, sf):
    return aggregate.two_level(Tables(spark, sf).orders.select(c("o_orderpriority").alias("field"), c("o_custkey").alias("value")), "field", "value").withColumn("rank", c("rank").cast("long"))


@query("WITH d AS (SELECT DISTINCT o_orderpriority, o_custkey FROM orders), r AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_custkey) AS n FROM d) SELECT o_orderpriority, array_to_string(list(o_custkey ORDER BY o_custkey), ',') AS examples FROM r WHERE n <= 5 GROUP BY 1")
def a12_examples(spark, sf):
    found = aggregate.examples(Tables(spark, sf).orders, ["o_orderpriority"], "o_custkey", 5)
    return found.select("o_orderpriority", F.array_join(c("examples").cast("array<string>"), ",").alias("examples"))


OUTCOME = "CASE WHEN o_orderstatus = 'P' THEN 'error' WHEN b <= 0 AND a > 0 THEN 'gained_reviews' WHEN a > b THEN 'more_reviews' WHEN a <= 0 THEN 'still_empty' ELSE 'unchanged' END"


@query(f"SELECT outcome, count(*) AS n, sum(a - b)::BIGINT AS delta FROM (SELECT *, {OUTCOME} AS outcome FROM (SELECT o_orderstatus, o_orderkey % 5 - 1 AS b, o_custkey % 4 - 1 AS a FROM orders)) GROUP BY 1")
def a13_c8_outcomes(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderstatus", (c("o_orderkey") % 5 - 1).alias("b"), (c("o_custkey") % 4 - 1).alias("a"))
    return o.groupBy(classify.rescrape_outcome(c("b"), c("a"), c("o_orderstatus") == "P").alias("outcome")).agg(counted(), F.sum(c("a") - c("b")).alias("delta"))


@query("SELECT p_brand, count(*) AS n, round(100.0 * count(*) / greatest(max(count(*)) OVER (), 1), 1) AS bar FROM part GROUP BY 1")
def a15_bar_scale(spark, sf):
    per = aggregate.counts(Tables(spark, sf).part, ["p_brand"])
    return per.withColumn("bar", aggregate.bar_scale(per, c("n")))


# ---- order, limit, samples ----


@query("WITH p AS (SELECT source, count(*) AS n FROM documents GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, source) AS k FROM p) SELECT CASE WHEN k <= 5 THEN source ELSE '(rest)' END AS source, sum(n)::BIGINT AS n FROM r GROUP BY 1")
def t3_top_and_rest(spark, sf):
    return aggregate.top_and_rest(Tables(spark, sf).documents, "source", 5)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 10")
def t1_t5_page(spark, sf):
    return aggregate.page_of(Tables(spark, sf).orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], 10, 20)


@query("SELECT p_type, count(*) AS n FROM part WHERE p_type IS NOT NULL GROUP BY 1 ORDER BY n DESC, p_type LIMIT 8")
def t4_most_common(spark, sf):
    return aggregate.value_counts(Tables(spark, sf).part, "p_type").limit(8)


STRATA = " UNION ALL ".join([f"SELECT *, {k} AS stratum, 5 AS take FROM d WHERE rating = {r} AND len >= 30" for k, r in enumerate(sample.RATINGS)] + ["SELECT *, 9, 15 FROM d WHERE len >= q", "SELECT *, 10, 15 FROM d WHERE len >= 15 AND len < 50", "SELECT *, 11, 10 FROM d WHERE len < 15", "SELECT *, 12, 10 FROM d WHERE source = 'src1'"])


@query(f"""WITH d AS (SELECT doc_id, source, (2 + doc_id % 9) / 2.0 AS rating, length(coalesce(text, '')) AS len, md5('42:' || doc_id::VARCHAR) AS h, quantile_cont(length(coalesce(text, '')), 0.95) OVER () AS q FROM documents),
    s AS ({STRATA}), n AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY h, doc_id) AS n FROM s), k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY stratum) AS f FROM n WHERE n <= take)
    SELECT doc_id, stratum FROM k WHERE f = 1 ORDER BY h, doc_id LIMIT 100""")
def t6_stratified_sample(spark, sf):
    d = Tables(spark, sf).documents.select("doc_id", "text", F.when(c("source") == "src1", "rescrape").otherwise("reviews").alias("source"), ((2 + c("doc_id") % 9) / 2).alias("rating"))
    return sample.stratified(d, 100, "doc_id", "rating", "text", "source").select("doc_id", "stratum")


# ---- functions ----


@query(f"""SELECT page_id, regexp_extract(regexp_replace(url, '/+$', ''), '([^/]*)$', 1) AS url_slug, {SLUG.format("url")} AS slug,
    regexp_replace(regexp_replace(trim(url), '[#?].*$', ''), '/+$', '') AS base_url, 'https://h.org' || {PATH} AS absolute, len([p for p in string_split({PATH}, '/') if p <> '']) AS parts FROM pages""")
def f1_f2_f3_f10_f11_urls(spark, sf):
    return Tables(spark, sf).pages.select("page_id", urls.url_slug(c("url")).alias("url_slug"), text.slugify(c("url")).alias("slug"), urls.base_url(c("url")).alias("base_url"), urls.absolute(c("url"), "h.org").alias("absolute"), F.size(urls.path_parts(c("url"))).cast("long").alias("parts"))


@query("""WITH u AS (SELECT o_orderkey, 'https://h.org/c/x' || o_orderkey::VARCHAR || list_extract(['', '/reviews', '/info', '/order', '/order/info', '/info/order', '/reviews?page=2#a'], (o_orderkey % 7 + 1)::INT) AS url FROM orders), b AS (SELECT *, regexp_replace(regexp_replace(url, '[#?].*$', ''), '/+$', '') AS x FROM u)
    SELECT o_orderkey, regexp_replace(regexp_replace(regexp_replace(x, '/reviews$', ''), '/info$', ''), '/order$', '') AS base, CASE WHEN x LIKE '%/order' THEN regexp_replace(x, '/order$', '/info') ELSE url END AS info,
    CASE WHEN url LIKE '%/delivery/%' THEN 'delivery_other' WHEN url LIKE '%/order' THEN 'order' WHEN url LIKE '%/info' THEN 'info' ELSE 'other' END AS kind FROM b""")
def f3_f4_c6_listing_urls(spark, sf):
    ends = F.array(*[F.lit(e) for e in ("", "/reviews", "/info", "/order", "/order/info", "/info/order", "/reviews?page=2#a")])
    url = F.concat(F.lit("https://h.org/c/x"), c("o_orderkey").cast("string"), F.get(ends, (c("o_orderkey") % 7).cast("int")))
    return Tables(spark, sf).orders.select("o_orderkey", urls.base_url(url).alias("base"), urls.prefer_info(url).alias("info"), classify.listing_type(url).alias("kind"))


@query("""WITH u AS (SELECT o_orderkey, 'https://h.org/forum/a-topic-t' || o_orderkey::VARCHAR || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE '-' || (o_orderkey % 3 * 10)::VARCHAR END || '.html' || CASE WHEN o_orderkey % 5 = 0 THEN 'x' ELSE '' END AS url FROM orders)
    SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey END AS topic_id, CASE WHEN o_orderkey % 5 <> 0 THEN (o_orderkey % 3 * 10)::INT END AS post_offset, 'a-topic' AS slug FROM u""")
def f12_f13_topic_urls(spark, sf):
    k = c("o_orderkey")
    url = F.concat(F.lit("https://h.org/forum/a-topic-t"), k.cast("string"), F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("-"), (k % 3 * 10).cast("string"))), F.lit(".html"), F.when(k % 5 == 0, "x").otherwise(""))
    return Tables(spark, sf).orders.select("o_orderkey", urls.topic_id(url).alias("topic_id"), urls.post_offset(url).alias("post_offset"), urls.topic_slug(url).alias("slug"))


@query("""SELECT p_partkey, CASE WHEN 1900 + p_partkey % 200 BETWEEN 1950 AND 2099 THEN (1900 + p_partkey % 200)::INT END AS year, CASE WHEN p_size BETWEEN 1 AND 110 THEN p_size::INT END AS age, (p_partkey % 1000)::BIGINT AS first_int, p_partkey * 1000 + 7 AS declared, round(p_retailprice, 2) AS price FROM part""")
def f15_f16_f17_f18_f21_numbers(spark, sf):
    k = c("p_partkey")
    said = F.concat(F.lit("in "), (1900 + k % 200).cast("string"), F.lit(" or 2001"))
    return Tables(spark, sf).part.select("p_partkey", text.extract_year(said).alias("year"), text.extract_age(F.concat(F.lit("about "), c("p_size").cast("string"))).alias("age"), text.first_int(F.concat(F.lit("x "), (k % 1000).cast("string"), F.lit(",784"))).alias("first_int"), text.declared_total(F.concat(F.format_number(k * 1000 + 7, 0), F.lit(" Topics")), "topics").alias("declared"), F.round(text.to_number(F.concat(F.lit(" "), c("p_retailprice").cast("string"))), 2).alias("price"))


@query(f"SELECT doc_id, {WORDS} AS words, length(text) AS chars, left(string_split(text, chr(10))[1], 120) AS head, CASE WHEN length(trim(replace(text, chr(10), ' '))) > 40 THEN left(trim(replace(text, chr(10), ' ')), 40) || '…' ELSE trim(replace(text, chr(10), ' ')) END AS short FROM documents")
def f19_f20_f25_f33_text(spark, sf):
    t = c("text")
    return Tables(spark, sf).documents.select("doc_id", text.word_count(t).cast("long").alias("words"), text.char_count(t).cast("long").alias("chars"), text.first_line(t).alias("head"), text.truncate(t, 40).alias("short"))


BUCKET = "CASE WHEN x IS NULL THEN '?' WHEN x <= 1.5 THEN '1' WHEN x <= 2.5 THEN '2' WHEN x <= 3.5 THEN '3' WHEN x <= 4.5 THEN '4' ELSE '5' END"


@query(f"SELECT bucket, tone, count(*) AS n FROM (SELECT {BUCKET} AS bucket, CASE WHEN x IS NULL THEN 'neutral' WHEN x >= 4 THEN 'good' WHEN x >= 3 THEN 'neutral' ELSE 'bad' END AS tone FROM (SELECT CASE WHEN p_size > 45 THEN NULL ELSE p_size / 9.0 END AS x FROM part)) GROUP BY 1, 2")
def f23_f24_ratings(spark, sf):
    x = F.when(c("p_size") <= 45, c("p_size") / 9.0)
    return Tables(spark, sf).part.groupBy(classify.rating_bucket(x).alias("bucket"), classify.rating_tone(x).alias("tone")).agg(counted())


@query(r"""SELECT page_id, trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1).replace('&lt;', '<').replace('&gt;', '>').replace('&quot;', '"').replace('&#39;', chr(39)).replace('&amp;', '&')) AS title FROM pages""")
def f26_x12_page_title(spark, sf):
    return Tables(spark, sf).pages.select("page_id", pages.page_title(c("html")).alias("title"))


@query(f"""WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS h FROM pages), u AS (SELECT page_id, 'https://h.org' || h AS url FROM l UNION ALL SELECT page_id, url FROM pages WHERE page_id % 3 <> 0)
    SELECT DISTINCT page_id, 'https://h.org' || {PATH} AS link FROM u WHERE starts_with(url, 'https://h.org/') AND NOT regexp_matches({PATH}, '^/(la|the)') UNION SELECT page_id, 'https://h.org/x/' || page_id FROM pages""")
def x12_internal_links(spark, sf):
    """Anchors of the pages, to which some are added: relative, outside, on the page itself and refused ones."""
    more = say('<A class=x href="x/', c("page_id"), '?q=1#f">a</a><a href=#top>t</a><a href="mailto:x@h.org">m</a><a href="//other.org/x">o</a>', "<a href='/the/", c("page_id"), "'>n</a>")
    rows = Tables(spark, sf).pages.select("page_id", F.concat("html", more, F.when(c("page_id") % 3 != 0, say('<a href="', c("url"), '">p</a>')).otherwise("")).alias("html"))
    return pages.internal_links(rows, "html", ["page_id"], "h.org", ("/",), ("/la", "/the"))


@query("SELECT c_custkey, regexp_replace(c_name, '[<>:\"/|?*#]', '', 'g') AS file, 'Reviews of' AS fallback FROM customer")
def f6_f8_names(spark, sf):
    name = text.title_to_name(F.concat(F.lit("Reviews of "), c("c_name"), F.lit(" | more")))
    return Tables(spark, sf).customer.select("c_custkey", F.replace(name, F.lit("#"), F.lit("")).alias("file"), text.sanitize_file_name(F.lit("Reviews of?")).alias("fallback"))


#: Dates as forums write them, and as they don't; {k} is the date itself.
DATES = ("{k}", "  {k} ", "Xyz {k}", "{k} x", "Fri Feb 31, 2012 2:19 pm", "Sat {k}", "", None, "mon apr 9, 2012 12:00 am", "Thu Apr 19 2012 2:19 pm", "Thursday Apr 19, 2012 2:19 pm", "Thu Apr 19, 2012 14:19")
DATED = sql_varied(DATES, "o_orderkey * 7 + o_custkey", "strftime(ts0, '%a %b %-d, %Y %-I:%M ') || lower(strftime(ts0, '%p'))")


@query(f"""WITH o AS (SELECT *, o_orderdate + to_minutes(o_orderkey * 37 % 1440) AS ts0 FROM orders), s AS (SELECT o_orderkey, {DATED} AS said FROM o),
    p AS (SELECT *, CASE WHEN regexp_matches(trim(said), '(?i)^(mon|tue|wed|thu|fri|sat|sun)\\s') THEN try_strptime(regexp_replace(trim(said), '(?i)^(mon|tue|wed|thu|fri|sat|sun)\\s+', ''), '%b %-d, %Y %-I:%M %p') END AS ts1 FROM s)
    SELECT o_orderkey, ts1 AS "at", strftime(ts1, '%Y-%m-%d') AS day, strftime(ts1, '%Y-%m') AS month, regexp_full_match(coalesce(said, ''), '[A-Z][a-z][a-z] [A-Z][a-z][a-z] [0-9][0-9]?, [0-9][0-9][0-9][0-9] [0-9][0-9]?:[0-9][0-9] (am|pm)') AS well_formed FROM p""")
def d1_d2_d3_forum_dates(spark, sf):
    at = c("o_orderdate") + F.make_dt_interval(mins=(c("o_orderkey") * 37 % 1440).cast("int"))
    written = F.concat(F.date_format(at, "EEE MMM d, yyyy h:mm "), F.lower(F.date_format(at, "a")))
    rows = Tables(spark, sf).orders.select("o_orderkey", varied(DATES, c("o_orderkey") * 7 + c("o_custkey"), written).alias("said"))
    read = dates.forum_date(c("said"))
    return rows.select("o_orderkey", read.alias("at"), dates.day(read).alias("day"), dates.month(read).alias("month"), dates.well_formed(c("said")).alias("well_formed"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, NULL::VARCHAR AS name FROM events")
def n1_json_map(spark, sf):
    return Tables(spark, sf).events.select("event_id", F.try_element_at(jsons.json_map(c("props")), F.lit("k")).alias("k"), jsons.profile_field(F.lit("[1]"), "Name").alias("name"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS shown FROM events")
def n3_scalar_text(spark, sf):
    nested_ = F.concat(F.lit('{"displayText": {"value": '), F.get_json_object("props", "$.k"), F.lit("}}"))
    return Tables(spark, sf).events.select("event_id", jsons.scalar_text(nested_).alias("shown"))


@query("""SELECT event_id, '{"e":0,"f":[' || json_extract_string(props, '$.k') || ']}' AS stripped FROM events""")
def n6_strip_nulls(spark, sf):
    doc = F.concat(F.lit('{"a":null,"b":[],"c":{"d":""},"e":0,"f":[{},'), F.get_json_object("props", "$.k"), F.lit("]}"))
    return Tables(spark, sf).events.select("event_id", jsons.strip_nulls(doc).alias("stripped"))


# ---- classifiers ----

EDGE = r"(?:^|[^\p{L}\p{N}_])", r"(?:$|[^\p{L}\p{N}_])"


def sql_words(pattern: str) -> str:
    """A pattern of whole words for an engine whose word edges know ASCII alone."""
    inner = pattern.split(")", 1)[1] if pattern.startswith("(?") else pattern
    return inner.replace("'", "''").removeprefix(r"\b").removesuffix(r"\b").join(EDGE) if inner.startswith(r"\b") else inner


DISMISSIVE_SQL = classify.DISMISSIVE.split(")", 1)[1].replace("'", "''")
EFFORT = rf"""CASE WHEN NOT regexp_matches(raw, '[\p{{L}}\p{{N}}_]') THEN 'one_liner' WHEN words >= 80 OR sentences >= 4 OR length(raw) >= 400 THEN 'high_effort_structured' WHEN words >= 25 OR sentences >= 2 THEN 'medium_effort'
    WHEN words <= 8 AND regexp_matches(lower(raw), '{DISMISSIVE_SQL}') THEN 'low_effort_emotional_DISMISSIVE' WHEN regexp_matches(lower(raw), '{sql_words(classify.ENGAGED)}') THEN 'low_effort_emotional_ENGAGED'
    WHEN words <= 3 THEN 'one_liner' WHEN words <= 8 THEN 'low_effort_emotional_DISMISSIVE' ELSE 'medium_effort' END"""
PHRASES = """(SELECT doc_id, text FROM documents UNION ALL SELECT 1000000000 + o_orderkey, list_extract(['great!!', 'rude staff', 'good', '', '!!!', 'nice food', 'crispy dosa was lovely', 'one two three four five six seven eight nine', 'dosa great but curry bad', 'Craft beer at the bar on Friday', 'never tried the wine; good but service was slow'], (o_orderkey % 11 + 1)::INT) FROM orders)"""
SAID = ("great!!", "rude staff", "good", "", "!!!", "nice food", "crispy dosa was lovely", "one two three four five six seven eight nine", "dosa great but curry bad", "Craft beer at the bar on Friday", "never tried the wine; good but service was slow")


def phrases(t: Tables) -> DataFrame:
    """Every document, and short reviews of all kinds."""
    said = F.get(F.array(*[F.lit(s) for s in SAID]), (c("o_orderkey") % 11).cast("int"))
    return t.documents.select("doc_id", "text").unionByName(t.orders.select((1000000000 + c("o_orderkey")).alias("doc_id"), said.alias("text")))


@query(rf"SELECT doc_id, {EFFORT} AS effort FROM (SELECT doc_id, raw, len([w for w in string_split_regex(raw, '\s+') if w <> '']) AS words, len([s for s in string_split_regex(raw, '[.!?]+') if trim(s, ' ' || chr(10)) <> '']) AS sentences FROM (SELECT doc_id, trim(coalesce(text, ''), ' ' || chr(10)) AS raw FROM {PHRASES}))")
def c1_review_effort(spark, sf):
    return phrases(Tables(spark, sf)).select("doc_id", classify.review_effort(c("text")).alias("effort"))


FIRED = ", ".join(f"CASE WHEN regexp_matches(lower(text), '{sql_words(p)}') THEN '{n}' END" for n, p in sorted(classify.TRIGGERS.items()))


@query(rf"SELECT doc_id, array_to_string([f for f in [{FIRED}] if f IS NOT NULL], ',') AS fired, len(regexp_extract_all(regexp_replace(lower(text), '([^\p{{L}}\p{{N}}_])', '\1\1', 'g'), '{sql_words(classify.DISHES)}')) >= 2 AND regexp_matches(lower(text), '{sql_words(classify.CONTRAST)}') AS contrast FROM {PHRASES}")
def c2_c3_triggers(spark, sf):
    return phrases(Tables(spark, sf)).select("doc_id", F.array_join(classify.triggers(c("text")), ",").alias("fired"), classify.contrasts_dishes(c("text")).alias("contrast"))


#: Addresses of the catalogue and others, whole and broken.
CATALOGUE = (
    "https://h.org/drugs/x-{k}", "https://h.org/drugs/x/y{k}?q=1", "/drugs-all-medicines", "https://h.org/drugs-therapeutic-classes/g{k}", "https://h.org/otc/p{k}?q=1#a", "/otc/a/{k}", "https://h.org/cancer-care/{k}", "https://h.org/", "", "not an address {k}",
    "/generics/a{k}", "/generics", "//h.org/marketer/b{k}", "/labs/t/{k}", "/doctors/d", "/categories/{k}/x", "/drug-store/f{k}", "/Drugs/{k}", "https://h.org", "https://h.org/drugs/", "https://h.org//drugs//x{k}/", " https://h.org/otc/x{k} ",
)
URLED = sql_varied(CATALOGUE, "o_orderkey * 7 + o_custkey", "o_custkey")
PARTS = r"[p for p in string_split(regexp_extract(trim(url), '^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)', 3), '/') if p <> '']"


@query(f"""WITH u AS (SELECT o_orderkey, {URLED} AS url FROM orders), p AS (SELECT o_orderkey, {PATH} AS path, {PARTS} AS parts FROM u)
    SELECT o_orderkey, CASE WHEN len(parts) = 0 THEN 'other' WHEN len(parts) = 2 AND parts[1] = 'drugs' THEN 'drug_page' WHEN len(parts) = 2 AND parts[1] = 'generics' THEN 'generic_page' WHEN len(parts) = 2 AND parts[1] = 'otc' THEN 'otc_page'
        WHEN len(parts) = 2 AND parts[1] = 'drug-store' THEN 'drug_store_page' WHEN starts_with(parts[1], 'drugs-') THEN 'drugs_listing' WHEN parts[1] = 'drugs' THEN 'drugs_other' ELSE replace(parts[1], '-', '_') END AS counted,
    CASE WHEN regexp_matches(path, '^/(otc|drug-store)/') THEN 'product' WHEN starts_with(path, '/generics/') THEN 'generic' WHEN regexp_matches(path, '^(/categories/|/drugs-therapeutic-classes|/drugs-all-medicines$)') THEN 'category'
        WHEN starts_with(path, '/marketer/') THEN 'marketer' WHEN starts_with(path, '/labs/') THEN 'lab' WHEN starts_with(path, '/doctors/') THEN 'doctor' ELSE 'misc' END AS crawled FROM p""")
def c4_c5_catalogue_urls(spark, sf):
    rows = Tables(spark, sf).orders.select("o_orderkey", varied(CATALOGUE, c("o_orderkey") * 7 + c("o_custkey"), c("o_custkey")).alias("url"))
    return rows.select("o_orderkey", classify.catalogue_class(c("url")).alias("counted"), classify.crawl_kind(c("url")).alias("crawled"))


LISTINGS = ("https://h.org/c/x{k}/info", "https://h.org/c/x{k}/delivery/dish-{k}", "https://h.org/c/x{k}/order", "https://h.org/c/x{k}/delivery/1", "https://h.org/C/X{k}/Delivery/Dish/2", "", None, "https://h.org/x/ORDER?p={k}", "https://h.org/x/info?{k}")
LISTED = sql_varied(LISTINGS, "o_custkey * 5 + o_orderkey", "o_custkey")
KIND = "CASE WHEN l LIKE '%/delivery/dish-%' OR l LIKE '%/delivery/dish/%' THEN 'delivery_dish' WHEN l LIKE '%/order' OR l LIKE '%/order?%' THEN 'order' WHEN l LIKE '%/info' OR l LIKE '%/info?%' THEN 'info' WHEN l LIKE '%/delivery/%' THEN 'delivery_other' ELSE 'other' END"


@query(f"""WITH r AS (SELECT *, lower(coalesce({LISTED}, '')) AS l, o_orderstatus <> 'O' AS done, o_custkey % 7 > 1 AS matched, o_orderkey % 5 - 1 AS reviews FROM orders), k AS (SELECT *, {KIND} AS kind FROM r)
    SELECT o_orderkey, kind, CASE WHEN kind = 'delivery_dish' THEN 'bad_url_delivery_dish' WHEN NOT done THEN 'not_processed' WHEN NOT matched THEN 'processed_no_csv_match' WHEN reviews < 0 THEN 'csv_read_error' WHEN reviews = 0 THEN 'no_dining_reviews' ELSE 'has_reviews' END AS status FROM k""")
def c7_coverage_status(spark, sf):
    kind = classify.listing_type(varied(LISTINGS, c("o_custkey") * 5 + c("o_orderkey"), c("o_custkey")))
    rows = Tables(spark, sf).orders.withColumn("kind", kind)
    return rows.select("o_orderkey", "kind", classify.coverage_status(c("kind"), c("o_orderstatus") != "O", c("o_custkey") % 7 > 1, c("o_orderkey") % 5 - 1).alias("status"))


# ---- addresses, cells and pages made of the tables' rows ----


@query("""SELECT o_orderkey, 'https://h.org/x/reviews?page=' || o_orderkey || '&sort=dd&filter=reviews-dd' AS listing, 'https://h.org/x?a=1&b=' || o_orderkey || '&sort=new' AS merged,
    CASE WHEN o_orderkey % 3 = 0 THEN 'https://h.org/resources/s' || o_orderkey END AS article, 'https://h.org/forum/t-t' || o_orderkey || '-20.html' AS topic_page, 'https://h.co/' || o_orderkey AS share,
    'P' || o_orderkey || ', A, C|P' || o_orderkey || ', A|P' || o_orderkey || '|My Place' AS candidates, CASE WHEN o_orderkey % 2 = 0 THEN 'https://h.org/?p=' || o_orderkey END AS next FROM orders""")
def f5_f9_f14_f27_f29_x14_addresses(spark, sf):
    k = c("o_orderkey").cast("string")
    say = lambda *parts: F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])
    article = F.when(c("o_orderkey") % 3 == 0, say("/resources/s", k)).when(c("o_orderkey") % 3 == 1, say("/other/s", k)).otherwise(say("https://x.org/resources/s", k))
    header = F.when(c("o_orderkey") % 2 == 0, say("<https://h.org/?p=", k, '>; rel="next"')).otherwise(F.lit('<https://h.org/>; rel="prev"'))
    return Tables(spark, sf).orders.select(
        "o_orderkey",
        urls.listing_url(F.lit("https://h.org/x"), c("o_orderkey"), "dd", "reviews-dd").alias("listing"),
        urls.merge_query(say("https://h.org/x?b=", k, "&a=1&sort=old#f"), {"sort": "new"}).alias("merged"),
        urls.article_url(article, "h.org").alias("article"),
        urls.topic_page_url(say("https://h.org/forum/t-t", k, ".html"), F.lit(20)).alias("topic_page"),
        urls.share_url(say("see (https://h.co/", k, ")."), r"h\.co").alias("share"),
        F.array_join(urls.candidate_names(say("P", k), F.lit("A"), F.lit("https://h.org/c/my-place/info"), "C"), "|").alias("candidates"),
        urls.next_link(header).alias("next"),
    )


BLOCKS = ('[{"x":1},{"display_text":""},{"displayText":"shown {k}"}]', "[]", "null", '[{"display_text":"first {k}","displayText":"other"},{"display_text":"b"}]', "broken {k}", "", '[{"x":{k}}]', '[{"displayText":null},{"display_text":" <b>{k}</b> "}]')
AUTHORS = ('{"authors":[{"role":"Reviewed By","name":"x"},{"role":" Written By ","name":" N{k} ","qualifications":"MD {k}"}]}', '{"authors":[]}', "[]", '{"authors":[{"role":"Written By"}]}', "{", '{"authors":[{"role":"written by","name":"{k}"}]}', '{"authors":[{"name":"a"},{"role":"Written By","name":"{k}"},{"role":"Written By","name":"second"}]}')
NESTED = ('{"a":["a",{"b":"{k}"}],"c":1}', '["{k}",["x",[null,true,"y\\u00e9"]]]', '"only {k}"', "{k}", "{}", "not {k}", '{"a":"","b":{"c":{"d":"deep {k}"}}}')
STRINGS = ("a|{k}", "{k}|x|yé", "only {k}", "", "", "", "|deep {k}")
SHOWN = "coalesce(list_filter([coalesce(nullif(json_extract_string(b, '$.display_text'), ''), json_extract_string(b, '$.displayText')) for b in from_json(CASE WHEN json_valid(blocks) AND starts_with(blocks, '[') THEN blocks ELSE '[]' END, '[\"JSON\"]')], lambda x: coalesce(x, '') <> '')[1], '')"
WRITER = "list_filter(from_json(CASE WHEN json_valid(authors) AND starts_with(authors, '{{') THEN coalesce(json_extract(authors, '$.authors'), '[]') ELSE '[]' END, '[\"JSON\"]'), lambda x: trim(json_extract_string(x, '$.role')) = 'Written By')[1]".replace("{{", "{")


@query(f"""WITH e AS (SELECT event_id, event_id % 3 AS k, user_id, {sql_varied(BLOCKS, "event_id * 3 + user_id", "event_id")} AS blocks, {sql_varied(AUTHORS, "event_id + user_id", "event_id")} AS authors, {sql_varied(STRINGS, "event_id * 5 + user_id", "user_id")} AS strings FROM events)
    SELECT event_id, CASE WHEN k = 0 THEN '' WHEN k = 1 THEN '{{"u":' || user_id || ',"l":[' || event_id || ']}}' ELSE '{{"u":' || user_id || '}}' END AS cell, {SHOWN} AS shown,
    coalesce(trim(json_extract_string({WRITER}, '$.name')), '') AS author, coalesce(trim(json_extract_string({WRITER}, '$.qualifications')), '') AS qualifications, strings FROM e""")
def n2_n4_n5_n7_cells(spark, sf):
    e = Tables(spark, sf).events
    cell = F.when(c("event_id") % 3 > 0, F.struct(c("user_id").alias("u"), F.when(c("event_id") % 3 == 1, F.array("event_id")).alias("l")))
    writer = jsons.author_with_role(varied(AUTHORS, c("event_id") + c("user_id"), c("event_id")), "Written By")
    return e.select(
        "event_id",
        jsons.json_cell(cell).alias("cell"),
        jsons.first_display_text(varied(BLOCKS, c("event_id") * 3 + c("user_id"), c("event_id"))).alias("shown"),
        writer["name"].alias("author"),
        writer["qualifications"].alias("qualifications"),
        F.array_join(jsons.json_strings(varied(NESTED, c("event_id") * 5 + c("user_id"), c("user_id"))), "|").alias("strings"),
    )


@query("SELECT o_orderkey, coalesce(c_name, 'nobody') AS c_name, coalesce(c_acctbal, 0.0) AS c_acctbal FROM orders LEFT JOIN customer ON o_custkey = c_custkey * 2")
def j8_lookup_with_defaults(spark, sf):
    t = Tables(spark, sf)
    even = t.customer.withColumn("o_custkey", c("c_custkey") * 2)
    return joins.with_defaults(t.orders.select("o_orderkey", "o_custkey"), even, "o_custkey", {"c_name": "nobody", "c_acctbal": 0.0}).drop("o_custkey")


@query("""WITH t AS (SELECT *, conv_id % 5 AS k FROM conversations)
    SELECT conv_id, turn + 10 AS post_id, CASE WHEN k = 1 THEN NULL ELSE 'Re: ' || conv_id END AS title, CASE WHEN k <> 2 THEN role END AS author, CASE WHEN k <> 2 THEN 'https://h.org/forum/member/' || role END AS author_profile_url,
    CASE WHEN k = 3 THEN '' ELSE trim(text, ' ' || chr(10)) END AS body_text, CASE WHEN k <> 4 THEN conv_id::VARCHAR END AS age, CASE WHEN k = 3 THEN 0 WHEN turn % 2 = 0 THEN 2 ELSE 1 END AS attachments, CASE WHEN k <> 2 THEN 'Thu Apr ' || (turn + 1) || ', 2012 2:19 pm' END AS posted_at FROM t""")
def x2_x3_x15_topic_pages(spark, sf):
    """Each turn as a forum's topic page, read back; some lack the heading, the author line, the content or the profile."""
    k, turn = c("conv_id") % 5, c("turn")
    heading = F.when(k == 1, "").otherwise(say('<h3><a href="#x">Re: ', c("conv_id"), "</a></h3>"))
    author = F.when(k == 2, "").otherwise(say('<p class="author">by <a href="./member/', c("role"), '">', c("role"), "</a> on Thu Apr ", turn + 1, ", 2012 2:19 pm</p>"))
    files = F.when(turn % 2 == 0, '<a href="./download/file.php?id=1">f</a><a href="/other">o</a>').otherwise("")
    content = F.when(k == 3, "").otherwise(say('<div class="content">', text.escape_html(c("text")), '<img src="./styles/a.png"><img src="./smilies/s.gif"><img src="./b.png"></div>', files))
    profile = F.when(k == 4, "").otherwise(say('<dl class="postprofile"><dt>x</dt><dd><strong>Age:</strong> <b>', c("conv_id"), "</b></dd><dd>plain</dd></dl>"))
    files_text = F.when((turn % 2 == 0) & (k != 3), F.lit(1)).otherwise(0)  # the link's text stands behind the content
    html = say('<div class="post" id="p', turn + 10, '">', profile, '<div class="postbody">', heading, author, content, "</div></div><div class='notpost'><p>x</p></div>")
    rows = pages.topic_pages(Tables(spark, sf).conversations.select("conv_id", html.alias("html"), files_text.alias("more")), "html", "https://h.org/forum/", ["conv_id"])
    return rows.select("conv_id", "post_id", "title", "author", "author_profile_url", "body_text", F.try_element_at("author_meta", F.lit("Age")).alias("age"), F.size("attachment_urls").alias("attachments"), "posted_at")


@query("""WITH o AS (SELECT *, (o_orderkey + o_custkey) % 6 AS k FROM orders)
    SELECT o_orderkey, o_orderkey AS topic_id, CASE WHEN k = 4 THEN 'a-b-' || o_custkey ELSE 't' END AS slug, 'Order <' || o_orderkey || '>' AS title, CASE WHEN k <> 1 THEN o_custkey END AS replies, CASE WHEN k = 2 THEN o_custkey * 7 END AS views, CASE WHEN k <> 3 THEN o_orderstatus END AS starter_author,
    CASE WHEN k <> 3 THEN 'https://h.org/forum/member/' || o_custkey END AS starter_profile_url, CASE WHEN k <> 3 THEN 'Thu Apr 19, 2012 2:19 pm' END AS start_date, CASE WHEN k <> 2 THEN 'Fri Apr 20, 2012 3:0' || (o_orderkey % 10) || ' am' END AS last_post_date,
    CASE WHEN k <> 2 THEN 'y' || o_custkey END AS last_post_author, o_orderkey % 2 = 0 AS has_attachment FROM o WHERE k <> 5""")
def x1_index_pages(spark, sf):
    """Each order as a row of a forum's index page, read back; some lack their counts, starter or last post, some are no topic."""
    k, key, who = (c("o_orderkey") + c("o_custkey")) % 6, c("o_orderkey"), c("o_custkey")
    address = F.when(k == 5, say("./viewforum.php?f=", key)).when(k == 4, say("/forum/a-b-", who, "-t", key, "-20.html?x=1")).otherwise(say("./t", "-t", key, ".html"))
    starter = F.when(k == 3, "").otherwise(say(' by <a href="/forum/member/', who, '">', c("o_orderstatus"), "</a> on Thu Apr 19, 2012 2:19 pm"))
    counts = F.concat(F.when(k == 1, "").otherwise(say('<dd class="posts">', who, " <dfn>Replies</dfn></dd>")), F.when(k == 2, say('<dd class="views">', who * 7, "</dd>")).otherwise(""))
    last = F.when(k == 2, "").otherwise(say('<dd class="lastpost"><span>Last post by <a href="/forum/member/9">y', who, '</a> on Fri Apr 20, 2012 3:0', key % 10, " am</span></dd>"))
    image = F.when(key % 2 == 0, '<img src="i.gif" alt="Attachment(s)">').otherwise('<img alt="other">')
    html = say('<ul class="topiclist topics"><li class="row"><dl><dt><a class="topictitle" href="', address, '">Order &lt;', key, "&gt;</a>", image, starter, "</dt>", counts, last, '</dl></li><li class="row"><a href="x">no topic</a></li></ul><li class="row"><a class="topictitle" href="./x-t9.html">elsewhere</a></li>')
    rows = pages.index_pages(Tables(spark, sf).orders.select("o_orderkey", html.alias("html")), "html", "https://h.org/forum/", ["o_orderkey"])
    return rows.select("o_orderkey", "topic_id", "slug", "title", "replies", "views", "starter_author", "starter_profile_url", "start_date", "last_post_date", "last_post_author", "has_attachment")


@query("SELECT o_orderkey, 'u' || o_orderkey AS key, o_orderstatus AS author, o_orderpriority AS description, (o_orderkey % 5 + 1)::VARCHAR AS rating FROM orders")
def x4_x5_x6_review_pages(spark, sf):
    """Each order as a review: even ones in JSON-LD, odd ones in a page's state."""
    k, rating = c("o_orderkey").cast("string"), c("o_orderkey") % 5 + 1
    ld = F.to_json(F.struct(F.array(F.struct(F.struct(c("o_orderstatus").alias("name")).alias("author"), F.concat(F.lit("u"), k).alias("url"), c("o_orderpriority").alias("description"), F.struct(rating.alias("ratingValue")).alias("reviewRating"))).alias("review")))
    state = F.to_json(F.struct(F.struct(F.create_map(k, F.struct(c("o_orderstatus").alias("userName"), F.concat(F.lit("u"), k).alias("reviewUrl"), c("o_orderpriority").alias("reviewText"), rating.alias("ratingV2"))).alias("REVIEWS")).alias("entities")))
    html = F.when(c("o_orderkey") % 2 == 0, F.concat(F.lit('<script type="application/ld+json">'), ld, F.lit("</script>"))).otherwise(F.concat(F.lit("<script>window.__PRELOADED_STATE__ = "), state, F.lit(";</script>")))
    return pages.review_pages(Tables(spark, sf).orders.select("o_orderkey", html.alias("html")), "html", ["o_orderkey"]).select("o_orderkey", "key", "author", "description", "rating")


#: The states of two drug pages, one with all fields and one with few, and the cells that come of them; {k} is the part's number.
DRUG_STATES = (
    '{"drugPage":{"drugInfo":{"sku":{"id":{k},"name":" Name {k} ","slug":{"value":"slug-{k}"},"price":{k}.5,"discountedPrice":"9","discountPercent":10,"perUnitPrice":{"displayText":"1 / unit"},"therapeuticClass":{"text":"CLASS"},"prescriptionRequired":true,"inStock":false,"available":1,'
    '"shortComposition":{"displayText":"<b>Comp</b> {k} &amp; mg"},"storageCondition":"Below {k}","missedDose":{"display_text":"Take <i>it</i>"},"marketer":{"name":" M {k} ","address":"A","url":"/marketer/{k}"},"manufacturer":{"name":"F"},"introduction":[{"display_text":"<p>Intro {k}</p>"}],'
    '"howToTake":[{"x":1},{"displayText":"With food"}],"mechanismOfAction":[],"quantities":[{"q":{k}}],"uses":["u{k}"],"benefits":[{"b":1}],"sideEffects":{"s":[]},"warning":[],"expertAdvice":["t"],"drugInteraction":null,"faqs":[{"q":"w"}],"references":["r"],"factBox":{"f":1}},'
    '"authoredBy":{"authors":[{"role":"Written By","name":" W{k} ","qualifications":"MD"},{"role":"Reviewed By","name":"R"}],"lastUpdated":{"date":"2024-01-{k}"}},"substitute":[{"s":{k}}],"relatedDoctor":[],"relatedLabTest":["l"],"breadcrumbs":[1,2],"metaData":{"title":" T {k} ","description":"D"}}}}',
    '{"drugPage":{"drugNotFound":false,"drugInfo":{"sku":{"id":"s{k}","quantities":[],"quantityProduct":{"p":"{k}"},"name":"<b>x</b>"},"skuFactBox":{"g":{k}},"metaData":{"meta_desc":" d "}}}}',
)
DRUG_CELLS = {
    "sku_id": ("{k}", "s{k}"), "name": ("Name {k}", "<b>x</b>"), "slug": ("slug-{k}", ""), "prescription_required": ("True", "False"), "salt_composition": ("Comp  {k} & mg", ""), "storage": ("Below {k}", ""), "marketer_name": ("M {k}", ""), "marketer_address": ("A", ""), "marketer_url": ("/marketer/{k}", ""),
    "manufacturer_name": ("F", ""), "price": ("{k}.5", ""), "discounted_price": ("9", ""), "discount_percent": ("10", ""), "per_unit_price": ("1 / unit", ""), "in_stock": ("False", "False"), "available": ("True", "False"), "therapeutic_class": ("CLASS", ""), "introduction_text": ("Intro {k}", ""),
    "how_to_use_text": ("With food", ""), "how_it_works_text": ("", ""), "missed_dose_text": ("Take  it", ""), "written_by": ("W{k}", ""), "written_by_qualifications": ("MD", ""), "reviewed_by": ("R", ""), "reviewed_by_qualifications": ("", ""), "last_updated": ("2024-01-{k}", ""),
    "pack_info": ('[{"q":{k}}]', '{"p":"{k}"}'), "uses_json": ('["u{k}"]', ""), "benefits_json": ('[{"b":1}]', ""), "side_effects_json": ('{"s":[]}', ""), "safety_advice_json": ("[]", ""), "quick_tips_json": ('["t"]', ""), "fact_box_json": ('{"f":1}', '{"g":{k}}'), "substitutes_json": ('[{"s":{k}}]', ""),
    "drug_interactions_json": ("", ""), "faqs_json": ('[{"q":"w"}]', ""), "references_json": ('["r"]', ""), "related_doctors_json": ("[]", ""), "related_lab_tests_json": ('["l"]', ""), "breadcrumbs_json": ("[1,2]", ""), "meta_title": ("T {k}", ""), "meta_description": ("D", "d"),
}
CELLS_SQL = ", ".join(f"CASE kind WHEN 5 THEN replace('{a}', '{{k}}', k) WHEN 6 THEN replace('{b}', '{{k}}', k) ELSE '' END AS {name}" for name, (a, b) in DRUG_CELLS.items())


@query(f"""WITH p AS (SELECT p_partkey::VARCHAR AS k, (p_partkey + p_size) % 7 AS kind FROM part)
    SELECT 'u' || k AS url, CASE WHEN kind = 4 THEN '0' ELSE '200' END AS fetch_http_status, list_extract(['no_preloaded_state', 'drug_not_found', 'no_drug_info', 'no_sku', 'fetch_error', 'ok', 'ok'], (kind + 1)::INT) AS fetch_status,
    CASE kind WHEN 0 THEN 'PRELOADED_STATE not found or invalid' WHEN 4 THEN 'timeout ' || k ELSE '' END AS fetch_error, {CELLS_SQL} FROM p""")
def x8_c9_drug_pages(spark, sf):
    """Each part as a drug page of some completeness, or as one that was not fetched, read back in all columns."""
    kind = (c("p_partkey") + c("p_size")) % 7
    state = varied((None, '{"drugPage":{"drugNotFound":true}}', '{"drugPage":{"drugInfo":[{k}]}}', '{"drugPage":{"drugInfo":{"x":{k}}}}', None, *DRUG_STATES), kind, c("p_partkey"))
    html = F.when(kind == 0, say("<p>none ", c("p_partkey"))).when(kind == 4, F.lit(None)).when(kind == 6, say("<script>var a=1; window.PRELOADED_STATE = [", F.to_json(F.array(state)).substr(F.lit(2), F.length(F.to_json(F.array(state))) - 2), "];</script>")).otherwise(say("<script>window.PRELOADED_STATE = [", state, "];</script>"))
    rows = Tables(spark, sf).part.select(say("u", c("p_partkey")).alias("url"), html.alias("html"), F.when(kind == 4, 0).otherwise(200).alias("status"), F.when(kind == 4, say("timeout ", c("p_partkey"))).alias("error"))
    return pages.drug_rows(rows, "url", "html", "status", "error")


@query("""WITH e AS (SELECT *, (event_id + user_id) % 6 AS k FROM events)
    SELECT event_id, CASE WHEN k <> 5 THEN 'U' || user_id END AS who, CASE WHEN k <> 1 THEN (user_id % 5 + 1)::VARCHAR || CASE WHEN k = 2 THEN '.5' ELSE '' END END AS rating, CASE k WHEN 0 THEN 'yesterday' WHEN 1 THEN user_id || ' days ago' WHEN 2 THEN 'Apr 19, 2012' WHEN 3 THEN 'one month ago' WHEN 5 THEN 'Today' END AS at,
    CASE WHEN k = 4 THEN '' ELSE event_type || chr(10) || 'more ' || event_id END AS said FROM e""")
def x13_review_cards(spark, sf):
    """Cards of several shapes: without rating, date, text or user, with and without votes."""
    k = (c("event_id") + c("user_id")) % 6
    user = F.when(k == 5, "12 reviews\n").otherwise(say("U", c("user_id"), "\n3 reviews\n"))
    rating = F.when(k == 1, "").otherwise(say(c("user_id") % 5 + 1, F.when(k == 2, ".5").otherwise(""), "\n"))
    at = F.when(k == 0, "yesterday\n").when(k == 1, say(c("user_id"), " days ago\n")).when(k == 2, "Apr 19, 2012\n").when(k == 3, "one month ago\n").when(k == 5, "Today\n").otherwise("")
    said = F.when(k == 4, "").otherwise(say(c("event_type"), "\n  more ", c("event_id"), "\n"))
    card = F.concat(user, F.when(k % 2 == 0, "DINING\n").otherwise("Delivery\n"), rating, at, said, F.when(k < 3, "2 votes\nHelpful").when(k == 3, "1 vote").otherwise(""))
    read = pages.card_fields(card)
    return Tables(spark, sf).events.select("event_id", read["user"].alias("who"), read["rating"].alias("rating"), read["date"].alias("at"), read["text"].alias("said"))


# ---- nested documents ----


def drafts(t: Tables) -> DataFrame:
    """A document for each event, made of its number."""
    kinds = F.array(*[F.lit(x) for x in ("friendly", "warm", "professional", "odd")])
    k = (c("event_id") % 4).cast("int")
    doc = F.to_json(F.struct(F.struct(F.get(kinds, k).alias("staff_friendliness"), F.when(k == 1, "x").alias("made_up")).alias("service"), F.struct(F.when(k == 2, "none").alias("alcohol_identity_signal")).alias("bar"), F.array(F.struct(F.lit("d").alias("name"), F.when(k == 3, "moderate").alias("portion_size"))).alias("dishes")))
    return t.events.select("event_id", doc.alias("document"))


@query("SELECT event_id, list_extract(['warm', 'warm', 'polite', 'odd'], (event_id % 4 + 1)::INT) AS friendliness, CASE WHEN event_id % 4 = 3 THEN 'adequate' END AS portion, event_id % 4 <> 2 AS has_bar FROM events")
def v1_normalise(spark, sf):
    d = drafts(Tables(spark, sf)).withColumn("document", nested.normalise(c("document"), F.array().cast("array<string>")))
    at = lambda p: F.get_json_object("document", p)
    return d.select("event_id", at("$.service.staff_friendliness").alias("friendliness"), at("$.dishes[0].portion").alias("portion"), at("$.bar").isNotNull().alias("has_bar"))


#: A schema as models are declared in, with a reference, a union, a list of objects, enums and required fields.
SCHEMA = {
    "type": "object",
    "required": ["service"],
    "$defs": {"Dish": {"type": "object", "properties": {"name": {"type": "string"}, "portion": {"anyOf": [{"enum": ["small", "adequate"], "type": "string"}, {"type": "null"}]}}, "required": ["name"]}},
    "properties": {
        "schema_version": {"type": "string"},
        "service": {"type": "object", "properties": {"staff_friendliness": {"enum": ["warm", "polite"], "type": "string"}, "rank": {"type": "integer"}}},
        "dishes": {"anyOf": [{"type": "array", "items": {"$ref": "#/$defs/Dish"}}, {"type": "null"}]},
    },
}
RULES = nested.schema_rules(SCHEMA)
CHECKED = (
    '{"service":{"staff_friendliness":"warm","rank":{k}},"dishes":[{"name":"n{k}"}]}', '{"service":{"staff_friendliness":"odd","made_up":1},"schema_version":"3"}', '{"bar":{"x":{k}},"dishes":[{"portion":"huge"},{"name":"b","portion":null,"size":{k}}]}',
    "broken {k}", '{"service":{"rank":"{k}"},"dishes":null}', '{"service":null,"dishes":{"name":{k}}}', "[{k}]",
)
DOCS = sql_varied(CHECKED, "event_id * 3 + user_id", "event_id")
DOC_CTE = f"e AS (SELECT event_id, {DOCS} AS t FROM events), d AS (SELECT event_id, t::JSON AS d FROM e WHERE json_valid(t) AND json_type(CASE WHEN json_valid(t) THEN t ELSE 'null' END) = 'OBJECT')"


def checked(t: Tables) -> DataFrame:
    return t.events.select("event_id", varied(CHECKED, c("event_id") * 3 + c("user_id"), c("event_id")).alias("document"))


def unknown_sql(legal: dict[str, list[str]], mark: str) -> str:
    """Names that are not legal, by unnesting documents: sections, fields of sections, fields of lists' items."""
    within = " ".join(f"WHEN '{s}' THEN [{', '.join(repr(f) for f in [*fields, 'span'])}]" for s, fields in legal.items())
    known = ", ".join(f"'{s}'" for s in legal)
    return f"""WITH {DOC_CTE}, s AS (SELECT event_id, d, unnest(json_keys(d)) AS k FROM d), v AS (SELECT event_id, k, json_extract(d, '$."' || k || '"') AS v FROM s),
    f AS (SELECT k, '' AS m, unnest(json_keys(v)) AS f FROM v WHERE k IN ({known}) AND json_type(v) = 'OBJECT' UNION ALL SELECT k, '{mark}', unnest(json_keys(i)) FROM (SELECT k, unnest(from_json(v, '["JSON"]')) AS i FROM v WHERE k IN ({known}) AND json_type(v) = 'ARRAY') WHERE json_type(i) = 'OBJECT')
    SELECT item, count(*) AS n FROM (SELECT k AS item FROM s WHERE k NOT IN ({known}) UNION ALL SELECT k || m || '.' || f FROM f WHERE NOT list_contains(CASE k {within} ELSE [] END, f)) GROUP BY 1"""


LEGAL = nested.legal_fields(RULES)
LEGAL_B = nested.legal_fields(nested.schema_rules(SCHEMA, legal_scalars=True))


@query(unknown_sql(LEGAL, "[]"))
def v2a_unknown_fields(spark, sf):
    return aggregate.item_histogram(checked(Tables(spark, sf)).select(nested.unknown_fields(c("document"), LEGAL).alias("u")), "u")


@query(unknown_sql(LEGAL_B, ""))
def v2b_unknown_fields(spark, sf):
    return aggregate.item_histogram(checked(Tables(spark, sf)).select(nested.unknown_fields(c("document"), LEGAL_B, "").alias("u")), "u")


SERVICE = "json_extract(d, '$.service')"
DISH = "SELECT event_id, unnest(from_json(CASE WHEN json_type(json_extract(d, '$.dishes')) = 'ARRAY' THEN json_extract(d, '$.dishes') ELSE '[]' END, '[\"JSON\"]')) AS i FROM d"


@query(f"""WITH {DOC_CTE}, i AS ({DISH})
    SELECT event_id, 'service' AS path, 'missing' AS kind, NULL::VARCHAR AS value FROM d WHERE coalesce(json_type({SERVICE}), 'NULL') = 'NULL'
    UNION ALL SELECT event_id, 'dishes[].name', 'missing', NULL FROM i WHERE json_extract(i, '$.name') IS NULL
    UNION ALL SELECT event_id, 'service.staff_friendliness', 'enum', json_extract_string(d, '$.service.staff_friendliness') FROM d WHERE json_extract_string(d, '$.service.staff_friendliness') NOT IN ('warm', 'polite')
    UNION ALL SELECT event_id, 'service.rank', 'type', json_extract_string(d, '$.service.rank') FROM d WHERE json_type(json_extract(d, '$.service.rank')) = 'VARCHAR'
    UNION ALL SELECT event_id, 'dishes', 'type', json_extract(d, '$.dishes')::VARCHAR FROM d WHERE json_type(json_extract(d, '$.dishes')) = 'OBJECT'
    UNION ALL SELECT event_id, 'dishes[].portion', 'enum', json_extract_string(i, '$.portion') FROM i WHERE json_extract_string(i, '$.portion') NOT IN ('small', 'adequate')""")
def v3_validated(spark, sf):
    rules = spark.createDataFrame(RULES, "path string, rule string, value string")
    found = nested.validated(checked(Tables(spark, sf)), "event_id", "document", rules)
    return found.select("event_id", "path", "kind", F.replace("value", F.lit(": "), F.lit(":")).alias("value"))


@query("SELECT event_id, 'service.staff_friendliness' AS path, list_extract(['friendly', 'warm', 'professional', 'odd'], (event_id % 4 + 1)::INT) AS value FROM events WHERE event_id % 4 <> 1")
def v3_enum_violations(spark, sf):
    domain = spark.createDataFrame([("service.staff_friendliness", "warm"), ("service.staff_friendliness", "polite")], "path string, value string")
    return nested.enum_violations(drafts(Tables(spark, sf)), "event_id", "document", domain)


MESSAGES = (
    "service.noise\n  Input should be 'a', 'b' or 'c' [type=enum, input_value='z{k}', input_type=str]\ndishes.{k}.name\n  Field required [type=missing, input_value={}, input_type=dict]",
    "pydantic_validation: 2 errors\nbar\n  Input should be a valid dictionary or instance of Bar [type=model_type, input_value='none{k}', input_type=str]",
    "context.group_size_exact\n  Input should be a valid integer [type=int_parsing, input_value='{k}', input_type=str]",
    "value\n  something else went wrong {k}",
    "",
    "no block at all: {k}",
    "a_b.c[0].d\n  Input should be 'x{k}' [type=enum, input_value=None, input_type=NoneType]\nz\n  bad",
)
DETAIL = r"\[type=([a-z_]+),\s+input_value=(.*?),\s+input_type="


@query(f"""WITH m AS (SELECT event_id, string_split({sql_varied(MESSAGES, "event_id * 3 + user_id", "user_id")}, chr(10)) AS l FROM events), b AS (SELECT event_id, l, unnest(range(1, len(l) + 1)) AS i FROM m),
    d AS (SELECT event_id, l[i] AS path, coalesce(l[i + 1], '') AS detail FROM b WHERE trim(l[i]) <> '' AND NOT starts_with(l[i], 'pydantic_validation') AND (i = 1 OR i < len(l) AND regexp_full_match(l[i], '[a-zA-Z_][a-zA-Z0-9_.]*'))), k AS (SELECT *, coalesce(nullif(regexp_extract(detail, '{DETAIL}', 1), ''), 'unknown') AS kind FROM d)
    SELECT event_id, path, kind, nullif(regexp_extract(detail, '{DETAIL}', 2), '') AS value, array_to_string(regexp_extract_all(regexp_extract(detail, 'Input should be\\s+(.*?)\\s+\\[type=', 1), chr(39) || '([^' || chr(39) || ']+)' || chr(39), 1), ',') AS allowed,
    regexp_extract(path, '^[^.\\[]*') AS section, CASE kind WHEN 'enum' THEN 'enum_violation' WHEN 'model_type' THEN 'shape_error' WHEN 'missing' THEN 'missing_required' ELSE 'other_validation' END AS mode FROM k""")
def v4_c10_warnings(spark, sf):
    e = Tables(spark, sf).events
    rows = e.select("event_id", F.explode(nested.warnings(varied(MESSAGES, c("event_id") * 3 + c("user_id"), c("user_id")))).alias("w"))
    return rows.select("event_id", "w.path", "w.kind", "w.value", F.array_join("w.allowed", ",").alias("allowed"), "w.section", "w.mode")


DOCUMENTS = ('{"_error":"x{k}"}', '{"_parse_error":"y","a":1}', "{}", '{"a":{k}}', "[1]", "null", "not {k}", "", None, '{"a":null,"_error":null}', ' {"b":[]} ', '{"_error":1,"_parse_error":{k}}')


@query(f"""WITH e AS (SELECT event_id, {sql_varied(DOCUMENTS, "event_id * 5 + user_id", "event_id")} AS d FROM events), k AS (SELECT event_id, CASE WHEN json_valid(d) AND json_type(d) = 'OBJECT' THEN json_keys(d) ELSE [] END AS keys FROM e)
    SELECT event_id, CASE WHEN list_contains(keys, '_error') THEN 'api_error' WHEN list_contains(keys, '_parse_error') THEN 'parse_error' WHEN len(keys) = 0 THEN 'empty' ELSE 'extracted' END AS kind FROM k""")
def v6_record_class(spark, sf):
    e = Tables(spark, sf).events
    return e.select("event_id", nested.record_class(varied(DOCUMENTS, c("event_id") * 5 + c("user_id"), c("event_id"))).alias("kind"))


@query("SELECT event_id, '3' AS version, list_extract(['', 'bar_quality_signal'], (event_id % 2 + 1)::INT) AS fired, 'one_liner' AS effort FROM events")
def v5_authority(spark, sf):
    fired = F.when(c("event_id") % 2 == 1, F.array(F.lit("bar_quality_signal"))).otherwise(F.array().cast("array<string>"))
    merged = nested.with_authority(c("document"), "3", fired, F.lit("one_liner"))
    d = drafts(Tables(spark, sf)).select("event_id", merged.alias("m"))
    return d.select("event_id", F.get_json_object("m", "$.schema_version").alias("version"), F.array_join(F.from_json(F.get_json_object("m", "$.t2_triggers_fired"), "array<string>"), ",").alias("fired"), F.get_json_object("m", "$.reviewer_signal.review_effort_signal").alias("effort"))


@query("""SELECT event_id, CASE event_id % 3 WHEN 0 THEN '{"_error":"x"}' ELSE '{"a":' || event_id || '}' END AS extracted FROM events""")
def v7_compact(spark, sf):
    k = c("event_id").cast("string")
    doc = F.when(c("event_id") % 3 == 0, '{"_error":"x","b":1}').otherwise(F.concat(F.lit('{"a":'), k, F.lit(',"b":null,"c":{"d":[]}}')))
    return nested.compact(Tables(spark, sf).events.select("event_id", doc.alias("doc")), "doc", ["event_id"])


@query("""SELECT event_id, 'Rating: ' || CASE WHEN event_id % 5 = 0 THEN 'none' ELSE regexp_replace(printf('%.2f', (user_id % 10) / 4.0), '[.]?0+$', '') END || chr(10) || 'Triggers: ' || CASE event_id % 4 WHEN 1 THEN 'a, b' WHEN 2 THEN event_type ELSE 'none' END || chr(10) || 'Review:' || chr(10) || CASE WHEN user_id % 7 = 0 THEN '' ELSE event_type || chr(10) || event_id END AS prompt FROM events""")
def f31_prompt(spark, sf):
    """Ratings, triggers and texts of all kinds, null ones too."""
    k = c("event_id") % 4
    fired = F.when(k == 1, F.array(F.lit("a"), F.lit("b"))).when(k == 2, F.array("event_type")).when(k == 3, F.array().cast("array<string>"))
    asked = nested.prompt(F.when(c("event_id") % 5 > 0, (c("user_id") % 10) / 4.0), fired, F.when(c("user_id") % 7 > 0, say(c("event_type"), "\n", c("event_id"))))
    return Tables(spark, sf).events.select("event_id", asked.alias("prompt"))


@query("SELECT unnest(['service: object', '  rank: integer', '  staff_friendliness: string (polite | warm)', 'dishes[]: object', '  name: string, required', '  portion: string (adequate | small)']) AS line")
def f32_field_specification(spark, sf):
    rows = spark.createDataFrame([(nested.field_specification(RULES, ("service", "dishes")),)], "spec string")
    return rows.select(F.explode(F.split("spec", "\n")).alias("line"))


@query("SELECT o_orderkey, count(l_orderkey) < o_custkey % 6 AS short FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_custkey")
def q11_declared_shortfall(spark, sf):
    t = Tables(spark, sf)
    found = joins.lookup_count(t.orders.select("o_orderkey", "o_custkey"), t.lineitem, "o_orderkey", "l_orderkey", "found")
    return found.select("o_orderkey", audit.declared_shortfall(c("o_custkey") % 6, c("found")).alias("short"))


@query("SELECT count(*) AS unmatched FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey * 2 FROM part)")
def q12_unmatched(spark, sf):
    joined = j1_many_to_one(spark, sf)
    return spark.createDataFrame([(joins.unmatched(joined),)], "unmatched bigint")


SECTIONS_X7 = ("SECTION_REVIEWS", "SECTION_REVIEWS_DINING", "SECTION_OTHER_REVIEWS", "SECTION_MENU", "section_my_reviews_x")


@query("""SELECT o_orderkey, CASE WHEN k = 3 OR o_custkey % 4 = 3 THEN NULL WHEN o_custkey % 4 = 2 THEN o_orderkey % 9 + 1 ELSE o_orderkey % 9 + 2 END AS n FROM (SELECT *, (o_orderkey + o_custkey) % 5 AS k FROM orders)""")
def x7_number_of_pages(spark, sf):
    """States that declare their pages at a restaurant, at the current page, in sections of several names, or nowhere."""
    section = F.get(F.array(*[F.lit(x) for x in SECTIONS_X7]), ((c("o_orderkey") + c("o_custkey")) % 5).cast("int"))
    of = lambda n: say('{"sections":{"', section, '":{"numberOfPages":', n, '},"SECTION_X":{"numberOfPages":99}}}')
    kind = c("o_custkey") % 4
    k = c("o_orderkey") % 9
    pages_ = F.when(kind == 3, say('{"current":', c("o_orderkey"), "}")).when(kind == 2, say('{"restaurant":[1],"current":', of(k + 1), "}")).otherwise(say('{"restaurant":{"', c("o_orderkey"), '":', of(k + 2), '},"current":', of(k + 1), "}"))
    html = say("<script>window.__PRELOADED_STATE__ = ", F.concat(F.lit('{"pages":'), pages_, F.lit("}")), ";</script>")
    return Tables(spark, sf).orders.select("o_orderkey", pages.pages_declared(html).alias("n"))


# ---- audits ----

TOPICS = "(SELECT o_orderkey AS topic_id, o_orderkey % 7 AS replies, o_orderstatus FROM orders)"


@query(f"SELECT t.topic_id, replies + 1 AS expected, coalesce(found, 0) AS found, coalesce(found, 0) - replies - 1 AS delta FROM {TOPICS} t LEFT JOIN (SELECT l_orderkey, count(*) AS found FROM lineitem GROUP BY 1) ON t.topic_id = l_orderkey WHERE o_orderstatus <> 'P'")
def q1_topic_counts(spark, sf):
    t = Tables(spark, sf)
    topics = t.orders.select(c("o_orderkey").alias("topic_id"), (c("o_orderkey") % 7).alias("replies"), "o_orderstatus")
    return audit.topic_counts(topics, t.lineitem.select(c("l_orderkey").alias("topic_id")), topics.filter("o_orderstatus = 'P'"))


@query("SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def q2_q3_unique_ids(spark, sf):
    return audit.unique_ids(Tables(spark, sf).lineitem, ["l_partkey", "l_suppkey"])


@query("SELECT k, 'unaccounted' AS what FROM (SELECT c_custkey AS k FROM customer EXCEPT (SELECT o_custkey * 2 FROM orders UNION SELECT user_id * 3 FROM events)) UNION ALL SELECT k, 'extra' FROM (SELECT o_custkey * 2 AS k FROM orders EXCEPT SELECT c_custkey FROM customer)")
def q4_coverage(spark, sf):
    t = Tables(spark, sf)
    return audit.coverage(t.customer.select(c("c_custkey").alias("k")), t.orders.select((c("o_custkey") * 2).alias("k")), t.events.select((c("user_id") * 3).alias("k")), "k")


@query("SELECT count(*) AS checked, count(*) FILTER (trim(coalesce(text, '')) = '') AS empty, round(100.0 * count(*) FILTER (trim(coalesce(text, '')) = '') / greatest(count(*), 1), 3) AS empty_percent FROM conversations")
def q6_empty_bodies(spark, sf):
    return audit.empty_bodies(Tables(spark, sf).conversations, "text")


REPORT = """SELECT 'per_topic_counts' AS name, count(*) AS checked, count(*) FILTER (n <> o_orderkey % 7 + 1) AS failed FROM (SELECT o_orderkey, count(l_orderkey) AS n FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'P' GROUP BY 1)
    UNION ALL SELECT 'global_id_uniqueness', count(*), count(*) FILTER (n > 1) FROM (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1)
    UNION ALL SELECT 'per_topic_id_uniqueness', count(*), count(*) FILTER (n > 1) FROM (SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2)
    UNION ALL SELECT 'coverage', count(DISTINCT o_orderkey), count(DISTINCT o_orderkey) FILTER (o_orderstatus = 'O') FROM orders
    UNION ALL SELECT 'position_contiguity', count(*), count(*) FILTER (NOT (lo = 1 AND hi = n AND d = n)) FROM (SELECT min(l_linenumber) AS lo, max(l_linenumber) AS hi, count(*) AS n, count(DISTINCT l_linenumber) AS d FROM lineitem GROUP BY l_orderkey)
    UNION ALL SELECT 'empty_bodies', count(*), count(*) FILTER (l_returnflag = 'A') FROM lineitem
    UNION ALL SELECT 'date_parseability', count(*), count(*) FROM lineitem"""


@query(f"SELECT name, checked, failed, failed = 0 OR name = 'empty_bodies' AS passed FROM ({REPORT})")
def q8_forum_report(spark, sf):
    t = Tables(spark, sf)
    topics = t.orders.select(c("o_orderkey").alias("topic_id"), (c("o_orderkey") % 7).alias("replies"), "o_orderstatus")
    posts = t.lineitem.select(c("l_orderkey").alias("topic_id"), c("l_partkey").alias("post_id"), (c("l_linenumber") - 1).alias("position_in_topic"), F.when(c("l_returnflag") == "A", " ").otherwise("x").alias("body_text"), c("l_shipdate").cast("string").alias("posted_at"))
    return audit.forum_report(topics, posts, topics.filter("o_orderstatus = 'F'"), topics.filter("o_orderstatus = 'P'")).select("name", "checked", "failed", "passed")


@query("SELECT count(*) FILTER (d < 0) AS fewer, count(*) FILTER (d > 0) AS more, count(*) FILTER (d = 0) AS equal FROM (SELECT o_orderkey % 5 - 2 AS d FROM orders)")
def q9_count_deltas(spark, sf):
    return audit.count_deltas(Tables(spark, sf).orders.select((c("o_orderkey") % 5 - 2).alias("count_delta")))


# ---- incremental, and what is only specified ----


@query("SELECT c_custkey AS k FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE event_type <> 'click')")
def i1_i3_pending(spark, sf):
    t = Tables(spark, sf)
    log = t.events.select(c("user_id").alias("k"), F.when(c("event_type") == "click", "fetch_error").otherwise("ok").alias("status"))
    return ingest.pending(t.customer.select(c("c_custkey").alias("k")), log, "k")


@query("SELECT user_id AS k FROM events GROUP BY 1 HAVING arg_max(event_type, event_id) = 'click'")
def i4_retryable(spark, sf):
    log = Tables(spark, sf).events.select(c("user_id").alias("k"), F.when(c("event_type") == "click", "fetch_error").otherwise("ok").alias("status"), "event_id")
    return ingest.retryable(log, "k", "event_id")


@query("WITH RECURSIVE e AS (SELECT DISTINCT l_orderkey AS s, l_partkey * 3 + 1 AS d FROM lineitem), f AS (SELECT unnest([1, 2, 3, 5]) AS u UNION SELECT d FROM f JOIN e ON s = u) SELECT u::VARCHAR AS url FROM f")
def i6_crawl(spark, sf):
    links = Tables(spark, sf).lineitem.select(c("l_orderkey").cast("string").alias("src"), (c("l_partkey") * 3 + 1).cast("string").alias("dst"))
    return ingest.crawl(links, ["1", "2", "3", "5"]).select("url")


@query("SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def i_windowed_counts(spark, sf):
    return ingest.windowed_counts(Tables(spark, sf).events, "ts", "event_type").withColumn("total", F.round("total", 4))


@query("WITH p AS (SELECT user_id AS g, 'type' AS field, event_type AS v, count(*) AS n FROM events GROUP BY ALL) SELECT g, field, array_to_string(list(v || '=' || n ORDER BY v), ',') AS distribution, arg_max(v, (n, v)) AS mode, sum(n)::BIGINT AS evidence_n, round(1 - exp(-sum(n) / 10.0), 9) AS confidence FROM p GROUP BY 1, 2")
def z1_z3_z4_evidence(spark, sf):
    e = Tables(spark, sf).events.select(c("user_id").alias("g"), F.lit("type").alias("field"), c("event_type").alias("v"))
    found = aggregate.evidence(e, ["g"], "field", "v")
    listed = F.array_join(F.transform(F.array_sort(F.map_entries("distribution")), lambda x: F.concat(x.key, F.lit("="), x.value.cast("string"))), ",")
    return found.select("g", "field", listed.alias("distribution"), "mode", "evidence_n", F.round("confidence", 9).alias("confidence"))


@query("SELECT user_id, 'v' AS field, round(avg(value), 6) AS mean, round(var_pop(value), 6) AS variance, count(value) AS evidence_n FROM events GROUP BY 1")
def z2_ordinal_stats(spark, sf):
    e = Tables(spark, sf).events.withColumn("field", F.lit("v"))
    return aggregate.ordinal_stats(e, ["user_id"], "field", c("value")).withColumns({k: F.round(k, 6) for k in ("mean", "variance")})


@query("SELECT o_orderpriority, strftime(o_orderdate, '%Y-%m') AS bucket, count(*) AS n, round(avg(o_totalprice), 4) AS mean FROM orders GROUP BY 1, 2")
def z5_z6_split_by(spark, sf):
    return aggregate.split_by(Tables(spark, sf).orders, ["o_orderpriority"], dates.month(c("o_orderdate")), c("o_totalprice")).withColumn("mean", F.round("mean", 4))


@query("SELECT o_orderpriority, sum(CASE WHEN o_orderstatus = 'F' THEN 1 END)::BIGINT AS \"F\", sum(CASE WHEN o_orderstatus = 'O' THEN 1 END)::BIGINT AS \"O\", sum(CASE WHEN o_orderstatus = 'P' THEN 1 END)::BIGINT AS \"P\" FROM orders GROUP BY 1")
def z7_wide(spark, sf):
    per = aggregate.counts(Tables(spark, sf).orders, ["o_orderpriority", "o_orderstatus"])
    return aggregate.wide(per, ["o_orderpriority"], "o_orderstatus", "n", ["F", "O", "P"])


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders) WHERE n <= 3")
def z8_capped(spark, sf):
    return aggregate.capped(Tables(spark, sf).orders.select("o_custkey", "o_orderkey"), ["o_custkey"], ["o_orderkey"], 3)


# ---- sources and sinks: tables are written to the shared folder and read back ----

NA_SQL = ", ".join("'" + t + "'" for t in readers.NA)


@query(f"SELECT doc_id, md5(CASE WHEN text NOT IN ({NA_SQL}) THEN text END) AS body, lang, n_chars FROM documents")
def s1_k3_csv(spark, sf):
    folder = shared_folder(spark, "csv")
    sinks.csv(Tables(spark, sf).documents.select("doc_id", "text", "lang", "n_chars"), folder)
    return readers.csv(spark, folder, "doc_id bigint, text string, lang string, n_chars bigint").select("doc_id", F.md5("text").alias("body"), "lang", "n_chars")


@query(f"""SELECT 'Place ' || (p_partkey % 9) AS restaurant, 'a' || p_partkey AS author, p_name || chr(10) || '"' || p_type || '"' AS description, CASE WHEN p_partkey % 5 > 0 THEN p_size / 10.0 END AS rating, 'reviews' AS source FROM part""")
def s2_s3_s4_k5_k11_review_files(spark, sf):
    """Parts as reviews in one file a restaurant, beside a report that is none; ratings of some can't be read."""
    rating = F.when(c("p_partkey") % 5 > 0, (c("p_size") / 10.0).cast("string")).otherwise("n. a.")
    rows = Tables(spark, sf).part.select(say("Place ", c("p_partkey") % 9).alias("file"), say("a", c("p_partkey")).alias("Author"), F.lit("u").alias("Review URL"), say(c("p_name"), '\n"', c("p_type"), '"').alias("Description"), rating.alias("Rating"))
    folder = shared_folder(spark, "reviews")
    sinks.csv_files(rows.unionByName(rows.withColumn("file", F.lit("rescrape_summary"))), folder, "file")
    return readers.review_folder(spark, folder, "reviews").select("restaurant", c("Author").alias("author"), c("Description").alias("description"), c("Rating").alias("rating"), "source")


@query("SELECT CASE WHEN p_brand NOT LIKE '%1%' THEN p_name END AS p_name, NULL::VARCHAR AS made_up, p_partkey::VARCHAR AS p_partkey FROM part")
def s5_fill_and_project(spark, sf):
    """Columns in a declared order and type, missing ones null."""
    df = Tables(spark, sf).part.select("p_partkey", F.when(~c("p_brand").contains("1"), c("p_name")).alias("p_name"), "p_size")
    return project.coerced(df, {"p_name": "string", "made_up": "string", "p_partkey": "string"})


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal, 2 AS copies FROM supplier")
def k1_k2_parquet(spark, sf):
    one, two = shared_folder(spark, "parquet"), shared_folder(spark, "parquet")
    rows = Tables(spark, sf).supplier.select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    sinks.parquet(rows, one)
    sinks.parquet(rows, two, "snappy", by=["s_nationkey"])
    both = spark.read.parquet(one).unionByName(spark.read.schema(rows.schema).parquet(two).select(rows.columns))
    return both.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))


@query("SELECT DISTINCT trim(url) AS line FROM pages WHERE trim(url) <> ''")
def s8_k6_lines(spark, sf):
    folder = shared_folder(spark, "lines")
    sinks.sorted_lines(Tables(spark, sf).pages, "url", folder)
    return readers.line_set(spark, folder)


@query("SELECT o_custkey AS topic_id, 'error ' || max(o_orderkey) AS error, CASE WHEN max(o_orderkey) % 3 > 0 THEN 'https://h.org/t' || max(o_orderkey) END AS url FROM orders GROUP BY 1")
def s9_failure_log(spark, sf):
    """A line an order, in order, beside lines that are none; some lack their address."""
    folder = shared_folder(spark, "failures")
    line = F.when(c("o_orderkey") % 3 > 0, say(c("o_custkey"), "\terror ", c("o_orderkey"), "\thttps://h.org/t", c("o_orderkey"))).otherwise(say(c("o_custkey"), "\terror ", c("o_orderkey")))
    lines = F.array(line, F.when(c("o_orderkey") % 11 == 0, F.lit("x\tno id")), F.when(c("o_orderkey") % 13 == 0, F.lit("")))
    Tables(spark, sf).orders.orderBy("o_orderkey").select(F.explode(F.array_compact(lines)).alias("value")).write.text(folder)
    return readers.failure_log(spark, folder)


@query("SELECT trim(url) AS url FROM pages WHERE trim(url) LIKE 'https://%'")
def s10_url_list(spark, sf):
    folder = shared_folder(spark, "urls")
    Tables(spark, sf).pages.select(say("  ", c("url")).alias("value")).write.text(folder)
    return readers.url_list(spark, folder, "https://")


@query("SELECT s_suppkey, s_name, s_acctbal, '{\"a\":' || s_nationkey || '}' AS document, 2 AS copies FROM supplier")
def s11_k7_k8_json(spark, sf):
    lines, report = shared_folder(spark, "ndjson"), shared_folder(spark, "json")
    rows = Tables(spark, sf).supplier.select("s_suppkey", "s_name", "s_acctbal", F.struct(c("s_nationkey").alias("a")).alias("document"))
    sinks.ndjson(rows, lines)
    sinks.json_report(rows, report)
    schema = "s_suppkey bigint, s_name string, s_acctbal double, document string"
    both = spark.read.schema(schema).json(lines).unionByName(readers.json_documents(spark, report, schema))
    return both.groupBy(*both.columns).agg(F.count(F.lit(1)).alias("copies"))


@query("SELECT DISTINCT trim(url) AS loc FROM pages WHERE page_id % 8 < 7 UNION SELECT trim(url) FROM pages WHERE page_id % 8 = 7 AND trim(url) LIKE 'http%'")
def s12_sitemaps(spark, sf):
    """Seven sitemaps of addresses and one plain list, below an index."""
    folder = shared_folder(spark, "sitemaps")
    plain = c("page_id") % 8 == 7
    entry = F.when(plain, c("url")).otherwise(F.concat(F.lit("<url>\n<loc> "), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit(" </loc></url>")))
    Tables(spark, sf).pages.select((c("page_id") % 8).alias("map"), entry.alias("value")).repartition("map").write.partitionBy("map").text(folder)
    index = spark.range(8).select(F.lit("index").alias("map"), say("<sitemapindex><sitemap><loc>", c("id"), "</loc></sitemap></sitemapindex>").alias("value"))
    index.coalesce(1).write.mode("append").partitionBy("map").text(folder)
    return readers.sitemap_urls(spark, "index", lambda loc: f"{folder}/map={loc}")


@query("SELECT page_id AS topic_id, page_id % 4 * 10 AS post_offset, md5(html || chr(10)) AS html FROM pages")
def s13_k11_page_cache(spark, sf):
    """Every page in a file of its own, named by topic and offset."""
    folder = shared_folder(spark, "cache")
    sinks.text_files(Tables(spark, sf).pages.select(say(c("page_id"), "/", c("page_id") % 4 * 10, ".html").alias("name"), "html"), folder, "name", "html")
    return readers.page_cache(spark, folder).select("topic_id", "post_offset", F.md5("html").alias("html"))


ANSWERS = (' {"x": {k}} ', "sorry {k}", None, "[{k}]", "", '{"y": "{k}"')


@query(f"""WITH e AS (SELECT event_id, {sql_varied(ANSWERS, "event_id + user_id", "event_id")} AS a FROM events)
    SELECT event_id, CASE WHEN a IS NULL THEN '{{"_error":"no answer"}}' WHEN json_valid(trim(a)) AND json_type(trim(a)) = 'OBJECT' THEN trim(a) ELSE '{{"_parse_error":' || to_json(a) || '}}' END AS extracted FROM e""")
def s18_recorded_answers(spark, sf):
    e = Tables(spark, sf).events
    recorded = e.select("event_id", varied(ANSWERS, c("event_id") + c("user_id"), c("event_id")).alias("answer")).filter("answer is not null")
    return readers.extracted(e.select("event_id", "event_type"), c("event_type"), recorded, "event_id").select("event_id", "extracted")


@query("SELECT c_custkey, c_name, 'report' AS of FROM customer UNION ALL SELECT c_custkey, c_name, 'canvas' FROM customer")
def k9_k10_reports(spark, sf):
    """Every customer in a page and in a script, read back from their text."""
    rows = Tables(spark, sf).customer.select("c_custkey", say("<", c("c_name"), "> & `${x}`").alias("c_name")).orderBy("c_custkey")
    page = spark.createDataFrame([(sinks.html_report("Customers", rows.agg(F.count(F.lit(1)).alias("n")), rows),)], "page string")
    cells = page.select(F.explode(F.regexp_extract_all("page", F.lit(r"<tr><td>(\d+</td><td>[^/]*?)</td></tr>"), F.lit(1))).alias("r"))
    report = cells.select(F.substring_index("r", "<", 1).cast("bigint").alias("c_custkey"), text.unescape_html(F.substring_index("r", ">", -1)).alias("c_name"), F.lit("report").alias("of"))
    script = spark.createDataFrame([(sinks.canvas(rows),)], "script string")
    literal = F.regexp_extract("script", r"(?s)JSON\.parse\(`(.*)`\);", 1)
    plain = F.regexp_replace(literal, r"\\([`$\\])", "$1")
    canvas = script.select(F.explode(F.from_json(plain, "array<struct<c_custkey: bigint, c_name: string>>")).alias("r")).select("r.c_custkey", "r.c_name", F.lit("canvas").alias("of"))
    shown = F.regexp_extract("c_name", r"^<(.*)> & `\$\{x\}`$", 1)
    return report.unionByName(canvas).select("c_custkey", shown.alias("c_name"), "of")


@query("SELECT event_id, event_type || '!' AS said, event_id % 2 AS run FROM events")
def i2_i9_k4_appended_runs(spark, sf):
    """Events come in two steps to a stream that goes on where it stood; each run is kept under its label."""
    folder = shared_folder(spark, "appended")
    events = Tables(spark, sf).events.select("event_id", "event_type")
    for run in (0, 1):
        events.filter(c("event_id") % 2 == run).write.mode("append").parquet(f"{folder}/in")
        stream = ingest.file_stream(spark, f"{folder}/in", events.schema)
        work = lambda batch: batch.select("event_id", F.concat("event_type", F.lit("!")).alias("said"))
        ingest.append_batches(stream, work, f"{folder}/out", f"{folder}/state").awaitTermination()
        ingest.labelled(spark.read.parquet(f"{folder}/out").filter(c("event_id") % 2 == run).select("event_id", "said"), str(run), f"{folder}/runs")
    return spark.read.parquet(f"{folder}/runs").select("event_id", "said", c("run_label").cast("bigint").alias("run"))


@query("SELECT o_custkey AS normalized_url, arg_min(o_orderkey, o_orderkey) AS link FROM orders WHERE o_orderstatus IN ('F', 'P') GROUP BY 1")
def i5_by_report(spark, sf):
    report = Tables(spark, sf).orders.select(c("o_custkey").alias("normalized_url"), c("o_orderkey").alias("link"), c("o_orderkey").alias("ord"), c("o_orderstatus").alias("coverage_status"))
    return ingest.by_report(report, ["F", "P"]).select("normalized_url", "link")


@query("""WITH r AS (SELECT user_id, event_id, event_id // 40 AS known, event_type = 'purchase' AS clicked FROM events), i AS (SELECT *, CASE WHEN known = lag(known, 1, 0) OVER (PARTITION BY user_id ORDER BY event_id) AND NOT clicked THEN 1 ELSE 0 END AS idle FROM r),
    s AS (SELECT *, (sum(idle) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) = 2)::INT AS stuck FROM i), o AS (SELECT *, coalesce(max(stuck) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ended FROM s)
    SELECT user_id, event_id FROM o WHERE ended = 0""")
def i7_until_stagnant(spark, sf):
    """Events as rounds of their users: a run ends after two rounds that knew no more and clicked on nothing."""
    rounds = Tables(spark, sf).events.select("user_id", "event_id", F.floor(c("event_id") / 40).alias("known"), (c("event_type") == "purchase").alias("clicked"))
    return ingest.until_stagnant(rounds, "user_id", "event_id", "known", "clicked", 2).select("user_id", "event_id")


@query("WITH a AS (SELECT p_partkey, 'large' AS label FROM part WHERE p_size > 40 ORDER BY p_name, p_partkey LIMIT 1), b AS (SELECT p_partkey, 'cheap' AS label FROM part WHERE p_retailprice < 2000 AND p_partkey NOT IN (SELECT p_partkey FROM a) ORDER BY p_name, p_partkey LIMIT 1), d AS (SELECT p_partkey, 'any' AS label FROM part WHERE p_partkey NOT IN (SELECT p_partkey FROM a UNION SELECT p_partkey FROM b) ORDER BY p_name, p_partkey LIMIT 1) SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM d")
def t7_showcase(spark, sf):
    part = Tables(spark, sf).part.select("p_partkey", "p_name", "p_size", "p_retailprice")
    shown = sample.showcase(part, "p_partkey", ["p_name", "p_partkey"], {"large": c("p_size") > 40, "cheap": c("p_retailprice") < 2000, "none": F.lit(None).cast("boolean"), "any": F.lit(True)})
    return spark.createDataFrame([(r["p_partkey"], r["showcase_label"]) for r in shown], "p_partkey bigint, label string")


# ---- pages and whole plans: no SQL says them, tests do ----


#: SQL for the text of a piece of a page: its tags cut it, references are decoded, pieces are trimmed.
PIECES = "[trim(p, ' ' || chr(10)) for p in string_split_regex({0}, '<[^>]*>') if trim(p, ' ' || chr(10)) <> '']"
DECODED = "replace(replace(replace(replace(replace(replace(replace({0}, '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&#x27;', chr(39)), '&amp;', '&')"


@query(f"""WITH p AS (SELECT page_id, html, regexp_extract(html, '(?s)<article>(.*?)(</article>|</body>|$)', 1) AS a, regexp_extract(html, '(?s)<div class="ad">(.*?)</div>', 1) AS d FROM pages),
    t AS (SELECT page_id, {DECODED.format("array_to_string(" + PIECES.format("a") + ", chr(10))")} AS a, {DECODED.format("array_to_string(" + PIECES.format("d") + ", chr(10))")} AS d, {DECODED.format("trim(regexp_extract(html, '(?s)<title>(.*?)</title>', 1))")} AS title, {DECODED.format("array_to_string(" + PIECES.format("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)") + ", '')")} AS h1 FROM p)
    SELECT page_id, title, '' AS meta_description, h1, CASE WHEN length(a) > 200 OR length(a) > length(d) THEN a ELSE d END AS article_text, '' AS json_ld, NULL::VARCHAR AS error FROM t""")
def x9_articles(spark, sf):
    return pages.article_pages(Tables(spark, sf).pages, "html", ["page_id"])



@query("""SELECT DISTINCT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS link FROM pages""")
def x11_links(spark, sf):
    return pages.links(Tables(spark, sf).pages, "html", ["page_id"])


@query(f"""WITH p AS (SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS r FROM conversations), t AS (SELECT conv_id, count(*) AS n, max(turn) AS replies FROM p GROUP BY 1)
    SELECT p.conv_id AS topic_id, turn AS post_id, turn = 0 AS is_first_post, length(text) AS chars, {WORDS} AS words, n AS topic_actual_post_count, n - replies - 1 AS topic_count_delta FROM p JOIN t ON p.conv_id = t.conv_id""")
def plan_posts_with_topics(spark, sf):
    """Conversations as a forum: cleaned posts with their cleaned topic."""
    rows = Tables(spark, sf).conversations
    nothing = F.lit(None).cast("string")
    posts = rows.select(c("conv_id").alias("topic_id"), c("turn").alias("post_id"), F.lit(0).alias("post_offset"), c("turn").alias("position_in_topic"), nothing.alias("title"), F.lit("").alias("author_meta_json"), nothing.alias("posted_at"), c("text").alias("body_text"))
    topics = rows.groupBy(c("conv_id").alias("topic_id")).agg(F.max("turn").alias("replies")).withColumns({"title": nothing, "start_date": nothing, "last_post_date": nothing})
    clean = pipelines.clean_posts(posts).withColumn("forum_slug", F.lit("a"))
    joined = pipelines.posts_with_topics(clean, pipelines.clean_topics(topics, clean).withColumn("forum_slug", F.lit("a")))
    return joined.select("topic_id", "post_id", "is_first_post", c("body_char_count").cast("long").alias("chars"), c("body_word_count").cast("long").alias("words"), "topic_actual_post_count", "topic_count_delta")



COVERAGE = f"""WITH m AS (SELECT s_suppkey AS id, 'Place ' || (s_suppkey % 60) || ' house' AS restaurant_name, 'https://h.org/c/place-' || (s_suppkey % 60) || '-house' || CASE s_suppkey % 4 WHEN 0 THEN '/order' WHEN 1 THEN '/info' WHEN 2 THEN '/delivery/dish-1' ELSE '' END AS link FROM supplier),
    f AS (SELECT DISTINCT 'Place ' || (c_custkey % 40) || ' house, Area' AS file FROM customer), s AS (SELECT file, {SLUG.format("file")} AS name FROM f), c AS (SELECT file, length(file) % 3 AS reviews FROM f),
    b AS (SELECT *, regexp_replace(regexp_replace(link, '/info$', ''), '/order$', '') AS normalized_url, CASE WHEN link LIKE '%/delivery/dish-%' THEN 'delivery_dish' WHEN link LIKE '%/order' THEN 'order' WHEN link LIKE '%/info' THEN 'info' ELSE 'other' END AS url_type FROM m),
    u AS (SELECT *, regexp_extract(normalized_url, '([^/]*)$', 1) AS url_slug, CASE WHEN normalized_url NOT LIKE '%7-house' THEN 'yes' ELSE 'no' END AS in_completed_log, {SLUG.format("restaurant_name")} AS n FROM b),
    e AS (SELECT u.*, coalesce(x1.file, x2.file, x3.file, x4.file) AS exact FROM u LEFT JOIN s x1 ON x1.name = n || '-area-city' LEFT JOIN s x2 ON x2.name = n || '-area' LEFT JOIN s x3 ON x3.name = n LEFT JOIN s x4 ON x4.name = url_slug),
    t AS (SELECT id, url_slug AS a, name AS b, file, [x for x in list_distinct(string_split(url_slug, '-')) if length(x) > 2] AS x, [y for y in list_distinct(string_split(name, '-')) if length(y) > 2] AS y FROM e, s WHERE exact IS NULL),
    p AS (SELECT id, file, CASE WHEN a = b THEN 1.0 WHEN contains(a, b) OR contains(b, a) THEN 0.92 WHEN len(x) = 0 OR len(y) = 0 THEN 0.0 ELSE len(list_intersect(x, y))::DOUBLE / len(list_distinct(x || y)) END AS score FROM t),
    g AS (SELECT id, file, score, row_number() OVER (PARTITION BY id ORDER BY score DESC, file) AS r FROM p WHERE score >= 0.55),
    w AS (SELECT e.*, coalesce(exact, g.file) AS file, CASE WHEN exact IS NOT NULL THEN 1.0 ELSE g.score END AS score FROM e LEFT JOIN g ON e.id = g.id AND r = 1)
    SELECT id, 'Area' AS area_found, restaurant_name, '4.0' AS master_rating, 'x' AS cuisine, '1' AS price, link, normalized_url, url_slug, url_type, in_completed_log, coalesce(w.file, '') AS review_csv_file, coalesce(printf('%.2f', score), '') AS match_score, coalesce(reviews, 0) AS review_count,
    CASE WHEN url_type = 'delivery_dish' THEN 'bad_url_delivery_dish' WHEN in_completed_log = 'no' THEN 'not_processed' WHEN w.file IS NULL THEN 'processed_no_csv_match' WHEN reviews = 0 THEN 'no_dining_reviews' ELSE 'has_reviews' END AS coverage_status FROM w LEFT JOIN c ON w.file = c.file"""


@query(COVERAGE)
def plan_coverage_report(spark, sf):
    """Suppliers as restaurants, customers' names as review files: found by name, by the best slug, or not at all."""
    t = Tables(spark, sf)
    n = c("s_suppkey") % 60
    end = F.get(F.array(*[F.lit(e) for e in ("/order", "/info", "/delivery/dish-1", "")]), (c("s_suppkey") % 4).cast("int"))
    master = t.supplier.select(c("s_suppkey").alias("id"), F.lit("Area").alias("area_found"), say("Place ", n, " house").alias("restaurant_name"), F.lit("4.0").alias("master_rating"), F.lit("x").alias("cuisine"), F.lit("1").alias("price"), say("https://h.org/c/place-", n, "-house", end).alias("link"))
    files = t.customer.select(say("Place ", c("c_custkey") % 40, " house, Area").alias("review_csv_file")).distinct().withColumn("review_count", (F.length("review_csv_file") % 3).cast("long"))
    completed = master.select(urls.base_url(c("link")).alias("normalized_url")).filter(~c("normalized_url").endswith("7-house"))
    return pipelines.coverage_report(master, files, completed, "City")


SIGNALS = f"""SELECT doc_id, {EFFORT} AS review_effort_signal, array_to_string(list_sort([f for f in [{FIRED}, CASE WHEN len(regexp_extract_all(regexp_replace(lower(text), '([^\\p{{L}}\\p{{N}}_])', '\\1\\1', 'g'), '{sql_words(classify.DISHES)}')) >= 2 AND regexp_matches(lower(text), '{sql_words(classify.CONTRAST)}') THEN 'cross_dish_consistency_signal' END] if f IS NOT NULL]), ',') AS fired, length(text) AS description_len
    FROM (SELECT doc_id, text, raw, len([w for w in string_split_regex(raw, '\\s+') if w <> '']) AS words, len([s for s in string_split_regex(raw, '[.!?]+') if trim(s, ' ' || chr(10)) <> '']) AS sentences FROM (SELECT doc_id, coalesce(text, '') AS text, trim(coalesce(text, ''), ' ' || chr(10)) AS raw FROM {PHRASES}))"""


@query(SIGNALS)
def plan_review_signals(spark, sf):
    return pipelines.review_signals(phrases(Tables(spark, sf)), c("text")).select("doc_id", "review_effort_signal", F.array_join("t2_triggers_fired", ",").alias("fired"), "description_len")


SECTIONS = {"/en/": "/drugs/", "/fr/": "/otc/", "/de/": "/search/"}
SECTIONED = "replace(replace(replace(url, '/en/', '/drugs/'), '/fr/', '/otc/'), '/de/', '/search/')"


@query(f"SELECT DISTINCT 'https://ththan.example.com' || {PATH} AS url FROM (SELECT replace({SECTIONED}, 'blog.', '') AS url FROM pages WHERE page_id % 3 = 0) WHERE {HOST} = 'ththan.example.com' AND regexp_matches({PATH}, '^/(drugs|otc)/') UNION SELECT DISTINCT 'https://ththan.example.com' || {PATH} FROM (SELECT regexp_replace({SECTIONED}, '//[^/]*', '//THTHAN.example.com') AS url FROM pages WHERE page_id % 3 <> 0) WHERE regexp_matches({PATH}, '^/(drugs|otc)/')")
def plan_catalogue_urls(spark, sf):
    """Pages' addresses with languages as sections; two of three are moved to the site, the others keep their host."""
    url = c("url")
    for lang, section in SECTIONS.items():
        url = F.replace(url, F.lit(lang), F.lit(section))
    moved = F.when(c("page_id") % 3 != 0, F.regexp_replace(url, "//[^/]*", "//THTHAN.example.com")).otherwise(F.replace(url, F.lit("blog."), F.lit("")))
    return pipelines.catalogue_urls(Tables(spark, sf).pages.select(moved.alias("loc")), "ththan.example.com")


