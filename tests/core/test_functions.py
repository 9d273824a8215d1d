"""Expressions, parsers and normalisers on hand-written cases."""

import json
import random

import pytest
from pyspark.sql import functions as F

from siltstone.functions import classify, dates, jsons, text, urls
from siltstone.functions.dom import parse
from siltstone.operators import nested, pages


def values(spark, column, inputs):
    """The column's value for each input text, which stands in column x."""
    df = spark.createDataFrame([(k, x) for k, x in enumerate(inputs)], "k int, x string")
    return [r[0] for r in df.orderBy("k").select(column).collect()]


X = lambda: F.col("x")


@pytest.mark.parametrize(
    "make, cases",
    [
        (lambda: dates.forum_date(X()).cast("string"), {"Thu Apr 19, 2012 2:19 pm": "2012-04-19 14:19:00", "Mon Apr 9, 2012 12:05 am": "2012-04-09 00:05:00", "yesterday": None, "": None, None: None, "Fri Feb 31, 2012 2:19 pm": None, "Apr 19, 2012 2:19 pm": None, " Thu Apr 19, 2012 2:19 PM ": "2012-04-19 14:19:00"}),
        (lambda: dates.well_formed(X()), {"Thu Apr 19, 2012 2:19 pm": True, "Thu Apr 19, 2012 2:19 PM": False, None: False}),
        (lambda: text.extract_year(X()), {"Feb 2009": 2009, "2009a": None, "1930 then 2009": None, None: None}),
        (lambda: text.extract_age(X()), {"56": 56, "about 120": None, "0": None, "1234": None, "aged 7": 7}),
        (lambda: text.word_count(X()), {"": 0, None: 0, " a  b\nc d ": 4}),
        (lambda: text.char_count(X()), {"a\U0001f600": 2, None: 0}),
        (lambda: text.slugify(X()), {"A  Café & Co.": "a-caf-co", "--": "", None: ""}),
        (lambda: text.first_int(X()), {"80,784": 80, "none": None}),
        (lambda: text.declared_total(X(), "topics"), {"<b>2,776 Topics": 2776, "posts": None}),
        (lambda: text.declared_pages(X()), {"Page <strong>1</strong> of <strong>112</strong>": 112, "page 1 of 9": 9, "": None}),
        (lambda: text.declared_in_brackets(X(), "Types"), {"Types (1,144)": 1144}),
        (lambda: text.to_number(X()), {" 4.5": 4.5, "x": None, None: None}),
        (lambda: text.title_to_name(X()), {"Reviews of A Place User Reviews - x": "A Place", "B | C": "B", None: "Unknown Restaurant"}),
        (lambda: text.title_case(X()), {"o'neil 3rd": "O'Neil 3Rd"}),
        (lambda: text.strip_tags(X()), {"<p>a&nbsp;&amp; b</p>": "a & b", None: ""}),
        (lambda: text.unescape_html(X()), {"caf&eacute; &#8217;": "café ’"}),
        (lambda: text.escape_html(X()), {"<a href='x'>&": "&lt;a href=&#x27;x&#x27;&gt;&amp;"}),
        (lambda: text.truncate(X(), 3), {"ab\ncd": "ab …", "ab": "ab"}),
        (lambda: text.sanitize_file_name(X()), {'a<b>:"/\\|?*c ': "abc", "?": "Unknown Restaurant"}),
        (lambda: urls.base_url(X()), {"https://h/c/x/reviews?page=2#a": "https://h/c/x", "https://h/c/x/order/info": "https://h/c/x", "https://h/c/x/info/order": "https://h/c/x/info", "": "", None: ""}),
        (lambda: urls.prefer_info(X()), {"https://h/x/order?a": "https://h/x/info", " https://h/x?a ": "https://h/x?a"}),
        (lambda: urls.topic_page_url(X(), F.lit(20)), {"https://h/a-t5.html": "https://h/a-t5-20.html"}),
        (lambda: urls.merge_query(X(), {"b": "2 3", "a": "1"}), {"https://h/x?c=&a=0#f": "https://h/x?a=1&b=2+3&c=", "https://h/x": "https://h/x?a=1&b=2+3"}),
        (lambda: urls.article_url(X(), "www.h.org", aliases=("h.org",), reserved=("types",)), {"/resources/a": "https://www.h.org/resources/a", "//h.org/resources/b/": "https://www.h.org/resources/b", "https://x.org/resources/a": None, "/resources/types": None, "/resources": None, "javascript:a": None, "": None}),
        (lambda: urls.share_url(X(), r"h\.co"), {"see https://h.co/abc). ok": "https://h.co/abc", "none": None}),
        (lambda: urls.name_from_url(X()), {"https://h/c/my-place-3rd/info": "My Place 3Rd", "": "Unknown Restaurant"}),
        (lambda: urls.next_link(X()), {'<https://h/?p=2>; rel="next", <https://h/?p=9>; rel="last"': "https://h/?p=2", "": None}),
        (lambda: F.array_join(urls.candidate_names(X(), F.lit("Area"), F.lit("https://h/c/my-cafe/info"), "City"), "|"), {"A/B": "AB, Area, City|AB, Area|AB|My Cafe", None: "My Cafe"}),
        (lambda: urls.mentions(X(), "h.org"), {" HTTPS://H.ORG/x": True, "nan": False, None: False}),
        (lambda: urls.allowed(X()), {"https://h/drugs/x": True, "https://h/checkout/drugs/": False, "https://h/": False, "https://h/drugs-usage": False}),
        (lambda: classify.review_effort(X()), {"": "one_liner", "!!!": "one_liner", "good": "low_effort_emotional_DISMISSIVE", "good!!": "low_effort_emotional_DISMISSIVE", "nice food": "one_liner", "rude staff": "low_effort_emotional_ENGAGED", "crispy dosa was lovely": "low_effort_emotional_ENGAGED", "a b c d e f g h i": "medium_effort", "a. b. c. d": "high_effort_structured", "a. b": "medium_effort", None: "one_liner"}),
        (lambda: F.array_join(classify.triggers(X()), ","), {"Craft beer at the bar on Friday": "alcohol_consumed_this_visit,alcohol_identity_signal,bar_quality_signal,visit_day", "नमस्ते": "review_language", "barley": "", None: ""}),
        (lambda: classify.contrasts_dishes(X()), {"dosa great but curry bad": True, "dosa great but slow": False, "dosa and curry": False}),
        (lambda: classify.fetch_status(X()), {None: "no_preloaded_state", '{"drugPage":{"drugNotFound":true}}': "drug_not_found", "{}": "no_drug_info", '{"drugPage":{"drugInfo":{}}}': "no_sku", '{"drugPage":{"drugInfo":{"sku":{"id":1}}}}': "ok"}),
        (lambda: classify.mapped(X(), {"high": "bad"}, "neutral"), {"high": "bad", "x": "neutral"}),
        (lambda: jsons.profile_field(X(), "When were you/they diagnosed?"), {'{"When were you/they diagnosed?":"Feb 2009"}': "Feb 2009", "[1]": None, "not json": None, '{"Name":""}': None}),
        (lambda: jsons.strip_nulls(X()), {'{"a":null,"b":[],"c":{"d":""},"e":0,"f":[{},1],"g":false}': '{"e":0,"f":[1],"g":false}', "x": None}),
        (lambda: jsons.scalar_text(X()), {" a ": "a", '{"label":{"text":"b"}}': "b", '{"z":1}': '{"z":1}', None: "", "3": "3"}),
        (lambda: jsons.first_display_text(X()), {'[{"display_text":""},{"displayText":"b"}]': "b", "x": "", None: ""}),
        (lambda: jsons.json_strings(X()), {'{"a":["b",{"c":"d"}],"e":1}': ["b", "d"], "x": []}),
    ],
)
def test_expression(spark, make, cases):
    assert dict(zip(cases, values(spark, make(), list(cases)), strict=True)) == cases


@pytest.mark.parametrize("a, b, score", [("a-cafe", "a-cafe", 1.0), ("cafe", "mycafe-x", 0.92), ("foo-bar", "bar-baz", 1 / 3), ("ab", "cd", 0.0), ("", "x", 0.0)])
def test_slug_score(spark, a, b, score):
    assert spark.range(1).select(text.slug_score(F.lit(a), F.lit(b))).first()[0] == pytest.approx(score)


def test_assigned():
    assert jsons.assigned('x; window.__PRELOADED_STATE__ = {"a": "}\\"", "b": [1]}; y', "__PRELOADED_STATE__") == {"a": '}"', "b": [1]}
    assert jsons.assigned("PRELOADED_STATE = JSON.parse(\"{\\\"a\\\": \\\"caf\\u00e9\\\"}\")", "PRELOADED_STATE") == {"a": "café"}
    assert jsons.assigned("PRELOADED_STATE = {", "PRELOADED_STATE") is None
    assert text.escape_template("a`${b}\\") == "a\\`\\${b}\\\\" and text.format_bytes(2048) == "2.00 KB"


@pytest.mark.parametrize(
    "doc, fired, want",
    [
        ({"service": {"staff_friendliness": "friendly"}}, [], {"service": {"staff_friendliness": "warm"}}),
        ({"context": {"visit_type": "one_time_visitor"}}, [], {"context": {}, "reviewer_signal": {"reviewer_type": "one_time_visitor"}}),
        ({"bar": {"alcohol_identity_signal": "none"}}, [], {}),
        ({"cross_dish_consistency_signal": "consistent"}, [], {}),
        ({"cross_dish_consistency_signal": "consistent"}, ["cross_dish_consistency_signal"], {"cross_dish_consistency_signal": "consistent_across_dishes"}),
        ({"dishes": [{"name": "x", "portion_size": "moderate"}, 1]}, [], {"dishes": [{"name": "x", "portion": "adequate"}, 1]}),
        ({"atmosphere": {"ambience": "x", "decor_character": "minimalist"}}, [], {"atmosphere": {"decor_character": "minimal"}}),
        ({"cuisine": {"menu_breadth": "extensive_but_coherent"}}, [], {"cuisine": {"cuisine_specialization_clarity": "extensive_but_coherent"}}),
        ({"entertainment": {"live_music": "variable"}, "value": {"portion_size": "sufficient"}}, [], {"entertainment": {"live_music": "none"}, "value": {"portion_size": "adequate"}}),
        ([1], [], [1]),
    ],
)
def test_normalised(doc, fired, want):
    assert nested.normalised(json.loads(json.dumps(doc)), fired) == want


def test_nested(spark):
    doc = '{"service": {"noise": "z", "odd": 1, "span": "q"}, "dishes": [{"price": 1}], "extra": {}}'
    df = spark.createDataFrame([(1, doc), (2, None), (3, "[]")], "id int, doc string")
    legal = {"service": ["noise"], "dishes": ["name"]}
    assert df.select(nested.unknown_fields(F.col("doc"), legal).alias("u")).first().u == ["service.odd", "dishes[].price", "extra"]
    assert df.select(nested.unknown_fields(F.col("doc"), legal, "").alias("u")).first().u == ["service.odd", "dishes.price", "extra"]
    domain = spark.createDataFrame([("service.noise", "a")], "path string, value string")
    assert nested.enum_violations(df, "id", "doc", domain).collect() == [(1, "service.noise", "z")]
    assert nested.missing_required(df, "id", "doc", {"dishes": ["name"]}).collect() == [(1, "dishes.name")]
    merged = json.loads(df.select(nested.with_authority(F.col("doc"), "3", F.array(F.lit("a")), F.lit("one_liner"))).first()[0])
    assert merged["schema_version"] == "3" and merged["t2_triggers_fired"] == ["a"] and merged["reviewer_signal"] == {"review_effort_signal": "one_liner"}
    one = nested.run_summary(df, "doc", F.lit(False), F.lit(10), F.lit(1)).first()
    assert (one.n, one.n_extracted, one.n_empty, one.tokens_in) == (3, 1, 2, 30)
    assert {r.section: r.n for r in nested.section_coverage(df, "doc").collect()} == {"service": 1, "dishes": 1, "extra": 1}
    assert nested.compact(df, "doc", ["id"]).first().extracted == '{"service":{"noise":"z","odd":1,"span":"q"},"dishes":[{"price":1}]}'
    asked = spark.range(1).select(nested.prompt(F.lit(4.5), F.array(F.lit("a")), F.lit("t")), nested.prompt(F.lit(4.0), F.array().cast("array<string>"), F.lit(None))).first()
    assert asked[0] == "Rating: 4.5\nTriggers: a\nReview:\nt" and asked[1] == "Rating: 4\nTriggers: none\nReview:\n"
    assert nested.describe_schema(df.schema) == "id: int\ndoc: string"


INDEX = """<p>2,776 topics &bull; Page <strong>1</strong> of <strong>112</strong></p><ul class="topiclist topics">
<li class="row"><dl><dt><a class="topictitle" href="./a-slug-t1002.html">First &amp; topic</a><img alt="Attachment(s)" src="x"> by <a href="/forum/member/ann">Ann</a> on Thu Apr 19, 2012 2:19 pm</dt>
<dd class="posts">472</dd><dd class="views">80,784</dd><dd class="lastpost">by <a href="/forum/member/bob">Bob</a> <a href="./a-slug-t1002-470.html#p9">x</a> on Fri Apr 20, 2012 3:00 am</dd></dl></li>
<li class="row"><a class="topictitle" href="/other.html">No topic</a></li></ul><ul><li class="row"><a class="topictitle" href="./b-t7.html">Elsewhere</a></li></ul>"""
TOPIC = """<h3 class="first"><a href="x">Title</a></h3>473 posts<div class="pagination"><a href="./a-t1002-10.html">2</a><a href="./a-t1002-470.html">48</a></div>
<div class="post bg1" id="p4785"><dl class="postprofile"><dd><strong>Name:</strong> <b>Ann</b></dd><dd><strong>Age at diagnosis:</strong> 56</dd></dl>
<div class="postbody"><h3 class="first"><a href="#p4785">Title</a></h3><p class="author">by <strong><a href="./member/ann">Ann</a></strong> on Thu Apr 19, 2012 2:19 pm </p>
<div class="content">Hello<br>there <img src="./styles/x.gif"><img src="./pic.jpg"><a href="./download/file.php?id=3">f</a></div></div></div>
<div class="post" id="p4790"><div class="postbody"><h3>Re: Title</h3><div class="postcontent2"><p>One</p><p>Two</p></div></div></div>"""


def test_forum_pages(spark):
    base = "https://h.org/forum/"
    (row,) = pages.topic_rows(INDEX, base)
    assert row == {"topic_id": 1002, "slug": "a-slug", "url": "https://h.org/forum/a-slug-t1002.html", "title": "First & topic", "starter_author": "Ann", "starter_profile_url": "https://h.org/forum/member/ann", "start_date": "Thu Apr 19, 2012 2:19 pm", "replies": 472, "views": 80, "last_post_author": "Bob", "last_post_profile_url": "https://h.org/forum/member/bob", "last_post_date": "Fri Apr 20, 2012 3:00 am", "last_post_link": "https://h.org/forum/a-slug-t1002-470.html#p9", "has_attachment": True}
    first, second = pages.post_rows(TOPIC, base)
    assert (first["post_id"], first["author"], first["posted_at"], first["body_text"]) == (4785, "Ann", "Thu Apr 19, 2012 2:19 pm", "Hello\nthere\nf")
    assert first["author_meta"] == {"Name": "Ann", "Age at diagnosis": "56"} and first["attachment_urls"] == [base + "pic.jpg", base + "download/file.php?id=3"]
    assert (second["title"], second["body_text"], second["author"]) == ("Re: Title", "One\nTwo", None)
    assert pages.topic_title(TOPIC) == "Title" and pages.page_offsets(TOPIC) == [0, 10, 470]
    df = spark.createDataFrame([(1, INDEX), (2, None), (3, "<")], "id int, html string")
    assert [(r.id, r.topic_id) for r in pages.index_pages(df, "html", base, ["id"]).collect()] == [(1, 1002)]


def test_review_pages(spark):
    block = json.dumps({"reviews": [{"author": {"name": "A"}, "url": "u", "description": "d", "reviewRating": {"ratingValue": 4}}, {"author": "B", "description": "e"}]})
    ld = f'<script type="application/ld+json">{{bad</script><script type="application/ld+json">{block}</script>'
    assert [(r["key"], r["author"], r["rating"]) for r in pages.review_rows(ld)] == [("u", "A", "4"), ("ld:B|e", "B", None)]
    state = {"entities": {"REVIEWS": {"7": {"userName": "C", "reviewUrl": "v", "reviewTextSm": "s", "ratingV2": 5}}}, "pages": {"restaurant": {"1": {"sections": {"SECTION_X_REVIEW": {"numberOfPages": 3.0}}}}}}
    page = f"<script>window.__PRELOADED_STATE__ = JSON.parse({json.dumps(json.dumps(state))});</script>"
    assert pages.review_rows(page) == [{"key": "v", "author": "C", "review_url": "v", "description": "s", "rating": "5"}]
    assert pages.number_of_pages(state) == 3 and pages.number_of_pages({"pages": {"current": {"sections": {"SECTION_REVIEWS": {"numberOfPages": 2}}}}}) == 2 and pages.number_of_pages(None) is None
    card = "Ann\n2 reviews\nDINING\n4\n3 days ago\nGood food\nand more\n2 votes\nHelpful"
    got = spark.createDataFrame([(card,)], "x string").select(pages.card_fields(F.col("x")).alias("f")).first().f
    assert tuple(got) == ("Ann", "4", "3 days ago", "Good food\nand more")


def test_article(spark):
    long = "word " * 60
    html = f'<html><head><title>T</title><meta property="og:title" content="Longer title"><meta name="description" content=" d "></head><body><h1>H</h1><div>x</div><article><p>{long}</p></article><script type="application/ld+json">{{"a":1}}</script></body></html>'
    row = pages.article_row(html)
    assert row == {"title": "Longer title", "meta_description": "d", "h1": "H", "article_text": long.strip(), "json_ld": '[{"a": 1}]', "error": None}
    assert pages.article_row("<body><div>ab</div><div>abc</div></body>")["article_text"] == "abc"
    cut = pages.article_row('<title>a&amp;&amp</title><meta name="description" content="m&amp"><h1>b&lt;&lt</h1><div>R&amp;D &notin; &notx; &#65; AT&T &copy=\ue000</div><script type="application/ld+json">{"u":"?a&amp"}</script>')
    assert cut == {"title": "a&&amp", "meta_description": "m&amp", "h1": "b<&lt", "article_text": "a&&amp\nb<&lt\nR&D ∉ &notx; A AT&T &copy=\ue000", "json_ld": '[{"u": "?a&amp"}]', "error": None}
    df = spark.createDataFrame([(1, '<a href="/x">x</a> https://h.org/y <a href="/x">again</a>')], "id int, html string")
    assert {r.link for r in pages.links(df, "html", ["id"]).collect()} == {"/x", "https://h.org/y"}


def test_article_of_many_blocks(spark):
    """The longest block counts wherever it stands: behind many others, within them, around them."""
    long, others = "the story " * 12, "".join(f"<div>note {k}</div>" for k in range(300))
    shapes = {1: f"<div>{long}</div>{others}", 2: f"{others}<div>{long}</div>", 3: others + "<section>" * 90 + f"<div>{long}</div>", 4: f"{others}<main><p>{long}</p></main>", 5: others + "<div>" * 90 + long, 6: f"{others}<article>short</article><article>{long}</article>"}
    df = spark.createDataFrame([(k, f"<body>{html}</body>") for k, html in shapes.items()], "id int, html string")
    assert {r.id: r.article_text for r in pages.article_pages(df, "html", ["id"]).collect()} == dict.fromkeys(shapes, long.strip())
    deal = random.Random(5)
    marks = ("<div>", "</div>", "<div>", "</div>", "<p>", "</p>", "<main>", "</main>", "<article>", "</article>", "<section>", "</section>", "<br>", "<style>p{color:red}</style>", "a", "bc", " ", "def g")
    for _ in range(300):
        root = parse("<body>" + "".join(deal.choices(marks, k=deal.randrange(400))))
        blocks = [n for n in root.first("body").walk() if n.tag in ("article", "main", "div")]
        assert pages.visible_text(root, 10_000) == max((b.text("\n", strip=True) for b in blocks), key=len, default="")


@pytest.mark.parametrize(
    "page, want",
    [
        ('<div data-to="/resources/a-b">x</div>', {"/resources/a-b"}),
        ("<a href=/resources/c>x</a><a href='/d e,'>y</a><a href=\"it's\">z</a><br />", {"/resources/c", "/d e,", "it's"}),
        (r'<script>load("https:\/\/h.org\/x?a=1\u0026b=2", "\/resources\/e")</script>', {"https://h.org/x?a=1&b=2", "/resources/e"}),
        ("go to /resources/f, or (/g) </p> and/or 1 / 2", {"/resources/f", "/g"}),
        (r'<script id="__NEXT_DATA__" type="application/json">{"a": [{"to": "\u002fresources\u002fh"}, "<a href=\"\u002fi\">", "no"], "b": "\u0068ttps://h.org/j"}</script>', {"/resources/h", "/i", "https://h.org/j"}),
        ("<script>__NEXT_DATA__ = {broken</script>", set()),
    ],
)
def test_links(spark, page, want):
    got = [r.link for r in pages.links(spark.createDataFrame([(1, page), (2, None)], "id int, html string"), "html", ["id"]).collect()]
    assert sorted(got) == sorted(want)


def test_drug_page(spark):
    state = {"drugPage": {"drugInfo": {"sku": {"id": 5, "name": "N", "price": 1.5, "inStock": True, "shortComposition": {"displayText": "<b>S</b>"}, "marketer": {"name": " M "}, "introduction": [{"display_text": "<p>I&amp;J</p>"}], "uses": [{"a": 1}], "quantities": [], "quantityProduct": {"q": 1}}, "authoredBy": {"authors": [{"role": "Written By", "name": "W", "qualifications": "Q"}], "lastUpdated": {"date": "2020"}}, "metaData": {"meta_desc": "md"}}}}
    html = f"<script>window.PRELOADED_STATE = {json.dumps([json.dumps(state)])};</script>"
    rows = pages.drug_rows(spark.createDataFrame([("u", html, 200), ("v", "none", 404)], "url string, html string, status int"), "url", "html", "status").orderBy("url").collect()
    r = rows[0].asDict()
    assert {k: r[k] for k in ("fetch_status", "sku_id", "name", "price", "in_stock", "available", "salt_composition", "marketer_name", "introduction_text", "uses_json", "pack_info", "written_by", "written_by_qualifications", "last_updated", "meta_description")} == {"fetch_status": "ok", "sku_id": "5", "name": "N", "price": "1.5", "in_stock": "True", "available": "False", "salt_composition": "S", "marketer_name": "M", "introduction_text": "I&J", "uses_json": '[{"a":1}]', "pack_info": '{"q":1}', "written_by": "W", "written_by_qualifications": "Q", "last_updated": "2020", "meta_description": "md"}
    assert rows[1].fetch_status == "no_preloaded_state" and rows[1].name == "" and len(r) == 46
