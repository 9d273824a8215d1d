import html as entities
import re

import pytest

from siltstone.llm import html, queries

CHROME = "<html><head><title>t</title><style>p{}</style></head><body><nav><ul><li><a href='/x'>Menu</a></li></ul></nav>"
SCHEMA = "page_id long, url string, html string, path string, host string"


def article(page):
    """What the generator's pages hold: blocks between p and h1 tags of their article."""
    inner = page[page.index("<article>") + 9 :].split("</article>")[0].split("<footer>")[0]
    parts = (" ".join(entities.unescape(re.sub("<[^>]+>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inner))
    return "\n".join(p for p in parts if p)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_op2(spark, sf):
    pages = {r.page_id: r for r in queries.table(spark, f"/root/testdata/{sf}", "pages").collect()}
    got = queries.op2_html_extraction(spark, f"/root/testdata/{sf}").collect()
    assert len(got) == len(pages)
    for r in got:
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, article(pages[r.page_id].html), len(r.text))


@pytest.mark.parametrize(
    "body, text",
    [
        ("<div class=post><h1>T&eacute;&amp;</h1><p>One&nbsp;two\n three<p>Four <b>fi</b>ve</div><div class='comments'><p>nice</p></div>", "Té&\nOne two three\nFour five"),
        ("<article><header><h1>Title</h1><p>by x</p></header><p>a</p><aside>side</aside><form>f</form><ul><li>b<li>c</ul><footer>end", "Title\na\nb\nc"),
        ("<main><p>a</p><script>var x = '<p>no</p>'</script><!-- <p>no</p> --><p>b &lt;i&gt;</p></main>", "a\nb <i>"),
        ("<div class='cookie-notice'>We use</div><article class='post-7'><p>text</p><div class=ad>buy</div><p>more", "text\nmore"),
        ("<div class=sidebar><a href=x>aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa</a></div><div><p>short text.</p></div>", "short text."),
        ("<article><p>a<button>Buy</button> b</p><div class='cookiebar'>c</div><div hidden>d</div><div class='sitefooter'>e</div><section id='reader-comments'><p>f</p></section><p class='unhidden'>g</p></article>", "a b\ng"),
        ("<article><p>a < b and <3 c</p><p title='x>y'>d</p></article>", "a < b and <3 c\nd"),
        ("", ""),
    ],
)
def test_extract(body, text):
    assert html.extract(CHROME + body, []) == text


@pytest.mark.parametrize(
    "body, text",
    [
        ("<p>a<svg class='i' />b</p><p>c</p><svg><path d=''/></svg><p>d</p>", "a b\nc\nd"),
        ("<p>a<svg><path d='x'><p>b</p><svg><g></g></svg><p>c</p>", "a\nb\nc"),
        ("<p>a<button>Buy</p><p>b</p><button>Buy</button><p>c</p>", "a\nb\nc"),
        ("<p>a</p><button>Buy<p>b</p><p>c</p>", "a\nb\nc"),
        ("<p>a<button><div>Buy</div><span>it</span></button> b</p><p>c</p>", "a b\nc"),
        ("<div><p>a</p><video src=x><p>no video</p></div><p>b</p><video src=y></video><p>c</p>", "a\nb\nc"),
        ("<p>a</p><iframe src='x' /><p>b</p><select><option>x<option>y</select><p>c</p>", "a\nb\nc"),
        ("<p>a</p><object><object><p>x</p></object>y</object><p>b<canvas>no</canvas></p>", "a\nb"),
        ("<svg><foreignObject><div>x</div></foreignObject></svg><p>a</p>", "a"),
        ("<h2 id='related-work'>Related</h2><p id='search'>a</p><h3 id='how-to-share-files'>Share</h3>", "Related\na\nShare"),
        ("<div class='post-header'><h1>Title</h1><p>by x</p></div><p>a</p><div class='site-header'><h1>Site</h1></div>", "Title\na"),
        ("<div title='the hidden gem'>a</div><p data-x='display: none'>b</p><p style='display:none'>c</p><p hidden=''>d</p><div data-class='ad'>e</div>", "a\nb\ne"),
    ],
)
def test_whole_article(body, text):
    """Self-closed and unclosed elements, ids of headings and words within other attributes cut nothing off."""
    assert html.extract(CHROME + "<article>" + body + "</article>", []) == text


@pytest.mark.parametrize(
    "body, text",
    [
        ("<div class='ad-free-content'><article><p>a</p></article></div><div><p>imprint</p></div>", "a"),
        ("<div class='content-widget'><article><p>a</p></article></div><div><p>imprint</p></div>", "a"),
        ("<div class='widget'><article><p>a</p><div class=widget>w</div></article></div><div><p>imprint</p></div>", "a"),
        ("<form id=page><article><p>a</p></article></form><div><p>imprint</p></div>", "a"),
        ("<form id=page><h1>T</h1><div><p>a</p></div></form>", "T\na"),
        ("<aside><article><p>teaser</p></article></aside><div class=post><p>the story itself</p></div>", "the story itself"),
        ("<article><section id='market-share'><h2>Market share</h2><p>a</p></section><section id=search><h2>Search</h2><p>b</p></section></article>", "Market share\na\nSearch\nb"),
        ("<article><div class='note-alert'>a</div><div class=alert>b</div><div class='notice'>c</div><div class='cookie-notice'>d</div></article>", "a\nb"),
        ("<article><p>a</p><div id=comments><h3>Comments</h3><p>b</p></div><ol class='comment-list'><li>c</ol></article>", "a"),
        ("<div class=story><p>a b c d</p><div class='ad-slot'>x</div><div role=alert>y</div><div class='related-posts'><p>z</p></div></div>", "a b c d"),
        ("<div id=header>x</div><div id=main-nav>y</div><p>a b</p><div id=footer>z</div>", "a b"),
    ],
)
def test_names(body, text):
    """Names cut off what is no article by all their words, never the article itself."""
    assert html.extract(CHROME + body, []) == text


@pytest.mark.parametrize(
    "body, text",
    [
        ("<p class=\"x\"\">lost text</p><p>b</p>", "lost text\nb"),
        ("<p><a title=it's>b</a> here</p><p>we don't c</p>", "b here\nwe don't c"),
        ("<p title='a>b' x=\"c>d\" y = e>t</p>", "t"),
        ("<p class='open>a</p><p>b", "a\nb"),
        ("<p title=a/b/>t</p><p/>u</p>", "t\nu"),
        ("<p =x '>a</p><p \"y>b</p>", "a\nb"),
        ("<!--><p>a</p><!-- x --!><p>b</p><!--->c", "a\nb\nc"),
        ("<p>a <3 b < c <é> d</p></ p><p>e", "a <3 b < c <é> d\ne"),
        ("<p data-class='ad' class=x class=ad>a</p>", "a"),
    ],
)
def test_tags(body, text):
    """Tags as the HTML standard's tokenizer reads them."""
    assert html.extract(CHROME + "<article>" + body, []) == text


def test_consensus(spark):
    """A page whose own best container is a long notice takes its host's path; another host's page does not."""
    good = CHROME + "<div class=story><p>Some story text that is long enough.</p></div><div class=legal><p>Terms.</p></div>"
    odd = CHROME + "<div class=story><p>Brief.</p></div><div class=legal><p>Very long terms and conditions, on and on and on and on.</p></div>"
    rows = [(k, "http://a.org/x", good, "p", "h") for k in range(5)] + [(9, "http://A.org/y", odd, "p", "h"), (10, "http://b.org/y", odd, "p", "h")]
    rows += [(11, None, None, None, None), (12, "no url", "<p>x", "", ""), (None, "http://a.org", "", "", ""), (12, "no url", "<p>x", "", "")]
    for hosts in (1000, 0):
        got = [(r.page_id, r.text) for r in html.extract_pages(spark.createDataFrame(rows, SCHEMA), most_hosts=hosts).collect()]
        assert dict(got)[9] == "Brief." and dict(got)[10].startswith("Very long") and dict(got)[11] == "" and dict(got)[None] == ""
        assert got.count((12, "x")) == 2 and len(got) == len(rows)
    assert html.extract_pages(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_page():
    assert len(html.extract("<article>" + "<p>word</p>" * 100_000, []).split("\n")) == 100_000
    assert html.extract("<" * 20_000 + 'a "' * 2000, []) != ""
    for broken in ("<a ", '<p x="', "<a b=c", "<p '", "<!-", "</", "<p =", "a='b' "):
        assert isinstance(html.extract("<article><p>t</p>" + broken * 20_000, []), str)
