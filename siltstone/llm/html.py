"""HTML extraction by consensus host paths.

Each page's containers are scored by the text that stands in them, links counting against them. A page votes for the
generalised path (tags with their first class, digits masked) of its best container; Spark counts the votes of each host, and
its pages are extracted again from the winning paths. A page that holds none of them is taken by its own best container.

Null or blank html gives empty text; pages without host form one group. Repeated rows are extracted each. Markup may be broken:
unclosed, crossed and stray tags are closed as browsers would do in the plain cases. Blocks keep page order; nothing is cut off, very
long pages are read whole. An empty table gives no rows. Only the key, the address and the html are read, so other columns may have any
names. Equal votes go to the path of the larger score, then to the first by name.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.common import bounded_batches, slices, stored

#: Tags and comments as the HTML standard's tokenizer reads them: a quote opens a value only behind "=", elsewhere it belongs to a name or a
#: bare value. A value whose quote is never closed ends at the next space or ">"; a tag that is never closed ends with the page.
VALUE = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))"""
TOKEN = re.compile(rf"<(?:!--(?:-?>|.*?(?:--!?>|\Z))|(/?)([a-zA-Z][^\s/>]*+)((?>[\s/]+|[^\s/>][^\s/>=]*(?:{re.sub(r'[(](?![?])', '(?:', VALUE)})?)*+(?:\s*=)?)(?:>|\Z)|[!?/][^>]*(?:>|\Z))", re.S)
ATTRIBUTE = re.compile(rf"([^\s/>][^\s/>=]*)(?:{VALUE})?")
#: Elements that end at their end tag whatever stands within, and others whose text isn't the page's.
RAW = frozenset("script style textarea title noscript iframe xmp".split())
SKIPPED = frozenset("template svg math foreignobject select button object canvas video audio".split())
#: Skipped elements that hold no block, and those that can't hold another of their kind.
FOREIGN, FLAT = frozenset(("svg", "math")), frozenset(("select", "button"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("article main section div td body center blockquote".split())
#: Elements and roles whose text is not the article's.
DROPPED = frozenset("head nav footer aside header form dialog menu".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar".split())
#: Class names drop an element if all their words are of these two lists and one is of the first: "cookie-notice" and "comment-list" do,
#: "ad-free-content" and "note-alert" don't. Names that an article's own boxes may have count outside an article only.
UNWANTED = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead comment comments respond disqus cookie cookies consent gdpr notice notices popup modal overlay share sharing social related recommended newsletter subscribe signup login search pagination pager widget widgets toolbar".split()
)
OUTSIDE = frozenset("alert alerts info message messages callout".split())
BESIDE = frozenset(
    "site page main top bottom left right upper lower global primary secondary inner outer box bar block container wrapper wrap area list section slot unit text link links item items form thread post posts entry reader readers user users sticky fixed mobile desktop col column panel button buttons btn bg policy law accept row holder zone footer header title body count reply replies media icons".split()
)
UNWANTED_PARTS = re.compile(r"^(?:cookie|advert|sidebar|sponsor|breadcrumb|newsletter)(?:s|bar|box|banner|notice|consent|ing|isement|ed|signup)?$|^(?:site|page|main|top|bottom|left|right|sub|mega|global)(?:nav|menu|sidebar|footer|banner)$")
#: Words of the ids of reader comments, of which one must be of the first two.
COMMENTS = frozenset("comments comment disqus respond thread reader readers user users list area section box form wrapper container".split())
#: Elements in each other, and marked ones, from which on paths and marks grow no further; no text is lost by it.
DEEPEST = 256
HIDDEN = re.compile(r"display\s*:\s*none", re.I)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words of classes and ids that make a header an article's own.
OWN = frozenset("article blog content entry post story".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "body": ("head",)}


@dataclass
class Block:
    path: str
    text: str
    linked: int
    marks: tuple[int, ...] = ()
    article: tuple[int, str] | None = None  # the article (else main) element around it, numbered, and its path


@dataclass
class Mark:
    """An element that its tag or its names mark as no part of the article."""

    weak: bool  # marked by names, or a form: not so if the page's only article stands within
    holds_article: bool = False
    holds_title: bool = False


def attributes(source: str) -> dict[str, str]:
    """Attributes by lower-case name; of repeated ones the first counts."""
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(source):
        found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return found


def drops(name: str, within: bool) -> bool:
    """Whether a class name marks what is no part of an article; ``within`` an article fewer do."""
    words = [w for w in re.split(r"[^a-z]+", name.lower()) if w]
    own = OWN if "header" in words or "footer" in words else frozenset()
    marked = [w in UNWANTED or bool(UNWANTED_PARTS.search(w)) or w in OUTSIDE and not within for w in words]
    return any(marked) and all(m or w in BESIDE or w in own or w in OUTSIDE for m, w in zip(marked, words, strict=True))


def made_of_heading(name: str, after: str) -> bool:
    """Whether an id repeats the heading that its element begins with, as Markdown tools make them."""
    m = re.match(r"\s*<h([1-6])\b[^>]*>(.*?)</h\1", after, re.S | re.I)
    slug = lambda t: re.sub(r"\W+", "-", entities.unescape(re.sub("<[^>]+>", "", t))).strip("-").lower()
    return bool(m) and slug(m[2]) == slug(name)


def unwanted(tag: str, own: dict[str, str], within: bool, after: str) -> tuple[bool, bool, bool]:
    """Whether an element's attributes hide it or mark it as no part of the article, and whether they mark it as the header of an article."""
    if "hidden" in own or HIDDEN.search(own.get("style", "")):
        return True, False, False
    names = own.get("class", "").split()
    headed = any("header" in (words := re.split(r"[^a-z]+", c.lower())) and not OWN.isdisjoint(words) for c in names)
    marked = own.get("role", "").lower() in ROLES or any(drops(c, within) for c in names)
    ident = own.get("id", "")
    if not marked and ident and tag not in HEADINGS and tag != "p":
        words = {w for w in re.split(r"[^a-z]+", ident.lower()) if w}
        marked = bool(words & {"comments", "comment", "disqus", "respond"}) and words <= COMMENTS or not within and drops(ident, within) and not made_of_heading(ident, after)
    return False, marked, headed


def blocks(source: str) -> list[Block]:
    """The page's blocks of text that stand in no dropped element, with the generalised path of the element around each.

    Names are the weaker sign: where no article or main element stands outside dropped elements, those that hold one by a class or id,
    and forms, are kept.
    """
    out: list[Block] = []
    stack: list[tuple[str, str, tuple[int, ...], bool, tuple[int, str] | None]] = []  # tag, path, marks around it, whether it is an article's header, the article around it
    marks: list[Mark] = []
    articles = elements = 0  # articles that stand in no marked element, all elements
    skips: list[tuple[str, int, bool]] = []  # open skipped elements: tag, size of the stack around, whether the next block ends it
    nexts: dict[str, int] = {}
    parts: list[str] = []
    linked, link_from, anchors = 0, 0, 0
    at, end = 0, len(source)

    def flush() -> None:
        nonlocal linked, link_from
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split()) if not (stack and any(not marks[k].weak for k in stack[-1][2])) else ""
            if text:
                size = sum(map(len, parts))
                out.append(Block(stack[-1][1] if stack else "", text, linked + (size - link_from if anchors else 0), *((stack[-1][2], stack[-1][4]) if stack else ())))
            parts.clear()
        linked = link_from = 0

    def next_at(what: str) -> int:
        """Where ``what`` (the beginning of a tag) comes next; each place is looked for once."""
        if nexts.get(what, -1) < at:
            m = re.compile(rf"{what}(?=[\s/>])", re.I).search(source, at)
            nexts[what] = m.start() if m else end
        return nexts[what]

    def unskip(k: int) -> None:
        """Ends the skipped elements from the ``k``-th on, and blocks open within them."""
        del stack[skips[k][1] :]
        del skips[k:]

    def pop(tags: tuple[str, ...], within: frozenset[str]) -> None:
        """Closes up to the nearest open element of ``tags``, if no element of ``within`` stands between."""
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in tags:
                del stack[k:]
                return
            if stack[k][0] in within:
                return

    while at < end:
        m = TOKEN.search(source, at)
        if not m:
            if not skips:
                parts.append(source[at:])
            break
        if m.start() > at and not skips:
            parts.append(source[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        closed_itself = m[3].endswith("/") and not re.match(r"""[^=]*=[^"']""", m[3].rsplit(None, 1)[-1])
        if m[1]:
            if tag == "a" and anchors:
                linked += sum(map(len, parts)) - link_from
                anchors = 0
            elif tag in SKIPPED:
                for k in range(len(skips) - 1, -1, -1):
                    if skips[k][0] == tag:
                        unskip(k)
                        break
            elif tag in BLOCKS:
                if skips and any(t[0] == tag for t in stack[skips[-1][1] :]):
                    pop((tag,), frozenset())
                    continue
                holds = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)
                inner = next((k for k, (_, depth, loose) in enumerate(skips) if loose or holds is not None and holds < depth), None)
                if inner is not None:
                    unskip(inner)
                if skips:
                    continue
                flush()
                pop((tag,), frozenset(("td", "th")) if tag not in ("table", "tr", "td", "th", "body", "html") else frozenset())
        elif tag in RAW:
            if tag in ("script", "style") or not closed_itself:
                close = re.compile(rf"</{tag}\s*>", re.I).search(source, at) if next_at(f"</{tag}") < end else None
                at = close.end() if close else end if tag in ("script", "style") else at
            parts.append(" ")
        elif tag in SKIPPED:
            parts.append(" ")
            if not closed_itself and (tag != "foreignobject" or skips):
                shut = next_at(f"</{tag}")
                loose = tag in FOREIGN or shut == end or tag in FLAT and next_at(f"<{tag}") < shut
                skips.append((tag, len(stack), loose))
        elif tag in VOID:
            parts.append(" ")
            if tag == "hr" and not skips:
                flush()
        elif tag == "a":
            if skips:
                continue
            link_from, anchors = sum(map(len, parts)), 1
        elif tag in BLOCKS:
            if skips and skips[-1][2]:
                k = len(skips) - 1
                while k and skips[k - 1][2]:
                    k -= 1
                unskip(k)
            if skips:
                if not closed_itself:
                    marks.append(Mark(False))
                    stack.append((tag, stack[-1][1] if stack else "", (*(stack[-1][2] if stack else ()), len(marks) - 1), False, None))
                continue
            flush()
            if tag in CLOSES:
                pop(CLOSES[tag], frozenset(("ul", "ol", "dl", "table")))
            if tag not in ("html", "body") and stack and stack[-1][0] == "p":
                stack.pop()
            own = attributes(m[3]) if m[3] else {}
            first = own.get("class", "").split()[:1]
            name = f"{tag}.{re.sub(r'[0-9]+', '#', first[0].lower())}" if first else tag
            around, path, inside, header, article = stack[-1] if stack else ("", "", (), False, None)
            gone, marked, headed = unwanted(tag, own, article is not None, source[at : at + 500]) if own and tag not in ("html", "body", "article", "main") else ("hidden" in own, False, False)
            title = tag in HEADINGS and inside and (header or around in ("header", "hgroup") and any(t[0] == "article" for t in stack))
            if title and not gone:
                inside = inside[:-1]
            if (gone or marked or tag in DROPPED) and len(inside) < DEEPEST:
                marks.append(Mark(not gone and (tag == "form" or tag not in DROPPED)))
                inside = (*inside, len(marks) - 1)
            elif tag in ("article", "main"):
                articles += not inside
                for k in inside:
                    marks[k].holds_article = True
            elif tag == "h1":
                for k in inside:
                    marks[k].holds_title = True
            path = f"{path}>{name}" if path else name
            path = stack[-1][1] if len(stack) >= DEEPEST else path
            elements += 1
            if tag == "article" or tag == "main" and article is None:
                article = elements, path
            stack.append((tag, path, inside, headed or header and tag in ("div", "hgroup"), article))
            if closed_itself and tag not in ("p", "div"):
                stack.pop()
    if skips:
        unskip(0)
    flush()
    lifted = {k for k, m in enumerate(marks) if m.weak and m.holds_article and not articles}
    if not any(lifted.issuperset(b.marks) for b in out):
        lifted |= {k for k, m in enumerate(marks) if m.weak and (m.holds_article or m.holds_title)}
    return [b for b in out if lifted.issuperset(b.marks)]


def best_container(found: list[Block]) -> tuple[str, float]:
    """Path and score of the page's only article (or main) element, else of the container whose own and next text is most and least linked.

    An article around that goes before it.
    """
    only = {b.article for b in found if b.article}
    if len(only) == 1:
        path = only.pop()[1]
        return path, float(sum(len(b.text) for b in found if b.article))
    scores: dict[str, float] = defaultdict(float)
    for b in found:
        steps = b.path.split(">")
        worth = max(0.0, len(b.text) - 2.0 * b.linked) * (1.5 if steps[-1].split(".")[0] in ("p", "pre", "blockquote") else 1.0)
        share = 1.0
        for k in range(len(steps), 0, -1):
            tag = steps[k - 1].split(".")[0]
            if tag in CONTAINERS:
                scores[">".join(steps[:k])] += share * worth * (1.25 if tag in ("article", "main") else 1.0)
                share /= 2
                if share < 0.1:
                    break
    if not scores:
        return "", 0.0
    path = max(scores, key=lambda p: (scores[p], p))
    steps = path.split(">")
    for wanted in ("article", "main"):
        for k in range(1, len(steps)):
            if steps[k - 1].split(".")[0] == wanted:
                path = ">".join(steps[:k])
                return path, max(scores[path], scores[">".join(steps)])
    return path, scores[path]


def vote(source: str | None) -> tuple[str, float]:
    return best_container(blocks(source or ""))


def extract(source: str | None, paths: list[str]) -> str:
    """The text below the first of ``paths`` that the page has, else below its own best container."""
    if not source:
        return ""
    found = blocks(source)
    there = {path[:k] for path in {b.path for b in found} for k in [*(m.start() for m in re.finditer(">", path)), len(path)]} if paths else set()
    own = next((p for p in paths if p in there), None) or best_container(found)[0]
    return "\n".join(b.text for b in found if not own or b.path == own or b.path.startswith(own + ">"))


def host(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def host_paths(pages: DataFrame, url: str = "url", html: str = "html", least_share: float = 0.01) -> DataFrame:
    """host and its winning paths, most voted first: those with a share of the votes of ``least_share``, so 1 / ``least_share`` at most, or the first.

    A path of a smaller share is no consensus; pages that hold no winning path are taken by their own best container.
    """

    def voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sources in slices(batches, 1):
            got = [vote(s) for s in sources]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([p for p, _ in got], pa.string()), pa.array([s for _, s in got], pa.float64())], names=["host", "path", "score"])

    rows = pages.select(host(F.col(f"`{url}`")).alias("host"), F.col(f"`{html}`").alias("html"))
    votes = bounded_batches(rows).mapInArrow(voted, "host string, path string, score double").filter("path <> ''").groupBy("host", "path").agg(F.count(F.lit(1)).alias("votes"), F.sum("score").alias("score"))
    by_host = Window.partitionBy("host")
    ranked = votes.withColumn("share", F.col("votes") / F.sum("votes").over(by_host)).withColumn("rank", F.row_number().over(by_host.orderBy(F.desc("votes"), F.desc("score"), "path")))
    won = ranked.filter((F.col("rank") == 1) | (F.col("share") >= least_share))
    return won.groupBy("host").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "path"))), lambda s: s.path).alias("paths"))


def extract_pages(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", most_hosts: int = 20_000) -> DataFrame:
    """key, url, text and n_chars of every page. The hosts' paths are broadcast if there are at most ``most_hosts``, else joined by a shuffle."""
    paths = stored(host_paths(pages, url, html), "host-paths")
    rows = pages.select(F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html"), host(F.col(f"`{url}`")).alias("host"))
    few = paths.limit(most_hosts + 1).count() <= most_hosts
    joined = rows.join(F.broadcast(paths) if few else paths, "host", "left").select("key", "url", "paths", "html")

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sources in slices(batches, 3):
            texts = [extract(s, p or []) for s, p in zip(sources, part.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["key", "url", "text", "n_chars"])

    out = joined.mapInArrow(extracted, f"key {rows.schema[0].dataType.simpleString()}, url string, text string, n_chars long")
    return out.withColumnRenamed("key", key)
