"""URL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.functions.text import sanitize_file_name, title_case

#: Paths of the drug catalogue that are kept, and those that are skipped whatever else holds.
ALLOWED_PATHS = ("/otc/", "/drug-store/", "/drugs/", "/generics/", "/drugs-all-medicines", "/drugs-therapeutic-classes", "/categories/", "/marketer/", "/cancer-care/", "/all-diseases", "/labs/", "/doctors/")
DENIED_PATHS = ("/cart", "/admin", "/checkout", "/checkout/prescription", "/checkout/address", "/checkout/confirm", "/search", "/checkDrugInteraction", "/checkdruginteraction", "/articles/", "/community", "/trends", "/drugs-usage", "/drugs-ailments", "/psp", "/vendor-details", "/corporate/")
URL = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def scheme(url: Column) -> Column:
    return F.regexp_extract(url, URL, 1)


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, URL, 2))


def path(url: Column) -> Column:
    return F.regexp_extract(url, URL, 3)


def query(url: Column) -> Column:
    return F.regexp_extract(url, URL, 4)


def path_parts(url: Column) -> Column:
    return F.filter(F.split(path(F.trim(url)), "/"), lambda p: p != "")


def url_slug(url: Column) -> Column:
    """The last part of the path, trailing slashes aside."""
    return F.substring_index(F.regexp_replace(url, "/+$", ""), "/", -1)


def base_url(url: Column) -> Column:
    """Without fragment, query and trailing slashes; '/reviews', then '/info', then '/order' drop off the end, each once."""
    out = F.regexp_replace(F.regexp_replace(F.trim(F.coalesce(url, F.lit(""))), r"[#?].*$", ""), "/+$", "")
    for suffix in ("/reviews", "/info", "/order"):
        out = F.regexp_replace(out, suffix + r"\z", "")
    return out


def prefer_info(url: Column) -> Column:
    """The '/info' page of an '/order' link; other links as they are, trimmed."""
    trimmed = F.trim(F.coalesce(url, F.lit("")))
    bare = F.regexp_replace(F.regexp_replace(trimmed, r"[#?].*$", ""), "/+$", "")
    return F.when(bare.endswith("/order"), F.regexp_replace(bare, r"/order\z", "/info")).otherwise(trimmed)


def listing_url(base: Column, page: Column, sort: str, kind: str) -> Column:
    return F.concat(base, F.lit("/reviews?page="), page.cast("string"), F.lit("&sort="), F.url_encode(F.lit(sort)), F.lit("&filter="), F.url_encode(F.lit(kind)))


def merge_query(url: Column, overrides: dict[str, str]) -> Column:
    """The query with ``overrides`` put in, keys sorted, blank values kept."""
    names = F.array(*[F.lit(k) for k in overrides])
    pairs = F.transform(F.filter(F.split(query(url), "&"), lambda p: p != ""), lambda p: F.struct(F.substring_index(p, "=", 1).alias("k"), F.when(p.contains("="), F.substring(p, F.length(F.substring_index(p, "=", 1)) + 2, F.length(p))).otherwise("").alias("v")))
    own = F.filter(pairs, lambda p: ~F.array_contains(names, p.k))
    new = F.array(*[F.struct(F.lit(k).alias("k"), F.url_encode(F.lit(v)).alias("v")) for k, v in overrides.items()])
    joined = F.array_join(F.transform(F.array_sort(F.concat(own, new)), lambda p: F.concat(p.k, F.lit("="), p.v)), "&")
    return F.concat(F.regexp_replace(url, r"[?#].*$", ""), F.lit("?"), joined)


def absolute(url: Column, site: str) -> Column:
    """https, the site's host and the path alone."""
    return F.concat(F.lit(f"https://{site}"), path(url))


def allowed(url: Column, allow: tuple[str, ...] = ALLOWED_PATHS, deny: tuple[str, ...] = DENIED_PATHS) -> Column:
    """Whether a path may be crawled: no denied prefix, and one of the allowed."""
    p = path(url)
    either = lambda prefixes: "^(?:" + "|".join(prefixes) + ")"
    return ~p.rlike(either(deny)) & p.rlike(either(allow))


def on_host(url: Column, name: str) -> Column:
    return host(url) == name.lower()


def mentions(url: Column, part: str) -> Column:
    """A link that holds ``part`` and is neither blank nor 'nan'."""
    trimmed = F.trim(F.coalesce(url, F.lit("")))
    return F.lower(trimmed).contains(part) & (trimmed != "") & (F.lower(trimmed) != "nan")


def article_url(href: Column, site: str, section: str = "resources", aliases: tuple[str, ...] = (), reserved: tuple[str, ...] = ()) -> Column:
    """The canonical '/section/slug' address on ``site`` of a link; null for anything else."""
    trimmed = F.trim(href)
    full = F.when(trimmed.startswith("//"), F.concat(F.lit("https:"), trimmed)).when(trimmed.startswith("/"), F.concat(F.lit(f"https://{site}"), trimmed)).otherwise(trimmed)
    parts = path_parts(full)
    good = F.lower(scheme(full)).isin("http", "https") & host(full).isin(site, *aliases) & (F.size(parts) == 2) & (F.lower(F.get(parts, F.lit(0))) == section)
    slug = F.get(parts, F.lit(1))
    if reserved:
        good = good & ~F.lower(slug).isin(*reserved)
    return F.when(good, F.concat(F.lit(f"https://{site}/{section}/"), slug))


def topic_id(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"-t(\d+)(?:-(\d+))?\.html(?:[?#]|$)", 1), F.lit("")).try_cast("bigint")


def post_offset(url: Column) -> Column:
    """The offset in a topic's address, 0 where it names none; null where it is no topic's."""
    return F.when(topic_id(url).isNotNull(), F.coalesce(F.nullif(F.regexp_extract(url, r"-t(\d+)(?:-(\d+))?\.html(?:[?#]|$)", 2), F.lit("")).try_cast("int"), F.lit(0)))


def topic_slug(url: Column) -> Column:
    return F.regexp_extract(url, r"/forum/([a-z0-9-]+)-t\d+", 1)


def topic_page_url(url: Column, offset: Column) -> Column:
    """The address of a topic's page: the offset goes before '.html', none for the first page."""
    bare = F.regexp_replace(url, r"(-t\d+)(?:-\d+)?\.html", r"$1.html")
    return F.when(offset > 0, F.replace(bare, F.lit(".html"), F.concat(F.lit("-"), offset.cast("string"), F.lit(".html")))).otherwise(bare)


def index_page_url(forum: Column, offset: Column) -> Column:
    return topic_page_url(forum, offset)


def share_url(text: Column, host_pattern: str) -> Column:
    """The first short link to a host within a text, closing punctuation dropped; null without one."""
    return F.nullif(F.regexp_replace(F.regexp_extract(text, rf"(https?://{host_pattern}/[^\s\"'<>]+)", 1), r"[.,);\]]+$", ""), F.lit(""))


def name_from_url(url: Column) -> Column:
    name = F.trim(title_case(F.replace(url_slug(base_url(url)), F.lit("-"), F.lit(" "))))
    return F.coalesce(F.nullif(name, F.lit("")), F.lit("Unknown Restaurant"))


def next_link(header: Column) -> Column:
    """The rel=next address of an HTTP Link header."""
    return F.nullif(F.regexp_extract(header, r"""(?i)<([^>]+)>\s*;[^,]*rel\s*=\s*"?next"?""", 1), F.lit(""))


def candidate_names(name: Column, area: Column, link: Column, city: str) -> Column:
    """At most four file names that a place's reviews may have, likeliest first."""
    n, a, u = (F.nullif(F.trim(F.coalesce(c, F.lit(""))), F.lit("")) for c in (name, area, link))
    options = F.array(F.concat(n, F.lit(", "), a, F.lit(f", {city}")), F.concat(n, F.lit(", "), a), n, F.when(u.isNotNull(), name_from_url(u)))
    return F.transform(F.filter(options, lambda o: o.isNotNull()), lambda o: sanitize_file_name(o))
