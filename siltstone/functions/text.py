"""Text, number and size expressions; every one is a column that Catalyst sees through."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: White space as Unicode has it, for Java's patterns.
SPACE = r"(?U)\s+"


def slugify(text: Column) -> Column:
    """Lower case; runs of anything but a-z and 0-9 become one hyphen, none at the ends. Null gives ''."""
    dashed = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", "-")
    return F.regexp_replace(dashed, "^-+|-+$", "")


def word_list(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Words between white space; 0 for null and blank texts."""
    return F.size(word_list(text)).cast("int")


def char_count(text: Column) -> Column:
    """Code points; 0 for null."""
    return F.length(F.coalesce(text, F.lit(""))).cast("int")


def first_int(text: Column) -> Column:
    """The first run of digits as a number; a thousands' comma ends it."""
    return F.regexp_substr(text, F.lit(r"\d+")).try_cast("bigint")


def declared_total(text: Column, noun: str) -> Column:
    """The number before ``noun`` ('2,776 topics'), in any case, commas dropped; null if there is none."""
    found = F.regexp_extract(text, rf"(?i)([\d,]+)\s+{noun}\b", 1)
    return F.regexp_replace(found, ",", "").try_cast("bigint")


def declared_pages(html: Column) -> Column:
    """The last page of 'Page 1 of 112', with or without bold marks."""
    marked = F.regexp_extract(html, r"(?i)Page\s*<strong>\s*\d+\s*</strong>\s*of\s*<strong>\s*(\d+)\s*</strong>", 1)
    plain = F.regexp_extract(html, r"(?i)Page\s+\d+\s+of\s+(\d+)", 1)
    return F.coalesce(F.nullif(marked, F.lit("")), F.nullif(plain, F.lit(""))).try_cast("bigint")


def declared_in_brackets(text: Column, label: str) -> Column:
    """The number of 'Types (144)'."""
    return F.regexp_replace(F.regexp_extract(text, rf"(?i){label}\s*\(([\d,]+)\)", 1), ",", "").try_cast("bigint")


def extract_year(text: Column) -> Column:
    """The first four-digit number from 1900 to 2099 that stands alone; null unless it lies in 1950 to 2100."""
    year = F.regexp_substr(text, F.lit(r"\b(?:19\d{2}|20\d{2})\b")).try_cast("int")
    return F.when(year.between(1950, 2100), year)


def extract_age(text: Column) -> Column:
    """The first number of one to three digits that stands alone; null unless it lies in 1 to 110."""
    age = F.regexp_substr(text, F.lit(r"\b\d{1,3}\b")).try_cast("int")
    return F.when(age.between(1, 110), age)


def to_number(text: Column) -> Column:
    """A double, or null where the text is no number."""
    return F.trim(text.cast("string")).try_cast("double")


def tokens(slug: Column) -> Column:
    """The different parts of a slug that are longer than two characters."""
    return F.array_distinct(F.filter(F.split(slug, "-"), lambda t: F.length(t) > 2))


def slug_score(a: Column, b: Column) -> Column:
    """1 for equal slugs, 0.92 if one holds the other, else the Jaccard similarity of their tokens; 0 if one is empty."""
    x, y = tokens(a), tokens(b)
    either = F.size(F.array_union(x, y))
    shared = F.when((F.size(x) > 0) & (F.size(y) > 0), F.size(F.array_intersect(x, y)) / either).otherwise(0.0)
    return F.when((F.coalesce(a, F.lit("")) == "") | (F.coalesce(b, F.lit("")) == ""), 0.0).when(a == b, 1.0).when(a.contains(b) | b.contains(a), 0.92).otherwise(shared)


def sanitize_file_name(name: Column, fallback: str = "Unknown Restaurant") -> Column:
    clean = F.trim(F.regexp_replace(F.coalesce(name, F.lit("")), r'[<>:"/\\|?*]', ""))
    return F.coalesce(F.nullif(clean, F.lit("")), F.lit(fallback))


def title_to_name(title: Column, fallback: str = "Unknown Restaurant") -> Column:
    """What a page title says before 'User Reviews' or a bar, without 'Reviews of '."""
    whole = F.trim(F.coalesce(title, F.lit("")))
    cut = F.when(whole.contains("User Reviews"), F.regexp_replace(F.substring_index(whole, "User Reviews", 1), r"^[ \-|]+|[ \-|]+$", "")).when(whole.contains("|"), F.trim(F.substring_index(whole, "|", 1))).otherwise(whole)
    return sanitize_file_name(F.when(F.lower(cut).startswith("reviews of "), F.trim(F.substr(cut, F.lit(12)))).otherwise(cut), fallback)


def title_case(text: Column) -> Column:
    """Capitals after everything but letters, as in O'Neil and 3Rd."""
    letters = F.split(F.lower(text), "")
    upper = F.transform(letters, lambda c, i: F.when((i == 0) | ~F.coalesce(F.get(letters, i - 1), F.lit(" ")).rlike(r"^\p{L}$"), F.upper(c)).otherwise(c))
    return F.array_join(upper, "")


def truncate(text: Column, most: int) -> Column:
    """One line, cut after ``most`` characters with an ellipsis."""
    flat = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\r?\n|\r", " "))
    return F.when(F.length(flat) > most, F.concat(F.left(flat, F.lit(most)), F.lit("…"))).otherwise(flat)


def first_line(text: Column, most: int = 120) -> Column:
    return F.left(F.substring_index(text, "\n", 1), F.lit(most))


def unescape_references(text: Column) -> Column:
    """The commonest character references decoded; '&amp;' last, so that none is decoded twice."""
    for name, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def strip_tags(html: Column) -> Column:
    """Tags become spaces; the commonest references and non-breaking spaces are decoded. ``unescape_html`` decodes all."""
    text = unescape_references(F.regexp_replace(F.coalesce(html, F.lit("")), "<[^>]+>", " "))
    return F.trim(F.replace(text, F.lit(" "), F.lit(" ")))


@F.pandas_udf(StringType())
def unescape_html(texts):
    """All character references, by the standard library's table (no built-in function has it)."""
    import html

    return texts.map(lambda t: None if t is None else html.unescape(t))


def escape_html(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(char), F.lit(name))
    return out


def escape_template(text: str) -> str:
    """For a JavaScript template literal."""
    return text.replace("\\", "\\\\").replace("`", "\\`").replace("${", "\\${")


def format_bytes(n: float) -> str:
    for unit in ("B", "KB", "MB", "GB"):
        if n < 1024:
            return f"{n:.2f} {unit}"
        n /= 1024
    return f"{n:.2f} TB"


def percentage(part: Column, whole: Column, digits: int = 1) -> Column:
    """A share in percent; of nothing it is 0."""
    return F.round(100 * part / F.greatest(whole, F.lit(1)), digits)
