"""Deterministic classifiers, each one CASE chain over columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.functions.text import word_count
from siltstone.functions.urls import path, path_parts

#: Patterns of short reviews that dismiss or engage.
DISMISSIVE = r"(?iU)^(great|good|nice|awesome|amazing|best|perfect|ok|okay|fine|bad|worst|terrible|horrible|loved it|hated it|must visit|must try|not good|don't go|do not go|never again|5/5|4/5|3/5|2/5|1/5)[\s!.]*$"
ENGAGED = r"(?iU)\b(dal|biryani|dosa|idli|paneer|chicken|fish|mutton|thali|coffee|ambience|ambiance|service|staff|wait|bill|price|portion|crispy|spicy|home|nostalg|surpris|disappoint|rude|slow|crowd|noise|birthday|date|family|friends|anniversary)\b"

#: Words that call for a field of the extraction.
TRIGGERS = {
    "alcohol_consumed_this_visit": r"\b(beer|wine|cocktail|whisky|whiskey|vodka|rum|gin|peg|shot|shots|sundowner|bar|drink|drinks|tipsy|drunk|buzzed|high on)\b",
    "ordering_risk_tolerance": r"\b(first time|never tried|always order|my regular|usual order|stick to|adventur|experiment|try something new|something different)\b",
    "sensory_load": r"\b(overwhelm|overwhelming|calming|calm atmosphere|stimulat|exhausting|peaceful|chaotic|sensory)\b",
    "social_override_signal": r"\b(company made|friends made|had so much fun|great time despite|wouldn't come for food alone|would not come for food alone|atmosphere of the place|vibe was great)\b",
    "delayed_dissatisfaction_signal": r"\b(food was great but|enjoyed until|would have been perfect if|good but the service|good but service|loved the food but)\b",
    "satisfaction_attribution": r"\b(because of the company|company made it|ambience made it|food was the star|atmosphere made|price made it|value made)\b",
    "emotional_aftertaste": r"\b(left feeling|went home feeling|still feel|came away feeling|days later|felt heavy|felt light|felt drained|felt energized)\b",
    "recovery_quality": r"\b(needed this|decompression|recharged|draining|exhausted after|restorative|wind down|stress relief)\b",
    "dish_function": r"\b(go-to|go to|like home|comfort food|comfort meal|signature dish|had to try|for the photo|instagram|show off|impress)\b",
    "delivery_quality_signal": r"\b(delivery|delivered|packaging|leaked|soggy|cold when|held well|in transit|zomato order|swiggy)\b",
    "alcohol_identity_signal": r"\b(craft beer|cocktail bar|wine list|whisky|nightlife|after work drinks|sundowner|pub|brewery)\b",
    "bar_quality_signal": r"\b(bar|cocktail|drinks menu|bartender|happy hour|peg|pitcher)\b",
    "visit_day": r"\b(weekend|weekday|monday|tuesday|wednesday|thursday|friday|saturday|sunday)\b",
    "review_language": "[ऀ-ॿಀ-೿஀-௿]",
}
#: By field the longest run of letters of each of its words: a text without any of these runs has none of the words.
RUNS = {n: sorted({max(re.findall("[a-z]+", word), key=len) for word in p.removeprefix(r"\b(").removesuffix(r")\b").split("|")}) for n, p in TRIGGERS.items() if p.startswith(r"\b")}
DISHES = r"(?U)\b(biryani|dosa|idli|paneer|chicken|mutton|fish|thali|pizza|pasta|burger|roll|momos|noodles|curry|dal|roti|naan|dessert|starter|main|appetizer)\b"
CONTRAST = r"(?U)\b(but|however|whereas|while|unlike|except|only the|rest was)\b"


def review_effort(text: Column) -> Column:
    """One of five classes, by length, sentences and words."""
    raw = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)^\s+|\s+$", "")
    words = word_count(raw)
    sentences = F.size(F.filter(F.split(raw, r"[.!?]+"), lambda s: s.rlike(r"(?U)\S")))
    engaged = F.lower(raw).rlike(ENGAGED)
    return (
        F.when(~raw.rlike(r"(?U)\w"), "one_liner")
        .when((words >= 80) | (sentences >= 4) | (F.length(raw) >= 400), "high_effort_structured")
        .when((words >= 25) | (sentences >= 2), "medium_effort")
        .when((words <= 8) & F.lower(raw).rlike(DISMISSIVE), "low_effort_emotional_DISMISSIVE")
        .when(engaged, "low_effort_emotional_ENGAGED")
        .when(words <= 3, "one_liner")
        .when(words <= 8, "low_effort_emotional_DISMISSIVE")
        .otherwise("medium_effort")
    )


def triggers(text: Column, extra: Column | None = None) -> Column:
    """Sorted names of the fields whose words occur, with ``extra`` names. Words are looked for only where a run of their letters occurs."""
    raw = F.coalesce(text, F.lit(""))
    runs = F.array_distinct(F.split(F.translate(F.lower(raw), "ſ", "s"), "[^a-z]+"))  # the long s counts as an s where case doesn't

    def found(own: Column) -> Column:
        there = {n: F.arrays_overlap(own, F.array(*map(F.lit, keys))) for n, keys in RUNS.items()}
        tests = {n: raw.rlike(f"(?iuU){p}") for n, p in TRIGGERS.items()}
        return F.array_compact(F.array(*[F.when(F.when(there[n], test) if n in there else test, n) for n, test in tests.items()]))

    # Bound once by the transform, the runs are not made again for each field.
    fired = F.get(F.transform(F.array(runs), found), F.lit(0))
    return F.array_sort(F.array_distinct(F.concat(fired, extra) if extra is not None else fired))


def contrasts_dishes(text: Column) -> Column:
    """Two dishes at least, and a word that sets them against each other."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return (F.regexp_count(low, F.lit(DISHES)) >= 2) & low.rlike(CONTRAST)


def catalogue_class(url: Column) -> Column:
    """What an address of the drug catalogue shows, for counting."""
    parts = path_parts(url)
    head, two = F.get(parts, F.lit(0)), F.size(parts) == 2
    return (
        F.when(F.size(parts) == 0, "other")
        .when(two & (head == "drugs"), "drug_page")
        .when(two & (head == "generics"), "generic_page")
        .when(two & (head == "otc"), "otc_page")
        .when(two & (head == "drug-store"), "drug_store_page")
        .when(head.startswith("drugs-"), "drugs_listing")
        .when(head == "drugs", "drugs_other")
        .otherwise(F.replace(head, F.lit("-"), F.lit("_")))
    )


def crawl_kind(url: Column) -> Column:
    """What an address of the drug catalogue shows, for crawling ('/drugs/' pages are 'misc' here)."""
    p = path(url)
    starts = lambda *prefixes: p.rlike("^(?:" + "|".join(prefixes) + ")")
    return (
        F.when(starts("/otc/", "/drug-store/"), "product")
        .when(starts("/generics/"), "generic")
        .when(starts("/categories/", "/drugs-therapeutic-classes") | (p == "/drugs-all-medicines"), "category")
        .when(starts("/marketer/"), "marketer")
        .when(starts("/labs/"), "lab")
        .when(starts("/doctors/"), "doctor")
        .otherwise("misc")
    )


def listing_type(link: Column) -> Column:
    low = F.lower(F.coalesce(link, F.lit("")))
    return (
        F.when(low.contains("/delivery/dish-") | low.contains("/delivery/dish/"), "delivery_dish")
        .when(low.endswith("/order") | low.contains("/order?"), "order")
        .when(low.endswith("/info") | low.contains("/info?"), "info")
        .when(low.contains("/delivery/"), "delivery_other")
        .otherwise("other")
    )


def coverage_status(url_type: Column, done: Column, matched: Column, reviews: Column) -> Column:
    return (
        F.when(url_type == "delivery_dish", "bad_url_delivery_dish")
        .when(~done, "not_processed")
        .when(~matched, "processed_no_csv_match")
        .when(reviews < 0, "csv_read_error")
        .when(reviews == 0, "no_dining_reviews")
        .otherwise("has_reviews")
    )


def rescrape_outcome(before: Column, after: Column, failed: Column) -> Column:
    return (
        F.when(failed, "error")
        .when((before <= 0) & (after > 0), "gained_reviews")
        .when(after > before, "more_reviews")
        .when(after <= 0, "still_empty")
        .otherwise("unchanged")
    )


def fetch_status(state: Column, not_found: Column | None = None, info: Column | None = None, sku: Column | None = None) -> Column:
    """Of a drug page's state (JSON text): what it lacks, or 'ok'. Parts that are read already need not be read again."""
    at = lambda known, p: F.get_json_object(state, p) if known is None else known
    is_object = lambda value: F.coalesce(value.startswith("{"), F.lit(False))
    return (
        F.when(state.isNull(), "no_preloaded_state")
        .when(~state.startswith("{"), "parse_error")
        .when(F.coalesce(at(not_found, "$.drugPage.drugNotFound"), F.lit("")).isin("true", "1"), "drug_not_found")
        .when(~is_object(at(info, "$.drugPage.drugInfo")), "no_drug_info")
        .when(~is_object(at(sku, "$.drugPage.drugInfo.sku")), "no_sku")
        .otherwise("ok")
    )


def failure_mode(kind: Column) -> Column:
    return F.when(kind == "enum", "enum_violation").when(kind == "model_type", "shape_error").when(kind == "missing", "missing_required").otherwise("other_validation")


def rating_bucket(rating: Column) -> Column:
    return F.when(rating.isNull() | F.isnan(rating.cast("double")), "?").when(rating <= 1.5, "1").when(rating <= 2.5, "2").when(rating <= 3.5, "3").when(rating <= 4.5, "4").otherwise("5")


def rating_tone(rating: Column) -> Column:
    return F.when(rating.isNull(), "neutral").when(rating >= 4, "good").when(rating >= 3, "neutral").otherwise("bad")


def mapped(value: Column, names: dict[str, str], default: str) -> Column:
    """A value's tone (or any label) by a table."""
    pairs = [F.lit(x) for kv in names.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value) if pairs else F.lit(None), F.lit(default))
