"""End-to-end plans: forum, reviews, catalogue. Each is one lazy plan; boundaries between scripts become shuffles or nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions import classify, dates, jsons, text, urls
from siltstone.operators import dedupe, joins, pages, project

#: The order of columns in cleaned and combined tables.
POST_COLUMNS = "topic_id post_id post_offset page_index position_in_topic is_first_post title author author_profile_url author_name_meta author_who author_dx_when_raw author_dx_year author_age_at_dx_raw author_age_at_dx posted_at posted_at_iso posted_date posted_year posted_month body_text body_word_count body_char_count body_html attachment_urls_json author_meta_json page_url".split()
TOPIC_COLUMNS = "topic_id slug url title starter_author starter_profile_url start_date start_date_iso start_year replies views expected_post_count actual_post_count count_delta last_post_author last_post_profile_url last_post_date last_post_date_iso last_post_link has_attachment".split()


def clean_posts(posts: DataFrame) -> DataFrame:
    """Each post of a topic once (its first place), with dates, profile fields and sizes."""
    first = dedupe.keep_first(posts, ["topic_id", "post_id"], ["post_offset", "position_in_topic"])
    meta = {column: jsons.profile_field(F.col("author_meta_json"), label) for label, column in jsons.PROFILE.items()}
    with_meta = first.withColumns(meta | {"posted_at_iso": dates.forum_date(F.col("posted_at"))})
    derived = {
        "author_dx_year": text.extract_year(F.col("author_dx_when_raw")),
        "author_age_at_dx": text.extract_age(F.col("author_age_at_dx_raw")),
        "posted_date": dates.day(F.col("posted_at_iso")),
        "posted_year": F.year("posted_at_iso"),
        "posted_month": dates.month(F.col("posted_at_iso")),
        "body_word_count": text.word_count(F.col("body_text")),
        "body_char_count": text.char_count(F.col("body_text")),
        "is_first_post": F.col("position_in_topic") == 0,
    }
    return project.ordered(with_meta.withColumns(derived), POST_COLUMNS)


def clean_topics(topics: DataFrame, posts: DataFrame) -> DataFrame:
    """Topics with dates and the posts expected and found."""
    counted = joins.lookup_count(topics, posts, "topic_id", "topic_id", "actual_post_count")
    with_dates = counted.withColumns({"start_date_iso": dates.forum_date(F.col("start_date")), "last_post_date_iso": dates.forum_date(F.col("last_post_date")), "expected_post_count": F.col("replies") + 1})
    return project.ordered(with_dates.withColumns({"start_year": F.year("start_date_iso"), "count_delta": F.col("actual_post_count") - F.col("expected_post_count")}), TOPIC_COLUMNS)


def posts_with_topics(posts: DataFrame, topics: DataFrame) -> DataFrame:
    """Posts of all forums with their topic's columns (named topic_...); 'matched' tells posts without topic."""
    keys = ["forum_slug", "topic_id"]
    named = project.prefixed(topics, "topic_", keys)
    return joins.many_to_one(posts.withColumnRenamed("title", "post_title"), named, keys)


def forum(raw_pages: DataFrame, base: str) -> DataFrame:
    """Posts from cached topic pages (topic_id, post_offset, html), with page and place."""
    rows = pages.topic_pages(raw_pages, "html", base, ["topic_id", "post_offset"])
    placed = rows.withColumns({"page_index": dedupe.page_index(["topic_id"], "post_offset"), "position_in_topic": F.col("post_offset") + F.col("position_on_page")})
    return placed.withColumns({"author_meta_json": F.when(F.size("author_meta") > 0, F.to_json("author_meta")).otherwise(""), "attachment_urls_json": F.when(F.size("attachment_urls") > 0, F.to_json("attachment_urls")).otherwise("")}).drop("author_meta", "attachment_urls", "position_on_page")


def canonical_reviews(base: DataFrame, rescraped: DataFrame) -> DataFrame:
    """Both sources; a rescraped review replaces the base's of the same address. Repeats within one source stay."""
    return joins.override(base, rescraped, "Review URL")


def coverage_report(master: DataFrame, files: DataFrame, completed: DataFrame, city: str, threshold: float = 0.55) -> DataFrame:
    """Per restaurant of a master list: its review file (by candidate names, else by the best slug), reviews and status.

    master: id, area_found, restaurant_name, master_rating, cuisine, price, link; files: review_csv_file (stem), review_count;
    completed: normalized_url.
    """
    rows = master.withColumns({"normalized_url": urls.base_url(F.col("link")), "url_type": classify.listing_type(F.col("link"))})
    rows = rows.withColumns({"url_slug": urls.url_slug(F.col("normalized_url")), "candidates": urls.candidate_names(F.col("restaurant_name"), F.col("area_found"), F.col("link"), city)})
    rows = joins.with_flag(rows, completed, "normalized_url", "in_completed_log", "yes", "no")
    slugged = files.withColumn("name", text.slugify(F.col("review_csv_file")))
    by_name = joins.by_priority(rows.withColumn("candidates", F.transform("candidates", text.slugify)), "id", "candidates", slugged, "name", "review_csv_file")
    exact = by_name.filter("review_csv_file is not null").withColumn("score", F.lit(1.0))
    open_ = by_name.filter("review_csv_file is null").drop("review_csv_file")
    fuzzy = joins.fuzzy_slugs(open_, "id", "url_slug", slugged, "review_csv_file", "name", threshold)
    found = exact.unionByName(open_.join(fuzzy, "id", "left")).join(files.select("review_csv_file", "review_count"), "review_csv_file", "left")
    status = classify.coverage_status(F.col("url_type"), F.col("in_completed_log") == "yes", F.col("review_csv_file").isNotNull(), F.col("review_count"))
    return found.select("id", "area_found", "restaurant_name", "master_rating", "cuisine", "price", "link", "normalized_url", "url_slug", "url_type", "in_completed_log", F.coalesce("review_csv_file", F.lit("")).alias("review_csv_file"), F.coalesce(F.when(F.col("score").isNotNull(), F.format_string("%.2f", "score")), F.lit("")).alias("match_score"), F.coalesce("review_count", F.lit(0)).alias("review_count"), status.alias("coverage_status"))


def review_signals(reviews: DataFrame, description: Column) -> DataFrame:
    """Effort, fired triggers and length of each review's text."""
    fired = classify.triggers(description)
    contrast = F.when(classify.contrasts_dishes(description), F.array(F.lit("cross_dish_consistency_signal"))).otherwise(F.array().cast("array<string>"))
    return reviews.withColumns({"review_effort_signal": classify.review_effort(description), "t2_triggers_fired": F.array_sort(F.concat(fired, contrast)), "description_len": text.char_count(description)})


def catalogue_urls(found: DataFrame, site: str, url: str = "loc") -> DataFrame:
    """The catalogue's addresses: on the site, allowed, normalised, each once, sorted."""
    own = found.filter(urls.on_host(F.col(url), site) & urls.allowed(F.col(url)))
    return project.distinct_sorted(own.select(urls.absolute(F.col(url), site).alias("url")), "url")


def catalogue_profile(listed: DataFrame, url: str = "url") -> DataFrame:
    return listed.groupBy(classify.catalogue_class(F.col(url)).alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct(url).alias("different"))
