"""Stored shop pages to one typed review table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from feedback_lens.functions.markup import Element, Path, path
from feedback_lens.functions.normalize import (
    brand_from_name,
    clean_name,
    compose_comment,
    parse_date,
    parse_rating,
    parse_relative_date,
    parse_usefulness,
    with_source,
)
from feedback_lens.operators.pages import attach_brand, extract_keys, last_page, read_blocks, read_lists, valid_rows
from feedback_lens.operators.segments import conform
from feedback_lens.session import written


@dataclass(frozen=True)
class ShopProfile:
    """Where a shop's pages hold what: elements and patterns only, so a new shop is a new profile."""

    name: str
    values: Mapping[str, Path]
    fields: Mapping[str, Path]
    block: Path | None = None
    driver: str | None = None
    key_pattern: str = ""
    page_number: str = ""
    brand: Path | None = None


# Markup of the three shops.
AMAZON = ShopProfile(
    name="Amazon",
    key_pattern=r'<li[^>]*data-asin="([^"]*)"',
    page_number=r'<li class="page-button"[^>]*>(?:<[^>]*>)*([0-9]+)',
    values={"name": path(Element("span", "id", "productTitle")), "brand": path(Element("a", "id", "bylineInfo"))},
    block=path(Element("div", "data-hook", "review")),
    fields={
        "rating_text": path(Element("i", "data-hook", "review-star-rating")),
        "title": path(Element("a", "data-hook", "review-title")),
        "date_text": path(Element("span", "data-hook", "review-date")),
        "body": path(Element("span", "data-hook", "review-body")),
        "votes": path(Element("span", "class", word="cr-vote-text")),
    },
)
BEST_BUY = ShopProfile(
    name="Best Buy",
    key_pattern=r'<h4[^>]*class="sku-header"[^>]*>[^<]*<a[^>]*href="([^"]*)"',
    values={"name": path(Element("h2", "class", "product-title"))},
    block=path(Element("div", "class", "col-xs-12 col-md-9")),
    fields={
        "rating_text": path(Element("p", "class", "sr-only")),
        "date_text": path(Element("time", "class", "submission-date")),
        "body": path(Element("p", "class", "pre-white-space")),
    },
)
WALMART = ShopProfile(
    name="Walmart",
    key_pattern=r'<a[^>]*class="product-title-link[^"]*"[^>]*href="([^"]*)"',
    page_number=r'aria-label="[^"]*?([0-9]+) [^" ]*"',
    values={"name": path(Element("div", "class", "product-summary-wrapper"), Element("h1"))},
    brand=path(Element("span", "itemprop", "brand")),
    driver="rating_text",
    fields={
        "title": path(Element("div", "itemprop", "name")),
        "rating_text": path(Element("div", "class", "stars stars-small"), Element("span", "alt"), take="alt"),
        "body": path(Element("div", "class", "review-body-text")),
        "date_text": path(Element("span", "itemprop", "datePublished")),
    },
)

REQUIRED = ("name", "rating", "comment", "date", "brand")


def _typed(df: DataFrame, profile: ShopProfile, as_of: Column | None) -> DataFrame:
    title = F.col("title") if "title" in df.columns else F.lit("")
    date = parse_date(F.col("date_text"))
    if as_of is not None:
        date = F.coalesce(date, parse_relative_date(F.col("date_text"), as_of))
    typed = df.withColumns(
        {
            "name": clean_name(F.col("name"), drop_commas=profile.name == "Walmart"),
            "rating": parse_rating(F.col("rating_text"), profile.name),
            "comment": compose_comment(title, F.col("body"), profile.name),
            "date": date,
        }
    )
    if "votes" in df.columns:
        typed = typed.withColumn("usefulness", parse_usefulness(F.col("votes")))
    return with_source(typed, profile.name)


def _shop_rows(
    pages: DataFrame, profile: ShopProfile, as_of: Column | None = None, product_pages: DataFrame | None = None
) -> DataFrame:
    """Every review found on the pages, typed, malformed ones included."""
    keep = ["page_id", "key"]
    if profile.block is not None:
        rows = read_blocks(pages, profile.block, profile.fields, keep, profile.values)
    else:
        rows = read_lists(pages, profile.fields, profile.driver, keep, profile.values)
    rows = rows.withColumns({name: F.nullif(F.trim(name), F.lit("")) for name in profile.values})
    rows = _typed(rows, profile, as_of)
    if profile.brand is not None and product_pages is not None:
        rows = attach_brand(rows, product_pages, profile.brand)
    elif "brand" not in profile.values:
        rows = rows.withColumn("brand", brand_from_name(F.col("name")))
    return rows.withColumn("review_id", F.xxhash64(F.lit(profile.name), "page_id", "pos"))


def shop_reviews(
    pages: DataFrame,
    profile: ShopProfile,
    as_of: Column | None = None,
    product_pages: DataFrame | None = None,
    rejects: Observation | None = None,
) -> DataFrame:
    """Reviews of one shop's stored pages ``(page_id, key, html)``, typed and without malformed rows.

    Every step works on one page or one review, so the only shuffle is the optional brand lookup.
    """
    return conform(valid_rows(_shop_rows(pages, profile, as_of, product_pages), REQUIRED, rejects))


@dataclass(frozen=True)
class ShopJob:
    """What a shop's job leaves: reviews ``REVIEW`` and what became of everything on the way ``(step, n)``."""

    reviews: DataFrame
    counts: DataFrame


def _long(df: DataFrame) -> DataFrame:
    """One row of counts as rows ``(step, n)``; sums over nothing are 0."""
    named = [F.struct(F.lit(c).alias("step"), F.coalesce(F.col(c), F.lit(0)).cast("long").alias("n")) for c in df.columns]
    return df.select(F.inline(F.array(*named)))


def shop_job(
    search_pages: DataFrame,
    product_pages: DataFrame,
    review_pages: DataFrame,
    profile: ShopProfile,
    dead_marker: str,
    as_of: Column | None = None,
) -> ShopJob:
    """From stored search pages to reviews: keys, dead products left out, review pages of live products read.

    The state of every key and the rows found are written once, and the counts come from these tables, so a task that runs twice counts
    once. Pages travel to no other task if the live keys are small enough for the optimiser to send them round.
    """
    found = extract_keys(search_pages, profile.key_pattern).groupBy("key").agg(F.count(F.lit(1)).alias("times"))
    dead = product_pages.filter(F.contains("html", F.lit(dead_marker))).select("key", F.lit(True).alias("dead")).distinct()
    stored = review_pages.filter("key IS NOT NULL").groupBy("key").agg(F.count(F.lit(1)).alias("pages"))
    states = found.join(stored, "key", "full").join(dead, "key", "left")
    if profile.page_number:
        states = states.join(last_page(review_pages, profile.page_number), "key", "left")
    else:
        states = states.withColumn("last_page", F.lit(None).cast("int"))
    states = states.select(
        "key",
        F.coalesce("times", F.lit(0)).alias("times"),
        F.coalesce("pages", F.lit(0)).alias("pages"),
        F.coalesce("dead", F.lit(False)).alias("dead"),
        "last_page",
    )
    states = written(states).df
    listed, live = F.col("times") > 0, (F.col("times") > 0) & ~F.col("dead")
    rows = _shop_rows(review_pages.join(states.filter(live).select("key"), "key", "left_semi"), profile, as_of, product_pages)
    good = F.lit(True)
    for name in REQUIRED:
        good = good & F.col(name).isNotNull()
    rows = rows.withColumn("good", good)
    rows = written(conform(rows, "good")).df
    keys = states.agg(
        F.sum("times").alias("keys_found"),
        F.count_if(listed).alias("keys_distinct"),
        F.count_if(listed & F.col("dead")).alias("keys_dead"),
        F.count_if(live & (F.col("pages") == 0)).alias("keys_without_pages"),
        F.count_if(live & (F.col("pages") > 0) & (F.col("pages") < F.col("last_page"))).alias("keys_with_missing_pages"),
        F.sum(F.when(live, F.col("pages"))).alias("pages_read"),
        F.sum(F.when(~live, F.col("pages"))).alias("pages_left_out"),
    )
    reviews = rows.agg(
        F.count(F.lit(1)).alias("reviews_seen"), F.count_if(~F.col("good")).alias("reviews_rejected"), F.count_if("good").alias("reviews_kept")
    )
    return ShopJob(rows.filter("good").drop("good"), _long(keys).unionByName(_long(reviews)))
