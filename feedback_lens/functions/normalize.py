"""Field normalisation for extracted reviews: ratings, votes, dates, comments, names, tags."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import StringType

from feedback_lens.functions.markup import references

# Accepted date layouts, tried in order.
DATE_FORMATS = ("yyyy-MM-dd", "MMMM d yyyy", "MMM d yyyy", "d MMMM yyyy", "d MMM yyyy", "M/d/yyyy")


def parse_rating(col: Column, source: str | None = None) -> Column:
    """Rating text to number.

    ``"4.0 out of 5 stars"`` and ``"Rating: 4 out of 5 stars"`` by pattern; Walmart's alt text holds the star count
    as its 17th character.
    """
    if source == "Walmart":
        return F.substring(col, 17, 1).try_cast("double")
    return F.regexp_extract(col, r"([0-9]+(?:\.[0-9]+)?) out of 5 stars", 1).try_cast("double")


def parse_usefulness(col: Column) -> Column:
    """Helpful-vote text to a count: ``1,204 people …`` is 1204, ``One person …`` is 1, nothing is 0."""
    count = F.regexp_replace(col, r" (?:people|person) found this helpful", "")
    count = F.replace(F.replace(count, F.lit(","), F.lit("")), F.lit("One"), F.lit("1"))
    return F.coalesce(F.trim(count).try_cast("int"), F.lit(0))


def parse_date(col: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First declared layout that fits; a leading ``on`` and commas are dropped. Null when none fits."""
    text = F.trim(F.replace(F.regexp_replace(F.trim(col), "^on ", ""), F.lit(","), F.lit("")))
    return F.coalesce(*[F.try_to_date(text, fmt) for fmt in formats])


def parse_relative_date(col: Column, as_of: Column) -> Column:
    """``"2 months ago"`` counted back from ``as_of`` (the crawl date); units below a day count whole days only."""
    pattern = r"([0-9]+) (year|month|week|day|hour|minute|second)s? ago"
    amount = F.regexp_extract(col, pattern, 1).try_cast("int")
    unit = F.regexp_extract(col, pattern, 2)
    months = F.when(unit == "year", amount * 12).when(unit == "month", amount)
    days = F.when(unit == "week", amount * 7).when(unit == "day", amount)
    for name, per_day in (("hour", 24), ("minute", 24 * 60), ("second", 24 * 3600)):
        days = days.when(unit == name, F.floor(amount / per_day).cast("int"))
    return F.coalesce(F.add_months(as_of, -months), F.date_sub(as_of, days))


def render_date(col: Column) -> Column:
    return F.date_format(col, "MMMM dd, yyyy")


def year_quarter(col: Column) -> Column:
    """``2017Q3`` form of a date."""
    return F.concat(F.year(col).cast("string"), F.lit("Q"), F.quarter(col).cast("string"))


def compose_comment(title: Column, body: Column, source: str | None = None) -> Column:
    """One comment out of title and body, in the layout each shop's reviews use."""
    if source == "Walmart":
        body = F.replace(F.replace(body, F.lit("\n"), F.lit("")), F.lit(","), F.lit("/"))
        return F.concat(F.replace(title, F.lit(","), F.lit("/")), body)
    if source == "Best Buy":
        return F.replace(body, F.lit("\n\n"), F.lit(""))
    return F.concat(title, F.lit(" "), body)


def clean_name(col: Column, drop_commas: bool = False) -> Column:
    name = F.trim(F.replace(col, F.lit("\n"), F.lit("")))
    return F.replace(name, F.lit(","), F.lit("")) if drop_commas else name


def brand_from_name(col: Column) -> Column:
    return F.trim(F.split(col, "-")[0])


@arrow_udf(StringType())
def _unescaped(texts: pa.Array) -> pa.Array:
    return pa.array([None if text is None else references(text) for text in texts.to_pylist()], pa.string())


def decode_entities(col: Column) -> Column:
    """Character references of the HTML standard, each decoded once: all names, with or without their semicolon, and numbers.

    A name without semicolon is the longest one that fits; what is no reference stays as it is.
    """
    return _unescaped(col)


def strip_tags(col: Column) -> Column:
    """Text of an element: tags out, entities decoded."""
    return decode_entities(F.regexp_replace(col, "<[^>]*>", ""))


def with_source(df: DataFrame, name: str) -> DataFrame:
    """Tag rows with their shop; shops without vote counts get 0."""
    votes = F.col("usefulness") if "usefulness" in df.columns else F.lit(None)
    return df.withColumn("source", F.lit(name)).withColumn("usefulness", F.coalesce(votes.cast("int"), F.lit(0)))
