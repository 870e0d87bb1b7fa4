"""Filters, polarity, segment size gates, unions and dimension joins on the review table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedback_lens.functions.normalize import year_quarter
from feedback_lens.schema import REPORT_SEGMENT, REVIEW


def with_quarter(df: DataFrame) -> DataFrame:
    return df.withColumn("year_quarter", year_quarter(F.col("date")))


def filter_years(df: DataFrame, years: Sequence[int | str]) -> DataFrame:
    """Keep the listed years as date ranges on the raw column, which the parquet scan can skip by."""
    ranges = [
        (F.col("date") >= F.make_date(F.lit(y), F.lit(1), F.lit(1)))
        & (F.col("date") < F.make_date(F.lit(y + 1), F.lit(1), F.lit(1)))
        for y in sorted({int(y) for y in years})
    ]
    return df.filter(reduce(lambda a, b: a | b, ranges, F.lit(False)))


def polarity(df: DataFrame, mode: str = "wide") -> DataFrame:
    """``review_type``: ratings 4–5 against 1–2 (``wide``) or 5 against 1 (``strict``); the rest is dropped."""
    positive, negative = {"wide": ([4, 5], [1, 2]), "strict": ([5], [1])}[mode]
    rated = df.filter(F.col("rating").isin([float(r) for r in positive + negative]))
    kind = F.when(F.col("rating").isin([float(r) for r in positive]), "positive").otherwise("negative")
    return rated.withColumn("review_type", kind)


def segment_sizes(df: DataFrame, keys: Sequence[str] = REPORT_SEGMENT) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_reviews"))


def min_segment(df: DataFrame, keys: Sequence[str] = REPORT_SEGMENT, n: int = 10) -> DataFrame:
    """Rows of segments with at least ``n`` rows.

    Counts are taken with partial aggregation and joined back, so no segment is ever gathered in one task.
    """
    large = segment_sizes(df, keys).filter(F.col("n_reviews") >= n).select(*keys)
    return df.join(large, list(keys), "left_semi")


def skipped_segments(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Segments that ``min_segment`` leaves out, for the run report."""
    return segment_sizes(df, keys).filter(F.col("n_reviews") < n)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def conform(df: DataFrame, *more: str) -> DataFrame:
    """Review columns with their declared types; absent ones become null, unknown ones are left out unless named in ``more``."""
    columns = [
        (F.col(f.name) if f.name in df.columns else F.lit(None)).try_cast(f.dataType).alias(f.name)
        for f in REVIEW.fields
    ]
    return df.select(*columns, *more)


def union_reviews(*dfs: DataFrame) -> DataFrame:
    """Union of whatever sources are given, aligned by name after casts."""
    return reduce(lambda a, b: a.unionByName(b), [conform(df) for df in dfs])


def attach_company(df: DataFrame, companies: DataFrame) -> DataFrame:
    """Company of each brand, null when the brand is not listed."""
    return df.drop("company").join(companies.select("brand", "company"), "brand", "left")
