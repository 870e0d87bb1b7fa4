"""Corpus reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def corpus_profile(df: DataFrame) -> DataFrame:
    """Size, widths and ranges of the corpus in one row."""
    return df.agg(
        F.count(F.lit(1)).alias("n_reviews"),
        F.countDistinct("company").alias("n_companies"),
        F.countDistinct("brand").alias("n_brands"),
        F.countDistinct("source").alias("n_sources"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.min("rating").alias("min_rating"),
        F.max("rating").alias("max_rating"),
    )


def reviews_by(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Review counts per value, largest first when only the top is wanted."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n_reviews"))
    return counts if top is None else counts.orderBy(F.desc("n_reviews"), column).limit(top)
