"""Counts, document frequencies, IDF and TF-IDF in long form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedback_lens.schema import TOPIC_SEGMENT


def bow(docs: DataFrame, seg: Sequence[str] = TOPIC_SEGMENT, tokens: str = "tokens") -> DataFrame:
    """``(seg, review_id, term, tf)`` without pruning; counted inside each review before any shuffle."""
    long = docs.select(*seg, "review_id", F.explode(tokens).alias("term"))
    return long.groupBy(*seg, "review_id", "term").agg(F.count(F.lit(1)).alias("tf"))


def vocabulary(counts: DataFrame, seg: Sequence[str] = TOPIC_SEGMENT) -> DataFrame:
    """Terms of each segment with document frequency and total count."""
    return counts.groupBy(*seg, "term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("n"))


def count_vectors(
    docs: DataFrame,
    seg: Sequence[str] = TOPIC_SEGMENT,
    min_df: int = 3,
    stop: DataFrame | None = None,
    tokens: str = "tokens",
) -> DataFrame:
    """Term counts of terms found in at least ``min_df`` reviews of the segment, stop words left out."""
    counts = bow(docs, seg, tokens)
    if stop is not None:
        counts = counts.join(stop.select(F.col("w").alias("term")), "term", "left_anti")
    kept = vocabulary(counts, seg).filter(F.col("df") >= min_df).select(*seg, "term")
    return counts.join(kept, [*seg, "term"], "left_semi")


def corpus_sizes(docs: DataFrame, seg: Sequence[str] = TOPIC_SEGMENT) -> DataFrame:
    return docs.groupBy(*seg).agg(F.count(F.lit(1)).alias("n_docs"))


def idf_table(
    docs: DataFrame,
    seg: Sequence[str] = TOPIC_SEGMENT,
    max_df: float | None = None,
    min_chars: int = 2,
    stop: DataFrame | None = None,
    tokens: str = "tokens",
) -> DataFrame:
    """Smoothed IDF ``ln((1 + n) / (1 + df)) + 1`` per segment and term.

    ``n`` counts every review of the segment, also those without tokens. With ``max_df`` terms in a larger share of
    the reviews are left out.
    """
    words = docs.select(*seg, F.explode(F.array_distinct(tokens)).alias("term")).filter(
        F.length("term") >= min_chars
    )
    if stop is not None:
        words = words.join(stop.select(F.col("w").alias("term")), "term", "left_anti")
    frequency = words.groupBy(*seg, "term").agg(F.count(F.lit(1)).alias("df"))
    joined = frequency.join(corpus_sizes(docs, seg), list(seg))
    if max_df is not None:
        joined = joined.filter(F.col("df") <= F.col("n_docs") * max_df)
    idf = F.log((1 + F.col("n_docs")) / (1 + F.col("df"))) + 1
    return joined.select(*seg, "term", "df", "n_docs", idf.alias("idf"))


def tfidf(
    docs: DataFrame,
    seg: Sequence[str] = TOPIC_SEGMENT,
    stop: DataFrame | None = None,
    tokens: str = "tokens",
) -> DataFrame:
    """TF-IDF rows of unit length per review; the window partition is one review."""
    idf = idf_table(docs, seg, stop=stop, tokens=tokens).select(*seg, "term", "idf")
    weighted = bow(docs, seg, tokens).join(idf, [*seg, "term"]).withColumn("x", F.col("tf") * F.col("idf"))
    length = F.sqrt(F.sum(F.col("x") * F.col("x")).over(Window.partitionBy(*seg, "review_id")))
    return weighted.select(*seg, "review_id", "term", (F.col("x") / length).alias("x"))


def attach_idf(topics: DataFrame, idf: DataFrame, seg: Sequence[str] = TOPIC_SEGMENT) -> DataFrame:
    """``keyword_idf`` of each keyword, 0 when the IDF table lacks it."""
    known = idf.select(*seg, F.col("term").alias("keyword"), F.col("idf").alias("keyword_idf"))
    return topics.join(known, [*seg, "keyword"], "left").withColumn("keyword_idf", F.coalesce("keyword_idf", F.lit(0.0)))
