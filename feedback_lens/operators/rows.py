"""Result rows of topic models: keywords, shortlists, frequencies, normalised weights, wide form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedback_lens.operators.bow import attach_idf
from feedback_lens.schema import TOPIC_SEGMENT


def top_keywords(topic_term: DataFrame, seg: Sequence[str] = TOPIC_SEGMENT, n: int = 15) -> DataFrame:
    """Heaviest ``n`` terms per topic, ties by term. Each task keeps ``n`` rows per topic before the shuffle."""
    order = Window.partitionBy(*seg, "topic").orderBy(F.desc("weight"), "term")
    ranked = topic_term.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
    return ranked.select(
        *seg, "topic", "rank", F.col("term").alias("keyword"), F.col("weight").alias("keyword_weight")
    )


def topic_mass(keywords: DataFrame, seg: Sequence[str] = TOPIC_SEGMENT) -> DataFrame:
    return keywords.groupBy(*seg, "topic").agg(F.sum("keyword_weight").alias("mass"))


def heavy_topics(
    keywords: DataFrame, seg: Sequence[str] = TOPIC_SEGMENT, k: int = 5, min_mass: float = 0.25
) -> DataFrame:
    """``(seg…, topic, place)`` of the heaviest ``k`` topics with enough mass, in order of falling mass."""
    order = Window.partitionBy(*seg).orderBy(F.desc(F.round("mass", 9)), "topic")
    kept = topic_mass(keywords, seg).filter(F.round("mass", 9) >= min_mass).withColumn("place", F.row_number().over(order))
    return kept.filter(F.col("place") <= k).select(*seg, "topic", "place")


def shortlist_topics(
    keywords: DataFrame, seg: Sequence[str] = TOPIC_SEGMENT, k: int = 5, min_mass: float = 0.25
) -> DataFrame:
    """Keywords of the heaviest ``k`` topics with enough mass, renumbered from 1 by falling mass."""
    renumbered = keywords.join(heavy_topics(keywords, seg, k, min_mass), [*seg, "topic"])
    return renumbered.withColumn("topic", F.col("place")).drop("place")


def normalise_weights(keywords: DataFrame, seg: Sequence[str] = TOPIC_SEGMENT) -> DataFrame:
    """Weights divided by their sum in the topic; a topic has only its top keywords here."""
    whole = Window.partitionBy(*seg, "topic")
    return keywords.withColumn("keyword_weight", F.col("keyword_weight") / F.sum("keyword_weight").over(whole))


def dominant_topic(doc_topics: DataFrame, seg: Sequence[str] = TOPIC_SEGMENT) -> DataFrame:
    """Topic with the largest share rounded to two places, lowest number on ties."""
    best = F.max_by("topic", F.struct(F.round("p", 2), -F.col("topic")))
    return doc_topics.groupBy(*seg, "review_id").agg(best.alias("topic"))


def topic_frequency(
    doc_topics: DataFrame, topics: DataFrame, seg: Sequence[str] = TOPIC_SEGMENT
) -> DataFrame:
    """Reviews per dominant topic; topics that win no review count 0."""
    counts = dominant_topic(doc_topics, seg).groupBy(*seg, "topic").agg(F.count(F.lit(1)).alias("n"))
    every = topics.select(*seg, "topic").distinct()
    joined = every.join(counts, [*seg, "topic"], "left")
    return joined.select(*seg, "topic", F.coalesce("n", F.lit(0)).alias("topic_frequency"))


def topic_rows(
    topic_term: DataFrame,
    idf: DataFrame,
    doc_topics: DataFrame | None = None,
    coherence: DataFrame | None = None,
    seg: Sequence[str] = TOPIC_SEGMENT,
    n: int = 15,
    shortlist: tuple[int, float] | None = None,
) -> DataFrame:
    """The result table ``(seg…, topic, topic_frequency, keyword, keyword_weight, keyword_idf, coherence)``.

    ``topic_frequency`` and ``coherence`` stay null where the model does not give them; ``coherence`` is joined by the
    topic number before shortlisting.
    """
    seg = list(seg)
    keywords = top_keywords(topic_term, seg, n)
    if doc_topics is not None:
        keywords = keywords.join(topic_frequency(doc_topics, keywords, seg), [*seg, "topic"])
    else:
        keywords = keywords.withColumn("topic_frequency", F.lit(None).cast("long"))
    if coherence is not None:
        keywords = keywords.join(coherence.select(*seg, "topic", "coherence"), [*seg, "topic"], "left")
    else:
        keywords = keywords.withColumn("coherence", F.lit(None).cast("double"))
    if shortlist is not None:
        keywords = shortlist_topics(keywords, seg, *shortlist)
    return attach_idf(normalise_weights(keywords, seg), idf, seg).select(
        *seg, "topic", "topic_frequency", "rank", "keyword", "keyword_weight", "keyword_idf", "coherence"
    )


def wide_topics(keywords: DataFrame, keys: Sequence[str], topics: Sequence[int]) -> DataFrame:
    """One row per key and one column per topic holding its keywords in order."""
    listed = F.sort_array(F.collect_list(F.struct("rank", "keyword")))
    text = F.array_join(F.transform(listed, lambda s: s["keyword"]), ", ")
    wide = keywords.groupBy(*keys).pivot("topic", list(topics)).agg(text)
    return wide.select(*keys, *[F.nullif(F.col(f"`{t}`"), F.lit("")).alias(f"topic_{t}") for t in topics])
