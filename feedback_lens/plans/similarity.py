"""Contextual similarity of reviews to hypotheses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedback_lens.operators.blocked import report_by_blocks
from feedback_lens.operators.lexicon import PRONOUN_LEMMA, SIMILARITY_STOP, tag_tokens
from feedback_lens.operators.phrases import long_phrases, tagged_in_blocks, with_phrases
from feedback_lens.operators.segments import attach_company, filter_years, min_segment, with_quarter
from feedback_lens.operators.similarity import (
    SCORE_DIGITS,
    analyze_hypothesis,
    apply_bias,
    hypothesis_vectors,
    max_similarity,
    similarity_tokens,
    vectors_of,
)
from feedback_lens.schema import REPORT_SEGMENT
from feedback_lens.session import cut_lineage, written

# Defaults of the original report.
THRESHOLD, BIAS, TOP, MIN_REVIEWS = 0.6, -0.2, 5, 10


def report_base(reviews: DataFrame, years: Sequence[int | str], min_reviews: int = MIN_REVIEWS) -> DataFrame:
    """Reviews of the listed years in segments with enough reviews."""
    return min_segment(with_quarter(filter_years(reviews, years)), REPORT_SEGMENT, min_reviews)


def cleaned_words(base: DataFrame, lexicon: DataFrame) -> DataFrame:
    """``(review_id, words, tags)``: lemmas without pronouns and the short stop list.

    The stop list applies to the surface form and to the lemma.
    """
    stop = list(SIMILARITY_STOP)

    def kept(words: DataFrame) -> DataFrame:
        tagged = tag_tokens(words, lexicon)
        return tagged.filter((F.col("lemma") != PRONOUN_LEMMA) & ~F.col("w").isin(stop) & ~F.col("lemma").isin(stop))

    return tagged_in_blocks(base, "comment", similarity_tokens("comment"), kept)


def prepare_similarity(
    reviews: DataFrame, years: Sequence[int | str], lexicon: DataFrame, min_reviews: int = MIN_REVIEWS
) -> DataFrame:
    """Three phrase columns for every review of the report, empty for a review without words."""
    base = report_base(reviews, years, min_reviews)
    phrases = with_phrases(cleaned_words(base, lexicon)).drop("words", "tags")
    empty = F.array().cast("array<string>")
    joined = base.join(phrases, "review_id", "left")
    names = [c for c in phrases.columns if c.endswith("_phrases")]
    return joined.withColumns({name: F.coalesce(name, empty) for name in names})


def scored_reviews(
    base: DataFrame,
    phrases: DataFrame,
    hypotheses: Sequence[str],
    lexicon: DataFrame,
    vectors: DataFrame,
    bias: float = BIAS,
    ngrams: DataFrame | None = None,
) -> DataFrame:
    """``(review_id, hypothesis, similarity, year_quarter, brand)`` for every review and usable hypothesis.

    All hypotheses are scored in one job. Comments stay behind: only light columns go through the shuffles.
    """
    # A few rows that the plan needs in four places; as a small table they keep it short.
    analysed = cut_lineage(analyze_hypothesis(base.sparkSession, hypotheses, lexicon))
    best = max_similarity(phrases, analysed, vectors, ngrams)
    asked = F.explode(F.array(*[F.lit(h) for h in dict.fromkeys(hypotheses)]))
    rows = base.select("review_id", "rating", *REPORT_SEGMENT, asked.alias("hypothesis"))
    rows = rows.join(analysed.select("hypothesis"), "hypothesis", "left_semi")
    rows = rows.join(best, ["review_id", "hypothesis"], "left")
    return apply_bias(rows.withColumn("similarity", F.coalesce("similarity", F.lit(0.0))), bias)


def project_similarity(df: DataFrame) -> DataFrame:
    """Declared columns of the report; ``company`` is null when it is not known."""
    company = F.col("company") if "company" in df.columns else F.lit(None).cast("string").alias("company")
    return df.select(
        "hypothesis", "year_quarter", company, "brand", "name", "rating", "source", "comment", "similarity",
        "overall_score", "review_id", "rank",
    )


def similarity_table(
    reviews: DataFrame,
    hypotheses: str | Sequence[str],
    years: Sequence[int | str],
    lexicon: DataFrame,
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    bias: float = BIAS,
    top: int = TOP,
    min_reviews: int = MIN_REVIEWS,
    ngrams: DataFrame | None = None,
    companies: DataFrame | None = None,
) -> DataFrame:
    """Best reviews per hypothesis, quarter and brand, with the share of reviews above the threshold.

    Scores are taken in blocks, see ``operators.blocked``: the report holds a few rows per hypothesis and block of reviews, not one per review
    and hypothesis. Comments are fetched at the end, for the winning rows only.
    """
    asked = [hypotheses] if isinstance(hypotheses, str) else list(hypotheses)
    base = report_base(reviews, years, min_reviews)
    phrases = written(long_phrases(with_phrases(cleaned_words(base, lexicon)))).df
    analysed = written(analyze_hypothesis(base.sparkSession, asked, lexicon)).df
    theirs = written(hypothesis_vectors(analysed, vectors, ngrams)).df
    light = base.select("review_id", F.col("rating").cast("double").alias("rating"), *REPORT_SEGMENT)
    ranked = report_by_blocks(light, phrases, vectors_of(vectors, ngrams), theirs, REPORT_SEGMENT, threshold, bias, top, SCORE_DIGITS)
    texts = filter_years(reviews, years).select(
        "review_id", "name", "rating", "source", "comment", *(["company"] if "company" in reviews.columns else [])
    )
    rows = ranked.join(texts, "review_id")
    if companies is not None:
        rows = attach_company(rows, companies)
    return project_similarity(rows)
