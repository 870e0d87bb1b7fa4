"""Text preparation for the topic models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedback_lens.functions.tokens import remove_punctuation, tokenize_cv, tokenize_topic
from feedback_lens.operators.collocations import merge_bigrams, score_bigrams
from feedback_lens.operators.lexicon import (
    CONTENT_TAGS,
    explode_tokens,
    gather_tokens,
    lemmatize,
    remove_stopwords,
)
from feedback_lens.operators.segments import filter_years, polarity, with_quarter
from feedback_lens.operators.spelling import correct_spelling
from feedback_lens.schema import TOPIC_SEGMENT


def segmented(reviews: DataFrame, years: Sequence[int | str] | None = None, mode: str = "wide") -> DataFrame:
    """Reviews with quarter and polarity; year and rating filters come first so that they reach the scan."""
    kept = reviews if years is None else filter_years(reviews, years)
    return with_quarter(polarity(kept, mode))


def prepare(
    reviews: DataFrame,
    lexicon: DataFrame,
    stop: DataFrame,
    seg: Sequence[str] = TOPIC_SEGMENT,
    years: Sequence[int | str] | None = None,
    mode: str = "wide",
    keep_pos: Sequence[str] | None = CONTENT_TAGS,
    min_count: int = 3,
    threshold: float = 10.0,
    bigrams: bool = True,
) -> DataFrame:
    """``(seg…, review_id, tokens)``: tokens, collocations of the segment, lemmas, stop words out.

    Reviews left without tokens stay as rows with an empty array, since they count in segment sizes and IDF.
    """
    seg = list(seg)
    base = segmented(reviews, years, mode).filter(F.col("brand").isNotNull() & F.col("year_quarter").isNotNull())
    docs = base.select(*seg, "review_id", tokenize_topic(F.col("comment")).alias("tokens"))
    if bigrams:
        docs = merge_bigrams(docs, score_bigrams(docs, seg, min_count, threshold), seg)
    long = explode_tokens(docs, keep=["review_id"])
    lemmas = lemmatize(long, lexicon, keep_pos).drop("w")
    kept = remove_stopwords(lemmas, stop, "lemma")
    return _with_all(base.select(*seg, "review_id"), gather_tokens(kept, word="lemma"))


def _with_all(base: DataFrame, gathered: DataFrame) -> DataFrame:
    """Gathered tokens for every review of ``base``, an empty array where none is left."""
    empty = F.array().cast("array<string>")
    return base.join(gathered, "review_id", "left").withColumn("tokens", F.coalesce("tokens", empty))


def cv_tokens(docs: DataFrame) -> DataFrame:
    """Prepared tokens cut again by the count-vectoriser rule."""
    return docs.withColumn("tokens", tokenize_cv(F.array_join("tokens", " ")))


def clean_legacy(
    reviews: DataFrame,
    stop: DataFrame,
    lexicon: DataFrame,
    keep: Sequence[str] = ("review_type", "brand"),
    spelling: DataFrame | None = None,
    drop_digits: bool = False,
) -> DataFrame:
    """Older cleaner: lower-case words, stop words out, then punctuation characters out, then noun lemmas."""
    words = F.split(F.trim(F.regexp_replace(F.lower("comment"), r"\s+", " ")), " ")
    long = explode_tokens(reviews.select("review_id", words.alias("tokens")))
    if spelling is not None:
        long = correct_spelling(long, spelling)
    long = remove_stopwords(long, stop, drop_digits=False)
    long = long.withColumn("w", remove_punctuation(F.col("w"))).filter(F.col("w") != "")
    if drop_digits:
        long = long.filter(~F.rlike("w", F.lit("^[0-9]+$")))
    lemmas = lemmatize(long, lexicon, keep_pos=None, mode="noun").drop("w")
    return _with_all(reviews.select(*keep, "review_id"), gather_tokens(lemmas, word="lemma"))


def raw_words(reviews: DataFrame, keep: Sequence[str] = ("review_type", "brand")) -> DataFrame:
    """Lower-case words of two or more characters straight from the comment, as the clustering takes them."""
    words = F.regexp_extract_all(F.lower("comment"), F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0))
    return reviews.select(*keep, "review_id", words.alias("tokens"))
