"""Phrase vectors and hypothesis scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedback_lens.functions.tokens import split_punctuation, tokenize_similarity
from feedback_lens.functions.vectors import mean_of
from feedback_lens.operators.blocked import Attach, best_of_reviews, best_products, mean_vectors
from feedback_lens.operators.lexicon import explode_tokens, tag_tokens
from feedback_lens.operators.phrases import PHRASE_TYPES, gather_tagged, with_phrases
from feedback_lens.session import written

SCORE_DIGITS = 9


def attach_vectors(words: DataFrame, vectors: DataFrame) -> DataFrame:
    """Vectors of the distinct words given. The vector table is never broadcast whole: it is joined by word."""
    return words.select("word").distinct().join(vectors, "word")


def subword_vectors(words: DataFrame, ngrams: DataFrame, min_n: int = 3, max_n: int = 6) -> DataFrame:
    """Vectors of words the table lacks: mean over the known character n-grams of ``<word>``."""
    bounded = F.concat(F.lit("<"), F.col("word"), F.lit(">"))
    grams = F.flatten(
        F.transform(
            F.sequence(F.lit(min_n), F.lit(max_n)),
            lambda n: F.when(
                F.length(bounded) >= n,
                F.transform(F.sequence(F.lit(1), F.length(bounded) - n + 1), lambda i: F.substr(bounded, i, n)),
            ).otherwise(F.array().cast("array<string>")),
        )
    )
    rows = words.select("word").distinct().select("word", F.posexplode(grams).alias("pos", "ngram"))
    known = rows.join(ngrams.select("ngram", "vec"), "ngram")
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("pos", "vec"))), lambda s: s["vec"])
    return known.groupBy("word").agg(mean_of(ordered).alias("vec"))


def word_vectors(words: DataFrame, vectors: DataFrame, ngrams: DataFrame | None = None) -> DataFrame:
    """Vectors of the distinct words given; with ``ngrams`` also of words the table lacks."""
    known = attach_vectors(words, vectors)
    if ngrams is None:
        return known
    unknown = words.select("word").distinct().join(vectors.select("word"), "word", "left_anti")
    return known.unionByName(subword_vectors(unknown, ngrams))


def vectors_of(vectors: DataFrame, ngrams: DataFrame | None = None) -> Attach:
    """What attaches vectors to rows with a column ``word``; the vectors of a block are those of its distinct words."""
    return lambda words: words.join(word_vectors(words, vectors, ngrams), "word")


def phrase_vectors(phrases: DataFrame, vectors: DataFrame, ngrams: DataFrame | None = None) -> DataFrame:
    """``(phrase, vec)``: mean vector of the known words, once per distinct phrase.

    Phrases without any known word have no row. With ``ngrams``, unknown words get their subword vector first. Blocks of phrases share the
    vectors of their words, see ``operators.blocked``.
    """
    return mean_vectors(phrases, vectors_of(vectors, ngrams))


def similarity_tokens(text: str) -> Column:
    """Tokens of a text column, punctuation split off before the lexicon lookup."""
    return split_punctuation(tokenize_similarity(F.col(text)))


def tag_text(df: DataFrame, text: str, lexicon: DataFrame, id_col: str = "review_id") -> DataFrame:
    """Long tagged tokens of a text column, punctuation split off before the lexicon lookup."""
    tokens = df.select(id_col, similarity_tokens(text).alias("tokens"))
    return tag_tokens(explode_tokens(tokens, keep=[id_col]), lexicon)


def analyze_hypothesis(spark: SparkSession, hypotheses: Sequence[str], lexicon: DataFrame) -> DataFrame:
    """``(hypothesis, phrase_type, phrases)``: the most numerous phrase kind, ties by noun, verb, prep.

    A hypothesis without any phrase has no row.
    """
    given = spark.createDataFrame([(h,) for h in dict.fromkeys(hypotheses)], "hypothesis string")
    words = given.select(
        "hypothesis",
        F.explode(split_punctuation(tokenize_similarity(F.col("hypothesis")))).alias("w"),
    )
    small_lexicon = lexicon.join(words.select("w").distinct(), "w", "left_semi")
    tagged = tag_text(given, "hypothesis", small_lexicon, "hypothesis")
    phrases = with_phrases(gather_tagged(tagged, "hypothesis", "w"))
    most = F.greatest(*[F.size(f"{kind}_phrases") for kind in PHRASE_TYPES])
    kind, chosen = F.lit(None), F.lit(None)
    for name in reversed(PHRASE_TYPES):
        wins = F.size(f"{name}_phrases") == most
        kind = F.when(wins, F.lit(name)).otherwise(kind)
        chosen = F.when(wins, F.col(f"{name}_phrases")).otherwise(chosen)
    return phrases.filter(most > 0).select("hypothesis", kind.alias("phrase_type"), chosen.alias("phrases"))


def pair_phrases(review_phrases: DataFrame, hypotheses: DataFrame) -> DataFrame:
    """Review phrases matched with the hypothesis phrases of the same kind, per hypothesis: for showing pairs, not for scoring them."""
    phrases = hypotheses.select("hypothesis", "phrase_type", F.explode("phrases").alias("hypothesis_phrase"))
    return review_phrases.join(phrases, "phrase_type")


def phrase_scores(
    distinct_phrases: DataFrame,
    hypotheses: DataFrame,
    vectors: DataFrame,
    ngrams: DataFrame | None = None,
) -> DataFrame:
    """``(phrase_type, phrase, hypothesis, score)``: best cosine against the hypothesis phrases.

    Works on distinct phrases, so a phrase shared by a third of all reviews is scored once, and in blocks, so that there may be any number
    of hypotheses.
    """
    theirs = hypothesis_vectors(hypotheses, vectors, ngrams)
    kinds = hypotheses.select("phrase_type").distinct()
    wanted = distinct_phrases.select("phrase_type", "phrase").distinct().join(kinds, "phrase_type", "left_semi")
    ours = wanted.join(phrase_vectors(wanted, vectors, ngrams), "phrase")
    return best_products(written(ours).df, written(theirs).df)


def hypothesis_vectors(hypotheses: DataFrame, vectors: DataFrame, ngrams: DataFrame | None = None) -> DataFrame:
    """``(hypothesis, phrase_type, vec)``: one row per phrase of a hypothesis, without a vector where no word is known."""
    theirs = hypotheses.select("hypothesis", "phrase_type", F.explode("phrases").alias("phrase"))
    return theirs.join(phrase_vectors(theirs, vectors, ngrams), "phrase", "left").select("hypothesis", "phrase_type", "vec")


def max_similarity(
    review_phrases: DataFrame,
    hypotheses: DataFrame,
    vectors: DataFrame,
    ngrams: DataFrame | None = None,
) -> DataFrame:
    """Best pair score per (review, hypothesis) over the phrase kind of the hypothesis.

    Reviews without a scored phrase have no row here; callers fill in 0. Scores keep nine digits, so equal phrases in
    another word order tie exactly, whatever the partitioning.
    """
    theirs = written(hypothesis_vectors(hypotheses, vectors, ngrams)).df
    best = best_of_reviews(review_phrases, theirs, vectors_of(vectors, ngrams))
    return best.withColumn("similarity", F.round("similarity", SCORE_DIGITS))


def biased(score: Column, rating: Column, bias: float) -> Column:
    """Add the bias for ratings of 4 and more, subtract it for 2 and less."""
    return F.when(rating >= 4, score + bias).when(rating <= 2, score - bias).otherwise(score)


def apply_bias(df: DataFrame, bias: float) -> DataFrame:
    score = F.round(biased(F.col("similarity"), F.col("rating"), bias), SCORE_DIGITS)
    return df.withColumn("similarity", score)


def overall_score(df: DataFrame, threshold: float, keys: Sequence[str]) -> DataFrame:
    """Share of reviews above the threshold per key; partial aggregation instead of a window over the segment."""
    above = F.when(F.col("similarity") > threshold, 1.0).otherwise(0.0)
    return df.groupBy(*keys).agg(F.avg(above).alias("overall_score"))


def top_reviews(df: DataFrame, keys: Sequence[str], n: int = 5) -> DataFrame:
    """Best ``n`` reviews per key, ties by review id.

    The rank filter sits right on the window, so every task cuts its own rows to ``n`` per key before the shuffle.
    """
    order = Window.partitionBy(*keys).orderBy(F.desc("similarity"), "review_id")
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
