"""Word classes, lemmas and stop words as joins against lexical tables.

Join strategies are left to the optimiser: a lexicon below the broadcast threshold is broadcast, a larger one is
shuffled, and very frequent words are split by the adaptive skew join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Tags of the lexicon. D determiner, P adposition, V verb, N noun, R adverb, A adjective, X other.
CONTENT_TAGS = ("N", "A", "V", "R")
PRONOUN_LEMMA = "-PRON-"

# The short stop list of the similarity path; negation stays in.
SIMILARITY_STOP = ("is", "the", "are", "a")


def explode_tokens(df: DataFrame, tokens: str = "tokens", keep: Sequence[str] = ("review_id",)) -> DataFrame:
    """Long form ``(…, pos, w)``.

    An inner explode lets the optimiser add a filter on the size of the array, which cuts every text into tokens once more before the scan
    hands it on. The outer one is left alone; the rows it makes for empty arrays go by their missing position.
    """
    return df.select(*keep, F.posexplode_outer(tokens).alias("pos", "w")).filter(F.col("pos").isNotNull())


def gather_tokens(
    long: DataFrame, keep: Sequence[str] = ("review_id",), word: str = "w", base: DataFrame | None = None
) -> DataFrame:
    """Back to one ordered array per review; a group is one review. Reviews of ``base`` without a token get an empty array."""
    ordered = F.sort_array(F.collect_list(F.struct("pos", F.col(word).alias("w"))))
    gathered = long.groupBy(*keep).agg(F.transform(ordered, lambda s: s["w"]).alias("tokens"))
    if base is None:
        return gathered
    empty = F.array().cast("array<string>")
    return base.select(*keep).join(gathered, list(keep), "left").withColumn("tokens", F.coalesce("tokens", empty))


def guess_tag(word: Column) -> Column:
    """Class of a word the lexicon does not list, by suffix."""
    return (
        F.when(~F.rlike(word, F.lit(r"^[\p{L}\p{N}_]")), "X")
        .when(F.rlike(word, F.lit("ly$")), "R")
        .when(F.rlike(word, F.lit("(ing|ed)$")), "V")
        .when(F.rlike(word, F.lit("(able|ible|ful|ous|ive|est)$")), "A")
        .otherwise("N")
    )


def tag_tokens(long: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Add ``tag`` and ``lemma`` to long tokens; unlisted words get a guessed tag and stay as they are."""
    entries = lexicon.select("w", F.col("pos").alias("lex_tag"), F.col("lemma").alias("lex_lemma"))
    joined = long.join(entries, "w", "left")
    return joined.withColumns(
        {
            "tag": F.coalesce("lex_tag", guess_tag(F.col("w"))),
            "lemma": F.coalesce("lex_lemma", F.col("w")),
        }
    ).drop("lex_tag", "lex_lemma")


def lemmatize(
    long: DataFrame, lexicon: DataFrame, keep_pos: Sequence[str] | None = CONTENT_TAGS, mode: str = "all"
) -> DataFrame:
    """Replace words by lemmas.

    ``keep_pos`` keeps only those classes (``None`` keeps all); pronouns go either way. ``mode="noun"`` changes
    nouns only and keeps every word.
    """
    tagged = tag_tokens(long, lexicon)
    if mode == "noun":
        lemma = F.when(F.col("tag") == "N", F.col("lemma")).otherwise(F.col("w"))
        return tagged.withColumn("lemma", lemma)
    kept = tagged.filter(F.col("lemma") != PRONOUN_LEMMA)
    return kept if keep_pos is None else kept.filter(F.col("tag").isin(list(keep_pos)))


def base_stopwords(spark: SparkSession) -> DataFrame:
    """English list that ships with Spark."""
    words = StopWordsRemover.loadDefaultStopWords("english")
    return spark.createDataFrame([(w,) for w in words], "w string")


def expand_synonyms(words: DataFrame, synonyms: DataFrame) -> DataFrame:
    """Synonyms of the given words."""
    return synonyms.join(words.select(F.col("w").alias("word")), "word").select(F.col("synonym").alias("w")).distinct()


def build_stopwords(
    reviews: DataFrame,
    user_words: Sequence[str] = (),
    search_term: str = "",
    common_words: Sequence[str] = (),
    synonyms: DataFrame | None = None,
    base: DataFrame | None = None,
    split_brands: bool = True,
) -> DataFrame:
    """Stop-word table: English base, user and search words, brand names, synonyms of common words."""
    spark = reviews.sparkSession
    brand = F.lower("brand")
    brands = reviews.select(brand.alias("w")).filter(F.col("w").isNotNull()).distinct()
    parts = [base if base is not None else base_stopwords(spark), brands]
    if split_brands:
        parts.append(brands.select(F.explode(F.split("w", r"\s+")).alias("w")))
    given = list(user_words) + search_term.split()
    if given:
        parts.append(spark.createDataFrame([(w,) for w in given], "w string"))
    if common_words:
        common = spark.createDataFrame([(w,) for w in common_words], "w string")
        parts.append(common)
        if synonyms is not None:
            parts.append(expand_synonyms(common, synonyms))
    union = parts[0].select("w")
    for part in parts[1:]:
        union = union.unionByName(part.select("w"))
    return union.distinct()


def remove_stopwords(long: DataFrame, stop: DataFrame, word: str = "w", drop_digits: bool = True) -> DataFrame:
    """Long tokens without stop words and, by default, without all-digit words."""
    kept = long.join(stop.select(F.col("w").alias(word)), word, "left_anti")
    return kept.filter(~F.rlike(word, F.lit("^[0-9]+$"))) if drop_digits else kept
