"""Phrase vectors, hypotheses and the similarity report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedback_lens.catalog import fixtures as fx
from feedback_lens.catalog.registry import query, sql
from feedback_lens.functions.vectors import cosine
from feedback_lens.operators import similarity as sm
from feedback_lens.operators.phrases import long_phrases, with_phrases
from feedback_lens.plans.similarity import (
    cleaned_words,
    prepare_similarity,
    report_base,
    scored_reviews,
    similarity_table,
)
from feedback_lens.schema import REPORT_SEGMENT
from feedback_lens.session import cut_lineage

KEYS = ["hypothesis", *REPORT_SEGMENT]


def _base(spark: SparkSession, sf: str) -> DataFrame:
    return report_base(fx.reviews(spark, sf), fx.YEARS)


def _phrases(spark: SparkSession, sf: str) -> DataFrame:
    return long_phrases(with_phrases(cleaned_words(_base(spark, sf), fx.lexicon(spark, sf))))


def _hypotheses(spark: SparkSession, sf: str) -> DataFrame:
    return cut_lineage(sm.analyze_hypothesis(spark, fx.HYPOTHESES, fx.lexicon(spark, sf)))


def best_scores(spark: SparkSession, sf: str) -> DataFrame:
    return sm.max_similarity(_phrases(spark, sf), _hypotheses(spark, sf), fx.word_vectors(spark, sf))


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return scored_reviews(
        _base(spark, sf), _phrases(spark, sf), fx.HYPOTHESES, fx.lexicon(spark, sf), fx.word_vectors(spark, sf), fx.BIAS
    )


def _flat(vec: str) -> list:
    """A vector as its first, last and summed entry."""
    total = F.aggregate(vec, F.lit(0.0), lambda a, x: a + x.cast("double"))
    return [
        F.round(F.get(vec, F.lit(0)).cast("double"), 6).alias("first"),
        F.round(F.get(vec, F.size(vec) - 1).cast("double"), 6).alias("last"),
        F.round(total, 6).alias("total"),
    ]


FLAT = "round(vec[1]::DOUBLE, 6) AS first, round(vec[len(vec)]::DOUBLE, 6) AS last, round(list_sum(vec::DOUBLE[]), 6) AS total"


@query("J3", sql("word_vectors stopwords tokens", f"SELECT word, {FLAT} FROM word_vectors WHERE word IN (SELECT w FROM tokens)"))
def vectors_of_words(spark: SparkSession, sf: str) -> DataFrame:
    words = fx.tokens(spark, sf).select(F.col("w").alias("word"))
    return sm.attach_vectors(words, fx.word_vectors(spark, sf)).select("word", *_flat("vec"))


@query("H1 J3", sql("phrase_vecs sim_phrases", f"SELECT phrase, {FLAT} FROM phrase_vecs WHERE phrase IN (SELECT phrase FROM sim_phrases)"))
def phrase_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return sm.phrase_vectors(_phrases(spark, sf), fx.word_vectors(spark, sf)).select("phrase", *_flat("vec"))


SUBWORDS = """SELECT word, list(x ORDER BY d) AS vec FROM (SELECT word, d, avg(x) AS x FROM (
    SELECT g.word, generate_subscripts(v.vec, 1) AS d, CAST(unnest(v.vec) AS DOUBLE) AS x FROM (
      SELECT w AS word, unnest(list_concat(
        list_transform(range(1, length(w) + 1), lambda i: substr('<' || w || '>', i, 3)),
        list_concat(list_transform(range(1, length(w)), lambda i: substr('<' || w || '>', i, 4)),
        list_concat(list_transform(range(1, length(w) - 1), lambda i: substr('<' || w || '>', i, 5)),
        list_transform(range(1, length(w) - 2), lambda i: substr('<' || w || '>', i, 6)))))) AS ngram
      FROM word_counts WHERE n = 1) g JOIN ngram_vectors v USING (ngram)) GROUP BY word, d) GROUP BY word"""


@query("H2", sql("word_counts ngram_vectors", f"SELECT word, {FLAT} FROM ({SUBWORDS})"))
def vectors_of_unknown_words(spark: SparkSession, sf: str) -> DataFrame:
    unknown = fx.word_counts(spark, sf).filter("n = 1").select(F.col("w").alias("word"))
    return sm.subword_vectors(unknown, fx.ngram_vectors(spark, sf)).select("word", *_flat("vec"))


@query(
    "H3",
    sql("", """SELECT a.vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS similarity
    FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1"""),
)
def cosine_of_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    a = fx.table(spark, sf, "embeddings").select("vec_id", "embedding")
    b = a.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return a.join(b, "vec_id").select("vec_id", F.round(cosine(F.col("embedding"), F.col("other")), 6).alias("similarity"))


@query(
    "J4 H7 P8",
    sql("sim_phrases hyp_phrases", """SELECT review_id, r.phrase_type, r.phrase, h.hypothesis, h.phrase AS hypothesis_phrase
    FROM sim_phrases r JOIN hyp_phrases h ON h.phrase_type = r.phrase_type"""),
)
def phrase_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return sm.pair_phrases(_phrases(spark, sf), _hypotheses(spark, sf)).select(
        "review_id", "phrase_type", "phrase", "hypothesis", "hypothesis_phrase"
    )


@query(
    "H5",
    sql("hyp_analysed sim_phrases", """SELECT hypothesis, h.phrase_type, array_to_string(ps, ' | ') AS phrases,
    (SELECT count(*) FROM sim_phrases s WHERE s.phrase_type = h.phrase_type) AS n_candidates FROM hyp_analysed h"""),
)
def analysed_hypotheses(spark: SparkSession, sf: str) -> DataFrame:
    """Kind and phrases of each hypothesis, with the number of review phrases it will be compared to."""
    sizes = _phrases(spark, sf).groupBy("phrase_type").agg(F.count(F.lit(1)).alias("n_candidates"))
    hyps = _hypotheses(spark, sf).withColumn("phrases", F.array_join("phrases", " | "))
    return sizes.join(F.broadcast(hyps), "phrase_type").select("hypothesis", "phrase_type", "phrases", "n_candidates")


@query(
    "H4 H7 A9",
    sql("report_base best_scores hyp_analysed", """SELECT b.review_id, h.hypothesis, coalesce(s.similarity, 0) AS similarity FROM report_base b
    CROSS JOIN hyp_analysed h LEFT JOIN best_scores s ON s.review_id = b.review_id AND s.hypothesis = h.hypothesis"""),
)
def best_pair_scores(spark: SparkSession, sf: str) -> DataFrame:
    scored = scored_reviews(
        _base(spark, sf), _phrases(spark, sf), fx.HYPOTHESES, fx.lexicon(spark, sf), fx.word_vectors(spark, sf), 0.0
    )
    return scored.select("review_id", "hypothesis", "similarity")


@query("H6 P9", sql("scored", "SELECT review_id, hypothesis, similarity FROM scored"))
def biased_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf).select("review_id", "hypothesis", "similarity")


@query("A2", sql("shares", "SELECT hypothesis, year_quarter, brand, round(overall_score, 6) AS overall_score FROM shares"))
def share_above_threshold(spark: SparkSession, sf: str) -> DataFrame:
    shares = sm.overall_score(_scored(spark, sf), fx.THRESHOLD, KEYS)
    return shares.withColumn("overall_score", F.round("overall_score", 6))


@query("W1", sql("best_reviews", "SELECT hypothesis, year_quarter, brand, rank, review_id, similarity FROM best_reviews"))
def top_five_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return sm.top_reviews(_scored(spark, sf), KEYS).select(
        *KEYS, "rank", "review_id", "similarity"
    )


@query("O1", sql("scored", "SELECT hypothesis, review_id, similarity FROM scored ORDER BY similarity DESC, review_id"))
def ranked_scores(spark: SparkSession, sf: str) -> DataFrame:
    scored = _scored(spark, sf).orderBy(F.desc("similarity"), "review_id")
    return scored.select("hypothesis", "review_id", "similarity")


REPORT = """SELECT b.hypothesis, b.year_quarter, {company} AS company, b.brand, r.name, b.rating, r.source, r.comment,
    b.similarity, round(s.overall_score, 6) AS overall_score, b.review_id, b.rank
    FROM best_reviews b JOIN shares s USING (hypothesis, year_quarter, brand) JOIN reviews r ON r.review_id = b.review_id"""


def _report(df: DataFrame) -> DataFrame:
    return df.withColumn("overall_score", F.round("overall_score", 6))


@query(
    "H8 H9 P7 J7",
    sql("best_reviews shares reviews companies", REPORT.format(company="c.company") + " LEFT JOIN companies c ON c.brand = b.brand"),
)
def similarity_report(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: three hypotheses over all reviews of the year in one job."""
    return _report(
        similarity_table(
            fx.reviews(spark, sf),
            fx.HYPOTHESES,
            fx.YEARS,
            fx.lexicon(spark, sf),
            fx.word_vectors(spark, sf),
            fx.THRESHOLD,
            fx.BIAS,
            companies=fx.companies(spark, sf),
        )
    )


@query(
    "H8 P7",
    sql("best_reviews shares reviews", REPORT.format(company="CAST(NULL AS VARCHAR)") + " WHERE b.hypothesis = 'was only thing'"),
)
def similarity_of_one(spark: SparkSession, sf: str) -> DataFrame:
    return _report(
        similarity_table(
            fx.reviews(spark, sf), "was only thing", fx.YEARS, fx.lexicon(spark, sf), fx.word_vectors(spark, sf)
        )
    )


@query(
    "H10",
    sql("report_base sim_phrases", """SELECT b.review_id, b.year_quarter, b.brand, count(*) FILTER (phrase_type = 'noun') AS n_noun,
    count(*) FILTER (phrase_type = 'verb') AS n_verb, count(*) FILTER (phrase_type = 'prep') AS n_prep
    FROM report_base b LEFT JOIN sim_phrases s ON s.review_id = b.review_id GROUP BY ALL"""),
)
def reviews_with_phrases(spark: SparkSession, sf: str) -> DataFrame:
    ready = prepare_similarity(fx.reviews(spark, sf), fx.YEARS, fx.lexicon(spark, sf))
    return ready.select(
        "review_id",
        *REPORT_SEGMENT,
        *[
            F.size(F.array_distinct(f"{kind}_phrases")).cast("long").alias(f"n_{kind}")
            for kind in ("noun", "verb", "prep")
        ],
    )
