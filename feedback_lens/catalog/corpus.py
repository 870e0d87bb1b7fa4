"""Scans, sinks, filters, unions, dimension joins and corpus reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedback_lens.catalog import fixtures as fx
from feedback_lens.catalog import views  # noqa: F401  (register views on import)
from feedback_lens.catalog.registry import query, sql
from feedback_lens.functions.normalize import parse_date, render_date
from feedback_lens.operators import segments as sg
from feedback_lens.operators.bow import bow
from feedback_lens.operators.lexicon import build_stopwords, expand_synonyms
from feedback_lens.operators.reports import corpus_profile, reviews_by
from feedback_lens.sources import read_lexicon, read_pages, read_reviews, read_vectors, stage, write_table

ROW = "review_id, name, rating, comment, CAST(date AS VARCHAR) AS date, brand, usefulness, source"
ROW_COLUMNS = ["review_id", "name", "rating", "comment", "date", "brand", "usefulness", "source"]


def _plain(df: DataFrame) -> DataFrame:
    return df.select(*ROW_COLUMNS).withColumn("date", F.col("date").cast("string"))


@query("S1 S5", sql("reviews", f"SELECT {ROW} FROM reviews"))
def scan_reviews(spark: SparkSession, sf: str) -> DataFrame:
    path = fx.scratch(spark, "reviews")
    write_table(fx.reviews(spark, sf), path)
    return _plain(read_reviews(spark, path))


@query("S1 S5", sql("reviews", f"SELECT {ROW} FROM reviews"))
def scan_reviews_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = fx.scratch(spark, "reviews_csv")
    write_table(fx.reviews(spark, sf), path, fmt="csv")
    # CSV has no order guarantee for columns beyond the header, and the declared schema names all of them.
    return _plain(read_reviews(spark, path, fmt="csv"))


@query("S2", sql("", "SELECT page_id, url, length(html) AS n_chars FROM pages"))
def scan_pages(spark: SparkSession, sf: str) -> DataFrame:
    return read_pages(spark, f"{sf}/pages.parquet").select("page_id", "url", F.length("html").cast("long").alias("n_chars"))


@query("S3", sql("word_vectors", "SELECT word, CAST(len(vec) AS INT) AS dim, round(list_sum(vec::DOUBLE[]), 6) AS total FROM word_vectors"))
def scan_vectors_text(spark: SparkSession, sf: str) -> DataFrame:
    path = fx.scratch(spark, "vectors")
    line = F.concat_ws(" ", "word", F.array_join(F.transform("vec", lambda x: x.cast("string")), " "))
    fx.word_vectors(spark, sf).select(line.alias("value")).write.text(path)
    total = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return read_vectors(spark, path, 64, fmt="text").select(
        "word", F.size("vec").alias("dim"), F.round(total, 6).alias("total")
    )


@query("S4", sql("lexicon", "SELECT w, pos, lemma FROM lexicon"))
def scan_lexicon(spark: SparkSession, sf: str) -> DataFrame:
    path = fx.scratch(spark, "lexicon")
    write_table(fx.lexicon(spark, sf), path)
    return read_lexicon(spark, path)


@query("S6", sql("best_scores", "SELECT hypothesis, review_id, similarity FROM best_scores"))
def sink_by_hypothesis(spark: SparkSession, sf: str) -> DataFrame:
    from feedback_lens.catalog.similarity import best_scores

    path = fx.scratch(spark, "similarity")
    write_table(best_scores(spark, sf), path, partition_by=["hypothesis"])
    return spark.read.parquet(path).select("hypothesis", "review_id", "similarity")


@query("S7", sql("keywords", "SELECT review_type, year_quarter, brand, topic, rank, keyword FROM keywords"))
def sink_by_polarity(spark: SparkSession, sf: str) -> DataFrame:
    from feedback_lens.catalog.models import keywords

    path = fx.scratch(spark, "topics")
    write_table(keywords(spark, sf), path, partition_by=["review_type"])
    return spark.read.parquet(path).select("review_type", "year_quarter", "brand", "topic", "rank", "keyword")


@query("S8", sql("seg_tokens", "SELECT review_type, year_quarter, brand, review_id, w AS term, count(*) AS tf FROM seg_tokens GROUP BY ALL"))
def reuse_stage(spark: SparkSession, sf: str) -> DataFrame:
    path = fx.scratch(spark, "stages")
    key = {"operator": "bow", "tokens": "topic"}
    stage(spark, lambda: bow(fx.segment_docs(spark, sf)), path, key)
    return stage(spark, lambda: bow(fx.segment_docs(spark, sf)).limit(0), path, key)


@query("S9 U1", sql("reviews", f"SELECT {ROW} FROM reviews"))
def combine_sources(spark: SparkSession, sf: str) -> DataFrame:
    paths = []
    for shop in ("shop0", "shop1", "shop2"):
        paths.append(fx.scratch(spark, shop))
        write_table(fx.reviews(spark, sf).filter(F.col("source") == shop), paths[-1])
    return _plain(read_reviews(spark, paths))


@query(
    "U1",
    sql("reviews", """SELECT review_id, name, rating, brand, usefulness, source, CAST(NULL AS VARCHAR) AS company FROM reviews
    UNION ALL SELECT review_id, name, rating, NULL, NULL, source, NULL FROM reviews WHERE rating >= 4"""),
)
def union_of_sources(spark: SparkSession, sf: str) -> DataFrame:
    first = fx.reviews(spark, sf)
    second = first.filter(F.col("rating") >= 4).select(
        "source", F.col("rating").cast("int").cast("string").alias("rating"), "name", "review_id"
    )
    union = sg.union_reviews(first, second)
    return union.select("review_id", "name", "rating", "brand", "usefulness", "source", "company")


@query("N9", sql("reviews_q", "SELECT review_id, year_quarter FROM reviews_q"))
def year_quarter(spark: SparkSession, sf: str) -> DataFrame:
    return sg.with_quarter(fx.reviews(spark, sf)).select("review_id", "year_quarter")


@query("N10", sql("reviews", "SELECT review_id, strftime(date, '%B %d, %Y') AS shown, CAST(date AS VARCHAR) AS parsed FROM reviews"))
def render_dates(spark: SparkSession, sf: str) -> DataFrame:
    shown = fx.reviews(spark, sf).select("review_id", render_date(F.col("date")).alias("shown"))
    return shown.withColumn("parsed", parse_date(F.col("shown")).cast("string"))


@query("P1", sql("reviews", "SELECT review_id, CAST(date AS VARCHAR) AS date FROM reviews WHERE year(date) IN (2014, 2016)"))
def filter_years(spark: SparkSession, sf: str) -> DataFrame:
    kept = sg.filter_years(fx.reviews(spark, sf), ["2014", "2016"])
    return kept.select("review_id", F.col("date").cast("string").alias("date"))


@query("P2", sql("reviews_q", "SELECT review_id, rating, review_type FROM reviews_q WHERE review_type IS NOT NULL"))
def polarity_wide(spark: SparkSession, sf: str) -> DataFrame:
    return sg.polarity(fx.reviews(spark, sf)).select("review_id", "rating", "review_type")


@query("P3", sql("reviews_q", "SELECT review_id, rating, review_type FROM reviews_q WHERE rating IN (1, 5)"))
def polarity_strict(spark: SparkSession, sf: str) -> DataFrame:
    return sg.polarity(fx.reviews(spark, sf), "strict").select("review_id", "rating", "review_type")


@query("P4", sql("report_base", "SELECT review_id, year_quarter, brand FROM report_base"))
def segments_of_ten(spark: SparkSession, sf: str) -> DataFrame:
    kept = sg.min_segment(sg.with_quarter(sg.filter_years(fx.reviews(spark, sf), fx.YEARS)))
    return kept.select("review_id", "year_quarter", "brand")


@query(
    "P5",
    sql("reviews_q", """SELECT review_id, review_type, brand FROM reviews_q WHERE rating IN (1, 5) AND (review_type, brand) IN (
    SELECT (review_type, brand) FROM reviews_q WHERE rating IN (1, 5) GROUP BY review_type, brand HAVING count(*) > 10)"""),
)
def segments_above_keywords(spark: SparkSession, sf: str) -> DataFrame:
    strict = sg.polarity(fx.reviews(spark, sf), "strict")
    return sg.min_segment(strict, ["review_type", "brand"], 11).select("review_id", "review_type", "brand")


@query(
    "P6 A1 J6 M15",
    sql("reviews_q", """SELECT review_type, year_quarter, brand, count(*) AS n_reviews, count(*) < 20 AS skipped FROM reviews_q
    WHERE review_type IS NOT NULL GROUP BY ALL"""),
)
def segment_sizes(spark: SparkSession, sf: str) -> DataFrame:
    rows = sg.with_quarter(sg.polarity(fx.reviews(spark, sf)))
    keys = ["review_type", "year_quarter", "brand"]
    skipped = sg.skipped_segments(rows, keys, 20).select(*keys, F.lit(True).alias("skipped"))
    joined = sg.segment_sizes(rows, keys).join(skipped, keys, "left")
    return joined.withColumn("skipped", F.coalesce("skipped", F.lit(False)))


@query("J7", sql("reviews companies", "SELECT review_id, r.brand, c.company FROM reviews r LEFT JOIN companies c ON c.brand = r.brand"))
def attach_company(spark: SparkSession, sf: str) -> DataFrame:
    return sg.attach_company(fx.reviews(spark, sf), fx.companies(spark, sf)).select("review_id", "brand", "company")


@query("A8", sql("reviews_q", "SELECT DISTINCT year_quarter FROM reviews_q"))
def distinct_quarters(spark: SparkSession, sf: str) -> DataFrame:
    return sg.distinct_values(sg.with_quarter(fx.reviews(spark, sf)), "year_quarter")


@query(
    "E10 U2 A8",
    sql("reviews stopwords synonyms", """SELECT w FROM stopwords UNION SELECT unnest(['one','two','three','four','five','star','shop','machine','only','est'])
    UNION SELECT lower(brand) FROM reviews UNION SELECT synonym FROM synonyms WHERE word IN ('only', 'est')"""),
)
def stopword_table(spark: SparkSession, sf: str) -> DataFrame:
    return build_stopwords(
        fx.reviews(spark, sf),
        ["one", "two", "three", "four", "five", "star"],
        "shop machine",
        ["only", "est"],
        fx.synonyms(spark),
        fx.stopwords(spark),
    )


@query("J9", sql("tokens synonyms", "SELECT DISTINCT synonym AS w FROM synonyms WHERE word IN (SELECT w FROM tokens)"))
def synonyms_of_words(spark: SparkSession, sf: str) -> DataFrame:
    return expand_synonyms(fx.tokens(spark, sf), fx.synonyms(spark))


@query(
    "C1",
    sql("reviews companies", """SELECT count(*) AS n_reviews, count(DISTINCT company) AS n_companies, count(DISTINCT r.brand) AS n_brands,
    count(DISTINCT source) AS n_sources, CAST(min(date) AS VARCHAR) AS first_date, CAST(max(date) AS VARCHAR) AS last_date,
    min(rating) AS min_rating, max(rating) AS max_rating FROM reviews r LEFT JOIN companies c ON c.brand = r.brand"""),
)
def profile_of_corpus(spark: SparkSession, sf: str) -> DataFrame:
    profile = corpus_profile(sg.attach_company(fx.reviews(spark, sf), fx.companies(spark, sf)))
    return profile.withColumns({c: F.col(c).cast("string") for c in ("first_date", "last_date")})


@query("C2", sql("reviews", "SELECT rating, count(*) AS n_reviews FROM reviews GROUP BY rating"))
def reviews_by_rating(spark: SparkSession, sf: str) -> DataFrame:
    return reviews_by(fx.reviews(spark, sf), "rating")


@query("C3", sql("reviews", "SELECT brand, count(*) AS n_reviews FROM reviews GROUP BY brand ORDER BY n_reviews DESC, brand LIMIT 10"))
def reviews_by_brand(spark: SparkSession, sf: str) -> DataFrame:
    return reviews_by(fx.reviews(spark, sf), "brand", 10)


@query("C4", sql("reviews", "SELECT source, count(*) AS n_reviews FROM reviews GROUP BY source"))
def reviews_by_source(spark: SparkSession, sf: str) -> DataFrame:
    return reviews_by(fx.reviews(spark, sf), "source")


@query("C5", sql("reviews_q", "SELECT year_quarter, count(*) AS n_reviews FROM reviews_q GROUP BY year_quarter"))
def reviews_by_quarter(spark: SparkSession, sf: str) -> DataFrame:
    return reviews_by(sg.with_quarter(fx.reviews(spark, sf)), "year_quarter")
