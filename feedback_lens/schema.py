"""Fixed schemas of the review corpus, stored pages, vectors and lexical tables."""

from __future__ import annotations

from pyspark.sql import types as T

REVIEW = T.StructType(
    [
        T.StructField("review_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("comment", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("brand", T.StringType()),
        T.StructField("usefulness", T.IntegerType()),
        T.StructField("source", T.StringType()),
        T.StructField("company", T.StringType()),
    ]
)

PAGE = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)

VECTOR = T.StructType(
    [
        T.StructField("word", T.StringType()),
        T.StructField("vec", T.ArrayType(T.FloatType())),
    ]
)

LEXICON = T.StructType(
    [
        T.StructField("w", T.StringType()),
        T.StructField("pos", T.StringType()),
        T.StructField("lemma", T.StringType()),
    ]
)

# The segment of the topic models and of the similarity report.
TOPIC_SEGMENT = ["review_type", "year_quarter", "brand"]
REPORT_SEGMENT = ["year_quarter", "brand"]
