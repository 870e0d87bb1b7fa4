"""Inputs derived from the given tables, for Spark; ``views`` holds the same for SQL.

All of it is row-wise arithmetic, grouping by word, or pages of at most twenty reviews, so it grows with the tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedback_lens.functions.tokens import tokenize_topic
from feedback_lens.operators.bow import bow
from feedback_lens.operators.lexicon import explode_tokens
from feedback_lens.operators.segments import polarity, with_quarter
from feedback_lens.schema import TOPIC_SEGMENT
from feedback_lens.session import ensure_checkpoint_dir, spread
from feedback_lens.sources import stage

Build = Callable[[SparkSession, str], DataFrame]

YEARS = [2016]
STOPWORDS = (
    "the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "on", "with", "be", "by", "as", "one", "star",
)
SYNONYMS = (("only", "thly"), ("only", "erly"), ("thing", "oning"), ("est", "hest"))
HYPOTHESES = ("was only thing", "the er of que", "and or")
THRESHOLD, BIAS = 0.6, -0.2
CRAWL_DATE = "2018-12-31"
PER_PAGE, PRODUCTS = 20, 9


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf}/{name}.parquet"))


def scratch(spark: SparkSession, name: str) -> str:
    """New folder for a written table, below the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/tables/{name}_{uuid.uuid4().hex}"


def stored(name: str) -> Callable[[Build], Build]:
    """Lexical tables and vectors are inputs a user has on disk, so they are built once per session and read back."""

    def wrap(build: Build) -> Build:
        @wraps(build)
        def read(spark: SparkSession, sf: str) -> DataFrame:
            ensure_checkpoint_dir(spark)
            path = f"{spark.sparkContext.getCheckpointDir()}/inputs/{name}"
            return stage(spark, lambda: build(spark, sf), path, {"tables": sf})

        return read

    return wrap


def reviews(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("doc_id")
    return table(spark, sf, "documents").select(
        i.alias("review_id"),
        F.concat(F.lit("Product "), (i % 9).cast("string")).alias("name"),
        (1 + F.floor(i / 3) % 5).cast("double").alias("rating"),
        F.col("text").alias("comment"),
        F.date_add(F.lit("2015-11-01").cast("date"), ((i * 37) % 365).cast("int")).alias("date"),
        F.concat(F.lit("brand"), (i % 3).cast("string")).alias("brand"),
        (i % 4).cast("int").alias("usefulness"),
        F.concat(F.lit("shop"), (F.floor(i / 7) % 3).cast("string")).alias("source"),
    )


def companies(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("doc_id")
    brand = F.concat(F.lit("brand"), (i % 3).cast("string")).alias("brand")
    company = F.concat(F.lit("Company "), (i % 3).cast("string")).alias("company")
    return table(spark, sf, "documents").filter(i % 3 < 2).select(brand, company).distinct()


def token_docs(spark: SparkSession, sf: str) -> DataFrame:
    return reviews(spark, sf).select("review_id", tokenize_topic(F.col("comment")).alias("tokens"))


def tokens(spark: SparkSession, sf: str) -> DataFrame:
    return explode_tokens(token_docs(spark, sf))


@stored("lexicon")
def lexicon(spark: SparkSession, sf: str) -> DataFrame:
    w = F.col("w")
    words = tokens(spark, sf).select("w").distinct()
    pos = (
        F.when(w.isin("the", "a", "an", "this", "that"), "D")
        .when(w.isin("of", "in", "on", "for", "with", "by", "at", "from", "to"), "P")
        .when(w.isin("is", "was", "be", "are", "were", "have", "had", "do"), "V")
        .when(w.isin("not", "never"), "R")
        .when(w.isin("and", "or", "but", "as"), "X")
        .when(w.like("%ing") | w.like("%ed"), "V")
        .when(w.like("%ly"), "R")
        .when(w.like("%ble") | w.like("%est"), "A")
        .otherwise("N")
    )
    lemma = (
        F.when(w.isin("is", "was", "are", "were"), "be")
        .when(w.isin("he", "she", "they"), "-PRON-")
        .when((F.col("pos") == "V") & w.like("%ing") & (F.length(w) > 5), F.expr("substr(w, 1, length(w) - 3)"))
        .when((F.col("pos") == "V") & w.like("%ed") & (F.length(w) > 4), F.expr("substr(w, 1, length(w) - 2)"))
        .otherwise(w)
    )
    return words.withColumn("pos", pos).select("w", "pos", lemma.alias("lemma"))


def stopwords(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(w,) for w in STOPWORDS], "w string")


def synonyms(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SYNONYMS), "word string, synonym string")


@stored("word_counts")
def word_counts(spark: SparkSession, sf: str) -> DataFrame:
    return tokens(spark, sf).groupBy("w").agg(F.count(F.lit(1)).alias("n"))


@stored("word_vectors")
def word_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Words seen at least twice, mapped onto the embeddings by arithmetic on count and spelling."""
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding")
    size = vectors.agg(F.count(F.lit(1)).alias("size")).withColumn("one", F.lit(1))
    words = word_counts(spark, sf).filter("n >= 2").withColumn("one", F.lit(1)).join(F.broadcast(size), "one")
    w = F.col("w")
    spelled = F.ascii(w) * 7 + F.ascii(F.expr("substr(w, 2, 1)")) * 13 + F.length(w) * 3
    vec_id = (F.col("n") * 31 + spelled) % F.col("size")
    return words.withColumn("vec_id", vec_id).join(vectors, "vec_id").select(w.alias("word"), F.col("embedding").alias("vec"))


@stored("ngram_vectors")
def ngram_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors of three-letter pieces of known words, mapped onto the embeddings by spelling."""
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding")
    size = vectors.agg(F.count(F.lit(1)).alias("size")).withColumn("one", F.lit(1))
    bounded = F.concat(F.lit("<"), "w", F.lit(">"))
    grams = F.transform(F.sequence(F.lit(1), F.length(bounded) - 2), lambda i: F.substr(bounded, i, F.lit(3)))
    rows = word_counts(spark, sf).filter("n >= 2").select(F.explode(grams).alias("ngram")).distinct()
    rows = rows.withColumn("one", F.lit(1)).join(F.broadcast(size), "one")
    g = [F.ascii(F.expr(f"substr(ngram, {i}, 1)")) for i in (1, 2, 3)]
    rows = rows.withColumn("vec_id", ((g[0] * 5 + g[1] * 11 + g[2] * 17) % F.col("size")).cast("long"))
    return rows.join(vectors, "vec_id").select("ngram", F.col("embedding").alias("vec"))


def segment_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Topic tokens per review with the topic segment, for operators that take prepared reviews."""
    kept = with_quarter(polarity(reviews(spark, sf)))
    return kept.select(*TOPIC_SEGMENT, "review_id", tokenize_topic(F.col("comment")).alias("tokens"))


def topic_term(spark: SparkSession, sf: str) -> DataFrame:
    """Stand-in for a fitted model: the reviews with ``review_id div 15 % 3 + 1 = topic`` make up a topic."""
    counts = bow(segment_docs(spark, sf)).withColumn("topic", (F.floor(F.col("review_id") / 15) % 3 + 1).cast("int"))
    return counts.groupBy(*TOPIC_SEGMENT, "topic", "term").agg(F.sum("tf").cast("double").alias("weight"))


def doc_topics(spark: SparkSession, sf: str) -> DataFrame:
    """Stand-in for inferred shares, with ties after rounding."""
    kept = with_quarter(polarity(reviews(spark, sf))).select(*TOPIC_SEGMENT, "review_id")
    share = [1 + (F.col("review_id") * t) % 5 for t in (1, 2, 3)]
    total = share[0] + share[1] + share[2]
    rows = kept.select("*", F.posexplode(F.array(*[s / total for s in share])).alias("i", "p"))
    return rows.select(*TOPIC_SEGMENT, "review_id", (F.col("i") + 1).alias("topic"), "p")


def _escaped(col: Column) -> Column:
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("'", "&apos;")):
        col = F.replace(col, F.lit(plain), F.lit(entity))
    return col


def _html(pattern: str, **values: Column) -> Column:
    """Text with ``{name}`` places filled from columns."""
    parts: list[Column] = []
    rest = pattern
    while "{" in rest:
        head, _, tail = rest.partition("{")
        name, _, rest = tail.partition("}")
        parts += [F.lit(head), values[name].cast("string")]
    return F.concat(*parts, F.lit(rest))


def _paged(rows: DataFrame, head: Column, tail: Column) -> DataFrame:
    """Pages of twenty blocks per product."""
    product, number = F.col("review_id") % PRODUCTS, F.floor(F.col("review_id") / (PRODUCTS * PER_PAGE))
    blocks = F.transform(F.sort_array(F.collect_list(F.struct("review_id", "block"))), lambda s: s["block"])
    grouped = rows.groupBy(product.alias("product"), number.alias("page_no")).agg(blocks.alias("blocks"))
    return grouped.select(
        (F.col("product") + PRODUCTS * F.col("page_no")).alias("page_id"),
        F.concat(F.lit("P"), F.col("product").cast("string")).alias("key"),
        F.concat(F.lit("<html><body>"), head, F.array_join("blocks", "\n"), tail, F.lit("</body></html>")).alias("html"),
    )


def amazon_pages(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("review_id")
    votes = F.when(F.col("usefulness") == 0, "").when(F.col("usefulness") == 1, "One person found this helpful")
    votes = votes.otherwise(F.concat(F.lit("1,20"), F.col("usefulness"), F.lit(" people found this helpful")))
    vote_tag = F.when(votes == "", "").otherwise(
        _html('<span class="a-size-base cr-vote-text cr-vote-component">{v}</span>', v=votes)
    )
    block = _html(
        '<div id="R{i}" data-hook="review" class="a-section"><div class="row"><div>'
        '<i data-hook="review-star-rating" class="a-icon"><span>{rating}</span></i></div>'
        '<a data-hook="review-title" href="/r/{i}">Title {i}</a></div>'
        '<span data-hook="review-date" class="d">on {date}</span>'
        '<span data-hook="review-body" class="b"><span class="lead"><b>Body</b></span> <span>{text}</span><br></span>'
        '<div class="votes"><div>{votes}</div></div></div>',
        i=i,
        rating=F.when(i % 50 == 0, "").otherwise(F.concat(F.col("rating").cast("int"), F.lit(".0 out of 5 stars"))),
        date=F.date_format("date", "MMMM d, yyyy"),
        text=_escaped(F.col("comment")),
        votes=vote_tag,
    )
    head = _html(
        '<div id="centerCol"><h1><span id="productTitle">\n  Product {p}\n</span></h1>'
        '<a id="bylineInfo" href="#">brand{b}</a></div>',
        p=F.col("product"),
        b=F.col("product") % 3,
    )
    numbers = F.transform(
        F.sequence(F.lit(1).cast("long"), F.col("page_no") + 1),
        lambda n: F.concat(F.lit('<li class="page-button"><a href="#">'), n.cast("string"), F.lit("</a></li>")),
    )
    tail = F.concat(
        F.lit('<div id="cm_cr-pagination_bar"><ul>'),
        F.array_join(numbers, ""),
        F.lit('</ul></div><div class="footer"><span class="cr-vote-text">77 people found this helpful</span></div>'),
    )
    return _paged(reviews(spark, sf).withColumn("block", block), head, tail)


DEAD_PRODUCT, UNLISTED_PRODUCT = 4, 7
NOT_FOUND = "<title>Page Not Found</title>"


def amazon_search_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Search pages that list every tenth review's product; one product is listed under a key that no page has."""
    product = F.col("review_id") % PRODUCTS
    key = F.when(product == UNLISTED_PRODUCT, "Q7").otherwise(F.concat(F.lit("P"), product.cast("string")))
    rows = reviews(spark, sf).filter("review_id % 10 = 0").select("review_id", _html('<li class="s" data-asin="{k}">x</li>', k=key).alias("item"))
    items = F.transform(F.sort_array(F.collect_list(F.struct("review_id", "item"))), lambda s: s["item"])
    grouped = rows.groupBy(F.floor(F.col("review_id") / 500).alias("page_id")).agg(items.alias("items"))
    return grouped.select("page_id", F.concat(F.lit("<ul>"), F.array_join("items", "\n"), F.lit("</ul>")).alias("html"))


def amazon_product_pages(spark: SparkSession, sf: str) -> DataFrame:
    product = F.col("product")
    rows = reviews(spark, sf).select((F.col("review_id") % PRODUCTS).alias("product")).distinct()
    html = F.when(product == DEAD_PRODUCT, NOT_FOUND).otherwise(_html("<h1>Product {p}</h1>", p=product))
    return rows.select(F.concat(F.lit("P"), product.cast("string")).alias("key"), html.alias("html"))


def bestbuy_pages(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("review_id")
    unit = F.element_at(F.array(F.lit("day"), F.lit("week"), F.lit("month"), F.lit("year")), (i % 4 + 1).cast("int"))
    amount = i % 11 + 1
    block = _html(
        '<div class="col-xs-12 col-md-9"><p class="sr-only">Rating: {rating} out of 5 stars</p>'
        '<time class="submission-date" title="x">{n} {unit}{s} ago</time>'
        '<p class="pre-white-space">{text}</p></div>',
        rating=F.when(i % 50 == 0, "").otherwise(F.col("rating").cast("int").cast("string")),
        n=amount,
        unit=unit,
        s=F.when(amount > 1, "s").otherwise(""),
        text=_escaped(F.col("comment")),
    )
    head = _html(
        '<h2 class="product-title"><a href="/p">brand{b} - Product {p}</a></h2>',
        b=F.col("product") % 3,
        p=F.col("product"),
    )
    return _paged(reviews(spark, sf).withColumn("block", block), head, F.lit(""))


def walmart_pages(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("review_id")
    last = (F.floor(i / PRODUCTS) % PER_PAGE == PER_PAGE - 1) & (i % PRODUCTS == 0)
    block = _html(
        '<div itemprop="name" class="Grid">Title, {i} </div>'
        '<div class="stars stars-small"><span alt="Average Rating: {rating} out of 5"></span></div>'
        '<div class="review-body-text">{text}</div>{date}',
        i=i,
        rating=F.col("rating").cast("int"),
        text=_escaped(F.col("comment")),
        date=F.when(last, "").otherwise(
            _html('<span itemprop="datePublished">{d}</span>', d=F.date_format("date", "MMMM d, yyyy"))
        ),
    )
    head = _html(
        '<div class="product-summary-wrapper"><a href="#"><h1><div><div>Product, {p}</div></div></h1></a></div>',
        p=F.col("product"),
    )
    return _paged(reviews(spark, sf).withColumn("block", block), head, F.lit(""))


def walmart_products(spark: SparkSession, sf: str) -> DataFrame:
    """Product pages; one product in nine has no brand on its page."""
    product = (F.col("review_id") % PRODUCTS).alias("product")
    rows = reviews(spark, sf).select(product).distinct()
    brand = _html('<span itemprop="brand" content="x">brand{b}</span>', b=F.col("product") % 3)
    return rows.select(
        F.concat(F.lit("P"), F.col("product").cast("string")).alias("key"),
        F.concat(F.lit("<div>"), F.when(F.col("product") == 8, "").otherwise(brand), F.lit("</div>")).alias("html"),
    )
