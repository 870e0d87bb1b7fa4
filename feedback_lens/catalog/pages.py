"""Page extraction and field normalisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedback_lens.catalog import fixtures as fx
from feedback_lens.catalog.registry import query, sql, view
from feedback_lens.functions import normalize as nz
from feedback_lens.operators import pages as pg
from feedback_lens.operators.segments import union_reviews
from feedback_lens.plans.corpus import AMAZON, BEST_BUY, WALMART, ShopJob, shop_job, shop_reviews
from feedback_lens.session import written

LINK = r'href="/([^"]+)"'
TAIL = "regexp_extract(regexp_replace(regexp_replace(regexp_replace(url, '[?#].*$', ''), '/$', ''), '\\.[a-z]+$', ''), '([^/]+)$', 1)"
LINKS = f"""SELECT page_id, CAST(generate_subscripts(ks, 1) - 1 AS INT) AS pos, unnest(ks) AS key FROM (
    SELECT page_id, regexp_extract_all(html, '{LINK}', 1) AS ks FROM pages)"""
TITLE = r"<title>([\s\S]*?)</title>"
HEADING = r"<h1[^>]*>([\s\S]*?)</h1>"
ARTICLE = r"<article>([\s\S]*?)</article>"


# The references that the given pages hold.
REFERENCES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def _plain_sql(expr: str) -> str:
    out = f"regexp_replace({expr}, '<[^>]*>', '', 'g')"
    for reference, plain in REFERENCES:
        quoted = plain.replace("'", "''")
        out = f"replace({out}, '{reference}', '{quoted}')"
    return out


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    return fx.table(spark, sf, "pages")


def _tail_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Stored pages under the last part of their link."""
    return _raw(spark, sf).select("page_id", pg.url_tail(F.col("url"), 1).alias("key"), "html")


@query("X1", sql("", LINKS))
def keys_from_links(spark: SparkSession, sf: str) -> DataFrame:
    return pg.extract_keys(_raw(spark, sf), LINK)


@query(
    "X1",
    sql("", f"""SELECT page_id, {TAIL} AS last_part,
    regexp_extract(regexp_replace(regexp_replace(regexp_replace(url, '[?#].*$', ''), '/$', ''), '\\.[a-z]+$', ''), '([^/]+/[^/]+)$', 1) AS last_two FROM pages"""),
)
def keys_from_urls(spark: SparkSession, sf: str) -> DataFrame:
    url = F.col("url")
    return _raw(spark, sf).select(
        "page_id", pg.url_tail(url, 1).alias("last_part"), pg.url_tail(url, 2).alias("last_two")
    )


@query(
    "X2",
    sql("", f"""SELECT key, page_id, pos FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY page_id, pos) AS rn
    FROM ({LINKS})) WHERE rn = 1"""),
)
def first_keys(spark: SparkSession, sf: str) -> DataFrame:
    return pg.dedupe_keys(pg.extract_keys(_raw(spark, sf), LINK))


@query(
    "X3 U3",
    sql("", f"""SELECT page_id, {TAIL} AS key FROM pages WHERE {TAIL} NOT IN (
    SELECT {TAIL} FROM pages WHERE html LIKE '%lang="fr"%')"""),
)
def live_keys(spark: SparkSession, sf: str) -> DataFrame:
    tails = _tail_pages(spark, sf)
    return pg.drop_dead(tails.select("page_id", "key"), tails, 'lang="fr"').select("page_id", "key")


@query(
    "X4",
    sql("reviews", "SELECT 'P' || CAST(review_id % 9 AS VARCHAR) AS key, CAST(max(review_id // 180) + 1 AS INT) AS last_page FROM reviews GROUP BY 1"),
)
def last_pages(spark: SparkSession, sf: str) -> DataFrame:
    return pg.last_page(fx.amazon_pages(spark, sf), AMAZON.page_number)


@query(
    "X5",
    sql("", f"""SELECT page_id, nullif(trim({_plain_sql(f"regexp_extract(html, '{TITLE}', 1)")}), '') AS title,
    nullif(trim({_plain_sql(f"regexp_extract(html, '{HEADING}', 1)")}), '') AS heading FROM pages"""),
)
def page_attributes(spark: SparkSession, sf: str) -> DataFrame:
    return pg.extract_attrs(_raw(spark, sf), {"title": TITLE, "heading": HEADING})


@query("X10", sql("", f"""SELECT page_id, {_plain_sql(f"regexp_extract(html, '{ARTICLE}', 1)")} AS body FROM pages"""))
def article_text(spark: SparkSession, sf: str) -> DataFrame:
    body = F.regexp_extract("html", ARTICLE, 1)
    return _raw(spark, sf).select("page_id", nz.strip_tags(body).alias("body"))


COLUMNS = ["source", "name", "brand", "rating", "comment", "date", "usefulness"]


def _shown(df: DataFrame) -> DataFrame:
    return df.select(*COLUMNS).withColumn("date", F.col("date").cast("string"))


AMAZON_SQL = """SELECT 'Amazon' AS source, 'Product ' || CAST(review_id % 9 AS VARCHAR) AS name,
    'brand' || CAST(review_id % 9 % 3 AS VARCHAR) AS brand, rating,
    'Title ' || CAST(review_id AS VARCHAR) || ' Body ' || comment AS comment, CAST(date AS VARCHAR) AS date,
    CAST(CASE usefulness WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 1200 + usefulness END AS INT) AS usefulness
    FROM reviews WHERE review_id % 50 <> 0"""
BEST_BUY_SQL = """SELECT 'Best Buy' AS source, brand || ' - Product ' || CAST(review_id % 9 AS VARCHAR) AS name, brand, rating,
    replace(comment, chr(10) || chr(10), '') AS comment, CAST(CAST(CASE review_id % 4
      WHEN 0 THEN DATE '2018-12-31' - to_days(CAST(review_id % 11 + 1 AS INT))
      WHEN 1 THEN DATE '2018-12-31' - to_days(CAST(7 * (review_id % 11 + 1) AS INT))
      WHEN 2 THEN DATE '2018-12-31' - to_months(CAST(review_id % 11 + 1 AS INT))
      ELSE DATE '2018-12-31' - to_years(CAST(review_id % 11 + 1 AS INT)) END AS DATE) AS VARCHAR) AS date, 0 AS usefulness
    FROM reviews WHERE review_id % 50 <> 0"""
WALMART_SQL = """SELECT 'Walmart' AS source, 'Product ' || CAST(review_id % 9 AS VARCHAR) AS name, brand, rating,
    'Title/ ' || CAST(review_id AS VARCHAR) || ' ' || replace(replace(comment, chr(10), ''), ',', '/') AS comment,
    CAST(date AS VARCHAR) AS date, 0 AS usefulness
    FROM reviews WHERE NOT ((review_id // 9) % 20 = 19 AND review_id % 9 = 0) AND review_id % 9 <> 8"""


@query("X7 X5 N1 N2 N3 N5 N6 N8 X9", sql("reviews", AMAZON_SQL))
def block_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(shop_reviews(fx.amazon_pages(spark, sf), AMAZON))


@query("X7 X5 N1 N4 N5 N7 N8", sql("reviews", BEST_BUY_SQL))
def dated_back_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(shop_reviews(fx.bestbuy_pages(spark, sf), BEST_BUY, F.lit(fx.CRAWL_DATE).cast("date")))


@query("X8 X6 N1 N3 N5 N6 N8", sql("reviews", WALMART_SQL))
def zipped_reviews(spark: SparkSession, sf: str) -> DataFrame:
    pages, products = fx.walmart_pages(spark, sf), fx.walmart_products(spark, sf)
    return _shown(shop_reviews(pages, WALMART, product_pages=products))


@query(
    "S9 U1 X9",
    sql("reviews", f"SELECT source, brand, count(*) AS n, sum(rating) AS stars, CAST(sum(length(comment)) AS BIGINT) AS chars FROM ({AMAZON_SQL} UNION ALL {BEST_BUY_SQL} UNION ALL {WALMART_SQL}) GROUP BY ALL"),
)
def corpus_of_three_shops(spark: SparkSession, sf: str) -> DataFrame:
    both = union_reviews(
        shop_reviews(fx.amazon_pages(spark, sf), AMAZON),
        shop_reviews(fx.bestbuy_pages(spark, sf), BEST_BUY, F.lit(fx.CRAWL_DATE).cast("date")),
        shop_reviews(fx.walmart_pages(spark, sf), WALMART, product_pages=fx.walmart_products(spark, sf)),
    )
    return both.groupBy("source", "brand").agg(
        F.count(F.lit(1)).alias("n"), F.sum("rating").alias("stars"), F.sum(F.length("comment")).alias("chars")
    )


view(
    "listed",
    "SELECT CASE WHEN review_id % 9 = 7 THEN 'Q7' ELSE 'P' || CAST(review_id % 9 AS VARCHAR) END AS key FROM reviews WHERE review_id % 10 = 0",
    "reviews",
)
view(
    "job_pages",
    """SELECT 'P' || CAST(review_id % 9 AS VARCHAR) AS key, review_id // 180 AS page, count(*) AS n, count(*) FILTER (review_id % 50 = 0) AS bad,
    'P' || CAST(review_id % 9 AS VARCHAR) IN (SELECT key FROM listed WHERE key <> 'P4') AS live FROM reviews GROUP BY ALL""",
    "reviews listed",
)


def _amazon_job(spark: SparkSession, sf: str) -> ShopJob:
    stored = (fx.amazon_search_pages(spark, sf), fx.amazon_product_pages(spark, sf), fx.amazon_pages(spark, sf))
    return shop_job(*stored, AMAZON, fx.NOT_FOUND)


@query(
    "X1 X2 X3 X4 X9",
    sql("listed job_pages", """SELECT 'keys_found' AS step, count(*) AS n FROM listed
    UNION ALL SELECT 'keys_distinct', count(DISTINCT key) FROM listed
    UNION ALL SELECT 'keys_dead', count(DISTINCT key) FROM listed WHERE key = 'P4'
    UNION ALL SELECT 'keys_without_pages', count(DISTINCT key) FROM listed WHERE key NOT IN (SELECT key FROM job_pages)
    UNION ALL SELECT 'keys_with_missing_pages', count(*) FROM (SELECT key FROM job_pages WHERE live GROUP BY key HAVING count(*) < max(page) + 1)
    UNION ALL SELECT 'pages_read', count(*) FROM job_pages WHERE live
    UNION ALL SELECT 'pages_left_out', count(*) FROM job_pages WHERE NOT live
    UNION ALL SELECT 'reviews_seen', CAST(coalesce(sum(n), 0) AS BIGINT) FROM job_pages WHERE live
    UNION ALL SELECT 'reviews_rejected', CAST(coalesce(sum(bad), 0) AS BIGINT) FROM job_pages WHERE live
    UNION ALL SELECT 'reviews_kept', CAST(coalesce(sum(n - bad), 0) AS BIGINT) FROM job_pages WHERE live"""),
)
def shop_job_counts(spark: SparkSession, sf: str) -> DataFrame:
    """What became of keys, pages and reviews between the search pages and the corpus."""
    return _amazon_job(spark, sf).counts


@query(
    "X1 X2 X3 X7 S9",
    sql("reviews listed", AMAZON_SQL + " AND 'P' || CAST(review_id % 9 AS VARCHAR) IN (SELECT key FROM listed WHERE key <> 'P4')"),
)
def shop_job_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(_amazon_job(spark, sf).reviews)


@query("X6", sql("reviews", """SELECT review_id, CASE WHEN review_id % 9 = 8 THEN NULL ELSE brand END AS brand FROM reviews"""))
def brand_from_product_page(spark: SparkSession, sf: str) -> DataFrame:
    keyed = fx.reviews(spark, sf).select(
        "review_id", F.concat(F.lit("P"), (F.col("review_id") % 9).cast("string")).alias("key"), "brand"
    )
    return pg.attach_brand(keyed, fx.walmart_products(spark, sf), WALMART.brand).select("review_id", "brand")


@query(
    "X9",
    sql("reviews", """SELECT count(*) AS seen, count(*) FILTER (review_id % 50 = 0) AS rejected,
    count(*) FILTER (review_id % 50 <> 0) AS kept FROM reviews"""),
)
def rejected_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = pg.read_blocks(fx.amazon_pages(spark, sf), AMAZON.block, AMAZON.fields)
    rated = written(rows.select(nz.parse_rating(F.col("rating_text")).alias("rating"))).df  # counted twice below
    bad = F.col("rating").isNull()
    kept = pg.valid_rows(rated, ["rating"]).agg(F.count(F.lit(1)).alias("kept")).withColumn("one", F.lit(1))
    seen = rated.agg(F.count(F.lit(1)).alias("seen"), F.count_if(bad).alias("rejected")).withColumn("one", F.lit(1))
    return seen.join(kept, "one").drop("one")


@query(
    "N1",
    sql("reviews", """SELECT review_id, CASE WHEN review_id % 50 = 0 THEN NULL ELSE rating END AS amazon,
    rating AS best_buy, rating AS walmart FROM reviews"""),
)
def ratings_from_text(spark: SparkSession, sf: str) -> DataFrame:
    stars = F.col("rating").cast("int").cast("string")
    first = F.when(F.col("review_id") % 50 == 0, "no stars").otherwise(F.concat(stars, F.lit(".0 out of 5 stars")))
    return fx.reviews(spark, sf).select(
        "review_id",
        nz.parse_rating(first).alias("amazon"),
        nz.parse_rating(F.concat(F.lit("Rating: "), stars, F.lit(" out of 5 stars"))).alias("best_buy"),
        nz.parse_rating(F.concat(F.lit("Average Rating: "), stars, F.lit(" out of 5")), "Walmart").alias("walmart"),
    )


@query(
    "N2",
    sql("reviews", "SELECT review_id, CAST(CASE usefulness WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 1000 + review_id ELSE 3 END AS INT) AS votes FROM reviews"),
)
def votes_from_text(spark: SparkSession, sf: str) -> DataFrame:
    u = F.col("usefulness")
    text = (
        F.when(u == 1, "One person found this helpful")
        .when(u == 2, F.concat(F.format_number(F.col("review_id") + 1000, 0), F.lit(" people found this helpful")))
        .when(u == 3, "3 people found this helpful")
    )
    return fx.reviews(spark, sf).select("review_id", nz.parse_usefulness(text).alias("votes"))


@query(
    "N3",
    sql("reviews", "SELECT review_id, CASE WHEN review_id % 5 = 4 THEN NULL ELSE CAST(date AS VARCHAR) END AS parsed FROM reviews"),
)
def dates_from_text(spark: SparkSession, sf: str) -> DataFrame:
    d = F.col("date")
    layouts = ["MMMM d, yyyy", "MMMM d yyyy", "yyyy-MM-dd", "M/d/yyyy", "d MMM"]
    text = F.element_at(F.array(*[F.date_format(d, x) for x in layouts]), (F.col("review_id") % 5 + 1).cast("int"))
    text = F.when(F.col("review_id") % 2 == 0, F.concat(F.lit("on "), text)).otherwise(text)
    return fx.reviews(spark, sf).select("review_id", nz.parse_date(text).cast("string").alias("parsed"))


@query(
    "N4",
    sql("reviews", """SELECT review_id, CAST(CAST(CASE review_id % 4 WHEN 0 THEN date - to_days(CAST(review_id % 40 AS INT))
    WHEN 1 THEN date - to_days(CAST(7 * (review_id % 40) AS INT)) WHEN 2 THEN date - to_months(CAST(review_id % 40 AS INT))
    ELSE date - to_years(CAST(review_id % 40 AS INT)) END AS DATE) AS VARCHAR) AS counted FROM reviews"""),
)
def dates_counted_back(spark: SparkSession, sf: str) -> DataFrame:
    units = F.array(F.lit("days"), F.lit("weeks"), F.lit("months"), F.lit("years"))
    unit = F.element_at(units, (F.col("review_id") % 4 + 1).cast("int"))
    text = F.concat((F.col("review_id") % 40).cast("string"), F.lit(" "), unit, F.lit(" ago"))
    return fx.reviews(spark, sf).select(
        "review_id", nz.parse_relative_date(text, F.col("date")).cast("string").alias("counted")
    )


@query(
    "N5",
    sql("reviews", """SELECT review_id, name || ', ' || brand || ' ' || comment AS amazon, replace(comment, chr(10) || chr(10), '') AS best_buy,
    replace(name || ', ' || brand, ',', '/') || replace(replace(comment, chr(10), ''), ',', '/') AS walmart FROM reviews"""),
)
def composed_comments(spark: SparkSession, sf: str) -> DataFrame:
    title = F.concat("name", F.lit(", "), "brand")
    return fx.reviews(spark, sf).select(
        "review_id",
        nz.compose_comment(title, F.col("comment")).alias("amazon"),
        nz.compose_comment(title, F.col("comment"), "Best Buy").alias("best_buy"),
        nz.compose_comment(title, F.col("comment"), "Walmart").alias("walmart"),
    )


@query(
    "N6 N7 N8",
    sql("reviews", """SELECT review_id, name || ', new' AS cleaned, name || ' new' AS without_commas, brand AS first_part,
    'Best Buy' AS source, CAST(0 AS INT) AS usefulness FROM reviews"""),
)
def cleaned_names(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.concat(F.lit("\n  "), "name", F.lit(", new\n"))
    df = fx.reviews(spark, sf).select(
        "review_id",
        nz.clean_name(raw).alias("cleaned"),
        nz.clean_name(raw, drop_commas=True).alias("without_commas"),
        nz.brand_from_name(F.concat("brand", F.lit(" - "), "name")).alias("first_part"),
    )
    return nz.with_source(df, "Best Buy")
