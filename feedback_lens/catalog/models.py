"""Topic rows on given model tables, coherence, and the fitted models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedback_lens.catalog import fixtures as fx
from feedback_lens.catalog.registry import query, sql, view
from feedback_lens.catalog.views import SEG
from feedback_lens.operators import rows as rw
from feedback_lens.operators.bow import attach_idf, bow, count_vectors, idf_table
from feedback_lens.operators.coherence import cv_coherence, embedding_coherence, keyword_pairs
from feedback_lens.operators.segments import polarity
from feedback_lens.operators.topics import kmeans as km
from feedback_lens.operators.topics import lda, lsa
from feedback_lens.operators.topics.engine import chunk_docs, initial_state
from feedback_lens.plans import topics as tp
from feedback_lens.plans.prepare import clean_legacy, cv_tokens, prepare, raw_words
from feedback_lens.schema import TOPIC_SEGMENT
from feedback_lens.session import cut_lineage

NORMALISED = f"keyword_weight / sum(keyword_weight) OVER (PARTITION BY {SEG}, topic)"

view(
    "dominant",
    f"""SELECT {SEG}, review_id, arg_max(topic, (round(p, 2), -topic)) AS topic FROM doc_topics GROUP BY {SEG}, review_id""",
    "doc_topics",
)
view(
    "frequency",
    f"""SELECT k.*, coalesce(d.n, 0) AS topic_frequency FROM (SELECT DISTINCT {SEG}, topic FROM keywords) k
    LEFT JOIN (SELECT {SEG}, topic, count(*) AS n FROM dominant GROUP BY ALL) d USING ({SEG}, topic)""",
    "keywords dominant",
)
view("mass", f"SELECT {SEG}, topic, sum(keyword_weight) AS mass FROM normal GROUP BY ALL", "normal")
view(
    "normal",
    f"""SELECT {SEG}, topic, rank, keyword, keyword_weight / total AS keyword_weight FROM keywords
    JOIN (SELECT {SEG}, topic, sum(weight) AS total FROM topic_term GROUP BY ALL) USING ({SEG}, topic)""",
    "keywords topic_term",
)
view(
    "vector_coherence",
    f"""SELECT k.*, coalesce(c.coherence, 0) AS coherence FROM (SELECT DISTINCT {SEG}, topic FROM keywords) k LEFT JOIN (
      SELECT {', '.join('a.' + c for c in SEG.split(', '))}, a.topic,
      avg(list_cosine_similarity(x.vec::DOUBLE[], y.vec::DOUBLE[])) AS coherence FROM keywords a
      JOIN keywords b ON (a.review_type, a.year_quarter, a.brand, a.topic) = (b.review_type, b.year_quarter, b.brand, b.topic)
        AND a.keyword <> b.keyword
      JOIN word_vectors x ON x.word = a.keyword JOIN word_vectors y ON y.word = b.keyword GROUP BY ALL) c
    USING ({SEG}, topic)""",
    "keywords word_vectors",
)

# c_v by brute force: every sliding window that holds a keyword.
view(
    "cv_lengths",
    f"SELECT {SEG}, review_id, len(ws) AS len, greatest(len(ws) - 110, 0) AS last FROM seg_docs",
    "seg_docs",
)
view("cv_windows", f"SELECT {SEG}, sum(CASE WHEN len > 0 THEN last + 1 ELSE 0 END) AS n_windows FROM cv_lengths GROUP BY ALL", "cv_lengths")
view(
    "cv_hits",
    f"""SELECT DISTINCT {SEG}, review_id, w, unnest(range(greatest(pos - 109, 0), least(pos, last) + 1)) AS win
    FROM seg_tokens JOIN cv_lengths USING ({SEG}, review_id) SEMI JOIN keywords k
      ON (k.review_type, k.year_quarter, k.brand, k.keyword) = (seg_tokens.review_type, seg_tokens.year_quarter, seg_tokens.brand, seg_tokens.w)""",
    "seg_tokens cv_lengths keywords",
)
view(
    "cv_together",
    f"""SELECT {', '.join('x.' + c for c in SEG.split(', '))}, x.w AS a, y.w AS b, count(*) AS n FROM cv_hits x
    JOIN cv_hits y ON x.review_id = y.review_id AND x.win = y.win GROUP BY ALL""",
    "cv_hits",
)
view(
    "cv_npmi",
    f"""SELECT {SEG}, topic, a, b, coalesce(ln(s) / -ln(j), 0) AS x FROM (SELECT g.*, coalesce(t.n, 0) / w.n_windows + 1e-12 AS j,
      (coalesce(t.n, 0) / w.n_windows + 1e-12) / ((p.n / w.n_windows) * (q.n / w.n_windows)) AS s
      FROM (SELECT k.review_type, k.year_quarter, k.brand, k.topic, k.keyword AS a, l.keyword AS b FROM keywords k JOIN keywords l
        ON (k.review_type, k.year_quarter, k.brand, k.topic) = (l.review_type, l.year_quarter, l.brand, l.topic)) g
      JOIN cv_windows w USING ({SEG}) LEFT JOIN cv_together t USING ({SEG}, a, b)
      LEFT JOIN (SELECT {SEG}, a, n FROM cv_together WHERE a = b) p USING ({SEG}, a)
      LEFT JOIN (SELECT {SEG}, b, n FROM cv_together WHERE a = b) q USING ({SEG}, b))""",
    "keywords cv_windows cv_together",
)
view(
    "cv_scores",
    f"""SELECT {SEG}, topic, avg(c) AS coherence FROM (SELECT {SEG}, topic, a, list_cosine_similarity(list(x ORDER BY b), list(s ORDER BY b)) AS c
    FROM (SELECT *, sum(x) OVER (PARTITION BY {SEG}, topic, b) AS s FROM cv_npmi) GROUP BY {SEG}, topic, a) GROUP BY ALL""",
    "cv_npmi",
)


def keywords(spark: SparkSession, sf: str) -> DataFrame:
    return rw.top_keywords(fx.topic_term(spark, sf), n=10)


def _shares(spark: SparkSession, sf: str) -> DataFrame:
    """Keywords weighted by their share of the whole topic, the scale on which masses are compared."""
    total = fx.topic_term(spark, sf).groupBy(*TOPIC_SEGMENT, "topic").agg(F.sum("weight").alias("total"))
    joined = keywords(spark, sf).join(total, [*TOPIC_SEGMENT, "topic"])
    return joined.withColumn("keyword_weight", F.col("keyword_weight") / F.col("total")).drop("total")


@query("W2 M9", sql("keywords", "SELECT * FROM keywords"))
def top_keywords(spark: SparkSession, sf: str) -> DataFrame:
    return keywords(spark, sf)


@query("A4", sql("keywords", f"SELECT {SEG}, topic, rank, keyword, round({NORMALISED}, 6) AS keyword_weight FROM keywords"))
def normalised_weights(spark: SparkSession, sf: str) -> DataFrame:
    return rw.normalise_weights(keywords(spark, sf)).withColumn("keyword_weight", F.round("keyword_weight", 6))


@query("A5", sql("mass", f"SELECT {SEG}, topic, round(mass, 6) AS mass FROM mass"))
def topic_masses(spark: SparkSession, sf: str) -> DataFrame:
    return rw.topic_mass(_shares(spark, sf)).withColumn("mass", F.round("mass", 6))


@query(
    "W3",
    sql("normal mass", f"""SELECT {SEG}, CAST(place AS INT) AS topic, rank, keyword, round(keyword_weight, 6) AS keyword_weight FROM normal JOIN (
    SELECT {SEG}, topic, row_number() OVER (PARTITION BY {SEG} ORDER BY round(mass, 9) DESC, topic) AS place FROM mass WHERE round(mass, 9) >= 0.2)
    USING ({SEG}, topic) WHERE place <= 2"""),
)
def shortlisted_topics(spark: SparkSession, sf: str) -> DataFrame:
    short = rw.shortlist_topics(_shares(spark, sf), k=2, min_mass=0.2)
    return short.select(*TOPIC_SEGMENT, "topic", "rank", "keyword", F.round("keyword_weight", 6).alias("keyword_weight"))


@query("W4", sql("dominant", "SELECT * FROM dominant"))
def dominant_topics(spark: SparkSession, sf: str) -> DataFrame:
    return rw.dominant_topic(fx.doc_topics(spark, sf))


@query("A3", sql("frequency", f"SELECT {SEG}, topic, topic_frequency FROM frequency"))
def topic_frequencies(spark: SparkSession, sf: str) -> DataFrame:
    return rw.topic_frequency(fx.doc_topics(spark, sf), keywords(spark, sf))


@query(
    "J1",
    sql("keywords seg_idf", f"""SELECT {SEG}, topic, keyword, round(coalesce(idf, 0), 6) AS keyword_idf FROM keywords k
    LEFT JOIN (SELECT {SEG}, term AS keyword, idf FROM seg_idf WHERE df <= 0.5 * n_docs) USING ({SEG}, keyword)"""),
)
def keyword_idf(spark: SparkSession, sf: str) -> DataFrame:
    joined = attach_idf(keywords(spark, sf), idf_table(fx.segment_docs(spark, sf), max_df=0.5))
    return joined.select(*TOPIC_SEGMENT, "topic", "keyword", F.round("keyword_idf", 6).alias("keyword_idf"))


@query(
    "J5",
    sql("keywords", f"""SELECT {', '.join('x.' + c for c in SEG.split(', '))}, x.topic, x.keyword AS a, y.keyword AS b FROM keywords x JOIN keywords y
    ON (x.review_type, x.year_quarter, x.brand, x.topic) = (y.review_type, y.year_quarter, y.brand, y.topic) AND x.keyword <> y.keyword"""),
)
def pairs_of_keywords(spark: SparkSession, sf: str) -> DataFrame:
    return keyword_pairs(keywords(spark, sf))


@query(
    "J10",
    sql("reviews_q", f"""SELECT {SEG}, CAST(k AS INT) AS k, CAST(d AS DOUBLE) AS decay, CAST(f AS INT) AS fold FROM (
    SELECT DISTINCT {SEG} FROM reviews_q WHERE review_type IS NOT NULL), (VALUES (2),(3),(4),(5)) AS a(k), (VALUES (0.5),(0.7),(0.9)) AS b(d),
    (VALUES (0),(1),(2)) AS c(f)"""),
)
def model_grid(spark: SparkSession, sf: str) -> DataFrame:
    segments = fx.segment_docs(spark, sf).select(*TOPIC_SEGMENT).distinct()
    return lda.expand_grid(segments, lda.TOPIC_COUNTS, lda.DECAYS)


@query("M6 A6 H3", sql("vector_coherence", f"SELECT {SEG}, topic, round(coherence, 6) AS coherence FROM vector_coherence"))
def coherence_by_vectors(spark: SparkSession, sf: str) -> DataFrame:
    scores = embedding_coherence(keywords(spark, sf), fx.word_vectors(spark, sf))
    return scores.withColumn("coherence", F.round("coherence", 6))


@query("M8", sql("cv_scores", f"SELECT {SEG}, topic, round(coherence, 6) AS coherence FROM cv_scores"))
def coherence_by_windows(spark: SparkSession, sf: str) -> DataFrame:
    scores = cv_coherence(keywords(spark, sf), fx.segment_docs(spark, sf))
    return scores.withColumn("coherence", F.round("coherence", 6))


@query(
    "M5",
    sql("keywords frequency seg_idf vector_coherence", f"""SELECT {SEG}, topic, topic_frequency, rank, keyword, round({NORMALISED}, 6) AS keyword_weight,
    round(coalesce(idf, 0), 6) AS keyword_idf, round(coherence, 6) AS coherence FROM keywords JOIN frequency USING ({SEG}, topic)
    JOIN vector_coherence USING ({SEG}, topic) LEFT JOIN (SELECT {SEG}, term AS keyword, idf FROM seg_idf) USING ({SEG}, keyword)"""),
)
def topic_result_rows(spark: SparkSession, sf: str) -> DataFrame:
    docs = fx.segment_docs(spark, sf)
    coherence = embedding_coherence(keywords(spark, sf), fx.word_vectors(spark, sf))
    table = rw.topic_rows(fx.topic_term(spark, sf), idf_table(docs), fx.doc_topics(spark, sf), coherence, n=10)
    return table.withColumns({c: F.round(c, 6) for c in ("keyword_weight", "keyword_idf", "coherence")})


@query(
    "R1",
    sql("keywords", f"""SELECT {SEG}, max(t1) AS topic_1, max(t2) AS topic_2, max(t3) AS topic_3 FROM (SELECT {SEG},
    CASE topic WHEN 1 THEN ks END AS t1, CASE topic WHEN 2 THEN ks END AS t2, CASE topic WHEN 3 THEN ks END AS t3 FROM (
    SELECT {SEG}, topic, string_agg(keyword, ', ' ORDER BY rank) AS ks FROM keywords GROUP BY ALL)) GROUP BY {SEG}"""),
)
def topics_side_by_side(spark: SparkSession, sf: str) -> DataFrame:
    return rw.wide_topics(keywords(spark, sf), TOPIC_SEGMENT, [1, 2, 3])


def _prepared(spark: SparkSession, sf: str, seg=TOPIC_SEGMENT) -> DataFrame:
    return prepare(fx.reviews(spark, sf), fx.lexicon(spark, sf), fx.stopwords(spark), seg, fx.YEARS)


def _legacy(spark: SparkSession, sf: str, spelling: bool = False) -> DataFrame:
    """Reviews as the older models take them: names of brands are stop words; with ``spelling``, words are corrected and numbers dropped."""
    strict = polarity(fx.reviews(spark, sf), "strict")
    brands = strict.select(F.lower("brand").alias("w")).distinct()
    known = fx.word_counts(spark, sf).filter("n >= 5") if spelling else None
    return clean_legacy(strict, fx.stopwords(spark).unionByName(brands), fx.lexicon(spark, sf), spelling=known, drop_digits=spelling)


@query("M1 M4")
def lda_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Topic shares of every review under a three-topic model per segment."""
    prepared = cut_lineage(_prepared(spark, sf))
    docs, state = lda.fit_lda(count_vectors(cv_tokens(prepared), stop=fx.stopwords(spark)), 3)
    return tp.complete_shares(lda.infer_topics(docs, state), prepared)


@query("M2 M3")
def lda_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Held-out perplexity of the twelve grid points in every segment, averaged over three folds."""
    counts = count_vectors(cv_tokens(_prepared(spark, sf)), stop=fx.stopwords(spark))
    return lda.grid_scores(counts)


@query("M3 M5 M6 S5")
def lda_report(spark: SparkSession, sf: str) -> DataFrame:
    """Grid-searched topics of every segment with frequency, IDF and vector coherence."""
    return tp.lda_topics(_prepared(spark, sf), fx.word_vectors(spark, sf), fx.stopwords(spark))


@query("M7 M8 W3")
def hdp_report(spark: SparkSession, sf: str) -> DataFrame:
    """Shortlisted HDP topics of every segment with ``c_v`` coherence."""
    return tp.hdp_table(_prepared(spark, sf), stop=fx.stopwords(spark))


@query("M10")
def lsa_report(spark: SparkSession, sf: str) -> DataFrame:
    return tp.lsa_table(_legacy(spark, sf))


# One multiplication on given vectors: their Rayleigh quotient and how far they are from a singular vector.
view("km_points", "SELECT review_type, brand, review_id, w AS term, CAST(count(*) AS DOUBLE) AS x FROM seg_tokens GROUP BY ALL", "seg_tokens")
view(
    "lsa_image",
    """SELECT review_type, brand, term, 1.0 + length(term) % 3 AS v, sum(x * s) AS b FROM km_points JOIN (
      SELECT review_type, brand, review_id, sum(x * (1.0 + length(term) % 3)) AS s FROM km_points GROUP BY ALL)
    USING (review_type, brand, review_id) GROUP BY ALL""",
    "km_points",
)


@query(
    "M10",
    sql(
        "lsa_image",
        """SELECT review_type, brand, round(sqrt(theta), 6) AS sigma, round(sqrt(sum((b - theta * v) * (b - theta * v)) / sum(v * v)) / theta, 6) AS residual
        FROM lsa_image JOIN (SELECT review_type, brand, sum(b * v) / sum(v * v) AS theta FROM lsa_image GROUP BY ALL) USING (review_type, brand)
        GROUP BY review_type, brand, theta""",
    ),
)
def lsa_residuals(spark: SparkSession, sf: str) -> DataFrame:
    """Singular value and residual that the stopping rule sees for one given vector per brand and polarity."""
    seg = ["review_type", "brand"]
    docs = chunk_docs(bow(fx.segment_docs(spark, sf), seg), seg)
    state = initial_state(docs, F.array(F.lit(1.0) + F.length("term") % 3))
    found = lsa.ritz(docs, state, lsa.power_step(docs, state), 1)
    first = [F.sqrt(F.get("theta", F.lit(0))), F.get("residual", F.lit(0))]
    return found.select(*seg, F.round(first[0], 6).alias("sigma"), F.round(first[1], 6).alias("residual"))


@query(
    "M15",
    sql(
        "seg_docs seg_tokens",
        f"""SELECT {SEG}, count(*) AS n_reviews FROM seg_docs ANTI JOIN (
        SELECT {SEG} FROM seg_tokens GROUP BY {SEG}, w HAVING count(DISTINCT review_id) >= 8) USING ({SEG}) GROUP BY ALL""",
    ),
)
def skipped_models(spark: SparkSession, sf: str) -> DataFrame:
    """Segments that give no model, as no term is in eight reviews, with their size."""
    docs = fx.segment_docs(spark, sf)
    return tp.skipped(docs, count_vectors(docs, min_df=8))


# k-means++ on word counts: draws by arithmetic, three centres, then the nearest centre of every review.
DRAW = "-ln(((review_id * 7919 + {step} * 104729) % 100003 + 0.5) / 100003)"
view("km_lengths", "SELECT review_type, brand, review_id, sum(x * x) AS length FROM km_points GROUP BY ALL", "km_points")
view(
    "km_first",
    f"""SELECT review_type, brand, min({{'key': {DRAW.format(step=0)}, 'review_id': review_id}}).review_id AS review_id FROM km_lengths GROUP BY ALL""",
    "km_lengths",
)


def _km_gaps(centre: str) -> str:
    return f"""SELECT l.review_type, l.brand, l.review_id, l.length + c.length - 2 * coalesce(o.overlap, 0) AS gap FROM km_lengths l
      JOIN {centre} f ON (f.review_type, f.brand) = (l.review_type, l.brand) JOIN km_lengths c
        ON (c.review_type, c.brand, c.review_id) = (f.review_type, f.brand, f.review_id)
      LEFT JOIN (SELECT p.review_type, p.brand, p.review_id, sum(p.x * q.x) AS overlap FROM km_points p JOIN {centre} f
        ON (f.review_type, f.brand) = (p.review_type, p.brand) JOIN km_points q ON (q.review_type, q.brand, q.review_id, q.term) =
        (f.review_type, f.brand, f.review_id, p.term) GROUP BY ALL) o
        ON (o.review_type, o.brand, o.review_id) = (l.review_type, l.brand, l.review_id)"""


view("km_gap1", _km_gaps("km_first"), "km_lengths km_first km_points")
view(
    "km_second",
    f"SELECT review_type, brand, min({{'key': {DRAW.format(step=1)} / gap, 'review_id': review_id}}).review_id AS review_id FROM km_gap1 WHERE gap > 0 GROUP BY ALL",
    "km_gap1",
)
view("km_gap2", _km_gaps("km_second"), "km_lengths km_second km_points")
view(
    "km_third",
    f"""SELECT review_type, brand, min({{'key': {DRAW.format(step=2)} / least(a.gap, b.gap), 'review_id': review_id}}).review_id AS review_id
    FROM km_gap1 a JOIN km_gap2 b USING (review_type, brand, review_id) WHERE least(a.gap, b.gap) > 0 GROUP BY ALL""",
    "km_gap1 km_gap2",
)
view("km_gap3", _km_gaps("km_third"), "km_lengths km_third km_points")


@query(
    "M11 O2",
    sql(
        "km_gap1 km_gap2 km_gap3",
        """SELECT review_type, brand, review_id, CAST(CASE WHEN a.gap <= b.gap AND a.gap <= c.gap THEN 1 WHEN b.gap <= c.gap THEN 2 ELSE 3 END AS INT) AS topic,
        least(a.gap, b.gap, c.gap) AS gap FROM km_gap1 a JOIN km_gap2 b USING (review_type, brand, review_id)
        JOIN km_gap3 c USING (review_type, brand, review_id)""",
    ),
)
def kmeans_seeds(spark: SparkSession, sf: str) -> DataFrame:
    """Nearest of three k-means++ centres, for every review with words; ties go to the earlier centre."""
    seg = ["review_type", "brand"]
    docs = chunk_docs(bow(fx.segment_docs(spark, sf), seg), seg)
    state = km.first_centres(docs, 3, lambda step: F.expr(DRAW.format(step=step)))
    return km.cluster_gaps(docs, state)


@query("M11 O2")
def kmeans_report(spark: SparkSession, sf: str) -> DataFrame:
    words = raw_words(polarity(fx.reviews(spark, sf), "strict"))
    return tp.kmeans_table(words, fx.stopwords(spark))


@query("M12 M13 M8")
def fixed_lda_report(spark: SparkSession, sf: str) -> DataFrame:
    """Topics for two to five topics per brand and polarity out of corrected words, with the coherence of each model."""
    return tp.fixed_lda_table(_legacy(spark, sf, spelling=True))


@query("M14")
def lda_by_quarter(spark: SparkSession, sf: str) -> DataFrame:
    docs = _prepared(spark, sf, ["year_quarter"])
    return tp.lda_topics(docs, None, fx.stopwords(spark), ["year_quarter"])
