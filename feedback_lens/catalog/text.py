"""Tokens, collocations, lemmas, counts and spelling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedback_lens.catalog import fixtures as fx
from feedback_lens.catalog.registry import query, sql, view
from feedback_lens.catalog.views import SEG, pieces, similarity_tokens
from feedback_lens.functions import tokens as tk
from feedback_lens.operators import bow as bw
from feedback_lens.operators import lexicon as lx
from feedback_lens.operators.collocations import merge_bigrams, score_bigrams
from feedback_lens.operators.phrases import PATTERNS, match_phrases
from feedback_lens.operators.spelling import correct_spelling, correction_table
from feedback_lens.plans.prepare import clean_legacy, cv_tokens, prepare, raw_words
from feedback_lens.schema import TOPIC_SEGMENT


def _every(rows: str, docs: str = "token_docs") -> str:
    """All reviews of ``docs`` with their joined tokens out of ``rows``."""
    return f"SELECT review_id, coalesce(tokens, '') AS tokens FROM (SELECT review_id FROM {docs}) LEFT JOIN ({rows}) USING (review_id)"


def _joined(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys, F.array_join("tokens", " ").alias("tokens"))


@query("E1", sql("token_docs", "SELECT review_id, array_to_string(ws, ' ') AS tokens FROM token_docs"))
def topic_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return _joined(fx.token_docs(spark, sf), "review_id")


@query(
    "E2",
    sql("reviews", f"""SELECT review_id, array_to_string({similarity_tokens('comment')}, ' ') AS tokens,
    array_to_string({pieces(similarity_tokens('comment'))}, ' ') AS pieces FROM reviews"""),
)
def similarity_words(spark: SparkSession, sf: str) -> DataFrame:
    words = tk.tokenize_similarity(F.col("comment"))
    return fx.reviews(spark, sf).select(
        "review_id",
        F.array_join(words, " ").alias("tokens"),
        F.array_join(tk.split_punctuation(words), " ").alias("pieces"),
    )


view(
    "legacy_words",
    """SELECT review_id, pos, CASE WHEN l.pos_tag = 'N' OR l.pos_tag IS NULL THEN coalesce(l.lemma, t.w) ELSE t.w END AS w FROM (
       SELECT review_id, pos, regexp_replace(w, '[!-/:-@\\[-`{-~]', '', 'g') AS w FROM (
         SELECT review_id, generate_subscripts(ws, 1) AS pos, unnest(ws) AS w FROM (SELECT review_id,
         string_split(trim(regexp_replace(lower(comment), '\\s+', ' ', 'g')), ' ') AS ws FROM reviews))
       WHERE w NOT IN (SELECT w FROM stopwords)) t
       LEFT JOIN (SELECT w, pos AS pos_tag, lemma FROM lexicon) l ON l.w = t.w WHERE t.w <> ''""",
    "reviews stopwords lexicon",
)


@query(
    "E3 E9",
    sql("reviews legacy_words", """SELECT r.review_id, coalesce(string_agg(w, ' ' ORDER BY pos), '') AS tokens FROM reviews r
    LEFT JOIN legacy_words l ON l.review_id = r.review_id GROUP BY r.review_id"""),
)
def legacy_tokens(spark: SparkSession, sf: str) -> DataFrame:
    docs = clean_legacy(fx.reviews(spark, sf), fx.stopwords(spark), fx.lexicon(spark, sf), keep=[])
    return _joined(docs, "review_id")


@query(
    "E4",
    sql("seg_docs", "SELECT review_id, array_to_string(regexp_extract_all(lower(array_to_string(ws, '_')), '[a-z0-9]{3,}'), ' ') AS tokens FROM seg_docs"),
)
def vectoriser_tokens(spark: SparkSession, sf: str) -> DataFrame:
    docs = fx.segment_docs(spark, sf).withColumn("tokens", F.array(F.array_join("tokens", "_")))
    return _joined(cv_tokens(docs), "review_id")


@query("E5", sql("seg_bigrams", f"SELECT {SEG}, a, b, n_ab, round(score, 6) AS score FROM seg_bigrams"))
def collocations(spark: SparkSession, sf: str) -> DataFrame:
    found = score_bigrams(fx.segment_docs(spark, sf), TOPIC_SEGMENT)
    return found.withColumn("score", F.round("score", 6))


@query("E6", sql("seg_docs seg_merged", _every("SELECT review_id, string_agg(w, ' ' ORDER BY pos) AS tokens FROM seg_merged GROUP BY review_id", "seg_docs")))
def merged_collocations(spark: SparkSession, sf: str) -> DataFrame:
    docs = fx.segment_docs(spark, sf)
    merged = merge_bigrams(docs, score_bigrams(docs, TOPIC_SEGMENT), TOPIC_SEGMENT)
    return _joined(merged, "review_id")


@query(
    "E7 J8",
    sql("token_docs tokens lexicon", _every("""SELECT review_id, string_agg(lemma, ' ' ORDER BY t.pos) AS tokens FROM tokens t
    JOIN (SELECT w, pos AS tag, lemma FROM lexicon) l USING (w) WHERE tag IN ('N','A','V','R') AND lemma <> '-PRON-' GROUP BY review_id""")),
)
def content_lemmas(spark: SparkSession, sf: str) -> DataFrame:
    lemmas = lx.lemmatize(fx.tokens(spark, sf), fx.lexicon(spark, sf))
    return _joined(lx.gather_tokens(lemmas, word="lemma", base=fx.token_docs(spark, sf)), "review_id")


@query(
    "E8 J8",
    sql("token_docs tokens lexicon", _every("""SELECT review_id, string_agg(lemma, ' ' ORDER BY t.pos) AS tokens FROM tokens t
    JOIN (SELECT w, lemma FROM lexicon) l USING (w) WHERE lemma <> '-PRON-' GROUP BY review_id""")),
)
def all_lemmas(spark: SparkSession, sf: str) -> DataFrame:
    lemmas = lx.lemmatize(fx.tokens(spark, sf), fx.lexicon(spark, sf), keep_pos=None)
    return _joined(lx.gather_tokens(lemmas, word="lemma", base=fx.token_docs(spark, sf)), "review_id")


@query(
    "E9",
    sql("token_docs tokens lexicon", _every("""SELECT review_id, string_agg(CASE WHEN tag = 'N' THEN lemma ELSE w END, ' ' ORDER BY t.pos) AS tokens
    FROM tokens t JOIN (SELECT w, pos AS tag, lemma FROM lexicon) l USING (w) GROUP BY review_id""")),
)
def noun_lemmas(spark: SparkSession, sf: str) -> DataFrame:
    lemmas = lx.lemmatize(fx.tokens(spark, sf), fx.lexicon(spark, sf), keep_pos=None, mode="noun")
    return _joined(lx.gather_tokens(lemmas.drop("w"), word="lemma", base=fx.token_docs(spark, sf)), "review_id")


@query(
    "J2 E11",
    sql("token_docs tokens stopwords", _every("SELECT review_id, string_agg(w, ' ' ORDER BY pos) AS tokens FROM tokens WHERE w NOT IN (SELECT w FROM stopwords) GROUP BY review_id")),
)
def without_stopwords(spark: SparkSession, sf: str) -> DataFrame:
    kept = lx.remove_stopwords(fx.tokens(spark, sf), fx.stopwords(spark))
    return _joined(lx.gather_tokens(kept, base=fx.token_docs(spark, sf)), "review_id")


@query(
    "E12 E8",
    sql("sim_words", "SELECT review_id, array_to_string(words, ' ') AS tokens, tags FROM sim_words"),
)
def similarity_lemmas(spark: SparkSession, sf: str) -> DataFrame:
    from feedback_lens.plans.similarity import cleaned_words, report_base

    words = cleaned_words(report_base(fx.reviews(spark, sf), fx.YEARS), fx.lexicon(spark, sf))
    return words.select("review_id", F.array_join("words", " ").alias("tokens"), "tags")




view("dictionary", "SELECT w, n FROM word_counts WHERE n >= 5", "word_counts")
view("misspelt", "SELECT w FROM word_counts WHERE n = 1", "word_counts")
view(
    "two_edits",
    """SELECT m.w, arg_min(d.w, (e, -d.n, d.w)) AS corrected FROM (SELECT m.w, d.w AS c, d.n,
         levenshtein(translate(m.w, 'ß', '0'), translate(d.w, 'ß', '0')) AS e FROM misspelt m JOIN dictionary d
         ON length(d.w) BETWEEN length(m.w) - 2 AND length(m.w) + 2) x JOIN dictionary d ON d.w = x.c JOIN misspelt m ON m.w = x.w
       WHERE e <= 2 GROUP BY m.w""",
    "dictionary misspelt",
)


@query("E13", sql("two_edits", "SELECT w, corrected FROM two_edits"))
def spelling_table(spark: SparkSession, sf: str) -> DataFrame:
    """Corrections at distance 2 of every word seen once, against the words seen at least five times."""
    counts = fx.word_counts(spark, sf)
    return correction_table(counts.filter("n = 1"), counts.filter("n >= 5"))


@query(
    "E13",
    sql("tokens dictionary misspelt two_edits", """SELECT t.review_id, count(*) AS n, count(*) FILTER (d.w IS NOT NULL) AS known,
    string_agg(coalesce(e.corrected, t.w), ' ' ORDER BY t.pos) AS tokens FROM (SELECT * FROM tokens SEMI JOIN (
      SELECT w FROM dictionary UNION ALL SELECT w FROM misspelt) k ON k.w = tokens.w) t
    LEFT JOIN dictionary d ON d.w = t.w LEFT JOIN two_edits e ON e.w = t.w GROUP BY t.review_id"""),
)
def spelling_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Words seen once or at least five times, corrected at distance 2: their number, the known ones before, and the text after."""
    counts = fx.word_counts(spark, sf)
    freq = counts.filter("n >= 5")
    long = fx.tokens(spark, sf).join(counts.filter("n = 1 OR n >= 5").select("w"), "w", "left_semi")
    corrected = correct_spelling(long.withColumn("seen", F.col("w")), freq)
    known = corrected.join(freq.select(F.col("w").alias("seen"), F.lit(1).alias("hit")), "seen", "left")
    words = F.transform(F.sort_array(F.collect_list(F.struct("pos", "w"))), lambda s: s["w"])
    return known.groupBy("review_id").agg(
        F.count(F.lit(1)).alias("n"), F.count("hit").alias("known"), F.array_join(words, " ").alias("tokens")
    )


@query(
    "E14",
    sql("seg_tokens stopwords", f"""SELECT {SEG}, review_id, term, tf FROM (SELECT *, count(*) OVER (PARTITION BY {SEG}, term) AS df FROM (
    SELECT {SEG}, review_id, w AS term, count(*) AS tf FROM seg_tokens WHERE w NOT IN (SELECT w FROM stopwords) GROUP BY ALL)) WHERE df >= 3"""),
)
def pruned_counts(spark: SparkSession, sf: str) -> DataFrame:
    return bw.count_vectors(fx.segment_docs(spark, sf), stop=fx.stopwords(spark))


@query("E15 A7", sql("seg_idf", f"SELECT {SEG}, term, df, n_docs, round(idf, 6) AS idf FROM seg_idf WHERE df <= 0.5 * n_docs"))
def idf_below_half(spark: SparkSession, sf: str) -> DataFrame:
    return bw.idf_table(fx.segment_docs(spark, sf), max_df=0.5).withColumn("idf", F.round("idf", 6))


@query("E15 A7", sql("seg_idf", f"SELECT {SEG}, term, df, n_docs, round(idf, 6) AS idf FROM seg_idf"))
def idf_of_all(spark: SparkSession, sf: str) -> DataFrame:
    return bw.idf_table(fx.segment_docs(spark, sf)).withColumn("idf", F.round("idf", 6))


@query("E16", sql("seg_tokens", f"SELECT {SEG}, review_id, w AS term, count(*) AS tf FROM seg_tokens GROUP BY ALL"))
def bag_of_words(spark: SparkSession, sf: str) -> DataFrame:
    return bw.bow(fx.segment_docs(spark, sf))


@query(
    "E16",
    sql("seg_tokens", f"SELECT {SEG}, w AS term, count(DISTINCT review_id) AS df, count(*) AS n FROM seg_tokens GROUP BY ALL"),
)
def segment_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return bw.vocabulary(bw.bow(fx.segment_docs(spark, sf)))


@query(
    "E17",
    sql("seg_tokens seg_idf", f"""SELECT {SEG}, review_id, term, round(x / sqrt(sum(x * x) OVER (PARTITION BY review_id)), 6) AS x FROM (
    SELECT {SEG}, review_id, term, tf * idf AS x FROM (SELECT {SEG}, review_id, w AS term, count(*) AS tf FROM seg_tokens GROUP BY ALL)
    JOIN seg_idf USING ({SEG}, term))"""),
)
def tfidf_rows(spark: SparkSession, sf: str) -> DataFrame:
    return bw.tfidf(fx.segment_docs(spark, sf)).withColumn("x", F.round("x", 6))


@query(
    "E18 E11",
    sql("reviews_q seg_prepared", """SELECT r.review_type, r.year_quarter, r.brand, r.review_id,
    coalesce(string_agg(p.lemma, ' ' ORDER BY p.pos), '') AS tokens FROM reviews_q r
    LEFT JOIN seg_prepared p ON p.review_id = r.review_id WHERE r.review_type IS NOT NULL GROUP BY ALL"""),
)
def prepared_reviews(spark: SparkSession, sf: str) -> DataFrame:
    docs = prepare(fx.reviews(spark, sf), fx.lexicon(spark, sf), fx.stopwords(spark))
    return _joined(docs, *TOPIC_SEGMENT, "review_id")


@query(
    "E18 M14",
    sql("reviews_q tokens lexicon stopwords", """SELECT r.year_quarter, r.review_id, coalesce(string_agg(p.lemma, ' ' ORDER BY p.pos), '') AS tokens
    FROM reviews_q r LEFT JOIN (SELECT review_id, t.pos, lemma FROM tokens t JOIN (SELECT w, pos AS tag, lemma FROM lexicon) l USING (w)
    WHERE tag IN ('N','A','V','R') AND lemma <> '-PRON-' AND lemma NOT IN (SELECT w FROM stopwords)) p ON p.review_id = r.review_id
    WHERE r.review_type IS NOT NULL AND year(r.date) = 2016 GROUP BY ALL"""),
)
def prepared_by_quarter(spark: SparkSession, sf: str) -> DataFrame:
    docs = prepare(
        fx.reviews(spark, sf), fx.lexicon(spark, sf), fx.stopwords(spark), ["year_quarter"], fx.YEARS, bigrams=False
    )
    return _joined(docs, "year_quarter", "review_id")


@query(
    "E17",
    sql("reviews", """SELECT review_id, array_to_string(regexp_extract_all(lower(comment), '[\\p{L}\\p{N}_]{2,}'), ' ') AS tokens FROM reviews"""),
)
def clustering_words(spark: SparkSession, sf: str) -> DataFrame:
    return _joined(raw_words(fx.reviews(spark, sf), keep=[]), "review_id")


def _phrase_query(kind: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        from feedback_lens.plans.similarity import cleaned_words, report_base

        words = cleaned_words(report_base(fx.reviews(spark, sf), fx.YEARS), fx.lexicon(spark, sf))
        found = match_phrases(F.col("words"), F.col("tags"), PATTERNS[kind])
        return words.select("review_id", F.explode(F.array_distinct(found)).alias("phrase"))

    run.__name__ = f"{kind}_phrases"
    return run


for _kind, _id in (("noun", "E19"), ("verb", "E20"), ("prep", "E21")):
    query(
        f"{_id} H10", sql("sim_phrases", f"SELECT review_id, phrase FROM sim_phrases WHERE phrase_type = '{_kind}'")
    )(_phrase_query(_kind))
