import datetime as dt

import numpy as np
import pytest

from feedback_lens.operators.coherence import embedding_coherence
from feedback_lens.operators import blocked
from feedback_lens.operators.phrases import long_phrases, with_phrases
from feedback_lens.operators.similarity import analyze_hypothesis, overall_score, phrase_scores, phrase_vectors, top_reviews
from feedback_lens.plans.similarity import cleaned_words, report_base, scored_reviews, similarity_table

LEXICON = [("pot", "N", "pot"), ("lid", "N", "lid"), ("leaks", "V", "leak"), ("the", "D", "the"), ("zzz", "N", "zzz")]
VECTORS = [("pot", [1.0, 0.0]), ("lid", [0.0, 1.0]), ("leak", [1.0, 1.0])]


def lexicon(spark):
    return spark.createDataFrame(LEXICON, "w string, pos string, lemma string")


def vectors(spark):
    return spark.createDataFrame(VECTORS, "word string, vec array<float>")


def test_hypothesis_kinds(spark):
    found = {r.hypothesis: (r.phrase_type, r.phrases) for r in analyze_hypothesis(spark, ["pot leaks", "the ,"], lexicon(spark)).collect()}
    assert found == {"pot leaks": ("noun", ["pot"])}


def test_scores_against_numpy(spark):
    phrases = spark.createDataFrame([("noun", "pot lid"), ("noun", "zzz"), ("verb", "leak")], "phrase_type string, phrase string")
    hyps = spark.createDataFrame([("h", "noun", ["lid", "pot zzz"])], "hypothesis string, phrase_type string, phrases array<string>")
    rows = {r.phrase: r.score for r in phrase_scores(phrases, hyps, vectors(spark)).collect()}
    assert set(rows) == {"pot lid"}
    assert rows["pot lid"] == pytest.approx(np.sqrt(0.5))


def test_report_edges(spark):
    day = dt.date(2016, 2, 1)
    rows = [(i, "n", 3.0, "the lid", day, "a", 0, "s") for i in range(8)]
    rows += [(8, "n", 5.0, "pot", day, "a", 0, "s"), (9, "n", 1.0, "", day, "a", 0, "s")]
    rows += [(100 + i, "n", 3.0, "pot", day, "b", 0, "s") for i in range(9)]
    schema = "review_id long, name string, rating double, comment string, date date, brand string, usefulness int, source string"
    table = similarity_table(
        spark.createDataFrame(rows, schema), ["pot", "the ,"], [2016], lexicon(spark), vectors(spark), 0.6, -0.2
    ).orderBy("rank").collect()
    assert {r.brand for r in table} == {"a"} and {r.hypothesis for r in table} == {"pot"}
    assert [(r.review_id, r.similarity) for r in table] == [(8, 0.8), (9, 0.2), (0, 0.0), (1, 0.0), (2, 0.0)]
    assert all(r.overall_score == pytest.approx(0.1) and r.company is None for r in table)


def test_report_by_blocks_equals_one_row_per_review_and_hypothesis(spark, monkeypatch):
    """Small blocks: many hypotheses, reviews and phrases meet in many groups."""
    for name, size in (("PHRASES", 3), ("HYPOTHESES", 4), ("REVIEWS", 5), ("COLUMNS", 2)):
        monkeypatch.setattr(blocked, name, size)
    rng = np.random.default_rng(2)
    words = [f"n{i}" for i in range(12)]
    known = spark.createDataFrame([(w, [float(x) for x in rng.normal(size=3)]) for w in words[:9]] + [("n9", [0.0] * 3)], "word string, vec array<float>")
    lex = spark.createDataFrame([(w, "N", w) for w in words], "w string, pos string, lemma string")
    day = dt.date(2016, 5, 1)
    rows = [(i, "n", float(rng.integers(1, 6)), " , ".join(rng.choice(words, rng.integers(0, 4))), day, "ab"[i % 2], 0, "s") for i in range(40)]
    schema = "review_id long, name string, rating double, comment string, date date, brand string, usefulness int, source string"
    reviews = spark.createDataFrame(rows, schema)
    asked = [" , ".join(rng.choice(words, rng.integers(1, 3))) for _ in range(25)] + ["n11", "n9"]
    keys = ["hypothesis", "year_quarter", "brand"]
    base = report_base(reviews, [2016])
    phrases = long_phrases(with_phrases(cleaned_words(base, lex)))
    scored = scored_reviews(base, phrases, asked, lex, known, -0.2)
    shares = {tuple(r)[:3]: r.overall_score for r in overall_score(scored, 0.3, keys).collect()}
    best = {(*[r[k] for k in keys], r["rank"]): (r.review_id, r.similarity) for r in top_reviews(scored, keys, 3).collect()}
    table = similarity_table(reviews, asked, [2016], lex, known, 0.3, -0.2, 3).collect()
    assert {(*[r[k] for k in keys], r["rank"]): (r.review_id, pytest.approx(r.similarity, abs=1e-9)) for r in table} == best
    assert all(r.overall_score == pytest.approx(shares[tuple(r[k] for k in keys)]) for r in table) and len(best) > 100


def test_vector_coherence(spark):
    words = [("x", 1, w) for w in ("pot", "lid", "leak")] + [("x", 2, "pot"), ("x", 3, "zzz")]
    found = embedding_coherence(spark.createDataFrame(words, "s string, topic int, keyword string"), vectors(spark), ["s"])
    scores = {r.topic: r.coherence for r in found.collect()}
    assert scores[1] == pytest.approx((0 + 2 * np.sqrt(0.5)) / 3)
    assert scores[2] == 0 and scores[3] == 0


def test_vectors_meet_phrases_once_per_block(spark):
    """A block gets each word's vector once: words of phrases never carry vectors through a shuffle. Repeats, copies and unknown words count as before."""
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(8)]
    rows = [(w, [float(x) for x in rng.normal(size=3)]) for w in words[:6]] + [("w0", [1.0, 2.0, 3.0]), ("w9", None)]
    known = spark.createDataFrame(rows, "word string, vec array<double>")
    phrases = [" ".join(rng.choice(words, rng.integers(1, 9))) for _ in range(60)] + ["w6", "w9", "", "w0 w0", None]
    given = spark.createDataFrame([(p,) for p in phrases], "phrase string")
    found = phrase_vectors(given, known)
    assert "collect_list" not in found._jdf.queryExecution().toString()
    table = {r.phrase: r.vec for r in found.collect()}
    wanted = {}
    for phrase in filter(None, phrases):
        vecs = [v for word in phrase.split(" ") for w, v in rows if w == word and v is not None]
        if vecs:
            wanted[phrase] = pytest.approx(np.mean(vecs, axis=0))
    assert table == wanted and len(wanted) > 30


def test_blocks_without_hypotheses_or_words(spark):
    day = dt.date(2016, 2, 1)
    rows = [(i, "n", 3.0, "the lid", day, "a", 0, "s") for i in range(12)]
    schema = "review_id long, name string, rating double, comment string, date date, brand string, usefulness int, source string"
    reviews = spark.createDataFrame(rows, schema)
    base = report_base(reviews, [2016])
    phrases = long_phrases(with_phrases(cleaned_words(base, lexicon(spark))))
    none = vectors(spark).limit(0)
    assert similarity_table(reviews, ["the ,"], [2016], lexicon(spark), vectors(spark)).count() == 0
    assert {r.similarity for r in similarity_table(reviews, ["pot"], [2016], lexicon(spark), none).collect()} == {0.0}
    assert scored_reviews(base, phrases, ["the ,"], lexicon(spark), vectors(spark)).count() == 0
    assert {r.similarity for r in scored_reviews(base, phrases, ["pot"], lexicon(spark), none).collect()} == {0.0}
    assert phrase_vectors(phrases.limit(0), vectors(spark)).count() == 0
