import random

from pyspark.sql import functions as F

from feedback_lens.operators import blocked as bl
from feedback_lens.operators import phrases as ph
from feedback_lens.operators.lexicon import explode_tokens, tag_tokens
from feedback_lens.operators.similarity import vectors_of


def test_blocks_tag_as_single_words_do(spark, monkeypatch):
    monkeypatch.setattr(ph, "BLOCK_REVIEWS", 3)
    rng = random.Random(3)
    rows = [(i // 2 if i < 8 else i, " ".join(rng.choices(["the", "good", "pump", "leaks", "déjà", "odd"], k=rng.randrange(9)))) for i in range(40)]
    rows += [(None, "pump leaks"), (None, "odd"), (90, None), (91, "")]
    texts = spark.createDataFrame(rows, "review_id long, comment string")
    lexicon = spark.createDataFrame([("good", "A", "good"), ("pump", "N", "pump"), ("pump", "V", "pump"), ("pump", "N", "a pump"), ("the", "D", "the")], "w string, pos string, lemma string")
    tokens = F.split("comment", " ")

    def kept(words):
        return tag_tokens(words, lexicon).filter(F.col("w") != "the")

    expected = ph.gather_tagged(kept(explode_tokens(texts.select("review_id", tokens.alias("tokens")))))
    assert sorted(ph.tagged_in_blocks(texts, "comment", tokens, kept).collect(), key=str) == sorted(expected.collect(), key=str)
    assert ph.tagged_in_blocks(texts.limit(0), "comment", tokens, kept).collect() == []


def test_words_meet_the_lexicon_once_per_block(spark):
    """Each token went to the lexicon and back."""
    words = F.transform(F.sequence(F.lit(1), F.lit(200)), lambda i: F.concat(F.lit("w"), (i * F.col("id") % 50).cast("string")))
    texts = spark.range(4000).select(F.col("id").alias("review_id"), F.array_join(words, " ").alias("comment"))
    lexicon = spark.createDataFrame([("w1", "N", "w1")], "w string, pos string, lemma string")
    asked = []

    def tag(words):
        asked.append(words.count())
        return tag_tokens(words, lexicon)

    rows = ph.tagged_in_blocks(texts, "comment", F.split("comment", " "), tag).collect()
    assert asked[0] <= 16 * 50  # of 800,000 tokens
    assert len(rows) == 4000 and all(len(r["words"]) == len(r["tags"]) == 200 for r in rows)


def test_reviews_that_share_a_vocabulary_score_alike(spark, monkeypatch):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(30)]
    vectors = spark.createDataFrame([(w, [rng.gauss(0, 1) for _ in range(4)]) for w in words[:25]], "word string, vec array<double>")
    rows = [(i, rng.choice(["noun", "verb"]), " ".join(rng.choices(words, k=3))) for i in range(60) for _ in range(3)]
    phrases = spark.createDataFrame(rows, "review_id long, phrase_type string, phrase string")
    given = [(f"h{i}", rng.choice(["noun", "verb"]), [rng.gauss(0, 1) for _ in range(4)]) for i in range(7)]
    hypotheses = spark.createDataFrame(given, "hypothesis string, phrase_type string, vec array<double>")

    def scores():
        found = bl.best_of_reviews(phrases, hypotheses, vectors_of(vectors))
        return {(r["review_id"], r["hypothesis"]): round(r["similarity"], 9) for r in found.collect()}

    expected = scores()
    monkeypatch.setattr(bl, "REVIEWS", 7)
    monkeypatch.setattr(bl, "_sharing", lambda spark, reviews: 25)
    assert scores() == expected and len(expected) > 100


def test_a_vocabulary_serves_more_reviews_the_more_there_are(spark):
    assert bl._sharing(spark, 1000) == bl.REVIEWS
    assert bl._sharing(spark, 10**7) == bl.SHARING_REVIEWS > bl.REVIEWS
